"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

The presence of an n-gram counts, not how often it occurs. A ratio says how much more frequent the n-gram is among toxic
texts of the training sample; a logistic regression is then fitted to presence times ratio.

Defined results: null and empty texts have no n-grams and score by the intercept alone. Null ids count as held out and are
never learnt from. Repeated rows get equal scores. Texts of any length are read whole, in portions. An empty table gives an empty result, and without labels of both kinds
every score is the share of toxic rows, or 0 when there is none. Labels and other columns are never part of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import logistic, with_text_id
from merchantlake.llm.ngrams import NO_LETTERS, counted, minimise
from merchantlake.llm.training import labelled_sample

#: Long enough to hold a word with its begin, or its first letters where a letter takes two bytes.
SIZES = (6, 8)
BITS = 20
#: The bound of the training sample: rows of each class.
PER_CLASS = 3000
SMOOTHING = 1.0
RIDGE = 1.0
LEAST_TEXTS = 3
STEPS = 60


def _prepare(text: str | None) -> str:
    """Lower case, a space wherever no letter is, and one before the first word."""
    return " " + (text or "").lower().translate(NO_LETTERS)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for begin, n, owner, bucket, _ in counted(texts, SIZES, BITS, _prepare):
            sums = np.bincount(owner, weights=self.weights[bucket], minlength=n)
            out[begin : begin + n] = logistic(sums + self.intercept)
        return out


#: Entries of the training sample that are worked on at once.
ENTRIES_AT_ONCE = 1 << 21


class Sample:
    """Presence of n-grams in labelled texts: the distinct buckets of each, one after the other, in 32 bits."""

    def __init__(self, toxic: np.ndarray, features: list[np.ndarray]):
        self.y = np.asarray(toxic).astype(np.float64)
        self.ends = np.cumsum([len(f) for f in features], dtype=np.int64)
        self.buckets = np.concatenate([np.empty(0, dtype=np.int32), *features])
        features.clear()

    def parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Texts, their entries, and the text of each entry, a bounded number of entries at a time."""
        begin = 0
        while begin < len(self.y):
            low = self.ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(self.ends, low + ENTRIES_AT_ONCE, side="right")))
            sizes = np.diff(self.ends[begin:end], prepend=low)
            yield slice(begin, end), self.buckets[low : self.ends[end - 1]], np.repeat(np.arange(end - begin), sizes)
            begin = end

    def added(self, of_texts: np.ndarray, size: int) -> np.ndarray:
        """For each bucket, the sum of a number over the texts that have it."""
        out = np.zeros(size)
        for texts, entries, owner in self.parts():
            out += np.bincount(entries, weights=of_texts[texts][owner], minlength=size)
        return out

    def gathered(self, of_buckets: np.ndarray) -> np.ndarray:
        """For each text, the sum of a number over its buckets."""
        return np.concatenate([np.bincount(owner, weights=of_buckets[entries], minlength=t.stop - t.start) for t, entries, owner in self.parts()])

    def keep(self, number: np.ndarray) -> None:
        """Give the buckets new numbers, in place, and drop those whose number is negative."""
        sizes, at = [], 0
        for texts, entries, owner in self.parts():
            new = number[entries]
            kept = new >= 0
            sizes.append(np.bincount(owner[kept], minlength=texts.stop - texts.start))
            new = new[kept]
            self.buckets[at : at + len(new)] = new
            at += len(new)
        self.buckets = self.buckets[:at]
        self.ends = np.cumsum(np.concatenate(sizes))


def log_ratios(sample: Sample, size: int) -> np.ndarray:
    """How much more frequent each bucket is among toxic texts than among others."""
    p, q = SMOOTHING + sample.added(sample.y, size), SMOOTHING + sample.added(1 - sample.y, size)
    return np.log((p / (sample.y.sum() + SMOOTHING)) / (q / ((1 - sample.y).sum() + SMOOTHING)))


def loss_of(sample: Sample, ratio: np.ndarray):
    """Penalised loss of weights and intercept, and its slope."""
    y = sample.y

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]
        z = sample.gathered(w * ratio) + b
        error = logistic(z) - y
        value = np.logaddexp(0, z).sum() - y @ z + 0.5 * RIDGE * (w @ w)
        return value, np.append(sample.added(error, len(ratio)) * ratio + RIDGE * w, error.sum())

    return loss


def fit(toxic: np.ndarray, features: list[np.ndarray]) -> Model:
    """``features`` has the distinct buckets of each text, as 32-bit integers; the list is emptied."""
    sample = Sample(toxic, features)
    y, size = sample.y, 1 << BITS
    share = y.mean() if len(y) else 0.0
    weights = np.zeros(size, dtype=np.float32)
    zero = Model(weights, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    if not 0 < share < 1:
        return zero
    ids = np.flatnonzero(sample.added(np.ones(len(y)), size) >= LEAST_TEXTS)
    if not len(ids):
        return zero
    number = np.full(size, -1, dtype=np.int32)
    number[ids] = np.arange(len(ids))
    sample.keep(number)
    ratio = log_ratios(sample, len(ids))
    x = minimise(loss_of(sample, ratio), np.zeros(len(ids) + 1), STEPS)
    weights[ids] = x[:-1] * ratio
    return Model(weights, float(x[-1]))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, found = batch["text"].tolist(), []
        for _, n, owner, bucket, _ in counted(texts, SIZES, BITS, _prepare):
            found += [part.tobytes() for part in np.split(bucket.astype(np.int32), np.searchsorted(owner, np.arange(1, n)))]
        yield pd.DataFrame({"label": batch["label"].astype("int32"), "f": found})


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labels, features = [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        features += [np.frombuffer(f.as_py(), dtype=np.int32) for f in batch.column("f")]
    if labels:
        model = fit(np.array(labels) > 0, features)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.intercept])], ["weights", "intercept"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    sample = labelled_sample(docs, labels, label, per_class).mapInPandas(_features, "label int, f binary")
    rows = sample.repartition(1).mapInArrow(_fit_rows, "weights binary, intercept double").toPandas()
    if rows.empty:
        return Model(np.zeros(1 << BITS, dtype=np.float32), -60.0)
    return Model(np.frombuffer(rows["weights"][0], dtype=np.float32), float(rows["intercept"][0]))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    model = train(given, labels, label)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = model.scores(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    scored = with_text_id(given).mapInPandas(score, "doc_id string, held_out boolean, score double, predicted int")
    return scored.withColumn("doc_id", F.col("doc_id").cast(given.schema["doc_id"].dataType))
