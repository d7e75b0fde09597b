"""Language identification as mixture inference.

Every language has a distribution over hashed byte n-grams, learnt from labelled texts. A document is a mixture of
languages whose proportions expectation-maximisation estimates from its n-grams. Smaller sets, made of the languages with
the largest proportions, are fitted again, and the set with the best likelihood after a price per language is selected. Sets
of every size up to all languages take part, except where no set of that size could do better.

Defined results: a text that is null or has no letters is ``und`` with score 1. Null ids count as held out and are never
learnt from, as are rows without a language. Repeated rows get equal results. Texts of any length are read whole, in portions;
letters too few for an n-gram say nothing, and equal likelihoods give the first language. An empty table gives an empty result; with
nothing to learn from, every text is ``und`` with score 0. Language, source and id are never part of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import with_text_id
from merchantlake.llm.ngrams import NO_LETTERS, counted
from merchantlake.llm.training import labelled_sample

UNDETERMINED = "und"
SIZES = (3,)
BITS = 14
#: The bound of the training sample: rows of each language.
PER_LANGUAGE = 2000
SMOOTHING = 0.5
ROUNDS = 8
#: Price of one more language, in units of half the logarithm of a document's n-grams. N-grams overlap, so it is over 1.
PENALTY = 6.0
LETTER = re.compile(r"[^\W\d_]")


def _prepare(text: str | None) -> str:
    return (text or "").lower().translate(NO_LETTERS)


@dataclass(frozen=True)
class Model:
    """``chance[bucket, language]``."""

    languages: list[str]
    chance: np.ndarray

    def mixtures(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the proportion of each language within its selected set, and whether it has n-grams."""
        out = np.zeros((len(texts), len(self.languages)))
        some = np.zeros(len(texts), dtype=bool)
        for begin, n, owner, bucket, times in counted(texts, SIZES, BITS, _prepare):
            if not len(owner):
                continue
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            which = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(owner))))
            out[begin + owner[starts]] = _select(self.chance[bucket], times, starts, which)
            some[begin + owner[starts]] = True
        return out, some


def _expect(p: np.ndarray, times: np.ndarray, starts: np.ndarray, which: np.ndarray, mix: np.ndarray, rounds: int):
    """Proportions after some rounds of expectation-maximisation, and the likelihood before the last."""
    total = np.add.reduceat(times, starts).astype(np.float32)
    for _ in range(rounds):
        part = p * mix[which]
        whole = part.sum(axis=1)
        part *= (times / np.maximum(whole, 1e-30))[:, None]
        mix = np.add.reduceat(part, starts, axis=0) / total[:, None]
    fit = np.add.reduceat(times * np.log(np.maximum((p * mix[which]).sum(axis=1), 1e-30)), starts)
    return mix, fit


def _select(p: np.ndarray, times: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    times = times.astype(np.float32)
    languages = p.shape[1]
    even = np.full((len(starts), languages), 1 / languages, dtype=np.float32)
    full, _ = _expect(p, times, starts, which, even, ROUNDS)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    price = 0.5 * PENALTY * np.log(np.add.reduceat(times, starts))
    # No mixture is likelier than the likeliest language of each n-gram by itself.
    ceiling = np.add.reduceat(times * np.log(np.maximum(p.max(axis=1), 1e-30)), starts)
    best, best_value = full.copy(), np.full(len(starts), -np.inf)
    for size in range(1, languages + 1):
        open_ = np.flatnonzero(ceiling - size * price > best_value)
        if not len(open_):
            break
        taken = np.zeros(len(starts), dtype=bool)
        taken[open_] = True
        part = slice(None) if taken.all() else taken[which]
        own = which[part]
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        mix = np.where(rank[open_] < size, np.maximum(full[open_], 1e-6), 0).astype(np.float32)
        mix /= mix.sum(axis=1, keepdims=True)
        of = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(own))))
        mix, fit = _expect(p[part], times[part], begins, of, mix, 1 if size == 1 else 3)
        value = fit - size * price[open_]
        better = value > best_value[open_]
        best[open_[better]], best_value[open_[better]] = mix[better], value[better]
    return best


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts of each language in one task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, group in batch.groupby("label"):
            total = sums.setdefault(language, np.zeros(1 << BITS))
            for _, _, _, bucket, times in counted(group["text"].tolist(), SIZES, BITS, _prepare):
                total += np.bincount(bucket, weights=times, minlength=1 << BITS)
    for language, total in sums.items():
        found = np.flatnonzero(total)
        yield pd.DataFrame({"label": language, "bucket": found, "n": total[found].astype(np.int64)})


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """From (doc_id, text, lang). The model has one row of bounded length for each language."""
    sample = labelled_sample(docs, docs.select("doc_id", "lang"), "lang", per_language)
    counts = sample.mapInPandas(_counts, "label string, bucket bigint, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()
    languages = sorted(rows["label"].unique())
    sums = np.zeros((1 << BITS, len(languages)))
    for k, language in enumerate(languages):
        own = rows[rows["label"] == language]
        sums[own["bucket"].to_numpy(), k] = own["n"]
    chance = (sums + SMOOTHING) / (sums + SMOOTHING).sum(axis=0, keepdims=True)
    return Model(languages, chance.astype(np.float32))


def languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE
) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the language's proportion), mixture (proportions of the selected set)."""
    given = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")
    )
    model = train(given, per_language)
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            letters = np.array([bool(t) and LETTER.search(t) is not None for t in texts], dtype=bool)
            if model.languages:
                mix, some = model.mixtures(texts)
                first = mix.argmax(axis=1)
                score = mix[np.arange(len(texts)), first]
            else:
                mix, some = np.zeros((len(texts), 0)), np.ones(len(texts), dtype=bool)
                first, score = np.full(len(texts), -1), np.zeros(len(texts))
            # Letters, but fewer bytes than an n-gram: every language is as likely.
            short = letters & ~some
            first, score = np.where(short, 0, first), np.where(short, 1 / max(1, len(model.languages)), score)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"],
                "lang_pred": names[np.where(letters, first, -1)], "score": np.clip(np.where(letters, score, 1.0), 0, 1),
                "mixture": [{names[k]: float(m[k]) for k in np.flatnonzero(m)} if on else {} for m, on in zip(mix, letters)],
            })

    schema = "doc_id string, held_out boolean, lang_pred string, score double, mixture map<string,double>"
    predicted = with_text_id(given).mapInPandas(predict, schema)
    return predicted.withColumn("doc_id", F.col("doc_id").cast(given.schema["doc_id"].dataType))
