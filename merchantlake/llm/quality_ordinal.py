"""Quality classifier: ordinal regression with cumulative links on graded ratings.

One weight per hashed n-gram is shared by all grades, and ordered thresholds cut the score: the chance that the grade
exceeds k is logistic(score - threshold k). It gives the expected grade, and the tail probability by which documents are
selected.

Defined results: null and empty texts score zero before the thresholds. Null ids count as held out and are never learnt
from. Repeated rows get equal results. Texts of any length are read whole, in portions. An empty table gives an empty result. With fewer than two grades in the sample
the grade is that one (or 0), with certainty. Labels and other columns are never part of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import logistic, with_text_id
from merchantlake.llm.ngrams import counted, minimise
from merchantlake.llm.training import fitted, labelled_sample

SIZES = (3,)
BITS = 16
#: The bound of the training sample: rows of each grade.
PER_GRADE = 3000
RIDGE = 0.02
STEPS = 80
SELECT_AT = 0.5


def _entries(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed n-grams with damped counts, scaled to length one for each text."""
    for begin, n, owner, bucket, times in counted(texts, SIZES, BITS, prepare=lambda t: t or ""):
        value = np.log1p(times)
        norm = np.sqrt(np.bincount(owner, weights=value * value, minlength=n))
        yield begin, n, owner, bucket, value / norm[owner]


@dataclass(frozen=True)
class Model:
    """``grades`` ascending; ``thresholds`` has one entry less."""

    grades: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """For each text, the chance of a grade above each but the last."""
        score = np.zeros(len(texts))
        for begin, n, owner, bucket, value in _entries(texts):
            score[begin : begin + n] = np.bincount(owner, weights=self.weights[bucket] * value, minlength=n)
        return logistic(score[:, None] - self.thresholds[None, :])


def fit(grade: np.ndarray, features: list[np.ndarray], values: list[np.ndarray]) -> Model:
    grades, y = np.unique(grade, return_inverse=True)
    empty = np.zeros(1 << BITS, dtype=np.float32)
    if len(grades) < 2:
        return Model(grades if len(grades) else np.zeros(1, dtype=int), empty, np.empty(0))
    owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
    ids, column = np.unique(np.concatenate(features), return_inverse=True)
    value = np.concatenate(values)
    cuts = len(grades) - 1
    above = np.append(np.cumsum(np.bincount(y)[::-1])[::-1][1:] / len(y), 0)[:cuts]
    start = np.log((1 - above) / above)
    gaps = np.log(np.maximum(np.diff(start), 1e-3))

    def thresholds(x: np.ndarray) -> np.ndarray:
        return x[len(ids)] + np.append(0, np.cumsum(np.exp(x[len(ids) + 1 :])))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, t = x[: len(ids)], thresholds(x)
        z = np.bincount(owner, weights=w[column] * value, minlength=len(y))
        tail = logistic(z[:, None] - t[None, :])
        upper = np.column_stack([np.ones(len(y)), tail])[np.arange(len(y)), y]
        lower = np.column_stack([tail, np.zeros(len(y))])[np.arange(len(y)), y]
        chance = np.maximum(upper - lower, 1e-12)
        # By the two thresholds beside the grade.
        by_upper, by_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = by_lower - by_upper
        slope_t = np.zeros(cuts)
        np.add.at(slope_t, y[y > 0] - 1, by_upper[y > 0])
        np.add.at(slope_t, y[y < cuts], -by_lower[y < cuts])
        later = np.cumsum(slope_t[::-1])[::-1]
        slope_x = np.append(later[0], later[1:] * np.exp(x[len(ids) + 1 :]))
        slope_w = np.bincount(column, weights=by_score[owner] * value, minlength=len(ids)) + RIDGE * w
        return 0.5 * RIDGE * (w @ w) - np.log(chance).sum(), np.concatenate([slope_w, slope_x])

    x = minimise(loss, np.concatenate([np.zeros(len(ids)), start[:1], gaps]), STEPS)
    weights = empty.copy()
    weights[ids] = x[: len(ids)]
    return Model(grades, weights, thresholds(x))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, f, v = batch["text"].tolist(), [], []
        for _, n, owner, bucket, value in _entries(texts):
            ends = np.searchsorted(owner, np.arange(1, n))
            f += np.split(bucket.astype(np.int32), ends)
            v += np.split(value.astype(np.float32), ends)
        yield pd.DataFrame({"label": batch["label"].astype("int32"), "f": f, "v": v})


def _fit_rows(sample: pd.DataFrame) -> pd.DataFrame:
    arrays = [[np.asarray(a) for a in sample[c]] for c in ("f", "v")]
    model = fit(sample["label"].to_numpy(), *arrays)
    return pd.DataFrame({
        "grades": [model.grades.astype(int).tolist()], "weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tolist()],
    })


def train(docs: DataFrame, ratings: DataFrame, rating: str, per_grade: int = PER_GRADE) -> Model:
    sample = labelled_sample(docs, ratings, rating, per_grade).mapInPandas(_features, "label int, f array<int>, v array<float>")
    rows = fitted(sample, _fit_rows, "grades array<int>, weights binary, thresholds array<double>")
    if rows.empty:
        return Model(np.zeros(1, dtype=int), np.zeros(1 << BITS, dtype=np.float32), np.empty(0))
    first = rows.iloc[0]
    return Model(np.asarray(first["grades"]), np.frombuffer(first["weights"], dtype=np.float32), np.asarray(first["thresholds"], dtype=float))


def quality_grades(
    docs: DataFrame, ratings: DataFrame, rating: str, doc_id: str = "doc_id", text: str = "text", at_least: int = 1
) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_probability (grade ``at_least`` or better), grade, selected."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    model = train(given, ratings, rating)
    grades = model.grades.astype(float)
    # The lowest threshold above which every grade is at_least or better.
    cut = int(np.searchsorted(model.grades, at_least)) - 1

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tails = model.tails(batch["text"].tolist())
            if cut < 0:
                tail = np.ones(len(batch))
            else:
                tail = tails[:, cut] if cut < tails.shape[1] else np.zeros(len(batch))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"],
                "expected_grade": grades[0] + tails @ np.diff(grades), "tail_probability": tail,
                "grade": model.grades[(tails >= 0.5).sum(axis=1)].astype("int32"), "selected": tail >= SELECT_AT,
            })

    schema = "doc_id string, held_out boolean, expected_grade double, tail_probability double, grade int, selected boolean"
    predicted = with_text_id(given).mapInPandas(predict, schema)
    return predicted.withColumn("doc_id", F.col("doc_id").cast(given.schema["doc_id"].dataType))
