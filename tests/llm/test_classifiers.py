"""Toxicity, quality grades and language mixtures: held-out accuracy on made-up labels, and defined results."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchantlake.llm import language_mix as L
from merchantlake.llm import quality_ordinal as Q
from merchantlake.llm import toxicity_nb as T
from merchantlake.llm.common import held_out
from merchantlake.llm.ngrams import counted, minimise
from merchantlake.llm.training import labelled_sample

LETTERS = {"xx": "abcdefg", "yy": "hijklmnop", "zz": "qrstuvéè"}


def sentence(r, letters, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def graded(spark):
    """Rude words in a third of the texts, symbols in others."""
    r = random.Random(1)
    docs, marks = [], []
    for k in range(900):
        text, toxic, good = sentence(r, "abcdefgh", r.randint(5, 60)), k % 3 == 0, k % 4 != 0
        words = text.split()
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(["nitwit", "rotter"]))
        if not good:
            words = [w + "###" for w in words]
        docs.append((k, " ".join(words)))
        marks.append((k, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def test_fold_follows_the_checksum(spark):
    ids = [*range(50), None]
    got = {x.i: x.held for x in spark.createDataFrame([(i,) for i in ids], "i bigint").select("i", held_out(F.col("i")).alias("held")).collect()}
    assert got == {i: True if i is None else zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_sample_is_bounded_and_holds_nothing_out(spark, graded):
    docs, labels = graded
    known = labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None)], labels.schema))
    sample = labelled_sample(docs.withColumn("text", F.col("doc_id").cast("string")), known, "toxic", 50).collect()
    assert [sum(x.label == k for x in sample) for k in (0, 1)] == [50, 50]
    assert all(zlib.crc32(x.text.encode()) % 5 for x in sample)


def test_toxicity_on_held_out_rows(graded):
    docs, labels = graded
    scored = T.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    assert scored.count() > 100
    assert scored.where("predicted != toxic").count() <= 0.03 * scored.count()
    assert scored.where("score < 0 or score > 1 or predicted != cast(score >= 0.5 as int)").count() == 0


def test_held_out_labels_change_nothing(graded, rows):
    docs, labels = graded
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    few = docs.where("doc_id < 40")
    ours = T.train(docs, labels).scores([x.text for x in few.collect()])
    theirs = T.train(docs, flipped).scores([x.text for x in few.collect()])
    assert np.allclose(ours, theirs)


def test_grades_on_held_out_rows(graded):
    docs, labels = graded
    ratings = labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("rating"))
    got = Q.quality_grades(docs, ratings, "rating").join(ratings, "doc_id").where("held_out")
    assert got.where("selected != (rating >= 1)").count() <= 0.05 * got.count()
    means = {x.rating: x.m for x in got.groupBy("rating").agg(F.avg("expected_grade").alias("m")).collect()}
    assert means[0] < means[1] < means[2]


def test_thresholds_are_ordered_and_the_slope_is_right():
    r = np.random.default_rng(0)
    features = [np.unique(r.integers(0, 50, 8)) for _ in range(200)]
    grade = np.array([min(3, int(sum(f < 12))) for f in features])
    model = Q.fit(grade, features, [np.ones(len(f)) for f in features])
    assert (np.diff(model.thresholds) > 0).all() and model.grades.tolist() == sorted(set(grade))


def test_minimise_finds_the_least():
    a = np.diag(np.arange(1.0, 21))
    found = minimise(lambda x: (0.5 * x @ a @ x - x.sum(), a @ x - 1), np.zeros(20), 100)
    assert np.allclose(found, 1 / np.arange(1, 21), atol=1e-2)


def test_ngrams_stay_inside_texts_and_count_all():
    texts = ["abcabc", None, "ab", "", "xabcx" * 1000]
    got = {}
    for begin, _, owner, bucket, times in counted(texts, (3,), 14):
        for o, b, n in zip(owner, bucket, times):
            got.setdefault(begin + int(o), {})[int(b)] = int(n)
    assert {k: sum(v.values()) for k, v in got.items()} == {0: 4, 4: 4998}
    assert sorted(got[0].values()) == [1, 1, 2]


@pytest.fixture(scope="module")
def tongues(spark):
    r = random.Random(2)
    rows = [(k, sentence(r, LETTERS[lang], r.randint(2, 80)), lang) for k, lang in enumerate(list(LETTERS) * 150)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_on_held_out_rows(tongues):
    got = L.languages(tongues).join(tongues.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out and lang_pred != lang").count() == 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_a_mixed_text_has_both_languages(tongues):
    r = random.Random(4)
    model = L.train(tongues)
    both = sentence(r, LETTERS["xx"], 300) + " " + sentence(r, LETTERS["zz"], 100)
    mix, some = model.mixtures([both, sentence(r, LETTERS["yy"], 100), None])
    assert model.languages == ["xx", "yy", "zz"] and some.tolist() == [True, True, False]
    assert mix[0] == pytest.approx([0.75, 0, 0.25], abs=0.05)
    assert mix[1].tolist() == [0, 1, 0]


def test_awkward_rows(spark, awkward, labels, tongues):
    got = L.languages(awkward)
    assert got.count() == awkward.count()
    by_id = {x.doc_id: x for x in got.collect()}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 1.0 for k in (8, 9, 10, 12))
    assert by_id[None].held_out and by_id[11].lang_pred in {"en", "de", "fr"}
    scored = T.toxicity(awkward, labels)
    assert scored.count() == awkward.count() and scored.where("score is null or isnan(score)").count() == 0
    assert len({x.score for x in scored.where("doc_id in (8, 9)").collect()}) == 1
    grades = Q.quality_grades(awkward, labels, "quality")
    assert grades.count() == awkward.count() and grades.where("expected_grade is null").count() == 0


def test_nothing_to_learn_from(awkward, no_documents, no_labels, labels):
    assert L.languages(no_documents).count() == 0
    assert T.toxicity(no_documents, labels).count() == 0
    assert Q.quality_grades(no_documents, labels, "quality").count() == 0
    assert {x.predicted for x in T.toxicity(awkward, no_labels).collect()} == {0}
    assert {x.grade for x in Q.quality_grades(awkward, no_labels, "quality").collect()} == {0}
    unknown = L.languages(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert {x.lang_pred for x in unknown.collect()} == {"und"}


def test_a_text_of_four_languages_keeps_them_all(spark):
    r = random.Random(4)
    letters = {"ww": "abcdef", "xx": "ghijkl", "yy": "mnopqr", "zz": "stuvwx"}
    rows = [(k, sentence(r, letters[n], 30), n) for k, n in enumerate(sorted(letters) * 60)]
    model = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    mix, _ = model.mixtures([" ".join(sentence(r, x, 200) for x in letters.values()), sentence(r, letters["ww"], 50)])
    assert (np.abs(mix[0] - 0.25) < 0.03).all() and np.count_nonzero(mix[1]) == 1


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(k % 50, f"text {k}") for k in range(500)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id bigint, toxic int")
    sample = labelled_sample(docs, marks, "toxic", 100).collect()
    known = docs.where(~held_out(F.col("doc_id"))).select("doc_id").distinct().count()
    assert len(sample) == len({x.text for x in sample}) == known


def test_toxicity_fit_equals_a_plain_one(monkeypatch):
    """Ratios, loss and slope on a dense matrix, with entries worked on in small portions."""
    monkeypatch.setattr(T, "ENTRIES_AT_ONCE", 50)
    rng = np.random.default_rng(3)
    y = (rng.random(60) < 0.4).astype(float)
    dense = rng.random((60, 30)) < 0.3
    sample = T.Sample(y, [np.flatnonzero(row).astype(np.int32) for row in dense])
    p, q = 1 + dense[y > 0].sum(axis=0), 1 + dense[y == 0].sum(axis=0)
    ratio = np.log((p / (y.sum() + 1)) / (q / ((1 - y).sum() + 1)))
    assert np.allclose(T.log_ratios(sample, 30), ratio)
    loss, x = T.loss_of(sample, ratio), rng.normal(size=31)

    def plain(x):
        z = (dense * ratio) @ x[:-1] + x[-1]
        return (np.log1p(np.exp(z)) - y * z).sum() + 0.5 * x[:-1] @ x[:-1]

    value, slope = loss(x)
    assert value == pytest.approx(plain(x))
    steps = np.eye(31) * 1e-6
    assert np.allclose(slope, [(plain(x + s) - plain(x - s)) / 2e-6 for s in steps], atol=1e-4)
    number = np.where(np.arange(30) % 3 == 0, -1, np.cumsum(np.arange(30) % 3 != 0) - 1).astype(np.int32)
    sample.keep(number)
    left = dense[:, np.arange(30) % 3 != 0]
    assert np.allclose(sample.added(y, left.shape[1]), left[y > 0].sum(axis=0)) and np.allclose(sample.gathered(np.ones(left.shape[1])), left.sum(axis=1))
