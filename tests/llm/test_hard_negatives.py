"""Hard negatives against a plain program."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchantlake.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, every=100, low=80, most=5):
    whole = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in rows]
    out = []
    for a in whole:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in whole if r[0] != a[0])
        for n, p, _ in [x for x in scored if x[2] == a[1]][:most]:
            found = [(i, -m) for m, i, lab in scored if lab != a[1] and low * -n <= -100 * m <= -100 * n][:most]
            out += [(a[0], p, k, i, -n, s) for k, (i, s) in enumerate(found, 1)]
    return out


def tied_rows(seed, n, width=4):
    r = random.Random(seed)
    return [(i, r.randrange(3), [r.choice([0.1, 0.2, -0.1, 0.3]) for _ in range(width)]) for i in range(-50, n)]


@pytest.mark.parametrize("block, at_once", [(1 << 13, 1 << 8), (97, 3)])
def test_equals_brute_force_with_many_ties(spark, rows, monkeypatch, block, at_once):
    given = tied_rows(1, 700)
    df = spark.createDataFrame(given, SCHEMA).repartition(5)
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "AT_ONCE", at_once)
    assert rows(H.hard_negatives(df, F.col("id") % 100 == 0)) == sorted(brute(given), key=repr)


def test_rows_that_take_no_part_and_repeats(spark, rows):
    given = tied_rows(3, 250)
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, [0.1] * 4), (900, None, [0.9] * 4), (901, 1, None), (902, 1, [0.9, None, 0.9, 0.9]), (903, 1, [nan] * 4), (904, 2, [inf, 0.0, 0.0, 0.0])]
    short = [(905, 1, [0.3]), (906, 2, [])]
    df = spark.createDataFrame(given + odd + short + given[:120], SCHEMA).withColumns({"id": F.lit("x"), "b": F.lit(1), "score": F.lit(2)})
    expected = brute(given + [(i, lab, (v + [0.0] * 4)[:4]) for i, lab, v in short])
    assert rows(H.hard_negatives(df.repartition(7), F.col("id") % 100 == 0)) == sorted(expected, key=repr)


def test_one_vector_for_all_rows(spark, rows):
    """A group of copies: every score is the same, so only ids decide."""
    given = [(i, i % 2, [0.5] * 4) for i in range(2500)]
    df = spark.createDataFrame(given, SCHEMA).repartition(6)
    assert rows(H.hard_negatives(df, F.col("id") % 1000 == 0)) == sorted(brute(given, 1000), key=repr)


def test_scores_beyond_what_floating_point_holds(spark, rows):
    given = [(i, i % 2, [float(np.float32(1e6 + 7e4 * i)), 3.0 * i]) for i in range(30)]
    df = spark.createDataFrame(given, SCHEMA)
    assert rows(H.hard_negatives(df, F.col("id") % 10 == 0)) == sorted(brute(given, 10), key=repr)


def test_a_label_alone_and_no_rows(spark):
    one = spark.createDataFrame([(0, 1, [0.5]), (1, 1, [0.5])], SCHEMA)
    assert H.hard_negatives(one, F.col("id") % 100 == 0).count() == 0
    assert H.hard_negatives(one.where("false"), F.col("id") % 100 == 0).count() == 0


def test_pairs_sent_do_not_grow_with_the_rows_of_a_block(spark):
    """From a block goes what can count for an anchor, not each of its pairs."""
    df = spark.createDataFrame(tied_rows(5, 3950), SCHEMA).coalesce(1)
    blocks = H.usable(df, "vec_id", F.col("label"), "embedding").mapInArrow(H._pack, H.PACKED)
    anchors = H.usable(df, "vec_id", F.col("label"), "embedding").where("id % 100 = 0").mapInArrow(H._pack, H.PACKED)
    sides = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    assert H._met(blocks, sides).mapInArrow(H._scorer(True, 5), H.PAIRS).count() <= 5 * 40 * blocks.count()


def test_anchors_are_not_copied_to_the_driver(spark):
    """Blocks meet by a product of stored partitions: no copy of the anchors for each task, nothing broadcast."""
    given = H.usable(spark.createDataFrame(tied_rows(6, 2950), SCHEMA).repartition(3), "vec_id", F.col("label"), "embedding")
    blocks = H.store(given.mapInArrow(H._pack, H.PACKED), "blocks")
    anchors = H.store(given.where("id % 10 = 0").mapInArrow(H._pack, H.PACKED), "anchors")
    met = H._met(blocks, anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]))
    assert met.select("b", "a_b").distinct().count() == blocks.count() * anchors.count() == met.count() == 9
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan


@pytest.mark.parametrize("held", [1, 200])
def test_anchors_in_several_portions(spark, rows, monkeypatch, held):
    given = tied_rows(7, 500)
    monkeypatch.setattr(H, "BLOCK_ROWS", 97)
    monkeypatch.setattr(H, "HELD_BYTES", held)
    df = spark.createDataFrame(given, SCHEMA).repartition(5)
    assert rows(H.hard_negatives(df, F.col("id") % 10 == 0)) == sorted(brute(given, 10), key=repr)
