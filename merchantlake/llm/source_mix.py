"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a hash. A source's target holds a whole number of passes over the source and a rest; the rest is
met by the documents whose hash lies below a threshold. The threshold is found from sums of sizes by (source, hash
bucket): the bucket in which the budget ends is the only one that is split again. Documents are filtered by the
threshold and never sorted, and the same hash gives nested selections for growing budgets.

Defined results: a null text has size zero, a null source is a source of its own (the last). Documents whose id and text
are equal share a hash and are taken together. A source without words gets target zero. Hashes that tie are taken or left together. An empty table gives an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantlake.llm.common import packed, store, text_of, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
LEVEL_BITS = 12
LEVELS = 4


def document_hash(doc_id: Column, text: Column) -> Column:
    """48 bits that two different SQL engines compute alike."""
    key = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text_of(text)).cast("binary"))
    return F.conv(F.substring(key, 1, LEVEL_BITS * LEVELS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target of each source, from ``sizes`` (source, size): weights share the total, no target exceeds its cap.

    Sources are ranked by cap / weight. Those whose cap is reached first are a prefix of that order, so the level at
    which the others share the remainder follows from running sums over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = totals.select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double").alias("weight"),
        (F.lit(float(max_epochs)) * F.col("source_size")).alias("cap"),
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(rest)
    leveled = ranked.withColumn("level", level)
    # From the first source whose cap is not reached on, all share that level.
    reached = F.col("cap") / F.col("weight") <= F.col("level")
    shared = F.max(F.when(~reached, F.col("level"))).over(Window.partitionBy())
    target = F.when(F.coalesce(F.col("weight") * shared < F.col("cap"), F.lit(False)), F.col("weight") * shared)
    return leveled.select("source", "source_size", F.coalesce(target, F.col("cap")).alias("target"))


def _bucket(level: int) -> Column:
    """The hash down to ``level``."""
    return F.shiftright("hash", LEVEL_BITS * (LEVELS - level))


def find_thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cut): documents with ``hash`` below ``cut`` have about ``budget`` words.

    ``rows`` has source, hash, size. Each level sums only what falls in the bucket that its predecessor left open.
    """
    open_part = budgets.select("source", F.col("budget").alias("left"), F.lit(0).cast("bigint").alias("inside"))
    for level in range(1, LEVELS + 1):
        same = F.col("r.source").eqNullSafe(F.col("o.source"))
        within = same if level == 1 else same & (_bucket(level - 1) == F.col("o.inside"))
        histogram = (
            rows.alias("r")
            .join(open_part.alias("o"), within)
            .groupBy(F.col("r.source").alias("source"), _bucket(level).alias("bucket"))
            .agg(F.sum("r.size").alias("size"), F.first("o.left").alias("left"))
        )
        upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        # The budget ends in the first bucket whose running sum reaches it.
        reaching = histogram.withColumn("upto", upto).where(F.col("upto") >= F.col("left"))
        first = F.min(F.struct("bucket", "size", "upto", "left"))
        ends = reaching.groupBy("source").agg(first.alias("b"))
        open_part = store(
            ends.select(
                "source", (F.col("b.left") - F.col("b.upto") + F.col("b.size")).alias("left"),
                F.col("b.bucket").alias("inside"), F.col("b.size").alias("size"),
            ),
            "mix-level",
        )
    # The last bucket holds documents of one hash: in when that brings the sum nearer to the budget.
    takes_last = F.col("left") * 2 > F.col("size")
    return open_part.select("source", (F.col("inside") + F.when(takes_last, 1).otherwise(0)).alias("cut"))


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, carry: bool = True,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken; the whole input row as ``document`` if it is carried."""
    sized = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.size(words(F.col(f"`{text}`"))).cast("bigint").alias("size"),
        document_hash(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("hash"),
        *([packed(docs)] if carry else []),
    )
    rows = store(sized.drop("document"), "mix-sizes")
    targets = store(source_targets(rows.select("source", "size"), weights, max_epochs), "mix-targets")
    passes = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("bigint")
    plan = targets.withColumn("passes", passes).withColumn(
        "budget", F.col("target") - F.col("passes") * F.col("source_size")
    )
    cuts = find_thresholds(rows.select("source", "hash", "size"), plan.where("budget > 0").select("source", "budget"))
    plan = plan.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    plan = store(plan.select("p.source", "source_size", "target", "passes", "cut"), "mix-plan")
    times = F.col("passes") + F.when(F.col("hash") < F.col("cut"), 1).otherwise(0)
    return (
        (sized if carry else rows).alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")), "left")
        .select("r.doc_id", "r.source", "size", "source_size", "target", (F.col("size") * times).alias("taken"),
                *(["document"] if carry else []))
    )
