"""Ranks and running sums over sections too large for one task.

Rows that agree in the order, peers, are folded to one row with a count and sums, so that no value can be heavy. The different
values are range-partitioned in order: each task adds up its slice, and a slice starts from what the slices before it
hold. That second level has a row for each slice and key, whatever the table's size. Every window below is over one slice,
or over the list of slices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantlake.operators.reuse import store

PEERS, BEFORE, WHOLE = "_peers", "_before", "_whole"


def sort_column(name: str) -> Column:
    """A column name, with ``-`` before it for falling order. Nulls are least, as in Spark."""
    return F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_first()


def looked_up(rows: DataFrame, found: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``found``, whose rows are told apart by ``columns``, of which null is a value."""
    other = found.withColumnsRenamed({c: f"_found_{c}" for c in columns})
    agree = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_found_{c}")) for c in columns])
    return rows.join(other, agree, how).drop(*[f"_found_{c}" for c in columns])


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column] | None = None) -> DataFrame:
    """One row for each key and peer group of ``df``.

    ``_peers`` rows are in the group, ``_before`` rows of the key before it, ``_whole`` in all; each of ``sums`` is
    added up to the end of the group, and ``whole_<name>`` over the key. Without keys the table is one section.
    """
    names = [o.removeprefix("-") for o in order]
    sorts = [sort_column(o) for o in order]
    sums = {PEERS: F.count(F.lit(1)), **{name: F.sum(c) for name, c in (sums or {}).items()}}
    key = keys or ["_all"]
    folded = (df if keys else df.withColumn("_all", F.lit(0))).groupBy(*key, *names).agg(*[c.alias(name) for name, c in sums.items()])
    placed = store(folded.repartitionByRange(*key, *sorts).withColumn("_slice", F.spark_partition_id()), "slices")

    upto_here = Window.partitionBy(*key, "_slice").orderBy(*sorts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumns({f"_in_{name}": F.sum(name).over(upto_here) for name in sums})
    earlier = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy(*key, "_slice").agg(*[F.sum(name).alias(name) for name in sums])
    starts = slices.select(
        *key,
        "_slice",
        *[F.sum(name).over(earlier).alias(f"_start_{name}") for name in sums],
        *[F.sum(name).over(Window.partitionBy(*key)).alias(f"_whole_{name}") for name in sums],
    )
    both = looked_up(inside, starts, [*key, "_slice"])

    def upto(name: str) -> Column:
        """Nulls add nothing, and stay null where nothing was added yet."""
        here, start = F.col(f"_in_{name}"), F.col(f"_start_{name}")
        return F.coalesce(here + start, here, start)

    return both.select(
        *keys,
        *names,
        PEERS,
        (upto(PEERS) - F.col(PEERS)).alias(BEFORE),
        F.col(f"_whole_{PEERS}").alias(WHOLE),
        *[x for name in list(sums)[1:] for x in (upto(name).alias(name), F.col(f"_whole_{name}").alias(f"whole_{name}"))],
    )


def percent_rank() -> Column:
    """Of a scanned row: the share of the others that come before it."""
    return F.when(F.col(WHOLE) > 1, F.col(BEFORE).cast("double") / (F.col(WHOLE) - 1).cast("double")).otherwise(F.lit(0.0))


def ntile(n: int) -> Column:
    """Of a scanned row without peers: its part of ``n`` parts, of which the first are one longer if they cannot be equal."""
    short = F.floor(F.col(WHOLE) / n)
    longer = F.col(WHOLE) - short * n
    border = longer * (short + 1)
    in_longer = F.floor(F.col(BEFORE) / (short + 1))
    in_short = longer + F.floor((F.col(BEFORE) - border) / F.greatest(short, F.lit(1)))
    return (F.when(F.col(BEFORE) < border, in_longer).otherwise(in_short) + 1).cast("int")
