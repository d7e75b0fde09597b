"""Rows per key: the best n, and a complete numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantlake.operators.reuse import store


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "_rank") -> DataFrame:
    """The first ``n`` rows of every key, numbered from 1 in ``rank``.

    ``row_number() <= n`` plans as a partial limit before the shuffle, so a key
    that holds a third of all rows sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def number_rows(df: DataFrame, key: str, order: list[Column], rank: str) -> DataFrame:
    """Number all rows of every key, for keys too large to be sorted in one task.

    ``order`` has to decide between any two different rows. Equal rows are first
    folded into one row with a count, so copies cannot pile up. The distinct rows
    are range-partitioned by (key, order): each task numbers its slice, and a slice
    starts where the slices before it end. The placement comes from sampling, so it
    is stored before it is used twice.
    """
    columns = df.columns
    # Grouping would make 0.0 of -0.0; as text, numbers keep their sign and come back as they were.
    kinds = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    as_text = df.withColumns({c: F.col(c).cast("string") for c in kinds})
    folded = as_text.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    folded = folded.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store(
        folded.repartitionByRange(parts, F.col(key), *order).withColumn("_slice", F.spark_partition_id())
    )

    inside = Window.partitionBy(key, "_slice").orderBy(*order)
    upto_here = F.sum("_copies").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(key, "_slice")
        .agg(F.sum("_copies").alias("_in_slice"))
        .withColumn("_before", F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)))
        .drop("_in_slice")
    )
    numbered = placed.withColumn("_upto", upto_here).join(starts, [key, "_slice"])

    # Copies get consecutive numbers. Long runs are cut into chunks and spread first.
    chunk = 10_000
    last = F.col("_before") + F.col("_upto")
    first = last - F.col("_copies") + 1
    chunks = numbered.select(
        *columns, last.alias("_last"), F.explode(F.sequence(first, last, F.lit(chunk))).alias("_from")
    )
    upto = F.least(F.col("_from") + (chunk - 1), F.col("_last"))
    return (
        chunks.repartition(parts, key, "_from")
        .select(*columns, F.explode(F.sequence("_from", upto)).alias(rank))
        .withColumn(rank, F.col(rank).cast("int"))
    )
