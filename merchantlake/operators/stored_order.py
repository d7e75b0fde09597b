"""Is a table stored in non-increasing order of a column?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def with_file_position(stored: DataFrame) -> DataFrame:
    """Position of a row of a Parquet table: its file, by the number in its name, and its index in the file."""
    path = F.col("_metadata.file_path")
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("bigint")
    return stored.withColumns({"_part": F.struct(number.alias("number"), path.alias("path")), "_row": F.col("_metadata.row_index")})


def with_output_position(df: DataFrame) -> DataFrame:
    """Position of a row in the output of a sorted frame: partition, then row."""
    position = F.monotonically_increasing_id()
    return df.withColumn("_position", position).withColumns(
        {"_part": F.shiftright("_position", 33), "_row": F.col("_position").bitwiseAND((1 << 33) - 1)}
    ).drop("_position")


def order_breaks(positioned: DataFrame, value: str) -> DataFrame:
    """One row: the number of rows, and of ``breaks``, rows larger than the one stored before.

    Neighbours are compared in blocks of rows, then block ends within a part, then
    part ends, so no task holds more than a block, a part's blocks or the parts.
    Nulls belong at the end.
    """
    rows = positioned.select("_part", "_row", F.struct(F.col(value).alias("v")).alias("item")).withColumn(
        "_block", F.floor(F.col("_row") / BLOCK_ROWS)
    )
    blocks = _fold(rows, ["_part", "_block"], "_row", F.col("item"), F.col("item"), F.lit(0), F.lit(1))
    parts = _fold(blocks, ["_part"], "_block", F.col("head"), F.col("tail"), F.col("breaks"), F.col("n_rows"))
    return _fold(parts, [], "_part", F.col("head"), F.col("tail"), F.col("breaks"), F.col("n_rows")).select(
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_rows", "breaks")]
    )


def _fold(df: DataFrame, keys: list[str], order: str, head: Column, tail: Column, known: Column, n: Column) -> DataFrame:
    w = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(order)
    before, here = F.col("_before.v"), F.col("_head.v")
    grows = F.col("_before").isNotNull() & here.isNotNull() & (before.isNull() | (here > before))
    return (
        df.withColumns({"_head": head, "_tail": tail, "_known": known, "_n": n, "_before": F.lag(tail).over(w)})
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("n_rows"),
            (F.sum("_known") + F.count_if(grows)).alias("breaks"),
            F.min_by("_head", order).alias("head"),
            F.max_by("_tail", order).alias("tail"),
        )
    )
