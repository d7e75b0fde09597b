"""Small helpers that several operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake.operators.reuse import new_path, store

# The white space that separates words.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDS = 5

# The other modules take these from here.
__all__ = ["new_path", "store"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs without white space; null has none."""
    return F.array_remove(F.split(text_of(text), WHITE_SPACE), "")


def held_out(doc_id: Column) -> Column:
    """Every fifth id by checksum, and null ids: a model never learns from these rows."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def with_text_id(given: DataFrame) -> DataFrame:
    """(doc_id, held_out, text) for pandas, which would turn integer ids beside nulls into floats: ids as text."""
    return given.select(F.col("doc_id").cast("string").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")


def packed(docs: DataFrame, name: str = "document") -> Column:
    """The whole input row as one struct, so that its names cannot clash with an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def joined_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (one more entry for the end)."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), starts


def batches_of_bytes(texts: list[str | None], limit: int):
    """Index ranges of ``texts`` that hold about ``limit`` characters; one long text is a range of its own."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += 0 if t is None else len(t)
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.clip(x, -60.0, 60.0)))

