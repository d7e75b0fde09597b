"""Where the raw transactions are."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# The layouts a download can have below the data folder.
FOLDER = "raw/historical_transactions"
SINGLE_FILE = "raw/historical_transactions.parquet"
LOOSE_PARTS = "raw/part-*.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask Spark's own file systems, so the answer holds for executors and for globs."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _join(root: str, tail: str) -> str:
    return f"{root.rstrip('/')}/{tail}"


def resolve_transactions(spark: SparkSession, data_root: str, path: str | None = None) -> str:
    """The path to read. Other layouts are tried only when no ``path`` was asked for."""
    candidates = [path] if path else [_join(data_root, p) for p in (FOLDER, SINGLE_FILE, LOOSE_PARTS)]
    for candidate in candidates:
        if path_exists(spark, candidate):
            return candidate
    raise FileNotFoundError(f"no transactions at any of {candidates}")


def discover_transactions(spark: SparkSession, data_root: str) -> list[str]:
    """Every location that holds transactions, each once (the checks read all of them).

    The folder is one location, as for :func:`resolve_transactions`, whether its files lie in it or in sub-folders.
    """
    candidates = [_join(data_root, p) for p in (FOLDER, SINGLE_FILE, LOOSE_PARTS)]
    return [p for p in candidates if path_exists(spark, p)]
