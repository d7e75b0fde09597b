"""Equi-joins of facts against a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``key``), ``how`` being inner or left.

    One plan for all sizes: each side is read once and no side is measured beforehand. Spark broadcasts
    ``right`` when its size, from statistics or from the shuffle itself, is below the session's threshold.
    Otherwise it splits partitions in which a hot key has gathered (adaptive skew join): exact copies of a row
    need no position or salt for that, as the split follows the files of the map tasks. Rows without a
    key match nothing; in a left join they are one more hot key.
    """
    return left.join(right, key, how)
