"""Association of two categorical columns from their contingency cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cramers_v(cells: DataFrame, row: str, column: str, n: str, min_row_total: int = 0) -> DataFrame:
    """One row with Cramér's V as ``v`` and the table's ``n_rows`` and ``n_columns``.

    ``cells`` holds each non-empty (row, column) once. Rows with fewer than
    ``min_row_total`` observations are left out before the column totals are taken.
    Chi-square needs only the non-empty cells: phi2 = sum(o^2 / (r * c)) - 1, so the
    dense matrix is never built. V is NaN when either side has fewer than two values.
    """
    row_totals = cells.groupBy(F.col(row).alias("_row")).agg(F.sum(n).alias("_row_total")).where(F.col("_row_total") >= min_row_total)
    kept = cells.join(row_totals, F.col(row).eqNullSafe(F.col("_row")))
    column_totals = kept.groupBy(F.col(column).alias("_column")).agg(F.sum(n).alias("_column_total"))
    totals = kept.join(column_totals, F.col(column).eqNullSafe(F.col("_column")))
    share = (F.col(n) / F.col("_row_total")) * (F.col(n) / F.col("_column_total"))
    stats = totals.agg((F.sum(share) - 1).alias("_phi2")).select(
        "_phi2",
        row_totals.agg(F.count("_row")).scalar().alias("n_rows"),
        column_totals.agg(F.count("_column")).scalar().alias("n_columns"),
    )
    return stats.select(_v().alias("v"), "n_rows", "n_columns")


def _v() -> Column:
    smaller = F.least(F.col("n_rows") - 1, F.col("n_columns") - 1)
    return F.when(smaller < 1, F.lit(float("nan"))).otherwise(
        F.sqrt(F.greatest(F.col("_phi2"), F.lit(0.0)) / F.nullif(smaller, F.lit(0)))
    )
