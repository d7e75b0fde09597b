"""Silver: one merchant per id, and transactions with a name and a category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.functions import columns as X
from merchantlake.operators.joins import lookup_join
from merchantlake.operators.rank import number_rows, top_n

KEY = "merchant_id"


def resolution_order(merchants: DataFrame) -> list[Column]:
    """Best row first. A range the table does not have is skipped; the remaining
    columns only decide between rows that agree on all criteria."""
    ranges = [c for c in ("most_recent_sales_range", "most_recent_purchases_range") if c in merchants.columns]
    activity = ["active_months_lag12", "active_months_lag6", "active_months_lag3", "avg_purchases_lag12"]
    used = {KEY, "merchant_name", *activity}
    rest = [c for c in merchants.columns if c not in used]
    return [
        *[X.letter_rank(F.col(c)).asc_nulls_last() for c in ranges],
        *[F.col(c).desc_nulls_last() for c in activity],
        F.col("merchant_name").asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in rest],
    ]


def resolve_merchants(merchants: DataFrame) -> DataFrame:
    """One golden row per ``merchant_id``; rows without an id form one group."""
    return top_n(merchants, [KEY], resolution_order(merchants), 1).drop("_rank")


def audit_duplicates(merchants: DataFrame) -> DataFrame:
    """Every row of the ids that occur more than once, ranked; rows without an id are left out.

    Rows are numbered slice by slice, so no task has to hold all rows of an id.
    """
    with_id = merchants.where(F.col(KEY).isNotNull())
    order, rank = resolution_order(merchants), "resolution_rank"
    several = with_id.groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    ranked = number_rows(with_id.join(several, KEY, "left_semi").select(*merchants.columns), KEY, order, rank)
    return ranked.withColumn("is_resolved_winner", F.col(rank) == 1)


def conform(transactions: DataFrame) -> DataFrame:
    """Give known synonyms their contract name; a canonical column that is there wins."""
    present = set(transactions.columns)
    return transactions.withColumnsRenamed(
        {old: new for old, new in C.SYNONYMS.items() if old in present and new not in present}
    )


def reading_order() -> tuple[Column, Column]:
    """What readers of Silver filter by: month, then city."""
    return F.date_trunc("month", "purchase_ts"), F.col("city_id")


def of_months(transactions: DataFrame, months: list[str]) -> DataFrame:
    """Transactions of some months (``yyyy-MM``), as ranges of the purchase time that reach the scan."""
    ts = next(c for c in ("purchase_ts", "purchase_date") if c in transactions.columns)
    first = [F.to_date(F.lit(f"{m}-01")) for m in months]
    inside = [(F.col(ts) >= d) & (F.col(ts) < F.add_months(d, 1)) for d in first]
    return transactions.where(reduce(lambda a, b: a | b, inside))


def with_category(transactions: DataFrame) -> DataFrame:
    """Transactions under their contract names, with a category that is never null."""
    return conform(transactions).withColumn("category", F.coalesce("category", F.lit(C.UNKNOWN_CATEGORY)))


def with_names(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rows with the ``merchant_name`` of their id, or the id when that is unknown: it depends on the id alone."""
    names = resolved.where(F.col(KEY).isNotNull()).select(KEY, F.col("merchant_name").alias("_name"))
    joined = lookup_join(rows, names, KEY, "left")
    columns = [c for c in joined.columns if c not in (KEY, "_name", "merchant_name")]
    return joined.select(KEY, *columns, F.coalesce("_name", KEY).alias("merchant_name"))


def enrich(transactions: DataFrame, resolved: DataFrame) -> DataFrame:
    """Transactions with ``merchant_name`` (the id when unknown) and a category that is never null.

    Spark sends the names to every task when its own size check allows it. Otherwise both
    sides are shuffled once, and partitions that a hot id or missing ids make large are split
    at run time (:mod:`merchantlake.operators.joins`).
    """
    return with_names(with_category(transactions), resolved)
