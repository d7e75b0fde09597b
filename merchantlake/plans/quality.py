"""Data-quality jobs on raw and Silver tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.functions import columns as X
from merchantlake.operators.joins import lookup_join
from merchantlake.operators.reuse import store
from merchantlake.sources import publish
from merchantlake.sources.tables import DataQualityError

KEY = "merchant_id"
# The columns that the two raw tables are documented to have.
TRANSACTION_DICTIONARY = ["merchant_id", "purchase_amount", "category", "purchase_date", "city_id", "state_id", "installments"]
MERCHANT_DICTIONARY = C.MERCHANTS.names


def _nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _rows_of(stats: DataFrame, rows: list[tuple[Column, ...]], names: list[str]) -> DataFrame:
    """Turn one row of aggregates into several rows."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return stats.select(F.inline(F.array(*structs)))


def null_ratios(df: DataFrame, columns: list[str] | None = None, limit: float = C.MAX_NULL_RATIO) -> DataFrame:
    """Share of nulls of each column in one pass; an empty table passes."""
    columns = columns or df.columns
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[_nulls(c).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = []
    for i, name in enumerate(columns):
        share = F.coalesce(X.ratio(F.col(f"n{i}"), F.col("n")), F.lit(0.0))
        rows.append((F.lit(name), F.col("n"), F.col(f"n{i}"), share, share <= limit))
    return _rows_of(stats, rows, ["column_name", "n_rows", "n_nulls", "null_ratio", "ok"])


def assert_null_ratio(df: DataFrame, columns: list[str], limit: float = C.MAX_NULL_RATIO, label: str = "") -> None:
    """Raise when a column has a larger share of nulls than ``limit``."""
    bad = null_ratios(df, columns, limit).where("not ok").collect()  # one row per column at most
    if bad:
        text = ", ".join(f"column {r.column_name} null ratio {r.null_ratio:.4f}" for r in bad)
        raise DataQualityError(f"{label}: {text} exceeds {limit}")


def profile_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of each column."""
    return df.select(*columns).describe()


def column_report(df: DataFrame, table: str, dictionary: list[str]) -> DataFrame:
    """Documented against actual columns, with the nulls of those that are there.

    A documented column that is missing is a warning; ``known_as`` tells the name
    Silver gives it. A column nobody documented is information.
    """
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[_nulls(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
    found = _rows_of(
        stats,
        [(F.lit(c), F.col("n"), F.col(f"n{i}")) for i, c in enumerate(df.columns)],
        ["column_name", "n_rows", "n_nulls"],
    )
    documented = df.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, dictionary))).alias("column_name"), F.lit(True).alias("documented")
    )
    status = (
        F.when(F.col("n_rows").isNull(), F.lit("missing"))
        .when(F.col("documented").isNull(), F.lit("extra"))
        .otherwise(F.lit("ok"))
    )
    known_as = F.coalesce(*[F.when(F.col("column_name") == old, F.lit(new)) for old, new in C.SYNONYMS.items()])
    return found.join(documented, "column_name", "full").select(
        F.lit(table).alias("table_name"),
        "column_name",
        status.alias("status"),
        F.when(status == "missing", F.lit("warn")).otherwise(F.lit("info")).alias("severity"),
        F.when(status == "missing", known_as).alias("known_as"),
        "n_rows",
        "n_nulls",
    )


def merchant_profile(merchants: DataFrame) -> DataFrame:
    """Rows, rows that repeat an id, and nulls of every column, as (metric, value)."""
    columns = merchants.columns
    per_id = merchants.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"), *[_nulls(c).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    stats = per_id.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") - 1).alias("repeats"),
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(columns))],
    )
    rows = [(F.lit("rows"), F.col("n")), (F.lit("repeated_id_rows"), F.col("repeats"))]
    rows += [(F.lit(f"nulls:{c}"), F.col(f"n{i}")) for i, c in enumerate(columns)]
    return _rows_of(stats, [(m, F.coalesce(v, F.lit(0))) for m, v in rows], ["metric", "value"])


@contextmanager
def _counts_from_footers(spark: SparkSession) -> Iterator[None]:
    """Within, Spark answers counts over Parquet from the files' own row counts (aggregate push-down)."""
    held = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def row_counts(spark: SparkSession, parts: dict[str, list[str]]) -> DataFrame:
    """(part, n_rows) of parts, each some Parquet files. To be run within ``_counts_from_footers``."""
    counts = [spark.read.parquet(*files).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit(part)) for part, files in parts.items()]
    return reduce(DataFrame.unionByName, counts).select("part", "n_rows")


def schema_drift(spark: SparkSession, path: str, by: str = "file", at_once: int = 50) -> DataFrame:
    """Per file (or ``by`` folder) of one table: rows, columns, and whether these differ from those of the first.

    No data is read: Spark infers each part's schema and counts its rows from footers alone. ``at_once`` parts are counted by one job.
    """
    parts: dict[str, list[str]] = {}
    for file in publish.Folders(spark).files(path):
        parts.setdefault(file.split("/")[{"file": -1, "folder": -2}[by]], []).append(file)
    schema = "part string, n_columns int, differs boolean"
    if not parts:
        return spark.createDataFrame([], "part string, n_rows bigint, n_columns int, differs boolean")
    columns = {part: sorted(spark.read.option("mergeSchema", len(files) > 1).parquet(*files).columns) for part, files in sorted(parts.items())}
    first = next(iter(columns.values()))
    found = spark.createDataFrame([(part, len(names), names != first) for part, names in columns.items()], schema)
    names = list(parts)
    with _counts_from_footers(spark):
        counts = [store(row_counts(spark, {n: parts[n] for n in names[k : k + at_once]}), "counts") for k in range(0, len(names), at_once)]
    return found.join(reduce(DataFrame.unionByName, counts), "part").select("part", "n_rows", "n_columns", "differs")


def orphan_merchants(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Ids that occur in transactions but not among the merchants. Null is not an id."""
    used = transactions.select(KEY).where(F.col(KEY).isNotNull()).distinct()
    return used.join(merchants.select(KEY).distinct(), KEY, "left_anti")


def orphan_summary(transactions: DataFrame, merchants: DataFrame, sample: int = 15) -> DataFrame:
    """How many orphan ids there are, and the first few. The ids are stored once for both."""
    orphans = store(orphan_merchants(transactions, merchants))
    few = orphans.orderBy(KEY).limit(sample).agg(F.array_join(F.sort_array(F.collect_list(KEY)), "|"))
    return orphans.agg(F.count(F.lit(1)).alias("n_orphans")).withColumn("sample", few.scalar())


def _per_id(merchants: DataFrame) -> DataFrame:
    """Per id: rows, different rows, and one flag per column that varies (null is a value).

    Copies are folded before rows of an id meet.
    """
    columns = [c for c in merchants.columns if c != KEY]

    def varies(i: int, c: str) -> Column:
        some_null = F.count(c) != F.count(F.lit(1))
        return ((F.min(c) != F.max(c)) | (some_null & (F.count(c) > 0))).alias(f"v{i}")

    folded = merchants.groupBy(KEY, *columns).agg(F.count(F.lit(1)).alias("_copies"))
    return folded.groupBy(KEY).agg(
        F.sum("_copies").alias("rows_for_id"),
        F.count(F.lit(1)).alias("unique_rows_for_id"),
        *[varies(i, c) for i, c in enumerate(columns)],
    )


def duplicate_groups(merchants: DataFrame) -> DataFrame:
    """Each id with several rows, and which columns differ between them."""
    columns = [c for c in merchants.columns if c != KEY]
    names = F.array_compact(F.array(*[F.when(F.col(f"v{i}"), F.lit(c)) for i, c in enumerate(columns)]))
    return (
        _per_id(merchants)
        .where(F.col(KEY).isNotNull() & (F.col("rows_for_id") > 1))
        .select(
            KEY,
            "rows_for_id",
            "unique_rows_for_id",
            F.size(names).alias("varying_columns_count"),
            F.array_join(names, "|").alias("varying_columns"),
        )
        .orderBy(
            F.col("unique_rows_for_id").desc(),
            F.col("varying_columns_count").desc(),
            F.col("rows_for_id").desc(),
            F.col(KEY).asc(),
        )
    )


def duplicate_metrics(merchants: DataFrame) -> DataFrame:
    """Totals over the merchants table. Rows without an id count as rows, not as an id."""
    columns = [c for c in merchants.columns if c != KEY]
    several, has_id = F.col("rows_for_id") > 1, F.col(KEY).isNotNull()
    repeated = several & has_id
    stats = _per_id(merchants).agg(
        F.sum("rows_for_id").alias("merchant_rows_total"),
        F.count_if(has_id).alias("merchant_id_distinct"),
        F.sum(F.when(several, F.col("rows_for_id"))).alias("duplicate_rows"),
        F.count_if(repeated).alias("duplicate_ids"),
        F.count_if(repeated & (F.col("unique_rows_for_id") > 1)).alias("groups_with_differences"),
        F.max(F.when(repeated, F.col("rows_for_id"))).alias("max_rows_same_id"),
        *[F.max(F.when(repeated & F.col(f"v{i}"), 1)).alias(f"v{i}") for i in range(len(columns))],
    )
    varying = sum((F.coalesce(f"v{i}", F.lit(0)) for i in range(len(columns))), F.lit(0))
    return stats.select(
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in (
                "merchant_rows_total",
                "merchant_id_distinct",
                "duplicate_rows",
                "duplicate_ids",
                "groups_with_differences",
                "max_rows_same_id",
            )
        ],
        varying.cast("int").alias("top_varying_columns_count"),
    )


def _repeated_ids(merchants: DataFrame) -> DataFrame:
    return (
        merchants.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("rows_for_id"))
        .where("rows_for_id > 1")
    )


def duplicate_rows(merchants: DataFrame) -> DataFrame:
    """The rows of all ids that occur more than once."""
    ids = _repeated_ids(merchants).select(KEY)
    return lookup_join(merchants, ids, KEY, "inner").select(*merchants.columns)


def duplicate_impact(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """How many transactions, and how much money, are on repeated ids, and how many
    rows a join without resolution would make of them. Null never matches an id."""
    amount = "amount" if "amount" in transactions.columns else "purchase_amount"
    per_id = transactions.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"), X.exact_sum(F.coalesce(amount, F.lit(0.0))).alias("total")
    )
    hit = F.col("rows_for_id").isNotNull()
    zero = F.lit(0).cast(C.TOTALS)
    stats = per_id.join(_repeated_ids(merchants), KEY, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_hit"),
        F.coalesce(X.sum_of_totals(F.col("total")), zero).cast("double").alias("total"),
        F.coalesce(X.sum_of_totals(F.when(hit, F.col("total"))), zero).cast("double").alias("total_hit"),
        F.coalesce(F.sum(F.col("n") * F.col("rows_for_id")), F.lit(0)).alias("joined"),
    )
    return stats.select(
        F.col("n").alias("tx_rows_total"),
        F.col("n_hit").alias("tx_rows_with_duplicate_merchant_id"),
        F.coalesce(X.ratio(F.col("n_hit"), F.col("n")), F.lit(0.0)).alias("tx_rows_impact_ratio"),
        F.col("total").alias("tx_amount_total"),
        F.col("total_hit").alias("tx_amount_with_duplicate_merchant_id"),
        F.coalesce(X.ratio(F.col("total_hit"), F.col("total")), F.lit(0.0)).alias("tx_amount_impact_ratio"),
        F.col("joined").alias("possible_join_multiplication_rows"),
    )


def silver_anomalies(silver: DataFrame) -> DataFrame:
    """Counts of rows without an id, a name or a category."""
    has_id = F.col(KEY).isNotNull()
    category = F.col("category")
    return silver.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~has_id).alias("null_merchant_id"),
        F.count_if(has_id & F.col("merchant_name").isNull()).alias("null_name_with_id"),
        F.count_if(has_id & (F.col("merchant_name") == "")).alias("empty_name_with_id"),
        F.count_if(category.isNull()).alias("null_category"),
        F.count_if(category == "").alias("empty_category"),
        F.count_if(category == C.UNKNOWN_CATEGORY).alias("unknown_category"),
    )
