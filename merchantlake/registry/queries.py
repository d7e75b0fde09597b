"""Every query by name, on the input tables of a scale folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.functions import columns as X
from merchantlake.operators.reuse import new_path, store
from merchantlake.plans import advisor, cities, gold_checks, merchant_sets, quality, questions, reports, silver
from merchantlake.sources import paths, standin, tables

Query = Callable[[SparkSession, str], DataFrame]
INGESTED_AT = "2024-01-01T00:00:00+00:00"


def _tx(spark: SparkSession, d: str) -> DataFrame:
    return standin.transactions(spark, d)


def _merchants(spark: SparkSession, d: str) -> DataFrame:
    return standin.merchants(spark, d)


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return silver.enrich(_tx(spark, d), silver.resolve_merchants(_merchants(spark, d)))


def _on_silver(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: plan(_silver(spark, d))


def _cells(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    """Transactions per cell, counted before their merchants get names: a name depends on the id alone.

    Rows of a cell are combined before they are shuffled, and names join cells in as many tasks as the session has shuffle
    partitions, however well cells compress: Spark would gather them by their compressed size.
    """
    cells = cities.count_cells(silver.with_category(_tx(spark, d)), *[k for k in keys if k != "merchant_name"])
    if "merchant_name" not in keys:
        return cells
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return silver.with_names(cells.repartition(parts, silver.KEY), silver.resolve_merchants(_merchants(spark, d)))


def _on_cells(plan: Callable[[DataFrame], DataFrame], *keys: str) -> Query:
    return lambda spark, d: plan(_cells(spark, d, *keys))


def _on_stored_cells(plan: Callable[[DataFrame], DataFrame], *keys: str) -> Query:
    """For plans that roll their cells up more than once."""
    return lambda spark, d: plan(store(_cells(spark, d, *keys), "cells"))


def _on_advisory(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: plan(advisor.advisory_summary(advisor.advisory_cells(_silver(spark, d))))


def _section(name: str) -> Query:
    return _on_advisory(lambda a: reports.section(a, name))


def _both(plan: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, d: plan(_tx(spark, d), _merchants(spark, d))


MERCHANT_CELL = cities.MERCHANT_CELL


def bronze_transactions(spark: SparkSession, d: str) -> DataFrame:
    return tables.with_lineage(_tx(spark, d), "transactions", INGESTED_AT)


def bronze_merchants(spark: SparkSession, d: str) -> DataFrame:
    """The merchants as a CSV file would bring them."""
    path = new_path(spark, "merchants-csv")
    tables.write_report(_merchants(spark, d), path, "csv")
    return tables.with_lineage(tables.read_merchants(spark, path), "merchants", INGESTED_AT)


def stored_layers_q1(spark: SparkSession, d: str) -> DataFrame:
    """Bronze to Silver to Gold through stored tables, as a run does it."""
    root = new_path(spark, "layers")
    tables.write_table(bronze_transactions(spark, d), f"{root}/bronze/transactions")
    tables.write_table(tables.with_lineage(_merchants(spark, d), "merchants", INGESTED_AT), f"{root}/bronze/merchants")
    transactions = tables.read_table(spark, f"{root}/bronze/transactions")
    resolved = silver.resolve_merchants(tables.read_table(spark, f"{root}/bronze/merchants"))
    enriched = silver.enrich(transactions, resolved)
    tables.write_table(enriched, f"{root}/silver/enriched_transactions")
    stored = C.assert_contract(tables.read_table(spark, f"{root}/silver/enriched_transactions"), C.SILVER, "silver")
    tables.write_table(questions.top_merchants(stored), f"{root}/gold/q1_results")
    return tables.read_table(spark, f"{root}/gold/q1_results")


def bronze_locations(spark: SparkSession, d: str) -> DataFrame:
    """Transactions that lie in three layouts below one folder: all are discovered, and each is read once."""
    root = new_path(spark, "download")
    tx, state = _tx(spark, d), F.col("state_id")
    tx.where(state < 8).write.partitionBy("installments").parquet(f"{root}/{paths.FOLDER}")
    tx.where((state >= 8) & (state < 16)).write.parquet(f"{root}/{paths.SINGLE_FILE}")
    tx.where(state >= 16).write.parquet(f"{root}/raw/part-2.parquet")
    found = paths.discover_transactions(spark, root)
    layout = {f"{root}/{p}": name for p, name in ((paths.FOLDER, "folder"), (paths.SINGLE_FILE, "file"), (paths.LOOSE_PARTS, "parts"))}
    first = paths.resolve_transactions(spark, root)
    rows = tables.read_transactions(spark, *[p for p in found]).groupBy("installments").agg(
        F.count(F.lit(1)).alias("n_rows"), X.money_sum(F.col("purchase_amount")).alias("total_amount")
    )
    return rows.withColumns({"layouts": F.lit("|".join(layout[p] for p in found)), "resolved": F.lit(layout[first])})


MONTH_FOLDERS = ("purchase_year", "purchase_month")


def silver_month_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Silver by month after the first month was rebuilt from corrected transactions, each dearer by one."""
    path = f"{new_path(spark, 'monthly')}/enriched_transactions"
    year, month = MONTH_FOLDERS
    source = _silver(spark, d).withColumns({year: F.year("purchase_ts"), month: F.month("purchase_ts")})
    tables.write_table(source, path, partition_by=MONTH_FOLDERS, cluster_by=(*MONTH_FOLDERS, "city_id"))
    stored = tables.read_table(spark, path)
    first = stored.agg(F.date_format(F.min("purchase_ts"), "yyyy-MM").alias("m")).first().m
    corrected = silver.of_months(source, [first]).withColumn("amount", X.dearer(F.col("amount"), 1))
    only = [dict(zip(MONTH_FOLDERS, map(int, first.split("-"))))]
    tables.write_partitions(corrected, path, MONTH_FOLDERS, only=only, cluster_by=("city_id",), gate=tables.Gate(C.GATED))
    return (
        tables.read_table(spark, path)
        .groupBy(*MONTH_FOLDERS)
        .agg(F.count(F.lit(1)).alias("transaction_count"), X.money_sum(F.col("amount")).alias("total_amount"))
    )


def silver_city_month(spark: SparkSession, d: str) -> DataFrame:
    """Transactions of one city and month, from Silver stored in the order of its readers."""
    path = f"{new_path(spark, 'ordered')}/enriched_transactions"
    tables.write_table(_silver(spark, d), path, cluster_by=silver.reading_order())
    return silver.of_months(tables.read_table(spark, path), ["1996-07"]).where("city_id = 14")


def dq_gate(spark: SparkSession, d: str) -> DataFrame:
    """Shares of nulls that the gate of Silver counted while the table was written."""
    gate = tables.Gate((*C.GATED, "city_id", "installments"), limit=1.0)
    tables.write_table(_silver(spark, d), f"{new_path(spark, 'gated')}/enriched_transactions", gate=gate)
    return spark.createDataFrame([(c, r, r <= C.MAX_NULL_RATIO) for c, r in gate.ratios().items()], "column_name string, null_ratio double, ok boolean")


def dq_csv_misfits(spark: SparkSession, d: str) -> DataFrame:
    """Findings about a CSV file of merchants some of whose numbers are none."""
    path = new_path(spark, "odd-csv")
    months, size = F.col("active_months_lag12"), F.col("active_months_lag6")
    odd = _merchants(spark, d).withColumns({
        "active_months_lag12": F.when(months == 5, F.lit("n/a")).otherwise(months.cast("string")),
        "active_months_lag6": F.when(size == 2, F.lit("2.5")).otherwise(size.cast("string")),
    })
    tables.write_report(odd, path, "csv")
    return tables.read_csv(spark, path, C.MERCHANTS)[1]


def dq_gold_path(spark: SparkSession, d: str) -> DataFrame:
    """What the check of a Gold folder says where two tables are missing and one lacks a column, and whether a strict run fails."""
    root = new_path(spark, "gold")
    frames = gold_frames(spark, d)
    for key in ("q1", "q3", "q4"):
        frame = frames[key].drop("Hour") if key == "q3" else frames[key]
        tables.write_table(frame, f"{root}/{C.GOLD_TABLES[key]}")
    findings = gold_checks.check_gold_path(spark, root)
    strict = F.lit(gold_checks.has_errors(findings))
    return findings.where("not ok").select("question", "code", "severity", strict.alias("strict_fails"))


def _merchant_sets(spark: SparkSession, d: str) -> DataFrame:
    source = _silver(spark, d)
    return store(merchant_sets.monthly_sets(source, merchant_sets.merchant_numbers(source)), "sets")


def q4_merchants_by_month(spark: SparkSession, d: str) -> DataFrame:
    month = X.month_label(F.col("year"), F.col("month")).alias("month")
    return merchant_sets.distinct_merchants(_merchant_sets(spark, d), month, F.col("city_id"))


def q4_merchants_by_period(spark: SparkSession, d: str) -> DataFrame:
    """Merchants of each quarter in all cities, and of each city over all time, from the same monthly cells."""
    sets = _merchant_sets(spark, d)
    quarters = merchant_sets.distinct_merchants(sets, merchant_sets.quarter()).withColumn("city_id", F.lit(None).cast("int"))
    of_cities = merchant_sets.distinct_merchants(sets, F.col("city_id")).withColumn("quarter", F.lit("all"))
    return quarters.unionByName(of_cities).select("quarter", "city_id", "distinct_merchants")


def q5_transactions_ev(spark: SparkSession, d: str) -> DataFrame:
    rows = advisor.expected_values(_silver(spark, d))
    return rows.withColumn("assumptions", F.array_join("assumptions", "; "))


def q4_association(spark: SparkSession, d: str) -> DataFrame:
    """Rounded, as the last digit of a sum of doubles depends on the order of the cells."""
    cells = store(cities.count_cells(_silver(spark, d), "city_id", "category"), "cells")
    rows = cities.city_category_association(cells)
    return rows.withColumn("city_category_cramers_v", F.round("city_category_cramers_v", 10))


def monthly_volume(spark: SparkSession, d: str) -> DataFrame:
    """Transactions and money by first day of the month."""
    month = X.month_start(F.col("purchase_ts")).cast("date")
    return (
        _silver(spark, d)
        .groupBy(month.alias("month_start"))
        .agg(F.count(F.lit(1)).alias("transaction_count"), X.money_sum(F.col("amount")).alias("total_amount"))
    )


def gold_frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All Gold tables, from Silver and cells that are stored once.

    No result needs merchants and categories in one cell: apart they are fewer cells than together.
    """
    source = store(_silver(spark, d), "silver")
    cells = store(cities.count_cells(source, *cities.MERCHANT_CELL))
    categories = store(cities.count_cells(source, *cities.CATEGORY_CELL))
    top = cities.top_merchants_global(cells)
    return {
        "q1": questions.top_merchants(source),
        "q2": questions.average_by_state(source),
        "q3": questions.peak_hours(source),
        "q4": cities.city_metrics(cells, categories),
        "q4_association": cities.city_category_association(categories),
        "q4_top_merchants": top,
        "q4_distribution": cities.top_merchants_distribution(top),
        "q4_popularity": cities.merchant_popularity(cells),
        "q5": advisor.expected_values(source),
        "q5_advisory": advisor.advisory_summary(advisor.advisory_cells(source)),
    }


def dq_gold_findings(spark: SparkSession, d: str) -> DataFrame:
    """Three checks read the top merchants: they are stored first, as Gold is, and their distribution is made of the stored rows."""
    frames = gold_frames(spark, d)
    top = store(frames["q4_top_merchants"])
    return gold_checks.check_gold(spark, {**frames, "q4_top_merchants": top, "q4_distribution": cities.top_merchants_distribution(top)})


def dq_profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    """The profile with numbers instead of text, rounded to digits that do not depend on order."""
    columns = ["amount", "installments", "city_id"]
    profile = quality.profile_numeric(_silver(spark, d), columns)
    return profile.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in columns])


def dq_column_contract(spark: SparkSession, d: str) -> DataFrame:
    return quality.column_report(_silver(spark, d), "enriched_transactions", quality.TRANSACTION_DICTIONARY)


def dq_column_contract_merchants(spark: SparkSession, d: str) -> DataFrame:
    return quality.column_report(_merchants(spark, d), "merchants", quality.MERCHANT_DICTIONARY)


def dq_schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of the transactions, the second without installments."""
    root = new_path(spark, "loads")
    tx = _tx(spark, d)
    tx.where("state_id <= 12").write.parquet(f"{root}/load=0")
    tx.where("state_id > 12").drop("installments").write.parquet(f"{root}/load=1")
    return quality.schema_drift(spark, root, by="folder")


def _rounded(query: Query, *columns: str) -> Query:
    """Means of doubles depend on the order of addition beyond these digits."""
    return lambda spark, d: query(spark, d).withColumns({c: F.round(c, 4) for c in columns})


def _report(source: Query, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: plan(source(spark, d))


# Reports sort for themselves, so their sources are left unsorted.
_q1 = _on_silver(lambda s: questions.top_merchants(s, ordered=False))
_q2 = _on_silver(lambda s: questions.average_by_state(s, ordered=False))


def _stored_report(source: Query, plan: Callable[[DataFrame], DataFrame]) -> Query:
    """For reports that read their Gold table more than once: it is stored first, as Gold is."""
    return lambda spark, d: plan(store(source(spark, d)))


_q3 = _on_silver(questions.peak_hours)
_q4 = _on_stored_cells(cities.city_metrics, "city_id", "merchant_id", "category")
_q4_top = _on_cells(cities.top_merchants_global, *MERCHANT_CELL)
_q4_distribution = _report(_q4_top, cities.top_merchants_distribution)
_q4_popularity = _on_cells(cities.merchant_popularity, *MERCHANT_CELL)

QUERIES: dict[str, Query] = {
    # Layers
    "bronze_transactions": bronze_transactions,
    "bronze_merchants": bronze_merchants,
    "merchants_resolved": lambda spark, d: silver.resolve_merchants(_merchants(spark, d)),
    "merchants_duplicates_audit": lambda spark, d: silver.audit_duplicates(_merchants(spark, d)),
    "enriched_transactions": _silver,
    "stored_layers_q1": stored_layers_q1,
    "bronze_locations": bronze_locations,
    "silver_month_rebuilt": silver_month_rebuilt,
    "silver_city_month": silver_city_month,
    # Questions
    "q1_top_merchants": _on_silver(questions.top_merchants),
    "q2_avg_by_state": _on_silver(questions.average_by_state),
    "q3_peak_hours": _q3,
    "q4_city_metrics": _q4,
    "q4_city_category_association": q4_association,
    "q4_top_merchants_global": _q4_top,
    "q4_top_merchants_distribution": _q4_distribution,
    "q4_merchant_popularity_by_city": _q4_popularity,
    "q4_merchants_by_month": q4_merchants_by_month,
    "q4_merchants_by_period": q4_merchants_by_period,
    "q5_transactions_ev": q5_transactions_ev,
    "q5_transaction_sample": lambda spark, d: reports.q5_transaction_sample(q5_transactions_ev(spark, d)),
    "q5a_cities": _section(C.SECTION_CITIES),
    "q5b_categories": _section(C.SECTION_CATEGORIES),
    "q5c_months": _section(C.SECTION_MONTHS),
    "q5d_hours": _section(C.SECTION_HOURS),
    "q5e_installments_overall": _section(C.SECTION_FINANCING),
    "q5_installments_impact": _section(C.SECTION_IMPACT),
    "q5e_installments_by_category": _section(C.SECTION_FINANCING_BY_CATEGORY),
    "q5e_installments_by_city": _section(C.SECTION_FINANCING_BY_CITY),
    "q5_advisory_summary": _on_advisory(lambda a: a),
    "monthly_volume": monthly_volume,
    # Data quality
    "dq_null_ratio": lambda spark, d: quality.null_ratios(_tx(spark, d)),
    "dq_gate": dq_gate,
    "dq_csv_misfits": dq_csv_misfits,
    "dq_gold_path": dq_gold_path,
    "dq_profile_numeric": dq_profile_numeric,
    "dq_gold_findings": dq_gold_findings,
    "dq_column_contract": dq_column_contract,
    "dq_column_contract_merchants": dq_column_contract_merchants,
    "dq_merchant_profile": lambda spark, d: quality.merchant_profile(_merchants(spark, d)),
    "dq_schema_drift": dq_schema_drift,
    "dq_orphan_merchants": _both(quality.orphan_summary),
    "dq_orphan_ids": _both(quality.orphan_merchants),
    "dq_duplicate_groups": lambda spark, d: quality.duplicate_groups(_merchants(spark, d)),
    "dq_duplicate_metrics": lambda spark, d: quality.duplicate_metrics(_merchants(spark, d)),
    "dq_duplicate_rows": lambda spark, d: quality.duplicate_rows(_merchants(spark, d)),
    "dq_duplicate_tx_impact": _both(quality.duplicate_impact),
    "dq_silver_anomalies": _on_silver(quality.silver_anomalies),
    # Reports
    "rep_q1_kpis": _report(_q1, reports.q1_kpis),
    "rep_q1_months": _stored_report(_q1, reports.q1_months),
    "rep_q1_focus": _stored_report(_q1, reports.q1_focus),
    "rep_q1_city_trend": _stored_report(_q1, reports.q1_city_trend),
    "rep_q1_city_choices": _report(_q1, lambda df: reports.choices(df, "City")),
    "rep_q2_state_summary": _rounded(_report(_q2, reports.q2_state_summary), "avg_of_avg"),
    "rep_q2_state_kpis": _rounded(_report(_q2, reports.q2_state_kpis), "top_avg_of_avg"),
    "rep_q2_top_merchants": _stored_report(_q2, reports.q2_top_merchants),
    "rep_q2_state_leaderboard": _rounded(_report(_q2, reports.q2_state_leaderboard), "avg_of_avg"),
    "rep_q3_overall_peak": _report(_q3, reports.q3_overall_peak),
    "rep_q3_category": _stored_report(_q3, reports.q3_category),
    "rep_q4_top_cities": _report(_q4, reports.q4_top_cities),
    "rep_q4_city_kpis": _report(_q4, reports.q4_city_kpis),
    "rep_q4_global_clean": _report(_q4_top, reports.q4_global_clean),
    "rep_q4_distribution_clean": _report(_q4_distribution, reports.q4_distribution_clean),
    "rep_q4_local": _stored_report(_q4_popularity, reports.q4_local),
    "rep_q5_kpis": _on_advisory(reports.q5_kpis),
    "rep_q5_pareto": _on_advisory(reports.q5_pareto),
    "rep_q5_categories": _on_advisory(reports.q5_categories),
    "rep_q5_peak_hours": _on_advisory(reports.q5_peak_hours),
    "rep_q5_profit_gap": _on_advisory(reports.q5_profit_gap),
    "rep_q5_city_focus": _stored_report(_on_advisory(lambda a: a), reports.q5_city_focus),
    "rep_month_over_month": _on_advisory(reports.month_over_month),
    "rep_pareto_cut": _on_silver(lambda s: reports.pareto_cut(advisor.advisory_cells(s))),
    "rep_installment_gap": _on_advisory(reports.installment_gap),
    "rep_city_profit_delta": _on_advisory(reports.city_profit_delta),
}
