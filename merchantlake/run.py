"""Run the layers: ``python -m merchantlake.run bronze|silver|gold|all|validate|duplicates|dictionary|report``."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.operators.reuse import store, use_work_folder
from merchantlake.plans import advisor, cities, gold_checks, quality, questions, reports, silver
from merchantlake.sources import paths, tables


MONTH_FOLDERS = ("purchase_year", "purchase_month")


@dataclass(frozen=True)
class Settings:
    """Where the layers are. Any path Spark can read will do."""

    data_root: str = "./data"
    raw_transactions: str | None = None
    raw_merchants: str | None = None
    fmt: str = "parquet"

    @classmethod
    def from_environment(cls) -> Settings:
        """``TABLE_FORMAT`` is any format that Spark can write and read."""
        env = os.environ
        raw = env.get("RAW_TRANSACTIONS_PATH"), env.get("RAW_MERCHANTS_PATH")
        return cls(env.get("DATA_ROOT", "./data"), *raw, env.get("TABLE_FORMAT", "parquet"))

    def at(self, *parts: str) -> str:
        return "/".join([self.data_root.rstrip("/"), *parts])

    @property
    def merchants(self) -> str:
        return self.raw_merchants or self.at("raw", "merchants.csv")


def session(app: str) -> SparkSession:
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def run_bronze(spark: SparkSession, settings: Settings) -> None:
    """Raw files as they are, with lineage."""
    source = paths.resolve_transactions(spark, settings.data_root, settings.raw_transactions)
    if not paths.path_exists(spark, settings.merchants):
        raise FileNotFoundError(f"no merchants at {settings.merchants}")
    transactions = tables.read_transactions(spark, source)
    merchants, misfits = tables.read_csv(spark, settings.merchants, C.MERCHANTS)
    tables.write_report(misfits.coalesce(1), settings.at("bronze", "qa", "merchants_misfits"), "json")
    tables.write_table(tables.with_lineage(transactions, source, by_file=True), settings.at("bronze", "transactions"), fmt=settings.fmt)
    tables.write_table(tables.with_lineage(merchants, settings.merchants), settings.at("bronze", "merchants"), fmt=settings.fmt)


def run_silver(
    spark: SparkSession, settings: Settings, partition_by_month: bool = False, months: list[str] | None = None,
    max_null_ratio: float = C.MAX_NULL_RATIO,
) -> list[str]:
    """One merchant per id, the audit of repeated ids, and the enriched transactions.

    ``months`` (``yyyy-MM``) rebuilds these months of a table that is partitioned by month, and no other. Transactions with too
    many nulls in a key column are not published. Returns the partition folders that were replaced.
    """
    merchants = tables.read_table(spark, settings.at("bronze", "merchants"), settings.fmt)
    resolved_path = settings.at("silver", "merchants_resolved")
    tables.write_table(silver.resolve_merchants(merchants), resolved_path, fmt=settings.fmt)
    tables.write_table(silver.audit_duplicates(merchants), settings.at("silver", "merchants_duplicates_audit"), fmt=settings.fmt)

    transactions = tables.read_table(spark, settings.at("bronze", "transactions"), settings.fmt)
    if months:
        transactions = silver.of_months(transactions, months)
    enriched = silver.enrich(transactions, tables.read_table(spark, resolved_path, settings.fmt))
    C.assert_contract(enriched, C.SILVER, "enriched_transactions")
    gate = tables.Gate(C.GATED, max_null_ratio, "enriched_transactions")
    target = settings.at("silver", "enriched_transactions")
    if not (partition_by_month or months):
        tables.write_table(enriched, target, fmt=settings.fmt, cluster_by=silver.reading_order(), gate=gate)
        return []
    year, month = MONTH_FOLDERS
    enriched = enriched.withColumns({year: F.year("purchase_ts"), month: F.month("purchase_ts")})
    if months:
        only = [dict(zip(MONTH_FOLDERS, (int(x) for x in m.split("-")))) for m in months]
        return tables.write_partitions(enriched, target, MONTH_FOLDERS, only=only, fmt=settings.fmt, cluster_by=("city_id",), gate=gate)
    clustered = (*MONTH_FOLDERS, "city_id")
    tables.write_table(enriched, target, fmt=settings.fmt, partition_by=MONTH_FOLDERS, cluster_by=clustered, gate=gate)
    return []


def _gold(settings: Settings, key: str) -> str:
    return settings.at("gold", C.GOLD_TABLES[key])


def _gold_q1(spark: SparkSession, source: DataFrame, settings: Settings) -> None:
    tables.write_table(questions.top_merchants(source), _gold(settings, "q1"), fmt=settings.fmt)


def _gold_q2(spark: SparkSession, source: DataFrame, settings: Settings) -> None:
    tables.write_table(questions.average_by_state(source), _gold(settings, "q2"), fmt=settings.fmt)


def _gold_q3(spark: SparkSession, source: DataFrame, settings: Settings) -> None:
    tables.write_table(questions.peak_hours(source), _gold(settings, "q3"), small=True, fmt=settings.fmt)


def _gold_q4(spark: SparkSession, source: DataFrame, settings: Settings) -> None:
    """Five tables from one scan: the cells are stored before they are rolled up."""
    cells = store(cities.count_cells(source))
    tables.write_table(cities.city_metrics(cells), _gold(settings, "q4"), fmt=settings.fmt)
    tables.write_table(cities.city_category_association(cells), _gold(settings, "q4_association"), small=True, fmt=settings.fmt)
    tables.write_table(cities.top_merchants_global(cells), _gold(settings, "q4_top_merchants"), small=True, fmt=settings.fmt)
    top = tables.read_table(spark, _gold(settings, "q4_top_merchants"), settings.fmt)
    tables.write_table(cities.top_merchants_distribution(top), _gold(settings, "q4_distribution"), small=True, fmt=settings.fmt)
    tables.write_table(cities.merchant_popularity(cells), _gold(settings, "q4_popularity"), fmt=settings.fmt)


def _gold_q5(spark: SparkSession, source: DataFrame, settings: Settings) -> None:
    """One row per transaction, and the summary."""
    tables.write_table(advisor.expected_values(source), _gold(settings, "q5"), fmt=settings.fmt)
    # Sections are computed side by side; only their rows meet in one file.
    summary = advisor.advisory_summary(advisor.advisory_cells(source)).repartition(1)
    tables.write_table(summary, _gold(settings, "q5_advisory"), small=True, fmt=settings.fmt)


GOLD: dict[str, Callable[[SparkSession, DataFrame, Settings], None]] = {
    "q1": _gold_q1,
    "q2": _gold_q2,
    "q3": _gold_q3,
    "q4": _gold_q4,
    "q5": _gold_q5,
}


def run_gold(spark: SparkSession, settings: Settings, question: str) -> None:
    if question not in GOLD:
        raise ValueError(f"unknown question {question!r}; there are {sorted(GOLD)}")
    source = tables.read_table(spark, settings.at("silver", "enriched_transactions"), settings.fmt)
    C.assert_contract(source, C.SILVER, "enriched_transactions")
    GOLD[question](spark, source, settings)


def run_all(spark: SparkSession, settings: Settings) -> None:
    run_bronze(spark, settings)
    run_silver(spark, settings)
    for question in GOLD:
        run_gold(spark, settings, question)


def run_validate(spark: SparkSession, settings: Settings) -> DataFrame:
    """Findings about Gold, stored as JSON beside it."""
    target = settings.at("gold", "qa", "findings")
    tables.write_report(gold_checks.check_gold_path(spark, settings.at("gold"), settings.fmt).coalesce(1), target, "json")
    return spark.read.schema("question string, code string, ok boolean, severity string, message string").json(target)


def run_duplicates(spark: SparkSession, settings: Settings) -> None:
    """What repeated merchant ids are like, and which transactions they touch."""
    merchants = tables.read_merchants(spark, settings.merchants)
    locations = (
        [settings.raw_transactions]
        if settings.raw_transactions
        else paths.discover_transactions(spark, settings.data_root)
    )
    if not locations:
        raise FileNotFoundError(f"no transactions below {settings.data_root}")
    transactions = tables.read_transactions(spark, *locations)
    out = settings.at("gold", "qa")
    tables.write_report(quality.duplicate_groups(merchants), f"{out}/duplicate_merchant_groups", "csv")
    tables.write_report(quality.duplicate_rows(merchants), f"{out}/duplicate_merchant_rows", "csv")
    tables.write_report(quality.duplicate_metrics(merchants), f"{out}/merchants_duplicate_metrics", "json")
    tables.write_report(quality.duplicate_impact(transactions, merchants), f"{out}/transactions_impact", "json")


REPORT_SOURCES = {"rep_q1": "q1", "rep_q2": "q2", "rep_q3": "q3", "rep_q4_top_cities": "q4", "rep_q4_city_kpis": "q4", "rep_q4_global": "q4_top_merchants",
                  "rep_q4_distribution": "q4_distribution", "rep_q4_local": "q4_popularity"}


def run_dictionary(spark: SparkSession, settings: Settings) -> DataFrame:
    """The dictionary check of both stored raw tables, with the profile of merchants, orphan ids, and nulls and numbers
    of the transactions; every report is stored beside Gold. Returns the columns of both tables."""
    transactions = tables.read_table(spark, settings.at("bronze", "transactions"), settings.fmt)
    merchants = tables.read_table(spark, settings.at("bronze", "merchants"), settings.fmt)
    out = settings.at("gold", "qa")
    columns = quality.column_report(transactions, "transactions", quality.TRANSACTION_DICTIONARY).unionByName(
        quality.column_report(merchants, "merchants", quality.MERCHANT_DICTIONARY)
    )
    numbers = [c for c in ("amount", "purchase_amount", "installments") if c in transactions.columns]
    reports = {
        "dictionary_columns": columns,
        "merchant_profile": quality.merchant_profile(merchants),
        "orphan_merchants": quality.orphan_summary(transactions, merchants),
        "transaction_nulls": quality.null_ratios(transactions),
        "transaction_numbers": quality.profile_numeric(transactions, numbers),
    }
    for name, report in reports.items():
        tables.write_report(report, f"{out}/{name}", "json")
    return columns


def run_report(spark: SparkSession, settings: Settings, name: str, **choices: object) -> DataFrame:
    """A report on stored Gold. ``choices`` are parameters of the report, such as month, months, city or state."""
    plan = getattr(reports, name.removeprefix("rep_"), None)
    source = next((key for prefix, key in REPORT_SOURCES.items() if name.startswith(prefix)), "q5_advisory")
    if plan is None or name == "rep_pareto_cut":
        raise ValueError(f"no report {name!r} on a Gold table")
    gold = tables.read_table(spark, _gold(settings, source), settings.fmt)
    return plan(gold, **{k: v for k, v in choices.items() if v is not None})


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=["bronze", "silver", "gold", "all", "validate", "duplicates", "dictionary", "report"])
    parser.add_argument("--question", choices=sorted(GOLD), help="one Gold question instead of all")
    parser.add_argument("--strict", action="store_true", help="validate: exit 1 on a failed check of severity error")
    parser.add_argument("--partition-by-month", action="store_true", help="silver: one folder per month")
    parser.add_argument("--name", help="report: its name, such as rep_q1_months")
    parser.add_argument("--month", action="append", help="report: a month; silver: a month to rebuild; may be given several times")
    parser.add_argument("--city", help="report: a city")
    parser.add_argument("--state", type=int, help="report: a state")
    args = parser.parse_args(arguments)
    spark, settings = session("merchantlake"), Settings.from_environment()
    use_work_folder(spark, settings.at("_work"))
    if args.step == "bronze":
        run_bronze(spark, settings)
    elif args.step == "silver":
        run_silver(spark, settings, args.partition_by_month, args.month)
    elif args.step == "gold":
        for question in [args.question] if args.question else GOLD:
            run_gold(spark, settings, question)
    elif args.step == "all":
        run_all(spark, settings)
    elif args.step == "duplicates":
        run_duplicates(spark, settings)
    elif args.step == "dictionary":
        run_dictionary(spark, settings).show(200, truncate=False)
    elif args.step == "report":
        months = {"months": args.month} if args.name == "rep_q1_months" else {"month": args.month and args.month[0]}
        run_report(spark, settings, args.name or "", **months, city=args.city, state=args.state).show(200, truncate=False)
    else:
        findings = run_validate(spark, settings)
        findings.orderBy("question", "code").show(200, truncate=False)
        if args.strict and gold_checks.has_errors(findings):
            return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
