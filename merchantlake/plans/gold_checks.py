"""Checks of the Gold tables: one row per finding."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.operators.stored_order import order_breaks, with_file_position, with_output_position
from merchantlake.sources.paths import path_exists

# The question a table answers, and the prefix of its finding codes.
QUESTIONS = {
    "q1": ("Q1", "q1"),
    "q2": ("Q2", "q2"),
    "q3": ("Q3", "q3"),
    "q4": ("Q4", "q4"),
    "q5": ("Q5", "q5"),
    "q4_association": ("Q4a", "q4/city_category_association"),
    "q4_top_merchants": ("Q4b", "q4/top_merchants_global"),
    "q4_distribution": ("Q4c", "q4/top_merchants_distribution_by_city"),
    "q4_popularity": ("Q4+", "q4/merchant_popularity_by_city"),
    "q5_advisory": ("Q5+", "q5_advisory_summary"),
}
# Columns a table must have, and the code of the finding about them.
REQUIRED = {
    "q1": ("q1_schema", ["Month", "City", "Merchant", "Purchase Total", "No of sales"]),
    "q2": ("q2_schema", ["Merchant", "State ID", "Average Amount"]),
    "q3": ("q3_schema", ["category", "Hour", "total_amount"]),
    "q4": ("q4_schema", ["city_id", "City", "total_transactions", "distinct_merchants", "distinct_categories"]),
    "q4_association": (
        "q4_assoc_schema",
        ["city_category_cramers_v", "metric_description", "min_city_tx_for_contingency"],
    ),
    "q4_top_merchants": (
        "q4_global_schema",
        [
            "global_rank",
            "merchant_id",
            "merchant_name",
            "total_transactions",
            "primary_city_id",
            "City",
            "tx_in_primary_city",
            "n_cities_active",
        ],
    ),
    "q4_distribution": ("q4_dist_schema", ["primary_city_id", "City", "n_top_merchants_in_top_k", "pct_of_top_k"]),
    "q4_popularity": (
        "q4_pop_schema",
        ["City", "city_id", "merchant_id", "merchant_name", "transaction_count", "popularity_rank"],
    ),
    "q5": (
        "q5_schema",
        [
            "merchant_name",
            "category",
            "amount",
            "installments",
            "installments_recommended",
            "expected_profit_margin",
            "risk_score",
            "assumptions",
        ],
    ),
    "q5_advisory": (
        "q5_adv_schema",
        ["section", "detail_key", "detail_label", "transaction_count", "total_amount", "extra_note"],
    ),
}
REQUIRED_SECTIONS = [C.SECTION_CITIES, C.SECTION_CATEGORIES, C.SECTION_MONTHS, C.SECTION_HOURS, C.SECTION_IMPACT]
CONSTANT_TOLERANCE = 1e-5

# (code, passed?, message, severity when it did not pass)
Rule = tuple[str, Column, Column, str]
Check = Callable[[DataFrame, dict[str, DataFrame]], tuple[DataFrame, list[Rule]]]


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("none")) for p in parts])


def _findings(stats: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(QUESTIONS[key][0]).alias("question"),
            F.lit(code).alias("code"),
            ok.alias("ok"),
            F.when(ok, F.lit("info")).otherwise(F.lit(severity)).alias("severity"),
            message.alias("message"),
        )
        for code, ok, message, severity in rules
    ]
    return stats.select(F.inline(F.array(*rows)))


def _q1(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    groups = df.groupBy("Month", "City").agg(F.count(F.lit(1)).alias("n"), F.min("Purchase Total").alias("least"))
    stats = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
        F.count_if(F.col("n") > C.TOP_PER_MONTH_CITY).alias("over"),
        F.count_if(F.col("least") < 0).alias("negative"),
    )
    return stats, [
        (
            "q1_top5_per_month_city",
            F.col("over") == 0,
            _text("largest group: ", F.col("largest"), "; groups over 5: ", F.col("over")),
            "error",
        ),
        (
            "q1_amounts_non_negative",
            F.col("negative") == 0,
            _text("groups with a negative total: ", F.col("negative")),
            "warn",
        ),
    ]


def _q2(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    ok = F.col("breaks") == 0
    return order_breaks(df, "Average Amount"), [
        ("q2_order_desc", ok, _text("rows larger than the row before: ", F.col("breaks")), "warn")
    ]


def _q3(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    hour = F.col("hour_of_day") if "hour_of_day" in df.columns else F.lit(None).cast("int")
    groups = df.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~hour.between(0, 23)).alias("outside")
    )
    stats = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
        F.count_if(F.col("n") > C.TOP_HOURS).alias("over"),
        F.coalesce(F.sum("outside"), F.lit(0)).alias("outside"),
    )
    hours = ("q3_hours_range", F.col("outside") == 0, _text("hours outside 0-23: ", F.col("outside")), "warn")
    return stats, [
        (
            "q3_top3_per_category",
            F.col("over") == 0,
            _text("largest group: ", F.col("largest"), "; groups over 3: ", F.col("over")),
            "error",
        ),
        *([hours] if "hour_of_day" in df.columns else []),
    ]


def _q4(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    stats = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return stats, [("q4_city_metrics", F.lit(True), _text("volume per city is present"), "info")]


def _association(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    v = F.col("city_category_cramers_v")
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.isnan(v) | v.between(0.0, 1.0)).alias("inside"),
        F.max(v).alias("v"),
    )
    return stats, [
        ("q4_assoc_rows", F.col("n_rows") == 1, _text("rows: ", F.col("n_rows"), ", expected 1"), "warn"),
        (
            "q4_cramers_v_bounds",
            F.col("inside") == F.col("n_rows"),
            _text("Cramer's V: ", F.format_string("%.6f", "v")),
            "warn",
        ),
    ]


def _top_merchants(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.max("global_rank"), F.lit(0)).alias("last")
    )
    ok = (F.col("n_rows") <= C.TOP_MERCHANTS) & (F.col("last") <= C.TOP_MERCHANTS)
    return stats, [("q4_global_top_k", ok, _text("rows: ", F.col("n_rows"), "; last rank: ", F.col("last")), "warn")]


def _distribution(df: DataFrame, tables: dict) -> tuple[DataFrame, list[Rule]]:
    """The counts add up to the top merchants there are, K when there are enough."""
    top = tables.get("q4_top_merchants")
    expected = F.lit(C.TOP_MERCHANTS) if top is None else top.agg(F.count(F.lit(1))).scalar()
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("n_top_merchants_in_top_k"), F.lit(0)).alias("merchants"),
    ).withColumn("expected", F.least(expected, F.lit(C.TOP_MERCHANTS)))
    ok = F.col("merchants") == F.col("expected")
    return stats, [
        ("q4_dist_sum", ok, _text("merchants: ", F.col("merchants"), "; expected: ", F.col("expected")), "warn")
    ]


def _popularity(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    groups = df.groupBy("city_id").agg(F.count(F.lit(1)).alias("n"), F.max("popularity_rank").alias("last"))
    stats = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("last") > C.TOP_PER_CITY).alias("over")
    )
    return stats, [
        ("q4_pop_top5", F.col("over") == 0, _text("cities with a rank over 5: ", F.col("over")), "error")
    ]


def _q5(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    def constant(column: str, expected: float) -> Column:
        """Non-null values are all the same and close to ``expected``."""
        low, high = F.min(column).cast("double"), F.max(column).cast("double")
        return F.coalesce((low == high) & (F.abs(low - expected) <= CONSTANT_TOLERANCE), F.lit(False))

    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        constant("expected_profit_margin", C.EXPECTED_MARGIN).alias("margin"),
        constant("risk_score", C.DEFAULT_RATE).alias("risk"),
    )
    return stats, [
        ("q5_ev_margin", F.col("margin"), _text(f"expected profit margin: {C.EXPECTED_MARGIN:.6f}"), "warn"),
        ("q5_default_rate", F.col("risk"), _text(f"default rate: {C.DEFAULT_RATE:.3f}"), "warn"),
        ("q5_advisory_tables", F.lit(True), _text("aggregates are in the advisory summary"), "info"),
        ("q5_gross_assumption", F.lit(True), _text(f"gross margin: {C.GROSS_MARGIN:.2f}"), "info"),
    ]


def _advisory(df: DataFrame, _: dict) -> tuple[DataFrame, list[Rule]]:
    sections = df.groupBy("section").agg(F.count(F.lit(1)).alias("n"))
    needed = F.array(*map(F.lit, REQUIRED_SECTIONS))
    stats = sections.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.collect_set("section").alias("have"))
    missing = F.array_except(needed, F.col("have"))
    return stats, [
        ("q5_adv_sections", F.size(missing) == 0, _text("missing sections: ", F.array_join(missing, ", ")), "error")
    ]


CHECKS: dict[str, Check] = {
    "q1": _q1,
    "q2": _q2,
    "q3": _q3,
    "q4": _q4,
    "q5": _q5,
    "q4_association": _association,
    "q4_top_merchants": _top_merchants,
    "q4_distribution": _distribution,
    "q4_popularity": _popularity,
    "q5_advisory": _advisory,
}


def _check(key: str, df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    code, required = REQUIRED[key]
    # Fixed value: this finding has another code when the columns are there.
    passed_code = "q2_schema_pdf" if key == "q2" else code
    shown = [c for c in df.columns if c not in ("_part", "_row")]
    missing = [c for c in required if c not in shown]
    if missing:
        stats, rules = df.agg(F.count(F.lit(1)).alias("n_rows")), []
    else:
        stats, rules = CHECKS[key](df, tables)
    rows = (
        f"{QUESTIONS[key][1]}_rows",
        F.lit(True),
        _text("rows: ", F.col("n_rows"), "; columns: " + ", ".join(shown)),
        "info",
    )
    schema = (code if missing else passed_code, F.lit(not missing), _text("missing columns: " + ", ".join(missing)), "error")
    return _findings(stats, key, [rows, schema, *rules])


def _absent(spark: SparkSession, key: str, suffix: str, message: str) -> DataFrame:
    severity = "error" if key in ("q1", "q2", "q3", "q4", "q5") else "warn"
    rule = (f"{QUESTIONS[key][1]}_{suffix}", F.lit(False), F.lit(message), severity)
    return _findings(spark.range(1), key, [rule])


def check_gold(
    spark: SparkSession, tables: dict[str, DataFrame], absent: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """Findings about Gold frames, keyed as in ``contract.GOLD_TABLES``.

    ``absent`` gives (code suffix, message) of tables that could not be opened.
    Rows count as stored in the order in which a frame puts them out.
    """
    found = []
    for key in CHECKS:
        if key not in tables:
            found.append(_absent(spark, key, *(absent or {}).get(key, ("path", "the table is missing"))))
            continue
        df = tables[key]
        if key == "q2" and "_part" not in df.columns:
            df = with_output_position(df)
        found.append(_check(key, df, tables))
    return reduce(DataFrame.unionByName, found)


def check_gold_path(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Findings about the Gold tables stored below ``root``."""
    tables, absent = {}, {}
    for key, folder in C.GOLD_TABLES.items():
        path = f"{root.rstrip('/')}/{folder}"
        if not path_exists(spark, path):
            absent[key] = ("path", f"nothing at {folder}")
        elif fmt == "parquet" and not path_exists(spark, f"{path}/part-*.parquet"):
            absent[key] = ("data", f"no Parquet files in {folder}")
        else:
            df = spark.read.format(fmt).load(path)
            tables[key] = with_file_position(df) if key == "q2" else df
    return check_gold(spark, tables, absent)


def has_errors(findings: DataFrame) -> bool:
    """Strict mode: a failed finding of severity error."""
    return not findings.where(~F.col("ok") & (F.col("severity") == "error")).isEmpty()
