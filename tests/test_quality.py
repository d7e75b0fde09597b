"""Quality jobs and Gold checks on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.plans import gold_checks, quality


def with_nulls(spark, share):
    return spark.range(100).select("id", F.when(F.col("id") >= share, F.col("id").cast("string")).alias("col_a"))


def test_null_ratio_passes_raises_and_accepts_an_empty_table(spark):
    quality.assert_null_ratio(with_nulls(spark, 1), ["col_a"], 0.05, "test")
    quality.assert_null_ratio(with_nulls(spark, 5), ["col_a"], 0.05, "test")
    with pytest.raises(quality.DataQualityError, match="test: column col_a null ratio 0.1000 exceeds 0.05"):
        quality.assert_null_ratio(with_nulls(spark, 10), ["id", "col_a"], 0.05, "test")
    quality.assert_null_ratio(with_nulls(spark, 0).limit(0), ["col_a"], 0.05, "test")


def test_profile_is_describe(spark):
    out = {r.summary: r.id for r in quality.profile_numeric(spark.range(1, 4), ["id"]).collect()}
    assert out == {"count": "3", "mean": "2.0", "stddev": "1.0", "min": "1", "max": "3"}


def test_column_report(spark, rows):
    df = spark.createDataFrame([(1.0, None), (2.0, "x")], "amount double, more string")
    report = quality.column_report(df, "t", ["purchase_amount", "amount", "gone"])
    assert rows(report, "column_name", "status", "severity", "known_as", "n_nulls") == [
        ("amount", "ok", "info", None, 0),
        ("gone", "missing", "warn", None, None),
        ("more", "extra", "info", None, 1),
        ("purchase_amount", "missing", "warn", "amount", None),
    ]


MERCHANTS = [("a", "x", 1.0), ("a", "x", 1.0), ("b", "x", 1.0), ("b", None, 2.0), ("c", "z", 3.0), (None, "p", 1.0), (None, "q", 1.0)]


@pytest.fixture
def merchants(spark):
    return spark.createDataFrame(MERCHANTS, "merchant_id string, merchant_name string, v double")


def test_duplicates(spark, merchants, rows):
    assert rows(quality.duplicate_groups(merchants)) == [("a", 2, 1, 0, ""), ("b", 2, 2, 2, "merchant_name|v")]
    assert quality.duplicate_metrics(merchants).first().asDict() == {
        "merchant_rows_total": 7,
        "merchant_id_distinct": 3,
        "duplicate_rows": 6,
        "duplicate_ids": 2,
        "groups_with_differences": 1,
        "max_rows_same_id": 2,
        "top_varying_columns_count": 2,
    }
    assert rows(quality.duplicate_rows(merchants)) == sorted(MERCHANTS[:4], key=repr)
    profile = {r.metric: r.value for r in quality.merchant_profile(merchants).collect()}
    assert profile == {"rows": 7, "repeated_id_rows": 3, "nulls:merchant_id": 2, "nulls:merchant_name": 1, "nulls:v": 0}


def test_duplicates_of_an_empty_table(merchants):
    empty = merchants.limit(0)
    assert set(quality.duplicate_metrics(empty).first()) == {0}
    assert {r.value for r in quality.merchant_profile(empty).collect()} == {0}


def test_impact_on_transactions(spark, merchants):
    tx = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 2.0), ("c", 4.0), (None, 1.0)], "merchant_id string, purchase_amount double"
    )
    assert tuple(quality.duplicate_impact(tx, merchants).first()) == (5, 3, 0.6, 8.0, 3.0, 0.375, 6)
    assert tuple(quality.duplicate_impact(tx.limit(0), merchants).first()) == (0, 0, 0.0, 0.0, 0.0, 0.0, 0)


def test_orphans(spark, merchants, rows):
    tx = spark.createDataFrame([("a",), ("q",), ("q",), ("p",), (None,)], "merchant_id string")
    assert rows(quality.orphan_merchants(tx, merchants)) == [("p",), ("q",)]
    assert tuple(quality.orphan_summary(tx, merchants).first()) == (2, "p|q")
    assert tuple(quality.orphan_summary(tx, merchants, sample=1).first()) == (2, "p")
    assert tuple(quality.orphan_summary(tx.where("merchant_id = 'a'"), merchants).first()) == (0, "")


def test_schema_drift(spark, tmp_path, rows):
    for i, columns in enumerate([["id", "x"], ["id", "x"], ["id", "y"]]):
        df = spark.range(i + 1).withColumn(columns[1], F.lit(1))
        df.toPandas()[columns].to_parquet(tmp_path / f"part-{i}.parquet")
    assert rows(quality.schema_drift(spark, str(tmp_path))) == [
        ("part-0.parquet", 1, 2, False), ("part-1.parquet", 2, 2, False), ("part-2.parquet", 3, 2, True),
    ]
    spark.range(4).write.parquet(f"{tmp_path}/deep/a")
    spark.range(5).withColumn("z", F.lit(None).cast("int")).repartition(3).write.parquet(f"{tmp_path}/deep/b")
    assert rows(quality.schema_drift(spark, f"{tmp_path}/deep", by="folder")) == [("a", 4, 1, False), ("b", 5, 2, True)]  # a column of nulls is a column
    assert rows(quality.schema_drift(spark, f"{tmp_path}/deep", by="file", at_once=2).groupBy("n_columns").agg(F.sum("n_rows"))) == [(1, 4), (2, 5)]
    (tmp_path / "none").mkdir()
    assert quality.schema_drift(spark, f"{tmp_path}/none").count() == 0


def test_rows_are_counted_from_footers(spark, tmp_path):
    spark.range(100).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/t")
    with quality._counts_from_footers(spark):
        counts = quality.row_counts(spark, {"t": [f"{tmp_path}/t"]})
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert counts.collect()[0].n_rows == 100
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan
    assert "BatchScan" not in spark.read.parquet(f"{tmp_path}/t")._jdf.queryExecution().executedPlan().toString()


def test_a_finding_about_hours_needs_the_column(spark, gold):
    found = gold_checks.check_gold(spark, {"q3": gold["q3"].drop("hour_of_day"), "q2": gold["q2"]})
    codes = {r.code for r in found.collect()}
    assert "q3_hours_range" not in codes and "q2_schema_pdf" in codes and "q2_schema" not in codes


def test_silver_anomalies(spark):
    data = [(None, None, "A"), ("m", None, ""), ("m", "", None), ("m", "n", C.UNKNOWN_CATEGORY)]
    df = spark.createDataFrame(data, "merchant_id string, merchant_name string, category string")
    assert tuple(quality.silver_anomalies(df).first()) == (4, 1, 1, 1, 1, 1, 1)


# Gold checks


@pytest.fixture
def gold(spark, sf_dir):
    from merchantlake.registry.queries import gold_frames

    return gold_frames(spark, sf_dir)


def failed(findings):
    return {(r.code, r.severity) for r in findings.where("not ok").collect()}


def check(spark, **tables):
    """Failures that concern the given tables."""
    return failed(gold_checks.check_gold(spark, tables).where("code not like '%path'"))


def test_missing_tables_are_errors_or_warnings(spark, tmp_path):
    (tmp_path / "q3_results").mkdir()
    found = failed(gold_checks.check_gold_path(spark, str(tmp_path)))
    assert {("q1_path", "error"), ("q3_data", "error"), ("q5_advisory_summary_path", "warn")} <= found
    assert len(found) == 10


def test_wrong_tables_are_found(spark, gold):
    q1 = spark.createDataFrame([("m", "c", str(i), -1.0, 1) for i in range(6)], gold["q1"].schema)
    assert check(spark, q1=q1) == {("q1_top5_per_month_city", "error"), ("q1_amounts_non_negative", "warn")}
    assert check(spark, q1=q1.drop("City")) == {("q1_schema", "error")}
    q2 = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], gold["q2"].schema).coalesce(1)
    assert check(spark, q2=q2) == {("q2_order_desc", "warn")}
    q3 = spark.createDataFrame([("A", 100 * h, 1.0, h) for h in (1, 2, 3, 24)], gold["q3"].schema)
    assert check(spark, q3=q3) == {("q3_top3_per_category", "error"), ("q3_hours_range", "warn")}
    v = spark.createDataFrame([(1.5, "m", 50), (0.5, "m", 50)], gold["q4_association"].schema)
    assert check(spark, q4_association=v) == {("q4_assoc_rows", "warn"), ("q4_cramers_v_bounds", "warn")}
    nan = spark.createDataFrame([(float("nan"), "m", 50)], gold["q4_association"].schema)
    assert check(spark, q4_association=nan) == set()
    top = spark.createDataFrame([(101, "m", "n", 1, 1, "City_1", 1, 1)], gold["q4_top_merchants"].schema)
    assert check(spark, q4_top_merchants=top) == {("q4_global_top_k", "warn")}
    spread = spark.createDataFrame([(1, "City_1", 2, 2.0)], gold["q4_distribution"].schema)
    assert check(spark, q4_distribution=spread) == {("q4_dist_sum", "warn")}
    pop = spark.createDataFrame([("City_1", 1, "m", "n", 1, 6)], gold["q4_popularity"].schema)
    assert check(spark, q4_popularity=pop) == {("q4_pop_top5", "error")}
    q5 = gold["q5"].limit(5).withColumn("risk_score", F.lit(0.3).cast("float"))
    assert check(spark, q5=q5) == {("q5_default_rate", "warn")}
    assert check(spark, q5=q5.limit(0)) == {("q5_ev_margin", "warn"), ("q5_default_rate", "warn")}
    few = gold["q5_advisory"].where(F.col("section") != C.SECTION_HOURS)
    assert check(spark, q5_advisory=few) == {("q5_adv_sections", "error")}


def test_strict_mode_looks_at_errors_only(spark, gold):
    good = gold_checks.check_gold(spark, gold)
    assert failed(good) == set() and not gold_checks.has_errors(good)
    warning = gold_checks.check_gold(spark, {**gold, "q4_distribution": gold["q4_distribution"].limit(0)})
    assert failed(warning) == {("q4_dist_sum", "warn")} and not gold_checks.has_errors(warning)
    assert gold_checks.has_errors(gold_checks.check_gold(spark, {"q1": gold["q1"]}))


def test_findings_can_be_stored(spark, gold, tmp_path):
    gold_checks.check_gold(spark, {"q3": gold["q3"]}).coalesce(1).write.json(str(tmp_path / "f"))
    lines = [json.loads(x) for p in (tmp_path / "f").glob("part-*.json") for x in p.read_text().splitlines()]
    assert {"question", "code", "ok", "severity", "message"} == set(lines[0])
