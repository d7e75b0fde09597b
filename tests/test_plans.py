"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import DataFrameWriter

from merchantlake.registry.queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stored_layers_q1", "bronze_merchants"}))
def test_no_query_pairs_all_rows(spark, sf_dir, name):
    text = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name",
    [
        "q1_top_merchants",
        "q2_avg_by_state",
        "q3_peak_hours",
        "q4_top_merchants_global",
        "q4_top_merchants_distribution",
        "q4_merchant_popularity_by_city",
        "q5_transactions_ev",
        "dq_silver_anomalies",
    ],
)
def test_facts_are_scanned_once(spark, sf_dir, name):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["q5_advisory_summary", "rep_q5_kpis", "rep_pareto_cut", "q4_merchants_by_month"])
def test_facts_are_scanned_once_before_sections_are_ranked(spark, sf_dir, name, monkeypatch):
    """Results in between are stored; the plans of all of them count. Merchants are numbered from a scan of their own."""
    stored, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (stored.append(plan_of(self._df)), write(self, *a, **k))[1])
    last = plan_of(QUERIES[name](spark, sf_dir))
    assert sum(p.count("lineitem.parquet") for p in [*stored, last]) == (2 if name.startswith("q4_merchants") else 1)


@pytest.mark.parametrize("name", ["rep_q1_focus", "rep_q1_months", "rep_q2_top_merchants", "rep_q4_local", "dq_orphan_merchants", "q4_city_metrics", "q4_city_category_association"])
def test_what_is_read_twice_is_stored_first(spark, sf_dir, name):
    text = plan_of(QUERIES[name](spark, sf_dir))
    assert "lineitem.parquet" not in text and ("stored-" in text or "cells-" in text)


@pytest.mark.parametrize("name", ["q1_top_merchants", "q3_peak_hours", "q4_merchant_popularity_by_city", "merchants_resolved"])
def test_ranks_are_limited_before_the_shuffle(spark, sf_dir, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan_of(QUERIES[name](spark, sf_dir)))


def test_the_top_merchants_are_not_sorted_in_full(spark, sf_dir):
    assert "TakeOrderedAndProject(limit=100" in plan_of(QUERIES["q4_top_merchants_global"](spark, sf_dir))


def test_gold_checks_find_the_top_merchants_once_and_from_cells_of_merchants_alone(spark, sf_dir, monkeypatch):
    stored, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (stored.append(self._df), write(self, *a, **k))[1])
    last = plan_of(QUERIES["dq_gold_findings"](spark, sf_dir))
    assert "TakeOrderedAndProject(limit=100" not in last
    assert sum("TakeOrderedAndProject(limit=100" in plan_of(df) for df in stored) == 1
    assert not any({"city_id", "category", "n"} < set(df.columns) for df in stored)


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan_of(QUERIES["q3_peak_hours"](spark, sf_dir))
    line = next(x for x in text.splitlines() if "lineitem.parquet" in x)
    assert "l_linenumber" not in line


def test_association_and_city_metrics_need_no_window_and_repeat_no_cell(spark, sf_dir):
    for name in ("q4_city_metrics", "q4_city_category_association"):
        text = plan_of(QUERIES[name](spark, sf_dir))
        assert "Window" not in text and "Expand" not in text, name


def test_no_row_goes_through_python(spark, sf_dir):
    for name in set(QUERIES) - {"stored_layers_q1", "bronze_merchants", "dq_gold_findings"}:
        text = plan_of(QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "InPandas" not in text, name


@pytest.fixture
def no_broadcast(spark):
    """Joins are shuffled, and what counts as a large partition is small."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["enriched_transactions", "dq_duplicate_rows", "q1_top_merchants"])
def test_shuffled_joins_give_the_same_rows_from_as_few_scans(spark, sf_dir, rows, no_broadcast, name):
    shuffled = QUERIES[name](spark, sf_dir)
    text = plan_of(shuffled)
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    assert text.count("lineitem.parquet") <= 1 and text.count("orders.parquet") <= 1
    got = rows(shuffled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert got == rows(QUERIES[name](spark, sf_dir))


def test_a_hot_key_is_split_over_tasks(spark, no_broadcast):
    """Most rows have one key; no task gets more than a part of them."""
    from pyspark.sql import functions as F

    from merchantlake.operators.joins import lookup_join

    copies = spark.range(0, 40_000, 1, 16).select(F.when(F.col("id") % 4 != 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    names = spark.range(500).select((F.col("id") * 4).cast("string").alias("key"), F.col("id").alias("n")).union(spark.sql("select 'hot', -1L"))
    joined = lookup_join(copies, names, "key", "left")
    by_task = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(F.col("key") == "hot").alias("hot"), F.max("v"), F.count("n"))
    per_task = [x["hot"] for x in by_task.collect()]
    assert sum(per_task) == 30_000 and max(per_task) < 15_000
    assert "skew=true" in plan_after(joined)


def plan_after(df) -> str:
    """The plan as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
