"""Ranks and running sums slice by slice, against Spark's windows."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.operators import scan
from merchantlake.plans import advisor, reports


@pytest.fixture(scope="module")
def sections(spark):
    """A large section with many ties and nulls, a small one, one of a single row, and one value that most rows share."""
    k = F.col("id")
    value = F.when(k % 11 == 0, None).when(k % 3 == 0, 7.5).otherwise((k * 7919 % 900).cast("double"))
    large = spark.range(20_000).select(F.lit("large").alias("s"), value.alias("v"), k.cast("string").alias("tie"), (k % 50).cast("decimal(20,2)").alias("m"))
    small = spark.range(7).select(F.lit("small"), (k % 3).cast("double"), k.cast("string"), F.when(k != 2, k).cast("decimal(20,2)"))
    one = spark.range(1).select(F.lit("one"), F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("decimal(20,2)"))
    return large.unionByName(small.toDF("s", "v", "tie", "m")).unionByName(one.toDF("s", "v", "tie", "m")).repartition(6)


@pytest.mark.parametrize("order", ["v", "-v"])
def test_percent_ranks_and_running_sums_equal_windows(sections, rows, order):
    found = scan.looked_up(sections, scan.prefix_scan(sections, ["s"], [order], {"upto": F.col("m")}), ["s", "v"])
    got = found.select("s", "v", "tie", scan.percent_rank().alias("p"), "upto", "whole_upto", scan.PEERS)
    w = Window.partitionBy("s")
    ordered = w.orderBy(scan.sort_column(order))
    expected = sections.select(
        "s", "v", "tie", F.percent_rank().over(ordered), F.sum("m").over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        F.sum("m").over(w), F.count("*").over(Window.partitionBy("s", "v")),
    )
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("n", [4, 3, 9])
def test_parts_equal_windows(sections, rows, n):
    found = scan.looked_up(sections, scan.prefix_scan(sections, ["s"], ["-v", "tie"]), ["s", "v", "tie"])
    window = Window.partitionBy("s").orderBy(F.col("v").desc(), "tie")
    assert rows(found.select("s", "v", "tie", scan.ntile(n))) == rows(sections.select("s", "v", "tie", F.ntile(n).over(window)))


def test_without_keys_the_table_is_one_section(sections, rows):
    got = scan.prefix_scan(sections, [], ["v", "tie", "s"], {"upto": F.col("m")})
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("v").asc_nulls_first(), F.col("tie").asc_nulls_first(), "s")
    expected = sections.select("v", "tie", "s", F.row_number().over(order) - 1, F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(got, "v", "tie", "s", scan.BEFORE, "upto") == rows(expected)


def test_an_empty_table(sections):
    none = scan.prefix_scan(sections.where("false"), ["s"], ["v"], {"upto": F.col("m")})
    assert none.select(scan.percent_rank(), scan.ntile(4)).count() == 0


def windows(df):
    """What the windows of a plan are partitioned by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", w) for w in re.findall(r"Window \[.*?\], \[(.*?)\]", plan)], plan


def test_no_task_holds_a_section(sections, request):
    """Small slices are put together while a query runs; without that, they show."""
    spark, name = sections.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    request.addfinalizer(lambda: spark.conf.unset(name))
    found = scan.prefix_scan(sections, ["s"], ["v"], {"upto": F.col("m")})
    partitioned, plan = windows(found)
    assert partitioned and "SinglePartition" not in plan
    slices = spark.read.parquet(*found.inputFiles()).groupBy("s", "_slice").count()
    of_large = [r["count"] for r in slices.where("s = 'large'").collect()]
    assert len(of_large) > 2 and max(of_large) < 0.6 * sum(of_large)


def city_cells(spark, n):
    """Cells of ``n`` cities, many with equal numbers."""
    k = F.col("id")
    return spark.range(n).select(
        F.when(k % 1000 != 7, k.cast("int")).alias("city_id"), F.element_at(F.array(*map(F.lit, "ABC")), (k % 3 + 1).cast("int")).alias("category"),
        (k % 2 == 0).alias("financed"), F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"), F.lit(None).cast("int").alias("hour"),
        F.lit(True).alias("is_party"), (k % 97 + 1).alias("n"), ((k * 7919) % 10_007 * F.lit(1.25)).cast(C.TOTALS).alias("total"),
    )


def test_the_share_of_leading_cities_among_a_million(spark):
    n = 1_000_000
    got = reports.pareto_cut(city_cells(spark, n)).first()
    totals = sorted(((k * 7919) % 10_007 * 1.25 for k in range(n) if k % 1000 != 7), reverse=True)
    whole, upto, cities = sum(totals), 0.0, 0
    for t in totals:
        cities += upto / whole < 0.8
        upto += t
    assert got.top_5_share == pytest.approx(sum(totals[:5]) / whole, rel=1e-12) and got.top_10_share == pytest.approx(sum(totals[:10]) / whole, rel=1e-12)
    assert got.cities_for_share == cities


def test_the_advisory_ranks_many_cities_as_windows_do(spark):
    cells = city_cells(spark, 200_000)
    summary = advisor.advisory_summary(cells)
    assert "SinglePartition" not in windows(summary)[1].split("TakeOrderedAndProject")[0]
    got = [r.detail_key for r in summary.where("section = 'q5a_cities'").select("detail_key", "total_amount").collect()]
    every = Window.partitionBy(F.lit(1))
    base = cells.where("city_id is not null").select("city_id", "n", "total", (F.col("total").cast("double") / F.col("n").cast("double")).alias("t"))
    a, b, c = C.SCORE_WEIGHTS
    score = sum((F.lit(w) * F.percent_rank().over(every.orderBy(m)) for w, m in ((a, "n"), (b, "total"), (c, "t"))), F.lit(0.0))
    expected = base.withColumn("score", score).orderBy(F.col("score").desc(), "city_id").limit(C.TOP_CITIES)
    assert sorted(got) == sorted(str(r.city_id) for r in expected.collect())
