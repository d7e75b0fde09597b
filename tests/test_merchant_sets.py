"""Distinct merchants from bitmaps of months, against counting them."""

import pytest
from pyspark.sql import functions as F

from merchantlake.operators import scan
from merchantlake.operators.reuse import store
from merchantlake.plans import merchant_sets as M
from merchantlake.registry.queries import _silver


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return store(_silver(spark, sf_dir), "source")


def test_numbers_are_dense(spark, source):
    numbers = [r.number for r in M.merchant_numbers(source).collect()]
    assert sorted(numbers) == list(range(1, 1 + source.select("merchant_id").where("merchant_id is not null").distinct().count()))


def test_a_city_has_neighbouring_numbers(source):
    numbers = M.merchant_numbers(source).join(source.groupBy("merchant_id").agg(F.min("city_id").alias("home")), "merchant_id")
    spans = numbers.groupBy("home").agg((F.max("number") - F.min("number") + 1).alias("span"), F.count("*").alias("n")).collect()
    assert all(r.span == r.n for r in spans)


@pytest.mark.parametrize("keys", [["year", "month", "city_id"], ["city_id"], ["year"], []])
def test_any_roll_up_of_months_equals_a_count(source, rows, keys):
    sets = M.monthly_sets(source, M.merchant_numbers(source))
    got = M.distinct_merchants(sets, *[F.col(k) for k in keys])
    keyed = source.where("merchant_id is not null").withColumns({"year": F.year("purchase_ts"), "month": F.month("purchase_ts")})
    assert rows(got, *keys, "distinct_merchants") == rows(keyed.groupBy(*keys).agg(F.count_distinct("merchant_id").alias("distinct_merchants")))


def test_many_buckets(spark, rows):
    """More merchants than a bitmap has bits."""
    k = F.col("id")
    df = spark.range(200_000).select(
        (k * 11 % 70_000).cast("string").alias("merchant_id"), (k % 3).cast("int").alias("city_id"),
        F.expr("timestamp'2017-01-15' + make_ym_interval(0, cast(id % 4 as int))").alias("purchase_ts"),
    )
    sets = M.monthly_sets(df, M.merchant_numbers(df))
    assert sets.select("bucket").distinct().count() >= 3
    got = M.distinct_merchants(sets, F.col("city_id"))
    assert rows(got) == rows(df.groupBy("city_id").agg(F.count_distinct("merchant_id")))


def test_no_merchants(spark, source):
    none = source.where("false")
    assert M.distinct_merchants(M.monthly_sets(none, M.merchant_numbers(none)), F.col("city_id")).count() == 0
    assert scan.PEERS not in M.merchant_numbers(source).columns


def test_thin_sets_take_a_number_for_each_merchant(spark):
    """A bitmap of some size for each month, city and bucket grows with the product of cells and merchants."""
    k = F.col("id")
    df = spark.range(20_000).select(
        (k * 7919 % 20_011).cast("string").alias("merchant_id"), (k % 500).cast("int").alias("city_id"),
        F.expr("timestamp'2017-01-15' + make_ym_interval(0, cast(id % 12 as int))").alias("purchase_ts"),
    )
    sets = M.monthly_sets(df, M.merchant_numbers(df))
    assert sets.schema["merchants"].dataType.simpleString() == "bigint"
    assert sets.count() <= 20_000 and sets.agg(F.sum(F.bit_count("merchants").cast("bigint"))).first()[0] == 20_000
