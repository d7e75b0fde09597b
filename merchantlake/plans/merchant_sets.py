"""Exact distinct merchants of any period, rolled up from monthly bitmaps.

A count of distinct merchants per month cannot be added up: a merchant that sells in two months counts once in both together.
Sets can be united. Merchants get dense numbers, and the merchants of a month and city are a bitmap of these numbers, in
buckets of 64, each one number: a bucket has a row only where a merchant is in it, so cells are never more than the different
merchants of months and cities, however thin these are spread, and are united in hash tables. Monthly cells are stored
once and give every longer period by uniting bitmaps, without the transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake.functions import columns as X
from merchantlake.operators import scan
from merchantlake.operators.joins import lookup_join

KEY = "merchant_id"
# Fixed value: a bucket is 2**6 merchants, the bits of a bigint.
BUCKET_BITS = 6


def merchant_numbers(silver: DataFrame) -> DataFrame:
    """(merchant_id, number): merchants counted through from 1, without gaps. Null is no merchant.

    Merchants whose first city is the same get neighbouring numbers, so that a city's bitmaps have few buckets. Numbers
    are dealt slice by slice (:mod:`merchantlake.operators.scan`), not by one task.
    """
    merchants = silver.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min("city_id").alias("_home"))
    return scan.prefix_scan(merchants, [], ["_home", KEY]).select(KEY, (F.col(scan.BEFORE) + 1).alias("number"))


def monthly_sets(silver: DataFrame, numbers: DataFrame) -> DataFrame:
    """(year, month, city_id, bucket, merchants): a bitmap for each month, city and bucket of merchant numbers."""
    cells = silver.select(*X.month_keys(F.col("purchase_ts")), "city_id", KEY).where(F.col(KEY).isNotNull()).distinct()
    numbered = lookup_join(cells, numbers, KEY, "inner")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("number") % (1 << BUCKET_BITS)).cast("int"))
    return numbered.groupBy("year", "month", "city_id", F.shiftright("number", BUCKET_BITS).alias("bucket")).agg(
        F.bit_or(bit).alias("merchants")
    )


def distinct_merchants(sets: DataFrame, *keys: Column) -> DataFrame:
    """Different merchants for each value of ``keys``, which can be any roll-up of year, month and city."""
    names = [f"_key{i}" for i in range(len(keys))]
    united = sets.select("bucket", "merchants", *[k.alias(n) for k, n in zip(keys, names)])
    united = united.groupBy(*names, "bucket").agg(F.bit_or("merchants").alias("merchants"))
    counted = united.groupBy(*names).agg(F.sum(F.bit_count("merchants").cast("bigint")).alias("distinct_merchants"))
    shown = [sets.select(k).columns[0] for k in keys]
    return counted.withColumnsRenamed(dict(zip(names, shown)))


def quarter() -> Column:
    """``yyyy-Qn`` of the cells' year and month; null stays null."""
    return F.concat(F.col("year").cast("string"), F.lit("-Q"), F.ceil(F.col("month") / 3).cast("string")).alias("quarter")
