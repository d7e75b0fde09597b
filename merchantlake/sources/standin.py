"""Transactions and merchants derived from order tables.

The real extract is not available here. Lines of orders stand in for card
transactions and parts for merchants, with nulls, duplicates, orphans and skew
that come from key arithmetic and so are the same wherever they are computed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantlake.operators.joins import lookup_join

# Columns of the input tables in use.
COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_nationkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Columns of an input table; one that is not there is an error."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*COLUMNS[name])


def _merchant_id(part_key: Column) -> Column:
    return F.concat(F.lit("M_"), F.floor(part_key / 2).cast("bigint").cast("string"))


def _null_or_id(part_key: Column) -> Column:
    return F.when(part_key % 211 != 0, _merchant_id(part_key)).alias("merchant_id")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions: line items with their order's date, priority and customer."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    placed = lookup_join(table(spark, sf_dir, "orders"), customers, "o_custkey", "inner")
    lines = table(spark, sf_dir, "lineitem")
    joined = lookup_join(lines, placed.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "inner")
    part, customer, line = F.col("l_partkey"), F.col("o_custkey"), F.col("l_linenumber")
    return joined.select(
        _null_or_id(part),
        F.col("l_extendedprice").alias("purchase_amount"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("category"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(part % 24).cast("int"))).alias("purchase_date"),
        F.when(customer % 97 != 13, F.floor(F.sqrt(customer * 3)).cast("int")).alias("city_id"),
        F.when(F.col("c_nationkey") == 0, F.lit(-1)).otherwise(F.col("c_nationkey")).alias("state_id"),
        F.when(line != 7, line - 1).alias("installments"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw merchants: parts, with one or two rows per id and ids that are missing."""
    key, size = F.col("p_partkey"), F.col("p_size")
    pair = F.floor(key / 2)
    sales = F.element_at(F.array(*map(F.lit, ("A", " b ", "C", "d", "E", "z"))), size % 6 + 1)
    purchases = F.element_at(F.array(*map(F.lit, ("E", "D", "C", "B", "A"))), size % 5 + 1)
    return (
        table(spark, sf_dir, "part")
        .where((pair % 10 != 9) & ~((key % 2 == 1) & (pair % 3 == 0)))
        .select(
            _merchant_id(key).alias("merchant_id"),
            F.when(key % 50 != 0, F.concat_ws(" ", "p_name", "p_brand")).alias("merchant_name"),
            sales.alias("most_recent_sales_range"),
            purchases.alias("most_recent_purchases_range"),
            (size % 13).alias("active_months_lag12"),
            (size % 7).alias("active_months_lag6"),
            (size % 4).alias("active_months_lag3"),
            F.col("p_retailprice").alias("avg_purchases_lag12"),
        )
    )
