"""Gold questions 1 to 3 on the Silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.functions import columns as X
from merchantlake.operators.rank import top_n


def top_merchants(silver: DataFrame, n: int = C.TOP_PER_MONTH_CITY, ordered: bool = True) -> DataFrame:
    """Q1: the merchants with the largest purchase total in each month and city."""
    totals = silver.groupBy(
        *X.month_keys(F.col("purchase_ts")), "city_id", F.col("merchant_name").alias("Merchant")
    ).agg(X.money_sum(F.col("amount")).alias("Purchase Total"), F.count(F.lit(1)).alias("No of sales"))
    order = [F.col("Purchase Total").desc(), F.col("Merchant").asc()]
    top = top_n(totals, ["year", "month", "city_id"], order, n).select(
        X.month_label(F.col("year"), F.col("month")).alias("Month"),
        X.city_label(F.col("city_id")).alias("City"),
        "Merchant",
        "Purchase Total",
        "No of sales",
    )
    return top.orderBy("Month", "City", *order) if ordered else top


def average_by_state(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Q2: the average amount of each merchant in each state, largest first."""
    average = X.ratio(X.exact_sum(F.col("amount")), F.count("amount"))
    averages = silver.groupBy(F.col("merchant_name").alias("Merchant"), F.col("state_id").alias("State ID")).agg(
        average.alias("Average Amount")
    )
    order = [F.col("Average Amount").desc(), F.col("Merchant").asc(), F.col("State ID").asc()]
    return averages.orderBy(*order) if ordered else averages


def peak_hours(silver: DataFrame, n: int = C.TOP_HOURS) -> DataFrame:
    """Q3: the hours with the largest total of each category."""
    totals = silver.groupBy("category", X.hour_of(F.col("purchase_ts")).alias("hour_of_day")).agg(
        X.money_sum(F.col("amount")).alias("total_amount")
    )
    order = [F.col("total_amount").desc(), F.col("hour_of_day").asc()]
    return (
        top_n(totals, ["category"], order, n)
        .select("category", (F.col("hour_of_day") * 100).alias("Hour"), "total_amount", "hour_of_day")
        .orderBy("category", *order)
    )
