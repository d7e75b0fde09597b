"""Report queries on Gold tables.

Each takes Gold frames and, where a reader would choose something, a parameter.
Without a choice they take what a reader sees first: see :func:`first_choice`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.functions import columns as X
from merchantlake.operators import scan


def choices(df: DataFrame, column: str) -> DataFrame:
    """The sorted values a reader can choose from."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def first_choice(df: DataFrame, column: str, position: int = 1) -> Column:
    """The value at ``position`` of the sorted choices, or the last one if there are fewer."""
    return choices(df, column).limit(position).agg(F.max(column)).scalar()


def _chosen(df: DataFrame, column: str, value: object | None, position: int = 1) -> DataFrame:
    wanted = first_choice(df, column, position) if value is None else F.lit(value)
    return df.where(F.col(column) == wanted)


def section(advisory: DataFrame, name: str) -> DataFrame:
    return advisory.where(F.col("section") == name)


def _best(value: str, by: str, tie: str) -> Column:
    """``value`` of the row with the largest ``by``; the smallest ``tie`` decides."""
    return F.min_by(value, F.struct((-F.col(by)).alias("a"), F.col(tie).alias("b")))


# Question 1


def q1_kpis(q1: DataFrame) -> DataFrame:
    return q1.agg(
        F.count_distinct("Month").alias("n_months"),
        F.count_distinct("City").alias("n_cities"),
        F.count_distinct("Merchant").alias("n_merchants"),
        X.sum_of_totals(F.col("Purchase Total")).cast("double").alias("total_purchase"),
    )


def q1_months(q1: DataFrame, months: list[str] | None = None, preset: int = 3) -> DataFrame:
    """Rows of the chosen months; of the first few when nothing was chosen yet, of all when the choice is empty."""
    if months is not None:
        return q1.where(F.col("Month").isin(months)) if months else q1
    return q1.join(F.broadcast(choices(q1, "Month").limit(preset)), "Month", "left_semi")


def q1_focus(q1: DataFrame, month: str | None = None, city: str | None = None, k: int = 5) -> DataFrame:
    """The leading merchants of one month and city."""
    rows = _chosen(q1, "City", city)
    # Of the city's own months, so that a choice left open shows something.
    rows = _chosen(rows, "Month", month, 4)
    return rows.orderBy(F.col("Purchase Total").desc(), F.col("Merchant").asc()).limit(k)


def q1_city_trend(q1: DataFrame, city: str | None = None) -> DataFrame:
    """Total of a city's leading merchants per month."""
    return (
        _chosen(q1, "City", city)
        .where(F.col("Month").isNotNull())
        .groupBy("Month")
        .agg(X.sum_of_totals(F.col("Purchase Total")).cast("double").alias("Purchase Total"))
        .orderBy("Month")
    )


# Question 2


def q2_state_summary(q2: DataFrame, exclude_unknown: bool = True) -> DataFrame:
    """Per state: its merchants and the mean of their averages.

    Question 2 has one row per merchant and state, so counting rows counts merchants.
    """
    rows = q2.dropna(subset=["State ID", "Average Amount"])
    if exclude_unknown:
        rows = rows.where(F.col("State ID") != C.UNKNOWN_STATE)
    return (
        rows.groupBy("State ID")
        .agg(F.count("Merchant").alias("n_merchants"), F.avg("Average Amount").alias("avg_of_avg"))
        .orderBy(F.col("avg_of_avg").desc(), F.col("State ID").asc())
    )


def q2_state_kpis(q2: DataFrame) -> DataFrame:
    return q2_state_summary(q2).agg(
        F.count(F.lit(1)).alias("n_states"),
        _best("State ID", "avg_of_avg", "State ID").alias("top_state"),
        F.max("avg_of_avg").alias("top_avg_of_avg"),
    )


def q2_state_leaderboard(q2: DataFrame, n: int = 10) -> DataFrame:
    return q2_state_summary(q2).limit(n)


def q2_top_merchants(q2: DataFrame, state: int | None = None, n: int = 15) -> DataFrame:
    """The largest averages of a state; the leading state when none is chosen."""
    wanted = F.lit(state)
    if state is None:
        wanted = q2_state_summary(q2).limit(1).agg(F.max("State ID")).scalar()
    return (
        q2.dropna(subset=["State ID", "Average Amount"])
        .where(F.col("State ID") == wanted)
        .orderBy(F.col("Average Amount").desc(), F.col("Merchant").asc())
        .limit(n)
    )


# Question 3


def q3_overall_peak(q3: DataFrame) -> DataFrame:
    """The category and hour with the largest total."""
    return (
        q3.orderBy(F.col("total_amount").desc(), "category", "hour_of_day")
        .limit(1)
        .select("hour_of_day", "category", "total_amount")
    )


def q3_category(q3: DataFrame, category: str | None = None) -> DataFrame:
    return _chosen(q3, "category", category).orderBy("hour_of_day")


# Question 4


def q4_top_cities(q4: DataFrame, n: int = 10) -> DataFrame:
    return q4.orderBy(F.col("total_transactions").desc(), F.col("city_id").asc()).limit(n)


def q4_city_kpis(q4: DataFrame) -> DataFrame:
    return q4.agg(
        _best("City", "total_transactions", "city_id").alias("top_city"),
        F.max("total_transactions").alias("top_city_transactions"),
        F.sum("total_transactions").alias("all_transactions"),
    )


def q4_global_clean(top_global: DataFrame, n: int = 50) -> DataFrame:
    """The top merchants that have an id and a name."""
    return top_global.dropna(subset=["merchant_id", "merchant_name"]).orderBy("global_rank").limit(n)


def q4_distribution_clean(distribution: DataFrame) -> DataFrame:
    return distribution.dropna(subset=["primary_city_id", "City"]).orderBy(
        F.col("pct_of_top_k").desc(), F.col("primary_city_id").asc()
    )


def q4_local(popularity: DataFrame, city: str | None = None, n: int = 15) -> DataFrame:
    """The most popular merchants of one city."""
    return (
        _chosen(popularity, "City", city)
        .orderBy(F.col("transaction_count").desc(), F.col("popularity_rank").asc())
        .limit(n)
    )


# Question 5


def q5_kpis(advisory: DataFrame) -> DataFrame:
    """The city with most revenue, and the month with most."""
    city, month = F.col("section") == C.SECTION_CITIES, F.col("section") == C.SECTION_MONTHS

    def best(value: str, among: Column) -> Column:
        order = F.struct((-F.col("total_amount")).alias("a"), F.col("detail_key").alias("b"))
        return F.min_by(F.when(among, F.col(value)), F.when(among, order))

    return advisory.where(city | month).agg(
        best("detail_label", city).alias("best_city"),
        best("total_amount", city).alias("best_city_revenue"),
        best("avg_ticket", city).alias("best_city_avg_ticket"),
        best("detail_label", month).alias("peak_month"),
    )


def q5_pareto(advisory: DataFrame, n: int = 10) -> DataFrame:
    """The cities of the summary by revenue, each row adding its own share."""
    w = Window.partitionBy("section")
    by_revenue = w.orderBy(F.col("total_amount").desc(), F.col("detail_key").try_cast("int").asc())
    total = F.col("total_amount").cast(C.TOTALS)
    running = F.sum(total).over(by_revenue.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        section(advisory, C.SECTION_CITIES)
        .withColumn("cum_share_revenue", X.ratio(running, F.sum(total).over(w)))
        .select("detail_key", "detail_label", "transaction_count", "total_amount", "avg_ticket", "cum_share_revenue")
        .orderBy(F.col("total_amount").desc(), F.col("detail_key").try_cast("int").asc())
        .limit(n)
    )


def q5_categories(advisory: DataFrame, n: int = 4) -> DataFrame:
    """The leading categories with their segment."""
    return (
        section(advisory, C.SECTION_CATEGORIES)
        .select("detail_label", "segment", "transaction_count", "total_amount", "avg_ticket")
        .orderBy(F.col("total_amount").desc(), F.col("detail_label").asc())
        .limit(n)
    )


def q5_peak_hours(advisory: DataFrame) -> DataFrame:
    hours = section(advisory, C.SECTION_HOURS).withColumn("hour", F.col("detail_key").try_cast("int"))
    return hours.agg(
        _best("hour", "transaction_count", "hour").alias("peak_hour_by_volume"),
        _best("hour", "total_amount", "hour").alias("peak_hour_by_revenue"),
    )


def _of(mode: str, column: str) -> Column:
    return F.max(F.when(F.col("detail_label") == mode, F.col(column)))


def q5_profit_gap(advisory: DataFrame) -> DataFrame:
    with_profit, without_profit = _of(C.FINANCED, "expected_profit"), _of(C.NOT_FINANCED, "expected_profit")
    return section(advisory, C.SECTION_IMPACT).agg(
        with_profit.alias("profit_with"),
        without_profit.alias("profit_without"),
        (with_profit - without_profit).alias("profit_gap"),
    )


def q5_city_focus(advisory: DataFrame, city: str | None = None) -> DataFrame:
    """Financing modes of one city of the summary."""
    rows = section(advisory, C.SECTION_FINANCING_BY_CITY).withColumn(
        "city_id", F.element_at(F.split("detail_key", r"\|"), 1)
    )
    return _chosen(rows, "city_id", city).select(
        "city_id", "detail_label", "transaction_count", "total_amount", "expected_revenue", "expected_profit"
    )


def q5_transaction_sample(q5: DataFrame, n: int = 500) -> DataFrame:
    """Some transactions, for a look at them: those of the largest amounts, in a fixed order."""
    return q5.orderBy(F.desc_nulls_last("amount"), *[F.asc(c) for c in ("merchant_name", "category", "city_id", "installments")]).limit(n)


def month_over_month(advisory: DataFrame) -> DataFrame:
    """Revenue per month and its change against the month before, in percent."""
    before = F.lag("total_amount").over(Window.partitionBy("section").orderBy("detail_key"))
    return (
        section(advisory, C.SECTION_MONTHS)
        .where(F.col("detail_key").isNotNull())
        .withColumn("_before", before)
        .select(
            F.col("detail_key").alias("month"),
            "total_amount",
            ((X.ratio(F.col("total_amount"), F.col("_before")) - 1.0) * 100.0).alias("change_pct"),
        )
        .orderBy("month")
    )


def pareto_cut(advisory_cells: DataFrame, share: float = 0.8) -> DataFrame:
    """Revenue share of the 5 and 10 largest of all cities, and how many cities make up ``share``."""
    cities = (
        advisory_cells.where(F.col("is_party") & F.col("city_id").isNotNull())
        .groupBy("city_id")
        .agg(X.sum_of_totals(F.col("total")).alias("total"))
    )
    # Cities of equal revenue follow each other by number.
    ranked = scan.prefix_scan(cities, [], ["-total", "city_id"], {"upto": F.col("total")})

    def top(n: int) -> Column:
        return X.ratio(F.sum(F.when(F.col(scan.BEFORE) < n, F.col("total"))), F.max("whole_upto"))

    below = X.ratio(F.col("upto") - F.coalesce("total", F.lit(0)), F.col("whole_upto")) < share
    return ranked.agg(
        top(5).alias("top_5_share"), top(10).alias("top_10_share"), F.count_if(below).alias("cities_for_share")
    )


def installment_gap(advisory: DataFrame) -> DataFrame:
    """Does financing raise the ticket, and what does it cost in margin?"""
    uplift = X.ratio(_of(C.FINANCED, "avg_ticket"), _of(C.NOT_FINANCED, "avg_ticket")) - 1.0

    def margin(mode: str) -> Column:
        return X.ratio(_of(mode, "expected_profit"), _of(mode, "total_amount"))

    return section(advisory, C.SECTION_IMPACT).agg(
        (uplift * 100.0).alias("ticket_uplift_pct"),
        ((margin(C.FINANCED) - margin(C.NOT_FINANCED)) * 100.0).alias("margin_gap_pp"),
    )


def city_profit_delta(advisory: DataFrame) -> DataFrame:
    """Expected profit with minus without financing per city, largest first."""

    def profit(mode: str) -> Column:
        mine = F.split("detail_key", r"\|")[1] == mode
        return F.coalesce(F.max(F.when(mine, F.col("expected_profit"))), F.lit(0.0))

    return (
        section(advisory, C.SECTION_FINANCING_BY_CITY)
        .groupBy(F.col("segment").try_cast("int").alias("city_id"))
        .agg((profit(C.FINANCED) - profit(C.NOT_FINANCED)).alias("profit_delta"))
        .orderBy(F.col("profit_delta").desc(), F.col("city_id").asc())
    )
