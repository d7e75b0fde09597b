"""Gold question 5: installments per transaction, and the advisory summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.functions import columns as X
from merchantlake.operators import scan
from merchantlake.operators.reuse import store

PER_CITY = (C.SECTION_CITIES, C.SECTION_FINANCING_BY_CITY)
FINANCING_SECTIONS = (
    C.SECTION_FINANCING,
    C.SECTION_IMPACT,
    C.SECTION_FINANCING_BY_CATEGORY,
    C.SECTION_FINANCING_BY_CITY,
)
SECTIONS = (C.SECTION_CITIES, C.SECTION_CATEGORIES, C.SECTION_MONTHS, C.SECTION_HOURS, *FINANCING_SECTIONS)


def expected_values(silver: DataFrame) -> DataFrame:
    """Q5 per transaction: expected revenue and profit with and without installments."""
    amount = F.col("amount")
    with_profit, without_profit = X.financed_profit(amount), X.single_payment_profit(amount)
    return silver.select(
        "merchant_name",
        "category",
        "city_id",
        "amount",
        "installments",
        X.financing(X.is_financed(F.col("installments"))).alias("installments_flag"),
        X.financed_revenue(amount).alias("expected_revenue_installments"),
        with_profit.alias("expected_profit_installments"),
        without_profit.alias("expected_profit_no_installments"),
        (with_profit - without_profit).alias("expected_profit_delta_installments"),
        X.installments_recommended(amount).alias("installments_recommended"),
        F.lit(C.EXPECTED_MARGIN).cast("float").alias("expected_profit_margin"),
        F.lit(C.DEFAULT_RATE).cast("float").alias("risk_score"),
        F.array(*map(F.lit, C.ASSUMPTIONS)).alias("assumptions"),
    )


def advisory_cells(silver: DataFrame) -> DataFrame:
    """Count and exact total per (city, category, financing) and per (month, hour).

    Two small grouping sets instead of one per section: each task reduces its
    rows to a few thousand cells, whatever it read, and one scan serves all sections.
    """
    keyed = silver.select(
        "city_id",
        "category",
        X.is_financed(F.col("installments")).alias("financed"),
        *X.month_keys(F.col("purchase_ts")),
        X.hour_of(F.col("purchase_ts")).alias("hour"),
        "amount",
    )
    party, time = ["city_id", "category", "financed"], ["year", "month", "hour"]
    return keyed.groupingSets([party, time], *party, *time).agg(
        (F.grouping("month") == 1).alias("is_party"),
        F.count(F.lit(1)).alias("n"),
        X.exact_sum(F.col("amount")).alias("total"),
    )


def _section_rows(cells: DataFrame) -> DataFrame:
    """Every cell goes to the sections it belongs to, keyed by (section, part, flag)."""

    def row(section: str, part: Column | None, flag: Column | None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            F.lit(section).alias("section"),
            (none if part is None else part).alias("part"),
            (none if flag is None else flag).alias("flag"),
        )

    city, category, flag = F.col("city_id").cast("string"), F.col("category"), X.financing(F.col("financed"))
    party = F.array(
        row(C.SECTION_CITIES, city, None),
        row(C.SECTION_CATEGORIES, category, None),
        row(C.SECTION_FINANCING, None, flag),
        row(C.SECTION_IMPACT, None, flag),
        row(C.SECTION_FINANCING_BY_CATEGORY, category, flag),
        row(C.SECTION_FINANCING_BY_CITY, city, flag),
    )
    time = F.array(
        row(C.SECTION_MONTHS, X.month_label(F.col("year"), F.col("month")), None),
        row(C.SECTION_HOURS, F.col("hour").cast("string"), None),
    )
    return (
        cells.select(F.inline(F.when(F.col("is_party"), party).otherwise(time)), "n", "total")
        .where(~F.col("section").isin(*PER_CITY) | F.col("part").isNotNull())
        .groupBy("section", "part", "flag")
        .agg(F.sum("n").alias("n"), X.sum_of_totals(F.col("total")).alias("total"))
    )


def city_score(volume: Column, revenue: Column, ticket: Column) -> Column:
    """Weighted percentile ranks."""
    a, b, c = C.SCORE_WEIGHTS
    return F.lit(a) * volume + F.lit(b) * revenue + F.lit(c) * ticket


def volume_value_segment(by_volume: Column, by_ticket: Column) -> Column:
    """Which quarter is a row in, by volume and by ticket?"""
    return (
        F.when((by_volume == 1) & (by_ticket > 2), F.lit("high_volume"))
        .when((by_ticket == 1) & (by_volume > 2), F.lit("high_value"))
        .otherwise(F.lit("balanced"))
    )


def standings(base: DataFrame) -> DataFrame:
    """Percentile ranks of cities and quarters of categories, by (section, part), in one scan of all measures.

    A measure is a number or a decimal; cities rise by it, and share a rank when equal. Categories fall by it, so there
    its negative rises, with missing ones last, and their names decide between equal ones.
    """

    def measure(name: str, exact: Column | None, number: Column | None, tie: Column | None) -> Column:
        value = exact if number is None else number
        return F.struct(
            F.lit(name).alias("measure"),
            (F.lit(False) if tie is None else value.isNull()).alias("missing"),
            (F.lit(None) if exact is None else exact).cast(C.TOTALS).alias("exact"),
            (F.lit(None) if number is None else number).cast("double").alias("number"),
            (F.lit(None) if tie is None else tie).cast("string").alias("tie"),
        )

    n, total, ticket, part = F.col("n"), F.col("total"), F.col("avg_ticket"), F.col("part")
    cities = F.array(measure("volume", n, None, None), measure("revenue", total, None, None), measure("ticket", None, ticket, None))
    categories = F.array(measure("volume", -n, None, part), measure("ticket", None, -ticket, part))
    is_cities = F.col("section") == C.SECTION_CITIES
    long = base.where(F.col("section").isin(C.SECTION_CITIES, C.SECTION_CATEGORIES)).select(
        "section", "part", F.inline(F.when(is_cities, cities).otherwise(categories))
    )
    order = ["missing", "exact", "number", "tie"]
    ranked = scan.looked_up(long, scan.prefix_scan(long, ["section", "measure"], order), ["section", "measure", *order])

    def of(name: str, value: Column) -> Column:
        return F.max(F.when(F.col("measure") == name, value))

    return ranked.groupBy("section", "part").agg(
        *[of(name, scan.percent_rank()).alias(f"{name}_rank") for name in ("volume", "revenue", "ticket")],
        *[of(name, scan.ntile(4)).alias(f"{name}_quarter") for name in ("volume", "ticket")],
    )


def advisory_summary(cells: DataFrame, top_cities: int = C.TOP_CITIES) -> DataFrame:
    """All sections of the advisory in one plan.

    A section has a row for each city, category, month, hour or financing mode, by then, never for each transaction. Ranks and
    running sums are scanned slice by slice, so that no task sorts a section, however many cities there are.
    """
    section, part, flag = F.col("section"), F.col("part"), F.col("flag")
    is_cities, is_categories = section == C.SECTION_CITIES, section == C.SECTION_CATEGORIES
    is_financing = section.isin(*FINANCING_SECTIONS)
    is_split = section.isin(C.SECTION_FINANCING_BY_CATEGORY, C.SECTION_FINANCING_BY_CITY)

    base = store(_section_rows(cells).withColumn("avg_ticket", X.ratio(F.col("total"), F.col("n"))), "sections")
    standing = scan.looked_up(base, standings(base), ["section", "part"], "left")
    score = city_score(F.col("volume_rank"), F.col("revenue_rank"), F.col("ticket_rank"))
    scored = standing.select(
        *base.columns,
        F.when(is_cities, score).otherwise(F.col("total").cast("double")).alias("_order"),
        volume_value_segment(F.col("volume_quarter"), F.col("ticket_quarter")).alias("_segment"),
    )
    # Shares of the city section are of the cities kept here.
    leading = scored.where(is_cities).orderBy(F.col("_order").desc(), part.try_cast("int")).limit(top_cities)
    # What is left has a row for each kept city, category, month, hour and mode; rows with equal order share one running total.
    per_section = Window.partitionBy("section")
    falling = per_section.orderBy(F.col("_order").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    few = scored.where(~is_cities & ~is_split).unionByName(leading)
    few = few.withColumns({"_whole": F.sum("total").over(per_section), "_upto": F.sum("total").over(falling)})
    # Sections split by a flag can have a row for each city: their totals are added up in parts, and nothing runs.
    wholes = base.where(is_split).groupBy("section").agg(F.sum("total").alias("_whole"))
    split = scored.where(is_split).join(F.broadcast(wholes), "section").withColumn("_upto", F.lit(None).cast(few.schema["_upto"].dataType))
    kept = few.unionByName(split)
    whole, running = F.col("_whole"), F.col("_upto")
    total = F.col("total").cast("double")
    financed = flag == C.FINANCED
    revenue = F.when(financed, X.financed_revenue(total)).otherwise(total)
    profit = F.when(financed, X.financed_profit(total)).otherwise(X.single_payment_profit(total))
    by_city, by_category = section == C.SECTION_FINANCING_BY_CITY, section == C.SECTION_FINANCING_BY_CATEGORY
    notes = F.coalesce(*[F.when(section == s, F.lit(note)) for s, note in C.SECTION_NOTES.items()])
    return kept.select(
        "section",
        F.when(is_financing, F.concat_ws("|", part, flag)).otherwise(part).alias("detail_key"),
        F.when(is_cities, F.concat(F.lit(C.CITY_PREFIX), part))
        .when(by_city, F.concat(F.lit(C.CITY_PREFIX), part, F.lit(" | "), flag))
        .when(is_financing, F.concat_ws(" | ", part, flag))
        .otherwise(part)
        .alias("detail_label"),
        F.col("n").alias("transaction_count"),
        total.alias("total_amount"),
        "avg_ticket",
        F.when(is_financing, revenue).alias("expected_revenue"),
        F.when(is_financing, profit).alias("expected_profit"),
        X.ratio(F.col("total"), whole).alias("share_of_total"),
        F.when(~is_split, X.ratio(running, whole)).alias("cumulative_share"),
        F.when(is_categories, F.col("_segment")).when(by_city | by_category, part).alias("segment"),
        notes.alias("extra_note"),
    )
