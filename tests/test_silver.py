"""Resolution of repeated merchants, cleaning and the contract."""

import pytest
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.plans import silver

MERCHANT = (
    "merchant_id string, merchant_name string, most_recent_sales_range string, most_recent_purchases_range string, "
    "active_months_lag12 long, active_months_lag6 long, active_months_lag3 long, avg_purchases_lag12 double"
)


CRITERIA = ["most_recent_sales_range", "most_recent_purchases_range", "active_months_lag12", "active_months_lag6", "active_months_lag3", "avg_purchases_lag12"]
MIDDLE = {"most_recent_sales_range": "D", "most_recent_purchases_range": "B", "active_months_lag12": 7, "active_months_lag6": 4,
          "active_months_lag3": 2, "avg_purchases_lag12": 31.25}
#: For each criterion, values from best to worst; a value without a rank or a null is worst.
LADDERS = {
    "most_recent_sales_range": ["A", " b ", "c", "D", "E", "?"],
    "most_recent_purchases_range": ["a", "B", "E", None],
    "active_months_lag12": [11, 8, 0, None],
    "active_months_lag6": [6, 5, -1, None],
    "active_months_lag3": [3, 1, None],
    "avg_purchases_lag12": [float("inf"), 70.5, -0.25, None],
}


def merchant(key, name, **changes):
    return (key, name, *{**MIDDLE, **changes}.values())


def winner(df, key="shop"):
    return silver.resolve_merchants(df).where(F.col("merchant_id") == key).collect()[0]


@pytest.mark.parametrize("place, criterion", list(enumerate(CRITERIA)))
def test_each_criterion_decides_before_all_later_ones(spark, place, criterion):
    ladder = LADDERS[criterion]
    best_of = {c: LADDERS[c][0] for c in CRITERIA[place + 1 :]}
    worst_of = {c: LADDERS[c][-1] for c in CRITERIA[place + 1 :]}
    for better, worse in zip(ladder, ladder[1:]):
        pair = [merchant("shop", "zeta", **{criterion: better}, **worst_of), merchant("shop", "alpha", **{criterion: worse}, **best_of)]
        for data in (pair, pair[::-1]):
            assert winner(spark.createDataFrame(data, MERCHANT)).merchant_name == "zeta", (better, worse)


def test_the_name_decides_next_and_then_the_remaining_columns(spark):
    named = spark.createDataFrame([merchant("shop", n) for n in (None, "pear", "fig")], MERCHANT)
    assert winner(named).merchant_name == "fig"
    placed = spark.createDataFrame([(*merchant("shop", "fig"), c) for c in (12, 4, None)], MERCHANT + ", city_id int")
    assert {winner(placed.orderBy(o)).city_id for o in (F.asc("city_id"), F.desc("city_id"))} == {4}


def test_tables_without_ranges_go_by_activity(spark):
    data = [merchant("shop", "quiet", active_months_lag12=3), merchant("shop", "busy", most_recent_sales_range="E", active_months_lag12=9)]
    bare = spark.createDataFrame(data, MERCHANT).drop(*CRITERIA[:2])
    assert winner(bare).merchant_name == "busy"


def test_audit_has_all_rows_of_repeated_ids(spark, rows):
    data = [merchant("twice", f"t{k}", active_months_lag12=k) for k in (4, 9)]
    data += [merchant("thrice", "same")] * 3 + [merchant("once", "o"), merchant(None, "x"), merchant(None, "y")]
    df = spark.createDataFrame(data, MERCHANT)
    assert rows(silver.audit_duplicates(df), "merchant_id", "merchant_name", "resolution_rank", "is_resolved_winner") == [
        ("thrice", "same", 1, True), ("thrice", "same", 2, False), ("thrice", "same", 3, False), ("twice", "t4", 2, False), ("twice", "t9", 1, True),
    ]
    resolved = silver.resolve_merchants(df)
    assert rows(resolved.groupBy("merchant_id").count()) == rows(df.select("merchant_id").distinct().withColumn("n", F.lit(1)))


def test_audit_of_a_hot_id_with_copies_equals_a_plain_numbering(spark, rows):
    from pyspark.sql import Window

    letters = F.element_at(F.array(*map(F.lit, "ABCDEz")), (F.col("id") % 6 + 1).cast("int"))
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 500)).alias("merchant_id"),
        F.concat(F.lit("n"), F.col("id") % 40).alias("merchant_name"),
        letters.alias("most_recent_sales_range"),
        letters.alias("most_recent_purchases_range"),
        (F.col("id") % 13).alias("active_months_lag12"),
        F.lit(1).alias("active_months_lag6"),
        F.lit(None).cast("int").alias("active_months_lag3"),
        (F.col("id") % 7).cast("double").alias("avg_purchases_lag12"),
    )
    df = df.union(df.where("merchant_id = 'hot'"))
    by_id = Window.partitionBy("merchant_id")
    plain = df.withColumn("resolution_rank", F.row_number().over(by_id.orderBy(*silver.resolution_order(df))))
    plain = plain.withColumn("n", F.count(F.lit(1)).over(by_id)).where("n > 1").drop("n")
    assert rows(silver.audit_duplicates(df)) == rows(plain.withColumn("is_resolved_winner", F.col("resolution_rank") == 1))


def test_names_and_categories_are_filled(spark, rows):
    sales = [("known", 4.5, None), ("stranger", 0.5, "toys"), (None, 8.0, ""), ("unnamed", 1.0, "food")]
    tx = spark.createDataFrame(sales, "merchant_id string, amount double, category string")
    names = spark.createDataFrame([("known", "Corner Shop"), ("unnamed", None), (None, "nobody")], "merchant_id string, merchant_name string")
    out = silver.enrich(tx, names)
    assert out.columns == ["merchant_id", "amount", "category", "merchant_name"]
    filled = {r.merchant_id: (r.category, r.merchant_name) for r in out.collect()}
    assert filled == {
        "known": (C.UNKNOWN_CATEGORY, "Corner Shop"), "stranger": ("toys", "stranger"), None: ("", None), "unnamed": ("food", "unnamed"),
    }


def test_synonyms_get_contract_names(spark):
    tx = spark.sql("select 'a' merchant_id, date'2018-07-02' purchase_date, 12.75 purchase_amount, 'toys' category")
    out = silver.enrich(tx, spark.createDataFrame([("a", "b")], "merchant_id string, merchant_name string"))
    assert {"purchase_ts", "amount"} <= set(out.columns) and not {"purchase_date", "purchase_amount"} & set(out.columns)


def test_canonical_column_wins_over_its_synonym(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "amount double, purchase_amount double")
    assert silver.conform(df).columns == ["amount", "purchase_amount"]
    assert silver.conform(df).first().amount == 1.0


def test_contract_names_what_is_wrong(spark):
    df = spark.createDataFrame([("m", 1.0)], "merchant_id string, amount double")
    with pytest.raises(C.ContractError, match="purchase_ts"):
        C.assert_contract(df, C.SILVER, "silver")
    with pytest.raises(C.ContractError, match="amount is string"):
        C.assert_contract(df.withColumn("amount", F.lit("x")), C.SILVER, "silver")


def test_row_count_is_kept(spark, sf_dir):
    from merchantlake.registry.queries import QUERIES

    assert QUERIES["enriched_transactions"](spark, sf_dir).count() == 6000
