"""Gold questions on small hand-made Silver tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake.plans import advisor, cities, questions, reports
from merchantlake.registry import queries

SILVER = (
    "merchant_id string, amount double, category string, purchase_ts timestamp_ntz, city_id int, state_id int, "
    "installments int, merchant_name string"
)
JAN, FEB = dt.datetime(2017, 1, 31, 23, 59), dt.datetime(2017, 2, 1, 0, 0)


def row(name="n", amount=1.0, category="A", ts=JAN, city=1, state=1, installments=0, key=None):
    return (key or f"id-{name}", amount, category, ts, city, state, installments, name)


@pytest.fixture
def silver(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SILVER)


@pytest.fixture
def advisory(silver):
    def make(*rows, **options):
        return advisor.advisory_summary(advisor.advisory_cells(silver(*rows)), **options)

    return make


def section(df, name):
    return {r.detail_key: r for r in df.where(F.col("section") == name).collect()}


# Question 1


def test_q1_keeps_five_and_breaks_ties_by_name(silver, rows):
    data = [row(name, 10.0) for name in "fedcba"] + [row("z", 20.0)]
    out = [r.Merchant for r in questions.top_merchants(silver(*data)).collect()]
    assert out == ["z", "a", "b", "c", "d"]


def test_q1_merges_ids_that_share_a_name(silver):
    out = questions.top_merchants(silver(row("same", 1.5, key="m1"), row("same", 2.25, key="m2"))).collect()
    assert [tuple(r) for r in out] == [("2017-01", "City_1", "same", 3.75, 2)]


def test_q1_null_city_month_and_name_are_groups(silver):
    data = [row(None, 1.0, ts=None, city=None), row(None, 2.0, ts=None, city=None), row("n", 9.0, ts=FEB)]
    out = [tuple(r) for r in questions.top_merchants(silver(*data)).collect()]
    assert out == [(None, None, None, 3.0, 2), ("2017-02", "City_1", "n", 9.0, 1)]


def test_q1_sums_cents_exactly_in_any_order(silver, spark):
    data = [row("n", 0.1) for _ in range(1000)] + [row("n", 1e9), row("n", -1e9)]
    one = questions.top_merchants(silver(*data)).first()["Purchase Total"]
    other = questions.top_merchants(silver(*data[::-1]).repartition(7)).first()["Purchase Total"]
    assert one == other == 100.0


# Questions 2 and 3


def test_q2_average_ignores_null_amounts(silver):
    data = [row("a", 1.0), row("a", 4.0), row("a", None), row("b", None), row("c", 9.0, state=-1)]
    out = [tuple(r) for r in questions.average_by_state(silver(*data)).collect()]
    assert out == [("c", -1, 9.0), ("a", 1, 2.5), ("b", 1, None)]


def test_q3_three_hours_tie_earliest_first(silver):
    data = [row(ts=dt.datetime(2017, 1, 1, h), amount=5.0) for h in (9, 7, 8, 6)]
    data.append(row(ts=dt.datetime(2017, 1, 2, 23), amount=50.0))
    out = [tuple(r) for r in questions.peak_hours(silver(*data)).collect()]
    assert out == [("A", 2300, 50.0, 23), ("A", 600, 5.0, 6), ("A", 700, 5.0, 7)]


# Question 4


def test_q4_counts_distinct_ids_without_null(silver):
    data = [row("a"), row("a", category="B"), row("b"), (None, 1.0, "A", JAN, 1, 1, 0, None), row("c", city=None)]
    out = [tuple(r) for r in cities.city_metrics(cities.count_cells(silver(*data))).collect()]
    assert out == [(1, 4, 2, 2, "City_1")]


def test_q4_primary_city_is_the_busiest_then_the_lowest(silver):
    data = [row("a", city=c) for c in (9, 9, 3, 3, 5)] + [row("b", city=4)] + [(None, 1.0, "A", JAN, 2, 1, 0, None)] * 9
    top = cities.top_merchants_global(cities.count_cells(silver(*data)), k=5)
    assert [tuple(r) for r in top.collect()] == [
        (1, None, None, 9, None, None, None, 1),
        (2, "id-a", "a", 5, 3, "City_3", 2, 3),
        (3, "id-b", "b", 1, 4, "City_4", 1, 1),
    ]
    without = cities.top_merchants_global(cities.count_cells(silver(*data)), k=5, exclude_null_merchant=True)
    assert [r.merchant_id for r in without.collect()] == ["id-a", "id-b"]
    spread = cities.top_merchants_distribution(top).collect()
    assert [(r.primary_city_id, r.n_top_merchants_in_top_k, r.pct_of_top_k) for r in spread] == [
        (None, 1, 1.0), (3, 1, 1.0), (4, 1, 1.0),
    ]


def test_q4_popularity_ranks_five_per_city(silver):
    data = [row(n) for n in "gfedcba"] + [row("g")]
    out = cities.merchant_popularity(cities.count_cells(silver(*data))).collect()
    assert [(r.merchant_name, r.transaction_count, r.popularity_rank) for r in out] == [
        ("g", 2, 1), ("a", 1, 2), ("b", 1, 3), ("c", 1, 4), ("d", 1, 5),
    ]


def test_q4_results_do_not_depend_on_how_fine_the_cells_are(silver, rows):
    data = [row("abc"[i % 3], category="XYZ"[i % 2], city=i % 4 or None) for i in range(60)]
    fine = cities.count_cells(silver(*data))
    for keys, plan in [
        (("city_id", "merchant_id", "category"), cities.city_metrics),
        (("city_id", "merchant_id", "merchant_name"), cities.top_merchants_global),
        (("city_id", "merchant_id", "merchant_name"), cities.merchant_popularity),
    ]:
        assert rows(plan(fine)) == rows(plan(cities.count_cells(silver(*data), *keys)))


def test_q4_association_needs_fifty_transactions(silver):
    data = [row(city=1, category=c) for c in "AB" * 25] + [row(city=2, category="A")] * 49
    out = cities.city_category_association(cities.count_cells(silver(*data))).first()
    assert math.isnan(out[0]) and tuple(out)[1:] == ("cramers_v_city_x_category_global", 50)


# Question 5


@pytest.mark.parametrize("amount, recommended", [(None, False), (-1.0, False), (0.0, True), (7.0, True)])
def test_q5_recommends_for_every_amount_that_is_not_negative(silver, amount, recommended):
    assert advisor.expected_values(silver(row(amount=amount))).first().installments_recommended is recommended


def test_q5_expected_values(silver):
    out = advisor.expected_values(silver(row(amount=1000.0, installments=3))).first()
    assert out.expected_profit_installments == pytest.approx(221.375)
    assert out.expected_profit_no_installments == 250.0
    assert out.expected_profit_delta_installments == pytest.approx(-28.625)
    assert out.expected_profit_margin == pytest.approx(0.221375, abs=1e-7)
    assert out.risk_score == pytest.approx(0.229, abs=1e-7)
    assert out.assumptions == list(C.ASSUMPTIONS)


@pytest.mark.parametrize("installments, flag", [(1, C.FINANCED), (0, C.NOT_FINANCED), (-1, C.NOT_FINANCED), (None, C.NOT_FINANCED)])
def test_q5_flag(silver, installments, flag):
    assert advisor.expected_values(silver(row(installments=installments))).first().installments_flag == flag


def test_q5_equal_totals_share_a_running_share(advisory):
    months = [(JAN, 10.0), (FEB, 10.0), (dt.datetime(2017, 3, 1), 5.0)]
    out = section(advisory(*[row(ts=t, amount=a) for t, a in months]), C.SECTION_MONTHS)
    assert [out[m].cumulative_share for m in ("2017-01", "2017-02", "2017-03")] == [0.8, 0.8, 1.0]
    assert out["2017-03"].share_of_total == 0.2


def test_q5_city_shares_are_of_the_cities_kept(advisory):
    data = [row(city=c, amount=float(c)) for c in (1, 2, 3)]
    out = section(advisory(*data, top_cities=2), C.SECTION_CITIES)
    assert set(out) == {"3", "2"}
    assert out["3"].share_of_total == 0.6 and out["2"].cumulative_share == 1.0


def test_q5_equal_scores_keep_the_lowest_city_numbers(advisory):
    out = section(advisory(*[row(city=c) for c in (10, 9, 2, 30)], top_cities=2), C.SECTION_CITIES)
    assert set(out) == {"2", "9"}


def test_q5_published_categories_get_their_segments(spark):
    """Counts and tickets as published for the full data set."""
    published = [("A", 3851127, 20103.29), ("B", 2918862, 20096.96), ("C", 459753, 20115.66), (C.UNKNOWN_CATEGORY, 44625, 20151.34)]
    base = spark.createDataFrame(published, "part string, n long, avg_ticket double")
    base = base.withColumns({"section": F.lit(C.SECTION_CATEGORIES), "total": (F.col("n") * F.col("avg_ticket")).cast(C.TOTALS)})
    segment = advisor.volume_value_segment(F.col("volume_quarter"), F.col("ticket_quarter"))
    assert {r[0]: r[1] for r in advisor.standings(base).select("part", segment).collect()} == {
        "A": "high_volume", "B": "balanced", "C": "balanced", C.UNKNOWN_CATEGORY: "high_value",
    }


def test_q5_financing_sections(advisory):
    data = [row(amount=68.81e9, installments=2), row(amount=10.0, city=None, category="B")]
    out = advisory(*data)
    overall = section(out, C.SECTION_FINANCING)
    assert overall[C.FINANCED].expected_revenue == pytest.approx(60.93e9, rel=1e-4)
    assert overall[C.FINANCED].expected_profit == pytest.approx(15.23e9, rel=1e-3)
    assert overall[C.NOT_FINANCED].expected_profit == 2.5
    impact = section(out, C.SECTION_IMPACT)
    assert {k: tuple(v)[1:] for k, v in impact.items()} == {k: tuple(v)[1:] for k, v in overall.items()}
    assert set(section(out, C.SECTION_FINANCING_BY_CATEGORY)) == {"A|with_installments", "B|without_installments"}
    by_city = section(out, C.SECTION_FINANCING_BY_CITY)
    assert {k: (v.detail_label, v.segment, v.cumulative_share) for k, v in by_city.items()} == {
        "1|with_installments": ("City_1 | with_installments", "1", None)
    }


def test_q5_zero_total_gives_null_shares(advisory):
    out = section(advisory(row(amount=0.0)), C.SECTION_MONTHS)["2017-01"]
    assert out.share_of_total is None and out.cumulative_share is None and out.avg_ticket == 0.0


def test_empty_silver_gives_empty_results(silver, advisory):
    empty = silver()
    cells = cities.count_cells(empty)
    for df in (
        questions.top_merchants(empty),
        questions.average_by_state(empty),
        questions.peak_hours(empty),
        cities.city_metrics(cells),
        cities.top_merchants_global(cells),
        cities.top_merchants_distribution(cities.top_merchants_global(cells)),
        cities.merchant_popularity(cells),
        advisor.expected_values(empty),
        advisory(),
    ):
        assert df.isEmpty()
    assert math.isnan(cities.city_category_association(cells).first()[0])


# Reports


def test_reports_with_a_choice(silver, advisory):
    data = [row(n, a, ts=t, city=c) for n, a, t, c in [("a", 5.0, JAN, 1), ("b", 9.0, JAN, 1), ("c", 1.0, FEB, 2)]]
    q1 = questions.top_merchants(silver(*data))
    assert [r.Merchant for r in reports.q1_focus(q1, "2017-01", "City_1", 3).collect()] == ["b", "a"]
    assert [tuple(r) for r in reports.q1_city_trend(q1, "City_2").collect()] == [("2017-02", 1.0)]
    assert reports.q1_months(q1, ["2017-02"]).count() == 1
    q2 = questions.average_by_state(silver(*data, row("u", 99.0, state=-1)))
    assert [r["State ID"] for r in reports.q2_state_summary(q2).collect()] == [1]
    assert [r["State ID"] for r in reports.q2_state_summary(q2, exclude_unknown=False).collect()] == [-1, 1]
    assert [r.Merchant for r in reports.q2_top_merchants(q2, -1).collect()] == ["u"]
    q3 = questions.peak_hours(silver(*data))
    assert reports.q3_category(q3, "none").isEmpty()
    summary = advisory(*data)
    assert reports.q5_city_focus(summary, "2").first().detail_label == "City_2 | without_installments"


def test_month_over_month(advisory):
    out = reports.month_over_month(advisory(row(amount=10.0), row(amount=12.0, ts=FEB))).collect()
    assert [(r.month, r.change_pct and round(r.change_pct, 9)) for r in out] == [("2017-01", None), ("2017-02", 20.0)]


def test_pareto_cut_uses_all_cities(silver):
    data = [row(city=c, amount=a) for c, a in enumerate([50.0, 20.0, 10.0, 10.0, 5.0, 5.0])]
    out = reports.pareto_cut(advisor.advisory_cells(silver(*data))).first()
    assert (out.top_5_share, out.top_10_share, out.cities_for_share) == (0.95, 1.0, 3)


def test_margin_gap(advisory):
    out = reports.installment_gap(advisory(row(amount=100.0, installments=1), row(amount=200.0))).first()
    assert out.ticket_uplift_pct == -50.0 and out.margin_gap_pp == pytest.approx(-2.8625)


@pytest.mark.parametrize("plan", ["q1_top_merchants", "q5_advisory_summary", "q4_top_merchants_global"])
def test_row_order_does_not_matter(spark, sf_dir, rows, plan, monkeypatch):
    from merchantlake.registry import queries
    from merchantlake.sources import standin

    expected = rows(queries.QUERIES[plan](spark, sf_dir))
    ordered = standin.table
    monkeypatch.setattr(standin, "table", lambda *a: ordered(*a).orderBy(F.rand(7)).repartition(5))
    assert rows(queries.QUERIES[plan](spark, sf_dir)) == expected


@pytest.mark.parametrize(
    "amounts, total",
    [
        ([0.1] * 10, 1.0),
        ([-0.1, -0.2, -5.75], -6.05),
        ([0.99996, 0.00004], 1.0),
        ([0.00004] * 100, 0.004),
        ([-0.70333091, 0.00000001, -0.00000002], -0.70333092),
        ([1e15, 0.25, -1e15], 0.25),
        ([123456789.12345678, 0.00000001], 123456789.12345679),
        ([99.9999, None], 99.9999),
        ([None], None),
    ],
)
def test_money_is_added_exactly(spark, amounts, total):
    from merchantlake.functions import columns as X

    df = spark.createDataFrame([(a,) for a in amounts], "amount double").repartition(3)
    assert df.agg(X.money_sum(F.col("amount")).alias("s")).first().s == total


@pytest.mark.parametrize("digits", [0, 2, 4, 6, 10])
def test_digits_are_a_parameter(spark, digits):
    from decimal import Decimal

    from merchantlake.functions import columns as X

    values = [round(k * 1.37 - 90, digits) for k in range(200)]
    expected = sum(Decimal(str(v)) for v in values)
    got = spark.createDataFrame([(v,) for v in values], "amount double").agg(X.exact_sum(F.col("amount"), digits).alias("s")).first().s
    assert got == expected and -got.as_tuple().exponent == digits


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), 1e19, 0.123456789, 1 / 3])
def test_money_that_is_no_number_is_an_error(spark, amount):
    from pyspark.errors import PySparkException

    from merchantlake.functions import columns as X

    with pytest.raises(PySparkException):
        spark.createDataFrame([(amount,)], "amount double").agg(X.money_sum(F.col("amount"))).collect()


def test_timestamps_may_be_text(spark, silver, rows):
    data = [row("a", 2.0, ts=dt.datetime(2017, 3, 4, 5, 6)), row("b", 3.0, ts=dt.datetime(2017, 12, 31, 23, 0))]
    typed = silver(*data)
    text = typed.withColumn("purchase_ts", F.col("purchase_ts").cast("string"))
    zoned = typed.withColumn("purchase_ts", F.col("purchase_ts").cast("timestamp"))
    for other in (text, zoned):
        assert rows(questions.top_merchants(other)) == rows(questions.top_merchants(typed))
        assert rows(questions.peak_hours(other)) == rows(questions.peak_hours(typed))
        assert rows(advisor.advisory_cells(other)) == rows(advisor.advisory_cells(typed))


def test_cells_are_counted_before_they_get_names(spark, sf_dir, rows):
    """The same cells as from Silver, and no join with names where no name is asked for."""
    found = queries._cells(spark, sf_dir, *queries.MERCHANT_CELL)
    expected = cities.count_cells(queries._silver(spark, sf_dir), *queries.MERCHANT_CELL)
    assert rows(found, *expected.columns) == rows(expected)
    plain = queries._cells(spark, sf_dir, "city_id", "merchant_id", "category")
    assert "part.parquet" not in "".join(plain.inputFiles()) and rows(plain) == rows(
        cities.count_cells(queries._silver(spark, sf_dir), "city_id", "merchant_id", "category")
    )


def test_cities_are_the_same_from_cells_of_merchants_and_of_categories(spark, sf_dir, rows):
    silver = queries._silver(spark, sf_dir)
    merchants, categories = (cities.count_cells(silver, *keys) for keys in (cities.MERCHANT_CELL, cities.CATEGORY_CELL))
    assert rows(cities.city_metrics(merchants, categories)) == rows(cities.city_metrics(cities.count_cells(silver)))
