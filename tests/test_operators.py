"""Operators against plain ways of computing the same, with hot keys and copies."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from merchantlake.operators.association import cramers_v
from merchantlake.operators.joins import lookup_join
from merchantlake.operators.rank import number_rows, top_n
from merchantlake.operators.stored_order import order_breaks, with_file_position, with_output_position


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has one key, a third has none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 900))
    return spark.range(9000).select(key.alias("key"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    ids = spark.range(600).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    return ids.union(spark.createDataFrame([("hot",), (None,)], "key string")).withColumn("name", F.upper("key"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_keeps_or_drops_rows_without_a_match(facts, lookup, how):
    joined = lookup_join(facts, lookup, "key", how)
    assert joined.columns == ["key", "v", "name"]
    assert joined.where("name is not null and name != upper(key)").isEmpty()
    assert joined.count() == (9000 if how == "left" else joined.where("name is not null").count())


def test_number_rows_equals_row_number(spark, rows):
    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 17).alias("a"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 11).alias("b"),
    )
    order = [F.col("a").desc_nulls_last(), F.col("b").asc_nulls_last()]
    w = Window.partitionBy("k").orderBy(*order)
    assert rows(number_rows(df, "k", order, "n")) == rows(df.withColumn("n", F.row_number().over(w)))


def test_numbering_gives_rows_back_as_they_were(spark):
    values = [-0.0, 0.0, float("nan"), None, float("inf"), 1.5, -0.0]
    df = spark.createDataFrame([("k", v) for v in values], "k string, x double")
    got = number_rows(df, "k", [F.col("x").asc_nulls_last()], "n")
    assert sorted(str(r.x) for r in got.collect()) == sorted(map(str, values))
    assert sorted(r.n for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_top_n_limits_before_the_shuffle(spark, facts):
    plan = top_n(facts, ["key"], [F.col("v").desc()], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan


def dense_v(matrix):
    """Textbook chi-square over the whole matrix."""
    o = np.asarray(matrix, dtype=float)
    e = o.sum(1, keepdims=True) @ o.sum(0, keepdims=True) / o.sum()
    return float(np.sqrt(((o - e) ** 2 / e).sum() / (o.sum() * (min(o.shape) - 1))))


@pytest.mark.parametrize("matrix", [[[10, 20], [30, 5]], [[5, 0, 7], [0, 9, 1], [4, 4, 4]], [[3, 3], [3, 3]], [[9, 0], [0, 9]]])
def test_association_equals_the_dense_formula(spark, matrix):
    cells = [(i, j, n) for i, row in enumerate(matrix) for j, n in enumerate(row) if n]
    out = cramers_v(spark.createDataFrame(cells, "r int, c int, n long"), "r", "c", "n").first()
    assert out.v == pytest.approx(dense_v(matrix), abs=1e-12)


def test_association_drops_light_rows_before_the_column_totals(spark):
    cells = [(1, "a", 40), (1, "b", 20), (2, "a", 10), (2, "b", 50), (3, "c", 5)]
    out = cramers_v(spark.createDataFrame(cells, "r int, c string, n long"), "r", "c", "n", 50).first()
    assert (out.n_rows, out.n_columns) == (2, 2)
    assert out.v == pytest.approx(dense_v([[40, 20], [10, 50]]), abs=1e-12)


@pytest.mark.parametrize("cells", [[], [(1, "a", 60)], [(1, "a", 60), (1, "b", 60)], [(1, "a", 60), (2, "a", 60)]])
def test_association_is_nan_without_two_rows_and_columns(spark, cells):
    out = cramers_v(spark.createDataFrame(cells, "r int, c string, n long"), "r", "c", "n").collect()
    assert len(out) == 1 and np.isnan(out[0].v)


@pytest.mark.parametrize(
    "values, breaks", [([5.0, 4.0, 4.0, 1.0, None], 0), ([1.0, 2.0, 2.0, 3.0], 2), ([3.0, None, 2.0], 1), ([], 0)]
)
def test_order_breaks_of_a_stored_table(spark, tmp_path, values, breaks):
    path = str(tmp_path / "t")
    spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).write.parquet(path)
    out = order_breaks(with_file_position(spark.read.schema("v double").parquet(path)), "v").first()
    assert (out.n_rows, out.breaks) == (len(values), breaks)


def test_order_breaks_across_blocks_parts_and_output(spark, monkeypatch):
    from merchantlake.operators import stored_order

    monkeypatch.setattr(stored_order, "BLOCK_ROWS", 7)
    ordered = spark.range(1000).select(F.rand(3).alias("v")).orderBy(F.col("v").desc())
    assert order_breaks(with_output_position(ordered), "v").first().breaks == 0
    values = [r.v for r in ordered.orderBy("v").collect()]
    rising = spark.createDataFrame([(v, i // 100, i % 100) for i, v in enumerate(values)], "v double, _part int, _row int")
    assert order_breaks(rising, "v").first().breaks == 999


def test_parts_are_ordered_by_number(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for number, value in ((99999, 2.0), (100000, 1.0)):
        pq.write_table(pa.table({"v": [value]}), tmp_path / f"part-{number}-x.parquet")
    out = order_breaks(with_file_position(spark.read.schema("v double").parquet(str(tmp_path))), "v").first()
    assert (out.n_rows, out.breaks) == (2, 0)


def test_results_are_stored_only_where_all_executors_see_them(spark, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from merchantlake.operators import reuse

    def session(master, named=None, set_before=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: set_before)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=context)

    with pytest.raises(reuse.NoSharedFolderError):
        reuse.shared_folder(session("spark://host:7077"))
    with pytest.raises(reuse.NoSharedFolderError):
        reuse.shared_folder(session("local-cluster[3,2,1024]"))
    assert reuse.shared_folder(session("yarn", named="hdfs://shared")) == "hdfs://shared"
    assert reuse.shared_folder(session("yarn", set_before="/given")) == "/given"
    assert reuse.store(spark.range(3)).count() == 3
