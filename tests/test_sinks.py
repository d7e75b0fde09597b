"""Tables are replaced whole or not at all, by month, behind a gate, and in an order that lets readers skip."""

import os
import signal
import subprocess
import sys
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchantlake import run
from merchantlake.functions import columns as X
from merchantlake.registry.queries import QUERIES
from merchantlake.sources import publish, standin, tables


class Killed(BaseException):
    """The end of a run: nothing catches it."""


class Dying(publish.Folders):
    """Folders on which a run ends before its n-th change."""

    def __init__(self, spark, left):
        super().__init__(spark)
        self.left = left

    def _step(self):
        self.left -= 1
        if self.left < 0:
            raise Killed

    def rename(self, source, target):
        self._step()
        super().rename(source, target)

    def delete(self, path):
        self._step()
        super().delete(path)


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize("steps", range(5))
def test_a_killed_run_leaves_the_old_or_the_new_table(spark, tmp_path, steps):
    path = f"{tmp_path}/layer/t"
    tables.write_table(spark.range(10), path)
    new = spark.range(10, 30)
    try:
        publish.replace_table(spark, path, lambda p: new.write.parquet(p), folders=Dying(spark, steps))
        ended = True
    except Killed:
        ended = False
    assert ended == (steps >= 4)
    got = ids(tables.read_table(spark, path))
    assert got == (list(range(10)) if steps < 1 else got) and got in (list(range(10)), list(range(10, 30)))
    tables.write_table(spark.range(3), path)
    assert ids(tables.read_table(spark, path)) == [0, 1, 2]
    assert os.listdir(f"{tmp_path}/layer") == ["t"]


def test_a_run_that_fails_while_it_writes_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_table(spark.range(10), path)
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(broken, path)
    assert ids(tables.read_table(spark, path)) == list(range(10))
    tables.write_table(spark.range(2), path)
    assert ids(tables.read_table(spark, path)) == [0, 1] and os.listdir(tmp_path) == ["t"]


def test_a_first_table_whose_swap_was_cut_short_is_found(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(Killed):
        publish.replace_table(spark, path, lambda p: spark.range(4).write.parquet(p), folders=Dying(spark, 1))
    assert not os.path.exists(path)
    assert ids(tables.read_table(spark, path)) == [0, 1, 2, 3]


KILLED = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from merchantlake.sources import tables
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
slow = spark.range(0, 10**12, 1, 4)
print("writing", flush=True)
tables.write_table(slow, {path!r})
"""


def test_a_process_that_is_killed_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_table(spark.range(10), path)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    child = subprocess.Popen([sys.executable, "-c", KILLED.format(root=root, path=path)], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        assert child.stdout.readline().strip() == b"writing"
        for _ in range(120):
            time.sleep(0.25)
            if any(n.startswith(publish.WRITING) for n in os.listdir(tmp_path)):
                break
    finally:
        os.killpg(child.pid, signal.SIGKILL)
        child.wait()
    assert any(n.startswith(publish.WRITING) for n in os.listdir(tmp_path))
    assert ids(tables.read_table(spark, path)) == list(range(10))
    tables.write_table(spark.range(5), path)
    assert ids(tables.read_table(spark, path)) == list(range(5)) and os.listdir(tmp_path) == ["t"]


def by_part(spark, path):
    return {r.p: (r.n, r.v) for r in spark.read.parquet(path).groupBy("p").agg(F.count("*").alias("n"), F.max("v").alias("v")).collect()}


def parts(spark, v, *ps):
    return spark.createDataFrame([(k, p, v) for p in ps for k in range(5)], "id long, p int, v string")


def files(path):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_table(parts(spark, "old", 1, 2, 3, None), path, partition_by=("p",))
    before = files(path)
    assert sorted(tables.write_partitions(parts(spark, "new", 2, 4), path, ("p",))) == ["p=2", "p=4"]
    assert by_part(spark, path) == {1: (5, "old"), 2: (5, "new"), 3: (5, "old"), 4: (5, "new"), None: (5, "old")}
    after = files(path)
    assert {f: t for f, t in before.items() if "p=2" not in f} == {f: t for f, t in after.items() if "p=2" not in f and "p=4" not in f}
    # A partition that was asked for and has no rows goes.
    assert sorted(tables.write_partitions(parts(spark, "newer", 1), path, ("p",), only=[{"p": 1}, {"p": 3}])) == ["p=1", "p=3"]
    assert by_part(spark, path) == {1: (5, "newer"), 2: (5, "new"), 4: (5, "new"), None: (5, "old")}


@pytest.mark.parametrize("steps", range(9))
def test_each_partition_is_old_or_new_after_a_killed_run(spark, tmp_path, steps):
    path = f"{tmp_path}/t"
    tables.write_table(parts(spark, "old", 1, 2, 3), path, partition_by=("p",))
    new = parts(spark, "new", 1, 2)
    try:
        publish.replace_partitions(spark, path, 1, lambda d: new.write.partitionBy("p").parquet(d), folders=Dying(spark, steps))
    except Killed:
        pass
    publish.recover_partitions(publish.Folders(spark), path, 1)
    got = by_part(spark, path)
    assert got[3] == (5, "old") and {got[1], got[2]} <= {(5, "old"), (5, "new")} and len(got) == 3
    tables.write_partitions(parts(spark, "last", 1, 2, 3), path, ("p",))
    assert set(by_part(spark, path).values()) == {(5, "last")} and not [n for n in os.listdir(path) if n.startswith("_") and n != "_SUCCESS"]


def test_formats_without_folders_of_files_have_no_partitions_to_replace(spark, tmp_path):
    with pytest.raises(ValueError, match="delta"):
        tables.write_partitions(parts(spark, "x", 1), f"{tmp_path}/t", ("p",), fmt="delta")


@pytest.fixture(scope="module")
def monthly(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("monthly")
    standin.transactions(spark, sf_dir).write.parquet(f"{root}/raw/historical_transactions")
    (root / "raw/merchants.csv").write_text(standin.merchants(spark, sf_dir).toPandas().to_csv(index=False))
    settings = run.Settings(str(root))
    run.run_bronze(spark, settings)
    run.run_silver(spark, settings, partition_by_month=True)
    return settings


def test_one_month_of_silver_is_rebuilt_alone(spark, monthly):
    path = monthly.at("silver", "enriched_transactions")
    before, rows_before = files(path), spark.read.parquet(path).count()
    first = spark.read.parquet(path).select(F.min("purchase_ts")).first()[0]
    month = f"{first:%Y-%m}"
    bronze = spark.read.parquet(monthly.at("bronze", "transactions")).withColumn("purchase_amount", F.col("purchase_amount") + 1)
    corrected = monthly.at("corrected")
    bronze.write.parquet(corrected)
    old = spark.read.parquet(path).groupBy("purchase_year", "purchase_month").agg(F.sum(F.col("amount").cast("decimal(20,2)")).alias("s"), F.count("*").alias("n"))
    old = {tuple(r)[:2]: tuple(r)[2:] for r in old.collect()}
    tables.write_table(spark.read.parquet(corrected), monthly.at("bronze", "transactions"))
    assert run.run_silver(spark, monthly, months=[month]) == [f"purchase_year={first.year}/purchase_month={first.month}"]
    after = files(path)
    folder = f"purchase_year={first.year}/purchase_month={first.month}/"
    assert {f: t for f, t in before.items() if folder not in f} == {f: t for f, t in after.items() if folder not in f}
    new = spark.read.parquet(path).groupBy("purchase_year", "purchase_month").agg(F.sum(F.col("amount").cast("decimal(20,2)")).alias("s"), F.count("*").alias("n"))
    for r in new.collect():
        s, n = old[(r.purchase_year, r.purchase_month)]
        assert (r.s, r.n) == ((s + n, n) if (r.purchase_year, r.purchase_month) == (first.year, first.month) else (s, n))
    assert spark.read.parquet(path).count() == rows_before


def test_the_gate_stops_a_run_and_publishes_nothing(spark, monthly):
    path = monthly.at("silver", "enriched_transactions")
    before = files(path)
    with pytest.raises(tables.DataQualityError, match="enriched_transactions: column merchant_id null ratio 0.00"):
        run.run_silver(spark, monthly, partition_by_month=True, max_null_ratio=0.001)
    first = spark.read.parquet(path).select(F.min("purchase_ts")).first()[0]
    with pytest.raises(tables.DataQualityError):
        run.run_silver(spark, monthly, months=[f"{first:%Y-%m}"], max_null_ratio=0.0)
    assert files(path) == before
    assert not [n for n in os.listdir(os.path.dirname(path)) if n.startswith("_")]


def test_the_gate_counts_in_the_pass_that_writes(spark, tmp_path):
    """Rows go through a counter: as often as the table has rows, with the gate as without it."""
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    df = spark.range(1000).select("id", F.when(F.col("id") % 50 > 0, 1).alias("v")).mapInArrow(counted, "id long, v int")
    gate = tables.Gate(["id", "v"], label="t")
    tables.write_table(df, f"{tmp_path}/t", gate=gate)
    assert rows.value == 1000 and gate.ratios() == {"id": 0.0, "v": 0.02}
    empty = tables.Gate(["v"], label="none")
    tables.write_table(df.where("false"), f"{tmp_path}/none", gate=empty)
    assert empty.ratios() == {"v": 0.0}


def scanned(df):
    """Rows that the scan below a filter hands on, as it counts them."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = plan.collectLeaves()
    found = [leaves.apply(k).metrics().get("numOutputRows") for k in range(leaves.size())]
    return sum(m.get().value() for m in found if m.isDefined())


def test_readers_of_one_month_and_city_skip_row_groups(spark, tmp_path):
    small = {"parquet.block.size": "8192", "parquet.page.size": "2048", "parquet.page.row.count.limit": "500"}
    conf = spark._jsc.hadoopConfiguration()
    for k, v in small.items():
        conf.set(k, v)
    try:
        day = F.expr("timestamp'2017-01-01' + make_dt_interval(cast(id * 7919 % 360 as int))")
        df = spark.range(60_000).select(day.alias("purchase_ts"), (F.col("id") * 31 % 200).cast("int").alias("city_id"), F.col("id").alias("amount")).repartition(4)
        from merchantlake.plans.silver import reading_order

        tables.write_table(df, f"{tmp_path}/plain")
        tables.write_table(df, f"{tmp_path}/ordered", cluster_by=reading_order())
    finally:
        for k in small:
            conf.unset(k)
    sought = "purchase_ts >= timestamp'2017-03-01' and purchase_ts < timestamp'2017-04-01' and city_id = 17"
    plain, ordered = (tables.read_table(spark, f"{tmp_path}/{n}").where(sought) for n in ("plain", "ordered"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, ordered.collect())) != []
    assert scanned(ordered) < 0.2 * scanned(plain)


def test_a_month_made_dearer_keeps_its_digits(spark, tmp_path, sf_dir):
    """2047.36 + 1 as doubles is not 2048.36, and its total was refused as having too many digits."""
    root = str(tmp_path)
    for name in ("orders", "customer", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("l_extendedprice", F.lit(2047.36)).write.parquet(f"{root}/lineitem.parquet")
    got = QUERIES["silver_month_rebuilt"](spark, root).orderBy("purchase_year", "purchase_month").collect()
    price = [Decimal("2048.36") if k == 0 else Decimal("2047.36") for k in range(len(got))]
    assert [r.total_amount for r in got] == [float(p * r.transaction_count) for p, r in zip(price, got)]
    odd = spark.createDataFrame([(0.1234567891,), (float("nan"),), (float("inf"),), (None,), (1e25,)], "a double")
    assert [str(r[0]) for r in odd.select(X.dearer(F.col("a"), 1)).collect()] == ["1.1234567891", "nan", "inf", "None", "1e+25"]
