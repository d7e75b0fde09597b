"""Sources, sinks and the runner, through files."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from merchantlake import contract as C
from merchantlake import run
from merchantlake.operators.reuse import store
from merchantlake.registry import queries
from merchantlake.sources import paths, standin, tables


def touch(path):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.touch()


def test_the_folder_is_preferred(spark, tmp_path):
    touch(tmp_path / "raw/historical_transactions/part-00000-test.snappy.parquet")
    touch(tmp_path / "raw/historical_transactions.parquet")
    assert paths.resolve_transactions(spark, str(tmp_path)) == f"{tmp_path}/raw/historical_transactions"


def test_a_single_file_comes_next(spark, tmp_path):
    touch(tmp_path / "raw/historical_transactions.parquet")
    touch(tmp_path / "raw/part-0.parquet")
    assert paths.resolve_transactions(spark, str(tmp_path)) == f"{tmp_path}/raw/historical_transactions.parquet"


def test_loose_parts_come_last(spark, tmp_path):
    touch(tmp_path / "raw/part-00000-tid-x.snappy.parquet")
    assert paths.resolve_transactions(spark, str(tmp_path)) == f"{tmp_path}/raw/part-*.parquet"


def test_a_path_that_was_asked_for_has_no_fallback(spark, tmp_path):
    touch(tmp_path / "raw/historical_transactions.parquet")
    with pytest.raises(FileNotFoundError):
        paths.resolve_transactions(spark, str(tmp_path), f"{tmp_path}/custom/missing.parquet")
    with pytest.raises(FileNotFoundError):
        paths.resolve_transactions(spark, f"{tmp_path}/elsewhere")


def test_discovery_reads_every_location_once(spark, tmp_path):
    for i, place in enumerate(["raw/historical_transactions/a.parquet", "raw/part-1.parquet"]):
        target = tmp_path / place
        target.parent.mkdir(parents=True, exist_ok=True)
        spark.range(10 * (i + 1)).toPandas().to_parquet(target)
    found = paths.discover_transactions(spark, str(tmp_path))
    assert len(found) == 2
    assert tables.read_transactions(spark, *found).count() == 30


def test_discovery_sees_folders_of_a_partitioned_table(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 as month").write.partitionBy("month").parquet(f"{tmp_path}/raw/historical_transactions")
    found = paths.discover_transactions(spark, str(tmp_path))
    assert found == [paths.resolve_transactions(spark, str(tmp_path))]
    assert tables.read_transactions(spark, *found).count() == 10


CSV = """merchant_name,merchant_id,most_recent_sales_range,avg_sales_lag3,avg_purchases_lag12,active_months_lag12,city_id,other
One inc,M_1,E,-0.4,13.9,12,242,x
"Two, inc",M_2,E,,inf,12,-1,y
"""


def test_csv_is_typed_by_the_contract(spark, tmp_path):
    (tmp_path / "merchants.csv").write_text(CSV)
    df = tables.read_merchants(spark, str(tmp_path / "merchants.csv"))
    assert dict(df.dtypes) == {
        "merchant_name": "string",
        "merchant_id": "string",
        "most_recent_sales_range": "string",
        "avg_sales_lag3": "double",
        "avg_purchases_lag12": "double",
        "active_months_lag12": "int",
        "city_id": "int",
        "other": "string",
    }
    two = df.where("merchant_id = 'M_2'").first()
    assert two.merchant_name == "Two, inc" and two.avg_sales_lag3 is None and math.isinf(two.avg_purchases_lag12)
    assert two.city_id == -1
    assert dict(tables.read_merchants(spark, str(tmp_path / "merchants.csv"), None).dtypes)["city_id"] == "int"


def test_values_that_do_not_fit_their_type_are_kept(spark, tmp_path):
    lines = ["merchant_id,active_months_lag12,city_id,avg_sales_lag3,subsector_id", "a,12.0,7,1.5,", "b,3.5,8,oops,4"]
    (tmp_path / "m.csv").write_text("\n".join(lines))
    df = tables.read_merchants(spark, str(tmp_path / "m.csv"))
    assert dict(df.dtypes) == {"merchant_id": "string", "active_months_lag12": "double", "city_id": "int", "avg_sales_lag3": "string", "subsector_id": "int"}
    assert [tuple(r)[1:] for r in df.orderBy("merchant_id").collect()] == [(12.0, 7, "1.5", None), (3.5, 8, "oops", 4)]


def test_a_csv_file_is_read_once_and_its_misfits_are_findings(spark, tmp_path, rows, monkeypatch):
    lines = ["merchant_id,active_months_lag12,city_id,avg_sales_lag3", *[f"m{k},{k},{k},{k}.5" for k in range(50)], "b,3.5,8,oops", "c,,x,1", 'd,4,"7, 8",oops']
    (tmp_path / "m.csv").write_text("\n".join(lines))
    stored = []
    monkeypatch.setattr(tables, "store", lambda df, name: stored.append(df._jdf.queryExecution().executedPlan().toString()) or store(df, name))
    df, findings = tables.read_csv(spark, str(tmp_path / "m.csv"), C.MERCHANTS)
    assert rows(findings) == [("active_months_lag12", "int", 1, "double", "3.5"), ("avg_sales_lag3", "double", 2, "string", "oops"), ("city_id", "int", 2, "string", "7, 8")]
    assert df.count() == 53 and "csv" not in df._jdf.queryExecution().executedPlan().toString().lower().replace("/csv-", "")
    assert len(stored) == 1 and stored[0].count("FileScan csv") == 1
    assert tuple(df.where("merchant_id = 'b'").first()) == ("b", 3.5, "8", "oops")


def test_lineage_can_name_the_file_of_each_row(spark, tmp_path):
    spark.range(6).repartition(3).write.parquet(f"{tmp_path}/t")
    origins = tables.with_lineage(tables.read_table(spark, f"{tmp_path}/t"), "t", by_file=True).select("_bronze_source").distinct().collect()
    assert len(origins) == 3 and all("/t/part-" in r[0] for r in origins)


def test_lineage_is_fixed_once(spark):
    df = tables.with_lineage(spark.range(100).repartition(4), "/raw/x")
    out = df.select("_ingested_at", "_bronze_source").distinct().collect()
    assert len(out) == 1 and out[0]._bronze_source == "/raw/x" and out[0]._ingested_at.endswith("+00:00")


def test_a_table_that_is_not_there(spark, tmp_path):
    with pytest.raises(tables.StorageError, match="nowhere"):
        tables.read_table(spark, f"{tmp_path}/nowhere")


def test_writes_replace_and_small_tables_are_one_file(spark, tmp_path):
    path = str(tmp_path / "deep" / "t")
    for n in (50, 20):
        tables.write_table(spark.range(n).repartition(4), path, small=True)
    assert tables.read_table(spark, path).count() == 20
    assert len(glob.glob(f"{path}/part-*.parquet")) == 1


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    """All layers, from raw files of stand-in data."""
    root = tmp_path_factory.mktemp("lake")
    standin.transactions(spark, sf_dir).repartition(3).write.parquet(f"{root}/raw/historical_transactions")
    (root / "raw/merchants.csv").write_text(standin.merchants(spark, sf_dir).toPandas().to_csv(index=False))
    settings = run.Settings(str(root))
    run.run_all(spark, settings)
    return settings


def test_all_gold_tables_equal_the_queries(spark, sf_dir, lake, rows):
    from merchantlake.registry.queries import gold_frames

    for key, frame in gold_frames(spark, sf_dir).items():
        stored = tables.read_table(spark, lake.at("gold", C.GOLD_TABLES[key]))
        assert stored.columns == frame.columns
        if key == "q4_association":  # a sum of doubles, whose last digits depend on the order
            assert stored.first()[0] == pytest.approx(frame.first()[0], rel=1e-12)
        else:
            assert rows(stored) == rows(frame), key


def test_layers_keep_their_rows(spark, lake):
    bronze = tables.read_table(spark, lake.at("bronze", "transactions"))
    silver = tables.read_table(spark, lake.at("silver", "enriched_transactions"))
    resolved = tables.read_table(spark, lake.at("silver", "merchants_resolved"))
    audit = tables.read_table(spark, lake.at("silver", "merchants_duplicates_audit"))
    assert bronze.count() == silver.count() == 6000
    assert {"_ingested_at", "_bronze_source"} <= set(silver.columns)
    assert "purchase_amount" in bronze.columns and "amount" in silver.columns
    assert resolved.count() == resolved.select("merchant_id").distinct().count() == 90
    assert audit.where("is_resolved_winner").count() == audit.select("merchant_id").distinct().count() == 60


def test_shares_add_up_and_v_is_bounded(spark, lake):
    summary = tables.read_table(spark, lake.at("gold", "q5_advisory_summary"))
    for r in summary.groupBy("section").agg(F.sum("share_of_total").alias("s"), F.max("cumulative_share").alias("c")).collect():
        assert r.s == pytest.approx(1.0) and (r.c is None or r.c == pytest.approx(1.0))
    v = tables.read_table(spark, lake.at("gold", C.GOLD_TABLES["q4_association"])).first()[0]
    assert 0.0 <= v <= 1.0


def test_validation_passes_on_what_was_written(spark, lake):
    findings = run.run_validate(spark, lake)
    assert findings.where("not ok").isEmpty()
    assert findings.count() >= 30


def test_duplicate_reports_are_written(spark, lake):
    run.run_duplicates(spark, lake)
    qa = lake.at("gold", "qa")
    groups = spark.read.option("header", True).csv(f"{qa}/duplicate_merchant_groups")
    assert groups.count() == 60 and "varying_columns" in groups.columns
    assert spark.read.json(f"{qa}/merchants_duplicate_metrics").first().duplicate_ids == 60
    assert spark.read.json(f"{qa}/transactions_impact").first().tx_rows_total == 6000


def test_silver_by_month_reads_only_the_month(spark, lake):
    run.run_silver(spark, lake, partition_by_month=True)
    silver = tables.read_table(spark, lake.at("silver", "enriched_transactions"))
    assert silver.count() == 6000
    plan = silver.where("purchase_year = 1996 and purchase_month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_year" in plan
    run.run_gold(spark, lake, "q3")


def test_the_dictionary_check_covers_both_stored_tables(spark, lake):
    columns = run.run_dictionary(spark, lake)
    status = {(r.table_name, r.column_name): r.status for r in columns.collect()}
    assert status["transactions", "purchase_amount"] == "ok" and status["transactions", "_bronze_source"] == "extra"
    assert status["merchants", "merchant_id"] == "ok" and status["merchants", "numerical_1"] == "missing"
    qa = lake.at("gold", "qa")
    assert spark.read.json(f"{qa}/orphan_merchants").first().n_orphans > 0
    assert spark.read.json(f"{qa}/merchant_profile").where("metric = 'rows'").first()["value"] > 0
    assert spark.read.json(f"{qa}/transaction_numbers").count() == 5


@pytest.mark.parametrize(
    "name, choices",
    [("rep_q1_months", {"months": []}), ("rep_q1_months", {"months": ["1996-02"]}), ("rep_q1_focus", {}), ("rep_q2_state_summary", {}),
     ("rep_q3_overall_peak", {}), ("rep_q4_top_cities", {}), ("rep_q4_global_clean", {}), ("rep_q4_distribution_clean", {}),
     ("rep_q4_local", {}), ("rep_q5_kpis", {}), ("rep_month_over_month", {})],
)
def test_reports_read_stored_gold(spark, lake, name, choices):
    got = run.run_report(spark, lake, name, **choices)
    assert not got.isEmpty()
    if choices == {"months": []}:
        assert got.count() == tables.read_table(spark, lake.at("gold", "q1_results")).count()


def test_unknown_report(spark, lake):
    with pytest.raises(ValueError, match="no report"):
        run.run_report(spark, lake, "rep_nothing")


def test_layers_in_another_format(spark, sf_dir, tmp_path):
    standin.transactions(spark, sf_dir).limit(500).write.parquet(f"{tmp_path}/raw/historical_transactions")
    (tmp_path / "raw/merchants.csv").write_text(standin.merchants(spark, sf_dir).toPandas().to_csv(index=False))
    settings = run.Settings(str(tmp_path), fmt="orc")
    run.run_bronze(spark, settings)
    run.run_silver(spark, settings)
    run.run_gold(spark, settings, "q1")
    assert glob.glob(f"{tmp_path}/gold/q1_results/part-*.orc")
    assert not run.run_report(spark, settings, "rep_q1_kpis").isEmpty()


def test_unknown_question(spark, lake):
    with pytest.raises(ValueError, match="unknown question"):
        run.run_gold(spark, lake, "q99")


def test_missing_merchants(spark, tmp_path):
    touch(tmp_path / "raw/historical_transactions/part-0.parquet")
    with pytest.raises(FileNotFoundError, match="no merchants"):
        run.run_bronze(spark, run.Settings(str(tmp_path)))


def test_command_line(spark, lake, monkeypatch, capsys):
    monkeypatch.setattr(run, "session", lambda app: spark)
    monkeypatch.setenv("DATA_ROOT", lake.data_root)
    assert run.main(["gold", "--question", "q1"]) == 0
    assert run.main(["validate", "--strict"]) == 0
    assert run.main(["dictionary"]) == 0
    assert run.main(["report", "--name", "rep_q1_focus", "--city", "City_12"]) == 0
    assert "q1_top5_per_month_city" in capsys.readouterr().out
    os.rename(lake.at("gold", "q1_results"), lake.at("gold", "q1_moved"))
    assert run.main(["validate", "--strict"]) == 1
    os.rename(lake.at("gold", "q1_moved"), lake.at("gold", "q1_results"))


def test_loose_parts_are_written_by_all_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """No task takes the rows of the others."""
    monkeypatch.setattr(queries, "new_path", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "_tx", lambda spark, d: standin.transactions(spark, d).repartition(5))
    queries.bronze_locations(spark, sf_dir)
    assert len(glob.glob(f"{tmp_path}/download/raw/part-2.parquet/part-*")) == 5
