from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chargelens import storage
from chargelens.plans import suite
from chargelens.schemas import TRANSACTIONS
from chargelens.sources import driver_views, tables


@pytest.fixture(scope="module")
def loaded(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    frames = driver_views.tables(spark, sf_dir, gaps=True)
    tables.load_tables(frames, folder)
    tables.load_tables(frames, folder)      # a full refresh replaces, it does not append
    return tables.open_tables(spark, folder)


def test_load_is_a_full_refresh(spark, loaded):
    counts = tables.load_counts(spark, loaded).first()
    assert counts.asDict() == {"customers": 150, "merchants": 10, "transactions": 1000}
    assert [(f.name, f.dataType) for f in loaded["transactions"].schema] == [
        (f.name, f.dataType) for f in TRANSACTIONS]


def test_csv_round_trip(spark, loaded, tmp_path):
    for name, read in (("transactions", tables.scan_transactions), ("customers", tables.scan_customers),
                       ("merchants", tables.scan_merchants)):
        path = str(tmp_path / name)
        tables.write_csv(loaded[name], path)
        again = read(spark, path, "csv")
        assert again.schema.simpleString() == loaded[name].schema.simpleString()
        assert again.exceptAll(loaded[name]).count() == 0 and again.count() == loaded[name].count()


def test_csv_columns_are_found_by_name(spark, loaded, tmp_path):
    path = str(tmp_path / "customers")
    tables.write_csv(loaded["customers"].select("account_age_days", "customer_id", F.lit("x").alias("note"),
                                                "avg_monthly_spend", "home_city"), path)
    again = tables.scan_customers(spark, path, "csv").select(loaded["customers"].columns)
    assert again.exceptAll(loaded["customers"]).count() == 0
    tables.write_csv(loaded["customers"].drop("home_city"), path)
    with pytest.raises(tables.MissingColumns, match="home_city"):
        tables.scan_customers(spark, path, "csv")


def test_csv_with_plain_timestamps(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "transaction_id,customer_id,merchant_id,category,timestamp,amount,merchant_risk_score\n"
        "1,2,3,fuel,2025-01-01 00:04:09,12.5,0.1\n")
    df = tables.scan_transactions(spark, str(tmp_path / "t.csv"), "csv")
    assert str(df.first()["timestamp"]) == "2025-01-01 00:04:09"


def test_sql_over_views(spark, loaded):
    tables.register_views(loaded)
    assert tables.run_sql(spark, "SELECT count(*) AS n FROM transactions t JOIN customers USING (customer_id)"
                          ).first()["n"] == 1000


def test_suite(spark, loaded, tmp_path):
    results = suite.run_suite(loaded)
    assert list(results) == list(range(1, 9)) and results[6][0] == "Card-testing pattern"
    suite.write_suite(loaded, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/q2").count() == 10
    assert {r["query_no"]: r["n_rows"] for r in suite.suite_overview(loaded).collect()}[8] == 20


def test_wide_csv_with_other_order_keys(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("Time,V1,Amount,Class\n2.5,0.5,10,0\n1e-3,0.25,20,1\n")
    df, _ = tables.scan_wide(spark, str(tmp_path / "wide.csv"), "Time", "Class", "csv", "double")
    assert [r["Time"] for r in df.orderBy("Time").collect()] == [0.001, 2.5]
    (tmp_path / "zoned.csv").write_text("Time,V1,Class\n2020-01-01T00:00:00+02:00,1,0\n2019-12-31T23:00:00Z,1,1\n")
    df, _ = tables.scan_wide(spark, str(tmp_path / "zoned.csv"), "Time", "Class", "csv", "timestamp")
    assert [r["Class"] for r in df.orderBy("Time").collect()] == [0, 1]


def test_wide_csv(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("Time,V1,Amount,Class\n2,0.5,10,0\n1,0.25,20,1\n")
    df, source = tables.scan_wide(spark, str(tmp_path / "wide.csv"), "Time", "Class", "csv")
    assert "Time" in source and df.schema.simpleString() == "struct<Time:bigint,V1:double,Amount:double,Class:int>"
    with pytest.raises(tables.MissingColumns):
        tables.scan_wide(spark, str(tmp_path / "wide.csv"), "Clock", "Class", "csv")


def test_tables_go_to_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert storage.new_path(spark).startswith(folder.rstrip("/"))
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert storage.materialize(df).exceptAll(df).count() == 0


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customer_id,home_city,age,avg_monthly_spend\n1,Rome,30,10.5\n")
    (tmp_path / "b.csv").write_text("age,home_city,customer_id,avg_monthly_spend\n60,Oslo,2,20.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.scan_customers(spark, str(tmp_path), "csv").collect()


def test_what_a_job_wrote_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(storage, "job_dir", lambda s: f"{storage.shared_dir(s)}/chargelens/one-job")
    frame = storage.materialize(spark.range(5))
    assert frame.count() == 5 and storage.clear(spark)
    assert not Path(storage.job_dir(spark).removeprefix("file:")).exists()
