from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chargelens.functions.expressions import risk_bucket
from chargelens.operators import analyst, features, profile, quality
from chargelens.schemas import NO_PREV

from .frames import rows, txns


def test_gap_of_exactly_the_limit_is_not_rapid(spark):
    df = txns(spark, [(1, 1, 0, 5, 0), (2, 1, 119, 5, 1), (3, 1, 239, 5, 0), (4, 1, 360, 5, 0), (5, 2, 0, 9, 0)])
    assert rows(analyst.card_testing_customers(df, min_rapid=1),
                "customer_id", "rapid_repeat_txns", "of_which_fraud") == [(1, 1, 1)]
    gaps = dict(rows(analyst.prev_txn_gap(df), "transaction_id", "gap_seconds"))
    assert gaps == {2: 119.0, 3: 120.0, 4: 121.0}


def test_equal_timestamps_are_ordered_by_id(spark):
    df = txns(spark, [(2, 1, 0, 5, 0), (1, 1, 0, 5, 0), (3, 1, 0, 5, 0)])
    assert sorted(rows(features.seconds_since_prev(df), "transaction_id", "seconds_since_prev_txn")) == [
        (1, NO_PREV), (2, 0), (3, 0)]


def test_sub_second_gap_is_truncated(spark):
    moment = datetime(2025, 1, 1)
    df = spark.createDataFrame([(1, 1, moment), (2, 1, moment + timedelta(seconds=119, microseconds=999_999))],
                               "transaction_id bigint, customer_id bigint, timestamp timestamp_ntz")
    assert rows(features.seconds_since_prev(df).filter("transaction_id = 2"), "seconds_since_prev_txn") == [(119,)]


def test_gap_ignores_the_session_time_zone(spark):
    df = spark.createDataFrame([(1, 1, datetime(2025, 3, 9, 1, 0)), (2, 1, datetime(2025, 3, 9, 4, 0))],
                               "transaction_id bigint, customer_id bigint, timestamp timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")    # clocks change that night
    try:
        gap = rows(features.seconds_since_prev(df).filter("transaction_id = 2"), "seconds_since_prev_txn")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert gap == [(3 * 3600,)]


def test_equal_burst_counts_rank_the_larger_customer_first(spark):
    df = txns(spark, [(10 * c + i, c, 10 * i, 1, 0) for c in (3, 9, 5) for i in range(3)]
              + [(100 + i, 4, 10 * i, 1, 0) for i in range(4)])
    assert rows(analyst.card_testing_customers(df, k=3), "customer_id", "rapid_repeat_txns") == [
        (4, 3), (9, 2), (5, 2)]


def test_average_on_a_half_cent_rounds_up(spark):
    df = txns(spark, [(1, 1, 0, 1, 0), (2, 1, 10, 0.14, 0), (3, 1, 20, 0.15, 0)])
    assert rows(analyst.card_testing_customers(df), "avg_amount") == [(0.15,)]


def test_week_labels(spark):
    days = {"2024-12-31": "2024-53", "2025-01-01": "2025-00", "2025-01-05": "2025-00", "2025-01-06": "2025-01",
            "2024-01-01": "2024-01", "2024-02-29": "2024-09", "2023-01-01": "2023-00"}
    for day in days:
        assert datetime.fromisoformat(day).strftime("%Y-%W") == days[day]
    df = spark.createDataFrame([(datetime.fromisoformat(d),) for d in days], "timestamp timestamp_ntz")
    got = {str(t)[:10]: w for t, w in rows(features.time_parts(df), "timestamp", "iso_week")}
    assert got == days


def test_rolling_rate_is_the_mean_of_weekly_rates(spark):
    week = 7 * 86_400
    df = txns(spark, [(1, 1, 0, 1, 1), (2, 1, week, 1, 0), (3, 1, week, 1, 0), (4, 1, week, 1, 1),
                      (5, 1, 2 * week, 1, 0), (6, 1, 3 * week, 1, 0)])
    assert rows(analyst.weekly_trend(df), "fraud_rate_pct", "rolling_3wk_avg_fraud_rate") == [
        (100.0, 100.0), (33.333, 66.667), (0.0, 44.444), (0.0, 11.111)]


def test_risk_bucket_edges_belong_to_the_upper_bucket(spark):
    df = spark.createDataFrame([(s,) for s in (0.0999, 0.10, 0.20, 0.35)], "merchant_risk_score double")
    assert rows(df, risk_bucket("merchant_risk_score")) == [
        ("0.00-0.10",), ("0.10-0.20",), ("0.20-0.35",), ("0.35+",)]


def test_no_fraud_gives_a_null_loss(spark):
    df = txns(spark, [(1, 1, 0, 5, 0)])
    assert rows(analyst.headline_fraud_rate(df), "fraud_rate_pct", "fraud_dollar_loss") == [(0.0, None)]
    assert rows(analyst.headline_fraud_rate(df.limit(0)), "total_transactions", "fraud_rate_pct") == [(0, None)]


def test_anomalies_tie_on_the_rounded_multiple_by_id(spark):
    customers = spark.createDataFrame([(1, 30.0), (2, 0.0)], "customer_id bigint, avg_monthly_spend double")
    df = txns(spark, [(3, 1, 0, 5.01, 0), (2, 1, 0, 4.99, 0), (1, 1, 0, 3.0, 0), (9, 2, 0, 1, 0), (8, 5, 0, 99, 0)])
    assert rows(analyst.spend_anomalies(df, customers), "transaction_id", "x_over_daily_norm") == [
        (2, 5.0), (3, 5.0), (9, None)]


def test_density_sums_to_one_per_class(spark, sf_dir):
    from chargelens.sources import driver_views
    density = profile.amount_density(driver_views.transactions(spark, sf_dir))
    for r in density.groupBy("is_fraud").agg(F.sum(F.col("density") * (F.col("upper") - F.col("lower"))).alias("s"),
                                             F.max("bin").alias("b")).collect():
        assert abs(r["s"] - 1) < 1e-3 and r["b"] <= 59


def test_density_counts_every_row(spark):
    df = spark.createDataFrame([(0, 5.0), (0, 0.0), (1, -2.0), (1, None), (1, 500.0)], "is_fraud int, amount double")
    got = profile.amount_density(df).groupBy("is_fraud").agg(
        F.sum("n").alias("n"), F.max("without_log").alias("w"), F.count(F.lit(1)).alias("bins")).orderBy("is_fraud")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 60), (1, 1, 2, 60)]


def test_density_of_one_amount_and_of_none(spark):
    df = txns(spark, [(1, 1, 0, 5, 0), (2, 1, 0, 5, 1)])
    assert rows(profile.amount_density(df), "is_fraud", "bin", "n") == [
        (c, b, int(b == 0)) for c in (0, 1) for b in range(60)]
    assert profile.amount_density(df.limit(0)).count() == 0


def test_integrity_reports(spark):
    facts = txns(spark, [(1, 1, 0, 5, 0), (1, 1, 1, 5, 0), (1, 2, 2, 5, 0), (2, 8, 3, 5, 0), (3, 8, 3, 5, 0)])
    facts = facts.withColumn("amount", F.expr("if(customer_id = 2, null, amount)")).withColumn(
        "merchant_id", F.lit(1).cast("bigint"))
    customers = spark.createDataFrame([(1,), (2,), (2,)], "customer_id bigint")
    merchants = spark.createDataFrame([(1,)], "merchant_id bigint")
    tables = {"customers": customers, "merchants": merchants, "transactions": facts}
    nulls = rows(quality.not_null_report(tables), "table_name", "column_name", "null_rows")
    assert ("transactions", "amount", 1) in nulls and sum(n for _, _, n in nulls) == 1
    assert sorted(rows(quality.unique_key_report(tables), "table_name", "duplicated_keys", "surplus_rows")) == [
        ("customers", 1, 1), ("merchants", 0, 0), ("transactions", 1, 2)]
    assert sorted(rows(quality.orphan_report(tables), "column_name", "orphan_keys", "orphan_rows")) == [
        ("customer_id", 1, 2), ("merchant_id", 0, 0)]
    assert rows(quality.orphans(facts, customers, "customer_id"), "customer_id", "rows") == [(8, 2)]
