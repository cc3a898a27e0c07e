"""Every query that SQL can express, against another engine on the same tables."""

import pytest

import __spark_entry__ as entry
from chargelens.plans import catalogue

from .oracle import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_relational_query_has_sql():
    assert set(SQL) <= set(entry.queries())
    assert not set(catalogue.relational_queries()) - set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, connection, name):
    assert compare(entry.queries()[name](spark, sf_dir), connection, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_results_do_not_depend_on_partitions(spark, sf_dir, connection, partitions):
    names = ["card_testing_customers_1h", "seconds_since_prev", "assign_ids_by_time", "pr_curve_raw_scores",
             "threshold_sweep", "stratified_keep_all_positive"]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for name in names:
            assert compare(entry.queries()[name](spark, sf_dir), connection, SQL[name]) is None, name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


LARGE = ["spend_anomalies", "join_customer_norm", "denormalise_merchant", "card_testing_customers_1h",
         "prev_txn_gap", "seconds_since_prev", "temporal_split", "build_features", "class_weights",
         "headline_fraud_rate", "threshold_sweep"]


@pytest.mark.parametrize("name", LARGE)
def test_the_ways_taken_by_large_data(spark, sf_dir, connection, monkeypatch, name):
    """Nothing is broadcast as a dimension, most keys count as hot, and a few rows are already too
    many to sort at once."""
    monkeypatch.setattr("chargelens.operators.skew.BROADCAST_BYTES", 0)
    monkeypatch.setattr("chargelens.operators.skew.HOT_ROWS", 70)
    monkeypatch.setattr("chargelens.operators.skew.ROWS_PER_PIECE", 30)
    monkeypatch.setattr("chargelens.operators.ordered.FINISH_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(entry.queries()[name](spark, sf_dir), connection, SQL[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
