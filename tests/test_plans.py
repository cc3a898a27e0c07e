"""Shapes of the physical plans that matter at scale."""

import pytest

import __spark_entry__ as entry
from chargelens.operators import analyst, features, ordered
from chargelens.sources import driver_views as views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_no_cross_join(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id transaction_id", "user_id customer_id", "ts timestamp", "value amount")
    early, _, _ = ordered.temporal_split(events, 0.25)
    text = plan(early.select("amount"))
    assert "PushedFilters: [Or(LessThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in text


def test_fraud_rate_by_category_shuffles_only_its_groups(spark, sf_dir):
    text = plan(analyst.fraud_rate_by_category(views.transactions(spark, sf_dir)))
    assert "Window" not in text and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_features_shuffle_the_facts_once(spark, sf_dir):
    built = features.build_features(
        views.events(spark, sf_dir).drop("props"), views.customer_spend(spark, sf_dir))
    assert plan(built).count("Exchange hashpartitioning") == 1


def test_top_k_does_not_sort_everything(spark, sf_dir):
    text = plan(analyst.spend_anomalies(views.transactions(spark, sf_dir), views.customer_spend(spark, sf_dir)))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["weekly_trend", "pr_curve", "threshold_sweep", "class_weights"])
def test_single_task_windows_run_over_aggregates(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    first_window = text.index("Exchange SinglePartition") if "Exchange SinglePartition" in text else len(text)
    assert "HashAggregate" in text[first_window:]
