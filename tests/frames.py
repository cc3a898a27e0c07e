"""Small hand-made inputs."""

from datetime import datetime, timedelta

START = datetime(2025, 3, 3, 10, 0, 0)      # a Monday


def txns(spark, rows):
    """Rows of (id, customer, seconds after START, amount, is_fraud)."""
    return spark.createDataFrame(
        [(i, c, START + timedelta(seconds=s), float(a), f) for i, c, s, a, f in rows],
        "transaction_id bigint, customer_id bigint, timestamp timestamp_ntz, amount double, is_fraud int")


def scored(spark, rows):
    """Rows of (is_fraud, amount, score)."""
    return spark.createDataFrame(
        [(i, y, float(a), float(p)) for i, (y, a, p) in enumerate(rows)],
        "transaction_id bigint, is_fraud int, amount double, score double")


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
