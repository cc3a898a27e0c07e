"""Declared constraints as data-quality reports."""

from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, RAPID_REPEAT_SECONDS


def null_counts(df, table):
    """One row per column: (table_name, column_name, null_rows), from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows"))
                      for c in df.columns])
    return (counts.select(F.explode(pairs).alias("p"))
            .select(F.lit(table).alias("table_name"), "p.column_name", "p.null_rows"))


def not_null_report(tables):
    return _stack(null_counts(df, name) for name, df in tables.items())


def duplicate_keys(df, key):
    """Key values held by more than one row: (key, copies)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def unique_key_report(tables):
    """One row per table: how many key values are duplicated and how many rows too many there are."""
    return _stack(
        duplicate_keys(tables[name], key).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"))
        for name, key in PRIMARY_KEYS.items())


def orphans(fact, parent, key):
    """Key values of the fact without a parent row: (key, rows).

    The fact is reduced to one row per key before it meets the parent, so a hot key is one row.
    """
    return (fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            .join(parent.select(key), key, "left_anti"))


def orphan_report(tables):
    """One row per foreign key: orphaned key values and the rows that carry them."""
    return _stack(
        orphans(tables["transactions"], tables[parent], key).agg(
            F.lit(key).alias("column_name"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"))
        for key, parent in FOREIGN_KEYS.items())


def dataset_profile(txns, gap_seconds=RAPID_REPEAT_SECONDS):
    """Rows, fraud count and rate, and rows that follow their customer's previous one quickly."""
    return txns.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("is_fraud").alias("fraud_transactions"),
        F.avg("is_fraud").alias("fraud_rate"),
        F.count_if(F.col("seconds_since_prev_txn") < gap_seconds).alias("rapid_transactions"))


def _stack(frames):
    frames = list(frames)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
