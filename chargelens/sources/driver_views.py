"""The three card tables and the wide table as views over the TPC-H-like test tables."""

from pyspark.sql import functions as F

from ..operators.features import amount_norm, denormalise_merchant, join_customer_norm, seconds_since_prev
from ..schemas import CATEGORIES

# declared, so that opening a table runs no job to infer its columns
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

_sizes = {}


def _read(spark, sf_dir, name):
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def size(spark, sf_dir, name):
    """Rows of a test table, counted once per session; these tables never change."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _sizes:
        _sizes[key] = _read(spark, sf_dir, name).count()
    return _sizes[key]


def customers(spark, sf_dir):
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (_read(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("home_city"),
                    _spend().alias("avg_monthly_spend"),
                    (F.col("c_custkey") % 3620 + 30).cast("int").alias("account_age_days")))


def customer_spend(spark, sf_dir):
    """The two customer columns the features need, without the city lookup."""
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), _spend().alias("avg_monthly_spend"))


def _spend():
    return F.abs("c_acctbal") / F.lit(10.0) + F.lit(30.0)


def merchants(spark, sf_dir):
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("merchant_id"),
        names[(F.col("s_suppkey") % len(CATEGORIES)).cast("int")].alias("category"),
        (F.abs("s_acctbal") / F.lit(20000.0)).alias("merchant_risk_score"))


def events(spark, sf_dir):
    """Raw charges: no merchant attributes, no gap, no label yet."""
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"), F.col("user_id").alias("customer_id"),
        (F.col("event_id") % size(spark, sf_dir, "supplier")).alias("merchant_id"),
        F.col("ts").alias("timestamp"), F.col("value").alias("amount"), "props")


def _labelled(spark, sf_dir, gaps):
    facts = events(spark, sf_dir)
    if gaps:
        facts = seconds_since_prev(facts)
    facts = join_customer_norm(facts, customer_spend(spark, sf_dir))
    facts = denormalise_merchant(facts, merchants(spark, sf_dir))
    marked = F.col("props").rlike(r'"k"\s*:\s*0\s*[,}]')
    night = (F.hour("timestamp") < 5) & (
        F.col("amount") > F.lit(4.0) * F.col("avg_monthly_spend") / F.lit(30.0))
    return facts.withColumn("is_fraud", F.coalesce((marked | night).cast("int"), F.lit(0)))


def transactions(spark, sf_dir, gaps=False):
    """The fact table; `gaps` adds seconds_since_prev_txn, which costs the only shuffle here."""
    gap = ["seconds_since_prev_txn"] if gaps else []
    return _labelled(spark, sf_dir, gaps).select(
        "transaction_id", "customer_id", "merchant_id", "category", "timestamp", "amount", *gap,
        "merchant_risk_score", "is_fraud")


def tables(spark, sf_dir, gaps=False):
    return {"customers": customers(spark, sf_dir), "merchants": merchants(spark, sf_dir),
            "transactions": transactions(spark, sf_dir, gaps)}


def rule_scored(spark, sf_dir):
    """transaction_id, timestamp, is_fraud, amount and a rule score to 4 places in place of a model's."""
    capped = F.least(F.lit(1.0), amount_norm() / F.lit(10.0))
    return _labelled(spark, sf_dir, False).select(
        "transaction_id", "customer_id", "category", "timestamp", "amount", "is_fraud",
        (F.floor(capped * 10000.0 + 0.5) / F.lit(10000.0)).alias("score"))


WIDE_FEATURES = [f"f{i}" for i in range(64)]


def wide(spark, sf_dir):
    """vec_id as order key, 64 features, a made-up positive amount, class 1 where the label is 0."""
    vector = F.col("embedding")
    return _read(spark, sf_dir, "embeddings").select(
        "vec_id", *[vector[i].cast("double").alias(name) for i, name in enumerate(WIDE_FEATURES)],
        (F.lit(1.0) + F.col("vec_id") % 100).alias("amount"),
        (F.col("label") == 0).cast("int").alias("class"))
