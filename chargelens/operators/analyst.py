"""The analyst's fraud questions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import (daily_spend, gap_seconds_exact, mean_money, money, money_units, percent,
                                     risk_bucket, week_label, week_number)
from ..schemas import (DAYS_PER_MONTH, HIGH_RISK_CATEGORIES, RAPID_REPEAT_SECONDS, RISK_EDGES,
                       RISK_LABELS, ROLLING_WEEKS, SPEND_MULTIPLE)
from .ordered import with_previous
from .skew import join_dimension


def row_count():
    return F.count(F.lit(1))


def fraud_count():
    return F.sum("is_fraud")


def fraud_pct():
    return F.round(percent(fraud_count(), row_count()), 3)


def fraud_dollars():
    """Null when there is no fraud."""
    return money(F.sum(F.when(F.col("is_fraud") == 1, money_units(F.col("amount")))))


# ------------------------------------------------------------------ filters

def fraud_only(txns):
    return txns.filter(F.col("is_fraud") == 1)


def in_category_set(txns, categories=HIGH_RISK_CATEGORIES):
    return txns.filter(F.col("category").isin(list(categories)))


# --------------------------------------------------------------- fraud rates

def headline_fraud_rate(txns):
    return txns.agg(
        row_count().alias("total_transactions"), fraud_count().alias("fraud_transactions"),
        fraud_pct().alias("fraud_rate_pct"), fraud_dollars().alias("fraud_dollar_loss"))


def fraud_rate_by_category(txns):
    return (txns.groupBy("category")
            .agg(row_count().alias("txns"), fraud_count().alias("fraud_txns"),
                 fraud_pct().alias("fraud_rate_pct"), fraud_dollars().alias("fraud_dollar_loss"))
            .orderBy(F.desc("fraud_rate_pct"), "category"))


def fraud_rate_by_hour(txns):
    return (txns.groupBy(F.hour("timestamp").alias("hour_of_day"))
            .agg(row_count().alias("txns"), fraud_count().alias("fraud_txns"), fraud_pct().alias("fraud_rate_pct"))
            .orderBy("hour_of_day"))


def fraud_rate_by_risk_bucket(txns, edges=RISK_EDGES, labels=RISK_LABELS):
    return (txns.groupBy(risk_bucket("merchant_risk_score", edges, labels).alias("risk_bucket"))
            .agg(row_count().alias("txns"), fraud_pct().alias("actual_fraud_rate_pct"))
            .orderBy("risk_bucket"))


def top_fraud_customers(txns, customers, k=10):
    """Customers by confirmed fraud dollars.

    Grouped before the join: the customer table is unique on its key, so one row per customer
    meets it instead of one per transaction, however large a customer is.
    """
    losses = (fraud_only(txns).groupBy("customer_id")
              .agg(row_count().alias("fraud_txns"), money(F.sum(money_units(F.col("amount")))).alias("total_fraud_amount")))
    return (losses.join(customers.select("customer_id", "home_city"), "customer_id")
            .select("customer_id", "home_city", "fraud_txns", "total_fraud_amount")
            .orderBy(F.desc("total_fraud_amount"), "customer_id").limit(k))


# ------------------------------------------------------------------- weekly

def weekly_counts(txns):
    """Rows and frauds per year and Monday-based week of the year (00 to 53)."""
    return (txns.groupBy(F.year("timestamp").alias("_year"), week_number("timestamp").alias("_week"))
            .agg(row_count().alias("txns"), fraud_count().alias("fraud_txns"))
            .select(week_label("_year", "_week").alias("iso_week"), "txns", "fraud_txns"))


def weekly_trend(txns, weeks=ROLLING_WEEKS):
    """Weekly fraud rate and the mean of the last `weeks` weekly rates.

    The window has no partition key; it runs over at most 54 rows a year.
    """
    rate = percent(F.col("fraud_txns"), F.col("txns"))
    recent = Window.orderBy("iso_week").rowsBetween(1 - weeks, 0)
    return (weekly_counts(txns)
            .select("iso_week", "txns", "fraud_txns", F.round(rate, 3).alias("fraud_rate_pct"),
                    F.round(F.avg(rate).over(recent), 3).alias("rolling_3wk_avg_fraud_rate"))
            .orderBy("iso_week"))


# ------------------------------------------------------------- card testing

def prev_txn_gap(txns, hot_rows=None):
    """Every transaction but a customer's first, with the seconds since the one before it."""
    ordered = with_previous(
        txns.select("customer_id", "transaction_id", "timestamp", "amount", "is_fraud"),
        "customer_id", ["timestamp", "transaction_id"], "timestamp", "prev_ts", hot_rows)
    return (ordered.filter(F.col("prev_ts").isNotNull())
            .withColumn("gap_seconds", gap_seconds_exact("timestamp", "prev_ts")))


def card_testing_customers(txns, gap_seconds=RAPID_REPEAT_SECONDS, min_rapid=2, k=15,
                           hot_rows=None):
    """Customers with the most transactions right after another of theirs."""
    return (prev_txn_gap(txns, hot_rows).filter(F.col("gap_seconds") < gap_seconds)
            .groupBy("customer_id")
            .agg(row_count().alias("rapid_repeat_txns"), fraud_count().alias("of_which_fraud"),
                 mean_money("amount").alias("avg_amount"))
            .filter(F.col("rapid_repeat_txns") >= min_rapid)
            .orderBy(F.desc("rapid_repeat_txns"), F.desc("customer_id")).limit(k))


# ---------------------------------------------------------- spend anomalies

def spend_anomalies(txns, customers, multiple=SPEND_MULTIPLE, days=DAYS_PER_MONTH, k=20):
    """The `k` transactions furthest above `multiple` times the customer's implied daily spend.

    Ranked by the rounded multiple.
    """
    joined = join_dimension(
        txns.select("transaction_id", "customer_id", "amount", "is_fraud"),
        customers.select("customer_id", "avg_monthly_spend"), "customer_id")
    largest = (joined.withColumn("_daily", daily_spend(days=days))
               .filter(F.col("amount") > F.lit(float(multiple)) * F.col("_daily"))
               .withColumn("x_over_daily_norm", F.round(F.try_divide("amount", "_daily"), 1))
               .orderBy(F.desc("x_over_daily_norm"), "transaction_id").limit(k))
    return largest.select("transaction_id", "customer_id", "amount",
                          F.round("_daily", 2).alias("implied_daily_spend"), "x_over_daily_norm", "is_fraud")
