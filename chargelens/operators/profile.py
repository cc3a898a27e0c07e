"""Exploratory summaries: the numbers behind the charts."""

from pyspark.sql import functions as F

from ..functions.expressions import percent, ratio_or_zero


def _rate():
    return percent(F.sum("is_fraud"), F.count(F.lit(1)))


def rate_by_category(txns):
    return (txns.groupBy("category").agg(_rate().alias("fraud_rate_pct"))
            .orderBy(F.desc("fraud_rate_pct"), "category"))


def rate_by_hour(txns):
    return (txns.groupBy(F.hour("timestamp").alias("hour_of_day"))
            .agg(_rate().alias("fraud_rate_pct")).orderBy("hour_of_day"))


def amount_density(txns, bins=60):
    """Histogram of log10(amount) per class: (is_fraud, bin, lower, upper, n, density, without_log).

    Every class has all bins. Their edges are shared and span all positive amounts; the last bin
    includes the maximum; density sums to 1 over each class. Rows of the class without a logarithm
    (amount null, zero or less) are in no bin and counted in `without_log`.
    """
    log = F.when(F.col("amount") > 0, F.log10("amount"))
    ends = txns.agg(F.min(log).alias("lo"), F.max(log).alias("hi")).first()
    lo = ends["lo"] or 0.0
    width = ((ends["hi"] or 0.0) - lo) / bins or 1.0
    cell = F.least(F.floor((log - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    # at most two classes times the number of bins and one
    counts = txns.groupBy("is_fraud", F.when(log.isNotNull(), cell).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    classes = counts.groupBy("is_fraud").agg(
        F.sum(F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)).alias("class_n"),
        F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("without_log"))
    grid = classes.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return (grid.join(F.broadcast(counts), ["is_fraud", "bin"], "left")
            .select("is_fraud", "bin",
                    F.round(F.lit(lo) + F.col("bin") * F.lit(width), 6).alias("lower"),
                    F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), 6).alias("upper"), n.alias("n"),
                    F.round(ratio_or_zero(n, F.col("class_n") * F.lit(width)), 6).alias("density"), "without_log")
            .orderBy("is_fraud", "bin"))


def label_rate(df, label="is_fraud", places=4):
    return df.agg(F.round(F.avg(label), places).alias("label_rate"))
