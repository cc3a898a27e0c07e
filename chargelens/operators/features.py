"""Features, built by the same code for training and scoring."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import daily_spend, gap_seconds, week_label, week_number
from ..schemas import DAYS_PER_MONTH, NO_PREV, ORDER, RAPID_REPEAT_SECONDS
from .ordered import number_rows, place, with_previous
from .skew import join_dimension

MAX_CATEGORIES = 1_000


def seconds_since_prev(txns, hot_rows=None):
    """Add whole seconds since the customer's previous transaction, NO_PREV for the first."""
    return (with_previous(txns, "customer_id", ORDER, "timestamp", "_prev", hot_rows)
            .withColumn("seconds_since_prev_txn",
                        F.coalesce(gap_seconds("timestamp", "_prev"), F.lit(NO_PREV)).cast("bigint"))
            .drop("_prev"))


def assign_ids_by_time(events, tie_break, alias="transaction_id"):
    """Number the rows 1..n by time; `tie_break` orders equal timestamps."""
    return number_rows(events, ["timestamp", tie_break], alias)


def denormalise_merchant(events, merchants, spread_by="transaction_id"):
    """Stamp the merchant's category and risk score on each event."""
    return join_dimension(events, merchants.select("merchant_id", "category", "merchant_risk_score"),
                          "merchant_id", spread_by=spread_by)


def join_customer_norm(txns, customers, spread_by="transaction_id"):
    """Left join of the customer's monthly spend; null for an unknown customer."""
    return join_dimension(txns, customers.select("customer_id", "avg_monthly_spend"),
                          "customer_id", "left", spread_by=spread_by)


def time_parts(txns):
    """Hour 0-23, weekday with Monday 0, and the week label."""
    return (txns.withColumn("hour_of_day", F.hour("timestamp"))
            .withColumn("day_of_week", F.weekday("timestamp"))
            .withColumn("_year", F.year("timestamp")).withColumn("_week", week_number("timestamp"))
            .withColumn("iso_week", week_label("_year", "_week")).drop("_year", "_week"))


def amount_norm(days=DAYS_PER_MONTH):
    """The charge next to the customer's daily spend; null without a customer."""
    return F.try_divide(F.col("amount"), daily_spend(days=days))


def build_features(txns, customers, gap=RAPID_REPEAT_SECONDS, hot_rows=None):
    """Transactions plus the engineered model inputs."""
    if "seconds_since_prev_txn" not in txns.columns:
        txns = seconds_since_prev(txns, hot_rows)
    spread_by = "transaction_id" if "transaction_id" in txns.columns else "timestamp"
    return (join_customer_norm(txns, customers, spread_by)
            .withColumns({
                "hour_of_day": F.hour("timestamp"),
                "day_of_week": F.weekday("timestamp"),
                "amount_vs_customer_norm": amount_norm(),
                "is_rapid_repeat": (F.col("seconds_since_prev_txn") < gap).cast("int")}))


def log_amount(df, amount="amount"):
    """Replace the amount by ln(1 + amount) and keep the dollars as raw_amount."""
    return df.withColumn("raw_amount", F.col(amount)).withColumn(amount, F.log1p(amount))


# ---------------------------------------------------- fitted column transforms

def training_statistics(train, label, numeric, categorical=None, most=MAX_CATEGORIES):
    """({class: rows}, {column: (mean, population deviation)}, categories) from one pass.

    The pass gives one row a class and category, whose moments are merged here; a constant column
    gets deviation 1. Categories are alphabetical; more than `most` are refused. `label` may be None.
    """
    groups = [c for c in (label, categorical) if c]
    moments = [m for i, c in enumerate(numeric) for m in (F.avg(c).alias(f"mean_{i}"), F.var_pop(c).alias(f"var_{i}"))]
    found = train.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *moments).limit(2 * most + 2).collect()
    values = sorted({r[categorical] for r in found}) if categorical else []
    if len(values) > most:
        raise ValueError(f"{categorical} has more than {most} values, too many for one slot each")
    found = sorted((r for r in found if r["n"]), key=lambda r: [repr(r[c]) for c in groups])
    rows = sum(r["n"] for r in found)
    classes, scaling = {}, {}
    for r in found:
        if label:
            classes[r[label]] = classes.get(r[label], 0) + r["n"]
    for i, c in enumerate(numeric):
        mean = math.fsum(r["n"] * r[f"mean_{i}"] for r in found) / rows if rows else 0.0
        spread = math.fsum(r["n"] * (r[f"var_{i}"] + (r[f"mean_{i}"] - mean) ** 2) for r in found)
        scaling[c] = (mean, math.sqrt(spread / rows) if spread > 0 else 1.0)
    return classes, scaling, values


def fit_scaling(train, columns):
    """{column: (mean, population deviation)} from one pass; a constant column gets deviation 1."""
    return training_statistics(train, None, columns)[1]


def scaled(column, mean, deviation):
    return (F.col(column) - F.lit(mean)) / F.lit(deviation)


def scale_features(df, scaling):
    return df.withColumns({f"{c}_z": scaled(c, m, s) for c, (m, s) in scaling.items()})


def fit_categories(train, column, most=MAX_CATEGORIES):
    """Distinct values, alphabetical: the domain of a categorical model input."""
    return training_statistics(train, None, [], column, most)[2]


def one_hot(df, column, values):
    """One 0/1 column per known value; a value not known gives all zeros."""
    return df.withColumns({f"{column}_{v}": (F.col(column) == v).cast("int") for v in values})


def class_weights(train, label="is_fraud"):
    """One row per class: (label, n, weight) with weight n_total / (classes * n)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # two rows
    return counts.select(label, "n", (F.sum("n").over(classes)
                                      / (F.count(F.lit(1)).over(classes) * F.col("n"))).alias("weight"))


def balanced_weights(classes):
    """{class: weight} that gives all classes the same total, and the rows a mean weight of 1."""
    rows = sum(classes.values())
    return {c: rows / (len(classes) * n) for c, n in classes.items()}


def weight_column(weights, label="is_fraud"):
    """Column of the per-row weight from {class: weight}; null for a class without one."""
    column = F.lit(None).cast("double")
    for value, weight in weights.items():
        column = F.when(F.col(label) == value, F.lit(float(weight))).otherwise(column)
    return column


# ------------------------------------------------------------- bounded drawing

DRAW_BITS = 60


def draw_rates(classes, bound):
    """{class: share of its rows to draw} so that `bound` rows are expected at most; all rows without a bound.

    Classes share the bound evenly; what a class does not need goes to the larger ones. So a rare
    class is kept whole as long as it is smaller than its part.
    """
    if bound is None:
        return dict.fromkeys(classes, 1.0)
    rates, left = {}, bound
    for place, (value, n) in enumerate(sorted(classes.items(), key=lambda c: (c[1], c[0]))):
        part = left / (len(classes) - place)
        rates[value] = min(1.0, part / n)
        left -= min(part, n)
    return rates


def draw_number(df, keys):
    """A number from 0 below 1 that depends on the order keys of a row alone: the first bits of an md5."""
    text = F.concat_ws("|", *[place(df, k).cast("string") for k in keys])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("bigint")
    return bits / F.lit(float(1 << DRAW_BITS))


def draw(df, label, rates, keys):
    """The drawn rows with `_rate`, the chance with which each was drawn.

    The draw depends on the keys, which tell rows apart, so it is the same however the rows lie.
    """
    rate = weight_column(rates, label)
    return df.filter(draw_number(df, keys) < rate).withColumn("_rate", rate)


def balanced_draw(df, label, classes, keys, bound):
    """The drawn rows with `weight`: the balanced weight of the class over the chance of the draw.

    Totals by class are those of all rows in expectation; without a draw the weight is the balanced one.
    """
    if bound is None:
        weight = weight_column(balanced_weights(classes), label)
        return df.filter(weight.isNotNull()).withColumn("weight", weight)
    drawn = draw(df, label, draw_rates(classes, bound), keys)
    return drawn.withColumn("weight", weight_column(balanced_weights(classes), label) / F.col("_rate")).drop("_rate")
