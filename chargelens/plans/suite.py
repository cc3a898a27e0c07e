"""The numbered analyst questions, run together."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import analyst

# The titles "Headline fraud rate" and "Card-testing pattern".
# number, title, query over {"customers", "merchants", "transactions"}
SUITE = [
    (1, "Headline fraud rate", lambda t: analyst.headline_fraud_rate(t["transactions"])),
    (2, "Merchant categories by fraud rate",
     lambda t: analyst.fraud_rate_by_category(t["transactions"])),
    (3, "Fraud rate over the day", lambda t: analyst.fraud_rate_by_hour(t["transactions"])),
    (4, "Customers with the largest fraud losses",
     lambda t: analyst.top_fraud_customers(t["transactions"], t["customers"])),
    (5, "Fraud rate per week", lambda t: analyst.weekly_trend(t["transactions"])),
    (6, "Card-testing pattern", lambda t: analyst.card_testing_customers(t["transactions"])),
    (7, "Fraud rate by merchant risk band",
     lambda t: analyst.fraud_rate_by_risk_bucket(t["transactions"])),
    (8, "Purchases far above a customer's norm",
     lambda t: analyst.spend_anomalies(t["transactions"], t["customers"])),
]


def run_suite(tables):
    """{number: (title, result frame)}"""
    return {number: (title, query(tables)) for number, title, query in SUITE}


def write_suite(tables, folder):
    """One parquet table per question."""
    for number, (_, result) in run_suite(tables).items():
        result.write.mode("overwrite").parquet(f"{folder}/q{number}")


DIGEST_DIGITS = 12      # hexadecimal digits of a row's md5 that are added up; thousands of rows fit a bigint


def _text(field):
    """A value as text, numbers to 3 places, so that other engines write the same."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.NumericType):
        value = F.round(value, 3).cast("decimal(20,3)")
    return F.coalesce(value.cast("string"), F.lit("null"))


def digest(result):
    """(column_name, n_rows, digest) per column of a result, whatever the order of its rows.

    Each row gives a hash of its first column, which names the row, and the value; their sum is the
    digest. So wrong values, wrong text and values of another row show in the column they are in.
    """
    names = result.columns
    texts = {f.name: _text(f) for f in result.schema.fields}
    hashes = [F.conv(F.substring(F.md5(F.concat_ws("|", texts[names[0]], texts[n])), 1, DIGEST_DIGITS), 16, 10).cast("bigint")
              for n in names]
    sums = result.agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(h), F.lit(0)).alias(f"_d{i}") for i, h in enumerate(hashes)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"_d{i}").alias("digest"))
        for i, n in enumerate(names)])))


def suite_overview(tables):
    """(query_no, title, column_name, n_rows, digest) of every question and column."""
    overview = None
    for number, (title, result) in run_suite(tables).items():
        lines = digest(result).select(F.lit(number).alias("query_no"), F.lit(title).alias("title"), "column_name", "n_rows", "digest")
        overview = lines if overview is None else overview.unionByName(lines)
    return overview
