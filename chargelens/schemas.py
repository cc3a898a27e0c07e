"""Table layouts, keys and the values that are part of the query semantics."""

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("home_city", T.StringType(), False),
    T.StructField("avg_monthly_spend", T.DoubleType(), False),
    T.StructField("account_age_days", T.IntegerType(), False),
])

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.LongType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("merchant_risk_score", T.DoubleType(), False),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("merchant_id", T.LongType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("seconds_since_prev_txn", T.LongType(), False),
    T.StructField("merchant_risk_score", T.DoubleType(), False),
    T.StructField("is_fraud", T.IntegerType(), False),
])

TABLES = {"customers": CUSTOMERS, "merchants": MERCHANTS, "transactions": TRANSACTIONS}
PRIMARY_KEYS = {"customers": "customer_id", "merchants": "merchant_id",
                "transactions": "transaction_id"}
# column of transactions -> table it refers to
FOREIGN_KEYS = {"customer_id": "customers", "merchant_id": "merchants"}

# --- fixed values: results depend on these being exactly as stated -----------
CATEGORIES = ["grocery", "electronics", "travel", "dining", "fuel",
              "online_retail", "entertainment", "utilities", "jewelry", "atm_withdrawal"]
HIGH_RISK_CATEGORIES = ["electronics", "jewelry", "online_retail", "atm_withdrawal"]
FEATURES_NUM = ["amount", "seconds_since_prev_txn", "merchant_risk_score",
                "hour_of_day", "day_of_week", "amount_vs_customer_norm", "is_rapid_repeat"]
FEATURES_CAT = ["category"]
TARGET = "is_fraud"
NO_PREV = 999999
RAPID_REPEAT_SECONDS = 120
DAYS_PER_MONTH = 30.0
SPEND_MULTIPLE = 3
RISK_EDGES = [0.10, 0.20, 0.35]
RISK_LABELS = ["0.00-0.10", "0.10-0.20", "0.20-0.35", "0.35+"]
ROLLING_WEEKS = 3
REVIEW_COST = 8.0
TEST_FRACTION = 0.25
DEFAULT_THRESHOLD = 0.5
THRESHOLD_GRID = [i / 100 for i in range(5, 96)]
FOREST_TREES = 300
FOREST_DEPTH = 10
FOREST_MIN_LEAF = 5
SEED = 42
EXPLAIN_SAMPLE = 2000
BREAKDOWN_ROWS = 12
# ------------------------------------------------------------------------------

ORDER = ["timestamp", "transaction_id"]
