"""Plain SQL for the same results, run by another engine over the same test tables."""

from chargelens.plans.rule_forest import FEATURES as RULE_FEATURES
from chargelens.plans.rule_forest import TREES as RULE_TREES

CATEGORIES = ("['grocery', 'electronics', 'travel', 'dining', 'fuel', 'online_retail', "
              "'entertainment', 'utilities', 'jewelry', 'atm_withdrawal']")

# the card tables as common table expressions
_VIEWS = f"""
customers AS (
  SELECT c_custkey AS customer_id, n_name AS home_city,
         abs(c_acctbal) / 10.0::DOUBLE + 30.0::DOUBLE AS avg_monthly_spend,
         CAST(30 + c_custkey % 3620 AS INTEGER) AS account_age_days
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
merchants AS (
  SELECT s_suppkey AS merchant_id, ({CATEGORIES})[CAST(s_suppkey % 10 AS INTEGER) + 1] AS category,
         abs(s_acctbal) / 20000.0::DOUBLE AS merchant_risk_score
  FROM supplier),
charges AS (
  SELECT event_id AS transaction_id, user_id AS customer_id,
         event_id % (SELECT count(*) FROM supplier) AS merchant_id, ts AS "timestamp",
         value AS amount, props,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM events),
transactions AS (
  SELECT e.transaction_id, e.customer_id, e.merchant_id, m.category, e."timestamp", e.amount,
         coalesce((epoch_us(e."timestamp") - epoch_us(e.prev_ts)) // 1000000, 999999)::BIGINT
           AS seconds_since_prev_txn,
         m.merchant_risk_score,
         CASE WHEN CAST(regexp_extract(e.props, '"k": *(-?[0-9]+)', 1) AS INTEGER) = 0
                OR (hour(e."timestamp") < 5
                    AND e.amount > 4.0::DOUBLE * c.avg_monthly_spend / 30.0::DOUBLE)
              THEN 1 ELSE 0 END AS is_fraud,
         e.prev_ts
  FROM charges e JOIN merchants m USING (merchant_id) LEFT JOIN customers c USING (customer_id))"""

_FEATURES = """,
features AS (
  SELECT t.* EXCLUDE (prev_ts), c.avg_monthly_spend,
         CAST(hour(t."timestamp") AS INTEGER) AS hour_of_day,
         CAST((dayofweek(t."timestamp") + 6) % 7 AS INTEGER) AS day_of_week,
         t.amount / (c.avg_monthly_spend / 30.0::DOUBLE) AS amount_vs_customer_norm,
         CASE WHEN t.seconds_since_prev_txn < 120 THEN 1 ELSE 0 END AS is_rapid_repeat
  FROM transactions t LEFT JOIN customers c USING (customer_id)),
placed AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp", transaction_id) - 1 AS place,
         count(*) OVER () AS n
  FROM features),
split AS (
  SELECT *, CASE WHEN place < floor(n * 0.75::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM placed)"""

_SCORED = _FEATURES + """,
scored AS (
  SELECT transaction_id, customer_id, category, "timestamp", amount, is_fraud,
         floor(least(1.0::DOUBLE, amount_vs_customer_norm / 10.0::DOUBLE) * 10000.0::DOUBLE + 0.5::DOUBLE)
           / 10000.0::DOUBLE AS score
  FROM features)"""

_CONFUSION = _SCORED + """,
cm AS (
  SELECT count(*) FILTER (score < 0.5 AND is_fraud = 0) AS tn,
         count(*) FILTER (score >= 0.5 AND is_fraud = 0) AS fp,
         count(*) FILTER (score < 0.5 AND is_fraud = 1) AS fn,
         count(*) FILTER (score >= 0.5 AND is_fraud = 1) AS tp
  FROM scored)"""

_CURVE = """,
by_score AS (
  SELECT score, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM scored GROUP BY score),
points AS (
  SELECT score, pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(pos) OVER () AS all_pos
  FROM by_score)"""

_COSTS = """,
grid AS (SELECT i / 100.0::DOUBLE AS threshold FROM range(5, 96) g(i)),
at_point AS (
  SELECT threshold,
         count(*) FILTER (score >= threshold AND is_fraud = 1) AS tp,
         count(*) FILTER (score >= threshold AND is_fraud = 0) AS fp,
         count(*) FILTER (score < threshold AND is_fraud = 1) AS fn,
         round(coalesce(sum(amount) FILTER (score < threshold AND is_fraud = 1), 0), 2) AS dollars
  FROM scored CROSS JOIN grid GROUP BY threshold),
sweep AS (
  SELECT round(threshold, 3) AS threshold,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(tp::DOUBLE / (tp + fp), 4) END::DOUBLE AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE round(tp::DOUBLE / (tp + fn), 4) END::DOUBLE AS recall,
         fp AS false_positives, fn AS missed_frauds, dollars AS dollars_lost_to_missed_fraud,
         round(8.0::DOUBLE * fp + dollars, 2) AS expected_cost
  FROM at_point)"""

_WEEKLY = """,
weekly AS (
  SELECT strftime("timestamp", '%Y-%W') AS iso_week, count(*) AS txns,
         CAST(sum(is_fraud) AS BIGINT) AS fraud_txns
  FROM transactions GROUP BY 1)"""

_GAPS = """,
gaps AS (
  SELECT customer_id, transaction_id, "timestamp", amount, is_fraud, prev_ts,
         (epoch_us("timestamp") - epoch_us(prev_ts)) / 1000000.0::DOUBLE AS gap_seconds
  FROM transactions WHERE prev_ts IS NOT NULL)"""

_WIDE = """
wide AS (
  SELECT vec_id, embedding, (1.0::DOUBLE + vec_id % 100) AS amount,
         CASE WHEN label = 0 THEN 1 ELSE 0 END AS "class"
  FROM embeddings)"""

NUMERIC = ["amount", "seconds_since_prev_txn", "merchant_risk_score", "hour_of_day", "day_of_week",
           "amount_vs_customer_norm", "is_rapid_repeat"]
NAMES = ["grocery", "electronics", "travel", "dining", "fuel", "online_retail", "entertainment",
         "utilities", "jewelry", "atm_withdrawal"]
_DOLLARS = "round(sum(CASE WHEN is_fraud = 1 THEN amount END), 2) AS fraud_dollar_loss"
_RATE = "round(100.0::DOUBLE * sum(is_fraud) / count(*), 3)"


def _q(text, more=""):
    return f"WITH {_VIEWS}{more}\n{text}"


def _card_testing_rows(gap):
    return f"""
SELECT customer_id, count(*) AS rapid_repeat_txns, CAST(sum(is_fraud) AS BIGINT) AS of_which_fraud,
       ((2 * sum(CAST(round(amount * 100) AS BIGINT)) + count(*)) // (2 * count(*)))::DOUBLE / 100.0::DOUBLE
         AS avg_amount
FROM gaps WHERE gap_seconds < {gap} GROUP BY customer_id HAVING count(*) >= 2
ORDER BY rapid_repeat_txns DESC, customer_id DESC LIMIT 15"""


def _card_testing(gap):
    return _q(_card_testing_rows(gap), _GAPS)


HEADLINE = f"""
SELECT count(*) AS total_transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
       {_RATE} AS fraud_rate_pct, {_DOLLARS} FROM transactions"""
BY_CATEGORY = f"""
SELECT category, count(*) AS txns, CAST(sum(is_fraud) AS BIGINT) AS fraud_txns,
       {_RATE} AS fraud_rate_pct, {_DOLLARS} FROM transactions GROUP BY category"""
BY_HOUR = f"""
SELECT CAST(hour("timestamp") AS INTEGER) AS hour_of_day, count(*) AS txns,
       CAST(sum(is_fraud) AS BIGINT) AS fraud_txns, {_RATE} AS fraud_rate_pct
FROM transactions GROUP BY 1"""
TOP_CUSTOMERS = """
SELECT customer_id, home_city, fraud_txns, total_fraud_amount
FROM (SELECT customer_id, count(*) AS fraud_txns, round(sum(amount), 2) AS total_fraud_amount
      FROM transactions WHERE is_fraud = 1 GROUP BY customer_id) AS losses
JOIN customers USING (customer_id) ORDER BY total_fraud_amount DESC, customer_id LIMIT 10"""
_RATED = """(SELECT row_number() OVER (ORDER BY iso_week) AS k, *, 100.0::DOUBLE * fraud_txns / txns AS rate FROM weekly)"""
TREND = f"""
SELECT now.iso_week, now.txns, now.fraud_txns, round(now.rate, 3) AS fraud_rate_pct,
       round(avg(past.rate), 3) AS rolling_3wk_avg_fraud_rate
FROM {_RATED} AS now JOIN {_RATED} AS past ON past.k BETWEEN now.k - 2 AND now.k
GROUP BY now.iso_week, now.txns, now.fraud_txns, now.rate"""
_EDGES = " + ".join(f"CAST(coalesce(merchant_risk_score, 1) >= {edge}::DOUBLE AS INTEGER)" for edge in (0.1, 0.2, 0.35))
BUCKET = f"['0.00-0.10', '0.10-0.20', '0.20-0.35', '0.35+'][1 + {_EDGES}]"
BY_BUCKET = f"""
SELECT {BUCKET} AS risk_bucket, count(*) AS txns, {_RATE} AS actual_fraud_rate_pct
FROM transactions GROUP BY 1"""
ANOMALIES = """
SELECT transaction_id, customer_id, amount, round(daily, 2) AS implied_daily_spend,
       round(amount / daily, 1) AS x_over_daily_norm, is_fraud
FROM (SELECT customer_id, avg_monthly_spend / 30.0::DOUBLE AS daily FROM customers) AS norms
JOIN transactions USING (customer_id) WHERE amount > 3.0::DOUBLE * daily
ORDER BY x_over_daily_norm DESC, transaction_id LIMIT 20"""

def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _suite():
    rate = ["txns", "fraud_txns", "fraud_rate_pct"]
    # title, rows, columns; a column of text is marked by a star, the first column names the row
    questions = [
        ("Headline fraud rate", HEADLINE, ["total_transactions", "fraud_transactions", "fraud_rate_pct", "fraud_dollar_loss"]),
        ("Merchant categories by fraud rate", BY_CATEGORY, ["*category", *rate, "fraud_dollar_loss"]),
        ("Fraud rate over the day", BY_HOUR, ["hour_of_day", *rate]),
        ("Customers with the largest fraud losses", TOP_CUSTOMERS, ["customer_id", "*home_city", "fraud_txns", "total_fraud_amount"]),
        ("Fraud rate per week", TREND, ["*iso_week", *rate, "rolling_3wk_avg_fraud_rate"]),
        ("Card-testing pattern", _card_testing_rows(120), ["customer_id", "rapid_repeat_txns", "of_which_fraud", "avg_amount"]),
        ("Fraud rate by merchant risk band", BY_BUCKET, ["*risk_bucket", "txns", "actual_fraud_rate_pct"]),
        ("Purchases far above a customer's norm", ANOMALIES,
         ["transaction_id", "customer_id", "amount", "implied_daily_spend", "x_over_daily_norm", "is_fraud"])]

    def written(column):
        text = column[1:] if column[0] == "*" else f"CAST(round({column}, 3) AS DECIMAL(20, 3))"
        return f"coalesce(CAST({text} AS VARCHAR), 'null')"

    def line(i, title, text, columns, column):
        row = f"{written(columns[0])} || '|' || {written(column)}"
        return (f"SELECT {i} AS query_no, {_text(title)} AS title, '{column.lstrip('*')}' AS column_name, count(*) AS n_rows, "
                f"CAST(coalesce(sum(('0x' || substr(md5({row}), 1, 12))::BIGINT), 0) AS BIGINT) AS digest FROM ({text}) AS q{i}")

    return _q("\nUNION ALL\n".join(
        line(i, title, text, columns, column) for i, (title, text, columns) in enumerate(questions, 1) for column in columns),
        _WEEKLY + _GAPS)


def _nulls():
    columns = {
        "customers": ["customer_id", "home_city", "avg_monthly_spend", "account_age_days"],
        "merchants": ["merchant_id", "category", "merchant_risk_score"],
        "transactions": ["transaction_id", "customer_id", "merchant_id", "category", "timestamp", "amount",
                         "seconds_since_prev_txn", "merchant_risk_score", "is_fraud"]}
    return _q("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (\"{c}\" IS NULL) AS null_rows FROM {t}"
        for t, cs in columns.items() for c in cs))


def _duplicates():
    keys = {"customers": "customer_id", "merchants": "merchant_id", "transactions": "transaction_id"}
    return _q("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS duplicated_keys, "
        f"CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS surplus_rows "
        f"FROM (SELECT {k}, count(*) AS copies FROM {t} GROUP BY {k} HAVING count(*) > 1) AS d_{t}"
        for t, k in keys.items()))


def _orphans():
    return _q("\nUNION ALL\n".join(
        f"SELECT '{k}' AS column_name, count(DISTINCT {k}) AS orphan_keys, count(*) AS orphan_rows "
        f"FROM transactions t WHERE NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{k} = t.{k})"
        for k, p in (("customer_id", "customers"), ("merchant_id", "merchants"))))


def _scaled():
    stats = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in NUMERIC)
    columns = ", ".join(f"round((f.{c} - s.{c}_m) / CASE WHEN s.{c}_s = 0 THEN 1 ELSE s.{c}_s END, 5) + 0.0::DOUBLE AS {c}_z"  # + 0.0: no minus zero
                        for c in NUMERIC)
    return _q(f"SELECT f.transaction_id, {columns} FROM features f CROSS JOIN "
              f"(SELECT {stats} FROM split WHERE part = 'train') s", _FEATURES)


REPORT = """,
r AS (
  SELECT *, tn + fp AS legit, fn + tp AS fraud, tn + fp + fn + tp AS every,
         coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS p0, coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS r0,
         coalesce(2.0::DOUBLE * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0,
         coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1,
         coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM cm)"""

# the declared forest: its score, and what its splits are worth

def _value(branch):
    if len(branch) == 2:
        return branch[0]
    return (_value(branch[2]) * _weight(branch[2]) + _value(branch[3]) * _weight(branch[3])) / _weight(branch)


def _splits(branch, tree):
    """(tree, feature, weight and fraud share of the node and of both children) of every split, as rows of values."""
    if len(branch) == 2:
        return []
    parts = [x for b in (branch, branch[2], branch[3]) for x in (float(_weight(b)), float(_value(b)))]
    return [f"({tree}, '{branch[0]}', {', '.join(f'{x!r}::DOUBLE' for x in parts)})",
            *_splits(branch[2], tree), *_splits(branch[3], tree)]


# Shapley values by their definition: a feature outside the coalition follows both branches by weight
_COALITIONS = range(1 << len(RULE_FEATURES))


def _weight(branch):
    return branch[1] if len(branch) == 2 else _weight(branch[2]) + _weight(branch[3])


def _expected(branch, coalition):
    if len(branch) == 2:
        return f"{branch[0]}::DOUBLE"
    feature, cut, low, high = branch
    a, b = _expected(low, coalition), _expected(high, coalition)
    if coalition >> RULE_FEATURES.index(feature) & 1:
        return f"CASE WHEN {feature} <= {cut} THEN {a} ELSE {b} END"
    return f"({_weight(low)}::DOUBLE * {a} + {_weight(high)}::DOUBLE * {b}) / {_weight(branch)}::DOUBLE"


_ALL = (1 << len(RULE_FEATURES)) - 1
_FOREST = _FEATURES + """,
forest AS (
  SELECT transaction_id, customer_id, category, "timestamp", amount, is_fraud,
         (""" + " + ".join(f"({_expected(t, _ALL)})" for t in RULE_TREES) + f""") / {len(RULE_TREES)}.0::DOUBLE AS raw
  FROM features),
forest_flags AS (
  SELECT * EXCLUDE (raw), round(raw, 4) AS fraud_score, CASE WHEN round(raw, 4) >= 0.4 THEN 1 ELSE 0 END AS flagged FROM forest)"""

_IMPORTANCE = """
splits(tree, feature, w, p, lw, lp, rw, rp) AS (VALUES
  """ + ",\n  ".join(line for i, t in enumerate(RULE_TREES) for line in _splits(t, i)) + """),
worth AS (
  SELECT tree, feature, sum(w * p * (1 - p) - lw * lp * (1 - lp) - rw * rp * (1 - rp)) AS worth FROM splits GROUP BY tree, feature),
shares AS (SELECT feature, sum(worth / whole) AS share FROM worth JOIN (SELECT tree, sum(worth) AS whole FROM worth GROUP BY tree) AS t
           USING (tree) GROUP BY feature),
importance AS (SELECT feature, share / (SELECT sum(share) FROM shares) AS importance FROM shares)"""

_MODELS = _SCORED[len(_FEATURES):] + """,
judged AS (
  SELECT 'rule_norm' AS model, score, is_fraud FROM scored
  UNION ALL SELECT 'rule_forest', fraud_score, is_fraud FROM forest_flags),
cm AS (
  SELECT model, count(*) FILTER (score < 0.5 AND is_fraud = 0) AS tn, count(*) FILTER (score >= 0.5 AND is_fraud = 0) AS fp,
         count(*) FILTER (score < 0.5 AND is_fraud = 1) AS fn, count(*) FILTER (score >= 0.5 AND is_fraud = 1) AS tp
  FROM judged GROUP BY model),
model_scores AS (
  SELECT model, score, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM judged GROUP BY model, score),
model_points AS (
  SELECT model, score, pos, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
         sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp, sum(pos) OVER (PARTITION BY model) AS all_pos
  FROM model_scores)"""


def _shapley(i):
    # of three players: weight 1/3 for coalitions of none or both of the others, 1/6 for those of one
    gains = [f"(v{c | 1 << i} - v{c}) / {(3.0, 6.0, 3.0)[bin(c).count('1')]}::DOUBLE"
             for c in _COALITIONS if not c >> i & 1]
    return " + ".join(gains)


_RULES = _FEATURES + """,
coalitions AS (
  SELECT transaction_id, is_fraud, """ + ", ".join(RULE_FEATURES) + "".join(
    ",\n    (" + " + ".join(f"({_expected(t, c)})" for t in RULE_TREES) + f") / {len(RULE_TREES)}.0::DOUBLE AS v{c}"
    for c in _COALITIONS) + """
  FROM features),
rules AS (""" + "\n  UNION ALL ".join(
    f"SELECT transaction_id, is_fraud, '{f}' AS feature, {f}::DOUBLE AS value, round({_shapley(i)}, 9) AS contribution, "
    "round(v0, 9) AS base_value FROM coalitions" for i, f in enumerate(RULE_FEATURES)) + """),
ranking AS (
  SELECT feature, round(avg(abs(contribution)), 9) AS mean_abs_contribution,
         row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS place FROM rules GROUP BY feature),
fraud_ranking AS (
  SELECT feature, row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS place
  FROM rules WHERE is_fraud = 1 GROUP BY feature),
best AS (
  SELECT transaction_id FROM rules WHERE is_fraud = 1 GROUP BY transaction_id
  ORDER BY round(max(base_value) + sum(contribution), 6) DESC, transaction_id LIMIT 1),
lines AS (
  SELECT *, row_number() OVER (ORDER BY abs(contribution) DESC, feature) AS size
  FROM rules WHERE transaction_id IN (SELECT transaction_id FROM best))"""

SQL = {
    "scan_transactions": _q("SELECT * EXCLUDE (prev_ts) FROM transactions"),
    "scan_customers": _q("SELECT * FROM customers"),
    "scan_merchants": _q("SELECT * FROM merchants"),
    "scan_wide": f"WITH {_WIDE} SELECT vec_id, amount, \"class\", " + ", ".join(
        f"round(embedding[{i + 1}]::DOUBLE, 6) AS f{i}" for i in range(64)) + " FROM wide",
    "load_counts": _q("SELECT (SELECT count(*) FROM customers) AS customers, "
                      "(SELECT count(*) FROM merchants) AS merchants, "
                      "(SELECT count(*) FROM transactions) AS transactions"),
    "query_suite": _suite(),
    "dq_not_null": _nulls(),
    "dq_unique_key": _duplicates(),
    "dq_orphans": _orphans(),
    "dataset_profile": _q("""
SELECT count(*) AS transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
       sum(is_fraud)::DOUBLE / count(*) AS fraud_rate,
       count(*) FILTER (seconds_since_prev_txn < 120) AS rapid_transactions FROM transactions"""),
    "fraud_only": _q("SELECT * EXCLUDE (prev_ts, seconds_since_prev_txn) FROM transactions WHERE is_fraud = 1"),
    "in_category_set": _q("""
SELECT * EXCLUDE (prev_ts, seconds_since_prev_txn) FROM transactions
WHERE category IN ('electronics', 'jewelry', 'online_retail', 'atm_withdrawal')"""),
    "risk_bucket": _q(f"SELECT transaction_id, merchant_risk_score, {BUCKET} AS risk_bucket FROM transactions"),
    "join_customer_norm": _q("""
SELECT t.transaction_id, t.customer_id, t.amount, c.avg_monthly_spend
FROM transactions t LEFT JOIN customers c USING (customer_id)"""),
    "denormalise_merchant": _q("""
SELECT e.transaction_id, e.customer_id, e.merchant_id, e."timestamp", e.amount, m.category, m.merchant_risk_score
FROM charges e JOIN merchants m USING (merchant_id)"""),
    "headline_fraud_rate": _q(HEADLINE),
    "fraud_rate_by_category": _q(BY_CATEGORY),
    "fraud_rate_by_hour": _q(BY_HOUR),
    "top_fraud_customers": _q(TOP_CUSTOMERS),
    "weekly_counts": _q("SELECT * FROM weekly", _WEEKLY),
    "weekly_trend": _q(TREND, _WEEKLY),
    "prev_txn_gap": _q("SELECT * FROM gaps", _GAPS),
    "card_testing_customers": _card_testing(120),
    "card_testing_customers_1h": _card_testing(3600),
    "fraud_rate_by_risk_bucket": _q(BY_BUCKET),
    "spend_anomalies": _q(ANOMALIES),
    "eda_rate_by_category": _q("""
SELECT category, 100.0::DOUBLE * sum(is_fraud) / count(*) AS fraud_rate_pct FROM transactions GROUP BY category"""),
    "eda_rate_by_hour": _q("""
SELECT CAST(hour("timestamp") AS INTEGER) AS hour_of_day, 100.0::DOUBLE * sum(is_fraud) / count(*) AS fraud_rate_pct
FROM transactions GROUP BY 1"""),
    "amount_density": _q("""
SELECT c.is_fraud, CAST(g.bin AS INTEGER) AS bin, round(e.lo + g.bin * e.w, 6) AS lower,
       round(e.lo + (g.bin + 1) * e.w, 6) AS upper, coalesce(h.n, 0) AS n,
       round(coalesce(h.n, 0) / (c.class_n::DOUBLE * e.w), 6) AS density, c.without_log
FROM (SELECT is_fraud, count(*) FILTER (amount > 0) AS class_n,
             count(*) FILTER (coalesce(amount, 0) <= 0) AS without_log FROM transactions GROUP BY is_fraud) AS c
CROSS JOIN range(60) AS g(bin)
CROSS JOIN (SELECT log10(min(amount)) AS lo, (log10(max(amount)) - log10(min(amount))) / 60 AS w
            FROM transactions WHERE amount > 0) AS e
LEFT JOIN (SELECT is_fraud, least(floor((log10(amount) - lo) / w), 59) AS bin, count(*) AS n
           FROM transactions, (SELECT log10(min(amount)) AS lo, (log10(max(amount)) - log10(min(amount))) / 60 AS w
                               FROM transactions WHERE amount > 0) AS ends
           WHERE amount > 0 GROUP BY 1, 2) AS h ON h.is_fraud = c.is_fraud AND h.bin = g.bin"""),
    "label_rate": _q("""
SELECT round(sum(is_fraud)::DOUBLE / count(*), 4) AS label_rate FROM split WHERE part = 'test'""", _FEATURES),
    "wide_label_rate": f"""WITH {_WIDE} SELECT round(sum("class")::DOUBLE / count(*), 5) AS label_rate FROM wide""",
    "seconds_since_prev": _q("""
SELECT transaction_id, customer_id, "timestamp", seconds_since_prev_txn FROM transactions"""),
    "assign_ids_by_time": _q("""
SELECT row_number() OVER (ORDER BY "timestamp", transaction_id) AS transaction_id, "timestamp",
       transaction_id AS event_id, customer_id, amount FROM charges"""),
    "temporal_split": _q("""
SELECT transaction_id, part, min("timestamp") FILTER (part = 'test') OVER () AS split_ts FROM split""", _FEATURES),
    "time_parts": """
SELECT event_id AS transaction_id, ts AS "timestamp", CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CAST((dayofweek(ts) + 6) % 7 AS INTEGER) AS day_of_week, strftime(ts, '%Y-%W') AS iso_week FROM events""",
    "amount_norm": _q("""
SELECT transaction_id, round(amount_vs_customer_norm, 6) AS amount_vs_customer_norm FROM features""", _FEATURES),
    "log_amount": _q("""
SELECT transaction_id, round(ln(1.0::DOUBLE + amount), 9) AS amount, amount AS raw_amount FROM transactions"""),
    "build_features": _q("""
SELECT * REPLACE (round(amount_vs_customer_norm, 6) AS amount_vs_customer_norm) FROM features""", _FEATURES),
    "scaled_features": _scaled(),
    "one_hot_category": _q("SELECT transaction_id, category, " + ", ".join(
        f"CAST(category = '{c}' AS INTEGER) AS category_{c}" for c in sorted(NAMES)) + " FROM transactions"),
    "class_weights": _q("""
SELECT is_fraud, count(*) AS n, (SELECT count(*) FROM split WHERE part = 'train')::DOUBLE / (2 * count(*)) AS weight
FROM split WHERE part = 'train' GROUP BY is_fraud""", _FEATURES),
    "predict_label": _q("""
SELECT transaction_id, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored""", _SCORED),
    "confusion_matrix": _q("SELECT * FROM cm", _CONFUSION),
    "binary_metrics": _q("""
SELECT round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS recall,
       round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, tn, fp, fn, tp FROM cm""",
                         _CONFUSION),
    "classification_report": _q("""
SELECT 'legit' AS class, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1, legit AS support FROM r
UNION ALL SELECT 'fraud', round(p1, 4), round(r1, 4), round(f1, 4), fraud FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, round((tn + tp)::DOUBLE / every, 4), every FROM r
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4), every FROM r
UNION ALL SELECT 'weighted avg', round((p0 * legit + p1 * fraud) / every, 4),
  round((r0 * legit + r1 * fraud) / every, 4), round((f0 * legit + f1 * fraud) / every, 4), every FROM r""",
                                _CONFUSION + REPORT),
    "pr_curve": _q("""
SELECT score AS threshold, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / all_pos, 9) AS recall
FROM points UNION ALL SELECT NULL, 1.0, 0.0""", _SCORED + _CURVE),
    "pr_curve_raw_scores": _q("""
SELECT score AS threshold, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / all_pos, 9) AS recall
FROM points UNION ALL SELECT NULL, 1.0, 0.0""",
                              ", scored AS (SELECT amount AS score, is_fraud FROM transactions)" + _CURVE),
    "average_precision": _q("""
SELECT round(sum(pos * tp::DOUBLE / (tp + fp)) / max(all_pos), 4) AS pr_auc FROM points""", _SCORED + _CURVE),
    "cost_at": _q("SELECT * FROM sweep WHERE threshold = 0.5", _SCORED + _COSTS),
    "threshold_sweep": _q("SELECT * FROM sweep", _SCORED + _COSTS),
    "cost_optimal": _q("SELECT * FROM sweep ORDER BY expected_cost, threshold LIMIT 1", _SCORED + _COSTS),
    "cost_reduction": _q("""
SELECT max(expected_cost) FILTER (threshold = 0.5) AS default_cost, min(expected_cost) AS optimal_cost,
       round(coalesce(100.0::DOUBLE * (max(expected_cost) FILTER (threshold = 0.5) - min(expected_cost))
             / nullif(max(expected_cost) FILTER (threshold = 0.5), 0), 0), 1) AS cost_reduction_pct
FROM sweep""", _SCORED + _COSTS),
    "flag_ranking": _q("""
SELECT transaction_id, customer_id, category, amount, "timestamp", score AS fraud_score
FROM scored WHERE score >= 0.3""", _SCORED),
    "flag_summary": _q("""
SELECT scored, flagged, tp, fp, fn, round(flagged::DOUBLE / scored, 4) AS flagged_share,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 3) AS recall,
       round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 3) AS precision
FROM (SELECT count(*) AS scored, count(*) FILTER (score >= 0.3) AS flagged,
             count(*) FILTER (score >= 0.3 AND is_fraud = 1) AS tp,
             count(*) FILTER (score >= 0.3 AND is_fraud = 0) AS fp,
             count(*) FILTER (score < 0.3 AND is_fraud = 1) AS fn FROM scored) AS c""", _SCORED),
    "top_scored_fraud": _q("""
SELECT * FROM scored WHERE is_fraud = 1 ORDER BY score DESC, transaction_id LIMIT 1""", _SCORED),
    "stratified_keep_all_positive": _q("""
SELECT transaction_id, is_fraud FROM transactions WHERE is_fraud = 1
UNION ALL
SELECT transaction_id, is_fraud FROM (
  SELECT transaction_id, is_fraud,
         row_number() OVER (ORDER BY (transaction_id % 1000003) * 7919 % 1000003, transaction_id) AS place
  FROM transactions WHERE is_fraud = 0) AS legit
WHERE place <= greatest(0, 2000 - (SELECT count(*) FROM transactions WHERE is_fraud = 1))"""),
    "explain_sample": _q("""
SELECT "timestamp", transaction_id, amount, is_fraud FROM split WHERE part = 'test' AND is_fraud = 1
UNION ALL
SELECT "timestamp", transaction_id, amount, is_fraud FROM (
  SELECT *, row_number() OVER (ORDER BY (transaction_id % 1000003) * 7919 % 1000003, transaction_id) AS nth
  FROM split WHERE part = 'test' AND is_fraud = 0) AS legit
WHERE nth <= greatest(0, 2000 - (SELECT count(*) FROM split WHERE part = 'test' AND is_fraud = 1))""", _FEATURES),
    "rule_contributions": _q("SELECT * EXCLUDE (is_fraud) FROM rules", _RULES),
    "rule_mean_contribution": _q("SELECT feature, mean_abs_contribution FROM ranking", _RULES),
    "rule_contribution_points": _q("""
SELECT transaction_id, feature, value, contribution FROM rules JOIN ranking USING (feature) WHERE place <= 2""", _RULES),
    "rule_top_drivers": _q("""
SELECT * EXCLUDE (is_fraud, size) FROM lines ORDER BY contribution DESC, feature LIMIT 2""", _RULES),
    "rule_decision_breakdown": _q("""
SELECT 1 AS position, feature, value, round(contribution, 8) AS contribution, base_value, 1 AS features
FROM lines WHERE size = 1
UNION ALL
SELECT 2, 'other', NULL, round(sum(contribution), 8), max(base_value), count(*) FROM lines WHERE size > 1""", _RULES),
    "rule_importance_overlap": _q("""
SELECT count(*) AS shared, 2 AS "of" FROM ranking JOIN fraud_ranking USING (feature)
WHERE ranking.place <= 2 AND fraud_ranking.place <= 2""", _RULES),
    "scan_transactions_csv": _q("SELECT * EXCLUDE (prev_ts) FROM transactions"),
    "loaded_transactions": _q("SELECT * EXCLUDE (prev_ts) FROM transactions"),
    "loaded_customers": _q("SELECT * FROM customers"),
    "run_sql": _q("""
SELECT home_city, count(*) AS txns, max(amount) AS largest FROM transactions JOIN customers USING (customer_id) GROUP BY home_city"""),
    "flagged_csv": _q("""
SELECT transaction_id, customer_id, category, amount, "timestamp", score AS fraud_score, true AS in_order
FROM scored WHERE score >= 0.3""", _SCORED),
    "metrics_json": _q("""
SELECT round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS recall,
       round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, tn, fp, fn, tp FROM cm""", _CONFUSION),
    "importances_json": _q("SELECT feature, round(mean_abs_contribution, 6) AS importance FROM ranking", _RULES),
    "wide_features": f"""WITH {_WIDE} SELECT vec_id, 65 AS inputs,
       round(list_sum([x::DOUBLE FOR x IN embedding]) + ln(1.0::DOUBLE + amount), 4) AS total FROM wide""",
    "temporal_split_double_key": """
WITH placed AS (SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) - 1 AS place, count(*) OVER () AS n FROM events),
split AS (SELECT *, CASE WHEN place < floor(n * 0.75::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM placed)
SELECT event_id AS transaction_id, value AS amount, part, min(value) FILTER (part = 'test') OVER () AS split_at FROM split""",
    "training_weights": _q("""
, classes AS (SELECT is_fraud, count(*) AS n FROM split WHERE part = 'train' GROUP BY is_fraud),
few AS (SELECT * FROM classes ORDER BY n, is_fraud LIMIT 1),
rates AS (
  SELECT c.is_fraud, c.n, least(1.0::DOUBLE, CASE WHEN c.is_fraud = f.is_fraud THEN 1000.0::DOUBLE
         ELSE 2000.0::DOUBLE - least(1000, f.n) END / c.n) AS rate FROM classes c, few f),
drawn AS (
  SELECT transaction_id, s.is_fraud, rates.n, rate, (SELECT sum(n) FROM classes) AS every,
         ('0x' || substr(md5(epoch_us("timestamp") || '|' || transaction_id), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE AS u
  FROM split s JOIN rates USING (is_fraud) WHERE part = 'train')
SELECT transaction_id, is_fraud, round(every / (2.0::DOUBLE * n) / rate, 9) AS weight FROM drawn WHERE u < rate""", _FEATURES),
    "rule_predict_proba": _q("SELECT transaction_id, round(raw, 9) AS fraud_score FROM forest", _FOREST),
    "rule_score_transactions": _q("""
SELECT transaction_id, customer_id, category, amount, "timestamp", fraud_score FROM forest_flags WHERE flagged = 1""", _FOREST),
    "rule_flag_summary": _q("""
SELECT scored, flagged, tp, fp, fn, round(flagged::DOUBLE / scored, 4) AS flagged_share,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 3) AS recall,
       round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 3) AS precision
FROM (SELECT count(*) AS scored, CAST(sum(flagged) AS BIGINT) AS flagged,
             count(*) FILTER (flagged = 1 AND is_fraud = 1) AS tp, count(*) FILTER (flagged = 1 AND is_fraud = 0) AS fp,
             count(*) FILTER (flagged = 0 AND is_fraud = 1) AS fn FROM forest_flags) AS c""", _FOREST),
    "rule_gini_importance": f"WITH {_IMPORTANCE} SELECT feature, round(importance, 9) AS importance FROM importance",
    "rule_top_importances": f"WITH {_IMPORTANCE} SELECT feature FROM importance ORDER BY importance DESC, feature LIMIT 2",
    "rule_model_comparison": _q("""
SELECT model, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 4) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 4) AS recall,
       round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, pr_auc, tn, fp, fn, tp
FROM cm JOIN (SELECT model, round(sum(pos * tp::DOUBLE / (tp + fp)) / max(all_pos), 4) AS pr_auc FROM model_points GROUP BY model) AS a
     USING (model)""", _FOREST + _MODELS),
    "rule_model_reports": _q("""
SELECT model, 'legit' AS class, round(p0, 4) AS precision, round(r0, 4) AS recall, round(f0, 4) AS f1, legit AS support FROM r
UNION ALL SELECT model, 'fraud', round(p1, 4), round(r1, 4), round(f1, 4), fraud FROM r
UNION ALL SELECT model, 'accuracy', NULL, NULL, round((tn + tp)::DOUBLE / every, 4), every FROM r
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 4), round((r0 + r1) / 2, 4), round((f0 + f1) / 2, 4), every FROM r
UNION ALL SELECT model, 'weighted avg', round((p0 * legit + p1 * fraud) / every, 4),
  round((r0 * legit + r1 * fraud) / every, 4), round((f0 * legit + f1 * fraud) / every, 4), every FROM r""",
                             _FOREST + _MODELS + REPORT),
    "rule_model_curves": _q("""
SELECT model, score AS threshold, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / all_pos, 9) AS recall
FROM model_points UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM model_points""", _FOREST + _MODELS),
    "logistic_gradient": "SELECT unnest([" + ", ".join(
        f"'{f}'" for f in [*NUMERIC, *(f"category_{c}" for c in sorted(NAMES)), "intercept"])
        + "]) AS feature, 0.0::DOUBLE AS gradient",
}
