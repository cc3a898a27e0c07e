"""Explanations of a small declared forest: every way a contribution can arise, checkable by hand."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..operators import explain, forest, models, scoring
from ..storage import materialize

FEATURES = ["amount", "hour_of_day", "merchant_risk_score"]
# (feature, cut, branch up to the cut, branch above); a leaf is (value, training weight)
TREES = [
    ("amount", 150.0, ("hour_of_day", 4.0, (0.3, 120.0), (0.05, 480.0)),
     ("hour_of_day", 4.0, (0.9, 60.0), (0.4, 140.0))),
    ("hour_of_day", 11.0, ("merchant_risk_score", 0.2, (0.1, 250.0), (0.5, 150.0)),
     ("amount", 300.0, (0.02, 300.0), (0.2, 100.0))),
    ("merchant_risk_score", 0.3, ("amount", 50.0, (0.0, 200.0), ("hour_of_day", 20.0, (0.25, 100.0), (0.45, 100.0))),
     (0.6, 400.0)),
]
NODES = ("tree int, id int, value double, cover double, left int, right int, feature int, "
         "split array<double>, categories int")


def _grow(tree, branch, rows):
    """Append the nodes of a branch to `rows`; returns (number, weight) of its root."""
    number = len(rows)
    rows.append(None)
    if len(branch) == 2:
        value, weight = branch
        rows[number] = (tree, number, value, weight, -1, -1, -1, [], -1)
        return number, weight
    feature, cut, low, high = branch
    left, below = _grow(tree, low, rows)
    right, above = _grow(tree, high, rows)
    mean = (rows[left][2] * below + rows[right][2] * above) / (below + above)
    rows[number] = (tree, number, mean, below + above, left, right, FEATURES.index(feature), [cut], -1)
    return number, below + above


def nodes(spark, trees=None):
    """The declared trees, one row a node, as `explain.forest_nodes` gives those of a fitted forest."""
    found = []
    for tree, branch in enumerate(TREES if trees is None else trees):
        rows = []
        _grow(tree, branch, rows)
        found += rows
    return spark.createDataFrame(found, NODES)


def _inputs(txns):
    return txns.withColumn("hour_of_day", F.hour("timestamp"))


def vectors(txns):
    """Contribution vectors of every transaction to 9 places, written once."""
    values = explain.display_values(FEATURES)
    rows = _inputs(txns).select("transaction_id", array_to_vector(values).alias("features"), values.alias("values"))
    leaves = materialize(explain.leaf_paths(nodes(txns.sparkSession)))
    found = explain.contribution_vectors(rows, leaves, FEATURES)
    return materialize(found.withColumns({"contributions": F.transform("contributions", lambda c: F.round(c, 9)),
                                          "base_value": F.round("base_value", 9)}))


def contributions(found):
    return explain.long_form(found, FEATURES)


def ranking(found):
    return explain.mean_abs_contribution(found, FEATURES).withColumn(
        "mean_abs_contribution", F.round("mean_abs_contribution", 9))


def top_fraud(found, txns):
    """Contributions of the fraud with the highest score."""
    scores = found.select("transaction_id", F.round(
        F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c), 6).alias("score"))
    best = scoring.top_scored_fraud(scores.join(txns.select("transaction_id", "is_fraud"), "transaction_id"))
    return contributions(found.join(F.broadcast(best.select("transaction_id")), "transaction_id", "left_semi"))


def overlap(found, txns, k=2):
    """How many features lead both among all transactions and among the frauds."""
    frauds = txns.filter("is_fraud = 1").select("transaction_id")
    return explain.importance_overlap(ranking(found), ranking(found.join(frauds, "transaction_id", "left_semi")), k)


# ---------------------------------------------------------------------- scores

def scored(txns):
    """The transactions with fraud_score, the declared forest compiled to nested comparisons."""
    score = forest.compiled(nodes(txns.sparkSession), FEATURES)
    return _inputs(txns).withColumn("fraud_score", score).select(*txns.columns, "fraud_score")


def flagged(txns, threshold=0.4):
    rounded = scored(txns).withColumn("fraud_score", F.round("fraud_score", 4))
    return scoring.flag(rounded, threshold)


def importance(spark):
    return models.gini_importance(nodes(spark), FEATURES)
