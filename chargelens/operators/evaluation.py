"""Classifier evaluation from a frame with a 0/1 label and a score.

All operators take `by`, columns whose groups are judged apart (such as the model that gave the
score), and `n`, a column that says for how many rows a row stands (one unless given). So several
models are judged from one small table of counts, see `stack_scores` and `count_scores`.
"""

from pyspark.sql import functions as F

from ..functions.expressions import present, ratio_or_zero
from ..schemas import DEFAULT_THRESHOLD
from .ordered import running_totals


def predict_label(scored, threshold=DEFAULT_THRESHOLD, score="score", ties=1):
    """Add the 0/1 decision; a score equal to the threshold gets `ties`, so is flagged unless told otherwise."""
    limit = F.lit(float(threshold))
    return scored.withColumn("predicted", (present(score) >= limit if ties else present(score) > limit).cast("int"))


def stack_scores(scored, models, keep=("is_fraud",)):
    """One row per row and model: the columns of `keep`, model, score. `models` are score columns."""
    return scored.select(*keep, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models])))


def count_scores(scored, label="is_fraud", score="score", by=("model",)):
    """Rows by group, score and label: all that the operators below need, from one pass over the scores."""
    return scored.groupBy(*by, present(score).alias(score), label).agg(F.count(F.lit(1)).alias("n"))


def _total(condition, n):
    return F.coalesce(F.sum(F.when(condition, F.lit(1) if n is None else F.col(n)).cast("bigint")), F.lit(0).cast("bigint"))


def confusion_matrix(scored, threshold=DEFAULT_THRESHOLD, label="is_fraud", score="score", by=(), n=None):
    """One row a group: tn, fp, fn, tp."""
    flagged = present(score) >= F.lit(float(threshold))
    fraud = F.col(label) == 1
    return scored.groupBy(*by).agg(
        _total(~flagged & ~fraud, n).alias("tn"), _total(flagged & ~fraud, n).alias("fp"),
        _total(~flagged & fraud, n).alias("fn"), _total(flagged & fraud, n).alias("tp"))


def binary_metrics(scored, threshold=DEFAULT_THRESHOLD, label="is_fraud", score="score", by=(), n=None):
    """Precision, recall and F1 of the fraud class to 4 places, 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion_matrix(scored, threshold, label, score, by, n).select(
        *by, F.round(ratio_or_zero(tp, tp + fp), 4).alias("precision"),
        F.round(ratio_or_zero(tp, tp + fn), 4).alias("recall"),
        F.round(ratio_or_zero(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        "tn", "fp", "fn", "tp")


def classification_report(scored, threshold=DEFAULT_THRESHOLD, label="is_fraud", score="score", by=(), n=None):
    """Rows legit, fraud, accuracy, macro avg and weighted avg.

    Accuracy is given in the f1 column, where such reports print it.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    legit, fraud, every = tn + fp, fn + tp, tn + fp + fn + tp

    def of_class(hit, false_alarm, miss):
        return (ratio_or_zero(hit, hit + false_alarm), ratio_or_zero(hit, hit + miss),
                ratio_or_zero(2 * hit, 2 * hit + false_alarm + miss))

    a, b = of_class(tn, fn, fp), of_class(tp, fp, fn)
    macro = [(x + y) / 2 for x, y in zip(a, b)]
    weighted = [ratio_or_zero(x * legit + y * fraud, every) for x, y in zip(a, b)]
    nothing = F.lit(None).cast("double")

    def line(name, values, support):
        return F.struct(F.lit(name).alias("class"), *[
            F.round(v, 4).alias(c) for v, c in zip(values, ("precision", "recall", "f1"))],
            support.alias("support"))

    rows = F.array(line("legit", a, legit), line("fraud", b, fraud),
                   line("accuracy", (nothing, nothing, ratio_or_zero(tn + tp, every)), every),
                   line("macro avg", macro, every), line("weighted avg", weighted, every))
    return confusion_matrix(scored, threshold, label, score, by, n).select(*by, F.inline(rows))


def score_counts(scored, label="is_fraud", score="score", by=(), n=None):
    """Frauds and legit rows per distinct score."""
    return scored.groupBy(*by, present(score).alias("score")).agg(
        _total(F.col(label) == 1, n).alias("pos"), _total(F.col(label) == 0, n).alias("neg"))


def _cumulative(scored, label, score, places, by, n):
    if places is not None:      # plain arithmetic; a decimal rounding per row costs far more
        unit = F.lit(10.0 ** places)
        inside = F.when(present(score).between(0, 1), F.col(score)).otherwise(
            F.raise_error(F.lit(f"{score} is not between 0 and 1; leave out places")).cast("double"))
        scored = scored.withColumn(score, F.floor(inside * unit + 0.5) / unit)
    return running_totals(score_counts(scored, label, score, by, n), [F.desc("score")],
                          {"tp": "pos", "fp": "neg"}, bounded=places is not None, by=by)


def pr_curve(scored, label="is_fraud", score="score", places=None, by=(), n=None):
    """Precision and recall at every distinct score, and the end point (recall 0, precision 1).

    `places` rounds the scores, which bounds their number (10,001 for 4 places) and lets a single
    small window do the sums; raw scores take the distributed running sum. Scores to be rounded must be
    in [0, 1], else the job fails by name.
    """
    curve = _cumulative(scored, label, score, places, by, n).select(
        *by, F.col("score").alias("threshold"),
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("tp_all")).alias("recall"))
    groups = scored.select(*by).distinct() if by else scored.sparkSession.range(0, 1, numPartitions=1)
    end = groups.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                        F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


def average_precision(scored, label="is_fraud", score="score", places=None, by=(), n=None):
    """Area under the curve as the step sum of (recall gain) * precision, to 4 places."""
    points = _cumulative(scored, label, score, places, by, n)
    step = F.col("pos") * ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp"))
    return points.groupBy(*by).agg(F.round(ratio_or_zero(F.sum(step), F.sum("pos")), 4).alias("pr_auc"))


def compare_models(counts, threshold=DEFAULT_THRESHOLD, label="is_fraud", by=("model",), n="n"):
    """One row a model: metrics at the threshold, average precision and confusion counts, from `count_scores`."""
    return (binary_metrics(counts, threshold, label, by=by, n=n)
            .join(average_precision(counts, label, by=by, n=n), list(by))
            .select(*by, "precision", "recall", "f1", "pr_auc", "tn", "fp", "fn", "tp"))
