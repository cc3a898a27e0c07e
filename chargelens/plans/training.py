"""Train both models on the earlier transactions, judge them on the later ones."""

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cost, evaluation, features, models, ordered, profile
from ..schemas import (DEFAULT_THRESHOLD, FEATURES_CAT, FEATURES_NUM, FOREST_TREES, ORDER, REVIEW_COST,
                       TARGET, TEST_FRACTION)
from ..sources import artifacts
from ..storage import materialize

MODELS = [models.LOGISTIC, models.FOREST]
PARTITION_ROWS = 5_000      # training rows in a partition, until there are FEW_PARTITIONS
FEW_PARTITIONS = 24
LARGE_ROWS = 100_000        # beyond them partitions grow to that many rows
MOST_PARTITIONS = 256


@dataclass
class Layout:
    """Which columns of a table play which part in training."""
    order: list             # time order, unique; never a model input
    label: str
    amount: str             # dollars lost with a missed fraud
    numeric: list
    categorical: str = None
    places: int = 4         # of the reported label rates

    @property
    def columns(self):
        wanted = [*self.order, self.label, self.amount, *self.numeric]
        wanted += [self.categorical] if self.categorical else []
        return list(dict.fromkeys(wanted))


CARD = Layout(order=ORDER, label=TARGET, amount="amount", numeric=FEATURES_NUM,
              categorical=FEATURES_CAT[0])


@dataclass
class Trained:
    layout: Layout
    inputs: PipelineModel
    logistic: object
    forest: object
    feature_names: list
    table: DataFrame        # the whole feature table
    test: DataFrame
    scored: DataFrame       # order keys, label, amount, one score column per model; test rows
    split_at: tuple
    rows: int
    classes: dict           # training rows of each class
    fit_rows: int           # bound on the rows that the solvers read, None for all of them

    @property
    def train_rows(self):
        return sum(self.classes.values())

    @property
    def pipeline(self):
        return PipelineModel([*self.inputs.stages, self.forest])

    def fitted(self):
        """The training rows that the solvers read, with their weight."""
        early = self.table.filter(ordered.before(self.split_at, self.layout.order))
        return features.balanced_draw(early, self.layout.label, self.classes, self.layout.order, self.fit_rows)

    @cached_property
    def counts(self):
        """Scored rows by model, score and label, written: one scan of the scores for all evaluations of all models."""
        stacked = evaluation.stack_scores(self.scored, MODELS, [self.layout.label])
        return materialize(evaluation.count_scores(stacked, self.layout.label))

    def scores(self, model):
        keep = list(dict.fromkeys([*self.layout.order, self.layout.label, self.layout.amount]))
        return self.scored.select(*keep, F.col(model).alias("score"))

    def sweep(self, model=models.FOREST, review_cost=REVIEW_COST):
        return cost.threshold_sweep(self.scores(model), review_cost=review_cost,
                                    label=self.layout.label, amount=self.layout.amount)


def fit_partitions(rows):
    """Partitions for that many rows: a function of the data, never of cores or files."""
    few = min(FEW_PARTITIONS, -(-rows // PARTITION_ROWS))
    return max(1, min(MOST_PARTITIONS, max(few, -(-rows // LARGE_ROWS))))


def train(table, layout=CARD, trees=FOREST_TREES, test_fraction=TEST_FRACTION, fit_rows=None,
          max_categories=features.MAX_CATEGORIES):
    """Fit on the earlier rows and score the later ones.

    The feature table and the scored test rows are each written once. Class sizes, scaling and
    categories are exact, from one pass over all training rows, and the solvers read all of them. Only if a
    caller gives `fit_rows` and there are more, rows are drawn by a hash of their order keys, rare classes whole
    as far as possible, and weigh the inverse of their chance to be drawn. The rows are dealt over
    partitions whose number follows from that of the rows, by a hash of the order keys, and sorted
    in each, because the forest draws its samples per partition: the model depends on the data
    alone, not on cores, files or the order of writing. The dealt rows are kept as their plain columns; model
    inputs are made of them in each pass.
    """
    table = materialize(models.require_inputs(table.select(*layout.columns), layout.columns))
    early, late, split_at = ordered.temporal_split(table, test_fraction, layout.order)
    classes, scaling, values = features.training_statistics(
        early, layout.label, layout.numeric, layout.categorical, max_categories)
    inputs, names = models.input_stages(scaling, layout.categorical, values)
    rates = features.draw_rates(classes, fit_rows)
    partitions = fit_partitions(sum(math.ceil(rates[c] * n) for c, n in classes.items()))
    drawn = (features.balanced_draw(early, layout.label, classes, layout.order, fit_rows)
             .repartition(partitions, *layout.order).sortWithinPartitions(*layout.order)).persist()
    ready = inputs.transform(drawn).select("features", F.col(layout.label).cast("double").alias("label"), "weight")
    logistic = models.fit_logistic(ready, sum(classes.values()), "label")
    forest = models.fit_forest(ready, "label", trees=trees)
    drawn.unpersist()
    keep = list(dict.fromkeys([*layout.order, layout.label, layout.amount]))
    scored = materialize(models.with_scores(inputs.transform(late), logistic, forest)
                         .select(*keep, *MODELS))
    return Trained(layout, inputs, logistic, forest, names, table, late, scored, split_at,
                   table.count(), classes, fit_rows)


def train_cards(txns, customers, **settings):
    return train(features.build_features(txns, customers), CARD, **settings)


def logistic_gradient(run):
    """(feature, gradient): size of the gradient of the logistic loss per row at the fitted coefficients.

    The loss is strictly convex, so the solution is the one place where all of it vanishes. One pass
    over the rows it was fitted on.
    """
    rows = run.logistic.transform(run.inputs.transform(run.fitted()))
    error = F.col("weight") * (vector_to_array("_lr_probability")[1] - F.col(run.layout.label))
    names = run.feature_names
    sums = rows.select(error.alias("e"), vector_to_array("features").alias("x")).agg(
        *[F.sum(F.col("e") * F.col("x")[i]).alias(f"s{i}") for i in range(len(names))], F.sum("e").alias("s"))
    parts = [(n, F.col(f"s{i}") + F.lit(float(c))) for i, (n, c) in enumerate(zip(names, run.logistic.coefficients))]
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.abs(g / F.lit(float(run.train_rows))).alias("gradient"))
        for n, g in [*parts, ("intercept", F.col("s"))]])))


def model_comparison(run):
    """One row per model: metrics at 0.5, average precision, confusion counts."""
    return evaluation.compare_models(run.counts, label=run.layout.label)


def pr_curves(run):
    return evaluation.pr_curve(run.counts, label=run.layout.label, by=["model"], n="n")


# ------------------------------------------------------------ metrics document

_COST_ROW = ("struct<threshold: double, precision: double, recall: double, false_positives: bigint, "
             "missed_frauds: bigint, dollars_lost_to_missed_fraud: double, expected_cost: double>")
_MODEL_ROW = ("struct<precision: double, recall: double, f1: double, pr_auc: double, "
              "confusion_matrix: array<array<bigint>>>")
DOCUMENT = (
    "source string, n_transactions bigint, fraud_rate double, "
    "split struct<first_test_row: string, train_rows: bigint, test_rows: bigint>, "
    "test_fraud_rate double, cost_model struct<review_cost: double, missed_fraud: string>, "
    f"threshold_analysis struct<default: {_COST_ROW}, cost_optimal: {_COST_ROW}, "
    "cost_reduction_vs_default_pct: double>, "
    f"logistic_regression {_MODEL_ROW}, random_forest {_MODEL_ROW}")


def model_reports(run):
    """The per-class report of both models at 0.5."""
    return evaluation.classification_report(run.counts, label=run.layout.label, by=["model"], n="n")


def metrics_document(run, review_cost=REVIEW_COST, source=None):
    """The published metrics as one nested row, assembled from a few one-row results.

    `source` says where the table came from.
    """
    spark, layout = run.table.sparkSession, run.layout
    sweep = run.sweep(review_cost=review_cost).collect()    # one row per grid point
    optimal = min(sweep, key=lambda r: (r["expected_cost"], r["threshold"]))
    default = next(r for r in sweep if r["threshold"] == DEFAULT_THRESHOLD)
    saved = default["expected_cost"] - optimal["expected_cost"]
    per_model = {}
    for r in model_comparison(run).collect():
        per_model[r["model"]] = (r["precision"], r["recall"], r["f1"], r["pr_auc"],
                                 [[r["tn"], r["fp"]], [r["fn"], r["tp"]]])
    rate = profile.label_rate(run.table, layout.label, layout.places).first()[0]
    test_rate = profile.label_rate(run.scored, layout.label, layout.places).first()[0]
    row = (source, run.rows, rate, (str(run.split_at[0]), run.train_rows, run.rows - run.train_rows), test_rate,
           (float(review_cost), f"{layout.amount} of the transaction"),
           (tuple(default), tuple(optimal),
            round(100 * saved / default["expected_cost"], 1) if default["expected_cost"] else 0.0),
           per_model[models.LOGISTIC], per_model[models.FOREST])
    return spark.createDataFrame([row], DOCUMENT)


def to_artifact(run):
    """The forest with its cost-optimal threshold, ready to save."""
    best = cost.cost_optimal(run.sweep()).first()
    auc = evaluation.average_precision(run.counts.filter(F.col("model") == models.FOREST), run.layout.label, n="n").first()[0]
    categorical = [run.layout.categorical] if run.layout.categorical else []
    return artifacts.Artifact(run.pipeline, best["threshold"], list(run.layout.numeric), categorical,
                              run.feature_names, artifacts.now(), run.train_rows, auc)


# ----------------------------------------------------------------- wide tables

def wide_layout(df, order, label, amount):
    """Every column but the label and the order keys is a model input."""
    numeric = [c for c in df.columns if c not in (label, "raw_amount", *order)]
    return Layout(order=list(order), label=label, amount="raw_amount", numeric=numeric, places=5)


def train_wide(df, order, label, amount, **settings):
    """The same training on an anonymised numeric table; the amount enters as ln(1 + amount).

    Rows equal in a single order key are told apart by a hash of all columns, so that the split
    still cuts at the exact row.
    """
    ready = features.log_amount(df, amount)
    if len(order) == 1:
        ready = ready.withColumn("_tie", F.shiftrightunsigned(F.xxhash64(*df.columns), 1))
        order = [*order, "_tie"]
    return train(ready, wide_layout(ready, order, label, amount), **settings)
