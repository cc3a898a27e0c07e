"""Score transactions with a saved model and rank them for review."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import explain, features, forest, models, scoring
from ..sources import artifacts, tables
from ..storage import materialize


def apply_model(frame, artifact):
    """Add fraud_score to 4 places and the 0/1 flag to a feature frame.

    A forest of few nodes is scored by generated code, a larger one by the saved inputs and a walk of its node tables.
    """
    frame = models.require_inputs(frame, [*artifact.features_num, *artifact.features_cat])
    categorical = artifact.features_cat[0] if artifact.features_cat else None
    score = None
    if artifact.forest.totalNumNodes <= forest.EXPRESSION_NODES:
        inputs = forest.pipeline_inputs(artifact.inputs, artifact.features_num, categorical)
        score = forest.compiled(explain.forest_nodes(artifact.forest, frame.sparkSession), inputs)
    if score is None:
        scored = models.with_forest_score(artifact.inputs.transform(frame), artifact.forest)
    else:
        scored = frame.withColumn("_forest_score", score)
    return scoring.flag(scored.withColumn("fraud_score", F.round(F.col("_forest_score"), 4)).select(*frame.columns, "fraud_score"),
                        artifact.threshold)


def score(spark, txns, customers, model_folder, fmt="csv"):
    """Scored and flagged transactions from a frame or a path to a file with the same columns."""
    artifact = artifacts.load(spark, model_folder)
    if not isinstance(txns, DataFrame):
        txns = tables.scan_transactions(spark, txns, fmt)
    if not isinstance(customers, DataFrame):
        customers = tables.scan_customers(spark, customers, fmt)
    return apply_model(features.build_features(txns, customers), artifact)


def ranked(flagged):
    """Flagged rows for review, highest score first.

    Written down before the sort: a range partitioning samples its input first, and rows that
    come from disk are not scored a second time for that.
    """
    return scoring.flag_ranking(materialize(flagged.filter("flagged = 1")))


def write_flagged(flagged, path):
    tables.write_csv(ranked(flagged), path)
