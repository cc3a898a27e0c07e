"""Model inputs and the two classifiers."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import ratio_or_zero
from ..schemas import FOREST_DEPTH, FOREST_MIN_LEAF, FOREST_TREES, SEED
from ..storage import new_path
from . import explain, growing
from .features import MAX_CATEGORIES, training_statistics
from .forest import walked

LOGISTIC, FOREST = "logistic_regression", "random_forest"
MAX_BINS = 128
SOLVER_ROWS = MAX_BINS ** 2     # up to them the library's solver places its cuts by all rows, beyond them by a sample


def require_inputs(df, columns):
    """Make the job fail by name on a null model input, as it is for an unknown customer.

    The check is part of the row expressions, so it takes no pass of its own.
    """
    def present(column):
        message = F.lit(f"null model input {column}; see the orphan report")
        return F.coalesce(F.col(column), F.raise_error(message).cast(df.schema[column].dataType))

    return df.withColumns({c: present(c) for c in columns})


def input_stages(scaling, categorical=None, values=()):
    """The model-input stages for known statistics: (PipelineModel, feature names).

    Numerics are standardised, the category becomes one slot per value and no slot for an unknown one.
    """
    columns = ", ".join(f"(`{c}` - {mean!r}D) / {dev!r}D AS `{c}_z`" for c, (mean, dev) in scaling.items())
    stages = [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")]
    inputs, names = [f"{c}_z" for c in scaling], list(scaling)
    if categorical:
        spark = SparkSession.active()
        indexer = StringIndexerModel.from_labels(
            list(values), inputCol=categorical, outputCol="_category_index", handleInvalid="keep")
        encoder = OneHotEncoder(inputCol="_category_index", outputCol="_category_slots")
        none = spark.createDataFrame([], f"`{categorical}` string")
        stages += [indexer, encoder.fit(indexer.transform(none))]     # slots known from the labels
        inputs.append("_category_slots")
        names += [f"{categorical}_{v}" for v in values]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return PipelineModel(stages), names


def fit_inputs(train, numeric, categorical=None, most=MAX_CATEGORIES):
    """Fit the model-input stages on the training rows, in one pass: (PipelineModel, feature names).

    Numerics are standardised with the population deviation, the category becomes one slot per
    known value, alphabetical; more than `most` values are refused.
    """
    _, scaling, values = training_statistics(train, None, numeric, categorical, most)
    return input_stages(scaling, categorical, values)


def fit_logistic(train, rows, label, weight="weight"):
    """Balanced logistic regression.

    A sum of losses plus half the squared norm is, per row, the mean loss with regParam 1 / rows;
    the balanced weights add up to the number of rows.
    """
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol=weight, regParam=1.0 / rows,
        elasticNetParam=0.0, standardization=False, maxIter=1000, predictionCol="_lr_label",
        probabilityCol="_lr_probability", rawPredictionCol="_lr_raw").fit(train)


def fit_forest(train, label, weight="weight", trees=FOREST_TREES, depth=FOREST_DEPTH,
               min_leaf=FOREST_MIN_LEAF, seed=SEED):
    """Balanced forest on the 0/1 label; its prediction is the mean weighted fraud share of leaves.

    A regression forest splits as a Gini classifier does (the variance of a 0/1 label is half its
    Gini impurity) and keeps the share of every leaf, where MLlib's classifier merges leaves that
    agree on the majority class.

    Up to SOLVER_ROWS rows the library's solver fits it, with the node that a row has reached in each tree kept
    beside the row. Beyond them the solver would place its cuts by a sample of the rows, and its draws and kept nodes
    (8 bytes a row and tree) would fill the disks: there the forest is grown from counts of all rows, see
    `growing`, and handed over as a model of the same kind.
    """
    solver = RandomForestRegressor(
        featuresCol="features", labelCol=label, weightCol=weight, predictionCol="_forest_score",
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt",
        maxBins=MAX_BINS, maxMemoryInMB=256, cacheNodeIds=True, checkpointInterval=-1, seed=seed)
    kinds, slots = growing.kinds_of(train, label, weight), growing.slots_of(train)
    if kinds is None or sum(n for *_, n in kinds) <= SOLVER_ROWS or any(n != 2 for n in slots.values()):
        return solver.fit(train)
    spark = train.sparkSession
    width = train.select(F.size(vector_to_array("features"))).first()[0]
    nodes = growing.grow(train, label, weight, kinds, width, slots, trees, depth, min_leaf, MAX_BINS, seed, bagged=solver.getBootstrap())
    # bare roots with the same parameters, saved, their nodes replaced and opened again
    path = new_path(spark, "forest")
    one = spark.createDataFrame([(Vectors.dense([0.0] * width), 0.0, 1.0)], ["features", label, weight])
    solver.fit(one).write().save(path)
    spark.createDataFrame(nodes, growing.NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def with_scores(df, logistic, forest):
    """Add the fraud probability of each fitted model; `df` has the features column."""
    scored = with_forest_score(logistic.transform(df), forest)
    return (scored.withColumn(LOGISTIC, vector_to_array("_lr_probability")[1])
            .withColumn(FOREST, F.col("_forest_score"))
            .drop("_lr_label", "_lr_probability", "_lr_raw", "_forest_score"))


def with_forest_score(df, forest):
    """Add _forest_score, the fraud share that a fitted forest predicts; `df` has the features column.

    The solver's own prediction walks one row at a time through a forest that no cache holds; the node
    tables give the same score by batches of rows.
    """
    score = walked(explain.forest_nodes(forest, df.sparkSession))
    return forest.transform(df) if score is None else df.withColumn("_forest_score", score)


def gini_importance(nodes, names):
    """Importances by feature name, largest first, from the node table of a forest (`explain.forest_nodes`).

    A split is worth the impurity of its node less that of its two children, each by training weight;
    the impurity of a node with fraud share p is p (1 - p). A feature's importance in a tree is what
    its splits are worth, as a share of the tree's sum; in the forest it is the mean over trees that
    split, as a share of the whole. Features without a split have none: 0.
    """
    spark = nodes.sparkSession
    impurity = nodes.select("tree", "id", "left", "right", "feature",
                            (F.col("cover") * F.col("value") * (1 - F.col("value"))).alias("impure"))
    below = impurity.select("tree", F.col("id").alias("child"), F.col("impure").alias("rest"))
    splits = impurity.filter(F.col("left") >= 0)
    sides = splits.select("tree", "id", "feature", "impure", F.explode(F.array("left", "right")).alias("child"))
    worth = (sides.join(below, ["tree", "child"]).groupBy("tree", "id", "feature")
             .agg((F.first("impure") - F.sum("rest")).alias("worth")))
    each = worth.groupBy("tree", "feature").agg(F.sum("worth").alias("worth"))
    whole = each.groupBy("tree").agg(F.sum("worth").alias("whole"))
    shares = (each.join(whole, "tree").groupBy("feature").agg(F.sum(ratio_or_zero(F.col("worth"), F.col("whole"))).alias("share")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)     # at most one row a feature
    shares = shares.withColumn("importance", ratio_or_zero(F.col("share"), F.sum("share").over(everything)))
    listed = spark.createDataFrame(list(enumerate(names)), "number int, name string")
    return (listed.join(shares, listed["number"] == shares["feature"], "left")
            .select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def top(ranking, k):
    return ranking.limit(k)
