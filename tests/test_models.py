import json
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from chargelens.operators import evaluation, explain, features, forest, models, scoring
from chargelens.plans import scoring as job
from chargelens.plans import training
from chargelens.schemas import FEATURES_NUM
from chargelens.sources import artifacts, driver_views, tables

from .frames import rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def customers(spark):
    return driver_views.customer_spend(spark, SF)


@pytest.fixture(scope="module")
def txns(spark):
    return driver_views.transactions(spark, SF, gaps=True)


@pytest.fixture(scope="module")
def run(txns, customers):
    return training.train_cards(txns, customers)


@pytest.fixture(scope="module")
def model_folder(run, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("model"))
    artifacts.save(training.to_artifact(run), folder, spark)
    return folder


def test_split_sizes(run):
    assert (run.rows, run.train_rows, run.test.count()) == (10_000, 7_500, 2_500)


def test_forest_clears_the_floor(run):
    best = {r["model"]: r for r in training.model_comparison(run).collect()}[models.FOREST]
    assert best["recall"] > 0.85 and best["pr_auc"] > 0.85


def test_optimal_threshold_is_no_worse_than_the_default(run):
    document = json.loads(training.metrics_document(run).toJSON().first())
    analysis = document["threshold_analysis"]
    assert 0 < analysis["cost_optimal"]["threshold"] < 1
    assert analysis["cost_optimal"]["expected_cost"] <= analysis["default"]["expected_cost"]
    assert document["split"] | {"first_test_row": None} == {
        "first_test_row": None, "train_rows": 7500, "test_rows": 2500}
    (tn, fp), (fn, tp) = document["random_forest"]["confusion_matrix"]
    assert tn + fp + fn + tp == 2500 and document["random_forest"]["recall"] == round(tp / (tp + fn), 4)


def test_logistic_minimises_the_penalised_sum_of_losses(run, spark):
    """Against Newton's method on sum_i w_i loss_i + |b|^2 / 2, intercept free."""
    early = run.table.filter(~F.col("transaction_id").isin([]))
    train = early.join(run.test.select("transaction_id"), "transaction_id", "left_anti")
    data = run.inputs.transform(train).select(vector_to_array("features").alias("x"), "is_fraud").toPandas()
    x = np.column_stack([np.stack(data["x"]), np.ones(len(data))])
    y = data["is_fraud"].to_numpy(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    penalty = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        gradient = x.T @ (w * (p - y)) + penalty @ b
        b -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, gradient)
    got = np.append(run.logistic.coefficients.toArray(), run.logistic.intercept)
    assert np.abs(got - b).max() < 1e-3


def test_scaling_uses_the_population_deviation_of_the_training_rows(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, b int")
    scaling = features.fit_scaling(df, ["a", "b"])
    assert scaling == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert rows(features.scale_features(df, scaling), "a_z", "b_z") == [(-1.0, 0.0), (1.0, 0.0)]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "is_fraud int")
    weights = features.class_weights(df).collect()
    assert {(r["is_fraud"], r["n"], r["weight"]) for r in weights} == {(0, 6, 8 / 12), (1, 2, 2.0)}
    balanced = features.balanced_weights({r["is_fraud"]: r["n"] for r in weights})
    assert balanced == {0: 8 / 12, 1: 2.0}
    assert df.agg(F.sum(features.weight_column(balanced))).first()[0] == pytest.approx(8)


def test_statistics_of_one_pass(spark):
    df = spark.range(1, 1001).select((F.col("id") % 7 == 0).cast("int").alias("y"), (F.col("id") * 1e9 + F.col("id") % 13).alias("a"),
                                     F.lit(3).alias("b"), F.format_string("c%d", F.col("id") % 4).alias("c"))
    classes, scaling, values = features.training_statistics(df, "y", ["a", "b"], "c")
    plain = df.agg(F.avg("a"), F.stddev_pop("a")).first()
    assert classes == {0: 858, 1: 142} and values == ["c0", "c1", "c2", "c3"]
    assert scaling["a"] == (pytest.approx(plain[0]), pytest.approx(plain[1])) and scaling["b"] == (3.0, 1.0)
    assert features.training_statistics(df.limit(0), "y", ["a"], "c") == ({}, {"a": (0.0, 1.0)}, [])


def test_draw(spark):
    assert features.draw_rates({0: 100, 1: 10}, 200) == {0: 1.0, 1: 1.0}
    assert features.draw_rates({0: 1000, 1: 10}, 110) == {0: 0.1, 1: 1.0}
    assert features.draw_rates({0: 1000, 1: 500}, 300) == {0: 0.15, 1: 0.3}
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 50 == 0).cast("int").alias("y"))
    drawn = features.balanced_draw(df, "y", {0: 19_600, 1: 400}, ["k"], 2_400)
    assert drawn.filter("y = 1").count() == 400 and abs(drawn.count() - 2_400) < 250
    sums = {r["y"]: r["w"] for r in drawn.groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert sums[1] == pytest.approx(10_000) and abs(sums[0] - 10_000) < 800
    again = features.balanced_draw(df.repartition(9), "y", {0: 19_600, 1: 400}, ["k"], 2_400)
    assert again.exceptAll(drawn).count() == 0
    whole = features.balanced_draw(df, "y", {0: 19_600, 1: 400}, ["k"], 20_000)
    assert whole.count() == 20_000


def test_a_bounded_fit_learns_as_well(txns, customers):
    run = training.train_cards(txns, customers, trees=20, fit_rows=1_500)
    assert run.fitted().count() < 1_700 and run.train_rows == 7_500
    best = {r["model"]: r for r in training.model_comparison(run).collect()}[models.FOREST]
    assert best["recall"] > 0.85 and best["pr_auc"] > 0.85
    assert training.logistic_gradient(run).agg(F.max("gradient")).first()[0] < 1e-3


def test_partitions_follow_the_rows():
    assert [training.fit_partitions(n) for n in (0, 1, 5_000, 5_001, 75_000, 10**9)] == [1, 1, 1, 2, 15, 256]


def test_partitions_do_not_grow_faster_than_their_work():
    """A partition beyond the first 24 holds 100,000 rows, so that counts of nodes are a small part of what it does."""
    found = [training.fit_partitions(n) for n in (120_000, 450_000, 2_400_000, 4_500_000, 20_000_000)]
    assert found == [24, 24, 24, 45, 200]


def test_kept_nodes_give_the_same_forest(spark):
    """Rows remember their nodes; trees equal those of a solver that walks them for each level."""
    df = spark.range(2_000).select(
        F.array(*[(F.col("id") * k % 101).cast("double") for k in (37, 53, 71)]).alias("x"), F.lit(1.0).alias("weight"),
        (F.col("id") * 37 % 101 + F.col("id") * 53 % 101 > 110).cast("double").alias("label"))
    ready = df.select(array_to_vector("x").alias("features"), "weight", "label").repartition(3, "features").persist()
    forest = models.fit_forest(ready, "label", trees=6)
    assert forest.getCacheNodeIds()
    walked = RandomForestRegressor(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=6, maxDepth=10, minInstancesPerNode=5,
        featureSubsetStrategy="sqrt", maxBins=128, maxMemoryInMB=1024, seed=42).fit(ready)
    ready.unpersist()
    assert forest.totalNumNodes > 100
    assert [t.toDebugString.split("\n")[1:] for t in forest.trees] == [t.toDebugString.split("\n")[1:] for t in walked.trees]


def test_kept_nodes_are_not_written_down(spark):
    """The fit leaves the checkpoint folder alone; a checkpoint would hold 4 bytes a training row and tree."""
    df = spark.range(200).select(array_to_vector(F.array(F.col("id") * 37.0 % 101)).alias("features"),
                                 F.lit(1.0).alias("weight"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    assert models.fit_forest(df, "label", trees=2).getCheckpointInterval() == -1


CORES = """
import sys
from chargelens.session import local_session
from chargelens.plans import training
from chargelens.sources import driver_views
spark = local_session(sys.argv[1])
run = training.train_cards(driver_views.transactions(spark, sys.argv[2], gaps=True), driver_views.customer_spend(spark, sys.argv[2]),
                           trees=2, fit_rows=600)
print("MODEL", run.forest.totalNumNodes, [repr(float(x)) for x in run.forest.featureImportances.toArray()],
      [round(float(x), 6) for x in run.logistic.coefficients])
"""


def test_the_same_model_on_two_and_eight_cores():
    root = str(Path(__file__).resolve().parent.parent)
    found = [subprocess.run([sys.executable, "-c", CORES, cores, SF.replace("0.01", "0.001")], cwd=root, capture_output=True, text=True, timeout=600).stdout
             for cores in ("2", "8")]
    assert "MODEL" in found[0] and found[0] == found[1]


def test_importances_equal_those_of_the_solver(run, spark):
    ours = {r["feature"]: r["importance"] for r in
            models.gini_importance(explain.forest_nodes(run.forest, spark), run.feature_names).collect()}
    theirs = dict(zip(run.feature_names, run.forest.featureImportances.toArray()))
    assert ours.keys() == theirs.keys()
    assert max(abs(ours[f] - theirs[f]) for f in ours) < 1e-6


def test_a_compiled_forest_scores_like_the_solver(spark, txns, customers):
    run = training.train_cards(txns, customers, trees=3, fit_rows=700)
    nodes = explain.forest_nodes(run.forest, spark)
    inputs = forest.pipeline_inputs(run.inputs, run.layout.numeric, run.layout.categorical)
    assert nodes.filter("categories > 0").count() > 0 and len(inputs) == len(run.feature_names)
    score = forest.compiled(nodes, inputs)
    ours = run.test.withColumn("ours", score)
    assert "Python" not in ours._jdf.queryExecution().toString()
    worst = ours.join(run.scored, "transaction_id").agg(F.max(F.abs(F.col("ours") - F.col(models.FOREST)))).first()[0]
    assert worst == 0.0
    assert forest.compiled(nodes, inputs, most=5) is None
    job_scores = job.apply_model(run.test, training.to_artifact(run))
    assert job_scores.join(run.scored, "transaction_id").filter(
        F.col("fraud_score") != F.round(models.FOREST, 4)).count() == 0


def test_a_large_forest_is_scored_by_batches_like_the_solver(spark, run):
    """Training and the scoring job walk node tables; the scores equal the solver's, bit for bit."""
    assert run.forest.totalNumNodes > forest.EXPRESSION_NODES
    ready = run.inputs.transform(run.test)
    ours = models.with_forest_score(ready, run.forest)
    assert "walk(" in ours._jdf.queryExecution().toString()
    assert "walk(" in job.apply_model(run.test, training.to_artifact(run))._jdf.queryExecution().toString()
    both = run.forest.transform(ours.withColumnRenamed("_forest_score", "walked"))
    assert both.filter("walked = _forest_score").count() == both.count() == 2500
    kept = run.scored.join(both.select("transaction_id", "walked"), "transaction_id")
    assert kept.filter(F.col("walked") == F.col(models.FOREST)).count() == 2500


def test_walk_of_odd_trees_and_rows(spark):
    """Cuts are met by equal values, a NaN goes up, a 0/1 slot may go either way, a bare root has one value, no rows no scores."""
    nodes = spark.createDataFrame([
        (0, 0, 0.5, 4.0, 1, 2, 0, [1.0], -1), (0, 1, 0.1, 2.0, -1, -1, -1, [], -1), (0, 2, 0.2, 2.0, 3, 4, 1, [1.0], 2),
        (0, 3, 0.3, 1.0, -1, -1, -1, [], -1), (0, 4, 0.4, 1.0, -1, -1, -1, [], -1), (1, 0, 0.7, 4.0, -1, -1, -1, [], -1)],
        "tree int, id int, value double, cover double, left int, right int, feature int, split array<double>, categories int")
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.5, 1.0]), (3, [1.5, 0.0]), (4, [float("nan"), 1.0])], "id int, x array<double>")
    df = df.repartition(7).select("id", array_to_vector("x").alias("features"))     # some tasks are empty
    found = {r["id"]: r["s"] for r in df.select("id", forest.walked(nodes).alias("s")).collect()}
    assert found == {1: (0.1 + 0.7) / 2, 2: (0.3 + 0.7) / 2, 3: (0.4 + 0.7) / 2, 4: (0.3 + 0.7) / 2}
    assert df.limit(0).select(forest.walked(nodes).alias("s")).count() == 0
    assert forest.walked(nodes.withColumn("categories", F.lit(3))) is None


def test_ties_of_the_decision(spark):
    df = spark.createDataFrame([(0.5,), (0.6,)], "score double")
    assert rows(evaluation.predict_label(df), "predicted") == [(1,), (1,)]
    assert rows(evaluation.predict_label(df, ties=0), "predicted") == [(0,), (1,)]


def test_models_are_judged_from_one_scan(run):
    """Comparison, reports and curves of all models read the counts, not the scores."""
    for frame in (training.model_comparison(run), training.model_reports(run), training.pr_curves(run)):
        plan = frame._jdf.queryExecution().toString()
        assert models.FOREST + "#" not in plan
    for name in training.MODELS:
        alone = evaluation.binary_metrics(run.scores(name)).first()
        both = training.model_comparison(run).filter(F.col("model") == name).first()
        assert [alone[c] for c in ("precision", "recall", "f1", "tn", "fp", "fn", "tp")] == [
            both[c] for c in ("precision", "recall", "f1", "tn", "fp", "fn", "tp")]
        assert both["pr_auc"] == evaluation.average_precision(run.scores(name)).first()[0]
        assert training.pr_curves(run).filter(F.col("model") == name).count() == evaluation.pr_curve(run.scores(name)).count()


def test_unknown_category_has_no_slot(spark):
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a")], "n double, category string")
    inputs, names = models.fit_inputs(train, ["n"], "category")
    assert names == ["n", "category_a", "category_b"]
    new = spark.createDataFrame([(1.5, "b"), (1.5, "zzz")], "n double, category string")
    assert [list(r["features"].toArray()) for r in inputs.transform(new).collect()] == [[0, 0, 1], [0, 0, 0]]
    values = features.fit_categories(train, "category")
    assert rows(features.one_hot(new, "category", values), "category_a", "category_b") == [(0, 1), (0, 0)]


def test_too_many_categories_are_refused(spark):
    df = spark.range(30).selectExpr("cast(id as string) AS category")
    with pytest.raises(ValueError, match="more than 20"):
        features.fit_categories(df, "category", 20)


def test_null_inputs_are_named(txns, customers):
    known = customers.filter("customer_id > 20")
    with pytest.raises(Exception, match="null model input a"):
        training.train_cards(txns, known, trees=1)


def test_saved_model_scores_like_the_fitted_one(run, model_folder, spark, txns, customers):
    artifact = artifacts.load(spark, model_folder)
    assert artifact.train_rows == 7500 and artifact.features_num == FEATURES_NUM
    again = job.score(spark, txns, customers, model_folder)
    worst = again.join(run.scored, "transaction_id").agg(
        F.max(F.abs(F.col("fraud_score") - F.round(models.FOREST, 4)))).first()[0]
    assert worst < 1e-9
    assert rows(again.agg(F.min("fraud_score") >= 0, F.max("fraud_score") <= 1, F.sum("flagged") > 0),
                "*") == [(True, True, True)]


def test_missing_model(spark, txns, customers, tmp_path):
    with pytest.raises(artifacts.ModelNotFound, match="training job"):
        job.score(spark, txns, customers, str(tmp_path / "none"))


def test_scoring_a_csv_without_gaps_and_labels(spark, model_folder, txns, customers, tmp_path):
    source = str(tmp_path / "new_transactions")
    tables.write_csv(txns.drop("seconds_since_prev_txn", "is_fraud"), source)
    from_file = job.score(spark, source, customers, model_folder)
    from_frame = job.score(spark, txns, customers, model_folder)
    assert "is_fraud" not in from_file.columns
    same = from_file.select("transaction_id", "fraud_score").exceptAll(
        from_frame.select("transaction_id", "fraud_score"))
    assert same.count() == 0
    out = str(tmp_path / "flagged")
    job.write_flagged(from_file, out)
    written = spark.read.option("header", True).csv(out, inferSchema=True)
    assert written.columns == scoring.FLAGGED_COLUMNS
    scores = [r["fraud_score"] for r in written.collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) == from_file.filter("flagged = 1").count()


def test_wide_training(spark):
    run = training.train_wide(driver_views.wide(spark, SF), ["vec_id"], "class", "amount", trees=10)
    assert run.layout.numeric == [*driver_views.WIDE_FEATURES, "amount"]
    assert (run.rows, run.train_rows) == (500, 375)
    assert run.scored.agg(F.min("vec_id")).first()[0] == 375
    assert run.scored.agg(F.max("raw_amount")).first()[0] == 100.0
    document = json.loads(training.metrics_document(run).toJSON().first())
    assert document["fraud_rate"] == 0.1


def test_wide_split_is_exact_through_equal_times(spark):
    df = spark.range(200).select(
        (F.col("id") / 150).cast("bigint").alias("Time"), (F.col("id") % 17).cast("double").alias("V1"),
        F.col("id").cast("double").alias("Amount"), (F.col("id") % 4 == 0).cast("int").alias("Class"))
    run = training.train_wide(df, ["Time"], "Class", "Amount", trees=2)
    assert (run.train_rows, run.test.count(), run.layout.numeric) == (150, 50, ["V1", "Amount"])
    run = training.train_wide(df.withColumn("Time", F.lit(5)), ["Time"], "Class", "Amount", trees=2)
    assert (run.train_rows, run.test.count()) == (150, 50)


def test_rule_can_be_learned_from_rapid_bursts(spark):
    """A frame whose fraud is exactly the rapid repeats is separated by both models."""
    start = datetime(2025, 1, 1)
    data = [(2 * i + j, i % 50, "a", start + timedelta(seconds=400 * i + 30 * j), 20.0 + i % 7, 0.1, j if i % 5 == 0 else 0)
            for i in range(600) for j in range(2 if i % 5 == 0 else 1)]
    df = spark.createDataFrame(data, "transaction_id bigint, customer_id bigint, category string, "
                                     "timestamp timestamp_ntz, amount double, merchant_risk_score double, is_fraud int")
    spend = spark.range(50).select(F.col("id").alias("customer_id"), F.lit(900.0).alias("avg_monthly_spend"))
    run = training.train_cards(df, spend, trees=5)
    for name in training.MODELS:
        assert evaluation.average_precision(run.scores(name)).first()[0] > 0.99


def test_forest_does_not_depend_on_files_or_cores(spark, txns, customers):
    """The files a table lies in and the read splits, which follow the cores, change; the model does not."""
    found = []
    for files, split in ((2, "128m"), (9, "4k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            run = training.train_cards(txns.repartition(files, "amount"), customers, trees=5)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        found.append((run.forest.totalNumNodes, [round(x, 9) for x in run.forest.featureImportances.toArray()]))
        assert training.model_reports(run).count() == 10
    assert found[0] == found[1]
