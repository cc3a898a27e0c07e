"""The forest grown from counts against the solver's and by definition."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from chargelens.operators import explain, growing, models
from chargelens.plans import training
from chargelens.sources import driver_views
from chargelens.storage import new_path

SF = "/root/testdata/sf0.01"


@pytest.fixture
def grown(monkeypatch):
    """Forests are grown from counts, whatever the number of rows."""
    monkeypatch.setattr(models, "SOLVER_ROWS", 0)


@pytest.fixture(scope="module")
def ready(spark):
    """One numeric of many values and one 0/1 slot, two classes of different weight."""
    df = spark.range(3_000).select(
        (F.col("id") * 37 % 1009).cast("double").alias("a"), F.when(F.col("id") * 7 % 11 < 5, "u").alias("category"),
        (F.col("id") * 37 % 1009 > F.col("id") % 7 * 130).cast("double").alias("label"))
    df = df.withColumn("weight", F.when(F.col("label") == 1, 0.75).otherwise(1.5)).fillna("v", ["category"])
    inputs, _ = models.fit_inputs(df.withColumnRenamed("category", "c"), ["a"], "c")
    two = inputs.transform(df.withColumnRenamed("category", "c"))
    sliced = VectorSlicer(inputCol="features", outputCol="two", indices=[0, 1]).transform(two).drop("features")     # one of the two slots
    out = sliced.withColumnRenamed("two", "features").select("a", "features", "label", "weight").repartition(3, "a").persist()
    out.count()
    yield out
    out.unpersist()


def shape(forest, spark, nodes=None):
    """Nodes of a forest by tree and way to them, the sides of a split by value."""
    out = []
    for t, tree in (explain.forest_nodes(forest, spark) if nodes is None else nodes).toPandas().groupby("tree"):
        node, todo = {n.id: n for n in tree.itertuples(index=False)}, [(0, "")]
        while todo:
            number, way = todo.pop()
            n = node[number]
            cut = None if n.left < 0 else 0.5 if n.categories == 2 else n.split[0]
            out.append((t, way, round(n.value, 9), round(n.cover, 6), n.feature, cut))
            if n.left >= 0:
                low = n.categories != 2 or 0.0 in list(n.split)
                todo += [(n.left, way + ("l" if low else "h")), (n.right, way + ("h" if low else "l"))]
    return sorted(out, key=lambda n: n[:2])


def test_a_tree_without_draws_is_that_of_the_solver(spark, ready):
    """All rows count once and a node looks at both features, so nothing is left to chance."""
    kinds = growing.kinds_of(ready, "label", "weight")
    assert [k[:2] for k in kinds] == [(0.0, 1.5), (1.0, 0.75)] and growing.slots_of(ready) == {1: 2}
    nodes = growing.grow(ready, "label", "weight", kinds, 2, {1: 2}, 1, 6, 5, 128, 42, bagged=False)
    path = new_path(spark)
    spark.createDataFrame(nodes, growing.NODE_SCHEMA).write.parquet(f"{path}/data")
    solver = RandomForestRegressor(featuresCol="features", labelCol="label", weightCol="weight", numTrees=1, maxDepth=6, bootstrap=False,
                                   minInstancesPerNode=5, featureSubsetStrategy="sqrt", maxBins=128, seed=42).fit(ready)
    ours, theirs = shape(None, spark, explain.node_table(spark, path)), shape(solver, spark)
    assert len(ours) > 20 and any(n[4] == 1 for n in ours)
    assert [n[:4] for n in ours] == [n[:4] for n in theirs] and [n[4] for n in ours] == [n[4] for n in theirs]
    assert [n[5] for n in ours] == pytest.approx([n[5] for n in theirs])


def test_a_grown_forest_is_a_model_like_others(spark, ready, grown):
    """It scores, weighs its features and is walked as one of the solver; a node holds what its rows say."""
    forest = models.fit_forest(ready, "label", trees=4, depth=5)
    nodes = explain.forest_nodes(forest, spark).toPandas()
    assert forest.getNumTrees == 4 and nodes["tree"].nunique() == 4 and forest.getMaxDepth() == 5
    scored = models.with_forest_score(ready, forest).withColumnRenamed("_forest_score", "walked")
    assert forest.transform(scored).filter("walked = _forest_score").count() == 3_000
    ours = models.gini_importance(explain.forest_nodes(forest, spark), ["a", "c"]).collect()
    for r in ours:
        assert r["importance"] == pytest.approx(forest.featureImportances[["a", "c"].index(r["feature"])], abs=1e-9)
    # each row counts once in expectation, and no two trees draw alike
    roots = nodes[nodes["id"] == 0]["cover"].to_numpy()
    whole = ready.agg(F.sum("weight")).first()[0]
    assert len(set(roots)) == 4 and np.abs(roots / whole - 1).max() < 0.1


def test_a_grown_forest_does_not_depend_on_tasks(spark, ready, grown, monkeypatch):
    found = []
    for task_bytes, shuffled in ((32 << 20, "4"), (1, "1")):
        monkeypatch.setattr(growing, "TASK_BYTES", task_bytes)
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        try:
            found.append(shape(models.fit_forest(ready, "label", trees=3, depth=4), spark))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] and len(found[0]) > 30


def test_cuts_come_from_all_rows(spark, grown):
    """One row in 40,000 tells; a sample of 16,384 rows would mostly miss its value."""
    df = spark.range(40_000).select(F.when(F.col("id") < 10, 5.0).otherwise(F.col("id") % 2).alias("a"), (F.col("id") < 10).cast("double").alias("label"),
                                    F.lit(1.0).alias("weight"))
    inputs, _ = models.fit_inputs(df, ["a"])
    forest = models.fit_forest(inputs.transform(df).repartition(5, "a"), "label", trees=1, depth=3)
    assert forest.totalNumNodes == 3


def test_many_rows_are_grown_and_few_are_not(spark, monkeypatch):
    """Beyond 16,384 rows the solver would sample; up to them it is asked."""
    asked = []
    grow = growing.grow
    monkeypatch.setattr(growing, "grow", lambda *a, **k: asked.append(1) or grow(*a, **k))
    df = spark.range(models.SOLVER_ROWS + 1).select((F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 5 == 1).cast("double").alias("label"),
                                                    F.lit(1.0).alias("weight"))
    inputs, _ = models.fit_inputs(df, ["a"])
    models.fit_forest(inputs.transform(df.limit(models.SOLVER_ROWS)), "label", trees=1, depth=2)
    assert not asked
    models.fit_forest(inputs.transform(df), "label", trees=1, depth=2)
    assert asked


def test_blocks_are_filled_whatever_the_batches():
    """A block has as many rows as it may, so that its draws do not depend on how rows arrive."""
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([[float(i), 0.0] for i in rows]), pa.array([i % 2 for i in rows], pa.int32())], names=["x", "kind"])

    found = [[growing._batches(iter(parts), width)] for parts, width in (
        ([batch(range(0, 7)), batch([]), batch(range(7, 70_000))], 2), ([batch(range(0, 66_000)), batch(range(66_000, 70_000))], 2))]
    sizes = [[(len(x), x[0, 0], kind.sum()) for x, kind in blocks] for (blocks,) in found]
    assert sizes[0] == sizes[1] == [(65_536, 0.0, 32_768), (4_464, 65_536.0, 2_232)]


def test_null_labels_are_left_to_the_solver(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0)], "label double, weight double")
    assert growing.kinds_of(df, "label", "weight") is None
    many = spark.range(20).select(F.col("id").cast("double").alias("weight"), F.lit(1.0).alias("label"))
    assert growing.kinds_of(many, "label", "weight") is None


def test_between():
    assert growing.between(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 9]), 3).tolist() == [1.5, 3.0]
    assert growing.between(np.array([3.0]), np.array([5]), 3).tolist() == []
    even = growing.between(np.arange(100.0), np.ones(100, dtype=int), 4)
    assert even.tolist() == [24.5, 49.5, 74.5]
    # a value of many rows takes one bin, the others share what is left
    assert len(growing.between(np.arange(100.0), np.array([1_000, *[1] * 99]), 4)) == 3


def test_best_split_by_definition():
    """Every split of every feature, the weighted variance worked out row by row."""
    rng = np.random.default_rng(7)
    sizes, kinds = np.array([6, 4, 2]), [(0.0, 1.5), (1.0, 0.25)]
    x, y = np.stack([rng.integers(0, s, 300) for s in sizes]), rng.integers(0, 2, 300)
    plan = growing._Plan(growing._Tree(2), sizes, 2, np.dtype(np.uint8), 3, (1, 2, 0))
    found = [np.zeros(n) for n in plan.cells]
    often = rng.integers(0, 3, 300)
    growing._count(found, plan, (x * 2 + y).astype(np.uint8).ravel(), 300, often, 0)
    best = growing.best_splits(0, plan, np.concatenate(found).astype(np.int64), sizes, kinds, 5).iloc[0]

    def variance(rows):
        w = often[rows] * np.where(y[rows] == 1, 0.25, 1.5)
        return w.sum() * np.average((y[rows] - np.average(y[rows], weights=w)) ** 2, weights=w)

    gains = {}
    for f, s in enumerate(sizes):
        for cut in range(s - 1):
            low, high = np.flatnonzero(x[f] <= cut), np.flatnonzero(x[f] > cut)
            if min(often[low].sum(), often[high].sum()) >= 5:
                gains[f, cut] = variance(np.arange(300)) - variance(low) - variance(high)
    total = (often * np.where(y == 1, 0.25, 1.5)).sum()
    assert (best["feature"], best["cut"]) == max(gains, key=gains.get)
    assert best["gain"] == pytest.approx(max(gains.values()) / total)
    assert best["whole"].tolist() == [often[y == 0].sum(), often[y == 1].sum()]


def test_poisson_draws():
    often = growing._drawn(42, 3, (7 << 32) + 1, 65_536)
    assert abs(often.mean() - 1) < 0.02 and abs(often.var() - 1) < 0.03 and abs((often == 0).mean() - np.exp(-1)) < 0.01
    assert (often == growing._drawn(42, 3, (7 << 32) + 1, 65_536)).all()
    assert (often != growing._drawn(42, 4, (7 << 32) + 1, 65_536)).any() and (often != growing._drawn(42, 3, 7 << 32, 65_536)).any()


def test_a_grown_forest_learns_as_well(spark, grown):
    run = training.train_cards(driver_views.transactions(spark, SF, gaps=True), driver_views.customer_spend(spark, SF), trees=20)
    best = {r["model"]: r for r in training.model_comparison(run).collect()}[models.FOREST]
    assert best["recall"] > 0.85 and best["pr_auc"] > 0.85
    wide = training.train_wide(driver_views.wide(spark, SF), ["vec_id"], "class", "amount", trees=3)
    assert wide.forest.getNumTrees == 3 and wide.forest.numFeatures == 65
    assert wide.scored.filter(F.col(models.FOREST).between(0, 1)).count() == 125
