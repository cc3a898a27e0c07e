import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from chargelens.operators import explain, models
from chargelens.plans import explaining, training
from chargelens.sources import artifacts, driver_views

from .frames import rows

SF = "/root/testdata/sf0.001"


def brute_force(tree, x):
    """Shapley values by the definition: every coalition, features outside it follow both branches."""
    def expected(known, number=0):
        node = tree[number]
        if node.left < 0:
            return node.value
        if node.categories == 2:
            goes_left = x[node.feature] in list(node.split)
        else:
            goes_left = x[node.feature] <= node.split[0]
        if node.feature in known:
            return expected(known, node.left if goes_left else node.right)
        a, b = tree[node.left], tree[node.right]
        return (a.cover * expected(known, node.left) + b.cover * expected(known, node.right)) / node.cover

    n = len(x)
    phi = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for coalition in itertools.combinations(others, size):
                phi[i] += weight * (expected({*coalition, i}) - expected(set(coalition)))
    return phi, expected(set())


@pytest.fixture(scope="module")
def small(spark):
    """Two numerics and one category with two values; the label needs all of them."""
    df = spark.range(400).select(
        F.col("id").alias("transaction_id"), (F.col("id") * 37 % 101).cast("double").alias("a"),
        (F.col("id") * 53 % 89).cast("double").alias("b"),
        F.when(F.col("id") * 7 % 11 < 5, "u").otherwise("v").alias("category"), F.lit(1.0).alias("weight"))
    df = df.withColumn("label", ((F.col("a") > 50) & (F.col("b") > 30) | (F.col("category") == "u")
                                 & (F.col("a") < 20)).cast("double"))
    inputs, names = models.fit_inputs(df, ["a", "b"], "category")
    ready = inputs.transform(df).cache()
    forest = models.fit_forest(ready, "label", trees=5, depth=3, min_leaf=2)
    return ready, names, forest


def test_contributions_equal_brute_force(spark, small):
    ready, names, forest = small
    nodes = explain.forest_nodes(forest, spark)
    assert nodes.filter("categories = 2").count() > 0      # a split on the 0/1 slot is covered
    sample = ready.filter("transaction_id % 13 = 0")
    got = explain.tree_contributions(sample, explain.leaf_paths(nodes), names).toPandas()
    trees = [{n.id: n for n in group.itertuples(index=False)} for _, group in nodes.toPandas().groupby("tree")]
    for r in sample.select("transaction_id", vector_to_array("features").alias("x")).collect():
        results = [brute_force(tree, r["x"]) for tree in trees]
        expected = np.mean([phi for phi, _ in results], axis=0)
        mine = got[got["transaction_id"] == r["transaction_id"]].set_index("feature")
        assert np.abs(mine.loc[names, "contribution"].to_numpy() - expected).max() < 1e-12
        assert abs(mine["base_value"].iloc[0] - np.mean([base for _, base in results])) < 1e-12


def test_base_and_contributions_add_up_to_the_score(spark, small):
    ready, names, forest = small
    leaves = explain.leaf_paths(explain.forest_nodes(forest, spark))
    total = (explain.tree_contributions(ready, leaves, names).groupBy("transaction_id")
             .agg((F.first("base_value") + F.sum("contribution")).alias("total")))
    scored = forest.transform(ready)
    assert total.join(scored, "transaction_id").agg(
        F.max(F.abs(F.col("total") - F.col("_forest_score")))).first()[0] < 1e-12


def test_a_forest_of_bare_roots(spark):
    df = spark.createDataFrame([(i, 1.0, 1.0, 1.0) for i in range(20)],
                               "transaction_id bigint, a double, label double, weight double")
    inputs, names = models.fit_inputs(df, ["a"])
    ready = inputs.transform(df)
    forest = models.fit_forest(ready, "label", trees=2)
    out = explain.tree_contributions(ready, explain.leaf_paths(explain.forest_nodes(forest, spark)), names)
    assert {(r["contribution"], r["base_value"]) for r in out.collect()} == {(0.0, 1.0)}


def test_sample_keeps_every_positive(spark):
    df = spark.range(1000).select(F.col("id").alias("transaction_id"), (F.col("id") % 20 == 0).cast("int").alias("is_fraud"))
    for size, expected in ((200, 200), (50, 50), (10, 50), (5000, 1000)):
        sample = explain.keep_all_positive(df, size)
        assert sample.count() == expected and sample.filter("is_fraud = 1").count() == 50
    again = explain.keep_all_positive(df.repartition(7), 200)
    assert explain.keep_all_positive(df, 200).exceptAll(again).count() == 0


@pytest.fixture(scope="module")
def run(spark):
    return training.train_cards(driver_views.transactions(spark, SF, gaps=True),
                                driver_views.customer_spend(spark, SF), trees=5)


@pytest.fixture(scope="module")
def explanation(run):
    return explaining.explain_run(run, size=100)


def test_explanation_of_the_test_rows(run, explanation):
    frauds = run.test.filter("is_fraud = 1").count()
    assert explanation.sample.count() == max(100, frauds)
    assert explanation.ranking.count() == len(run.feature_names)
    assert not explanation.ranking.first()["feature"].startswith("category_")


def test_points_show_raw_values(run, explanation):
    points = explanation.points(3)
    assert points.count() == 3 * explanation.sample.count()
    hours = points.filter("feature = 'hour_of_day'").join(explanation.sample.select("transaction_id", "hour_of_day"),
                                                          "transaction_id")
    assert hours.filter("value != hour_of_day").count() == 0


def test_all_test_rows_can_be_explained(run):
    everything = explaining.explain_run(run, size=None)
    total = everything.contributions.groupBy("transaction_id").agg(
        (F.first("base_value") + F.sum("contribution")).alias("total"))
    assert total.count() == run.test.count()
    assert total.join(run.scored, "transaction_id").agg(
        F.max(F.abs(F.col("total") - F.col(models.FOREST)))).first()[0] < 1e-9


def test_rows_are_spread_by_their_number(spark, small, monkeypatch):
    ready, names, forest = small
    monkeypatch.setattr(explain, "ROWS_PER_TASK", 10)
    leaves = explain.leaf_paths(explain.forest_nodes(forest, spark))
    plan = explain.tree_contributions(ready, leaves, names)._jdf.queryExecution().toString()
    assert "hashpartitioning(transaction_id" in plan and ", 40)" in plan
    assert rows(explain.tree_contributions(ready.limit(0), leaves, names), "transaction_id") == []


def test_blocks_of_leaves_add_up_to_the_same(spark, small, monkeypatch):
    """One block of all leaves and one a tree; the driver sees a block at a time."""
    ready, names, forest = small
    leaves = explain.leaf_paths(explain.forest_nodes(forest, spark))
    sizes, original = [], explain._pack
    monkeypatch.setattr(explain, "_pack", lambda part: sizes.append(len(part)) or original(part))
    whole = rows(explain.contribution_vectors(ready, leaves, names), "transaction_id", "contributions", "base_value")
    assert sizes == [leaves.count()]
    parts = dict((r[0], r[1:]) for r in rows(explain.contribution_vectors(ready, leaves, names, block_bytes=1),
                                             "transaction_id", "contributions", "base_value"))
    assert len(sizes) == 1 + 5 and sum(sizes[1:]) == sizes[0] and len(parts) == len(whole)
    for number, contributions, base in whole:
        assert np.abs(np.array(parts[number][0]) - contributions).max() < 1e-12 and abs(parts[number][1] - base) < 1e-12


def test_patterns_and_rows_give_the_same(monkeypatch):
    """Leaves worked out per way to take a path equal those worked out per row."""
    draw = np.random.default_rng(3)
    for depth in (1, 3, 6):
        feature = np.array([draw.choice(7, depth, replace=False) for _ in range(40)])
        low = draw.normal(size=(40, depth)) - 1
        leaves = (draw.normal(size=40), feature, low, low + draw.exponential(size=(40, depth)), draw.uniform(0.1, 0.9, (40, depth)))
        x = draw.normal(size=(200, 7))
        whole, apart = np.zeros((200, 7)), np.zeros((200, 7))
        explain._add_leaves(whole, x, *leaves)
        monkeypatch.setattr(explain, "CELLS", 50)
        for i in range(200):
            explain._add_leaves(apart[i:i + 1], x[i:i + 1], *leaves)
        monkeypatch.undo()
        assert np.abs(whole - apart).max() < 1e-12


def drawn_leaves(draw, cuts, depth, features=6):
    """The leaves of a tree of random splits, neighbours side by side."""
    import pandas as pd
    out, todo = [], [({}, 0)]
    while todo:
        path, level = todo.pop()
        f = int(draw.integers(features))
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        inside = [c for c in cuts if low < c < high]
        if level == depth or not inside:
            out.append((0, float(draw.normal()), list(path), *[[p[i] for p in path.values()] for i in range(3)]))
            continue
        cut, part = float(draw.choice(inside)), float(draw.uniform(0.1, 0.9))
        todo += [({**path, f: (cut, high, share * (1 - part))}, level + 1), ({**path, f: (low, cut, share * part)}, level + 1)]
    return pd.DataFrame(out, columns=["tree", "value", "features", "low", "high", "share"]).assign(block=0)


@pytest.mark.parametrize("table", [4_096, 16, 1])
def test_tables_of_leaves_give_the_same(spark, monkeypatch, table):
    """Rows looked up in tables equal rows worked out leaf by leaf: on cuts, beyond all of them, without a number."""
    draw = np.random.default_rng(7)
    leaves = drawn_leaves(draw, [-1.0, -0.5, 0.0, 0.25, 0.5, 1.0], 7)
    monkeypatch.setattr(explain, "TABLE", table)
    schema = f"{explain.LEAF_SCHEMA}, block bigint"
    found = explain.bunched(spark.createDataFrame(leaves, schema).coalesce(1)).toPandas()
    assert len(found) == len(leaves)
    if table == 4_096:      # many leaves a table, that is the saving
        assert found["bunch"].min() == 0 and found["bunch"].nunique() < len(leaves) / 5
    if table == 1:          # each path is too long
        assert set(found["bunch"]) == {-1}
    x = draw.choice([-9.0, -1.0, -0.7, -0.5, 0.0, 0.1, 0.25, 0.3, 0.5, 1.0, 1.1, np.nan], size=(3_000, 6))
    plain = np.zeros(x.shape)
    for group in explain._pack(leaves.assign(bunch=-1)):
        explain._add_leaves(plain, x, *group[1:])
    packed, mixed = explain._pack(found), np.zeros(x.shape)
    for bunch, *columns in packed:
        explain._add_leaves(mixed, x, *[c[:np.searchsorted(bunch, 0)] for c in columns])
    mixed += explain._tabled(x, packed, 6).T
    assert np.abs(plain).max() > 0.1 and np.abs(mixed - plain).max() < 1e-12


def test_tables_and_single_leaves_agree_in_a_job(spark, small, monkeypatch):
    """Many rows a task take the tables, few do not."""
    ready, names, forest = small
    leaves = explain.leaf_paths(explain.forest_nodes(forest, spark))
    plain = dict(rows(explain.contribution_vectors(ready, leaves, names), "transaction_id", "contributions"))
    monkeypatch.setattr(explain, "TABLED_ROWS", 1)
    for block_bytes in (None, 1):
        tabled = rows(explain.contribution_vectors(ready, leaves, names, block_bytes=block_bytes), "transaction_id", "contributions")
        assert len(tabled) == len(plain)
        assert all(np.abs(np.array(c) - plain[i]).max() < 1e-12 for i, c in tabled)


def test_means_are_taken_of_the_vectors(spark, explanation):
    """No row per feature is made on the way to the mean."""
    means = explain.mean_abs_contribution(explanation.vectors, explanation.names)
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") > plan.index("Generate") and plan.count("Aggregate") == 1
    slow = explanation.contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("m"))
    assert means.join(slow, "feature").agg(F.max(F.abs(F.col("m") - F.col("mean_abs_contribution")))).first()[0] < 1e-12


def test_breakdown_adds_up(spark, run, explanation):
    one = explaining.explain_top_fraud(run, explanation.leaves)
    lines = explain.decision_breakdown(one, 5).collect()
    assert [r["position"] for r in lines] == [1, 2, 3, 4, 5] and lines[-1]["feature"] == "other"
    assert lines[-1]["value"] is None and all(r["value"] is not None for r in lines[:-1])
    best = run.scored.filter("is_fraud = 1").agg(F.max(models.FOREST)).first()[0]
    assert lines[0]["base_value"] + sum(r["contribution"] for r in lines) == pytest.approx(best)
    everything = explain.decision_breakdown(one, 40)
    assert everything.count() == len(run.feature_names) and everything.filter("feature = 'other'").count() == 0
    top = [r["contribution"] for r in explain.top_drivers(one).collect()]
    assert len(top) == 3 and top == sorted(top, reverse=True)


def test_a_saved_model_is_explained_the_same(spark, run, explanation, tmp_path):
    folder = str(tmp_path / "model")
    artifacts.save(training.to_artifact(run), folder, spark)
    subject = explaining.reopen(spark, folder, driver_views.transactions(spark, SF, gaps=True),
                                driver_views.customer_spend(spark, SF))
    again = {r[0]: r[1] for r in explaining.explain_run(subject, size=100).ranking.collect()}
    for feature, effect in rows(explanation.ranking, "feature", "mean_abs_contribution"):
        assert again[feature] == pytest.approx(effect, abs=1e-12)


def test_overlap(spark):
    first = spark.createDataFrame([(f,) for f in "abcdef"], "feature string")
    second = spark.createDataFrame([(f,) for f in "xbaefc"], "feature string")
    assert rows(explain.importance_overlap(first, second), "shared", "of") == [(3, 5)]


def test_importances_file(spark, explanation, tmp_path):
    path = str(tmp_path / "importances")
    explaining.write_importances(explanation.ranking, path)
    written = spark.read.json(path).first()["importances"].asDict()
    assert set(written) == {r["feature"] for r in explanation.ranking.collect()}
