import random

import numpy as np
import pytest

from chargelens.operators import cost, evaluation, scoring

from .frames import rows, scored


def brute_ap(data):
    total = sum(y for y, _, _ in data)
    area = before = 0.0
    for s in sorted({p for _, _, p in data}, reverse=True):
        flagged = [y for y, _, p in data if p >= s]
        recall = sum(flagged) / total
        area += (recall - before) * sum(flagged) / len(flagged)
        before = recall
    return round(area, 4)


CASES = {
    "mixed": [(int(random.Random(i).random() < .2), 1 + i, round(random.Random(-i).random(), 2)) for i in range(300)],
    "tied": [(1, 5, .5), (0, 5, .5), (1, 7, .5), (0, 9, .2)],
    "four": [(0, 1, .1), (0, 1, .4), (1, 1, .35), (1, 1, .8)],
    "all fraud": [(1, 10, .3), (1, 20, .9)],
    "on grid points": [(1, 3, i / 100) for i in range(0, 101)] + [(0, 4, i / 100) for i in range(0, 101, 7)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("places", [None, 4])
def test_average_precision_is_the_step_sum(spark, name, places):
    df = scored(spark, CASES[name])
    assert rows(evaluation.average_precision(df, places=places), "pr_auc") == [(brute_ap(CASES[name]),)]


def test_step_sum_is_not_the_trapezoid(spark):
    assert brute_ap(CASES["four"]) == 0.8333


def test_no_fraud_gives_zeros(spark):
    df = scored(spark, [(0, 1, .2), (0, 1, .7)])
    assert rows(evaluation.average_precision(df), "pr_auc") == [(0.0,)]
    assert rows(evaluation.binary_metrics(df), "precision", "recall", "f1", "tn", "fp") == [(0.0, 0.0, 0.0, 1, 1)]
    assert rows(cost.cost_at(df), "recall", "dollars_lost_to_missed_fraud", "expected_cost") == [(0.0, 0.0, 8.0)]


def test_curve_ends_at_recall_zero(spark):
    points = rows(evaluation.pr_curve(scored(spark, CASES["tied"])), "threshold", "precision", "recall")
    assert sorted(points, key=str) == sorted([(.5, 2 / 3, 1.0), (.2, .5, 1.0), (None, 1.0, 0.0)], key=str)


def test_a_score_on_the_threshold_is_flagged(spark):
    df = scored(spark, [(1, 5, .5), (0, 5, .4999)])
    assert rows(evaluation.predict_label(df), "predicted") == [(1,), (0,)]
    assert rows(evaluation.confusion_matrix(df), "tn", "fp", "fn", "tp") == [(1, 0, 0, 1)]


def test_report(spark):
    df = scored(spark, [(1, 1, .9), (1, 1, .1), (0, 1, .6), (0, 1, .2), (0, 1, .3)])
    got = {r["class"]: tuple(r)[1:] for r in evaluation.classification_report(df).collect()}
    assert got["fraud"] == (0.5, 0.5, 0.5, 2)
    assert got["legit"] == (0.6667, 0.6667, 0.6667, 3)
    assert got["accuracy"] == (None, None, 0.6, 5)
    assert got["macro avg"] == (0.5833, 0.5833, 0.5833, 5)
    assert got["weighted avg"] == (0.6, 0.6, 0.6, 5)


def brute_cost(data, t):
    y, a, p = (np.array(c, dtype=float) for c in zip(*data))
    flagged = p >= t
    fp, missed = int((flagged & (y == 0)).sum()), ~flagged & (y == 1)
    tp, fn = int((flagged & (y == 1)).sum()), int(missed.sum())
    lost = round(float(a[missed].sum()), 2)
    return (t, round(tp / (tp + fp), 4) if tp + fp else 0.0, round(tp / (tp + fn), 4) if tp + fn else 0.0,
            fp, fn, lost, round(8 * fp + lost, 2))


@pytest.mark.parametrize("name", CASES)
def test_sweep_equals_costing_each_threshold(spark, name):
    df = scored(spark, CASES[name])
    grid = [i / 100 for i in range(5, 96)]
    assert [tuple(r) for r in cost.threshold_sweep(df).collect()] == [brute_cost(CASES[name], t) for t in grid]
    assert tuple(cost.cost_at(df, 0.43).first()) == brute_cost(CASES[name], 0.43)


def test_any_grid(spark):
    df = scored(spark, CASES["mixed"])
    for grid in ([0.5], [0.9, 0.1], [0.0, 0.25, 1.0]):
        assert [tuple(r) for r in cost.threshold_sweep(df, grid).collect()] == [
            brute_cost(CASES["mixed"], t) for t in sorted(grid)]


def test_lowest_threshold_wins_a_tie(spark):
    sweep = cost.threshold_sweep(scored(spark, [(1, 50, .9), (0, 1, .02)]))
    assert cost.cost_optimal(sweep).first()["threshold"] == 0.05
    assert rows(cost.cost_reduction(sweep), "cost_reduction_pct") == [(0.0,)]       # the default costs nothing


def test_optimum_is_no_worse_than_the_default(spark):
    row = cost.cost_reduction(cost.threshold_sweep(scored(spark, CASES["mixed"]))).first()
    assert row["optimal_cost"] <= row["default_cost"] and row["cost_reduction_pct"] >= 0


def test_flagging(spark):
    df = scored(spark, [(1, 5, .3), (0, 6, .9), (1, 7, .9), (1, 8, .1)]).withColumnRenamed("score", "fraud_score")
    flagged = scoring.flag(df, 0.3)
    assert rows(scoring.flag_ranking(flagged), "transaction_id", "fraud_score") == [(1, .9), (2, .9), (0, .3)]
    assert scoring.flag_summary(flagged).first().asDict() == {
        "scored": 4, "flagged": 3, "tp": 2, "fp": 1, "fn": 1, "flagged_share": .75, "recall": .667, "precision": .667}
    assert scoring.flag_summary(flagged.drop("is_fraud")).columns == ["scored", "flagged", "flagged_share"]
    assert scoring.flag_summary(flagged.limit(0)).first()["flagged_share"] == 0.0
    assert scoring.top_scored_fraud(df, "fraud_score").first()["transaction_id"] == 2


def test_null_scores_and_scores_out_of_range_fail_by_name(spark):
    df = spark.createDataFrame([(1, 0.9, 5.0), (1, None, 7.0)], "is_fraud int, score double, amount double")
    for report in (cost.cost_at, cost.threshold_sweep, evaluation.confusion_matrix, evaluation.pr_curve):
        with pytest.raises(Exception, match="null score in score"):
            report(df).collect()
    far = spark.createDataFrame([(1, 7.5)], "is_fraud int, score double")
    with pytest.raises(Exception, match="not between 0 and 1"):
        evaluation.pr_curve(far, places=4).collect()
