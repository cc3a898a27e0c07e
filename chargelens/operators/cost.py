"""Decision thresholds in dollars: a review fee per false alarm, the amount per missed fraud."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expressions import grid_points_reached, money, money_units, present, ratio_or_zero
from ..schemas import DEFAULT_THRESHOLD, REVIEW_COST, THRESHOLD_GRID


def _report(frame, review_cost):
    """From threshold, tp, fp, fn and dollars in money units to the published columns."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    dollars = money(F.coalesce(F.col("dollars"), F.lit(0)))
    return frame.select(
        F.round("threshold", 3).alias("threshold"),
        F.round(ratio_or_zero(tp, tp + fp), 4).alias("precision"),
        F.round(ratio_or_zero(tp, tp + fn), 4).alias("recall"),
        fp.alias("false_positives"), fn.alias("missed_frauds"),
        dollars.alias("dollars_lost_to_missed_fraud"),
        F.round(F.lit(float(review_cost)) * fp + dollars, 2).alias("expected_cost"))


def cost_at(scored, threshold=DEFAULT_THRESHOLD, review_cost=REVIEW_COST, label="is_fraud",
            score="score", amount="amount"):
    """Counts and cost of flagging every row with score >= threshold."""
    flagged, fraud = present(score) >= F.lit(float(threshold)), F.col(label) == 1
    return _report(scored.agg(
        F.lit(float(threshold)).alias("threshold"),
        F.count_if(flagged & fraud).alias("tp"), F.count_if(flagged & ~fraud).alias("fp"),
        F.count_if(~flagged & fraud).alias("fn"),
        F.sum(F.when(~flagged & fraud, money_units(F.col(amount)))).alias("dollars")), review_cost)


def threshold_sweep(scored, grid=THRESHOLD_GRID, review_cost=REVIEW_COST, label="is_fraud",
                    score="score", amount="amount"):
    """`cost_at` for every grid point from one pass over the rows.

    A row counts towards the number of grid points its score reaches; those len(grid) + 1 groups
    are then accumulated.
    """
    grid = sorted(grid)
    fraud = F.col(label) == 1
    scored = scored.withColumn(score, present(score))
    groups = scored.groupBy(grid_points_reached(score, grid).alias("reached")).agg(
        F.count_if(fraud).alias("pos"), F.count_if(~fraud).alias("neg"),
        F.sum(F.when(fraud, money_units(F.col(amount))).otherwise(0)).alias("dollars"))
    points = scored.sparkSession.range(1, len(grid) + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("reached"),
        F.expr(f"element_at(array({', '.join(f'{float(t)!r}D' for t in grid)}), int(id))").alias("threshold"))
    # a row for every grid point, also where no score ends; group 0 is below the first point
    every = (groups.withColumn("threshold", F.lit(None).cast("double"))
             .unionByName(points.select("reached", "threshold", F.lit(0).alias("pos"),
                                        F.lit(0).alias("neg"), F.lit(0).alias("dollars")))
             .groupBy("reached").agg(F.max("threshold").alias("threshold"), *[
                 F.sum(c).alias(c) for c in ("pos", "neg", "dollars")]))
    below = Window.orderBy("reached").rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.orderBy("reached").rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def total(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    return _report(
        every.select("threshold", total("pos", from_here).alias("tp"), total("neg", from_here).alias("fp"),
                     total("pos", below).alias("fn"), total("dollars", below).alias("dollars"))
        .filter(F.col("threshold").isNotNull()), review_cost).orderBy("threshold")


def cost_optimal(sweep):
    """The cheapest threshold, the lowest on ties."""
    return sweep.orderBy("expected_cost", "threshold").limit(1)


def cost_reduction(sweep, default=DEFAULT_THRESHOLD):
    """Percent saved by the cheapest grid point against the default one, 0 when that costs nothing."""
    costs = sweep.agg(
        F.max(F.when(F.col("threshold") == default, F.col("expected_cost"))).alias("default_cost"),
        F.min("expected_cost").alias("optimal_cost"))
    saved = F.lit(100.0) * (F.col("default_cost") - F.col("optimal_cost"))
    return costs.select("default_cost", "optimal_cost", F.round(
        ratio_or_zero(saved, F.col("default_cost")), 1).alias("cost_reduction_pct"))
