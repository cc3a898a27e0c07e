"""Column expressions with the numeric rules the queries rely on."""

from pyspark.sql import functions as F

from ..schemas import DAYS_PER_MONTH, RISK_EDGES, RISK_LABELS


def gap_seconds(later, earlier):
    """Whole seconds between two timestamps, truncated; no time zone is involved."""
    return (F.col(later) - F.col(earlier)).cast("interval second").cast("bigint")


def gap_seconds_exact(later, earlier):
    """Seconds with microseconds as a double."""
    between = (F.col(later) - F.col(earlier)).cast("interval second")
    return between.cast("decimal(18,6)").cast("double")


def week_number(ts):
    """Monday-based week of the year, 0 for the days before the first Monday (not ISO)."""
    ts = F.col(ts)
    return ((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7).cast("int")


def week_label(year, week):
    return F.format_string("%d-%02d", F.col(year), F.col(week))


def percent(part, whole):
    """100 * part / whole in double arithmetic; null when the whole is 0."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))


def ratio_or_zero(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


MONEY_UNITS = 10_000.0       # of a dollar


def money_units(amount):
    """An amount in whole hundredths of a cent, whose sums are the same in any order of addition."""
    return F.floor(amount * F.lit(MONEY_UNITS) + F.lit(0.5))


def money(units):
    """A sum of `money_units` in dollars to 2 places."""
    return F.round(units / F.lit(MONEY_UNITS), 2)


def mean_money(amount):
    """Average of money to 2 places, half up, on whole cents and in whole numbers.

    The mean of two amounts is often an exact half cent, which binary rounding gets wrong either way.
    """
    cents = F.sum(F.round(F.col(amount) * 100.0).cast("bigint"))
    n = F.count(F.lit(1))
    twice, whole = 2 * cents + n, F.nullif(2 * n, F.lit(0))
    return F.call_function("div", twice - F.pmod(twice, whole), whole).cast("double") / F.lit(100.0)


def risk_bucket(score, edges=RISK_EDGES, labels=RISK_LABELS):
    """Label of the left-closed interval the score falls in."""
    column = F.col(score)
    ladder = F.when(column < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        ladder = ladder.when(column < edge, label)
    return ladder.otherwise(labels[-1])


def daily_spend(monthly="avg_monthly_spend", days=DAYS_PER_MONTH):
    return F.col(monthly) / F.lit(float(days))


def grid_points_reached(score, grid):
    """How many points of the ascending `grid` are <= score.

    Nested comparisons, about log2(len(grid)) per row, and exact on a score equal to a point.
    """
    def between(lo, hi):
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return (f"if(`{score}` >= {float(grid[mid])!r}D, "
                f"{between(mid + 1, hi)}, {between(lo, mid)})")

    return F.expr(between(0, len(grid)))


def present(score):
    """The score; a null one has no side of any threshold and fails the job by name."""
    return F.coalesce(F.col(score).cast("double"), F.raise_error(F.lit(f"null score in {score}")).cast("double"))
