"""Operators that need row order, without ever sorting a large group in one task."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from . import skew

CUTS = 4_096             # quantiles that the sketch of an order key is asked for
ACCURACY = 10_000        # of that sketch: ranks are off by rows / ACCURACY at most
FINISH_ROWS = 100_000    # a remainder this small is sorted directly
MOST_SLICES = 4_096      # of a hot key
SLICE_SAMPLE = 16        # sampled rows a slice of a hot key
FAN = 64                 # boundaries of slices looked through at a time


# ---------------------------------------------------------------- previous row

def with_previous(df, key, order, value, alias, hot_rows=None):
    """Add the `value` of the preceding row of the same key (null for the first).

    One window per key, if there is no hot key. Else the rows of hot keys are numbered by slices,
    whose boundaries come from a sample, and all rows take one shuffle to windows of (key, slice).
    The result is written, and the first row of a slice takes the last value of the slice before it.
    Apart from the sample the input is read once.
    """
    hot = skew.hot_keys(df, key, hot_rows)
    if hot.isEmpty():
        return df.withColumn(alias, F.lag(value).over(Window.partitionBy(key).orderBy(*order)))
    marked = df.join(skew.sized(slice_bounds(df, hot, key, order)), skew.is_hot(key), "left")
    sliced = marked.withColumn("_slice", _slice_number(order)).drop("_hot", "_bounds", "_coarse")
    within = Window.partitionBy(key, "_slice").orderBy(*order)
    # written, because the carried values are made of the same rows; other keys have no slice
    inside = materialize(sliced.withColumn(alias, F.lag(value).over(within)))
    cut = inside.filter(F.col("_slice").isNotNull())
    last = cut.groupBy(key, "_slice").agg(F.max(F.struct(*order, F.col(value).alias("_v"))).alias("_last"))
    carried = materialize(last.select(      # at most MOST_SLICES rows a hot key
        F.col(key).alias("_hot"), F.col("_slice").alias("_in"),
        F.lag("_last._v").over(Window.partitionBy(key).orderBy("_slice")).alias("_carried")))
    return (inside.join(skew.sized(carried), skew.is_hot(key) & (F.col("_slice") == F.col("_in")), "left")
            .withColumn(alias, F.coalesce(F.col(alias), F.col("_carried")))
            .select(*df.columns, alias))


def slice_bounds(df, hot, key, order):
    """_hot, _bounds and _coarse for each hot key: the order keys at which its slices begin, and every FAN-th of them.

    A key gets as many slices as its pieces say, MOST_SLICES at most, and the boundaries are
    quantiles of a sample of SLICE_SAMPLE rows a slice. They decide how even slices are, not what is in
    them, so any sample gives the same result.
    """
    pieces = F.least(F.col("_pieces"), F.lit(MOST_SLICES))
    # no key needs a larger share of its rows than one of two slices
    share = hot.agg(F.max(F.least(F.lit(1.0), SLICE_SAMPLE * pieces / F.col("_rows")))).first()[0]
    seen = df.select(key, *order) if share >= 1 else df.select(key, *order).sample(share, seed=2)
    wanted = F.least(F.lit(1.0), SLICE_SAMPLE * pieces / (F.col("_rows") * F.lit(min(share, 1.0))))
    rows = (seen.join(skew.sized(hot), skew.is_hot(key)).filter(F.rand(3) < wanted)
            .groupBy("_hot", pieces.alias("_pieces")).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_seen")))
    step = lambda i: F.col("_seen")[F.floor(i * F.size("_seen") / F.col("_pieces")).cast("int")]
    bounds = rows.withColumn("_bounds", F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("_pieces") - 1), step)))
    coarse = F.filter("_bounds", lambda b, i: i % FAN == FAN - 1)
    return materialize(bounds.select("_hot", "_bounds", coarse.alias("_coarse")))


def _slice_number(order):
    """Number of the boundaries in `_bounds` that are not after the row; null for a key without."""
    def reached(bounds):
        def not_after(b):
            condition = F.lit(True)
            for c in reversed(order):
                condition = (b[c] < F.col(c)) | ((b[c] == F.col(c)) & condition)
            return condition
        return F.size(F.filter(bounds, not_after))

    # the coarse boundaries tell which FAN of the others are to be looked through
    number = F.transform(F.array(reached(F.col("_coarse")) * FAN), lambda at: at + reached(
        F.slice("_bounds", at + 1, F.lit(FAN))))[0]
    return F.when(F.col("_bounds").isNotNull(), number)


# ------------------------------------------------------------- row at a rank

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def place(df, column):
    """The order key as a number of the same order: whole microseconds or days for times, else itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        seconds = (F.col(column) - epoch).cast("interval second").cast("decimal(18,6)")
        return (seconds * 1_000_000).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return F.col(column)
    raise TypeError(f"order key {column} must be a number, a date or a timestamp, not {kind.simpleString()}")


def _literal(kind, place):
    """The key whose place is `place`, as a constant the scan can push down."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(place))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(place))
    if not isinstance(kind, T.TimestampNTZType):
        return F.lit(place).cast(kind)
    seconds, micros = divmod(place, 1_000_000)
    days, seconds = divmod(seconds, 86_400)
    return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval({days}, 0, 0, "
                  f"cast({seconds}.{micros:06d} as decimal(18,6)))")


def _sketch(df, order):
    """Rows, null keys, and CUTS + 1 approximate quantiles of the first key, in one pass over the order keys."""
    found = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(order)],
        F.percentile_approx(place(df, order[0]), [i / CUTS for i in range(CUTS + 1)], ACCURACY).alias("cuts")).first()
    for i, c in enumerate(order):
        if found[f"null_{i}"]:
            raise ValueError(f"order key {c} is null in {found[f'null_{i}']} rows")
    return found["n"], found["cuts"]


def _census(df, column, low, high):
    """Rows by the value of a key inside [low, high], and rows below and above it, in one pass; written.

    Columns _side (-1, 0, 1), _place, _rows. None leaves a side open. Rows with the same key are one
    group, counted before the shuffle.
    """
    kind = df.schema[column].dataType
    side = F.lit(0)
    if high is not None:
        side = F.when(F.col(column) > _literal(kind, high), 1).otherwise(side)
    if low is not None:
        side = F.when(F.col(column) < _literal(kind, low), -1).otherwise(side)
    return materialize(df.select(side.alias("_side"), place(df, column).alias("_place"))
                       .groupBy("_side", F.when(F.col("_side") == 0, F.col("_place")).alias("_place"))
                       .agg(F.count(F.lit(1)).alias("_rows")))


def _bracketed(df, column, rank, n, cuts):
    """(place, rank among the rows of that place, their number) of the row at `rank` by one key.

    The quantiles bracket the rank, a census proves the bracket and holds the exact place. Where it
    does not hold, because a sketch of many parts may be off, the bracket is widened.
    """
    first, width = rank * CUTS // n, 1 + 2 * CUTS // ACCURACY
    while True:
        low = cuts[first - width] if first >= width else None
        high = cuts[first + 1 + width] if first + 1 + width <= CUTS else None
        if isinstance(low, int):        # the sketch holds doubles, which tell large whole numbers apart only so far
            low = max(low - (abs(low) >> 52), -1 << 63)
        if isinstance(high, int):
            high = min(high + (abs(high) >> 52), (1 << 63) - 1)
        counts = _census(df, column, low, high)
        sides = {r["_side"]: (r["rows"], r["places"]) for r in
                 counts.groupBy("_side").agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("places")).collect()}
        below, (inside, places) = sides.get(-1, (0, 0))[0], sides.get(0, (0, 0))
        if below <= rank < below + inside:
            break
        width *= 8
    totals = running_totals(counts.filter("_side = 0").select("_place", "_rows"), ["_place"], {"_upto": "_rows"},
                            bounded=places <= FINISH_ROWS)
    reached = rank - below
    found = totals.filter((F.col("_upto") > reached) & (F.col("_upto") - F.col("_rows") <= reached)).first()
    return found["_place"], reached - (found["_upto"] - found["_rows"]), found["_rows"]


def row_at_rank(df, rank_of, order=("timestamp", "transaction_id")):
    """Order keys of the row with 0-based rank `rank_of(number of rows)` when sorted by `order`.

    Two passes over the order keys, whatever their range: a sketch, whose quantiles bracket the row,
    and an exact count in the bracket. Rows equal in the first key are one group there; the next key
    is searched in the same way among them alone, by a filter that the scan can use. Nothing is
    shuffled but counts. Keys are numbers, dates or timestamps; a zoned timestamp is returned with
    its zone, NaN is the greatest number. None when there is no such row. Rows with a null order key
    have no place: they are refused by name.
    """
    order = list(order)
    df, rank = df.select(*order), None
    for i, column in enumerate(order):
        n, cuts = _sketch(df, order[i:])
        if rank is None:
            rank = rank_of(n)
            if not 0 <= rank < n:
                return None
        if n <= FINISH_ROWS:
            break
        at, rank, n = _bracketed(df, column, rank, n, cuts)
        df = df.filter(F.col(column) == _literal(df.schema[column].dataType, at))
        if n == 1:
            break
    zoned = [c for c in order if isinstance(df.schema[c].dataType, T.TimestampType)]
    ranked = df.orderBy(*order).offset(rank) if n > 1 and n <= FINISH_ROWS else df      # else all rows left are equal
    found = ranked.limit(1).withColumns({c: F.unix_micros(c) for c in zoned}).first()
    return tuple(EPOCH + timedelta(microseconds=v) if c in zoned else v for c, v in zip(order, found))


# -------------------------------------------------------------- temporal split

def _constant(value):
    """An order key as a constant; a time without a zone is a timestamp_ntz."""
    if not isinstance(value, datetime):
        return F.lit(value)
    if value.tzinfo is None:
        return F.lit(str(value)).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit((value - EPOCH) // timedelta(microseconds=1)))


def before(point, order=("timestamp", "transaction_id")):
    """Condition for rows strictly before the point, comparing the order keys left to right."""
    earlier, same = F.lit(False), F.lit(True)
    for column, value in zip(order, point):
        bound = _constant(value)
        earlier = earlier | (same & (F.col(column) < bound))
        same = same & (F.col(column) == bound)
    return earlier


def split_point(df, test_fraction, order=("timestamp", "transaction_id")):
    """Order keys of the first test row, the one of rank int(n * (1 - fraction))."""
    return row_at_rank(df, lambda n: int(n * (1 - test_fraction)), order)


def temporal_split(df, test_fraction, order=("timestamp", "transaction_id")):
    """(train, test, order keys of the first test row): earlier rows train, later rows test.

    Both parts are filters on the input, so the split moves no rows.
    """
    point = split_point(df, test_fraction, order)
    if point is None:
        return df, df.filter(F.lit(False)), None
    early = before(point, order)
    return df.filter(early), df.filter(~early), point


# ------------------------------------------------------------------ dense rank

def number_rows(df, order, alias, start=1):
    """Add the dense position of each row in `order`, which must tell all rows apart.

    One range shuffle; a position is the row's place in its partition plus the rows of all
    partitions before it.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_place", F.monotonically_increasing_id()))
    # upper bits: partition, lower 33 bits: place in it
    part = F.shiftright("_place", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))   # one row per partition
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(start)
    return (placed.withColumn("_part", F.shiftright("_place", 33))
            .join(F.broadcast(offsets), "_part")
            .select(position.alias(alias), *df.columns))


# -------------------------------------------------------------- running totals

def running_totals(df, order, sums, bounded, by=()):
    """Add running totals of the columns in `sums` ({alias: column}) along `order`, in each group of `by`.

    Also adds the totals of the group as {alias}_all. With `bounded` the caller states that the frame is
    small (an aggregate over a fixed number of groups) and one window does. Otherwise it is range
    partitioned on `by` and `order`, summed inside each partition, and shifted by the totals of the
    partitions before it, so that one group may hold all rows.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if bounded:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(*upto)
        return df.withColumns({a: F.sum(c).over(window) for a, c in sums.items()}
                              | {f"{a}_all": F.sum(c).over(whole) for a, c in sums.items()})
    placed = materialize(df.repartitionByRange(*by, *order)
                         .withColumn("_part", F.spark_partition_id()))
    # one row per partition and group that lies in it
    totals = placed.groupBy("_part", *by).agg(*[F.sum(c).alias(f"_t_{a}") for a, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *by, *[
        column for a in sums for column in (
            F.coalesce(F.sum(f"_t_{a}").over(earlier), F.lit(0)).alias(f"_o_{a}"),
            F.sum(f"_t_{a}").over(whole).alias(f"{a}_all"))])
    window = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(*upto)
    summed = placed.withColumns({a: F.sum(c).over(window) for a, c in sums.items()})
    return (summed.join(skew.sized(offsets) if by else F.broadcast(offsets), ["_part", *by])
            .select(*df.columns, *[(F.col(a) + F.col(f"_o_{a}")).alias(a) for a in sums],
                    *[f"{a}_all" for a in sums]))
