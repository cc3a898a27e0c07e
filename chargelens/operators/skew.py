"""Hot keys, and a dimension join that stays balanced when one key holds much of the fact."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize

HOT_ROWS = 1_000_000        # a key with fewer rows is never worth special care
ROWS_PER_PIECE = 1_000_000
SAMPLED_ROWS = 1_000        # rows of a just-hot key that the search looks at
BROADCAST_BYTES = 64 << 20  # of a side that is broadcast, as counted
VALUE_BYTES = 16            # counted for a value of fixed width


_counted = {}       # (application, plan, files) -> bytes


def counted_bytes(df):
    """Bytes of all values of the frame, from one pass over it; once for the same plan over the same files."""
    files = df.inputFiles()
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), df.schema.simpleString(), tuple(sorted(files)))
    if files and key in _counted:
        return _counted[key]
    size = F.lit(VALUE_BYTES * len(df.columns))
    for field in df.schema.fields:
        if not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType, T.TimestampNTZType)):
            size = size + F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
    found = df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]
    if files:
        _counted[key] = found
    return found


def sized(df, most=None):
    """The frame, broadcast if it is counted at `most` bytes or less (BROADCAST_BYTES unless given)."""
    return F.broadcast(df) if counted_bytes(df) <= (BROADCAST_BYTES if most is None else most) else df


def hot_keys(df, key, hot_rows=None):
    """Written frame (_hot, _rows, _pieces) of the keys with about `hot_rows` rows or more, a null key included.

    `hot_rows` is HOT_ROWS unless given, `_rows` is estimated, `_pieces` says over how many pieces
    the rows of the key are to be spread. There are fewer such keys than twice the rows divided by
    `hot_rows`; none of them passes through the driver.

    Keys are looked for in a sample that shows about SAMPLED_ROWS rows of a key of that size, so
    only a small share of the keys is shuffled to be counted. The answer decides which of two exact
    ways a row takes, never whether it is kept.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    fraction = min(1.0, SAMPLED_ROWS / hot_rows)
    seen = df.select(key) if fraction == 1.0 else df.select(key).sample(fraction, seed=1)
    least = hot_rows if fraction == 1.0 else hot_rows * fraction / 2
    rows = F.ceil(F.col("count") / F.lit(fraction))
    return materialize(seen.groupBy(F.col(key).alias("_hot")).count().filter(F.col("count") >= least)
                       .select("_hot", rows.alias("_rows"),
                               F.greatest(F.lit(2), F.ceil(rows / F.lit(ROWS_PER_PIECE))).cast("int").alias("_pieces")))


def is_hot(key):
    """Condition that joins a frame to the result of `hot_keys`; null is a key like others."""
    return F.col(key).eqNullSafe(F.col("_hot"))


def join_dimension(fact, dim, key, how="inner", spread_by="transaction_id", broadcast_bytes=None, hot_rows=None):
    """Join a fact to a dimension that is unique on `key`.

    The dimension is broadcast when it is counted at `broadcast_bytes` or less (BROADCAST_BYTES
    unless given). Beyond that it is a shuffle join in which hot keys are spread: the fact rows of
    such a key over as many pieces as its size asks for, by a hash of `spread_by`, and its one
    dimension row copied to each piece. Rows with a null key, which match nothing, are spread alike.
    """
    if counted_bytes(dim) <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return fact.join(F.broadcast(dim), key, how)
    hot = hot_keys(fact, key, hot_rows).select("_hot", "_pieces")
    if hot.isEmpty():
        return fact.join(dim, key, how)
    pieces = sized(hot)
    count = F.coalesce(F.col("_pieces"), F.lit(1))
    spread_fact = fact.join(pieces, is_hot(key), "left").withColumn(
        "_piece", F.pmod(F.xxhash64(spread_by), count).cast("int"))
    spread_dim = dim.join(pieces, is_hot(key), "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), count - 1))).drop("_hot", "_pieces")
    columns = fact.columns + [c for c in dim.columns if c != key]
    return spread_fact.drop("_hot", "_pieces").join(spread_dim, [key, "_piece"], how).select(*columns)
