"""Helpers shared by the corpus operators."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..storage import materialize  # noqa: F401  (the operators import it from here)

PIECE_BYTES = 1 << 22    # text bytes handled at once inside a task; a longer text is handled alone


def column(name):
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(base, taken):
    """`base`, lengthened until no name in `taken` equals it (names ignore case in Spark)."""
    taken = {t.lower() for t in taken}
    while base.lower() in taken:
        base += "_"
    return base


def carried(df, carry, results):
    """Names of `carry` (all columns if None) that do not clash with a result column."""
    results = {r.lower() for r in results}
    return [c for c in (df.columns if carry is None else carry) if c.lower() not in results]


def pieces(batch, index, limit=PIECE_BYTES):
    """Slices of an Arrow batch that hold about `limit` bytes in column `index`, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        used = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, used + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def per_text(df, text, fn, fields, carry=None, binary=False, limit=PIECE_BYTES):
    """Carried columns plus `fields`, which `fn` computes from lists of whole texts.

    `fn(texts)` gets str (bytes with `binary`) or None per row and returns one list or array per
    field. `fields` is DDL text. A carried column that clashes with a field gives way to it. The
    text is sent to Python once, also when it is carried.
    """
    added = T.StructType.fromDDL(fields)
    keep = carried(df, carry, added.names)
    kind = "binary" if binary else "string"
    at = keep.index(text) if text in keep else len(keep)
    sent = [column(c).cast(kind).alias(c) if i == at else column(c) for i, c in enumerate(keep)]
    if at == len(keep):
        sent.append(column(text).cast(kind).alias(free_name("_text", keep)))
    source = df.select(*sent)
    schema = T.StructType(source.schema.fields[:len(keep)] + added.fields)
    types = [f.type for f in to_arrow_schema(added)]

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, at, limit):
                found = fn(piece.column(at).to_pylist())
                arrays = [pa.array(values, type=kind) for values, kind in zip(found, types)]
                yield pa.RecordBatch.from_arrays(piece.columns[:len(keep)] + arrays, names=schema.names)

    result = source.mapInArrow(run, schema)
    return result.withColumn(text, column(text).cast("string")) if binary and at < len(keep) else result


def neutral(df):
    """The frame with neutral column names, {name: neutral name}, and the columns that undo it."""
    place = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return (df.select(*[column(n).alias(c) for n, c in place.items()]), place,
            [F.col(c).alias(n) for n, c in place.items()])


def small(df, rows):
    """The frame, broadcast if it has `rows` rows at most; counted, so call it on written tables."""
    return F.broadcast(df) if df.count() <= rows else df


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key, divisor):
    """crc32 of the key as text modulo `divisor`; null for a null key."""
    return F.pmod(F.crc32(column(key).cast("string").cast("binary")), F.lit(divisor))
