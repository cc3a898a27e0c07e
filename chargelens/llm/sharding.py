"""Shards that all hold the same mixture: proportional stratified interleaving."""

from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from .common import column, materialize

SEED = "shards-1"


def _text(name):
    return F.coalesce(column(name).cast("string"), F.lit(""))


def interleave(df, stratum, keys, shards, seed=SEED):
    """Add `shard` (int), `slot` (long) and `fraction` (double) to the rows of `df`.

    The rows of a stratum are shuffled by a seeded hash of `keys` and ranked; a row's fraction is
    (rank - 0.5) / rows of its stratum. All rows are sorted by fraction and cut into `shards` runs
    whose counts differ by one at most, so each run holds every stratum in proportion. `slot` is
    the place in the run. Both ranks come from range partitions and offsets of whole partitions,
    so a stratum of any size is spread over tasks.

    `keys` should tell rows apart; rows equal in them and in the stratum are interchangeable, so
    they should hold all that distinguishes rows. A null stratum is a stratum of its own, a null
    key hashes as empty text. An empty table gives no rows. With fewer rows than shards some
    shards stay empty. Columns named shard, slot or fraction are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    names = [c for c in df.columns if c.lower() not in ("shard", "slot", "fraction")]
    inner = [f"c{i}" for i in range(len(names))]
    of = dict(zip(names, inner))
    order = [of[k] for k in keys]
    rows = df.select(*[column(n).alias(of[n]) for n in names])
    rows = materialize(rows.withColumn("_key", F.xxhash64(
        F.lit(seed), *[F.coalesce(F.col(o).cast("string"), F.lit("")) for o in order])))
    sizes = materialize(rows.groupBy(F.col(of[stratum]).alias("_s")).agg(F.count(F.lit(1)).alias("_n")))
    ranked = number_rows(rows, [of[stratum], "_key", *order], "_rank")
    # number_rows sorts nulls first, and so does the running count of the strata
    starts = _starts(sizes)
    joined = ranked.join(starts, F.col(of[stratum]).eqNullSafe(F.col("_s")))
    placed = joined.withColumn("fraction", (F.col("_rank") - F.col("_before") - F.lit(0.5)) / F.col("_n"))
    placed = materialize(placed.select(*inner, "_key", "fraction"))
    cut = number_rows(placed, ["fraction", "_key", *order], "_at", start=0)
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    shard = F.floor(F.col("_at") * F.lit(shards) / F.lit(max(total, 1)))
    if total * shards < 1 << 62:
        shard = F.expr(f"(_at * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")   # first place of the shard
    return (cut.withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.col("_at") - first)
            .select(*[F.col(of[n]).alias(n) for n in names], "shard", "slot", "fraction"))


def _starts(sizes):
    """Rows of the strata before each stratum, nulls first; one row a stratum."""
    from pyspark.sql import Window

    before = Window.orderBy(F.col("_s").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return materialize(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))


def shard_documents(docs, shards=16):
    """All documents in shards 0 to `shards` - 1 by source, with size and checksum.

    Returns doc_id, size (UTF-8 bytes of the text plus 1, null text: 1), text_crc32 (null text: 0),
    law ("rows"), shard, slot, grown_shard (null) and source. Only these narrow columns are sorted.
    Repeated rows are kept and placed like any others.
    """
    narrow = docs.select(
        column("doc_id"), column("source"),
        (F.coalesce(F.octet_length(column("text")), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(_text("text").cast("binary")).alias("text_crc32"))
    cut = interleave(narrow, "source", ["doc_id", "text_crc32", "size"], shards)
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")
