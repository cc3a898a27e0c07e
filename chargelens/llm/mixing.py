"""Mixing sources to target weights: random order, prefix sums, an exact cut per source."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.ordered import running_totals
from .common import column, materialize, neutral

WEIGHTS = (3, 1, 2)          # given to the sources by code point, repeating, null last
BUDGET = (3, 2)              # the mix holds 3/2 of all words
MOST_EPOCHS = 2              # and no source more than twice
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(column(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_key(doc_id, seed=SEED):
    return F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))


def targets(sizes, weights=WEIGHTS, budget=BUDGET, epochs=MOST_EPOCHS):
    """Budget of each source by weight, filled up to `epochs` times its size.

    `sizes` has one row a source: source, source_size. Sources that reach their cap stop there and
    what they leave is shared among the others by weight, until none is above its cap. In order of
    cap / weight a source is capped exactly if its share of what the earlier ones left reaches its
    cap, so running sums find the level; all comparisons are between whole numbers.
    Adds target (double) and cut (its whole part).
    """
    up, down = budget
    big = "decimal(38,0)"
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    level = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = (sizes.withColumn("weight", level.cast("bigint"))
            .withColumn("cap", F.col("source_size") * F.lit(epochs)))
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # what is left for this source and those after it is left / down
    rows = (rows.withColumn("left", F.lit(up) * F.sum("source_size").over(whole)
                            - F.lit(down) * F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
            .withColumn("open", F.sum("weight").over(onward)))
    rows = rows.withColumn("capped", (F.col("cap") * down).cast(big) * F.col("open").cast(big)
                           <= F.col("weight").cast(big) * F.col("left").cast(big))
    first = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("ratio"),
                                                    F.col("source").isNull().alias("last"), "source",
                                                    "left", "open"))).over(whole)
    share = F.col("weight") * F.col("at.left")
    per = F.col("at.open") * down
    return (rows.withColumn("at", first)
            .withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double"))
                        .otherwise(share.cast("double") / per.cast("double")))
            .withColumn("cut", F.floor("target").cast("bigint"))
            .select("source", "source_size", "weight", "target", "cut"))


def mix(docs, size, weights=WEIGHTS, budget=BUDGET, epochs=MOST_EPOCHS, seed=SEED, carry=("doc_id",),
        doc_id="doc_id", source="source", ties=()):
    """How much of each document the mix takes: carried columns, source, size, source_size, target, taken,
    key (the hash that orders a source) and rounds (how often the mix takes the whole source).

    `size` is the column with a document's words. Documents of a source are put in the order of a
    seeded hash of doc_id; the first `cut` words of that order, taken round and round, are in the
    mix. A document inside the budget of the last round counts once more; the one on the edge is
    taken in part, so the words taken from a source are exactly its budget, rounded down.

    Rows are range-partitioned by (source, hash), so a source of any size is spread over tasks; the
    prefix sums are sums inside partitions plus one offset a partition. Null sources are one source,
    null doc_ids hash as empty text, null sizes count 0. Repeated rows count as often as they occur;
    equal ones are interchangeable. Equal hashes are ordered by doc_id, size and the columns `ties`. Empty tables and sources without words give taken 0.
    Carried columns that clash with a result are replaced.
    """
    results = ["source", "size", "source_size", "target", "taken", "key", "rounds"]
    keep = [c for c in carry if c.lower() not in results]
    rows = docs.select(
        column(source).alias("source"), F.coalesce(column(size), F.lit(0)).cast("bigint").alias("size"),
        hash_key(column(doc_id), seed).alias("key"),
        column(doc_id).alias("tie"), *[column(c).alias(f"t{i}") for i, c in enumerate(ties)],
        *[column(c).alias(f"k{i}") for i, c in enumerate(keep)])
    rows = materialize(rows)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(materialize(sizes), weights, budget, epochs).withColumn(
        "start", F.coalesce(F.sum("source_size").over(
            Window.orderBy(F.col("source").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    order = ["source", "key", "tie", "size", *[f"t{i}" for i in range(len(ties))]]     # rows equal in these take part alike
    summed = running_totals(rows, order, {"upto": F.col("size")}, bounded=False)
    goals = goals.withColumnRenamed("source", "of")
    joined = summed.join(goals, F.col("source").eqNullSafe(F.col("of")))
    before = F.col("upto") - F.col("size") - F.col("start")
    rounds = F.expr("if(source_size = 0, 0L, cut div source_size)")
    rest = F.col("cut") - F.col("rounds") * F.col("source_size")
    return (joined.withColumn("rounds", rounds)
            .withColumn("taken", F.col("rounds") * F.col("size")
                        + F.greatest(F.lit(0), F.least(F.col("size"), rest - before)))
            .select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *results))


def repeat_rows(docs):
    """The rows of `docs` as often as the mix takes them, whole: the columns stay.

    Every row of a source comes `rounds` times, and once more if in the order of hash, doc_id, size and
    text hash it is not beyond the row at the edge of the budget, so the edge row comes whole, with rows
    equal to it in all of these. The decision is one row a source, and the texts are not shuffled.
    Rows without words go with their place like any others.
    """
    frame, place, back = neutral(docs)
    doc_id, text = F.col(place["doc_id"]), F.col(place["text"])
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    narrow = frame.select(doc_id.alias("doc_id"), F.col(place["source"]).alias("source"), size.alias("size"),
                          F.xxhash64(text).alias("mark"))
    taken = mix(narrow, "size", carry=("doc_id", "mark"), ties=("mark",))
    more = F.col("taken") > F.col("rounds") * F.col("size")
    spot = F.struct("key", "doc_id", "size", "mark")
    edges = materialize(taken.groupBy(F.col("source").alias("_source")).agg(
        F.max("rounds").alias("_rounds"), F.max(F.when(more, spot)).alias("_edge")))
    own = F.struct(hash_key(doc_id).alias("key"), doc_id.alias("doc_id"), size.alias("size"),
                   F.xxhash64(text).alias("mark"))
    # the hash decides but for the edge's own, so words are counted again only there
    edge = F.col("_edge")
    inside = (hash_key(doc_id) < edge["key"]) | ((hash_key(doc_id) == edge["key"]) & (own <= edge))
    times = F.col("_rounds") + F.when(inside, 1).otherwise(0)
    return (frame.join(edges, F.col(place["source"]).eqNullSafe(F.col("_source")))
            .withColumn("_times", times.cast("int")).filter("_times > 0")
            .withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*back))


def mix_documents(docs):
    """Mix of `documents` by the default weights; a document's size is its number of words."""
    narrow = docs.select(column("doc_id"), column("source"), word_count("text").alias("size"))
    return mix(narrow, "size").select("doc_id", "size", "source_size", "target", "taken", "source")
