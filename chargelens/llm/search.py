"""Ranked lexical search of a table of items against all documents, by a search in two trees."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ordered
from .common import column, materialize, per_text

K = 20
PASS_BLOCKS = 16
BLOCK_TERMS = 1 << 14       # terms of the items of a block, each item's counted; PASS_BLOCKS blocks share a reading of the texts
FAN = 16                    # documents a leaf, leaves a branch, branches a tree
ITEM_FAN = 8
EXACT = 1 << 53             # whole numbers below this are exact as doubles
#: Upper-case letters to lower case, bytes that no term holds to blanks.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text):
    """Terms of a text in UTF-8: stretches of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(BYTES).split() if text else []


# ------------------------------------------------------------- what is counted

def item_terms(items, item_id="item_id", text="text"):
    """item, item_id, terms, times and block of every different (item_id, text) that has a term.

    Written once. `item` numbers the items; a block holds items that begin within BLOCK_TERMS terms.
    """
    distinct = items.select(column(item_id).alias("item_id"), column(text).cast("string").alias("text")).distinct()

    def count(texts):
        counted = [Counter(terms(t)) for t in texts]
        return [[t.decode() for t in c] for c in counted], [list(c.values()) for c in counted]

    counted = per_text(distinct, "text", count, "terms array<string>, times array<bigint>", ["item_id"], binary=True)
    counted = counted.filter(F.size("terms") > 0).withColumns(
        {"one": F.lit(1).cast("long"), "size": F.size("terms").cast("long")})
    numbered = ordered.running_totals(counted, ["item_id", "terms", "times"], {"item": "one", "end": "size"}, bounded=False)
    return materialize(numbered.select(
        "item", "item_id", "terms", "times", F.expr(f"(end - size) div {BLOCK_TERMS}").alias("block")))


def document_terms(docs, vocabulary, doc_id="doc_id", text="text"):
    """doc_id, n (terms with repeats), and places and times of the terms in `vocabulary`, per document."""
    place = {t.encode(): i for i, t in enumerate(vocabulary)}

    def count(texts):
        sizes, places, times = [], [], []
        for t in texts:
            words = terms(t)
            sizes.append(len(words))
            found = Counter(filter(place.__contains__, words))
            places.append([place[w] for w in found])
            times.append(list(found.values()))
        return sizes, places, times

    rows = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    return per_text(rows, "text", count, "n bigint, places array<int>, times array<bigint>", ["doc_id"], binary=True)


def weight(documents, having):
    """Whole-number weight of a term that `having` of `documents` documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def lengths(n, documents, total):
    """Length of each document against the mean, in hundredths, softened: 75 + 25 * n / mean."""
    if 25 * int(n.max(initial=0)) * documents >= 1 << 63:
        return np.array([75 + 25 * int(x) * documents // total for x in n], dtype=np.int64)
    return 75 + 25 * n * documents // total


# ------------------------------------------------------------------------ trees

class Node:
    """Items of a branch: their numbers, the terms any of them has, and the highest weight of each term."""

    def __init__(self, items, places, weights, children=()):
        self.items, self.places, self.weights, self.children = items, places, weights, children
        self.most = weights.max(axis=0)


def item_tree(vectors):
    """Root over {place: weight} vectors; items of a leaf begin with the same heavy terms where possible."""
    heavy = [sorted(v, key=lambda p: (-v[p], p)) for v in vectors]
    line = sorted(range(len(vectors)), key=lambda i: heavy[i])
    level = []
    for at in range(0, len(line), ITEM_FAN):
        items = line[at:at + ITEM_FAN]
        places = np.array(sorted({p for i in items for p in vectors[i]}), dtype=np.int64)
        weights = np.array([[vectors[i].get(p, 0) for p in places.tolist()] for i in items], dtype=np.int64)
        level.append(Node(np.array(items), places, weights))
    while len(level) > 1:
        upper = []
        for at in range(0, len(level), ITEM_FAN):
            children = level[at:at + ITEM_FAN]
            places = np.unique(np.concatenate([c.places for c in children]))
            weights = np.zeros((len(children), len(places)), dtype=np.int64)
            for row, child in zip(weights, children):
                row[np.searchsorted(places, child.places)] = child.most
            upper.append(Node(np.concatenate([c.items for c in children]), places, weights, children))
        level = upper
    return level[0]


class Documents:
    """A tree over up to FAN ** 3 documents: for each leaf, branch and the root the highest value of each term."""

    def __init__(self, owner, place, value, heaviest, terms):
        # documents with the same heaviest term share leaves, so that the maxima of a leaf stay low
        worth = heaviest[place] * value
        first = np.lexsort((place, -worth, owner))
        ids, begin = np.unique(owner[first], return_index=True)
        self.rows = ids[np.lexsort((ids, -worth[first][begin], place[first][begin]))]
        position = np.empty(int(owner.max()) + 1, dtype=np.int64)
        position[self.rows] = np.arange(len(self.rows))
        order = np.argsort(position[owner], kind="stable")
        self.at, self.place, self.value = position[owner][order], place[order], value[order]
        self.start = np.searchsorted(self.at, np.arange(len(self.rows) + 1))
        leaves = np.zeros((-(-len(self.rows) // FAN), terms))
        np.maximum.at(leaves, (self.at // FAN, self.place), self.value)
        self.levels = [leaves]
        while len(self.levels) < 3:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), FAN), axis=0))

    def dense(self, leaves, node, column_of):
        """Documents of the leaves, and their values of the node's terms, a row each."""
        rows = (leaves[:, None] * FAN + np.arange(FAN)).ravel()
        rows = rows[rows < len(self.rows)]
        counts = self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(counts)
        picked = np.repeat(self.start[rows] - ends + counts, counts) + np.arange(ends[-1])
        columns = column_of[self.place[picked]]
        held = columns >= 0
        values = np.zeros((len(rows), len(node.places)), dtype=np.int64)
        values[np.repeat(np.arange(len(rows)), counts)[held], columns[held]] = self.value[picked][held]
        return rows, values


def products(values, weights):
    """Exact scores, documents by items."""
    if weights.sum(axis=1).max() * 1_000_000 < EXACT:       # a value is below a million
        return (values.astype(np.float64) @ weights.T.astype(np.float64)).astype(np.int64)
    return values @ weights.T


class Search:
    """The best k documents of each item so far, over trees of documents given one after the other."""

    def __init__(self, root, items, terms, k):
        self.root, self.k = root, k
        self.best = [[] for _ in range(items)]              # (-score, no id, id), best first
        self.weakest = np.ones(items, dtype=np.int64)       # a score must reach this to be among the k
        self.heaviest = np.zeros(terms)
        self.heaviest[root.places] = root.most
        self.column_of = np.full(terms, -1, dtype=np.int64)

    def add(self, owner, place, value, ids):
        """Search documents given as (row, term, value) triples; `ids` has the id of each row."""
        if len(owner):
            tree = Documents(owner, place, value, self.heaviest, len(self.heaviest))
            self._visit(self.root, tree, 2, np.zeros(1, dtype=np.int64), ids)

    def _visit(self, node, tree, level, at, ids):
        """All items of `node` against the documents below the nodes `at` of a level.

        The products of the maxima bound every score of a pair of nodes. A pair whose bound is below
        the weakest kth score of all items of the node cannot change any result, and is left.
        """
        bounds = tree.levels[level][np.ix_(at, node.places)] @ node.most.astype(np.float64)
        at = at[bounds * (1 + 1e-9) >= self.weakest[node.items].min()]
        if not len(at):
            return
        if level:
            below = (at[:, None] * FAN + np.arange(FAN)).ravel()
            at, level = below[below < len(tree.levels[level - 1])], level - 1
        elif not node.children:
            self._leaf(node, tree, at, ids)
            return
        for child in node.children or (node,):
            self._visit(child, tree, level, at, ids)

    def _leaf(self, leaf, tree, at, ids):
        """The items of a leaf, each with its own bound, against leaves of documents, the most promising first."""
        bounds = tree.levels[0][np.ix_(at, leaf.places)] @ leaf.weights.T.astype(np.float64) * (1 + 1e-9)
        order = np.argsort(-bounds.max(axis=1), kind="stable")
        at, bounds = at[order], bounds[order]
        while len(at):
            live = (bounds >= self.weakest[leaf.items]).any(axis=1)
            at, bounds = at[live], bounds[live]
            if len(at):
                self._score(leaf, tree, at[:FAN], ids)
                at, bounds = at[FAN:], bounds[FAN:]

    def _score(self, leaf, tree, at, ids):
        self.column_of[leaf.places] = np.arange(len(leaf.places))
        rows, values = tree.dense(at, leaf, self.column_of)
        self.column_of[leaf.places] = -1
        for item, scores in zip(leaf.items.tolist(), products(values, leaf.weights).T):
            good = np.flatnonzero(scores >= self.weakest[item])
            if len(good) > self.k:          # those below the kth best of these cannot stay; ties are settled by id
                good = good[scores[good] >= np.partition(scores[good], -self.k)[-self.k]]
            if len(good):
                named = ids.take(pa.array(tree.rows[rows[good]])).to_pylist()
                ranked = sorted(self.best[item] + [(-s, i is None, i) for s, i in zip(scores[good].tolist(), named)],
                                key=lambda r: r[:2] if r[1] else r)[:self.k]
                self.best[item] = ranked
                if len(ranked) == self.k:
                    self.weakest[item] = -ranked[-1][0]


# ----------------------------------------------------------------------- search

def _search_block(counted, rows, place, having, documents, total, k):
    """item, doc_id, score: the best k of each part of `counted` for the items in `rows`."""
    local = {p: i for i, p in enumerate(sorted({place[t] for r in rows for t in r["terms"]}))}
    vectors = [{local[place[t]]: weight(documents, having.get(place[t], 0)) * times
                for t, times in zip(r["terms"], r["times"])} for r in rows]
    numbers = [r["item"] for r in rows]
    to_local = np.full(len(place), -1, dtype=np.int64)
    to_local[list(local)] = list(local.values())
    schema = T.StructType([T.StructField("item", T.LongType()), counted.schema["doc_id"],
                           T.StructField("score", T.LongType())])

    def run(batches):
        search, kind = Search(item_tree(vectors), len(vectors), len(local), k), None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, FAN ** 3):
                part = batch.slice(at, FAN ** 3)
                n = part.column("n").to_numpy(zero_copy_only=False)
                m = lengths(n, documents, total)
                owner = np.repeat(np.arange(part.num_rows), part.column("places").value_lengths().to_numpy())
                terms_of = to_local[part.column("places").flatten().to_numpy()]
                times = part.column("times").flatten().to_numpy()
                held = terms_of >= 0
                owner, terms_of, times = owner[held], terms_of[held], times[held]
                value = 1_000_000_000 * times // (1000 * times + 12 * m[owner])
                search.add(owner, terms_of, value, part.column("doc_id"))
        found = [(numbers[i], r[2], -r[0]) for i, best in enumerate(search.best) for r in best]
        if found:
            item, doc, score = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, kind), pa.array(score, pa.int64())],
                                             names=["item", "doc_id", "score"])

    return counted.select("doc_id", "n", "places", "times").mapInArrow(run, schema)


def search(items, docs, k=K, item_id="item_id", doc_id="doc_id", text="text"):
    """item_id, rank (int, from 1), doc_id, score: the k documents with the highest scores above 0 for each item.

    With N documents that have a term, L terms in all of them, n terms of a document, f of them a
    given term, and d documents that hold it, a term weighs w = floor(1000 ln((2N + 2) / (2d + 1)))
    and has the value 10^9 f div (1000 f + 12 m), m = 75 + 25 n N div L; a score is the sum of
    w * value over the item's terms, repeats included. All in whole numbers; equal scores go by
    doc_id, nulls last.

    Items and documents are vectors of weights and of values, and a score is their product. Each
    task builds a tree over FAN^3 documents after the other and one over the items; nodes hold the
    highest value of each term, so the product of two nodes bounds all scores below them, and pairs
    that cannot reach the weakest kth score are left. Each task gives k rows an item at most, which
    a window merges. Texts are read once for every PASS_BLOCKS blocks of items.

    Rows of `docs` are documents of their own, also repeated ones and those with a null id. Rows of
    `items` with equal id and text are one item; an id with several texts has a ranking for each.
    Null texts, and texts without a term, find nothing and are not found, but a document without a
    term does not count in N. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    listed = item_terms(items, item_id, text)
    blocks = listed.agg(F.max("block")).first()[0]
    empty = T.StructType([T.StructField("item_id", items.schema[item_id].dataType), T.StructField("rank", T.IntegerType()),
                          T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())])
    if blocks is None:
        return spark.createDataFrame([], empty)
    found = None
    for first in range(0, blocks + 1, PASS_BLOCKS):
        last = first + PASS_BLOCKS - 1
        # at most PASS_BLOCKS * BLOCK_TERMS terms and one item more
        rows = listed.filter(F.col("block").between(first, last)).select("item", "terms", "times", "block").collect()
        place = {t: i for i, t in enumerate(sorted({t for r in rows for t in r["terms"]}))}
        counted = materialize(document_terms(docs, list(place), doc_id, text))
        documents, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        having = {r["place"]: r["count"] for r in           # one row a term of the items
                  counted.select(F.explode("places").alias("place")).groupBy("place").count().collect()}
        for block in sorted({r["block"] for r in rows}) if total else ():
            part = _search_block(counted, [r for r in rows if r["block"] == block], place, having, documents, total, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], empty)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .join(listed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"))


def search_documents(docs, benchmark):
    """The K best documents of every item of the benchmark."""
    return search(benchmark, docs)


def oracle_sql(k=K):
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents),
dt AS (SELECT k, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
size AS (SELECT k, count(*) AS n FROM dt GROUP BY k),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM size),
tf AS (SELECT k, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM dt GROUP BY k, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY term),
it AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM it GROUP BY item_id, term),
scores AS (
  SELECT item_id, tf.k, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size ON size.k = tf.k, corpus GROUP BY item_id, tf.k),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""
