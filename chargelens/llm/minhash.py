"""Near-duplicates: MinHash bands, sequential Bayesian pruning, exact verification, components."""

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import column, materialize, neutral, per_text, pieces, small

BANDS, ROWS = 24, 5          # a pair at 0.85 shares no band with probability 7e-7, at 0.8 with 7e-5
HASHES = BANDS * ROWS
BATCH = 20                   # signature places compared at a time
MISS = 1e-6                  # a pair goes once its similarity is enough with no more probability than this
BLOCK = 512                  # members of a band compared with each other at once
FETCH_ROWS = 1_000_000       # ids (16 bytes) that may be broadcast to pick texts
CHUNK = 2_048                # shingles hashed at once
#: ASCII capitals in lower case, all else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_draw = np.random.default_rng(20_240_601)
FACTORS = (_draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
SHIFTS = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint32)


# ---------------------------------------------------------------------------- sets

def shingle_set(text, size, codes):
    """Sorted distinct 64-bit hashes of the `size`-word shingles of a text.

    Words are runs of anything but ASCII blanks, with A-Z in lower case. A text with fewer words is
    one shingle, one without words has none. `codes` caches the hashes of words.
    """
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    if len(codes) > 500_000:
        codes.clear()
    numbers = []
    for w in words:
        code = codes.get(w)
        if code is None:
            code = codes[w] = xxhash.xxh3_64_intdigest(w)
        numbers.append(code)
    line = np.array(numbers, np.uint64)
    n = len(line) - size + 1
    total = line[:n].copy()
    for i in range(1, size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        total += line[i:i + n]
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(32)
    return np.unique(total)


def signature(shingles):
    """Least value of each of the HASHES hash functions over the set."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), CHUNK):
        part = short[at:at + CHUNK]
        np.minimum(low, (FACTORS[:, None] * part[None, :] + SHIFTS[:, None]).min(axis=1), out=low)
    return low


def _profile(size):
    codes = {}                   # of words, kept for a task

    def run(texts):
        rows = []
        for t in texts:
            shingles = shingle_set(t, size, codes)
            n = len(shingles)
            rows.append((n, xxhash.xxh3_128_digest(shingles.tobytes()) if n else None,
                         signature(shingles).tobytes() if n else None))
        return list(zip(*rows)) if rows else [[]] * 3
    return run


# ------------------------------------------------------------------------- pruning

def least_matches(similarity, miss=MISS, batch=BATCH, hashes=HASHES):
    """For each batch end n, the fewest matches with which a pair is kept.

    After m matches in n places the posterior of the similarity under a flat prior is
    Beta(m + 1, n - m + 1), and P(similarity >= t) = P(Binomial(n + 1, t) <= m). A pair is pruned
    when that is at most `miss`.
    """
    table = {}
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * similarity ** m * (1 - similarity) ** (n + 1 - m)
            if total > miss:
                break
            m += 1
        table[n] = m
    return table


def survivors(left, right, table):
    """Which of the pairs of signature rows outlive all batches, compared batch by batch."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    begin = 0
    for n, least in sorted(table.items()):
        if not len(alive):
            break
        matches[alive] += (left[alive, begin:n] == right[alive, begin:n]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
        begin = n
    return alive


def _matrix(values):
    return np.frombuffer(b"".join(values), np.uint32).reshape(-1, HASHES)


def _prune(pairs, nodes, table):
    """Pairs (a, b) whose signatures outlive the Bayesian test."""
    left = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            if not batch.num_rows:
                continue
            alive = pa.array(survivors(_matrix(x.to_pylist()), _matrix(y.to_pylist()), table))
            yield pa.RecordBatch.from_arrays([a.take(alive), b.take(alive)], names=["a", "b"])

    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b")
            .mapInArrow(run, "a bigint, b bigint"))


# ---------------------------------------------------------------------- verification

def _sets(wanted_nodes, nodes, rows, size):
    """(node, s): the full shingle sets of the nodes, from their texts."""
    wanted = materialize(wanted_nodes.join(nodes.select("node", "fp", "lead", "mark"), "node"))
    picked = _picked(rows, wanted).select("node", "fp", F.col("text").cast("binary").alias("text"))

    def build(batches):
        codes = {}
        for batch in batches:
            for piece in pieces(batch, 2):
                at, sets = [], []
                for i, (fp, t) in enumerate(zip(piece.column(1).to_pylist(), piece.column(2).to_pylist())):
                    found = shingle_set(t, size, codes).tobytes()
                    if xxhash.xxh3_128_digest(found) == fp:      # else another text with the same id and mark
                        at.append(i)
                        sets.append(found)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(at, pa.int64())), pa.array(sets, pa.binary())], names=["node", "s"])

    sets = materialize(picked.mapInArrow(build, "node bigint, s binary"))
    if not sets.groupBy("node").count().filter("count > 1").isEmpty():      # repeated rows
        sets = materialize(sets.groupBy("node").agg(F.first("s").alias("s")))
    return sets


def _ends(pairs):
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _links(pairs, sets, share):
    """The pairs whose full sets reach the similarity `share` = (up, down): down * both >= up * union."""
    up, down = share

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(down * both >= up * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)],
                                             names=["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("s").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("s_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b")
            .mapInArrow(check, "a bigint, b bigint"))


def _likely(open_rows, sets, nodes, share):
    """The rows of the open bands without members that the sets show to be linked with no other of the band.

    Shingles that no other member of an open band has cannot be in an intersection. With c the other
    shingles of a member, an intersection holds at most the least c of the two, and a union at least
    what the smallest set of the band leaves; a member whose bound is below `share` drops out of
    the band. So heavily edited copies, which resemble their whole group but reach nobody, cost one
    row each and no pairs. Adds `common`, the share of c, by which the least edited member is found.
    """
    up, down = share

    def explode(batches):
        for batch in batches:
            for piece in pieces(batch, 1):
                line = np.frombuffer(b"".join(piece.column(1).to_pylist()), np.int64)
                counts = [len(x) // 8 for x in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(piece.column(0).to_numpy(), counts)), pa.array(line)], names=["node", "x"])

    alone = (sets.mapInArrow(explode, "node bigint, x bigint").groupBy("x")
             .agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("node")).filter("m = 1")
             .groupBy("node").agg(F.count(F.lit(1)).alias("alone")))
    known = materialize(sets.select("node").join(nodes.select("node", "n"), "node").join(alone, "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("c")))
    rows = materialize(open_rows.select("key", "node").join(known, "node"))
    bounds = materialize(rows.groupBy("key").agg(F.max("c").alias("most"), F.min("n").alias("least")))
    both = F.least("c", "most")
    return (rows.join(bounds, "key")
            .filter(F.lit(down) * both >= F.lit(up) * (F.col("n") + F.greatest("least", both) - both))
            .select("key", "node", (F.col("c") / F.col("n")).alias("common")))


def _picked(rows, wanted):
    """The rows whose doc_id and text hash are wanted, with the columns of `wanted`."""
    return (rows.withColumn("_mark", F.xxhash64("text"))
            .join(small(wanted, FETCH_ROWS), F.col("doc_id").eqNullSafe(F.col("lead")) & (F.col("_mark") == F.col("mark"))))


# ------------------------------------------------------------------------ components

def components(edges):
    """(node, comp) for the nodes of the edges (a, b): comp is the least node that can be reached.

    Each round takes the least label among the neighbours, then the label of that label, so the
    rounds grow with the logarithm of a component's width. Minima are combined before the shuffle;
    labels are written tables.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("comp")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        # a label is a node that has a label itself
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("beyond"))
        moved = materialize(lower.join(jump, "next").select(
            "node", "comp", F.least("next", "beyond").alias("to")))
        labels = moved.select("node", F.col("to").alias("comp"))
        if moved.filter("to != comp").isEmpty():
            return labels


# ------------------------------------------------------------------------- candidates

def _open_bands(bands, comps):
    """Rows of the bands whose members are in more than one component so far, with comp and members."""
    if comps is None:
        rows = bands.withColumn("comp", F.col("node"))
    else:
        rows = (bands.join(comps.withColumnRenamed("comp", "_c"), "node", "left")
                .withColumn("comp", F.coalesce("_c", "node")).drop("_c"))
    rows = materialize(rows)
    # written, so that a hot band can be split in the join
    keys = materialize(rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                               F.count(F.lit(1)).alias("members"))
                       .filter("lo != hi").select("key", "members"))
    return materialize(rows.join(keys, "key"))


def _pivot_pairs(rows, rank):
    """Each member of a band with the band's pivot, the first by `rank`, where they are not in one component.

    `rank` orders the members of all bands alike, so bands with the same members give the same pairs.
    """
    order = F.struct(rank.alias("r"), F.xxhash64("node").alias("h"), F.col("node").alias("pivot"),
                     F.col("comp").alias("home"))
    pivots = materialize(rows.groupBy("key").agg(F.min(order).alias("p")).select("key", "p.pivot", "p.home"))
    return (rows.join(pivots, "key").filter("comp != home")
            .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())


def _rest_links(rows, nodes, sets, table, share):
    """Links between members of a band that are in different components, enough to join what they join.

    A band is cut into blocks of about BLOCK members and each two blocks meet in one group, so no
    group is larger than two blocks. In a group, pairs from different components that outlive the
    Bayesian test are verified on the full sets, and a link that joins nothing new is not given: a
    group gives fewer links than it has members.
    """
    up, down = share
    cut = rows.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks").cast("bigint")).cast("int"))
    spread = (cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                      "block", "node", "comp"))
    spread = spread.join(nodes.select("node", "sig"), "node").join(sets, "node")

    def run(group):
        node, comp, block = (group.column(c).to_numpy() for c in ("node", "comp", "block"))
        one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
        sigs = _matrix(group.column("sig").to_pylist())
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        pairs = []
        for i in left:
            others = right[right > i] if one == two else right
            others = others[comp[others] != comp[i]]
            if len(others):
                good = others[survivors(np.broadcast_to(sigs[i], (len(others), HASHES)), sigs[others], table)]
                pairs.append(np.stack([np.full(len(good), i), good]))
        found = []
        if pairs:
            x, y = np.concatenate(pairs, axis=1)
            lines = [np.frombuffer(s, np.uint64) for s in group.column("s").to_pylist()]
            sizes = np.array([len(s) for s in lines])
            both = _intersections(lines, x, y)
            linked = down * both >= up * (sizes[x] + sizes[y] - both)
            found = _forest(x[linked].tolist(), y[linked].tolist(), comp.tolist())
        a, b = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        return pa.table({"a": np.minimum(node[a], node[b]), "b": np.maximum(node[a], node[b])})

    return spread.groupBy("key", "one", "two").applyInArrow(run, "a bigint, b bigint").distinct()


def _intersections(lines, x, y):
    """Sizes of the intersections of the sets x[i] and y[i], by products of 0/1 matrices, some shingles at a time."""
    _, place, counts = np.unique(np.concatenate(lines), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(lines)), [len(s) for s in lines])
    shared = counts[place] > 1
    place, owner = (np.cumsum(counts > 1) - 1)[place[shared]], owner[shared]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    both = np.zeros((len(lines), len(lines)), np.float32)        # exact, the counts are below 2 ** 24
    for begin in range(0, int(counts[counts > 1].size), CHUNK):
        lo, hi = np.searchsorted(place, [begin, begin + CHUNK])
        part = np.zeros((len(lines), CHUNK), np.float32)
        part[owner[lo:hi], place[lo:hi] - begin] = 1
        both += part @ part.T
    return both[x, y].astype(np.int64)


def _forest(x, y, comp):
    """The links (x[i], y[i]) that join two components, each joined before the next is looked at."""
    parent = {}

    def root(c):
        while parent.get(c, c) != c:
            parent[c] = parent.get(parent[c], parent[c])
            c = parent[c]
        return c

    found = []
    for i, j in zip(x, y):
        a, b = root(comp[i]), root(comp[j])
        if a != b:
            parent[b] = a
            found.append((i, j))
    return found


# --------------------------------------------------------------------------- operator

def near_duplicates(docs, size=5, share=(80, 100), text="text", doc_id="doc_id"):
    """Per row: doc_id, n_shingles, component_id and kept.

    Two rows are linked when their sets of `size`-word shingles are similar by `share` or more
    (80 of 100 unless given); component_id is the least doc_id that links lead to, kept says
    whether it is the row's own. Rows without words are linked with nothing and kept.

    Rows with equal sets are one node. Nodes that agree in a band of their signatures are candidates.
    The members of a band are compared with a pivot first, which joins large groups of copies by as
    many pairs as members. Bands whose members are still in different components lose the members
    that by their sets can reach nobody there, are compared with their least edited member, and
    then every two members left in different components are compared in blocks. So no link that a band shows
    is lost, and no group gives all its pairs. Pairs are pruned by the posterior of their similarity batch by
    batch and the rest verified on the full sets. A null doc_id is larger than any other: such rows
    have the id of the others of their component, null if there is none, and are kept only then.
    Rows with a repeated doc_id are separate rows. An empty table gives no rows.
    """
    up, down = share
    table = least_matches(up / down)
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    profile = materialize(per_text(
        rows.withColumn("mark", F.xxhash64("text")), "text", _profile(size),
        "n_shingles bigint, fp binary, sig binary", carry=["doc_id", "mark"], binary=True))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "mark"))    # nulls are last
    nodes = materialize(
        profile.filter("n_shingles > 0").groupBy("fp").agg(first.alias("at"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
        .select("fp", "sig", "n", F.col("at.doc_id").alias("lead"), F.col("at.mark").alias("mark"),
                F.monotonically_increasing_id().alias("node")))
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("sig", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(BANDS)])
    bands = nodes.select("node", F.explode(keys).alias("key"))
    shared = materialize(bands.groupBy("key").count().filter("count > 1").select("key"))
    bands = materialize(bands.join(shared, "key"))
    comps = _components_of(bands, nodes, rows, size, share, table)
    if comps is None:
        classes = nodes.select("fp", F.col("lead").alias("first"))
    else:
        named = comps.join(nodes.select("node", "lead"), "node")
        firsts = named.groupBy("comp").agg(F.min("lead").alias("first"))
        joined = materialize(comps.join(firsts, "comp").select("node", "first"))
        classes = nodes.select("node", "fp", "lead").join(joined, "node", "left").select(
            "fp", F.coalesce("first", "lead").alias("first"))
    classes = materialize(classes)
    plain = profile.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = (profile.filter("n_shingles > 0").select("doc_id", "n_shingles", "fp").join(classes, "fp")
              .select("doc_id", "n_shingles", F.col("first").alias("component_id")))
    return linked.unionByName(plain).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _components_of(bands, nodes, rows, size, share, table):
    """(node, comp) of the linked nodes, or None without links."""
    state = {"edges": None, "comps": None}

    def add(found):
        found = materialize(found)
        if not found.isEmpty():
            state["edges"] = found if state["edges"] is None else materialize(state["edges"].union(found))
            state["comps"] = components(state["edges"])

    def link(pairs, sets):
        pairs = materialize(pairs)
        if not pairs.isEmpty():
            add(_links(pairs, sets or _sets(_ends(pairs), nodes, rows, size), share))

    open_rows = _open_bands(bands, None)
    link(_prune(_pivot_pairs(open_rows, F.lit(0)), nodes, table), None)
    open_rows = _open_bands(bands, state["comps"])
    if open_rows.isEmpty():
        return state["comps"]
    sets = _sets(open_rows.select("node").distinct(), nodes, rows, size)
    likely = materialize(_likely(open_rows, sets, nodes, share))
    open_rows = _open_bands(likely, state["comps"])
    link(_prune(_pivot_pairs(open_rows, -F.col("common")), nodes, table), sets)
    open_rows = _open_bands(likely, state["comps"])
    add(_rest_links(open_rows, nodes, sets, table, share))
    return state["comps"]


def link_documents(docs):
    """Near-duplicates by three-word shingles at 85 of 100."""
    return near_duplicates(docs.select(column("doc_id"), column("text")), size=3, share=(85, 100))


def keep_one(docs):
    """The rows of `docs` that are the first of their group, by five-word shingles at 80 of 100.

    The columns stay. A row is known by its doc_id and its text, so a null or repeated id stands for
    as many documents as it has texts, and one of a group stays whatever its id: the one with the
    least id, null last, then the least text hash. Repeated rows are one document and stay together.
    """
    frame, place, back = neutral(docs)
    doc_id, text = F.col(place["doc_id"]), F.col(place["text"])
    keyed = frame.withColumn("row", F.struct(doc_id.isNull().alias("no"), doc_id.alias("doc_id"),
                                             F.xxhash64(text).alias("mark")))
    found = near_duplicates(keyed.select("row", text.alias("text")), doc_id="row")
    gone = materialize(found.filter("not kept").select(F.col("doc_id").alias("gone")).distinct())
    return keyed.join(small(gone, FETCH_ROWS), F.col("row").eqNullSafe(F.col("gone")), "left_anti").select(*back)
