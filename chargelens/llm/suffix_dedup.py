"""Repeated passages: two-stage suffix sorting of the places that can repeat.

Every string of `length` bytes has one anchor, the first of its GRAM-byte pieces with the least
hash. The starts of a text fall into runs with the same anchor; a run and the bytes its strings
cover is a context. Equal strings have equal anchors, so only contexts whose anchor occurs again
can hold a repeat. Equal contexts repeat as a whole; different contexts with the same anchor meet in
a block, whose suffixes are sorted in two stages.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import column, materialize, pieces, small

LENGTH = 200
GRAM = 32
PLACE_BITS = 28
SEGMENT = 1 << 20            # text bytes whose anchors are found at once
BLOCK_BYTES = 1 << 19        # context bytes of one suffix sort
MOST_CONTEXTS = 1_000        # different contexts of one key; a key with more is split by content
FETCH_ROWS = 1_000_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                0xFF51AFD7ED558CCD, 0xBF58476D1CE4E5B9], np.uint64)


# ------------------------------------------------------------------------- anchors

def _gram_hashes(data):
    """64-bit hash of the GRAM bytes at each place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * ODD[0]
    h ^= h >> np.uint64(32)
    width, step = 1, 1
    while width < GRAM:
        h = h[:-width] * ODD[step] + h[width:]
        width, step = 2 * width, step + 1
    h ^= h >> np.uint64(29)
    h *= ODD[0]
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(values, width):
    """Minimum of each `width` neighbours, by doubling."""
    low, have = values, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    return low


def anchors(data, begins, length=LENGTH):
    """(text number, anchor hash, first start, starts, anchor - first start) of each run of starts with one anchor.

    `data` (uint8) is texts of `length` bytes or more end to end, `begins` their first places; first
    starts are places in `data`.
    """
    h = _gram_hashes(data)
    high = ~np.uint64((1 << PLACE_BITS) - 1)
    # ties in the hash go to the first place, in every copy alike
    least = _sliding_min((h & high) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
    inside = np.ones(len(least), bool)
    for b in begins[1:]:
        inside[b - length + 1:b] = False         # strings that would reach into the next text
    start = np.flatnonzero(inside)
    place = (least[start] & ~high).astype(np.int64)
    new = np.flatnonzero((np.diff(place) != 0) | (np.diff(start) > 1)) + 1
    new = np.concatenate([[0], new])
    first = start[new]
    owner = np.searchsorted(begins, first, side="right") - 1
    return owner, h[place[new]], first, np.diff(np.append(new, len(place))), place[new] - first


def _parts(texts, length):
    """Lists of (text number, offset, bytes) with about SEGMENT bytes; a longer text is cut into segments.

    Segments overlap by what a string needs, so each start is in one of them.
    """
    group, size = [], 0
    for i, text in enumerate(texts):
        if text is None or len(text) < length:
            continue
        for at in range(0, len(text) - length + 1, SEGMENT):
            part = text if len(text) <= SEGMENT else text[at:at + SEGMENT + length - 1]
            group.append((i, at, part))
            size += len(part)
            if size >= SEGMENT:
                yield group
                group, size = [], 0
            if part is text:
                break
    if group:
        yield group


def _folded(h, c, first, n, a):
    """The runs with times: a stretch of equal contexts one after another, as in repeated lines, is one run."""
    new = np.flatnonzero(np.append(True, (np.diff(h) != 0) | (np.diff(c) != 0)))
    return h[new], c[new], first[new], n[new], a[new], np.diff(np.append(new, len(h)))


def _profile(length):
    """Batches (doc_id, text, n_bytes, sha) to packed arrays of anchors and context hashes, one row a text."""
    kinds = (np.uint64, np.uint64, np.uint32, np.uint16, np.uint16, np.uint32)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 1, SEGMENT):
                texts = piece.column(1).to_pylist()
                found = [[] for _ in texts]
                for group in _parts(texts, length):
                    data = b"".join(part for _, _, part in group)
                    begins = np.cumsum([0] + [len(part) for _, _, part in group])[:-1]
                    owner, h, first, n, a = anchors(np.frombuffer(data, np.uint8), begins, length)
                    c = np.fromiter((xxhash.xxh3_64_intdigest(data[s:e]) for s, e in
                                     zip(first.tolist(), (first + n + length - 1).tolist())), np.uint64, len(h))
                    cuts = np.searchsorted(owner, np.arange(len(group) + 1))
                    for (i, at, _), b, lo, hi in zip(group, begins.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                        found[i].append(_folded(h[lo:hi], c[lo:hi], first[lo:hi] - b + at, n[lo:hi], a[lo:hi]))
                packed = [[np.concatenate([f[k] for f in parts]).astype(kind).tobytes() if parts else None
                           for parts in found] for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), piece.column(3)] + [pa.array(p, pa.binary()) for p in packed],
                    names=["doc_id", "n_bytes", "sha", "h", "c", "lo", "n", "a", "times"])
    return run


def _unpack(batches):
    """Rows (uid, w, h, c, lo, n, a, times) of the packed arrays."""
    names = ["uid", "w", "h", "c", "lo", "n", "a", "times"]
    kinds = (np.int64, np.int64, np.uint32, np.uint16, np.uint16, np.uint32)
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            columns = [np.frombuffer(b"".join(part.column(i).to_pylist()), kind) for i, kind in enumerate(kinds, 2)]
            sizes = np.array([len(x) // 8 for x in part.column(2).to_pylist()], np.int64)    # 8 bytes a hash
            uid, w = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), sizes) for i in (0, 1))
            out = [uid, w, columns[0], columns[1], *(x.astype(np.int32) for x in columns[2:])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)


# -------------------------------------------------------------------- suffix sorting

def sort_suffixes(data, wanted, depth):
    """Ranks of the `wanted` suffixes of `data` (bytes), ordered by `depth` bytes at least.

    Two stages. A suffix is smaller than its successor if the next different byte is larger; those
    are sorted directly. All others are induced, bucket by bucket of their first byte c: such a
    suffix is r times c and then a suffix that begins with a smaller byte, whose rank is known, so
    (r, that rank) is its order in the bucket, ahead of the directly sorted ones.
    `wanted` marks places; further suffixes are ranked where the induction needs them. Ranks of
    suffixes that are not needed are -1.
    """
    data = data + b"\x00\x01"                # the last but one is smaller than its successor
    text = np.frombuffer(data, np.uint8)
    size = len(text)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, size)
    following = np.repeat(change, np.diff(np.append(0, change)))      # first place with another byte
    smaller = np.zeros(size, bool)
    inside = following < size
    smaller[inside] = text[following[inside]] > text[inside.nonzero()[0]]
    direct = np.flatnonzero(smaller)
    want = np.flatnonzero(wanted)
    until = direct[np.searchsorted(direct, want)]           # the induction of a suffix ends there at latest
    needed = np.cumsum(np.bincount(want, minlength=size) - np.bincount(until + 1, minlength=size)[:size]) > 0
    direct = direct[needed[direct]].tolist()
    direct.sort(key=lambda i: data[i:i + depth])
    direct = np.array(direct, np.int64)
    induced = np.flatnonzero(needed & ~smaller)
    induced = induced[np.argsort(text[induced], kind="stable")]
    rank = np.full(size, -1, np.int64)
    ends_direct = np.searchsorted(text[direct], np.arange(257))
    ends_induced = np.searchsorted(text[induced], np.arange(257))
    base = 0
    for c in range(256):
        bucket = induced[ends_induced[c]:ends_induced[c + 1]]
        if len(bucket):
            key = (following[bucket] - bucket) * np.int64(size) + np.where(
                following[bucket] < size, rank[np.minimum(following[bucket], size - 1)], 0)
            rank[bucket[np.argsort(key, kind="stable")]] = np.arange(base, base + len(bucket))
            base += len(bucket)
        bucket = direct[ends_direct[c]:ends_direct[c + 1]]
        rank[bucket] = np.arange(base, base + len(bucket))
        base += len(bucket)
    return rank[:-2]


def common_prefixes(data, left, right, limit):
    """Whether the suffixes at `left` and `right` share `limit` bytes, compared eight at a time."""
    words = np.ndarray(shape=(len(data) - 7,), dtype=np.uint64, buffer=data, strides=(1,))
    alive = np.arange(len(left))
    for at in [*range(0, limit - 7, 8), *([limit - 8] if limit % 8 else [])]:
        alive = alive[words[left[alive] + at] == words[right[alive] + at]]
    equal = np.zeros(len(left), bool)
    equal[alive] = True
    return equal


def repeated_starts(contexts, counts, length):
    """For each context (bytes) with counts[i] starts: which of its starts repeat in any of them."""
    data = b"".join(contexts)
    begins = np.cumsum([0] + [len(c) for c in contexts])[:-1]
    starts = np.concatenate([np.arange(b, b + n) for b, n in zip(begins.tolist(), counts)])
    wanted = np.zeros(len(data) + 2, bool)
    wanted[starts] = True
    rank = sort_suffixes(data, wanted, length)
    order = starts[np.argsort(rank[starts], kind="stable")]
    same = common_prefixes(data, order[:-1], order[1:], length)
    twice = np.zeros(len(data), bool)
    twice[order[:-1][same]] = True
    twice[order[1:][same]] = True
    return [twice[b:b + n] for b, n in zip(begins.tolist(), counts)]


def _runs(flags):
    """[(start, end)] of the stretches that are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def _sort_blocks(length):
    """Batches sorted by key to rows (h, c, s0, s1): the repeated starts of contexts not known to repeat."""
    def finish(rows):
        unique, contexts, counts = {}, [], []
        for key, h, c, off, known, n, text in rows:
            if (key, text) not in unique:
                unique[key, text] = len(contexts)
                contexts.append(text)
                counts.append(n)
        found = [(h, c, off, known, unique[key, text]) for key, h, c, off, known, n, text in rows]
        flags = [_runs(f) for f in repeated_starts(contexts, counts, length)]
        return [(h, c, off + s, off + e) for h, c, off, known, i in found if not known for s, e in flags[i]]

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if size >= BLOCK_BYTES and row[0] != rows[-1][0]:
                    out += finish(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[6])
            if out:
                yield _ranges(out)
        if rows:
            yield _ranges(finish(rows))
    return run


def _ranges(rows):
    h, c, start, end = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(start, pa.int32()),
                                       pa.array(end, pa.int32())], names=["h", "c", "s0", "s1"])


RANGES = "h bigint, c bigint, s0 int, s1 int"
ITEM = "key bigint, h bigint, c bigint, off int, known boolean, n int, text binary, a int, p int, q int"


# ------------------------------------------------------------------------ Spark side

def _cut_contexts(length):
    """Batches (text, uid, list of contexts) to items."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                rows = []
                for text, wanted in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    for x in wanted:
                        rows.append((x["h"], x["h"], x["c"], 0, x["known"], x["n"],
                                     text[x["lo"]:x["lo"] + x["n"] + length - 1], x["a"], length - GRAM, 0))
                yield _items(rows)
    return run


def _items(rows):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.int32(),
             pa.int32(), pa.int32())
    columns = zip(*rows) if rows else [[]] * 10
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["key", "h", "c", "off", "known", "n", "text", "a", "p", "q"])


def _halves(length):
    """Items of hot keys to items of two keys each, by the bytes that all strings of a half hold.

    The strings of an item start p to q bytes ahead of the anchor at most; those of a half from p to
    q all hold the bytes from anchor - q to anchor - p + length, with p and q of that half.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for key, h, c, off, known, n, text, a, most, least in zip(*(x.to_pylist() for x in batch.columns)):
                middle = (most + least) // 2
                for p, q in ((most, middle + 1), (middle, least)):      # strings that start q to p ahead
                    lo, hi = max(a - p, 0), min(a - q, n - 1)
                    if lo > hi or p < q:
                        continue
                    part = text[lo:hi + length]
                    shared = text[a - q:a - p + length]
                    rows.append((xxhash.xxh3_64_intdigest(shared, key & 0xFFFFFFFF) - (1 << 63) ^ p, h, c, off + lo,
                                 known, hi - lo + 1, part, a - lo, p, q))
            yield _items(rows)
    return run


def _split_hot(items, length):
    """(items of keys with few contexts, ranges settled on the way): hot keys are split until none is left."""
    settled = None
    done = None
    while True:
        sizes = items.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
        hot = materialize(sizes.filter(F.col("m") > MOST_CONTEXTS).select("key"))
        if hot.isEmpty():
            return items if done is None else done.unionByName(items), settled
        rest = items.join(hot, "key", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        halves = materialize(items.join(hot, "key", "left_semi").select(*items.columns).mapInArrow(_halves(length), ITEM))
        same = halves.withColumn("_t", F.xxhash64("text"))
        groups = materialize(same.groupBy("key", "_t", "n").agg(
            F.count(F.lit(1)).alias("m"), F.max("known").alias("k"), F.min(F.struct("h", "c", "off")).alias("one")))
        marked = same.join(groups, ["key", "_t", "n"])
        found = marked.filter("m > 1 and not known").select(
            "h", "c", F.col("off").alias("s0"), (F.col("off") + F.col("n")).alias("s1"))
        settled = found if settled is None else settled.unionByName(found)
        # one of equal items stays, as what others are compared with; items alone under their key are done
        items = materialize(
            marked.filter((F.col("one.h") == F.col("h")) & (F.col("one.c") == F.col("c")) & (F.col("one.off") == F.col("off")))
            .withColumn("known", F.col("known") | (F.col("m") > 1)).select(*items.columns))
        several = items.groupBy("key").count().filter("count > 1").select("key")
        items = items.join(several, "key", "left_semi").select(*items.columns)


def _with_text(rows, wanted, columns):
    """Rows of the documents whose (sha, doc_id) is wanted, joined to `wanted`.

    When few are wanted they are broadcast first, so only their texts are shuffled. One of a group
    of copies is wanted at most, so no hash is hot.
    """
    def same(frame):
        return (F.col("sha") == frame["_sha"]) & F.col("doc_id").eqNullSafe(frame["_of"])

    wanted = wanted.withColumnsRenamed({"sha": "_sha", "of": "_of"})
    few = small(materialize(wanted.select("_sha", "_of").distinct()), FETCH_ROWS)
    return rows.join(few, same(few), "left_semi").join(wanted, same(wanted)).select(*columns)


def repeats(docs, length=LENGTH, text="text", doc_id="doc_id", keep_text=False):
    """Per row: doc_id, n_bytes, spans (start, end) of the bytes to remove, kept_sha256 (and kept).

    A byte goes if it is in a string of `length` bytes (64 or more) that starts at another place of any
    text too, the same one included; strings are judged on the input. `kept_sha256` is the hash of the other
    bytes joined up; with `keep_text` they are returned too. Null texts are empty; shorter texts keep all.
    Repeated rows are copies of each other and go whole. Spans are those of the UTF-8 bytes.

    Equal texts are counted first and stand for one text from then on, so groups of copies cost one
    row. Anchors are counted by hash with combining before the shuffle; contexts are compared by a
    64-bit hash under their 64-bit anchor, and the different ones by suffix sorting in blocks of bounded
    size. A key with more than MOST_CONTEXTS different contexts is split by the bytes its strings share,
    as often as it takes.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    rows = docs.select(column(doc_id).alias("doc_id"), F.coalesce(column(text), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("text", 256)))
    profile = materialize(
        rows.select("doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes"), "sha")
        .mapInArrow(_profile(length), f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes bigint, sha binary, h binary, "
                                      "c binary, lo binary, n binary, a binary, times binary")
        .withColumn("uid", F.monotonically_increasing_id()))
    long = profile.filter(F.col("n_bytes") >= length)
    copies = materialize(long.groupBy("sha").agg(F.count(F.lit(1)).alias("m"), F.min("uid").alias("one"))
                         .filter("m > 1").select("sha", "one"))
    packed = (long.join(small(copies, FETCH_ROWS), "sha", "left").filter("one is null or one = uid")
              .select("uid", F.when(F.col("one").isNull(), 1).otherwise(2).alias("w"), "h", "c", "lo", "n", "a", "times"))
    seen = packed.mapInArrow(_unpack, "uid bigint, w int, h bigint, c bigint, lo int, n int, a int, times int")
    often = F.sum(F.col("w") * F.col("times"))
    again = materialize(          # written, so that a hot anchor can be split in the join
        seen.groupBy("h").agg(often.alias("m"), F.min("c").alias("c0"), F.max("c").alias("c1"))
        .filter("m > 1").select("h", (F.col("c0") != F.col("c1")).alias("mixed")))
    found = materialize(seen.join(again, "h"))
    groups = materialize(found.groupBy("h", "c").agg(
        often.alias("m"), F.max("mixed").alias("mixed"), F.min(F.struct("uid", "lo", "n", "a")).alias("one")))
    # all starts of such a context, as often as it is repeated in a run
    whole = groups.filter("m > 1").select("h", "c", F.lit(0).alias("s0"), F.lit(None).cast("int").alias("s1"))

    of = profile.select("uid", "sha", F.col("doc_id").alias("of"))
    lists = (groups.filter("mixed").groupBy(F.col("one.uid").alias("uid")).agg(F.collect_list(
        F.struct("h", "c", "one.lo", "one.n", "one.a", (F.col("m") > 1).alias("known"))).alias("wanted")))
    lists = materialize(lists.join(of, "uid").select("sha", "of", "wanted"))
    items = materialize(_with_text(rows, lists, ["text", "wanted"]).mapInArrow(_cut_contexts(length), ITEM))
    items, settled = _split_hot(items, length)
    blocks = (items.select("key", "h", "c", "off", "known", "n", "text").repartition("key")
              .sortWithinPartitions("key", "h", "c"))
    ranges = whole.unionByName(blocks.mapInArrow(_sort_blocks(length), RANGES))
    if settled is not None:
        ranges = ranges.unionByName(settled)
    ranges = materialize(ranges)
    spans = (found.filter("w = 1").select("uid", "h", "c", "lo", (F.col("n") * F.col("times")).alias("all"))
             .join(ranges, ["h", "c"]).withColumn("s1", F.coalesce("s1", "all"))
             .groupBy("uid").agg(F.collect_list(F.struct((F.col("lo") + F.col("s0")).alias("s"),
                                                         (F.col("lo") + F.col("s1")).alias("e"))).alias("starts")))
    spans = materialize(spans.join(of, "uid").select("sha", "of", "starts"))
    part = materialize(_with_text(rows, spans, ["sha", "text", "starts"])
                       .mapInArrow(_remove(length, keep_text), PART + (", kept binary" if keep_text else "")))
    nothing = hashlib.sha256().hexdigest()
    gone = copies.join(long.select(F.col("uid").alias("one"), "n_bytes"), "one").select(
        "sha", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end"))).alias("spans"),
        F.lit(nothing).alias("cut_sha"), *([F.lit(b"").alias("kept")] if keep_text else []))
    results = materialize(gone.unionByName(part)).withColumnRenamed("sha", "_sha")
    joined = profile.select("doc_id", "n_bytes", "sha").join(results, F.col("sha") == F.col("_sha"), "left")
    joined = joined.select("doc_id", "n_bytes", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
                           F.coalesce("cut_sha", F.lower(F.hex("sha"))).alias("kept_sha256"),
                           *(["sha", "kept"] if keep_text else []))
    if keep_text:
        whole_texts = rows.groupBy("sha").agg(F.first("text").alias("whole")).withColumnRenamed("sha", "_sha")
        joined = (joined.join(whole_texts, F.col("sha") == F.col("_sha"))
                  .withColumn("kept", F.coalesce("kept", "whole")).drop("sha", "_sha", "whole"))
    return joined


SPANS = "array<struct<start:bigint,end:bigint>>"
PART = f"sha binary, spans {SPANS}, cut_sha string"


def _remove(length, keep_text):
    """Batches (sha, text, starts) to the spans that the strings at those starts cover and what is left."""
    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for piece in pieces(batch, 1):
                spans, hashes, kept = [], [], []
                for text, starts in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                    merged = []
                    for s, e in sorted((x["s"], x["e"]) for x in starts):
                        if merged and s <= merged[-1]["end"]:
                            merged[-1]["end"] = max(merged[-1]["end"], e + length - 1)
                        else:
                            merged.append({"start": s, "end": e + length - 1})
                    edges = [0] + [x for m in merged for x in (m["start"], m["end"])] + [len(text)]
                    left = b"".join(text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                    spans.append(merged)
                    hashes.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
                columns = [piece.column(0), pa.array(spans, kind), pa.array(hashes, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary())] if keep_text else []),
                                                 names=["sha", "spans", "cut_sha"] + ["kept"] * keep_text)
    return run


def repeat_documents(docs):
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for strings of 200 bytes."""
    found = repeats(docs.select(column("doc_id"), column("text")))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")
