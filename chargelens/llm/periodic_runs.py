"""Periodic runs of words, found online by a sparse dynamic program over lags."""

from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import functions as F

from .common import column, free_name, per_text

LEAST, TIMES = 6, 4     # a run has LEAST words and TIMES periods at least
GRAM = 5                # words that an earlier occurrence has in common at least


def word_numbers(words):
    """One number a word, equal for equal words."""
    known = {}
    return [known.setdefault(w, len(known)) for w in words]


def _places(line):
    """Places in the order of the GRAM words that end there, the rank of each, and the first rank of its equals."""
    n = len(line)
    key = np.zeros(n, dtype=np.uint64)
    for back in range(GRAM):
        key[GRAM - 1:] = key[GRAM - 1:] * np.uint64(0x9E3779B97F4A7C15) + line[GRAM - 1 - back:n - back].astype(np.uint64)
    key[:GRAM - 1] = np.arange(GRAM - 1, dtype=np.uint64) | np.uint64(1 << 63)      # too early for a gram
    order = np.argsort(key, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return order.tolist(), rank.tolist(), first[rank].tolist()


def runs(words, least=LEAST, times=TIMES):
    """Maximal runs (start, length, period) by start, then period.

    A run is a stretch whose smallest period is `period`, of max(least, times * period) words or
    more, that no neighbouring word extends. `least` and `times` may not be below LEAST and TIMES.

    Words are read once. A lag is active while words are equal to those so many places before; its
    match length grows by one a word. At the first difference, or at the end, the lag gives a run if
    the stretch is long enough and no active divisor of the lag covers it, which would be a smaller
    period. Earlier occurrences of a word make lags active. To keep the table sparse, lags of
    2^k to 2^(k+1) - 1 are looked up at every 2^k-th word only, and become active if the 2^(k+1)
    words (GRAM at least) that end there are equal to those at the lag: a run of four periods
    matches over three, so it cannot miss all of these places. A lag that is a multiple of an
    active one whose stretch reaches back to the earlier occurrence has no run of its own. So
    squares alone are followed, few a place, also in texts of one word or of two.
    """
    if least < LEAST or times < TIMES:
        raise ValueError(f"least and times may not be below {LEAST} and {TIMES}")
    n, longest = len(words), len(words) // times
    if n < least:
        return []
    ids = word_numbers(words)
    line = np.array(ids, dtype=np.int32)
    order, rank, first = _places(line)
    repeated = [i for i in range(n) if first[i] < rank[i]]
    if not repeated:
        return []
    raw, size = line.tobytes(), line.itemsize
    active, found = {}, []              # lag -> words equal to those so many places before

    def close(ended, stop):
        for lag in ended:
            stretch = active[lag] + lag
            if stretch >= max(least, times * lag) and not any(
                    lag % q == 0 and q < lag and length >= stretch - q for q, length in active.items()):
                found.append((stop - stretch, stretch, lag))

    def admit(i):
        last = (i & -i).bit_length() - 1
        for k in range(min(last, longest.bit_length() - 1) + 1):
            low, high = 1 << k, min((2 << k) - 1, longest)
            if any(q <= GRAM and high < length + q for q, length in active.items()):
                continue                # GRAM words of a period of GRAM or less come again at its multiples only
            begin = bisect_left(order, i - high, first[i], rank[i])
            stop = bisect_right(order, i - low, begin, rank[i])
            if begin == stop:
                continue
            lags = i - np.array(order[begin:stop])
            for q, length in active.items():
                lags = lags[(lags % q != 0) | (lags > length + q - 1)]
            context = max(GRAM, 2 << k)
            for lag in lags[::-1].tolist():
                start, end = i + 1 - context, i + 1
                if start < lag or raw[start * size:end * size] != raw[(start - lag) * size:(end - lag) * size]:
                    continue
                if any(lag % q == 0 and lag <= length + q - 1 for q, length in active.items()):
                    continue
                while start > lag and ids[start - 1] == ids[start - 1 - lag]:
                    start -= 1
                active[lag] = end - start

    at, i = 0, 0
    while i < n:
        if not active:                  # on to the next word whose GRAM words were seen before
            while at < len(repeated) and repeated[at] < i:
                at += 1
            if at == len(repeated):
                break
            i = repeated[at]
        else:
            word = ids[i]
            ended = [lag for lag in active if ids[i - lag] != word]
            if ended:
                close(ended, i)
                for lag in ended:
                    del active[lag]
            for lag in active:
                active[lag] += 1
        if first[i] < rank[i]:
            admit(i)
        i += 1
    close(list(active), n)
    return sorted((s, e, q) for s, e, q in found)


def kept_words(words, found):
    """The words that are in no run, or in the first period of every run that holds them."""
    edges = [0] * (len(words) + 1)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept, depth = [], 0
    for word, edge in zip(words, edges):
        depth += edge
        if not depth:
            kept.append(word)
    return kept


def find_runs(df, text="text", carry=None, least=LEAST, times=TIMES):
    """Carried columns plus runs (start, length, period), by start, then period, and collapsed.

    Words are stretches without the six ASCII blanks; places are word numbers from 0. `collapsed`
    is the text's words without those that a run repeats, joined by single blanks. Texts are read
    whole, one row at a time, in time that grows little faster than the text whatever its words. A
    null text is empty and, like texts of fewer than `least` words, has no run. Repeated rows are
    read alike, an empty table gives an empty one, and carried columns that clash with a result
    give way to it.
    """
    def each(texts):
        listed, collapsed = [], []
        for t in texts:
            words = t.split() if t else []      # bytes: split at the six ASCII blanks alone
            found = runs(words, least, times)
            listed.append([{"start": s, "length": e, "period": q} for s, e, q in found])
            collapsed.append(b" ".join(kept_words(words, found) if found else words).decode())
        return listed, collapsed

    return per_text(df, text, each, "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
                    carry, binary=True)


def planted(docs, text, key):
    """The frame with `text` made periodic from some word on in the rows whose crc32 of `key` ends in 0.

    With h the crc32 of the key as text, g = h div 10 and n words: words from a = g mod n on repeat
    with period 1 + (n - a) div (3 + g mod 8). Rows with a null key or no words stay as they are.
    """
    h, name = F.crc32(column(key).cast("string").cast("binary")), free_name("_w", docs.columns)
    words = F.filter(F.split(column(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = (h % 10 == 0) & column(text).rlike(r"[^\x20\x09-\x0D]")
    n, g = F.size(name), F.floor(h / 10)
    start = (g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    times = F.ceil((n - start) / period).cast("int")
    changed = F.concat(F.slice(name, F.lit(1), start),
                       F.slice(F.flatten(F.array_repeat(F.slice(name, start + 1, period), times)), F.lit(1), n - start))
    return (docs.withColumn(name, F.when(chosen, words))
            .withColumn(text, F.when(F.col(name).isNull(), column(text)).otherwise(F.array_join(changed, " ")))
            .drop(name))


def run_documents(docs):
    """The runs of every document, some of them made periodic, as counts, the longest run and digests."""
    rows = planted(docs.select(column("doc_id"), column("text").cast("string").alias("text")), "text", "doc_id")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                               r["period"].cast("string")), F.lit("\n")))
    return (find_runs(rows, "text", ["doc_id"]).withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    (-F.col("best.length")).alias("length"), F.col("best.period").alias("period"),
                    F.expr("(-1000 * best.length) div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def oracle_sql():
    """The same in DuckDB: every lag of every document by a self-join, its islands, and no shorter period over one."""
    return r"""
WITH eighth AS (
  SELECT range AS byte, list_reduce([range::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS crc FROM range(256)),
crc_table AS (SELECT list(crc ORDER BY byte) AS t FROM eighth),
docs AS (
  SELECT row_number() OVER () AS k, doc_id,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) AS h
  FROM documents, crc_table),
placed AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM docs),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM placed),
timed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
lines AS (
  SELECT k, doc_id, n, CASE WHEN a IS NULL THEN w
         ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w
  FROM timed),
words AS (SELECT k, n, unnest(range(n)) AS i, unnest(w) AS word FROM lines),
same AS (SELECT x.k, x.i, x.i - y.i AS q FROM words x JOIN words y ON x.k = y.k AND x.word = y.word
         WHERE y.i < x.i AND 4 * (x.i - y.i) <= x.n),
islands AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM same),
stretches AS (SELECT k, q, min(i) - q AS start, count(*) + q AS length FROM islands GROUP BY k, q, island
              HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM stretches x WHERE NOT EXISTS (
           SELECT 1 FROM stretches y WHERE y.k = x.k AND y.q < x.q AND y.start <= x.start
           AND y.start + y.length >= x.start + x.length)),
listed AS (
  SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs,
         arg_min({'start': start, 'length': length, 'q': q}, (-length, start, q)) AS best FROM runs GROUP BY k),
dropped AS (SELECT DISTINCT k, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS line FROM words ANTI JOIN dropped USING (k, i) GROUP BY k)
SELECT l.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
       best.q::BIGINT AS period, (1000 * best.length // best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(r.runs, '')) AS runs_sha256, sha256(coalesce(line, '')) AS collapsed_sha256
FROM lines l LEFT JOIN listed r USING (k) LEFT JOIN kept USING (k)"""
