"""Language identification: multinomial naive Bayes over hashed character n-grams."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import column, per_text, pieces

BUCKETS = 1 << 15
SIZES = (1, 2, 3)            # characters of an n-gram
SMOOTHING = 0.5
TRAIN_ROWS = 20_000          # about as many labelled rows per language are learned from, at most
POSITIONS = 1 << 20          # score cells held at once while scoring
UNKNOWN = "und"
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def has_letter(text):
    return any(map(str.isalpha, text)) if text else False


def _points(texts):
    """Code points of the lower-cased texts, each between two spaces, and the starts of the texts."""
    padded = [f" {t.lower()} " for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in padded], dtype=np.int64)])
    raw = "".join(padded).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, dtype=np.uint32), starts


def _hashes(points, size):
    """Bucket of the n-gram of `size` characters that begins at each place."""
    n = len(points) - size + 1
    code = np.full(max(n, 0), size * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
    for i in range(size):
        code ^= points[i:i + n]
        code *= np.uint32(MULTIPLIERS[i])
        code ^= code >> np.uint32(15)
    return code & np.uint32(BUCKETS - 1)


def _grams(points, starts, size):
    """Buckets of all n-grams that lie inside one text, and how many each text has."""
    counts = np.maximum(np.diff(starts) - size + 1, 0)
    codes = _hashes(points, size)
    inside = np.ones(len(codes), dtype=bool)
    for back in range(1, size):               # n-grams that would reach into the next text
        inside[starts[1:-1] - back] = False
    return codes[inside], counts


def train(df, text="text", label="lang", key="doc_id", rows=TRAIN_ROWS):
    """Model from the rows of `df` with a text and a label, or None if there are none.

    At most about `rows` rows of each label are used, drawn by a hash of `key` and text, so that rows
    which share a key are not drawn as one; this bounds the fit, nothing else. The counts are summed by Spark per (label, bucket): that many numbers, not
    the rows, reach the driver. The labels are the languages, so they are taken to be few.
    """
    known = df.filter(column(text).isNotNull() & column(label).isNotNull()).select(
        column(key).cast("string").alias("key"), column(text).alias("text"), column(label).alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64(F.coalesce("key", F.lit("")), "text", F.lit("train")), F.lit(1_000_000))
    share = F.coalesce(*[F.when(F.col("label") == lang, F.lit(int(1_000_000 * min(1.0, rows / n))))
                         for lang, n in sizes.items()])
    known = known.filter(draw < share)

    def count(batches):
        totals = {}
        for batch in batches:
            for piece in pieces(batch, 0):
                by = {}
                for t, lang in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    by.setdefault(lang, []).append(t)
                for lang, texts in by.items():
                    points, starts = _points(texts)
                    total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    for size in SIZES:
                        total += np.bincount(_grams(points, starts, size)[0], minlength=BUCKETS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["label", "bucket", "n"])

    cells = (known.select("text", "label").mapInArrow(count, "label string, bucket int, n bigint")
             .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas())
    labels = sorted(sizes)
    counts = np.full((len(labels), BUCKETS), SMOOTHING)
    place = {x: i for i, x in enumerate(labels)}
    counts[cells["label"].map(place).to_numpy(np.int64), cells["bucket"].to_numpy()] += cells["n"].to_numpy()
    weights = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    prior = np.log(np.array([sizes[x] for x in labels], dtype=float) / sum(sizes.values()))
    return {"labels": labels, "weights": np.ascontiguousarray(weights.T.astype(np.float32)), "prior": prior}


def _likelihoods(texts, model):
    """Log likelihood of each text under each language, with the prior."""
    weights, prior = model["weights"], model["prior"]
    points, starts = _points(texts)
    total = np.tile(prior, (len(texts), 1))
    step = max(1, POSITIONS // len(prior))
    for size in SIZES:
        codes, counts = _grams(points, starts, size)
        ends = np.cumsum(counts)
        for lo in range(0, len(codes), step):
            part = weights[codes[lo:lo + step]]
            hi = lo + len(part)
            first, last = np.searchsorted(ends, [lo, hi - 1], side="right")
            edges = np.maximum(np.concatenate([[0], ends])[first:last + 1], lo) - lo
            some = np.flatnonzero(np.diff(np.append(edges, hi - lo)) > 0)
            total[first + some] += np.add.reduceat(part, edges[some], axis=0, dtype=np.float64)
    return total


def predict(df, model, text="text", carry=None):
    """Carried columns plus lang_pred and score, the posterior of the predicted language.

    The matrix of log probabilities (buckets x languages) is broadcast, texts are scored in batches
    of whole texts. A null text, a text without a letter, and every text without a model get "und"
    and score 0. Equal posteriors go to the first label in order. Repeated rows are scored alike.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(texts):
        model = shared.value
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if model and has_letter(t)]
        if at:
            total = _likelihoods([texts[i] for i in at], model)
            best = total.argmax(axis=1)
            top = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            for i, b, s in zip(at, best.tolist(), top.tolist()):
                labels[i], scores[i] = model["labels"][b], s if math.isfinite(s) else 0.0
        return labels, scores

    return per_text(df, text, score, "lang_pred string, score double", carry)


def identify_documents(docs):
    """Learned where crc32(doc_id as text) mod 4 is not 2, predicted for every document.

    Returns doc_id, held_out, lang_pred and score. A null doc_id counts as held out.
    """
    held = F.coalesce(F.pmod(F.crc32(column("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))
    rows = docs.select(column("doc_id"), column("text"), column("lang"))
    model = train(rows.filter(~held))
    return predict(rows.select("doc_id", held.alias("held_out"), "text"), model, carry=["doc_id", "held_out"])
