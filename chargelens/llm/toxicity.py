"""Toxic passages: maximal-scoring segments over token log-odds, judged by extreme-value statistics."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import column, materialize, neutral, per_text, pieces, small

TRAIN_ROWS = 30_000          # about as many labelled rows are learned from, at most
MARKS_ROWS = 1_000_000       # labels up to so many are broadcast; more are joined by shuffle, with the drawn rows only
PRIOR_SHARE = 0.05           # weight of the Dirichlet prior, as a share of all counts
LEAST_Z = 4.0                # tokens below keep no score of their own
MOST_TOKENS = 200_000        # tokens of the fitted model, those with the highest |z|
MOST_SCORE = 8.0             # nats a single token can add or take
DRIFT = 0.5                  # nats that a token without a score takes
SIGNIFICANT = 0.05           # expected chance passages per document, at most, in a reported one
STEPS = 50

#: ASCII letters in lower case, other ASCII characters as blanks; bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def tokens_of(text):
    return text.translate(FOLD).split()


# ------------------------------------------------------------------------- segments

def segments(scored, length, drift=DRIFT):
    """All maximal scoring segments (start, end, score) of a text, by one linear scan.

    `scored` lists (place, score) of the tokens that have a score, in order; each of the other
    tokens up to `length` scores -drift. A candidate keeps the sums before and after it; a new one
    is merged with the candidates back to the last one that starts lower, as long as it ends higher.
    """
    found = []          # (start, end, sum before, sum after, candidate that starts lower before it)
    total, seen = 0.0, 0
    for place, score in scored:
        total -= drift * (place - seen)
        seen = place + 1
        if score <= 0:
            total += score
            continue
        start, low, high = place, total, total + score
        total = high
        back = len(found) - 1
        while True:
            while back >= 0 and found[back][2] >= low:
                back = found[back][4]
            if back < 0 or found[back][3] >= high:
                break
            start, low = found[back][0], found[back][2]     # merge with all candidates from there on
            del found[back:]
            back = len(found) - 1
        found.append((start, place + 1, low, high, back))
    return [(s, e, high - low) for s, e, low, high, _ in found]


# ------------------------------------------------------------------------- learning

def scale_of(scores, shares, drift=DRIFT):
    """The positive root of sum(share * exp(root * score)) = 1, with the rest of the mass at -drift."""
    rest = max(0.0, 1.0 - shares.sum())
    mean = float((scores * shares).sum() - rest * drift)
    if not len(scores) or scores.max() <= 0 or mean >= 0:
        return 1.0
    grow = lambda x: float((shares * np.exp(x * scores)).sum() + rest * math.exp(-x * drift))
    low, high = 0.0, 1e-3
    while grow(high) < 1 and high < 50:
        low, high = high, high * 2
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if grow(middle) < 1 else (low, middle)
    return high


def _evidence(model, text):
    """(evidence, tokens, passages) of one text: nats by which its passages beat chance.

    A passage of score S among n tokens is expected K * n * exp(-scale * S) times by chance.
    Passages expected less than once are summed up; without one, the best of the text counts.
    """
    tokens = tokens_of(text) if text else []
    if not tokens:
        return None, 0, []
    table = model["scores"]
    scored = [(i, table[t]) for i, t in enumerate(tokens) if t in table]
    level = math.log(model["k"] * len(tokens))
    found = [(s, e, score, model["scale"] * score - level) for s, e, score in segments(scored, len(tokens))]
    if not found:
        return -level, len(tokens), []
    strong = [f for f in found if f[3] > 0]
    evidence = sum(f[3] for f in strong) if strong else max(f[3] for f in found)
    return evidence, len(tokens), [f for f in strong if f[3] >= -math.log(SIGNIFICANT)]


def _logistic(x, y):
    """(intercept, slope) of a slightly damped logistic fit."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    a, b = 0.0, 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(y - p).sum() - 1e-3 * a, ((y - p) * x).sum() - 1e-3 * b])
        hessian = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs, labels, rows=TRAIN_ROWS):
    """Model from the labelled documents, or None unless both labels occur.

    `docs` has doc_id and text, `labels` doc_id and toxic (0 or 1; null rows are left out, of
    several labels of a document the highest counts). About `rows` labelled rows are used at most,
    however many rows share an id: the labelled rows are counted, and drawn by a hash of doc_id and
    text. Equal texts count once, so a group of copies carries one vote. Spark counts the texts that
    hold a token; tokens with a clear log-odds reach the driver, at most MOST_TOKENS.
    """
    marks = materialize(labels.filter(column("doc_id").isNotNull() & column("toxic").isNotNull())
                        .groupBy(column("doc_id").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    marks = small(marks, MARKS_ROWS)
    named = docs.select(column("doc_id").alias("doc_id"), column("text").cast("binary").alias("text")).filter(F.col("text").isNotNull())
    share = min(1.0, rows / max(named.select("doc_id").join(marks, "doc_id").count(), 1))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("train")), F.lit(1_000_000)) < int(1_000_000 * share)
    rows_of = materialize(
        named.filter(draw).join(marks, "doc_id")
        .groupBy(F.sha2("text", 256).alias("_same")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
        .select("toxic", "text"))
    if rows_of.select("toxic").distinct().count() < 2:
        return None

    def count(batches):
        counters = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counters[bool(toxic)].update(set(tokens_of(text)))       # once a text: long ones don't outvote
        names = list(counters[0] | counters[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([counters[0][n] for n in names], pa.int64()),
             pa.array([counters[1][n] for n in names], pa.int64())], names=["token", "clean", "toxic"])

    table = materialize(rows_of.select("toxic", "text")
                        .mapInArrow(count, "token binary, clean bigint, toxic bigint")
                        .groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    sums = table.agg(F.sum("clean"), F.sum("toxic")).first()
    if not sums[0] or not sums[1]:
        return None
    clean, toxic = float(sums[0]), float(sums[1])
    # log-odds with a Dirichlet prior spread like all counts; z = delta / deviation
    prior = F.lit(PRIOR_SHARE) * (F.col("clean") + F.col("toxic"))

    def odds(name, total):
        mass = F.col(name) + prior
        return F.log(mass) - F.log(F.lit(total + PRIOR_SHARE * (clean + toxic)) - mass)

    delta = odds("toxic", toxic) - odds("clean", clean)
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    clear = (table.withColumn("delta", delta).withColumn("z", F.col("delta") / spread)
             .filter(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "token").limit(MOST_TOKENS).toPandas())
    scores = np.clip(clear["delta"].to_numpy(float), -MOST_SCORE, MOST_SCORE)
    scale = scale_of(scores, clear["clean"].to_numpy(float) / clean)
    model = {"scores": dict(zip((bytes(t) for t in clear["token"]), scores.tolist())), "scale": scale, "k": 1.0}
    return _calibrate(model, rows_of)


def _calibrate(model, rows):
    """Set k by the best segments of clean texts, then the logistic curve by the evidence of all."""
    def best(batches):
        for batch in batches:
            for piece in pieces(batch, 1):
                kept = []
                for toxic, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    evidence, n, _ = _evidence(model, text)
                    if n:
                        tops = segments([(i, model["scores"][t]) for i, t in enumerate(tokens_of(text))
                                         if t in model["scores"]], n)
                        kept.append((int(toxic), n, max((s for _, _, s in tops), default=0.0), evidence))
                columns = list(zip(*kept)) if kept else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.float64(), pa.float64()))],
                    names=["toxic", "n", "best", "evidence"])

    kind = "toxic int, n bigint, best double, evidence double"
    clean = rows.filter("toxic = 0").mapInArrow(best, kind).agg(
        F.count(F.lit(1)), F.sum(F.col("n") * F.exp(-F.lit(model["scale"]) * F.col("best")))).first()
    if clean[0]:
        model["k"] = clean[0] / clean[1]        # likeliest k of P(best < x) = exp(-k n exp(-scale x))
    seen = rows.mapInArrow(best, kind).select("toxic", "evidence").toPandas()     # at most TRAIN_ROWS rows
    model["curve"] = _logistic(np.clip(seen["evidence"], -30, 30), seen["toxic"])
    return model


# -------------------------------------------------------------------------- scoring

def score(df, model, text="text", carry=None):
    """Carried columns plus score, predicted, n_passages and passages of every whole text.

    `score` is the calibrated probability of label 1, `predicted` is 1 from 0.5 on. `passages` are
    the significant ones: start and end in tokens (runs of letters), score, and the passages as
    high that chance would give. A null text and one without letters have no evidence either way
    and get score 0; so does every text without a model. Repeated rows are scored alike. Nothing is
    shuffled; the model is broadcast, its size is bounded by MOST_TOKENS.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        model = shared.value
        scores, labels, counts, passages = [], [], [], []
        for t in texts:
            evidence, _, strong = _evidence(model, t) if model else (None, 0, [])
            p = 0.0
            if evidence is not None:
                a, b = model["curve"]
                p = 1 / (1 + math.exp(-min(max(a + b * min(max(evidence, -30), 30), -30), 30)))
            scores.append(p)
            labels.append(int(p >= 0.5))
            counts.append(len(strong))
            passages.append([{"start": s, "end": e, "score": v, "expected": math.exp(-x)} for s, e, v, x in strong])
        return scores, labels, counts, passages

    results = "score double, predicted int, n_passages int, " \
              "passages array<struct<start:bigint,end:bigint,score:double,expected:double>>"
    return per_text(df, text, run, results, carry, binary=True)


def held_out():
    """crc32(doc_id as text) mod 5 is 0; a null doc_id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(column("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def score_documents(docs, labels):
    """Learned from labels outside the held-out fifth; doc_id, held_out, score, predicted, n_passages."""
    rows = docs.select(column("doc_id"), column("text"))
    model = fit(rows, labels.filter(~held_out()))
    return (score(rows.withColumn("held_out", held_out()), model, carry=["doc_id", "held_out"])
            .select("doc_id", "held_out", "score", "predicted", "n_passages"))


def keep_clean(docs, labels):
    """The rows of `docs` that are not predicted toxic, with the same columns; learns from all labels."""
    model = fit(docs, labels)
    frame, place, back = neutral(docs)
    return score(frame, model, place["text"], list(place.values())).filter("predicted = 0").select(*back)
