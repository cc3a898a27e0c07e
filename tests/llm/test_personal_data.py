"""Personal data: known shapes against plain patterns, votes and their worth, added spans."""

import random

import pytest
from pyspark.sql import functions as F

from chargelens.llm import personal_data as pii

from . import brute
from .frames import DOCS, documents, empty, frame

LETTERS = "ab1290.-+@ ()_%é\n"


def odd_texts():
    draw = random.Random(5)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(1, 60))) for _ in range(700)]
    texts += ["".join(draw.choice("0123456789 -+") for _ in range(draw.randint(10, 90))) for _ in range(300)]
    texts += ["".join(draw.choice("a.@b") for _ in range(40)) for _ in range(200)]
    texts += ["1.2.3.4.5.6.7.8 256.1.1.1 0255.01.0.00 1.2.3", "a@b.c_d@e.f..g@h.i a@b..c@d.e a@.b a@b. a.b@c-d.e-f-",
              "4111 1111-1111 1111 4111111111111111 4111111111111112 41111111111111111111111", "é +49 (30) 1234-5678 +1 (2 +12",
              "+4111111111111111", "a@b.c@d.e"]
    return texts


def sha(text):
    return brute.sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, spans in enumerate(brute.personal(text)) for s, e in spans))


def test_known_shapes(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(documents())]
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate(odd_texts())]
    found = pii.detect_documents(frame(spark, rows + [rows[0]])).collect()
    assert len(found) == len(rows) + 1
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        spans = brute.personal(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(s) for s in spans], texts[r.doc_id]
        assert r.base_sha256 == sha(texts[r.doc_id]), texts[r.doc_id]
        known = [f"{pii.KINDS[k]}:{s}:{e}" for k, part in enumerate(spans) for s, e in part]
        assert [x for x in r.spans.split(",") if x][:len(known)] == known
    assert pii.detect_documents(empty(spark)).count() == 0


def test_long_texts(spark):
    texts = ["a@" + "b." * 40_000, "1 " * 40_000, "1." * 40_000, "." * 100_000 + "a@b.c", "x" * 200_000, "+1" + "(" * 100_000,
             "+1 (" * 20_000, "9" * 100_000, "a@b.c " * 3_000, "Ab " * 20_000, "1-" * 40_000]
    found = {r.doc_id: r for r in pii.detect_documents(spark.createDataFrame(
        [(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)).collect()}
    for i, t in enumerate(texts):
        assert found[i].base_sha256 == sha(t), t[:10]


def test_null_ids_and_clashing_columns(spark):
    rows = spark.createDataFrame([(None, "a@b.cc", 1, "x"), (None, "a@b.cc", 1, "x"), (2, None, 2, "y")],
                                 "doc_id bigint, text string, spans int, `n_ip` string")
    found = pii.detect(rows).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_email, len(r.spans)) for r in found if r.text) == [(0, "a@b.cc", 1, 1)] * 2
    assert found[0].asDict().keys() == {"doc_id", "text", "n_email", "n_ip", "n_card", "n_phone", "spans"}


ADDED = ["please call 212-555-0143 now", "my phone: 0171 555 0143.", "Telefon (030) 555-0143", "my ssn: 078-05-1120",
         "Dear Maria Schmidt, thanks", "signed, Dr. Peter Bauer", "contact: Thomas Weber"]
CLEAN = ["invoice 2024 1123 9981", "ISBN 978-3-16-148410-0", "on 2021-03-04 10", "the North Street City", "12 3 45 6 7 8 9 10 11 12",
         "Berlin Hamburg", "about 1.234.567.890 €", "order 4111111111111112"]


def test_added_spans(spark):
    rows = [(i, "zu " + t, None, None, None) for i, t in enumerate((ADDED + CLEAN) * 6)]
    rows += [(5000 + i, f"card 4111111111111111 and +49 30 5550143 and number {10**9 + i}", None, None, None) for i in range(60)]
    found = {r.doc_id: r.spans for r in pii.detect_documents(frame(spark, rows)).collect()}
    size = len(ADDED) + len(CLEAN)
    for i in range(6 * size):
        assert bool(found[i]) == (i % size < len(ADDED)), (rows[i][1], found[i])
    assert found[0] == "number:15:27" and found[4].startswith("person:8:21")


def test_added_spans_do_not_touch_known_ones(spark):
    text = "phone 1.2.3.4 555 123 4567 phone 10.1.1.1 and card +49 30 5550143 212-555-0143 call 212-555-0143"
    r = pii.detect(spark.createDataFrame([(1, text)] * 30, "doc_id int, text string")).first()
    known = [(s.start, s.end) for s in r.spans if s.kind < 4]
    added = [(s.start, s.end) for s in r.spans if s.kind >= 4]
    assert added == [(84, 96)] and all(e <= s2 or e2 <= s for s, e in known for s2, e2 in added)


def test_estimation_finds_reliabilities():
    draw = random.Random(2)
    right = [0.95, 0.9, 0.7, 0.55]      # how often a voter that votes is right
    counts = {}
    for _ in range(20_000):
        truth = draw.random() < 0.2
        votes = tuple(0 if draw.random() < 0.3 else (1 if (draw.random() < p) == truth else 2) for p in right)
        counts[votes] = counts.get(votes, 0) + 1
    share, chances = pii.estimate(counts, 4)
    assert abs(share - 0.2) < 0.03
    for voter, p in enumerate(right):
        found = chances[1][voter][1] / (chances[1][voter][1] + chances[1][voter][2])
        assert abs(found - p) < 0.08
    assert pii.posterior((1, 1, 1, 0), share, chances) > 0.9 > 0.1 > pii.posterior((2, 2, 0, 0), share, chances)


def test_classifier_is_the_regression():
    draw = random.Random(3)
    rows = [((a, b), 100, 100 / (1 + 2.718281828 ** -(-1 + 2 * a - 0.5 * b))) for a in (0, 1) for b in (0, 1)]
    weights = pii.fit_logistic(rows, 2, ridge=1e-9)
    assert weights == pytest.approx([-1, 2, -0.5], abs=1e-6) and draw


def test_scan(spark):
    rows = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 255, 256, 257, 1000)], "a array<int>")
    got = rows.select("a", pii.scan(F.col("a"), F.lit(0), lambda s, x: (s + x, s + x), "int", "int").alias("b")).collect()
    for r in got:
        assert r.b == [sum(r.a[:i + 1]) for i in range(len(r.a))]


def test_luhn(spark):
    numbers = ["4111111111111111", "4111111111111112", "79927398713", "79927398710", "0"]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select(pii.luhn(F.col("n"))).collect()
    assert [r[0] for r in got] == [brute.luhn(n) for n in numbers] == [True, False, True, False, True]
