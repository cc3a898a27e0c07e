"""Periodic runs against every lag, search against every score."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from chargelens.llm import periodic_runs, search

from . import brute
from .frames import DOCS, documents, empty, frame, prose


# --------------------------------------------------------------- periodic runs

def odd_line(draw):
    n = draw.randint(0, 80)
    if draw.random() < 0.4:
        return [draw.choice("ab" if draw.random() < 0.8 else "abc") for _ in range(n)]
    line = []
    while len(line) < n:
        part = [draw.choice("abcdefgh") for _ in range(draw.randint(1, 13))]
        if draw.random() < 0.4:
            part = part * draw.randint(1, 3) + [draw.choice("ab")]
        line += part * draw.randint(1, 9)
        line = line[:len(line) - draw.randint(0, 3)]
    return line


def test_runs():
    draw = random.Random(8)
    found = 0
    for _ in range(3_000):
        line = odd_line(draw)
        got = periodic_runs.runs(line)
        assert got == brute.runs(line), line
        found += len(got)
    assert found > 2_000
    with pytest.raises(ValueError):
        periodic_runs.runs(["a"], least=5)
    assert periodic_runs.runs(["a", "b"] * 5, times=5) == [(0, 10, 2)] and not periodic_runs.runs(["a", "b"] * 5, least=11)


@pytest.mark.parametrize("line", [["a"] * 30_000, ["a", "b"] * 15_000, ["a"] * 9 + ["b"], (["a"] * 700 + ["b"]) * 30])
def test_runs_of_few_words_take_little_time(line):
    begin = time.time()
    assert len(periodic_runs.runs(line)) in (1, 31)
    assert time.time() - begin < 10


def test_find_runs(spark):
    draw = random.Random(9)
    rows = [(i, *r[1:]) for i, r in enumerate(documents())]
    rows += [(1000 + i, " \t".join(odd_line(draw)), None, None, None) for i in range(200)]
    rows += [(2000, "a\u00a0 " * 9, None, None, None), (2001, "x\x1cy z " * 5, None, None, None)]
    found = periodic_runs.find_runs(frame(spark, rows).withColumnRenamed("kept", "runs")).collect()
    texts = {r[0]: r[1] for r in rows}
    assert len(found) == len(rows) and "collapsed" in found[0].asDict()
    for r in found:
        words = brute.words(texts[r.doc_id])
        spans = brute.runs(words) if len(words) < 300 else [tuple(x) for x in r.runs]
        assert [(x.start, x.length, x.period) for x in r.runs] == spans
        gone = {i for s, n, q in spans for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert periodic_runs.find_runs(empty(spark)).count() == 0


def planted(doc_id, text):
    words = brute.words(text)
    h = brute.crc(doc_id)
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_run_documents(spark):
    draw = random.Random(10)
    rows = [(i, prose(draw, draw.choice([1, 2, 3, 10, 40, 90])), None, None, None) for i in range(300)]
    rows += [(300, None, None, None, None), (301, "", None, None, None), (None, "a " * 9, None, None, None),
             (302, None, None, None, None), (310, " \n", None, None, None)]
    found = periodic_runs.run_documents(frame(spark, rows)).collect()
    texts, changed = {r[0]: r[1] for r in rows}, 0
    for r in found:
        words = planted(r.doc_id, texts[r.doc_id])
        changed += words != brute.words(texts[r.doc_id])
        spans = brute.runs(words)
        gone = {i for s, n, q in spans for i in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in spans), default=None)
        assert r.n_runs == len(spans)
        assert (r.start, r.length, r.period, r.exponent_milli) == (
            (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in spans))
        assert r.collapsed_sha256 == brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone))
    assert changed > 8 and periodic_runs.run_documents(empty(spark)).count() == 0


# ---------------------------------------------------------------------- search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def term_list(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranking(items, docs, k):
    """{(item_id, text): [(score, doc_id)]}, every score worked out."""
    counted = [(d, Counter(term_list(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    many, total = sum(n > 0 for n in sizes), sum(sizes)
    held = Counter(t for _, c in counted for t in c)
    result = {}
    for item, text in set(items):
        asked, scores = Counter(term_list(text)), []
        for (d, c), n in zip(counted, sizes):
            score = sum(times * math.floor(1000 * math.log((2 * many + 2) / (2 * held[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * many // total)))
                        for t, times in asked.items() if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0))
        result[item, text] = [(-s, None if none else d) for s, none, d in sorted(scores)[:k]]
    return result


def found_ranking(found):
    lists = {}
    for r in found.collect():
        lists.setdefault(r.item_id, []).append((r["rank"], r.score, r.doc_id))
    return {i: sorted(x) for i, x in lists.items()}


def tables(spark, n=6_000):
    draw = random.Random(11)
    words = [f"w{int(draw.paretovariate(0.7)) % 900}" for _ in range(4_000)] + ["Été", "x_y", "ÀB", "a1"]
    docs = [(i, draw.choice(" -_.\n").join(draw.choice(words) for _ in range(draw.randint(0, 30))), None, None, None)
            for i in range(n)]
    docs += [(n, None, None, None, None), (n + 1, "", None, None, None), (n + 2, "...", None, None, None),
             (None, docs[5][1], None, None, None), (n + 3, docs[5][1], None, None, None), docs[5],
             (n + 4, "w1 " * 50_000, None, None, None)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 25)))) for i in range(60)]
    items += [(60, None), (61, ""), (62, "unheard"), (63, "w1 w1 w2"), (63, "w1 w1 w2"), (64, docs[5][1])]
    return docs, items, spark.createDataFrame([(a, b, "x", 1) for a, b in items], "item_id int, text string, `rank` string, n int")


def check(found, items, docs, k):
    want = {i: ranked for (i, _), ranked in ranking(items, docs, k).items()}
    got = found_ranking(found)
    assert set(got) == {i for i, ranked in want.items() if ranked}
    for i, lines in got.items():
        assert lines == [(place + 1, s, d) for place, (s, d) in enumerate(want[i])], i


def test_search(spark):
    docs, items, asked = tables(spark)
    check(search.search(asked, frame(spark, docs).repartition(3)), items, [r[:2] for r in docs], search.K)


def test_search_in_blocks(spark, monkeypatch):
    docs, items, asked = tables(spark, 400)
    monkeypatch.setattr(search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(search, "PASS_BLOCKS", 3)
    monkeypatch.setattr(search, "FAN", 3)
    check(search.search(asked, frame(spark, docs), k=4), items, [r[:2] for r in docs], 4)


def test_search_of_empty_tables(spark):
    docs, items, asked = tables(spark, 20)
    assert search.search(asked, empty(spark)).count() == 0
    assert search.search(asked.limit(0), frame(spark, docs)).count() == 0
    assert search.search(asked, frame(spark, [(1, "!!", None, None, None)])).count() == 0


def test_an_id_with_two_texts_has_two_rankings(spark):
    asked = spark.createDataFrame([(1, "ab"), (1, "cd")], "item_id int, text string")
    found = search.search(asked, spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "x")], "doc_id int, text string")).collect()
    assert sorted((r["rank"], r.doc_id) for r in found) == [(1, 1), (1, 2)]


def test_branches_are_left(monkeypatch):
    """Pairs of nodes that cannot reach the kth score are not scored."""
    draw = np.random.default_rng(1)
    vectors = [{int(t): int(draw.integers(1, 9)) for t in draw.choice(300, 6, replace=False)} for _ in range(40)]
    tree = search.Search(search.item_tree(vectors), 40, 300, 5)
    scored, real = [], search.products
    monkeypatch.setattr(search, "products", lambda values, weights: scored.append(values.shape[0]) or real(values, weights))
    dense = np.zeros((12_288, 300), dtype=np.int64)
    for row in dense:
        row[draw.choice(300, 4, replace=False)] = draw.integers(1, 100, 4)
    ids = search.pa.array(range(12_288))
    for at in range(0, 12_288, 4_096):
        owner, place = np.nonzero(dense[at:at + 4_096])
        tree.add(owner, place, dense[at:at + 4_096][owner, place], ids.slice(at, 4_096))
    for item, v in enumerate(vectors):
        weights = np.zeros(300, dtype=np.int64)
        weights[list(v)] = list(v.values())
        scores = dense @ weights
        want = sorted((-int(s), i) for i, s in enumerate(scores) if s > 0)[:5]
        assert [(r[0], r[2]) for r in tree.best[item]] == want
    assert sum(scored) < 0.6 * 12_288 * 5      # five leaves of items


def test_long_lengths():
    n = np.array([0, 5, 10**9])
    assert search.lengths(n, 10**12, 10**13).tolist() == [75, 87, 75 + 25 * 10**8]
    assert search.lengths(n[:2], 3, 7).tolist() == [75, 75 + 25 * 15 // 7]


def test_exact_products_of_large_weights():
    weights = np.array([[1 << 41, 3], [5, 7]])
    values = np.array([[999_999, 1], [1, 0]])
    assert search.products(values, weights).tolist() == [[(1 << 41) * 999_999 + 3, 5 * 999_999 + 7], [1 << 41, 5]]


def test_documents_schema():
    assert DOCS.startswith("doc_id")
