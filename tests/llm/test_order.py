"""Sharding, mixing and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
from chargelens.llm import mixing, sharding
from pyspark.sql import functions as F

from . import brute
from .frames import documents, empty, frame


def test_sharding(spark):
    rows = documents()
    found = sharding.shard_documents(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    places = defaultdict(list)
    for r in found:
        places[r.shard].append(r)
    sizes = [len(places[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    for rs in places.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), s) for d, t, _, s, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.source) for r in found) == want
    again = sharding.shard_documents(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    for source, n in Counter(r[3] for r in rows).items():         # every shard matches the mixture
        assert all(abs(sum(r.source == source for r in places[s]) - n / 16) <= 2 for s in range(16))


def test_sharding_of_little(spark):
    assert sharding.shard_documents(empty(spark)).count() == 0
    two = frame(spark, documents()[:2])
    assert [r.slot for r in sharding.shard_documents(two, 5).collect()] == [0, 0]


def poured(sizes, weights, budget):
    """Targets by pouring again and again."""
    targets, left, open_ = {}, budget, dict(weights)
    while open_:
        per = left / sum(open_.values())
        full = [s for s in open_ if 2 * sizes[s] <= per * open_[s]]
        if not full:
            return targets | {s: per * w for s, w in open_.items()}
        for s in full:
            targets[s] = Fraction(2 * sizes[s])
            left -= targets[s]
            del open_[s]
    return targets


def test_mixing(spark):
    rows = documents()
    docs = frame(spark, rows)
    found = mixing.mix_documents(docs).collect()
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((d, len(brute.words(t))) for d, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(brute.words(t))
    names = sorted(s for s in sizes if s is not None) + [None]
    want = poured(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, Fraction(3 * sum(sizes.values()), 2))
    taken = Counter()
    for r in found:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.taken <= 2 * r.size
        assert math.isclose(r.target, want[r.source])
    assert all(taken[s] == math.floor(want[s]) for s in names)
    again = mixing.mix_documents(docs.repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert mixing.mix_documents(empty(spark)).count() == 0


def test_mixing_follows_the_random_order(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), None, "a" if i % 3 else "b", None) for i in range(90)]
    docs = frame(spark, rows)
    mixed = mixing.mix(docs.withColumn("words", mixing.word_count("text")), "words", weights=(1, 5), budget=(1, 2)).collect()
    for source in "ab":
        own = sorted((r for r in mixed if r.source == source), key=lambda r: r.key)
        left = math.floor(own[0].target) - own[0].rounds * own[0].source_size
        for r in own:
            assert r.taken == r.rounds * r.size + min(max(left, 0), r.size)
            left -= r.size
    rowed = mixing.repeat_rows(docs)
    assert rowed.columns == docs.columns
    assert mixing.repeat_rows(empty(spark)).count() == 0


def test_repeated_rows_are_whole(spark):
    docs = frame(spark, documents())
    counts = Counter(r.doc_id for r in mixing.repeat_rows(docs).collect())
    narrow = docs.select("doc_id", "source", mixing.word_count("text").alias("words"))
    for r in mixing.mix(narrow, "words").filter("size > 0").dropDuplicates(["doc_id"]).collect():
        rows = sum(d[0] == r.doc_id for d in documents())
        assert counts[r.doc_id] in (r.rounds * rows, (r.rounds + 1) * rows)
        assert counts[r.doc_id] * r.size >= r.taken


def test_repeated_rows_of_null_and_repeated_ids(spark):
    sizes = {"a": 300, "b": 200, "c": 90}
    rows = [(None if i % 2 else 5, " ".join([f"w{i}"] * (i % 7 + 1)), None, s, None)
            for s, n in sizes.items() for i in range(n)]
    docs = frame(spark, rows)
    goals = {r.source: math.floor(r.target) for r in mixing.mix_documents(docs).collect()}
    words = Counter()
    for r in mixing.repeat_rows(docs).collect():
        words[r.source] += len(r.text.split())
    assert any(goals[s] % sum(i % 7 + 1 for i in range(n)) for s, n in sizes.items())
    assert all(goals[s] <= words[s] < goals[s] + 7 for s in sizes)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf_dir)
        assert after.columns == docs.columns
        rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
        left = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "near_duplicates":
            assert left == {d for d, (_, c) in brute.components(rows, 5, 80, 100).items() if d == c}
        if name == "decontamination":
            bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            leaks = {d for d, t in rows if any(len(b.split()) >= 15 and b in t for b in bench)}
            assert not leaks & left and len(left) > 0.8 * len(rows)
        kept = after
    result = corpus_pipeline.run(spark, sf_dir)
    sizes = [r["count"] for r in result.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1
    assert result.count() == kept.count()
    assert result.select(F.sum("size")).first()[0] == kept.select(F.sum(F.octet_length("text") + 1)).first()[0]
