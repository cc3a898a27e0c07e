"""Near-duplicates, repeated passages and decontamination against plain versions."""

import random
import time

import numpy as np
import pytest

from chargelens.llm import decontaminate, minhash, suffix_dedup

from . import brute
from .frames import documents, edited, empty, frame, prose, word


def named(rows):
    """Rows with an id of their own, as the plain versions need."""
    return [(i, r[1], *r[2:]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    rows = named(documents(seed))
    found = minhash.link_documents(frame(spark, rows)).collect()
    want = brute.components([r[:2] for r in rows], 3, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FETCH_ROWS", 0)
    monkeypatch.setattr(suffix_dedup, "FETCH_ROWS", 0)
    monkeypatch.setattr(decontaminate, "FETCH_ROWS", 0)
    test_near_duplicates(spark, 3)
    test_keep_one_keeps_columns(spark)
    test_repeats(spark, monkeypatch, 3, 1_000)
    test_decontamination_in_blocks(spark, monkeypatch)


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    draw = random.Random(3)
    base = prose(draw, 120)
    rows = [(i, edited(draw, base, draw.randint(1, 14))) for i in range(250)]
    found = minhash.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(rows, 3, 85, 100)


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "A b c d e f"), (4, "A b c d e f"), (9, "x")]
    found = minhash.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found) == sorted([
        ("None", 4, "4", False), ("None", 0, "None", True), ("4", 4, "4", True), ("4", 4, "4", True),
        ("4", 4, "4", True), ("9", 1, "9", True)])
    assert minhash.link_documents(empty(spark)).count() == 0


def test_keep_one_keeps_columns(spark):
    docs = frame(spark, named(documents()))
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {d for d, (_, c) in brute.components([(r[0], r[1]) for r in named(documents())], 5, 80, 100).items() if d == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_keep_one_of_null_and_repeated_ids(spark):
    draw = random.Random(10)
    one, two, three, four = (prose(draw, 60) for _ in range(4))
    near = one.rsplit(" ", 1)[0]
    lone = prose(draw, 50)
    rows = [(1, one), (None, near), (None, two), (None, ""), (None, None),       # a null id linked with 1
            (2, three), (2, lone), (0, three + " end"),                          # an id over two texts
            (None, four), (None, four + " end"), (None, four + " end"),          # near copies without ids
            (5, two + " end"), (6, "x y"), (6, "x y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id, r.text) for r in minhash.keep_one(docs).collect()), key=str)
    fours = [r for r in kept if r[1] and r[1].startswith(four)]
    assert len(set(fours)) == 1 and len(fours) == rows.count(fours[0])
    assert sorted((r for r in kept if r not in fours), key=str) == sorted(
        [(1, one), (None, ""), (None, None), (2, lone), (0, three + " end"), (5, two + " end"), (6, "x y"), (6, "x y")],
        key=str)


def test_pruning_table():
    table = minhash.least_matches(0.85)
    assert list(table) == list(range(20, 121, 20)) and table[120] > 70
    left = np.zeros((2, minhash.HASHES), np.uint32)
    right = np.stack([np.zeros(minhash.HASHES), np.ones(minhash.HASHES)]).astype(np.uint32)
    assert minhash.survivors(left, right, table).tolist() == [0]


@pytest.mark.parametrize("seed,most", [(1, 1_000), (2, 2)])
def test_repeats(spark, monkeypatch, seed, most):
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)      # with 2, keys are split by content
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 5_000)
    rows = named(documents(seed))
    found = suffix_dedup.repeat_documents(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute.repeats(
        [r[:2] for r in rows], 200)


def test_repeats_across_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 3_000)
    rows = named(documents(4))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in
            suffix_dedup.repeat_documents(frame(spark, rows)).collect()} == brute.repeats([r[:2] for r in rows], 200)


def test_repeats_odd_rows(spark):
    text = "z" * 250
    rows = [(1, text), (1, text), (None, None), (3, "short")]
    found = suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), keep_text=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, bytes(r.kept)) for r in found) == [
        ("1", 250, b""), ("1", 250, b""), ("3", 5, b"short"), ("None", 0, b"")]
    assert suffix_dedup.repeat_documents(empty(spark)).count() == 0


def test_suffixes_in_two_stages():
    draw = random.Random(5)
    for alphabet, n in (("ab", 400), ("abcdef", 600), ("a", 50)):
        data = "".join(draw.choice(alphabet) for _ in range(n)).encode()
        rank = suffix_dedup.sort_suffixes(data, np.append(np.ones(n, bool), [False, False]), n + 2)
        tail = data + b"\x00\x01"
        assert np.argsort(rank).tolist() == sorted(range(n), key=lambda i: tail[i:])


def test_decontamination(spark):
    draw = random.Random(6)
    item = "If Anna buys 12 apples at 3 kg each and gives Peter 5 of them, how many apples are left with Anna now?"
    other = item.replace("12", "90").replace("5", "7").replace("Anna", "Maria").replace("Peter", "Ivan")
    torn = item.replace("Anna now", "Olga now")
    docs = [(1, prose(draw, 40) + ". " + item), (2, other), (3, prose(draw, 200)), (4, None), (5, ""), (6, torn),
            (None, item), (2, other)]
    bench = [(7, item), (8, prose(draw, 30)), (9, None), (10, "No"), (None, "No")]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                       spark.createDataFrame(bench, "item_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 7), ("2", 7), ("2", 7), ("6", 7), ("None", 7)]
    changed = {r.doc_id: r.changed_slots for r in found}
    assert changed[1] == 0 and changed[2] == 4
    whole = {r.doc_id: r.coverage for r in found}
    assert whole[2] == 1.0 and whole[6] < 1.0         # the slot that names two people is left out


def test_decontamination_in_blocks(spark, monkeypatch):
    draw = random.Random(8)
    bench = [(i, prose(draw, 30)) for i in range(20)]
    docs = [(i, prose(draw, 50) + "\n" + bench[i][1]) for i in range(0, 20, 3)] + [(100, prose(draw, 90))]
    docs, bench = (frame(spark, [(*r, None, None, None) for r in docs]),
                   spark.createDataFrame(bench, "item_id bigint, text string"))
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 100)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole
    assert [r[:2] for r in whole] == [(i, i) for i in range(0, 20, 3)]
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [100]
    none = bench.limit(0)
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()


def test_decontamination_after_a_stray_window(spark):
    draw = random.Random(9)
    item = " ".join(" ".join(word(draw) for _ in range(6)) + " Anna" for _ in range(6))
    stray = " ".join(item.split()[3:11]).replace("Anna", "Olga")
    odd = item.replace("Anna", "Olga", 1)                    # the first name alone is another
    docs = [(1, item), (2, prose(draw, 300) + " and " + stray + " " + prose(draw, 2_000) + " and " + item), (3, odd),
            (4, prose(draw, 50) + " and " + stray)]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                       spark.createDataFrame([(7, item)], "item_id bigint, text string")).collect()
    got = {r.doc_id: (r.coverage, r.longest_run, r.changed_slots) for r in found}
    assert set(got) == {1, 2, 3} and got[1] == got[2] == (1.0, 42, 0)
    assert got[3][0] > 0.8 and got[3][2] == 0


def test_decontamination_of_names_that_begin_sentences(spark):
    item = ("Anna has 12 apples. Peter buys 7 pears. Maria eats 3 plums. Tom sells 5 figs. "
            "How many fruits are left?")
    renamed = item
    for a, b in (("Anna", "Olga"), ("Peter", "Ivan"), ("Maria", "Ruth"), ("Tom", "Emil"), ("12", "31"), ("5", "8")):
        renamed = renamed.replace(a, b)
    bench = [(1, item), (2, "What is the capital of France?"), (3, "Yesterday Anna walked with Peter to Oldtown.")]
    docs = [(1, renamed), (2, "Some words. " + renamed.replace("Olga", "then Olga")), (3, item.lower()),
            (4, "Questions\nWhat is the capital of France?"), (5, "we ask what is the capital of France"),
            (6, "Berlin is the capital of Germany."), (7, "yesterday anna walked with peter to oldtown"),
            (8, "So Ruth has many cats. Olga sees none of them.")]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                       spark.createDataFrame(bench, "item_id bigint, text string")).collect()
    got = {(r.doc_id, r.item_id): (r.coverage, r.changed_slots) for r in found}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (7, 3)}
    assert got[1, 1] == (1.0, 6) and got[2, 1] == (1.0, 6) and got[3, 1] == (1.0, 0)


def found_pairs(spark, docs, bench):
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                       spark.createDataFrame(bench, "item_id bigint, text string")).collect()
    return {(r.doc_id, r.item_id): r for r in found}


def test_numbers_and_names_alone_are_no_evidence(spark):
    """Tables of numbers, lists of names and other texts of placeholders stay, also with such items in the benchmark."""
    draw = random.Random(12)
    names = "Anna Bob Carla Dmitri Elena Frank Greta Hugo Ines Jonas Karl Lena Marta Nils Olga Pavel Rosa Sven Tara Uwe".split()
    numeric = "What is the median of 3 5 8 12 14 20 21 23 27 30 31 40?"
    listed = "The winners were Anna, Bob, Carla, Dmitri, Elena, Frank, Greta, Hugo and Ines."
    bench = [(1, numeric), (2, listed), (3, "3.5 kg 7 kg 9 kg 12 kg 14 kg 18 kg 20 kg"), (4, " ".join(names[13::-1]))]
    tables = [(i, " ".join(str(draw.randint(1, 99)) for _ in range(30))) for i in range(50)]
    tables += [(100 + i, "The winners: " + ", ".join(draw.choice(names) for _ in range(12)) + ".") for i in range(50)]
    tables += [(200 + i, "Cities: " + ", ".join(word(draw).capitalize() for _ in range(12))) for i in range(50)]
    tables += [(300 + i, " ".join(f"{draw.randint(1, 99)} kg" for _ in range(20))) for i in range(20)]
    copies = [(900, numeric), (901, "x " + bench[2][1] + " y"), (902, bench[3][1]), (903, "Now. " + listed)]
    assert set(found_pairs(spark, tables + copies, bench)) == {(900, 1), (901, 3), (902, 4), (903, 2)}
    docs = spark.createDataFrame(tables, "doc_id bigint, text string")
    assert decontaminate.drop_contaminated(docs, spark.createDataFrame(bench, "item_id bigint, text string")).count() == len(tables)


QUESTIONS = [
    "If {a} buys {x} apples at {y} kg each and gives {b} {z} of them, how many apples are left with {a} now?",
    "{a} has {x} marbles. {b} wins {y} of them in the first game and {z} in the second. How many marbles does {a} keep?",
    "A train leaves the station at {x} km per hour while {a} drives after it at {y} km per hour for {z} hours. Who is ahead?",
    "The sum of two numbers is {x} and their difference is {y}. {a} says the larger is {z}. Is {b} right to doubt it?",
    "{a} paints {x} walls in {y} days and {b} paints {z} walls in the same time. How long do they need together for the house?"]


def test_changed_questions_are_found(spark):
    """Recall on planted questions with other names and numbers, and no other text reported."""
    draw = random.Random(13)
    people = "Anna Peter Maria Tom Ivan Olga Lena Hugo Rosa Sven".split()

    def made(question):
        a, b = draw.sample(people, 2)
        x, y, z = draw.sample(range(2, 90), 3)
        return question.format(a=a, b=b, x=x, y=y, z=z)

    bench = [(i, made(q)) for i, q in enumerate(QUESTIONS)]
    docs, planted = [], set()
    for k in range(100):
        i = draw.randrange(len(QUESTIONS))
        docs.append((k, prose(draw, draw.randint(0, 60)) + ". " + made(QUESTIONS[i]) + " " + prose(draw, draw.randint(0, 60))))
        planted.add((k, i))
    docs += [(1000 + k, prose(draw, 120)) for k in range(50)]
    found = set(found_pairs(spark, docs, bench))
    assert len(found & planted) >= 0.9 * len(planted) and found <= planted


@pytest.mark.parametrize("text", ["same " * 20_000, "Name " * 20_000, "7 " * 20_000, "a 1 b 2 c d e f g h " * 2_000,
                                  "if x is 3 then y is 4 . " * 2_000])
def test_texts_of_few_words_take_little_time(text):
    made = [t for t in ("same " * 300, "Name " * 300, "7 " * 300, "a 1 b 2 c d e f g h " * 30, "if x is 3 then y is 4 . " * 40)]
    items, packed, _ = decontaminate.item_rows([m.encode() for m in made])
    _, known, tables = decontaminate.index(list(zip(range(5), items, packed)))
    decontaminate.templates([b"warm up"], {})
    begin = time.time()
    lines, ends, slots_of = decontaminate.templates([text.encode()], {})
    found = decontaminate.starts(lines, ends, tables)
    pairs = [decontaminate.match(known[i], lines, b, lambda: slots_of(0)) for i, b in found[0].items()]
    assert any(p and p[1] == 1.0 for p in pairs) and time.time() - begin < 3      # about half a second on an idle machine


def test_windows_are_counted(spark, monkeypatch):
    """Four windows a place at most, and blocks by their number."""
    text = " ".join(f"{word(random.Random(i)).capitalize()}." for i in range(400))
    (size,) = decontaminate.item_rows([text.encode()])[2]
    assert size <= 4 * 400
    blocks, original = [], decontaminate.index
    monkeypatch.setattr(decontaminate, "index", lambda rows: blocks.append(len(rows)) or original(rows))
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 60)
    draw = random.Random(4)
    found_pairs(spark, [(1, "x")], [(i, prose(draw, 30)) for i in range(20)])
    assert sum(blocks) == 20 and len(blocks) > 5


def slow_matches(text, item, size=8):
    """Plain rule for texts without names and numbers: equal windows at all places, all pairs of them."""
    doc, own = text.lower().split(), item.lower().split()
    if len(own) < 5:
        return doc == own
    size = min(size, len(own))
    covered, run, best = set(), {}, 0
    for i in range(len(own) - size + 1):
        for d in range(len(doc) - size + 1):
            if own[i:i + size] == doc[d:d + size]:
                covered.update(range(i, i + size))
                run[i, d] = run.get((i - 1, d - 1), size - 1) + 1
                best = max(best, run[i, d])
    return len(covered) >= 5 and (2 * len(covered) >= len(own) or best >= 13)


@pytest.mark.parametrize("words", ["abc", "abcdefghijklmnop"])
def test_matches_equal_the_plain_rule(spark, words):
    draw = random.Random(14)
    line = lambda n: " ".join("q" + draw.choice(words) for _ in range(n))
    bench = [(i, line(draw.choice([2, 4, 6, 9, 14, 40]))) for i in range(30)]
    docs = []
    for k in range(120):
        text = line(draw.randint(0, 40))
        if k % 2:
            own = draw.choice(bench)[1].split()
            lo = draw.randint(0, len(own) // 2)
            text += " " + " ".join(own[lo:lo + draw.randint(4, 30)]) + " " + line(draw.randint(0, 5))
        docs.append((k, text.strip()))
    docs += [(500, bench[0][1]), (501, bench[0][1].upper())]
    want = {(d, i) for d, text in docs for i, item in bench if slow_matches(text, item)}
    assert want and set(found_pairs(spark, docs, bench)) == want
