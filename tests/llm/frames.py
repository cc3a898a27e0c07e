"""Small document tables with everything that may be odd about them."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOWELS, OTHERS = "aeiou", "bcdfghklmnprstvw"


def word(draw):
    return "".join(draw.choice(OTHERS) + draw.choice(VOWELS) for _ in range(draw.randint(1, 4)))


def prose(draw, n):
    words = [word(draw) for _ in range(n)]
    return " ".join(w.capitalize() if i % 12 == 0 else w + "." if i % 12 == 11 else w for i, w in enumerate(words))


def edited(draw, text, changes):
    words = text.split(" ")
    for i in draw.sample(range(len(words)), changes):
        words[i] = word(draw)
    return " ".join(words)


def documents(seed=1, originals=12, copies=6):
    """Rows with copies, edited copies, shared passages, null and empty cells, repeated rows, a long text."""
    draw = random.Random(seed)
    texts = [prose(draw, draw.choice([6, 30, 90, 150])) for _ in range(originals)]
    base = max(texts, key=len)
    passage = prose(draw, 70)
    texts += [base] * copies + [edited(draw, base, k) for k in (1, 2, 3, 5, 8, 13, 21) for _ in range(4)]
    texts += [prose(draw, 40) + "\n" + passage + " " + prose(draw, 20) for _ in range(3)]
    texts += [None, "", " \n\t ", "a", "Ñ é", "one two", "=" * 500, "Same line of text here.\n" * 60,
              prose(draw, 4_000) + " " + passage, "x" * 30_000]
    rows = [(i, t, draw.choice(["en", "fr", None]), draw.choice(["s0", "s1", "s10", None]), None)
            for i, t in enumerate(texts)]
    return rows + [rows[0], rows[3], (None, "Nobody knows my number " + passage, None, None, None)]


def frame(spark, rows):
    """The rows with extra columns whose names clash with what operators add."""
    extra = ", score string, kept int, _text string, key string, node int, shard string, size string, h int, spans int"
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2, "w", "v", 3, 4) for r in rows], DOCS + extra)


def empty(spark):
    return spark.createDataFrame([], DOCS)
