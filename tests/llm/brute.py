"""Plain versions of the corpus operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


# ------------------------------------------------------------- near-duplicates

def shingles(text, size):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    line = words(lowered)
    if not line:
        return set()
    return {tuple(line)} if len(line) < size else {tuple(line[i:i + size]) for i in range(len(line) - size + 1)}


def components(rows, size, up, down):
    """{doc_id: (set size, component)} for rows (doc_id, text), by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having, same = defaultdict(list), {}
    for d, s in sets.items():
        if not s:
            continue
        key = frozenset(s)
        if key in same:
            a, b = sorted((find(d), find(same[key])))
            parent[b] = a
            continue
        same[key] = d
        near = Counter(o for x in s for o in having[x])
        for other, both in near.items():
            if down * both >= up * (len(s) + len(sets[other]) - both):
                a, b = sorted((find(d), find(other)))
                parent[b] = a
        for x in s:
            having[x].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


# ----------------------------------------------------------- repeated passages

def repeats(rows, length):
    """{doc_id: (bytes, removed, spans, hash)} for rows (doc_id, text)."""
    texts = {d: (t or "").encode() for d, t in rows}
    seen = Counter()
    for t in texts.values():
        seen.update(t[i:i + length] for i in range(len(t) - length + 1))
    found = {}
    for d, t in texts.items():
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        left = bytes(b for b, g in zip(t, gone) if not g)
        found[d] = (len(t), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return found


# -------------------------------------------------------------------- quality

def base(text):
    """(words, code points in words, symbols, duplicate lines, repeated words, failed)."""
    line = words(text)
    twice = Counter(tuple(line[i:i + 5]) for i in range(len(line) - 4))
    covered = set()
    for i in range(len(line) - 4):
        if twice[tuple(line[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    n, r = len(line), len(covered)
    return (n, sum(map(len, line)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), r,
            n < 10 or 100 * r > 20 * n)


# --------------------------------------------------------------------- secrets

def known_spans(text):
    text = text or ""
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]""" \
             r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def crc(value):
    return zlib.crc32(str(value).encode())


# --------------------------------------------------------------- personal data

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text):
    """Spans of email, ip, card and phone, each by its plain pattern."""
    text = text or ""
    only = lambda m: re.sub("[^0-9]", "", m.group())
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)] if "@" in text else []
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
          if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))] if "." in text else []
    card = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(only(m)) <= 19 and luhn(only(m))]
    phone = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(only(m)) <= 15]
    return email, ip, card, phone


# --------------------------------------------------------------- periodic runs

def runs(words):
    """(start, length, period) of maximal runs of four periods and six words, lag by lag."""
    found = []
    for lag in range(1, len(words) // 4 + 1):
        i = lag
        while i < len(words):
            start = i - lag
            while i < len(words) and words[i] == words[i - lag]:
                i += 1
            part = words[start:i]
            if len(part) >= max(6, 4 * lag) and all(any(part[k] != part[k - q] for k in range(q, len(part))) for q in range(1, lag)):
                found.append((start, i - start, lag))
            i = max(i, start + lag) + 1
    return sorted(found)
