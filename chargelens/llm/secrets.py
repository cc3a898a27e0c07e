"""Secret scans: known shapes, and candidate strings whose sliding-window entropy is high."""

import re
from bisect import bisect_left
from math import log2

from pyspark.sql import functions as F

from .common import column, per_text

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
VALUE_LEAST, ACCESS_LEAST = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Class of a candidate by the characters it holds: bits per character that a window must reach.
THRESHOLDS = {"entropy_hex": 3.0, "entropy_alnum": 3.6, "entropy_base64": 3.8}
LONGEST_WORD = 32        # letters; a longer stretch of one case is judged by its entropy
ALLOWED = (
    re.compile(r"[0-9=_/+-]+"),                                                     # numbers, rules
    re.compile(rf"[A-Z]?[a-z]{{1,{LONGEST_WORD}}}"),                                # a long word
    re.compile(rf"[A-Z]{{1,{LONGEST_WORD}}}"),
    re.compile(r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"),   # UUID
    re.compile(rf"[/_=-]*(?:(?:[A-Z]?[a-z]{{1,{LONGEST_WORD}}}[0-9]{{0,4}}|[A-Z]{{1,{LONGEST_WORD}}}|[0-9]{{1,4}})"
               r"(?:[/_=-]+|$))*"),                                                 # path, slug
)
SINGLE_CASE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MASS = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]     # n * log2(n)


def _class_of(text):
    if re.fullmatch(r"[0-9A-Fa-f]+", text):
        return "entropy_hex"
    return "entropy_alnum" if text.isalnum() else "entropy_base64"


def entropy_spans(text, least, window=WINDOW):
    """Maximal stretches covered by windows whose Shannon entropy is `least` bits or more.

    The counts of a window follow from those of the one before: one character leaves, one enters.
    """
    counts, mass, spans = {}, 0.0, []
    for i, char in enumerate(text):
        n = counts.get(char, 0)
        mass += MASS[n + 1] - MASS[n]
        counts[char] = n + 1
        if i >= window:
            old = text[i - window]
            n = counts[old]
            mass += MASS[n - 1] - MASS[n]
            counts[old] = n - 1
        if i >= window - 1 and log2(window) - mass / window >= least - 1e-9:
            start = i - window + 1
            if spans and spans[-1][1] >= start:
                spans[-1][1] = i + 1
            else:
                spans.append([start, i + 1])
    return spans


def known_spans(text):
    """(start, kind, end) of the known shapes, unsorted; offsets are code points."""
    found = []
    lower = text.lower()
    if any(k in lower for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return found


def _merged(spans):
    """Disjoint stretches that cover the spans, in order."""
    merged = []
    for start, end in sorted(spans):
        if merged and merged[-1][1] >= start:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return merged


def _free(start, end, taken, starts):
    """The parts of a stretch that no known span covers; `starts` are those of the disjoint spans `taken`."""
    at = max(bisect_left(starts, start + 1) - 1, 0)
    while at < len(taken) and taken[at][0] < end:
        if taken[at][1] > start:
            if taken[at][0] > start:
                yield start, taken[at][0]
            start = taken[at][1]
        at += 1
    if start < end:
        yield start, end


def scan_text(text):
    """Spans of one text as (start, kind number, end), sorted by start, then kind."""
    found = known_spans(text)
    candidates = list(CANDIDATE.finditer(text))
    if candidates:                            # a hex run of 24 lies inside a candidate
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    taken = _merged((s, e) for s, _, e in found)
    starts = [s for s, _ in taken]
    for m in candidates:
        word = m.group()
        if any(rule.fullmatch(word) for rule in ALLOWED):
            continue
        kind = _class_of(word)
        least = LONGEST_WORD + 1 if SINGLE_CASE.fullmatch(word) else WINDOW
        for start, end in entropy_spans(word, THRESHOLDS[kind]):
            if end - start < least:     # a compound word is dense in places
                continue
            for low, high in _free(start + m.start(), end + m.start(), taken, starts):
                if (low, high) == (start + m.start(), end + m.start()):
                    found.append((low, KINDS.index(kind), high))
                    continue
                rest = text[low:high]       # what a known shape leaves of a stretch must stand by itself
                if any(rule.fullmatch(rest) for rule in ALLOWED):
                    continue
                kind_of_rest = _class_of(rest)
                found += [(s + low, KINDS.index(kind_of_rest), e + low) for s, e in entropy_spans(rest, THRESHOLDS[kind_of_rest])]
    return sorted(found)


def scan(df, text="text", carry=None):
    """Carried columns plus n_assign, n_access, n_hex and spans (kind, start, end), sorted by start.

    Spans are in code points, end exclusive. Known shapes are always reported. Entropy spans come
    from candidate strings of 20 characters or more; candidates that an allow-list pattern matches
    whole (words, numbers, paths, slugs, UUIDs) are suppressed, words up to LONGEST_WORD letters. What a
    known shape covers is cut out of a stretch; the rest is reported if it has the entropy by itself.
    An empty table gives an empty one. Texts are read whole, a null text is empty. Repeated rows are scanned alike.
    """
    def run(texts):
        rows = []
        for t in texts:
            spans = scan_text(t) if t else []
            kinds = [k for _, k, _ in spans]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                         [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]))
        return list(zip(*rows)) if rows else [[]] * 4

    return per_text(df, text, run, "n_assign bigint, n_access bigint, n_hex bigint, "
                                   "spans array<struct<kind:string,start:bigint,end:bigint>>", carry)


def digest(spans):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_documents(docs):
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return (scan(docs.select(column("doc_id"), column("text")), carry=["doc_id"])
            .select("doc_id", "n_assign", "n_access", "n_hex",
                    F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"),
                    digest(F.col("spans")).alias("spans")))
