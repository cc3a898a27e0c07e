"""Benchmark decontamination by templates: typed placeholders, window hashes, consistent slots."""

import pickle
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ..operators import ordered
from .common import column, materialize, neutral, per_text, small

WINDOW = 8                   # template tokens of a window
LITERALS = 3                 # plain words in a window; a window with fewer is compared with its values
SHORTEST = 5                 # items with fewer template tokens are matched only as a whole text
FEWEST = 5                   # plain words or equal values that a match covers at least
COVERAGE = 0.5               # share of an item's plain words and equal values that makes a document contaminated
RUN = 13                     # or so many of its template tokens in a row
BLOCK_WINDOWS = 500_000      # benchmark windows looked up in one pass over the documents, and those of one item more
FETCH_ROWS = 1_000_000

# Units that follow a number.
UNITS = frozenset("""mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hrs ms w kw v a hz khz mhz ghz kb mb gb tb
j kj c f k mph kmh inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
kilometre kilometres gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds
minute minutes hour hours day days week weeks month months year years percent dollar dollars cent cents euro euros
degree degrees""".split())
# Words that are no names, also where they begin a sentence or a title: they stand for themselves only.
COMMON = frozenset("""a an the this that these those there here it he she we you they i me my his her its our your their
and or but nor so yet if when while since because although though unless until after before then than as at by for from
in into of off on onto out over to under up with without about between through during what which who whom whose where why
how is are was were be been am do does did has have had can could will would shall should may might must not no yes all
any both each either neither every few many more most much one other some such only also now given let find suppose
assume consider calculate compute determine""".split())
NUMBER = re.compile(r"([$€£]?)([+-]?[0-9][0-9.,/:]*)(.*)", re.DOTALL)
EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~" + "¡¿«»“”‘’…–—"
AROUND_NUMBER = "".join(c for c in EDGES if c not in "$€£%+-")
AROUND_UNIT = EDGES.replace("%", "")
ENDS = (".", "!", "?", ":", ";")
CACHE = 400_000

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
STIR = 0xBF58476D1CE4E5B9
NUM, NAME, UNIT = 1, 2, 3
PIECE = 1 << 19              # text bytes handled at once, so that the arrays stay in the processor's cache
BLANK, LETTER, LEAD, TAIL = 1, 2, 4, 8
BYTES = np.zeros(256, np.uint8)                          # what a byte is: LEAD and TAIL make ß and à to ÿ
BYTES[[9, 10, 11, 12, 13, 32]] = BLANK
BYTES[97:123] = LETTER
BYTES[0xC3] = LEAD
BYTES[[0x9F, *(b for b in range(0xA0, 0xC0) if b != 0xB7)]] = TAIL
CLOSING = np.zeros(256, bool)
CLOSING[[ord(c) for c in ",.!?:;"]] = True
ENDING = CLOSING & (np.arange(256) != ord(","))
VALUES = np.arange(1, 257, dtype=np.uint64)


# ----------------------------------------------------------------------- templates

def _code(word):
    """64-bit code of a word: a polynomial of its UTF-8 bytes, stirred."""
    h = 0
    for b in word.encode("utf-8", "surrogatepass"):
        h = (h * BASE + b + 1) & MASK
    h = (h ^ h >> 32) * STIR & MASK
    return h ^ h >> 29


COMMON_CODES = np.sort(np.array([_code(w) for w in COMMON], np.uint64))


def _value(code, value):
    """Token of a placeholder: its code, its value and the code of that."""
    return code, value, _code(value.lower())


def _analyse(raw):
    """(tokens inside a sentence, tokens at its start, ends a sentence, is a unit) of a raw word.

    Tokens are (code, slot, code of the value); slot is None for words.
    """
    core = raw.strip(EDGES)
    ends = raw.rstrip("\"')]}”’»").endswith(ENDS)
    found = NUMBER.fullmatch(raw.strip(AROUND_NUMBER)) if core else None
    if found:
        sign, number, rest = found.groups()
        tokens = ([_value(UNIT, sign)] if sign else []) + [_value(NUM, number.rstrip(".,/:"))]
        rest = rest.strip(AROUND_UNIT).lower()
        if rest == "%" or rest in UNITS:
            tokens.append(_value(UNIT, rest))
        elif rest:
            tokens.append((_code(rest), None, _code(rest)))
        return tokens, tokens, ends, False
    if not core:
        return [], [], ends, False
    lower = core.lower()
    plain = [(_code(lower), None, _code(lower))]
    named = [_value(NAME, core)] if core[0].isupper() and lower not in COMMON else plain
    return named, plain, ends, lower in UNITS


def _powers(n, known=[None, None]):  # noqa: B006  (kept for a task)
    """BASE ** i and INVERSE ** i for i below n, modulo 2 ** 64."""
    if known[0] is None or len(known[0]) < n:
        for i, x in enumerate((BASE, INVERSE)):
            line = np.full(max(n, 1 << 16), x, np.uint64)
            line[0] = 1
            known[i] = np.multiply.accumulate(line)
    return known[0][:n], known[1][:n]


def _simple_words(data):
    """(starts, core ends, ends, codes, simple, capital, closes a sentence) of the words of a byte array.

    Simple words are a-z, à-ÿ and ß with at most a capital A-Z before and one closing mark after.
    The code of a simple word is that of `_code` for its core in lower case, from running sums.
    """
    kind = BYTES[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], kind == BLANK, [True]])))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * down[:-1], out=sums[1:])
    capital = (data[starts] >= 65) & (data[starts] <= 90)
    final = data[ends - 1]
    cores = ends - (CLOSING[final] & (ends - starts > 1))
    codes = (sums[cores] - sums[starts]) * up[cores - 1]
    codes[capital] += np.uint64(32) * up[(cores - 1 - starts)[capital]]
    codes = (codes ^ codes >> np.uint64(32)) * np.uint64(STIR)
    codes ^= codes >> np.uint64(29)
    letter = kind == LETTER
    pair = np.flatnonzero((kind[:-1] == LEAD) & (kind[1:] == TAIL))
    letter[pair] = letter[pair + 1] = True
    odd = np.zeros(len(data) + 1, np.int32)
    np.cumsum(~letter, dtype=np.int32, out=odd[1:])
    simple = odd[cores] == odd[np.minimum(starts + capital, cores)]
    return starts, cores, ends, codes, simple, capital, ENDING[final] & (cores < ends)


def templates(texts, cache):
    """(codes of all texts end to end in four readings, end of each text, slots of a text by its number).

    `texts` are bytes. One code a template token: words lose their punctuation and case, numbers
    become one placeholder, capitalised words another, a unit after or joined to a number a third.
    A capitalised word that begins a sentence may be a name or not: the first reading takes it as a
    plain word, the second as a name; the third takes all capitalised words as plain ones, the fourth
    has values in place of all placeholders. Common words are never names.
    The slots are ({place in the text: value} of the placeholders of the second reading, places of
    names, those of them that begin a sentence).
    Simple words are handled as arrays; only the others are looked at one by one.
    """
    text = b"\n".join(texts)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    starts, cores, stops, codes, simple, capital, closes = _simple_words(np.frombuffer(text, np.uint8))
    n = len(starts)
    firsts = np.searchsorted(starts, begins)             # first word of each text
    opens = np.append(False, closes)                     # whether a word begins a sentence
    opens[firsts] = True
    opening = set(firsts.tolist())
    if len(cache) > CACHE:
        cache.clear()
    odd = np.flatnonzero(~simple)
    last, number = -2, False
    sizes, found, slots, units = [], ([], [], [], []), {}, set()
    named, initial = set(), set()                        # (word, token) that may be a name, and begins a sentence
    for k, lo, hi in zip(odd.tolist(), starts[odd].tolist(), stops[odd].tolist()):
        raw = text[lo:hi]
        known = cache.get(raw)
        if known is None:
            known = cache[raw] = _analyse(raw.decode("utf-8", "replace"))
        inside, first, ends, unit = known
        begin = bool(opens[k])
        number = number and k == last + 1 and k not in opening
        if unit and number:
            tokens = inside = first = [_value(UNIT, raw.decode("utf-8", "replace").strip(EDGES).lower())]
            number = False
        else:
            tokens = first if begin else inside
            if tokens:
                number = tokens[-1][0] == NUM
        for j, readings in enumerate(zip(tokens, inside, first)):
            for line, (code, _, _) in zip(found, readings):
                line.append(code)
            found[3].append(readings[1][2])
            if readings[1][1] is not None:
                slots[k, j] = readings[1][1]
            if readings[1][0] == NAME:
                named.add((k, j))
                if begin:
                    initial.add((k, j))
        sizes.append(len(tokens))
        if k + 1 not in opening:
            opens[k + 1] = ends or (begin and not tokens)
        last = k
        if number and k + 1 < n and simple[k + 1] and k + 1 not in opening:
            after = text[starts[k + 1]:cores[k + 1]].decode().lower()
            if after in UNITS:
                units.add(k + 1)
                slots[k + 1, 0] = after
    names = simple & capital
    names[names] = ~_among(codes[names], COMMON_CODES)
    exact = codes
    if units:
        names[list(units)] = False
        exact = codes.copy()
        codes[list(units)] = UNIT
    counts = np.ones(n + 1, np.int64)
    counts[odd] = sizes
    counts[-1] = 0
    offsets = np.cumsum(counts) - counts                 # first token of each word, and the end of all
    sizes = np.array(sizes, np.int64)
    within = np.arange(len(found[0])) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    others = np.repeat(offsets[odd], sizes) + within
    lines = []
    for own, special in zip((np.where(names & ~opens[:n], np.uint64(NAME), codes), np.where(names, np.uint64(NAME), codes),
                             codes, exact), found):
        line = np.empty(int(counts.sum()), np.uint64)
        line[offsets[:-1][simple]] = own[simple]
        line[others] = np.array(special, np.uint64)
        lines.append(line)
    bounds = np.append(firsts, n)
    edges = offsets[bounds]

    def slots_of(i):
        lo, hi = bounds[i], bounds[i + 1]
        own, name_places, initial_places = {}, set(), set()
        for k in range(lo, hi):
            at = int(offsets[k] - edges[i])
            if names[k]:
                own[at] = text[starts[k]:cores[k]].decode()
                name_places.add(at)
                if opens[k]:
                    initial_places.add(at)
            for j in range(int(counts[k])):
                if (k, j) in slots:
                    own[at + j] = slots[k, j]
                    if (k, j) in named:
                        name_places.add(at + j)
                    if (k, j) in initial:
                        initial_places.add(at + j)
        return own, name_places, initial_places

    return lines, edges[1:], slots_of


def _among(codes, known):
    """Which codes are among sorted known ones."""
    return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes


def windows(codes, size):
    """64-bit hash of each window of `size` codes."""
    n = len(codes) - size + 1
    return _hashed([codes[i:i + n] for i in range(size)]) if n > 0 else np.empty(0, np.uint64)


def _hashed(columns):
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for column_ in columns:
        total ^= column_
        total *= np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
    return total


def _differing(one, two, size):
    """Whether each window differs in two readings."""
    sums = np.append(0, np.cumsum(one != two))
    return sums[size:] > sums[:-size]


def _literals(line, size):
    """Plain words of each window."""
    sums = np.append(0, np.cumsum(line > UNIT))
    return sums[size:] - sums[:-size]


def looked_up(lines, size):
    """[(places, hashes, hash of the window before)] of the windows to look up, a triple a reading.

    A window with LITERALS plain words counts in the first reading, and in the others where it
    differs from the ones before; windows with fewer even if all capitalised words are plain ones
    count with their values, so numbers and names alone match the same numbers and names only.
    The window before is 0 where it does not count in that reading.
    """
    n = len(lines[0]) - size + 1
    if n <= 0:
        return [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))] * 4
    plain = [_literals(line, size) >= LITERALS for line in lines[:3]]
    first, second = _differing(lines[0], lines[1], size), _differing(lines[0], lines[2], size)
    wanted = [plain[0], plain[1] & first, plain[2] & second & _differing(lines[1], lines[2], size), ~plain[2]]
    found = []
    for reading, (line, which) in enumerate(zip(lines, wanted)):
        places = np.flatnonzero(which)
        if len(places) > n // 2:
            hashes = windows(line, size)[places]
        else:
            hashes = _hashed([line[places + i] for i in range(size)]) if len(places) else np.empty(0, np.uint64)
        if reading == 3:
            hashes ^= np.uint64(STIR)
        before = np.zeros(len(places), np.uint64)
        follows = np.flatnonzero(np.diff(places) == 1) + 1
        before[follows] = hashes[follows - 1]
        found.append((places, hashes, before))
    return found


# ------------------------------------------------------------------------- matching

class Item:
    """Template of a benchmark item: codes in four readings, slots, and the size of its windows."""

    def __init__(self, lines, slots):
        self.lines, self.slots, self.n = lines, slots, len(lines[0])
        self.size, self.whole = min(WINDOW, self.n), self.n < SHORTEST
        self.literal, self.places = lines[0] > UNIT, sorted(slots[0])


def item_rows(texts):
    """(pickled template, windows as packed arrays, number of windows) of each text; None for one without a token."""
    rows = []
    for text in texts:
        lines, _, slots_of = templates([text or b""], {})
        if not len(lines[0]):
            rows.append((None, None, 0))
            continue
        item = Item([line.copy() for line in lines], slots_of(0))
        if item.whole:      # compared as a whole, with its values
            found = [(np.zeros(1, np.int64), windows(lines[3], item.n) ^ np.uint64(STIR), np.zeros(1, np.uint64))]
        else:
            found = looked_up(lines, item.size)
        places, hashes, before = (np.concatenate(x) for x in zip(*found))
        rows.append((pickle.dumps(item), pickle.dumps((places.astype(np.int32), hashes, before)), len(places)))
    return [list(x) for x in zip(*rows)] if rows else [[], [], []]


def index(rows):
    """Lookup of a block of items [(item_id, pickled template, pickled windows)]: (ids, templates, {(size, whole): table}).

    A table has the known hashes, where each begins in the entries, and the entries: hash of the
    window before, item number, place. The entries of a hash are in order of the window before.
    """
    items, parts = [], defaultdict(list)
    for number, (_, item, packed) in enumerate(rows):
        items.append(pickle.loads(item))
        places, hashes, before = pickle.loads(packed)
        parts[items[-1].size, items[-1].whole].append((hashes, before, np.full(len(places), number, np.int32), places))
    tables = {}
    for key, some in parts.items():
        hashes, before, owners, places = (np.concatenate(x) for x in zip(*some))
        order = np.lexsort((before, hashes))
        known, begins = np.unique(hashes[order], return_index=True)
        tables[key] = known, np.append(begins, len(order)), before[order], owners[order], places[order]
    return [r[0] for r in rows], items, tables


def starts(lines, ends, tables):
    """{text number: {item number: [(item place, text place, reading)]}}: where stretches that a text shares with an item begin.

    A place at which the windows before match as well continues a stretch and is passed over, so a
    hash that an item and a text hold many times costs its stretches, not all pairs of its places.
    """
    lengths = np.diff(ends, prepend=0)
    found = defaultdict(lambda: defaultdict(list))
    asked = {}
    for (size, whole), (known, begins, before, owners, places) in tables.items():
        if whole:
            at = ends[lengths == size] - size
            hashes = _hashed([lines[3][at + i] for i in range(size)]) ^ np.uint64(STIR) if len(at) else np.empty(0, np.uint64)
            readings = [(at, hashes, np.zeros(len(at), np.uint64))] if len(at) else []
        else:
            readings = asked.get(size) or asked.setdefault(size, looked_up(lines, size))
        for reading, (at, hashes, previous) in enumerate(readings):
            if not len(at):
                continue
            near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            equal = np.flatnonzero(known[near] == hashes)
            owner = np.searchsorted(ends, at[equal], side="right")
            inside = at[equal] + size <= ends[owner]
            for d, t, j, p in zip(at[equal][inside].tolist(), owner[inside].tolist(), near[equal][inside].tolist(),
                                  previous[equal][inside]):
                low, high = int(begins[j]), int(begins[j + 1])
                begin = int(ends[t] - lengths[t])
                skip = (low, low)
                if p and d > begin:
                    skip = (low + int(np.searchsorted(before[low:high], p)), low + int(np.searchsorted(before[low:high], p, "right")))
                for x in (*range(low, skip[0]), *range(skip[1], high)):
                    found[t][int(owners[x])].append((int(places[x]), d - begin, 3 if whole else reading))
    return found


def stretches(item, lines, begins):
    """Longest stretches (item place, text place, tokens, reading) of equal template tokens around the starts.

    A capitalised word of the item may stand for any name, or for the same word in whatever case.
    """
    known, found = {}, []
    n = len(lines[0])
    for i, d, reading in sorted(begins, key=lambda b: (b[2], b[1], b[0])):
        if known.get((reading, d - i), -1) >= d:        # inside a stretch that was found
            continue
        options, text = item.lines[:3] if reading < 3 else item.lines[3:], lines[reading]
        low, high = min(i, d), min(item.n - i, n - d)
        stop = i + _equal(text[d:d + high], [line[i:i + high] for line in options])
        start = i
        if low and any(text[d - 1] == line[i - 1] for line in options):
            start -= _equal(text[d - low:d][::-1], [line[i - low:i][::-1] for line in options])
        known[reading, d - i] = stop + d - i - 1
        found.append((start, start + d - i, stop - start, reading))
    return found


def _equal(text, options):
    """How many tokens from the first on are equal to one of the options."""
    equal = text == options[0]
    for line in options[1:]:
        equal |= text == line
    first = int(equal.argmin())
    return len(equal) if equal[first] else first


def consistent(item, stretch, slots):
    """[(item place, text place, tokens, {item value: text value})]: parts of a stretch that rename values one to one.

    A name that the text has as a plain word stands for itself. Parts are as long as can be and hold a window.
    """
    i, d, length, reading = stretch
    own, names, initial = item.slots
    values, doc_names, doc_initial = slots
    pairs = []
    for a, b in zip(range(i, i + length), range(d, d + length)):
        plain = b not in values or (b in doc_names and (reading == 2 or (reading == 0 and b in doc_initial)))
        if plain:
            pairs.append((own[a], own[a]) if a in names and a not in initial else None)
        else:
            pairs.append((own.get(a, values[b]), values[b]))
    found, there, back, begin = [], {}, {}, 0       # value -> (other value, last place that says so)
    for k, pair in enumerate(pairs):
        if pair is None:
            continue
        x, y = pair
        wrong = max((there[x][1] if x in there and there[x][0] != y else -1), (back[y][1] if y in back and back[y][0] != x else -1))
        if wrong >= begin:
            found.append((begin, k))
            begin = wrong + 1
        there[x], back[y] = (y, k), (x, k)
    found.append((begin, length))
    return [(i + lo, d + lo, hi - lo, dict(p for p in pairs[lo:hi] if p)) for lo, hi in found if hi - lo >= item.size]


def _evidence(item, part):
    """Which tokens of a part speak for the item: its plain words, and values that are the same in the text."""
    i, _, length, there = part
    mask = item.literal[i:i + length]
    if there is None:
        return np.ones(length, bool)        # at most
    if there:
        mask, own = mask.copy(), item.slots[0]
        for a in item.places[bisect_left(item.places, i):bisect_left(item.places, i + length)]:
            mask[a - i] |= there.get(own[a], "").lower() == own[a].lower()
    return mask


def _verdict(item, parts):
    """(coverage, longest run) of parts that fit each other, or None if they are too few.

    The coverage is that of the plain words and equal values; all tokens count in an item of few plain words.
    """
    seen, run = np.zeros(item.n, bool), 0
    for part in parts:
        i, _, length, _ = part
        mask = _evidence(item, part)
        seen[i:i + length] |= mask
        if length > run and (length < RUN or mask.sum() >= FEWEST):
            run = length
    words = int(seen.sum())
    total = int((seen | item.literal).sum()) if item.literal.sum() >= FEWEST else item.n
    few = min(FEWEST, item.n)
    return (words / total, run) if words >= few and (words >= COVERAGE * total or run >= RUN) else None


def _alignments(item, parts):
    """Sets of parts that fit one renaming, each with the renaming.

    Every part that no set has yet begins another, the longest first; the parts near it in the text, by
    the distance of their diagonal, join if they give no value a second meaning. So a copy is complete
    before anything else in the text is looked at.
    """
    reach = 4 * item.n + 64
    by_place = sorted(range(len(parts)), key=lambda x: parts[x][1])
    line = [parts[x][1] for x in by_place]
    used = set()
    for x in sorted(range(len(parts)), key=lambda x: (-parts[x][2], parts[x][1])):
        if x in used:
            continue
        i, d, _, _ = parts[x]
        near = by_place[bisect_left(line, d - reach):bisect_right(line, d + reach)]
        there, back, kept = {}, {}, []
        for y in [x, *sorted(near, key=lambda y: (abs(parts[y][1] - parts[y][0] - d + i), abs(parts[y][1] - d), y))]:
            own = parts[y][3]
            if y not in kept[:1] and all(there.get(a, b) == b and back.get(b, a) == a for a, b in own.items()):
                there.update(own)
                back.update((b, a) for a, b in own.items())
                kept.append(y)
        used.update(kept)
        yield [parts[y] for y in kept], there


def match(item, lines, begins, slots):
    """(matched windows, coverage, longest run, changed slots) if a text holds the item, else None.

    Plain words count, and values that are the same. Others may differ, if they are renamed one to one.
    """
    found = stretches(item, lines, begins)
    if _verdict(item, [(*s[:3], None) for s in found]) is None:      # even if nothing contradicted and all values were equal
        return None
    held, best, parts, equal = slots(), None, {}, {}
    values, numbers = sorted(held[0]), sorted(set(held[0]) - held[1])
    for stretch in found:
        i, d, length, reading = stretch
        if not _within(item.places, i, i + length) and not _within(values, d, d + length):
            some = [(i, d, length, {})]
        elif reading == 3 or (reading == 2 and not _within(numbers, d, d + length)):     # the same words and values
            if (i, length) not in equal:
                own = [item.slots[0][a] for a in item.places if i <= a < i + length]
                equal[i, length] = dict(zip(own, own))
            some = [(i, d, length, equal[i, length])]
        else:
            some = consistent(item, stretch, held)
        for part in some:
            # the same words with the same values are the same evidence; copies far apart are told apart
            parts.setdefault((part[0], part[2], frozenset(part[3].items()), part[1] // (4 * item.n + 64)), part)
    parts = list(parts.values())
    if _verdict(item, [(*p[:3], None) for p in parts]) is None:
        return None
    for chosen, there in _alignments(item, parts):
        share = _verdict(item, chosen)
        if share is not None and (best is None or share > best[1:3]):
            best = (_window_count(item, chosen), *share, sum(a != b for a, b in there.items()))
            if share[0] == 1.0:
                break
    return best


def _within(places, low, high):
    return bisect_left(places, low) < bisect_left(places, high)


def _window_count(item, parts):
    """Windows of the item that lie in a part."""
    seen = np.zeros(item.n, bool)
    for i, _, length, _ in parts:
        seen[i:i + length - item.size + 1] = True
    return int(seen.sum())


def contaminated(docs, benchmark, text="text", doc_id="doc_id"):
    """Pairs of a document and a benchmark item found in it: doc_id, item_id, matched_windows, coverage,
    longest_run and changed_slots (values of the item that stand for others in the document).

    Items become templates in tasks, with a table of window hashes. Documents are hash-joined with that
    table, a block of whole items with about BLOCK_WINDOWS windows (counted) at a time: each block goes to
    every task and is one pass over the documents, which are read whole; nothing but the result is shuffled.

    A window needs LITERALS plain words, else it is compared with its values: numbers or names alone
    match the same numbers or names. Equal windows are grown to stretches. A pair is reported when
    stretches whose values can be renamed one to one cover COVERAGE of the item's plain words and equal
    values, or RUN tokens in a row, and FEWEST plain words or equal values in any case. A capitalised word at the start of a sentence is looked up as a name and
    as a plain word, and windows also match by their plain words, whatever their case. Items
    shorter than a window are one window; under SHORTEST tokens they match only a document that is
    nothing else. Stretches that contradict each other are read apart, so a chance hit hides no copy
    elsewhere in the document.

    Null and empty texts match nothing, empty tables give no pair. Repeated documents or items give a pair
    each time; a null id is reported as null. Long texts of few words cost what their stretches cost.
    """
    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    items = benchmark.select(column("item_id").alias("item_id"), column("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    made = per_text(items, "text", item_rows, "item binary, windows binary, size bigint", ["item_id"], binary=True)
    made = materialize(made.filter(F.col("size") > 0))
    numbered = ordered.running_totals(made, [F.xxhash64("item")], {"end": "size"}, bounded=False)
    blocked = materialize(numbered.select("item_id", "item", "windows", F.expr(f"(end - size) div {BLOCK_WINDOWS}").alias("block")))
    last = blocked.agg(F.max("block")).first()[0]
    results = None
    for block in range(0 if last is None else last + 1):
        part = blocked.filter(F.col("block") == block).select("item_id", "item", "windows").collect()
        if not part:        # a long item fills several blocks
            continue
        shared = docs.sparkSession.sparkContext.broadcast(index([tuple(r) for r in part]))

        def run(texts, shared=shared, cache={}):     # the cache of words lasts for a task  # noqa: B006
            ids, known, tables = shared.value
            lines, ends, slots_of = templates([t or b"" for t in texts], cache)
            found = starts(lines, ends, tables)
            return [[[r for item, begins in found[t].items()
                      for r in [_pair(ids[item], known[item], lines, ends, t, begins, slots_of)] if r] if t in found else []
                     for t in range(len(texts))]]

        pairs = per_text(rows, "text", run, f"found array<struct<item_id:{kind},matched_windows:int,coverage:double,"
                                            "longest_run:int,changed_slots:int>>", carry=["doc_id"], binary=True,
                         limit=PIECE)
        pairs = pairs.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
        results = pairs if results is None else results.unionByName(pairs)
    if results is None:
        return rows.select("doc_id").limit(0).select(
            "doc_id", F.lit(None).cast(kind).alias("item_id"), F.lit(0).alias("matched_windows"),
            F.lit(0.0).alias("coverage"), F.lit(0).alias("longest_run"), F.lit(0).alias("changed_slots"))
    return results


def _pair(item_id, item, lines, ends, t, begins, slots_of):
    """The row of a document and an item, or None."""
    begin = int(ends[t - 1]) if t else 0
    found = match(item, [line[begin:ends[t]] for line in lines], begins, lambda: slots_of(t))
    return found and dict(zip(("item_id", "matched_windows", "coverage", "longest_run", "changed_slots"), (item_id, *found)))


def drop_contaminated(docs, benchmark):
    """The rows of `docs` in which no benchmark item is found, with the same columns."""
    frame, place, back = neutral(docs)
    keyed = frame.withColumn("row", F.struct(F.col(place["doc_id"]), F.xxhash64(F.col(place["text"]))))
    found = contaminated(keyed.select("row", F.col(place["text"]).alias("text")), benchmark, doc_id="row")
    gone = materialize(found.select(F.col("doc_id").alias("gone")).distinct())
    return keyed.join(small(gone, FETCH_ROWS), F.col("row").eqNullSafe(F.col("gone")), "left_anti").select(*back)
