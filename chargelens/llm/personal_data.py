"""Personal data: known shapes, and further spans that several weak labelers vote for. Built-in expressions only."""

import math

from pyspark.sql import functions as F

from .common import carried, column, free_name, materialize

KINDS = ("email", "ip", "card", "phone", "number", "person")
BASE = KINDS[:4]

# Patterns of the known shapes. They match what the plain patterns of the docstring of `find` match, but
# in one step a character and without nested repetition, so that no text makes them slow or deep.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
             r"[A-Za-z0-9.-]*?(?=\.\.|\.?(?![A-Za-z0-9.-]))",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?=(?:[\x20-]?[0-9]){12})[0-9\x20-]*?(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of a kind holds; texts without it are not searched.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
          "number": r"[0-9][\x20().-]{0,2}[0-9]", "person": r"\p{Lu}\p{Ll}++\x20\p{Lu}\p{Ll}"}
#: Candidates: numbers with short gaps between digits; two or three capitalised words.
CANDIDATES = {
    "number": r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?=(?:[\x20().-]{0,2}[0-9]){6})[0-9\x20().-]*?(?![\x20().-]{0,2}[0-9])",
    "person": r"(?<!\p{L})(?!(?:Dear|Mrs?|Ms|Dr|Prof|Herrn?|Frau|Señora?|Sra?|Don|Doña|Monsieur|Madame|Mme|Mlle|Lieber?|Ch[eè]re?|"
              r"Querid[oa]|Contact|Author|Name|Nombre|Nom|Signed|From|By)\x20)\p{Lu}\p{Ll}{1,20}\x20\p{Lu}\p{Ll}{1,20}(?:\x20\p{Lu}\p{Ll}{1,20})?(?!\p{L})",
}
FEWEST, MOST = 7, 19        # digits of a candidate number
BEFORE, AFTER = 32, 12      # characters of context

# Gazetteers, in lower case.
GIVEN_NAMES = """alice anna anne antonio barbara carlos carmen catherine charles christine claire daniel david elena elizabeth emma
francois frank george hans heinrich helen henry isabel jack jacques james jane jean jennifer john jorge jose joseph juan julia karl
katharina klaus laura linda lisa louis luis lukas manuel maria marie mark martin mary michael michel miguel monika nicolas nicole
patricia paul pedro peter pierre rafael richard robert rosa sabine sarah sofia sophie stefan susan teresa thomas ursula william
wolfgang""".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 354 358 359 380 420".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|35)"
NOT_PERSONS = """the this that these and but for from with new north south east west great street road avenue square city river lake
island mount university college school hospital church street monday tuesday wednesday thursday friday saturday sunday january
february march april may june july august september october november december der die das und ein eine los las el una les des une
est""".split()
SURNAMES = r"(?i:.(?:son|sen|mann|stein|meyer|rez|nez|mez|ski|ova)|smith|schmidt|bauer|m[üu]ller|weber|garc[íi]a|martin|durand|dubois|brown|jones)$"
TITLES = r"(?i:\b(?:mrs?|ms|dr|prof|herrn?|frau|señora?|sra?|don|doña|monsieur|madame|mme|mlle)\.?\x20)$"
ROLES = r"(?i:\b(?:author|by|contact|dear|name|signed|regards|sincerely|autor|nombre|nom|auteur|liebe[r]?|cher|chère|querid[oa])\W{1,3})$"
PRIVATE = (r"(?i:\b(?:phone|tel|telephone|mobile|cell|call|fax|card|visa|mastercard|account|iban|ssn|passport|contact|whatsapp|"
           r"telefon|handy|karte|konto|tarjeta|cuenta|tel[ée]fono|carte|compte|t[ée]l[ée]phone)\b[^\n0-9]{0,16})$")
PUBLIC = (r"(?i:\b(?:order|invoice|isbn|issn|doi|version|page|ref|reference|serial|part|model|lot|sku|build|commit|"
          r"bestellung|rechnung|pedido|factura|commande|facture)\b[^\n0-9]{0,16}|[$€£#=]\x20?)$")

# ------------------------------------------------------------ array expressions

SCAN = 256      # elements whose results are appended one by one before they are appended together


def let(value, body):
    """`body` of a value that is evaluated once, however often the body uses it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def scan(array, zero, step, state, out):
    """The results of `step(state, element) -> (state, result)` along an array; types in DDL.

    Appending to an array copies it, so results are gathered SCAN at a time.
    """
    none = F.array().cast(f"array<{out}>")

    def one(acc, x):
        new, result = step(acc["state"], x)
        return F.struct(new.cast(state).alias("state"), F.concat(acc["out"], F.array(result.cast(out))).alias("out"))

    def some(values, begin):
        return F.aggregate(values, F.struct(begin.alias("state"), none.alias("out")), one)

    def whole(values):
        return F.aggregate(
            F.sequence(F.lit(1), F.size(values), F.lit(SCAN)),
            F.struct(zero.cast(state).alias("state"), F.array().cast(f"array<array<{out}>>").alias("out")),
            lambda acc, at: let(some(F.slice(values, at, F.lit(SCAN)), acc["state"]), lambda r: F.struct(
                r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out"))),
            lambda acc: F.flatten(acc["out"]))

    return F.when(F.size(array) > 0, let(array, whole)).otherwise(none)


MATCH = "struct<start:int,end:int,match:string,before:string,after:string>"


def matches(text, pattern, needed):
    """Matches of a pattern with their places and the characters around them, up to the next match."""
    def placed(both):
        found, gaps = both["found"], both["gaps"]
        rows = F.arrays_zip(found.alias("match"), F.slice(gaps, F.lit(1), F.size(found)).alias("before"),
                            F.slice(gaps, F.lit(2), F.size(found)).alias("after"))

        def step(at, x):
            start = at + F.length(x["before"])
            end = start + F.length(x["match"])
            return end, F.struct(start, end, x["match"], F.right(x["before"], F.lit(BEFORE)), F.left(x["after"], F.lit(AFTER)))

        return scan(rows, F.lit(0), step, "int", MATCH)

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                    F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(needed), let(both, placed)).otherwise(F.array().cast(f"array<{MATCH}>"))


def digits(text):
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number):
    """Whether the check digit of a string of digits is right."""
    def add(total, i):
        value = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + value - F.when(value > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def _valid(kind, match):
    """Whether a match of a known shape stands."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda v: (F.length(v) < 3) | (
            (F.length(v) == 3) & (v <= "255"))))
    if kind == "card":
        return let(digits(match), lambda d: F.length(d).between(13, 19) & luhn(d))
    return F.length(digits(match)).between(9, 15)


# ---------------------------------------------------------- labelers and features

def _one_of(word, names):
    return F.lower(word).isin(*names)


def labelers(family):
    """(name, vote) of the labelers of a family: vote(candidate) is 1 for personal data, 2 against, 0 for no vote."""
    if family == "number":
        length = lambda c: F.length(c["digits"])
        return [
            ("check digit", lambda c: F.when(length(c).between(13, 19), F.when(luhn(c["digits"]), 1).otherwise(2))),
            ("issuer", lambda c: F.when(length(c).between(13, 19), F.when(~c["digits"].rlike(ISSUERS), 2))),
            ("calling code", lambda c: F.when(c["match"].startswith("+"), F.when(
                c["digits"].rlike(f"^(?:{'|'.join(CALLING_CODES)})") & length(c).between(9, 15), 1).otherwise(2))),
            ("telephone groups", lambda c: F.when(c["match"].rlike(
                r"^(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{3,4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), 1)),
            ("private context", lambda c: F.when(c["before"].rlike(PRIVATE), 1)),
            ("public context", lambda c: F.when(c["before"].rlike(PUBLIC) | c["after"].rlike(r"^(?:[A-Za-z_]|\x20?[€$%])"), 2)),
            ("date or amount", lambda c: F.when(c["match"].rlike(
                r"^(?:19|20)[0-9]{2}[-./][01]?[0-9]|^[0-3]?[0-9][-./][01]?[0-9][-./](?:19|20)[0-9]{2}|"
                r"^[0-9]{1,3}(?:\.[0-9]{3}){2,6}$|^[0-9]+\.[0-9]+$|^(?:[0-9]{1,2}[\x20.-]){5}"), 2)),
        ]
    first, last = (lambda c: F.substring_index(c["match"], " ", 1)), (lambda c: F.substring_index(c["match"], " ", -1))
    return [
        ("given name", lambda c: F.when(_one_of(first(c), GIVEN_NAMES), 1)),
        ("surname", lambda c: F.when(last(c).rlike(SURNAMES), 1)),
        ("title", lambda c: F.when(c["before"].rlike(TITLES), 1)),
        ("role", lambda c: F.when(c["before"].rlike(ROLES), 1)),
        ("sentence start", lambda c: F.when(c["before"].rlike(r"(?:^|[.!?:]\s*|\n\s*)$"), 2)),
        ("no person", lambda c: F.when(F.exists(F.split(c["match"], " "), lambda w: _one_of(w, NOT_PERSONS)), 2)),
        ("repeated word", lambda c: F.when(first(c) == last(c), 2)),
        ("no name known", lambda c: F.when(~_one_of(first(c), GIVEN_NAMES) & ~last(c).rlike(SURNAMES), 2)),
    ]


def features(family):
    """Yes-or-no features of a candidate for the final classifier."""
    if family == "number":
        n = lambda c: F.length(c["digits"])
        return [lambda c: n(c) <= 8, lambda c: n(c).between(9, 12), lambda c: n(c).between(13, 19),
                lambda c: c["match"].startswith("+"), lambda c: c["match"].contains("("),
                lambda c: c["match"].contains("-"), lambda c: c["match"].contains("."), lambda c: c["match"].contains(" "),
                lambda c: F.when(n(c).between(13, 19), luhn(c["digits"])).otherwise(F.lit(False)),
                lambda c: c["before"].rlike(PRIVATE), lambda c: c["before"].rlike(PUBLIC),
                lambda c: c["match"].rlike(r"^(?:[0-9]{1,2}[\x20.-]){3}|^(?:19|20)[0-9]{2}[-./]")]
    first, last = (lambda c: F.substring_index(c["match"], " ", 1)), (lambda c: F.substring_index(c["match"], " ", -1))
    return [lambda c: _one_of(first(c), GIVEN_NAMES), lambda c: last(c).rlike(SURNAMES),
            lambda c: c["before"].rlike(TITLES), lambda c: c["before"].rlike(ROLES),
            lambda c: c["before"].rlike(r"(?:^|[.!?:]\s*|\n\s*)$"),
            lambda c: F.exists(F.split(c["match"], " "), lambda w: _one_of(w, NOT_PERSONS)),
            lambda c: c["match"].rlike(r"\x20.*\x20"), lambda c: c["after"].rlike(r"^[,.]"),
            lambda c: F.length(c["match"]) > 16]


def _code(parts, base):
    """One whole number for small numbers, `base` possible values each."""
    total = F.lit(0)
    for i, part in enumerate(parts):
        total = total + F.coalesce(part.cast("int"), F.lit(0)) * base ** i
    return total


CANDIDATE = "struct<family:int,start:int,end:int,known:boolean,votes:int,shape:int>"
EDGES = "array<struct<start:int,end:int,match:string,before:string,after:string,known:boolean>>"


def _marked(found, known):
    """Candidates with `known`: whether they overlap a span of `known`."""
    kind = EDGES[6:-1]
    given = F.transform(known, lambda s: F.struct(s["start"], s["end"], F.lit(None), F.lit(None), F.lit(None), F.lit(True)).cast(kind))
    asked = F.transform(found, lambda s: F.struct(s["start"], s["end"], s["match"], s["before"], s["after"],
                                                  F.lit(False)).cast(kind))

    def forward(end, x):
        given = x["match"].isNull()
        return (F.when(given, F.greatest(end, x["end"])).otherwise(end),
                F.struct(x["start"], x["end"], x["match"], x["before"], x["after"], x["known"] | (end > x["start"])))

    def backward(start, x):
        given = x["match"].isNull()
        return (F.when(given, F.least(start, x["start"])).otherwise(start),
                F.struct(x["start"], x["end"], x["match"], x["before"], x["after"], x["known"] | (start < x["end"])))

    line = scan(F.array_sort(F.concat(given, asked)), F.lit(0), forward, "int", kind)
    line = scan(F.reverse(line), F.lit(2**31 - 1), backward, "int", kind)
    return F.filter(line, lambda x: x["match"].isNotNull())


def _judged(family, found):
    """Candidates with their votes and features as whole numbers."""
    def judge(c):
        wide = F.struct(c["start"], c["end"], c["known"], c["match"].alias("match"), c["before"].alias("before"),
                        c["after"].alias("after"), digits(c["match"]).alias("digits"))
        return let(wide, lambda w: F.struct(
            F.lit(KINDS.index(family)), w["start"], w["end"], w["known"],
            _code([vote(w) for _, vote in labelers(family)], 3),
            _code([has(w) for has in features(family)], 2)).cast(CANDIDATE))

    return F.transform(found, judge)


def _known(kind, text):
    """Spans of a known kind."""
    good = F.filter(matches(text, PATTERNS[kind], NEEDED[kind]), lambda m: _valid(kind, m["match"]))
    return F.transform(good, lambda m: F.struct(m["start"], m["end"])).cast("array<struct<start:int,end:int>>")


def _candidates(family, found, known):
    """Votes on the candidates of a family and their features; nothing is evaluated for texts without one."""
    return F.when(F.size(found) > 0, let(F.struct(found.alias("found"), known.alias("known")),
                                         lambda s: _judged(family, _marked(s["found"], s["known"])))
                  ).otherwise(F.array().cast(f"array<{CANDIDATE}>"))


def find(df, text="text", carry=None):
    """Carried columns plus one array of spans a known kind, and candidates.

    Known: email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`; ip, four numbers of 255 at
    most; card, 13 to 19 digits with single blanks or dashes between and a right check digit; phone,
    a plus and 9 to 15 digits. Each kind leftmost and without overlap; matches that fail are dropped
    and not tried again. Places are code points, end exclusive. Each kind is one search of the text.
    """
    keep = carried(df, carry, [*BASE, "candidates"])
    name = free_name("_text", keep)
    rows = df.select(*[column(c) for c in keep], F.coalesce(column(text).cast("string"), F.lit("")).alias(name))
    source = column(name)
    rows = rows.withColumns({kind: _known(kind, source) for kind in BASE})
    numbers = F.filter(matches(source, CANDIDATES["number"], NEEDED["number"]),
                       lambda m: F.length(digits(m["match"])).between(FEWEST, MOST))
    persons = matches(source, CANDIDATES["person"], NEEDED["person"])
    known = F.concat(*[column(k) for k in BASE])
    found = [_candidates("number", F.col("_numbers"), known), _candidates("person", F.col("_persons"), known)]
    rows = rows.withColumns({"_numbers": numbers, "_persons": persons})
    return rows.withColumn("candidates", F.concat(*found)).select(*[column(c) for c in keep], *BASE, "candidates")


# -------------------------------------------------------- what the votes are worth

ROUNDS, PRIOR = 60, 0.02        # rounds of estimation; weight of the prior as a share of the candidates
SHARE = 0.05                    # prior share of personal data: one vote alone is not enough
BELIEF = {1: (0.30, 0.65, 0.05), 0: (0.05, 0.65, 0.30)}     # prior share of votes for, none, against, by class


def estimate(counts, voters):
    """Share of personal data and each labeler's chances, from {votes (0, 1 or 2 each): candidates}.

    Expectation-maximisation of a model in which labelers vote independently of each other given the
    class. Every labeler begins with the chances in BELIEF, and keeps them as a prior. Returns
    (share, {class: [(no vote, for, against) a labeler]}); deterministic.
    """
    total = sum(counts.values())
    strength = 20 + PRIOR * total
    start = {z: [(n, f, a)] * voters for z, (f, n, a) in BELIEF.items()}
    share, chances = SHARE, start
    for _ in range(ROUNDS):
        held = {1: [[0.0] * 3 for _ in range(voters)], 0: [[0.0] * 3 for _ in range(voters)]}
        mass = 0.0
        for votes, n in sorted(counts.items()):
            p = posterior(votes, share, chances)
            mass += n * p
            for z, part in ((1, n * p), (0, n * (1 - p))):
                for row, vote in zip(held[z], votes):
                    row[vote] += part
        share = (mass + SHARE * strength) / (total + strength)
        chances = {z: [tuple((row[v] + strength * prior[v]) / (sum(row) + strength) for v in range(3))
                       for row, prior in zip(held[z], start[z])] for z in (0, 1)}
    return share, chances


def posterior(votes, share, chances):
    odds = math.log(share) - math.log(1 - share)
    for yes, no, vote in zip(chances[1], chances[0], votes):
        odds += math.log(yes[vote]) - math.log(no[vote])
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def fit_logistic(rows, width, ridge=1.0, rounds=30):
    """Weights (the constant first) of a logistic regression on soft labels.

    `rows` holds (features as 0 and 1, candidates, sum of their posteriors). Newton's method with a
    ridge penalty, on one row a feature pattern.
    """
    weights = [0.0] * (width + 1)
    lines = [([i for i, x in enumerate((1, *features)) if x], n, mass) for features, n, mass in rows]
    for _ in range(rounds):
        slope = [-ridge * w for w in weights]
        curve = [[ridge if i == j else 0.0 for j in range(width + 1)] for i in range(width + 1)]
        for on, n, mass in lines:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[i] for i in on)))))
            for i in on:
                slope[i] += mass - n * p
                for j in on:
                    curve[i][j] += n * p * (1 - p)
        step = _solve(curve, slope)
        weights = [w + max(-4.0, min(4.0, s)) for w, s in zip(weights, step)]
        if max(map(abs, step)) < 1e-9:
            break
    return weights


def _solve(matrix, right):
    """Solution of a small system of linear equations with a positive definite matrix."""
    a = [[*row, r] for row, r in zip(matrix, right)]
    n = len(a)
    for i in range(n):
        top = max(range(i, n), key=lambda k: abs(a[k][i]))
        a[i], a[top] = a[top], a[i]
        for k in range(i + 1, n):
            f = a[k][i] / a[i][i]
            a[k] = [x - f * y for x, y in zip(a[k], a[i])]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (a[i][n] - sum(a[i][k] * out[k] for k in range(i + 1, n))) / a[i][i]
    return out


def _parts(code, base, width):
    return tuple(code // base ** i % base for i in range(width))


def _table(values):
    """A constant array of doubles."""
    return F.expr("array(" + ",".join(f"{v:.12e}D" for v in values) + ")")


def learn(found):
    """{family: score of every feature pattern}, from the candidates of all texts.

    At most 3 ** labelers vote patterns and 2 ** features feature patterns of each family come to
    the driver as counts, however many candidates there are.
    """
    each = materialize(found.select(F.explode("candidates").alias("c")).groupBy("c.family", "c.votes", "c.shape")
                       .agg(F.count(F.lit(1)).alias("n")))
    scores = {}
    for family in CANDIDATES:
        mine = each.filter(F.col("family") == KINDS.index(family))
        voters, width = len(labelers(family)), len(features(family))
        counts = {_parts(r["votes"], 3, voters): r["n"] for r in mine.groupBy("votes").agg(F.sum("n").alias("n")).collect()}
        if not counts:
            scores[family] = [0.0] * 2 ** width
            continue
        share, chances = estimate(counts, voters)
        belief = _table(posterior(_parts(v, 3, voters), share, chances) for v in range(3 ** voters))
        shapes = (mine.withColumn("p", F.element_at(belief, F.col("votes") + 1)).groupBy("shape")
                  .agg(F.sum("n").alias("n"), F.sum(F.round(F.col("n") * F.col("p"), 6).cast("decimal(38,6)")).alias("mass")).collect())
        weights = fit_logistic(sorted((_parts(r["shape"], 2, width), r["n"], float(r["mass"])) for r in shapes), width)
        scores[family] = [1 / (1 + math.exp(-max(-700.0, min(700.0, weights[0] + sum(
            w for w, x in zip(weights[1:], _parts(s, 2, width)) if x))))) for s in range(2 ** width)]
    return scores


LEAST = 0.5
SPANS = "array<struct<kind:int,start:int,end:int,score:double>>"


def _scored(number, kind):
    return F.transform(kind, lambda s: F.struct(F.lit(number), s["start"], s["end"], F.lit(1.0)))


def detect(df, text="text", carry=None):
    """Carried columns plus n_email, n_ip, n_card, n_phone and spans (kind, start, end, score).

    `spans` holds the known shapes (see `find`), whose score is 1, and the candidates (numbers of
    FEWEST to MOST digits, capitalised names) that overlap none of them and whose score is LEAST or
    more, by kind as in KINDS, then start. Labelers (shapes and check digits, gazetteers, context)
    vote on every candidate; expectation-maximisation over the vote counts of all texts estimates
    how reliable they are; a logistic classifier over features of the span is fitted to the
    posteriors and gives the score. Numbers of a known shape are candidates too, so that the estimation
    learns from them, but they are reported once.

    Whole texts are searched, once. A null text is empty. Repeated rows are judged alike, an empty
    table gives an empty one, and carried columns that clash with a result give way to it. Nothing
    but counts by pattern is shuffled.
    """
    results = [*(f"n_{k}" for k in BASE), "spans"]
    keep = carried(df, carry, results)
    neutral = {c: f"c{i}" for i, c in enumerate(keep)}
    rows = df.select(*[column(c).alias(n) for c, n in neutral.items()], column(text).alias("text"))
    found = materialize(find(rows, "text", list(neutral.values())))
    scores = learn(found)
    known = [_scored(i, kind) for i, kind in enumerate(BASE)]
    judged = F.filter("candidates", lambda c: ~c["known"])
    tables = {f: _table(scores[f]) for f in CANDIDATES}
    score = lambda c: F.when(c["family"] == KINDS.index("number"), F.element_at(tables["number"], c["shape"] + 1)).otherwise(
        F.element_at(tables["person"], F.least(c["shape"], F.lit(len(scores["person"]) - 1)) + 1))
    added = F.filter(F.transform(judged, lambda c: F.struct(c["family"], c["start"], c["end"], score(c)).cast(SPANS[6:-1])),
                     lambda s: s["score"] >= LEAST)
    return found.select(*[F.col(n).alias(c) for c, n in neutral.items()],
                        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                        F.concat(*[k.cast(SPANS) for k in known], F.array_sort(added)).alias("spans"))


def digest(spans):
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect_documents(docs):
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return (detect(docs.select(column("doc_id"), column("text")), carry=["doc_id"])
            .select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"),
                    digest(F.col("spans")).alias("spans")))
