"""URL filters: pattern rules found through their rarest literal token, in built-in expressions only."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, materialize

TOKEN = r"[A-Za-z0-9]+"
INDEX_BYTES = 8 << 20    # a rule index up to this size is broadcast, a larger one is joined by shuffle
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Rules (action, host, path) of the query.
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

# Pattern rules for urls that no host rule fits: (action, name, literal tokens that any match
# contains as whole tokens, regular expression over the url from its first :// on, with its host in lower case).
PATTERN_RULES = [
    ("block", "casino label", ["casino"], r"^://([^/?#]*[.-])?casino[.-]"),
    ("block", "login page", ["login"], r"/login([/.?#]|\z)"),
    ("block", "cart page", ["cart"], r"/cart([/.?#]|\z)"),
    ("block", "tag listing", ["tag"], r"/tag/"),
    ("block", "feed reader", ["utm", "source", "feed"], r"[?&]utm_source=feed(&|#|\z)"),
    ("block", "session in query", ["sessionid"], r"[?&;]sessionid="),
    ("block", "result page", ["page", "ref"], r"[?&]page=[0-9]+&ref="),
]


def host_rule(action, host, path):
    """A pattern rule for a host with its subdomains and a path prefix."""
    whole = path if path.endswith("/") else path[:max(path.rfind("/"), 0) + 1]
    tokens = [t for t in _tokens(host + whole)]
    return (action, host + path, tokens, rf"^://([^/?#]*\.)?{_literal(host)}{_literal(path)}")


def _tokens(text):
    import re

    return re.findall(TOKEN, text)


def _literal(text):
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def parts(url):
    """(host, path) columns: host after the first :// in lower case A-Z, path up to ? or #; else empty."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), *LETTERS)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _normal(url):
    """The url from its first :// on, with the host in lower case, which rules are matched against.

    What comes before may hold anything, colons included. A url without :// stays as it is.
    """
    host, _ = parts(url)
    at = F.instr(url, "://")
    return F.when(at > 0, F.concat(F.lit("://"), host, F.substr(url, at + 3 + F.length(host)))).otherwise(url)


def match(urls, rules, url="url"):
    """Longest rule that fits each distinct url: url, action, rule, tier.

    `rules` is a list of (tier, action, name, tokens, regex): lower tiers win, then longer names,
    then the name itself. Each rule is filed under the one of its tokens that the fewest urls have;
    the tokens of a url fetch its candidates from that index, and only candidates run their regular
    expression. Rules without a token are tried on every url. Urls without a match are left out,
    null urls too. Equal urls are matched once; token counts are combined before the shuffle.
    """
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r[3]})
    distinct = materialize(urls.select(column(url).alias("url")).filter(F.col("url").isNotNull()).distinct()
                           .withColumn("target", _normal(F.col("url"))))
    tokened = distinct.withColumn("token", F.explode(F.array_distinct(
        F.regexp_extract_all("target", F.lit(TOKEN), F.lit(0)))))
    listed = spark.createDataFrame([(t,) for t in wanted], "token string")
    # one row a token of the rules
    counts = {r["token"]: r["count"] for r in
              tokened.join(_sized(listed, wanted), "token").groupBy("token").count().collect()} if wanted else {}
    fields = T.StructType.fromDDL(
        "token string, tier int, action string, rule string, regex string")
    index = [(min(tokens, key=lambda t: (counts.get(t, 0), t)) if tokens else None, tier, action, name, regex)
             for tier, action, name, tokens, regex in rules]
    keyed = spark.createDataFrame([r for r in index if r[0] is not None], fields)
    hits = (tokened.join(_sized(keyed, index), "token")
            .filter(F.expr("target rlike regex")).select("url", "tier", "action", "rule"))
    for _, tier, action, name, regex in (r for r in index if r[0] is None):
        hits = hits.unionByName(distinct.filter(F.col("target").rlike(regex)).select(
            "url", F.lit(tier).alias("tier"), F.lit(action).alias("action"), F.lit(name).alias("rule")))
    best = F.min(F.struct("tier", (-F.length("rule")).alias("_l"), "rule", "action")).alias("_best")
    return hits.groupBy("url").agg(best).select("url", "_best.action", "_best.rule", "_best.tier")


def _sized(frame, rows):
    """The frame, broadcast if the Python rows it was made of are few bytes."""
    size = sum(sum(len(str(v)) for v in (r if isinstance(r, tuple) else (r,))) for r in rows)
    return F.broadcast(frame) if size <= INDEX_BYTES else frame


def judge(pages, host_rules=HOST_RULES, patterns=PATTERN_RULES, url="url", carry=("page_id",)):
    """Carried columns plus host, path, rule, pattern and verdict for every row.

    The longest host rule that fits decides and is named in `rule`. Where none fits, a pattern rule
    decides, is named in `pattern`, and urls that no pattern fits are allowed. A null url, or one
    without ://, has an empty host and path and is allowed unless a pattern fits. Repeated rows are
    kept. Carried columns that clash with a result are replaced.
    """
    results = {"host", "path", "rule", "pattern", "verdict"}
    keep = [c for c in carry if c.lower() not in results]
    rules = [(0, *host_rule(*r)) for r in host_rules] + [(1, *r) for r in patterns]
    found = materialize(match(pages, rules, url)).withColumnRenamed("url", "_matched")
    host, path = parts(column(url))
    rows = pages.select(*[column(c) for c in keep], column(url).alias("_url"),
                        host.alias("host"), path.alias("path"))
    named = rows.filter(F.col("_url").isNotNull()).join(found, F.col("_url") == F.col("_matched"), "left")
    unnamed = rows.filter(F.col("_url").isNull()).withColumns(   # null keys would all meet in one task
        {"_matched": F.lit(None).cast("string"), "action": F.lit(None).cast("string"),
         "rule": F.lit(None).cast("string"), "tier": F.lit(None).cast("int")})
    both = named.unionByName(unnamed)
    return both.select(
        *[column(c) for c in keep], "host", "path",
        F.when(F.col("tier") == 0, F.col("rule")).alias("rule"),
        F.when(F.col("tier") == 1, F.col("rule")).alias("pattern"),
        F.coalesce("action", F.lit("allow")).alias("verdict"))


def oracle_sql(host_rules=HOST_RULES, patterns=PATTERN_RULES):
    """The verdicts in DuckDB: every rule tried on every page."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    hosts = ",\n".join(f"({quote(a)}, {quote(h)}, {quote(p)})" for a, h, p in host_rules)
    tests = ",\n".join(f"({i}, {quote(a)}, {quote(n)}, {quote(x)})" for i, (a, n, _, x) in enumerate(patterns))
    return f"""
WITH cut AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT row_number() OVER () AS k, page_id, url,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), '{LETTERS[0]}', '{LETTERS[1]}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
t AS (
  SELECT *, CASE WHEN strpos(url, '://') > 0
                 THEN '://' || host || substr(url, strpos(url, '://') + 3 + length(host))
                 ELSE url END AS target FROM p),
h(action, host, path) AS (VALUES {hosts}),
x(n, action, name, regex) AS (VALUES {tests}),
fit AS (
  SELECT k, arg_max(h.action, length(h.host || h.path)) AS action,
         arg_max(h.host || h.path, length(h.host || h.path)) AS rule
  FROM p JOIN h ON (p.host = h.host OR ends_with(p.host, '.' || h.host)) AND starts_with(p.path, h.path)
  GROUP BY k),
pat AS (
  SELECT k, arg_min(x.action, (-length(name), name)) AS action, arg_min(name, (-length(name), name)) AS pattern
  FROM t JOIN x ON regexp_matches(t.target, x.regex) GROUP BY k)
SELECT t.page_id, t.host, t.path, fit.rule,
       CASE WHEN fit.k IS NULL THEN pat.pattern END AS pattern,
       coalesce(fit.action, pat.action, 'allow') AS verdict
FROM t LEFT JOIN fit ON fit.k = t.k LEFT JOIN pat ON pat.k = t.k"""
