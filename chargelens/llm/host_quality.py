"""Host-level quality rules: a document goes when it fails itself or when its host fails too often."""

from collections import Counter
from itertools import islice

from pyspark.sql import functions as F

from .common import carried, column, materialize, per_text

SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20       # per cent of the words
MOST_SYMBOLS = 10        # per 100 characters in words
MOST_DUPLICATES = 30     # per cent of the lines
TIMES = 3.0              # times the corpus's share of failures that a host's must be beyond, for its documents to go
LEAST_FAILING = 0.2      # and at least so much, so that rare failures alone condemn no host
DEVIATIONS = 2.0         # of the posterior of the host's share
MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "n_lines bigint")

#: The rules that hosts are judged by: whether a measured document fails.
RULES = {
    "short": lambda: F.col("n_words") < LEAST_WORDS,
    "repeats": lambda: 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"),
    "lines": lambda: 100 * F.col("n_dup_lines") > MOST_DUPLICATES * F.col("n_lines"),
    "base": lambda: F.col("base_failed"),
}


def _repeated_words(words):
    """Words inside a five-word window that occurs twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(islice(words, i, None) for i in range(WINDOW))))
    counts = Counter(windows)
    if len(counts) == n:
        return 0
    total, done = 0, 0           # done: first word not counted yet
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + WINDOW - max(i, done)
            done = i + WINDOW
    return total


def _lines(text):
    """(lines with a word that are equal to an earlier line, lines with a word)."""
    lines = [line for line in text.split(b"\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines)), len(lines)


def _measure(texts):
    rows = []
    for text in texts:
        if not text:
            rows.append((0, 0, 0, 0, 0, 0))
            continue
        words = text.split()                       # bytes split at ASCII blanks only
        joined = b"".join(words)
        code_points = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
        symbols = len(text) - len(text.translate(None, SYMBOLS))
        twice, lines = _lines(text)
        rows.append((len(words), code_points, symbols, twice, _repeated_words(words), lines))
    return list(zip(*rows)) if rows else [[]] * 6


def measure(df, text="text", carry=None):
    """Carried columns plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and base_failed.

    Words are runs of anything but ASCII blanks. A null or empty text has no words and fails.
    Texts are read whole; nothing is shuffled.
    """
    rows = per_text(df, text, _measure, MEASURES, carried(df, carry, ["base_failed"]), binary=True)
    return rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                           | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def host_rates(measured, host="source", rules=RULES):
    """One row a host: host, documents, and rates: for each rule a struct (rule, rate, shrunk, least, condemned).

    Each rule's failures are aggregated by host and shrunk by an empirical beta prior of its own. The
    prior's mean is the share of failures over all documents. Its strength comes from the spread of
    the hosts' rates beyond what chance would give (method of moments, hosts weighted by documents);
    hosts that do not differ by more than chance all get the common rate. `least` is DEVIATIONS
    deviations below the host's posterior mean. A host is condemned when that is beyond TIMES the
    common rate and beyond LEAST_FAILING. Rows of a host are combined before the shuffle, and the
    priors are one row of sums. A null host is a host. An empty table gives no host.
    """
    failed = measured.select(column(host).alias("host"), *[F.coalesce(rule(), F.lit(False)).cast("bigint").alias(f"f_{r}")
                                                           for r, rule in rules.items()])
    counts = materialize(failed.groupBy("host").agg(F.count(F.lit(1)).alias("documents"),
                                                    *[F.sum(f"f_{r}").alias(f"f_{r}") for r in rules]))
    n = F.col("documents").cast("double")
    sums = counts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("documents").alias("n"), F.sum(n * n).alias("nn"), *[
        c for r in rules for c in (F.sum(f"f_{r}").alias(f"f_{r}"),
                                   F.sum(F.col(f"f_{r}").cast("double") * F.col(f"f_{r}") / n).alias(f"ff_{r}"))]).first()
    lines = []
    for r in rules:
        mean, strength = beta_prior(sums["hosts"], sums["n"], sums[f"f_{r}"], sums["nn"], sums[f"ff_{r}"])
        f = F.col(f"f_{r}").cast("double")
        if strength is None:
            shrunk = least = F.lit(mean)
            condemned = F.lit(False)
        else:
            shrunk = (f + F.lit(mean * strength)) / (n + F.lit(strength))
            least = shrunk - F.lit(DEVIATIONS) * F.sqrt(shrunk * (1 - shrunk) / (n + F.lit(strength + 1)))
            condemned = (least > F.lit(TIMES * mean)) & (least > F.lit(LEAST_FAILING))
        lines.append(F.struct(F.lit(r).alias("rule"), (f / n).alias("rate"), shrunk.alias("shrunk"), least.alias("least"),
                              condemned.alias("condemned")))
    return counts.select("host", "documents", F.array(*lines).alias("rates"))


def beta_prior(hosts, n, failures, n_squares, f_squares):
    """(mean, strength) of the prior from sums over hosts; strength None: no spread beyond chance.

    `n_squares` is the sum of n_h ** 2, `f_squares` the sum of f_h ** 2 / n_h.
    """
    if not n:
        return 0.0, None
    mean = failures / n
    inside = mean * (1 - mean)
    shared = n - n_squares / n - (hosts - 1)            # 0 if every host has one document
    if hosts < 2 or inside == 0 or shared <= 0:
        return mean, None
    between = f_squares - n * mean * mean               # sum of n_h * (rate_h - mean) ** 2
    spread = (between - (hosts - 1) * inside) / shared
    if spread <= 0:
        return mean, None
    return mean, max(inside / spread - 1, 1e-6)


def judge(df, host="source", text="text", carry=None, rules=RULES):
    """Measures of every document, its host's figures, and `kept`.

    Returns the carried columns, the measures, base_failed, host_rates (see `host_rates`), host_rule
    (the first rule that condemns the host, else null) and kept: false if the document fails itself or
    its host is condemned. The host column is carried as well. One row per input row; repeated rows
    stay, an empty table gives an empty one. Carried columns that clash with a result are replaced.
    """
    results = ["host_rates", "host_rule", "kept"]
    keep = carried(df, carry, results)
    if host not in keep:
        keep = [*keep, host]
    measured = materialize(measure(df, text, [c for c in keep if c != text]))
    rates = materialize(host_rates(measured, host, rules).select(
        F.col("host").alias("_host"), F.col("rates").alias("host_rates"),
        F.get(F.filter("rates", lambda r: r["condemned"]), F.lit(0))["rule"].alias("host_rule")))
    return (measured.join(rates, column(host).eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_rule").isNull()))


def judge_documents(docs):
    base = F.get(F.filter("host_rates", lambda r: r["rule"] == "base"), F.lit(0))
    return judge(docs.select(column("doc_id"), column("source"), column("text"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "source", base["shrunk"].alias("host_shrunk"), "host_rule")
