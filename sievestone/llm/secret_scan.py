"""Secrets in texts: fixed patterns, and a battery of randomness tests for what they miss.

Runs of 16 encoding characters or more are candidates, with or without digits. Each gets the smallest
encoding that has all its characters, and tests of the hypothesis that its symbols are random draws from
the encoding's alphabet: chi-squared for uniform use of the alphabet, the runs test about the alphabet's
middle, and the lag-one serial correlation. Chi-squared comes in two parts that add up to the statistic
over all symbols: between bins of neighbours in an order of how often languages use the letters, as many
bins as have an expected count of BIN_COUNT (texts use few of them), and between the symbols within the bins
(strings of few symbols). Fisher's statistic combines the four; as runs and serial correlation depend on
each other, it is referred to a gamma distribution of FREEDOM degrees of freedom (Brown's method), so that p
is even for random strings of any length from 16, and near zero for names, paths, dates and words.

In each stratum of encoding and length (by powers of two) the number of random strings follows from
those with a large p, and the lowest cut is taken at which the share of others among what is kept
stays within FDR; short strings, whose tests say less, so get a stricter cut than long ones where they need
it. The cuts come from counts over all documents, at most BINS for each stratum. Digits alone are a
stratum of their own, tested as hexadecimal, as numbers are not secrets for being random; so are letters
alone, tested by their own alphabet, so that long words do not hide keys with digits.

A random span that overlaps one of the fixed patterns is left out. Everything is DataFrame functions.

Results for odd input: a null or empty text has no span; null ids are carried; repeated rows each give a
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN_CHARS = 6
# A longest run of 20 or 24 characters, as the shorter runs do not count.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
RANDOM = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

#: Encodings from the smallest: name, its characters as a class, its alphabet in order, and by use in texts.
DIGITS, UPPER, LOWER = "0123456789", common.UPPER, common.LOWER
FREQUENT = "etaoinshrdlucmfwypvbgkjqxz"
FREQUENT_BOTH = "".join(c + c.upper() for c in FREQUENT)
ENCODINGS = (
    ("digits", "[0-9]", DIGITS + "abcdef", "abcdef" + DIGITS),
    ("hex", "[0-9a-f]", DIGITS + "abcdef", "abcdef" + DIGITS),
    ("HEX", "[0-9A-F]", DIGITS + "ABCDEF", "ABCDEF" + DIGITS),
    ("upper", "[A-Z]", UPPER, FREQUENT.upper()),
    ("lower", "[a-z]", LOWER, FREQUENT),
    ("letters", "[A-Za-z]", UPPER + LOWER, FREQUENT + FREQUENT.upper()),
    ("base32", "[A-Z2-7]", UPPER + "234567", FREQUENT.upper() + "234567"),
    ("base36", "[0-9a-z]", DIGITS + LOWER, FREQUENT + DIGITS),
    ("base62", "[0-9A-Za-z]", DIGITS + UPPER + LOWER, FREQUENT_BOTH + DIGITS),
    ("base64", "[0-9A-Za-z+/]", UPPER + LOWER + DIGITS + "+/", FREQUENT_BOTH + DIGITS + "+/"),
    ("base64url", "[0-9A-Za-z_-]", UPPER + LOWER + DIGITS + "-_", FREQUENT_BOTH + DIGITS + "-_"),
    ("mixed", "[0-9A-Za-z+/_-]", UPPER + LOWER + DIGITS + "+/-_", FREQUENT_BOTH + DIGITS + "+/-_"),
)
BINS, FDR = 50, 0.05
#: Bins from which on strings are counted to estimate the number of random ones: p of 0.5 and 0.76.
LEVELS, ERRORS = (25, 38), 2.5
BIN_COUNT = 5
#: Of Fisher's statistic over random strings; its mean is twice the number of tests.
TESTS, FREEDOM = 4, 6.4


def located(rows: DataFrame, kind: str, pattern: str, hint: Column | None = None, group: int = 0) -> DataFrame:
    """Adds <kind>: array of (gap, len, value): characters before each match since the last, its length, and a group's value."""
    found, pieces = f"_{kind}_found", f"_{kind}_pieces"
    get = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    rows = rows.withColumn(found, get if hint is None else F.when(hint, get).otherwise(none))
    rows = rows.withColumn(pieces, F.when(F.size(found) > 0, F.split("_text", pattern, -1)).otherwise(none))
    value = F.when(F.size(found) > 0, F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))).otherwise(none) if group else F.col(found)
    zipped = F.transform(F.arrays_zip(F.col(found).alias("f"), F.slice(pieces, 1, F.size(found)).alias("p"), value.alias("v")), lambda x: F.struct(F.length(x["p"]).alias("gap"), F.length(x["f"]).alias("len"), x["v"].alias("value")))
    return rows.withColumn(kind, F.when(F.size(found) > 0, zipped).otherwise(F.array().cast("array<struct<gap:int,len:int,value:string>>"))).drop(found, pieces)


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id and the matches of each kind; the one pass over the texts."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), common.whole_text().alias("_text")).withColumn("_low", F.lower("_text"))
    rows = located(rows, "assign", ASSIGN, reduce(lambda a, b: a | b, (F.contains(F.col("_low"), F.lit(h)) for h in ASSIGN_HINTS)), 2)
    rows = located(rows.drop("_low"), "access", ACCESS, F.contains(F.col("_text"), F.lit("AKIA")))
    rows = located(rows, "hex", HEX)
    rows = located(rows, "random", RANDOM)
    return common.save(rows.drop("_text"), "secret-scan")


def spans_of(scanned: DataFrame, kind: str) -> DataFrame:
    """row, kind number, start, end, value; positions are running sums within a document."""
    each = scanned.where(F.size(kind) > 0).select("row", F.posexplode(kind).alias("k", "m")).select("row", "k", "m.gap", "m.len", "m.value")
    upto = W.partitionBy("row").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    return each.withColumn("end", end).select("row", F.lit(KINDS.index(kind)).alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end", "value")


def normal_above(z: Column) -> Column:
    """The share of a normal distribution above z (0 to 8), to 1e-7 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    series = reduce(lambda a, b: a * t + b, map(F.lit, (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530)))
    return series * t * F.exp(-z * z / 2) / (2 * math.pi) ** 0.5


def gamma_above(x: Column, mean: Column, freedom: Column) -> Column:
    """The share above x of a scaled chi-squared distribution, by the cube root (Wilson and Hilferty)."""
    spread = 2 / (9 * freedom)
    z = (F.cbrt(x / mean) - (1 - spread)) / F.sqrt(spread)
    tail = normal_above(F.least(F.abs(z), F.lit(8.0)))
    return F.when(z > 0, tail).otherwise(1 - tail)


def two_sided(z: Column) -> Column:
    return 2 * normal_above(F.least(F.abs(z), F.lit(8.0)))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)


def symbol_counts(rows: DataFrame) -> DataFrame:
    """Adds _chi (between _m bins), _within (between symbols in the bins)."""
    body, k, n = F.col("_body"), F.col("_k"), F.col("_n")
    counts = F.transform(F.sequence(F.lit(1), k.cast("int")), lambda i: (n - F.length(F.replace(body, F.substring(F.col("_frequent"), i, F.lit(1)), F.lit("")))).cast("double"))
    bins = F.greatest(F.lit(3), F.least(F.floor(k / 2), F.floor(n / BIN_COUNT))).cast("int")
    rows = rows.withColumn("_counts", counts).withColumn("_m", bins - (bins % 2 == 0).cast("int"))  # an odd number: the distribution has a closed form
    edges = F.transform(F.sequence(F.lit(0), F.col("_m")), lambda q: F.ceil(q * k / F.col("_m")).cast("int"))
    rows = rows.withColumn("_edges", edges)

    def square(q: Column) -> Column:
        low, high = F.get("_edges", q), F.get("_edges", q + 1)
        held = total(F.slice("_counts", low + 1, high - low))
        return held * held * k / (n * (high - low))

    between = total(F.transform(F.sequence(F.lit(0), F.col("_m") - 1), square)) - n
    every = total(F.transform("_counts", lambda c: c * c)) * k / n - n
    rows = rows.withColumns({"_chi": between, "_every": every})
    return rows.withColumn("_within", F.greatest(F.col("_every") - F.col("_chi"), F.lit(0.0))).drop("_counts", "_edges", "_every")


def tested(tokens: DataFrame) -> DataFrame:
    """Adds encoding, size (power of two) and p to tokens (value)."""
    body = F.rtrim(F.col("value"), F.lit("="))
    encoding = F.coalesce(*(F.when(F.regexp_like("_body", F.lit(f"^{e[1]}+$")), F.lit(k)) for k, e in enumerate(ENCODINGS)))
    rows = tokens.withColumn("_body", body).withColumn("encoding", encoding)
    of = lambda at: F.element_at(F.array(*(F.lit(e[at]) for e in ENCODINGS)), F.col("encoding") + 1)
    rows = rows.withColumns({"_alphabet": of(2), "_frequent": of(3)})
    n = F.col("_n")
    rows = symbol_counts(rows.withColumns({"_k": F.length("_alphabet").cast("double"), "_n": F.length("_body").cast("double")}))
    half = F.least(F.col("_chi") / 2, F.lit(300.0))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.floor(F.col("_m") / 2).cast("int"), F.lit(1))),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct((a["term"] * half / i).alias("term"), (a["sum"] + a["term"]).alias("sum")),
        lambda a: a["sum"],
    )
    p_between = F.exp(-half) * terms
    left = F.col("_k") - F.col("_m")
    p_within = gamma_above(F.col("_within"), left, left * n / (n - 1))
    symbols = F.transform(F.sequence(F.lit(1), F.length("_body")), lambda i: (F.call_function("instr", F.col("_alphabet"), F.substring(F.col("_body"), i, F.lit(1))) - 1).cast("double"))
    rows = rows.withColumns({"_p1": p_between, "_p2": p_within, "_x": symbols})
    # Runs about the middle.
    high = F.transform("_x", lambda x: (2 * x >= F.col("_k")).cast("int"))
    rows = rows.withColumn("_high", high).withColumn("_n1", total(F.col("_high"))).withColumn("_n2", n - F.col("_n1"))
    changes = F.size(F.filter(F.sequence(F.lit(1), F.size("_high") - 1), lambda i: F.get(F.col("_high"), i) != F.get(F.col("_high"), i - 1)))
    mu = 2 * F.col("_n1") * F.col("_n2") / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    rows = rows.withColumn("_runs_z", F.when(var > 0, (changes + 1 - mu) / F.sqrt(var)).otherwise(F.lit(40.0)))
    # Correlation of neighbours.
    rows = rows.withColumn("_mean", total(F.col("_x")) / n).withColumn("_c", F.transform("_x", lambda x: x - F.col("_mean")))
    products = F.aggregate(F.sequence(F.lit(1), F.size("_c") - 1), F.lit(0.0), lambda a, i: a + F.get(F.col("_c"), i) * F.get(F.col("_c"), i - 1))
    squares = F.aggregate("_c", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.withColumn("_serial_z", F.when(squares > 0, (products / squares + 1 / n) * n * F.sqrt(n - 1) / (n - 2)).otherwise(F.lit(40.0)))
    every = (F.col("_p1"), F.col("_p2"), two_sided(F.col("_runs_z")), two_sided(F.col("_serial_z")))
    fisher = reduce(lambda a, b: a + b, (-2 * F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-12))) for p in every))
    rows = rows.withColumn("p", gamma_above(fisher, F.lit(2.0 * TESTS), F.lit(FREEDOM)))
    return rows.withColumn("size", F.floor(F.log2("_n")).cast("int")).drop(*(c for c in rows.columns if c.startswith("_")))


def cuts(counts: dict[tuple[int, int], list[int]], fdr: float = FDR) -> dict[tuple[int, int], float]:
    """For each stratum the lowest p that keeps the share of non-random strings within fdr, if there is one.

    The p of random strings is even, that of others falls, so the number above either of LEVELS tells how
    many random strings there are at most: the least such number is taken. One more string counts, so that
    a lone secret is not lost for a p below one half (a stratum so keeps up to two others), and ERRORS
    standard errors, so that chance does not raise the cut of a stratum with few strings.
    """
    made = {}
    for stratum, bins in counts.items():
        above = [(sum(bins[k:]), 1 - k / BINS) for k in LEVELS]
        random = min((n + 1 + ERRORS * n**0.5) / share for n, share in above)
        for k in range(BINS):
            kept = sum(bins[k:])
            if kept and 1 - random * (1 - k / BINS) / kept <= fdr:
                made[stratum] = k / BINS
                break
    return made


def random_spans(scanned: DataFrame) -> DataFrame:
    """The candidates that their stratum's cut keeps."""
    rows = common.save(tested(spans_of(scanned, "random")), "secret-tested")
    binned = rows.groupBy("encoding", "size", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n")).collect()
    counts: dict[tuple[int, int], list[int]] = {}
    for r in binned:  # encodings x powers of two x BINS rows at most
        counts.setdefault((r["encoding"], r["size"]), [0] * BINS)[r["bin"]] += r["n"]
    kept = F.lit(False)
    for (encoding, size), p in sorted(cuts(counts).items()):
        kept = kept | ((F.col("encoding") == encoding) & (F.col("size") == size) & (F.col("p") >= p))
    return rows.where(kept).select("row", "kind", "start", "end", "value")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans for each row of docs."""
    scanned = scan(docs)
    base = spans_of(scanned, "assign").where(F.length("value") >= ASSIGN_CHARS).unionByName(spans_of(scanned, "access")).unionByName(spans_of(scanned, "hex"))
    every = base.unionByName(random_spans(scanned)).select("row", "kind", "start", "end")
    added = F.col("kind") == KINDS.index("random")
    place = W.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(~added, F.col("end"))).over(place.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(~added, F.col("start"))).over(place.rowsBetween(1, W.unboundedFollowing))
    every = every.withColumns({"before": before, "after": after}).where(~added | ((F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", "end") >= F.col("end"))))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    text = F.concat_ws(":", name, "start", "end")
    item = F.struct("start", "kind", text.alias("text"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["text"]), ",")
    found = every.groupBy("row").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{n}") for k, n in enumerate(KINDS)),
        listed(F.collect_list(F.when(~added, item))).alias("base"),
        listed(F.collect_list(item)).alias("spans"),
    )
    return scanned.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{n}", F.lit(0)).cast("long").alias(f"n_{n}") for n in KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
