"""Similarity joins of 64-bit hashes by Hamming distance."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hamming
from . import blocks

BITS = 64
#: Values looked up for a part of a hash, at most.
MAX_BALL = 1000
#: Pairs that blocks compare in the time of one lookup of the index or one of its candidates.
PAIRS_A_LOOKUP = 1000


def part_widths(parts: int) -> list[int]:
    """64 bits in parts of like size, the wider first."""
    return [BITS // parts + (k < BITS % parts) for k in range(parts)]


def costs(threshold: int, rows: int) -> list[tuple[float, int, int]]:
    """Lookups plus expected random candidates of a row, number of parts and the radius in each.

    Of `parts` parts one differs in at most threshold // parts bits. threshold + 1 parts need only equal
    ones; fewer, wider parts with a radius tell more rows apart.
    """
    made = []
    for parts in range(1, min(threshold + 1, BITS) + 1):
        radius, width = threshold // parts, BITS // parts
        ball = sum(comb(width, r) for r in range(min(radius, width) + 1))
        if ball <= MAX_BALL:
            made.append((parts * ball * (1 + rows / 2.0**width), parts, radius))
    return made or [(float(rows), 1, BITS)]


def plan(threshold: int, rows: int) -> tuple[int, int]:
    """Number of parts and the radius in each: the cheapest."""
    return min(costs(threshold, rows))[1:]


def by_blocks(threshold: int, rows: int) -> bool:
    """Whether comparing all pairs costs less than the cheapest index. With 20 bits it always does: an index tells little apart there, and the pairs found grow with the square too."""
    return rows / 2 < PAIRS_A_LOOKUP * min(costs(threshold, rows))[0]


def parts_of(h: Column, parts: int, radius: int) -> Column:
    """Array of (part, value) for each value within radius of a part of h."""

    def entry(k: int, value: Column):
        return lambda m: F.struct(F.lit(k).alias("part"), value.bitwiseXOR(m.cast("long")).alias("value"))

    made, low = [], BITS
    for k, width in enumerate(part_widths(parts)):
        low -= width
        value = F.call_function("shiftrightunsigned", h, F.lit(low)).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))
        masks = [sum(1 << b for b in c) for r in range(min(radius, width) + 1) for c in combinations(range(width), r)]
        if len(masks) == 1:
            made.append(F.array(F.struct(F.lit(k).alias("part"), value.alias("value"))))
        else:
            made.append(F.transform(F.array(*map(F.lit, masks)), entry(k, value)))
    return F.concat(*made)


def kind(rows: DataFrame, column: str = "id") -> str:
    return dict(rows.dtypes)[column]


def hash_links(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """ha, hb, d for the pairs of distinct hashes (h) of two tables within a threshold below 64 bits."""
    a, b = left.select(F.col("h").alias("ha")).where("ha IS NOT NULL").distinct(), right.select(F.col("h").alias("hb")).where("hb IS NOT NULL").distinct()
    parts, radius = plan(threshold, b.count())
    probes = a.select("ha", F.inline(parts_of(F.col("ha"), parts, radius)))
    index = b.select("hb", F.inline(parts_of(F.col("hb"), parts, 0)))
    d = hamming(F.col("ha"), F.col("hb"))
    return probes.join(index, ["part", "value"]).where(d <= threshold).select("ha", "hb", d.alias("d")).distinct()


def hamming_join(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """a, b, d for all pairs of rows (id, h) of two tables. An index compares hashes once each, then rows are put in."""
    n = max(left.count(), right.count())
    if by_blocks(threshold, n):
        return blocks.crossed(left, right, [], ["h", "id"], n, blocks.pairs(threshold, "id"), f"a {kind(left)}, b {kind(right)}, d int")
    links = hash_links(left, right, threshold)
    a, b = left.select(F.col("id").alias("a"), F.col("h").alias("ha")), right.select(F.col("id").alias("b"), F.col("h").alias("hb"))
    return links.join(a, "ha").join(b, "hb").select("a", "b", "d")


def hamming_pairs(rows: DataFrame, threshold: int) -> DataFrame:
    """a < b, d for all pairs of rows (id, h) within a threshold. Rows leave in the order they are found; none is shuffled or sorted where blocks are compared."""
    n = rows.count()
    if not by_blocks(threshold, n):
        return hamming_join(rows, rows, threshold).where("a < b")
    found = blocks.crossed(rows, None, [], ["h", "id"], n, blocks.pairs(threshold, "id"), f"a {kind(rows)}, b {kind(rows)}, d int")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d").where("a < b")


def copy_edges(rows: DataFrame, threshold: int) -> DataFrame:
    """Edges (a, b) that connect the rows (id, h) as all pairs within the threshold would, at most one for each row and each pair of hashes; of blocks a forest.

    Rows with equal hashes hang on the smallest of them; links are between those. Use this for groups,
    where a hash that many rows share would make a square of pairs.
    """
    least = rows.where("h IS NOT NULL").groupBy("h").agg(F.min("id").alias("rep"))
    stars = rows.join(least, "h").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    if threshold == 0:
        return stars
    n = least.count()
    if by_blocks(threshold, n):
        links = blocks.crossed(least, None, [], ["h"], n, blocks.forest(threshold), "a long, b long").select(F.col("a").alias("ha"), F.col("b").alias("hb"))
    else:
        links = hash_links(least, least, threshold).where("ha < hb")
    one, two = least.select(F.col("h").alias("ha"), F.col("rep").alias("a")), least.select(F.col("h").alias("hb"), F.col("rep").alias("b"))
    return stars.unionByName(links.join(one, "ha").join(two, "hb").select("a", "b"))


def distance_histogram(rows: DataFrame, threshold: int, *keys: str) -> DataFrame:
    """keys, d, pairs: pairs of rows (h) with equal keys within a threshold, from counts by hash."""
    counts = rows.where("h IS NOT NULL").groupBy(*keys, "h").agg(F.count("*").alias("n"))
    n = counts.count()
    if by_blocks(threshold, n):
        met = blocks.crossed(counts, None, list(keys), ["h", "n"], n, blocks.counts(threshold), "d int, pairs long", lambda a, b: a == b)
        return met.groupBy(*(F.col(f"a_{k}").alias(k) for k in keys), "d").agg(F.sum("pairs").alias("pairs"))
    one, two = (counts.select(*(F.col(k).alias(f"{c}_{k}") for k in keys), F.col("h").alias(f"h{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
    met = hash_links(counts, counts, threshold).where("ha <= hb").join(one, "ha").join(two, "hb")
    for k in keys:
        met = met.where(F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")))
    pairs = F.when(F.col("ha") == F.col("hb"), F.col("na") * (F.col("na") - 1) / 2).otherwise(F.col("na") * F.col("nb")).cast("long")
    return met.groupBy(*(F.col(f"a_{k}").alias(k) for k in keys), "d").agg(F.sum(pairs).alias("pairs")).where("pairs > 0")


def overlap_counts(left: DataFrame, right: DataFrame, thresholds: tuple[int, ...] = (0, 2, 4, 8)) -> DataFrame:
    """threshold, pairs: pairs of rows of two tables within each threshold, from counts by hash."""
    sizes = [rows.where("h IS NOT NULL").groupBy("h").agg(F.count("*").alias("n")) for rows in (left, right)]
    n = max(x.count() for x in sizes)
    if by_blocks(max(thresholds), n):
        met = blocks.crossed(*sizes, [], ["h", "n"], n, blocks.counts(max(thresholds)), "d int, pairs long")
    else:
        na, nb = (x.select(F.col("h").alias(f"h{c}"), F.col("n").alias(f"n{c}")) for x, c in zip(sizes, "ab"))
        met = hash_links(left, right, max(thresholds)).join(na, "ha").join(nb, "hb").select("d", (F.col("na") * F.col("nb")).alias("pairs"))
    sums = met.agg(*(F.coalesce(F.sum(F.when(F.col("d") <= t, F.col("pairs"))), F.lit(0)).alias(str(t)) for t in thresholds))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(str(t)).alias("pairs")) for t in thresholds))))


def first_pairs(rows: DataFrame, threshold: int, n: int, *keys: str) -> DataFrame:
    """keys, a < b, d: for each value of the keys the first n pairs of rows (id, h) within a threshold, by a and b.

    A pair whose row has n smaller rows of its hash beside it comes after n others, so only the n smallest
    rows of a hash are put together.
    """
    from .ranking import capped

    few = capped(rows.where("h IS NOT NULL").select(*keys, "h", "id"), [*keys, "h"], [F.col("id")], n + 1)
    size = few.count()
    if by_blocks(threshold, size):
        found = blocks.crossed(few, None, list(keys), ["h", "id"], size, blocks.first(threshold, n), f"a {kind(rows)}, b {kind(rows)}, d int", lambda a, b: a == b)
        return capped(found.select(*(F.col(f"a_{k}").alias(k) for k in keys), "a", "b", "d"), list(keys), [F.col("a"), F.col("b")], n)
    one, two = (few.select(*(F.col(k).alias(f"{c}_{k}") for k in keys), F.col("h").alias(f"h{c}"), F.col("id").alias(c)) for c in "ab")
    met = hash_links(few, few, threshold).join(one, "ha").join(two, "hb").where("a < b")
    for k in keys:
        met = met.where(F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")))
    return capped(met.select(*(F.col(f"a_{k}").alias(k) for k in keys), "a", "b", "d"), list(keys), [F.col("a"), F.col("b")], n)


def first_equal_pairs(left: DataFrame, right: DataFrame, n: int = 10) -> DataFrame:
    """The first n pairs (a, b) of rows (id, h) of two tables with equal hashes, by a and b; of a hash with more rows than n only the n smallest ids can be among them."""
    from .ranking import capped

    least = lambda rows, name: capped(rows.where("h IS NOT NULL"), ["h"], [F.col("id")], n).select("h", F.col("id").alias(name))
    return least(left, "a").join(least(right, "b"), "h").select("a", "b").orderBy("a", "b").limit(n)


def random_pair_distance(rows: DataFrame, seed: int = 1) -> DataFrame:
    """mean_distance, pairs over pairs of neighbours in a seeded order: near 32 for sound hashes."""
    from .ranking import ranked, seeded

    placed = ranked(rows.withColumn("_all", F.lit(0)), ["_all"], [seeded(seed, "id"), F.col("id")])
    twos = placed.groupBy(F.floor((F.col("rank") - 1) / 2).alias("pair")).agg(F.min("h").alias("x"), F.max("h").alias("y"), F.count("*").alias("n")).where("n = 2")
    return twos.agg(F.avg(hamming(F.col("x"), F.col("y"))).alias("mean_distance"), F.count("*").alias("pairs"))
