"""Splits that keep groups together, and the proof that they do."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import hamming
from ..sources.scratch import save
from . import blocks
from .hamming import by_blocks, hash_links
from .ranking import ranked, seeded

SPLITS = ("train", "val", "test")


def fill(deficits: list[float], size: int, n: int) -> list[int]:
    """How many of n groups of one size each split gets, if each goes where most is missing; ties to the earlier split.

    The n largest terms of the falling sequences deficit, deficit - size, ... are taken: a level is found
    that leaves few, and those are dealt one by one.
    """
    low, high = min(deficits) - size * n - size, max(deficits)
    taken = [0] * len(deficits)
    for _ in range(80):
        middle = (low + high) / 2
        some = [max(0, int((d - middle) // size)) for d in deficits]
        if sum(some) <= n:
            high, taken = middle, some
        else:
            low = middle
    taken = [max(0, k - 1) for k in taken]  # rounding at the level may have taken one too many
    heap = [(-(d - size * k), s) for s, (d, k) in enumerate(zip(deficits, taken))]
    heapq.heapify(heap)
    for _ in range(n - sum(taken)):
        d, s = heapq.heappop(heap)
        taken[s] += 1
        heapq.heappush(heap, (d + size, s))
    return taken


def stratified_group_split(groups: DataFrame, ratios: tuple[float, float, float], seed: int = 42) -> DataFrame:
    """groups (group_id, profile, members) with split.

    Within a profile the largest groups go first, each to the split that lacks most of its target. Groups
    of one size are interchangeable, so the greedy order is worked out on how many groups there are of
    each size; which of them go where follows a seeded order. So a profile with most of all groups is a
    few thousand sizes in one task, not its groups.
    """
    kind = "profile string, members long, train long, val long"

    def deal(pdf):
        import pandas as pd

        pdf = pdf.sort_values("members", ascending=False)
        total = int((pdf["members"] * pdf["groups"]).sum())
        missing, out = [r * total for r in ratios], []
        for members, n in zip(pdf["members"], pdf["groups"]):
            taken = fill(missing, int(members), int(n))
            missing = [m - k * int(members) for m, k in zip(missing, taken)]
            out.append((pdf["profile"].iloc[0], int(members), taken[0], taken[1]))
        return pd.DataFrame(out, columns=["profile", "members", "train", "val"])

    sizes = groups.groupBy("profile", "members").agg(F.count("*").alias("groups"))
    quota = sizes.groupBy("profile").applyInPandas(deal, kind)
    placed = ranked(groups, ["profile", "members"], [seeded(seed, "group_id"), F.col("group_id")])
    split = F.when(F.col("rank") <= F.col("train"), "train").when(F.col("rank") <= F.col("train") + F.col("val"), "val").otherwise("test")
    return placed.join(quota, ["profile", "members"]).select("group_id", "profile", "members", split.alias("split"))


def series_links(rows: DataFrame, gap: int = 2, threshold: int = 16) -> DataFrame:
    """a, b, d: neighbours in a series (id, prefix, number, h) at most gap apart in number and threshold in distance.

    Rows are dealt by range, so that a series may lie in many partitions; the last row of a partition is
    carried to the first of the next one that has the series.
    """
    dealt = save(rows.select("prefix", "number", "id", "h").repartitionByRange("prefix", "number", "id").withColumn("part", F.spark_partition_id()), "series")
    place = F.struct("number", "id", "h")
    ends = dealt.groupBy("prefix", "part").agg(F.min(place).alias("first"), F.max(place).alias("last"))  # a row for each series and partition
    carried = ends.select(F.lag("last").over(W.partitionBy("prefix").orderBy("part")).alias("one"), F.col("first").alias("two")).where("one IS NOT NULL")
    inside = dealt.select(F.lag(place).over(W.partitionBy("prefix", "part").orderBy("number", "id")).alias("one"), place.alias("two")).where("one IS NOT NULL")
    d = hamming(F.col("one.h"), F.col("two.h"))
    near = (F.col("two.number") - F.col("one.number") <= gap) & (d <= threshold)
    return inside.unionByName(carried).where(near).select(F.col("one.id").alias("a"), F.col("two.id").alias("b"), d.alias("d"))


def source_links(rows: DataFrame, key: str = "source") -> DataFrame:
    """Edges from the smallest id of a source key to the others."""
    least = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("id").alias("a"))
    return rows.join(least, rows[key] == least["_key"]).where("id <> a").select("a", F.col("id").alias("b"))


def split_pair_counts(rows: DataFrame, threshold: int) -> DataFrame:
    """first_split, second_split (in order of name), d, pairs: pairs of rows (id, h, split) within a threshold, from counts by hash and split. Rows without a split are left out."""
    counts = rows.where("h IS NOT NULL AND split IS NOT NULL").groupBy("h", "split").agg(F.count("*").alias("n"))
    size = counts.count()
    if by_blocks(threshold, size):
        met = blocks.crossed(counts, None, ["split"], ["h", "n"], size, blocks.counts(threshold), "d int, pairs long").withColumnsRenamed({"a_split": "split_a", "b_split": "split_b"})
        return met.groupBy(F.least("split_a", "split_b").alias("first_split"), F.greatest("split_a", "split_b").alias("second_split"), "d").agg(F.sum("pairs").alias("pairs"))
    one, two = (counts.select(F.col("h").alias(f"h{c}"), F.col("split").alias(f"split_{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
    met = hash_links(counts, counts, threshold).where("ha <= hb").join(one, "ha").join(two, "hb")
    own = (F.col("ha") == F.col("hb")) & (F.col("split_a") == F.col("split_b"))
    pairs = F.when(own, F.col("na") * (F.col("na") - 1) / 2).otherwise(F.col("na") * F.col("nb")).cast("long")
    once = met.where("ha < hb OR split_a <= split_b")
    sums = once.groupBy(F.least("split_a", "split_b").alias("first_split"), F.greatest("split_a", "split_b").alias("second_split"), "d").agg(F.sum(pairs).alias("pairs"))
    return sums.where("pairs > 0")


def crossing_histogram(rows: DataFrame, threshold: int) -> DataFrame:
    """d, crossing, pairs of rows (id, h, split) within a threshold."""
    crossing = (F.col("first_split") != F.col("second_split")).alias("crossing")
    return split_pair_counts(rows, threshold).groupBy("d", crossing).agg(F.sum("pairs").alias("pairs"))


def collisions(entries: DataFrame, key: str | Column = "entry") -> DataFrame:
    """Entries that occur more than once; a package must have none."""
    return entries.groupBy(key).agg(F.count("*").alias("times")).where("times > 1")
