"""Copies are set aside: by content, by distance, by the priority of their split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import SPLIT_ALIASES, SPLIT_PRIORITY
from .graph import grouped
from . import blocks
from .hamming import by_blocks, copy_edges, hash_links, kind


def lookup(table: dict, c: Column) -> Column:
    return reduce(lambda acc, k: F.when(c == k, F.lit(table[k])).otherwise(acc), table, F.lit(None))


def split_name(c: Column) -> Column:
    """The split's usual name; others are null."""
    return lookup(SPLIT_ALIASES, c)


def priority(c: Column) -> Column:
    return F.coalesce(lookup(SPLIT_PRIORITY, c), F.lit(0))


def first_copies(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds first: the least struct of order among the rows of a key. Two aggregations, no window: a key may hold most rows."""
    least = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*order)).alias("first"))
    return rows.join(least, rows[key] == least["_key"], "left").drop("_key")


def exact_quarantine(rows: DataFrame, key: str = "sha") -> DataFrame:
    """removed, kept, split: all but one row (id, split) of each content; test before val before train, then the smallest id."""
    ranked = first_copies(rows.withColumn("_down", -priority(F.col("split"))), key, ["_down", "id"])
    return ranked.where(F.col("id") != F.col("first.id")).select(F.col("id").alias("removed"), F.col("first.id").alias("kept"), "split")


def near_quarantine(rows: DataFrame, threshold: int) -> DataFrame:
    """removed, kept, split, distance: rows (id, split, h) near one of a split of higher priority; kept is the smallest such id.

    The best of each hash and split stands for its rows, so copies do not multiply the links.
    """
    best = rows.where("h IS NOT NULL").withColumn("p", priority(F.col("split"))).groupBy("h", "p").agg(F.min("id").alias("rep"))
    placed = rows.withColumn("pa", priority(F.col("split")))
    size = best.count()
    if by_blocks(threshold, size):
        found = blocks.crossed(best.withColumnRenamed("rep", "id"), None, ["p"], ["h", "id"], size, blocks.nearest(threshold), f"h long, b {kind(rows)}, d int", lambda a, b: a < b)
        kept = found.groupBy(F.col("h").alias("ha"), F.col("a_p").alias("pa")).agg(F.min(F.struct("b", "d")).alias("kept"))
    else:
        kept = nearest_links(rows, best, threshold)
    kept = kept.withColumnRenamed("pa", "pk")
    return placed.join(kept, (placed["h"] == kept["ha"]) & (placed["pa"] == kept["pk"])).select(F.col("id").alias("removed"), F.col("kept.b").alias("kept"), "split", F.col("kept.d").alias("distance"))


def nearest_links(rows: DataFrame, best: DataFrame, threshold: int) -> DataFrame:
    """ha, pa, kept (b, d): the smallest id near a hash of a priority among those of higher ones, by the index."""
    links = hash_links(rows, rows, threshold)
    above = links.join(best.withColumnsRenamed({"h": "hb", "p": "pb", "rep": "b"}), "hb")
    below = best.select(F.col("h").alias("ha"), F.col("p").alias("pa"))
    return below.join(above, "ha").where("pa < pb").groupBy("ha", "pa").agg(F.min(F.struct("b", "d")).alias("kept"))


def clique_quarantine(rows: DataFrame, threshold: int = 0) -> DataFrame:
    """removed, kept: of each component of rows (id, h) within the threshold all but the smallest id."""
    if threshold == 0:
        return copy_edges(rows, 0).select(F.col("b").alias("removed"), F.col("a").alias("kept"))
    groups = grouped(rows, copy_edges(rows, threshold), "id")
    return groups.where("id <> group_id").select(F.col("id").alias("removed"), F.col("group_id").alias("kept"))


def report_targets(pairs: DataFrame) -> DataFrame:
    """removed, kept from reported pairs (later, first): every later copy goes, the first stays."""
    return pairs.groupBy(F.col("later").alias("removed")).agg(F.min("first").alias("kept"))


def keep(rows: DataFrame, removed: DataFrame) -> DataFrame:
    return rows.join(removed.select(F.col("removed").alias("_removed")).distinct(), rows["id"] == F.col("_removed"), "left_anti")


def manifest(exact: DataFrame, near: DataFrame, bad_lines: DataFrame, missing: DataFrame) -> DataFrame:
    """type, source, kept, split, distance, count of all that preparation set aside."""
    kind = lambda rows, name: rows.withColumn("type", F.lit(name))
    parts = [kind(exact, "exact_duplicate"), kind(near, "near_duplicate"), kind(bad_lines, "invalid_label_lines_skipped"), kind(missing, "missing_label")]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for c, t in (("kept", "string"), ("split", "string"), ("distance", "int"), ("count", "long")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(t))
    return rows.select("type", F.col("removed").alias("source"), "kept", "split", "distance", "count")
