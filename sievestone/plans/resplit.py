"""A new split of a dataset in which no group of near copies crosses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, hamming, quarantine, splitting
from ..sources.scratch import save


def resplit(rows: DataFrame, threshold: int, ratios: tuple[float, float, float], seed: int = 42, extra_edges: tuple[DataFrame, ...] = (), copies: int | None = None) -> DataFrame:
    """rows (id, h, profile) with group_id, their group's profile and split.

    With copies given, all but one of each component within that distance is set aside first. Groups are
    the components of near copies and of the extra edges (a, b), such as shared sources or neighbours in
    a series; a group's profile is the one most members have.
    """
    if copies is not None:
        rows = save(quarantine.keep(rows, quarantine.clique_quarantine(rows, copies)), "resplit-kept")
    edges = reduce(lambda a, b: a.unionByName(b.select("a", "b")), extra_edges, hamming.copy_edges(rows, threshold))
    members = save(graph.grouped(rows, edges, "id"), "resplit-groups")
    groups = graph.dominant(members, "profile", "id")
    placed = splitting.stratified_group_split(groups, ratios, seed)
    return members.drop("profile", "split").join(placed.select("group_id", "profile", "split"), "group_id")


def verify(rows: DataFrame, assignment: DataFrame, threshold: int) -> DataFrame:
    """d, crossing, pairs of the rows (id, h) under an assignment (id, split): after a new split no pair may cross. Rows without a split are left out."""
    return splitting.crossing_histogram(rows.select("id", "h").join(assignment.select("id", "split"), "id"), threshold)


def leakage(rows: DataFrame, assignment: DataFrame, threshold: int) -> DataFrame:
    """split (official_all, official_kept, new), d, crossing, pairs: the official split of rows (id, h, split), all of it and what the assignment has kept, against the new one."""
    official = rows.select("id", "split")
    kept = official.join(assignment.select("id"), "id", "left_semi")
    parts = (("official_all", official), ("official_kept", kept), ("new", assignment))
    return reduce(lambda a, b: a.unionByName(b), (verify(rows, split, threshold).withColumn("split", F.lit(name)) for name, split in parts)).select("split", "d", "crossing", "pairs")


def resplit_by_rules(rows: DataFrame, threshold: int, ratios: tuple[float, float, float], gap: int = 2, series_threshold: int = 16, copies: int = 0, seed: int = 42) -> DataFrame:
    """resplit() of rows (id, h, profile, source, prefix, number) without copies that keeps together near copies, rows of one source and neighbours in a series."""
    kept = save(quarantine.keep(rows, quarantine.clique_quarantine(rows, copies)), "resplit-kept")
    return resplit(kept, threshold, ratios, seed, rule_links(kept, gap, series_threshold))


def rule_links(rows: DataFrame, gap: int = 2, series_threshold: int = 16) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) between rows (id, h, source, prefix, number) of one source, and between neighbours in a series."""
    series = splitting.series_links(rows.where("prefix IS NOT NULL"), gap, series_threshold)
    return splitting.source_links(rows), series.select("a", "b")
