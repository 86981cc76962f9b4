"""Who has what on, and who has lacked it for long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import REQUIRED_ITEMS, association_score, iou

LEAST_SCORE = 0.45


def assign_items(workers: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """frame_no, item, cls, track_id, score: each item (frame_no, item, cls, box, conf) goes to the worker (frame_no, track_id, pos, box) of its frame it fits best; of equals to the first.

    Of workers with one box only the first can be best, so items meet each box of their frame once; pairs below
    the least score go before the best is looked for.
    """
    known = items.where(F.col("cls").isin(*REQUIRED_ITEMS))
    firsts = workers.groupBy("frame_no", F.col("box").alias("w")).agg(F.max_by(F.struct("track_id", "pos"), F.struct(-F.col("pos"))).alias("_first")).select("frame_no", "w", "_first.track_id", "_first.pos")
    pairs = known.select("frame_no", "item", "cls", "conf", F.col("box").alias("i")).join(firsts, "frame_no")
    scored = pairs.withColumn("score", association_score(F.col("w"), F.col("i"), F.col("cls"), F.col("conf"))).where(F.col("score") >= least)
    best = scored.groupBy("frame_no", "item", "cls").agg(F.max_by(F.struct("track_id", "score"), F.struct("score", -F.col("pos"))).alias("best"))
    return best.select("frame_no", "item", "cls", "best.track_id", "best.score")


def status(workers: DataFrame, assigned: DataFrame, required: tuple[str, ...] = REQUIRED_ITEMS) -> DataFrame:
    """frame_no, track_id, present, missing (both in the order of required), compliant for each worker."""
    worn = assigned.groupBy("frame_no", "track_id").agg(F.collect_set("cls").alias("worn"))
    rows = workers.select("frame_no", "track_id").distinct().join(worn, ["frame_no", "track_id"], "left")
    need, has = F.array(*map(F.lit, required)), F.coalesce("worn", F.array().cast("array<string>"))
    rows = rows.withColumns({"present": F.array_intersect(need, has), "missing": F.array_except(need, has)})
    return rows.select("frame_no", "track_id", "present", "missing", (F.size("missing") == 0).alias("compliant"))


def zone_status(worn: DataFrame, zones: DataFrame) -> DataFrame:
    """Rows (zone, present) against the required items of their zone (zone, required): adds missing, compliant. zones has one row for each zone."""
    return worn.join(zones, "zone").withColumn("missing", F.array_except("required", "present")).withColumn("compliant", F.size("missing") == 0).drop("required")


def persistent(rows: DataFrame, key: str, order: list[str], bad: str, confirm: int = 3, clear: int = 2) -> DataFrame:
    """The rows at which a key has been bad for confirm rows running; the next alert needs clear rows without in between.

    Runs are numbered by the rows of the other kind before; an episode by the clear runs that reached
    the length that arms the gate again. The first row of an episode with a bad run long enough alerts.
    """
    by = W.partitionBy(key).orderBy(*order)
    b = F.col(bad).cast("int")
    upto = by.rowsBetween(W.unboundedPreceding, 0)
    placed = rows.withColumn("_run", F.when(F.col(bad), F.sum(1 - b).over(upto)).otherwise(F.sum(b).over(upto)))
    within = W.partitionBy(key, bad, "_run").orderBy(*order)
    placed = placed.withColumn("_length", F.row_number().over(within))
    placed = placed.withColumn("_episode", F.sum(F.when(~F.col(bad) & (F.col("_length") == clear), 1).otherwise(0)).over(upto))
    hits = placed.where(F.col(bad) & (F.col("_length") >= confirm))
    first = hits.withColumn("_first", F.row_number().over(W.partitionBy(key, "_episode").orderBy(*order)))
    return first.where("_first = 1").drop("_run", "_length", "_episode", "_first")


def uncovered(people: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """People (frame_no, track_id, box) without an item box (frame_no, box) that overlaps theirs by that much. Boxes that are equal are compared once."""
    p, i = (rows.select("frame_no", F.col("box").alias(c)).distinct() for rows, c in ((people, "p"), (items, "i")))
    held = p.join(i, "frame_no").where(iou(F.col("p"), F.col("i")) >= least).select(F.col("frame_no").alias("_frame"), "p").distinct()
    same = (people["frame_no"] == held["_frame"]) & people["box"].eqNullSafe(held["p"])
    return people.join(people.join(held, same, "left_semi").select("frame_no", "track_id").distinct(), ["frame_no", "track_id"], "left_anti")


def assign_heads(people: DataFrame, heads: DataFrame, least: float) -> DataFrame:
    """frame_no, head, track_id: each head box goes to the person whose box it overlaps most as a share of the head, if by that much; of equals to the smallest track. Of people with one box only that one can be best."""
    p, h = people.groupBy("frame_no", F.col("box").alias("p")).agg(F.min("track_id").alias("track_id")), heads.select("frame_no", F.col("idx").alias("head"), F.col("box").alias("h"))
    side = lambda low, high: F.greatest(F.least(F.col("p")[high], F.col("h")[high]) - F.greatest(F.col("p")[low], F.col("h")[low]), F.lit(0.0))
    share = side("x1", "x2") * side("y1", "y2") / F.greatest((F.col("h.x2") - F.col("h.x1")) * (F.col("h.y2") - F.col("h.y1")), F.lit(1e-9))
    best = h.join(p, "frame_no").withColumn("share", share).where(F.col("share") >= least).groupBy("frame_no", "head").agg(F.max_by(F.struct("track_id", "share"), F.struct("share", -F.col("track_id"))).alias("b"))
    return best.select("frame_no", "head", "b.track_id")
