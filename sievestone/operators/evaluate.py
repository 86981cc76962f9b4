"""Predicted boxes against true ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import iou

MATCHED = "image string, pred int, gt int, iou double"


def candidates(predictions: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """image, pred, gt, iou of boxes (image, idx, cls, box) of one class in one image with that overlap or more. Both sides are normalised alike."""
    p = predictions.select("image", "cls", F.col("idx").alias("pred"), F.col("box").alias("p"))
    g = truth.select("image", "cls", F.col("idx").alias("gt"), F.col("box").alias("g"))
    overlap = iou(F.col("p"), F.col("g"))
    return p.join(g, ["image", "cls"]).select("image", "pred", "gt", overlap.alias("iou")).where(F.col("iou") >= least)


def greedy_matches(predictions: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """One-to-one matches, the largest overlap first, then by prediction and truth.

    Candidates are sorted by image and overlap and taken batch by batch; only the boxes of one image
    that are matched already are kept in memory.
    """

    def match(batches: Iterator) -> Iterator:
        image, taken = None, [np.empty(0, np.int64)] * 2
        for b in batches:
            if not b.num_rows:
                continue
            names, ends = b.column("image"), [b.column(c).fill_null(-(1 << 31)).to_numpy().astype(np.int64) for c in ("pred", "gt")]
            turns = np.asarray(names[1:].to_numpy(zero_copy_only=False) != names[:-1].to_numpy(zero_copy_only=False), bool)
            run = np.concatenate([[0], np.cumsum(turns)])
            old = (run == 0) & (names[0].as_py() == image)
            free = ~(old & (np.isin(ends[0], taken[0]) | np.isin(ends[1], taken[1])))
            keep = np.zeros(b.num_rows, bool)
            at = np.flatnonzero(free)
            keep[at[first_of_both(*((run[at] << 32) + x[at] for x in ends))]] = True
            last = keep & (run == run[-1])
            same = names[-1].as_py() == image
            taken = [np.concatenate([t if same else t[:0], x[last]]) for t, x in zip(taken, ends)]
            image = names[-1].as_py()
            yield b.filter(pa.array(keep))

    found = candidates(predictions, truth, least).selectExpr("cast(image AS string) image", "cast(pred AS int) pred", "cast(gt AS int) gt", "iou")
    placed = found.repartition("image").sortWithinPartitions("image", F.desc("iou"), "pred", "gt")
    return placed.mapInArrow(match, MATCHED)


def first_of_both(p: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Places of the pairs that are taken one after another if neither end is taken yet.

    In a round all pairs go that are the first left of both their ends, and with them what shares an end; the first pair left is always one of them.
    """
    left, kept = np.arange(len(p)), []
    while len(left):
        firsts = [np.unique(x[left], return_index=True)[1] for x in (p, g)]
        now = left[np.intersect1d(*firsts)]
        kept.append(now)
        left = left[~(np.isin(p[left], p[now]) | np.isin(g[left], g[now]))]
    return np.concatenate([*kept, left])


def outcomes(predictions: DataFrame, truth: DataFrame, matches: DataFrame) -> DataFrame:
    """image, cls, outcome (tp, fn, fp) of each box; a match is one tp."""
    m = matches.select("image", "pred", "gt")
    g = truth.select(F.col("image").cast("string").alias("image"), "cls", F.col("idx").alias("gt")).join(m.drop("pred").withColumn("hit", F.lit(True)), ["image", "gt"], "left")
    p = predictions.select(F.col("image").cast("string").alias("image"), "cls", F.col("idx").alias("pred")).join(m.drop("gt"), ["image", "pred"], "left_anti")
    return g.select("image", "cls", F.when(F.col("hit"), "tp").otherwise("fn").alias("outcome")).unionByName(p.select("image", "cls", F.lit("fp").alias("outcome")))


def totals(found: DataFrame) -> DataFrame:
    """cls (null: all), tp, fn, fp."""
    return found.rollup("cls").agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("tp", "fn", "fp")))


def worst_images(found: DataFrame, n: int = 50) -> DataFrame:
    """The images with most errors: image, fn, fp and the classes of both."""
    of = lambda o: F.array_sort(F.collect_list(F.when(F.col("outcome") == o, F.col("cls"))))
    per = found.groupBy("image").agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("fn", "fp")), of("fn").alias("fn_classes"), of("fp").alias("fp_classes"))
    return per.where("fn + fp > 0").orderBy(F.desc(F.col("fn") + F.col("fp")), "image").limit(n)


def curve(scored: DataFrame, truth: DataFrame, *keys: str) -> DataFrame:
    """keys, cls, n (truths), conf, hits, tp, seen: running counts of scored predictions (keys, cls, conf, hit) by falling confidence.

    Predictions of equal confidence count as one step, so the windows run over distinct confidences.
    """
    n = truth.groupBy("cls").agg(F.count("*").alias("n"))
    steps = scored.groupBy(*keys, "cls", "conf").agg(F.count_if("hit").alias("hits"), F.count("*").alias("all"))
    down = W.partitionBy(*keys, "cls").orderBy(F.desc("conf")).rowsBetween(W.unboundedPreceding, 0)
    return n.join(steps.withColumns({"tp": F.sum("hits").over(down), "seen": F.sum("all").over(down)}), "cls")


def average_precision(scored: DataFrame, truth: DataFrame, *keys: str) -> DataFrame:
    """keys, cls, ap: area under the precision-recall steps of scored predictions (keys, cls, conf, hit), with precision made non-rising; without keys, classes without predictions have 0."""
    steps = curve(scored, truth, *keys).withColumn("precision", F.col("tp") / F.col("seen"))
    rest = W.partitionBy(*keys, "cls").orderBy(F.desc("conf")).rowsBetween(0, W.unboundedFollowing)
    steps = steps.withColumn("best", F.max("precision").over(rest))
    made = steps.groupBy(*keys, "cls").agg(F.sum(F.col("best") * F.col("hits") / F.col("n")).alias("ap"))
    return made if keys else truth.select("cls").distinct().join(made, "cls", "left").select("cls", F.coalesce("ap", F.lit(0.0)).alias("ap"))


#: Overlaps at which a detection counts.
OVERLAPS = tuple(k / 100 for k in range(50, 100, 5))


def detection_report(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """cls (null: mean over classes), precision, recall, ap50, ap50_95 of predictions (cls, conf, iou: of the match, null for none) against truth (cls).

    As matches are taken by falling overlap, those of a stricter limit are the matches with that overlap.
    Precision and recall are those at the confidence of a class's best F1 at 0.5, the highest of equals.
    """
    limits = F.explode(F.array(*map(F.lit, OVERLAPS))).alias("least")
    at = scored.select("cls", "conf", "iou", limits).select("least", "cls", "conf", F.coalesce(F.col("iou") >= F.col("least"), F.lit(False)).alias("hit"))
    ap = average_precision(at, truth, "least").groupBy("cls").agg(F.max(F.when(F.col("least") == OVERLAPS[0], F.col("ap"))).alias("ap50"), (F.sum("ap") / len(OVERLAPS)).alias("ap50_95"))
    steps = curve(at.where(F.col("least") == OVERLAPS[0]), truth)
    f1 = 2 * F.col("tp") / (F.col("n") + F.col("seen"))
    best = steps.groupBy("cls").agg(F.max_by(F.struct((F.col("tp") / F.col("seen")).alias("precision"), (F.col("tp") / F.col("n")).alias("recall")), F.struct(f1, "conf")).alias("b"))
    names = ("precision", "recall", "ap50", "ap50_95")
    per = truth.select("cls").distinct().join(best.select("cls", "b.*"), "cls", "left").join(ap, "cls", "left").select("cls", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in names))
    return per.unionByName(per.agg(F.lit(None).cast(dict(per.dtypes)["cls"]).alias("cls"), *(F.avg(c).alias(c) for c in names)))
