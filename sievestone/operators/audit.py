"""Inventories, counts and expectations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from .hamming import distance_histogram, first_pairs
from .ranking import cumulative


def pair_up(images: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, has_image, has_label for all that have either."""
    a, b = images.select(*keys).distinct().withColumn("has_image", F.lit(True)), labels.select(*keys).distinct().withColumn("has_label", F.lit(True))
    both = a.join(b, keys, "full")
    return both.select(*keys, *(F.coalesce(c, F.lit(False)).alias(c) for c in ("has_image", "has_label")))


def missing_labels(listed: DataFrame, labels: DataFrame, key: str = "path") -> DataFrame:
    """Listed images without a label file."""
    wanted = listed.withColumn("label", scalars.label_path(F.col(key)))
    return wanted.join(labels.select(F.col("path").alias("label")).distinct(), "label", "left_anti").select(key)


def class_counts(boxes: DataFrame) -> DataFrame:
    """split, cls, boxes with subtotals: null cls for a split, both null for all."""
    return boxes.rollup("split", "cls").agg(F.count("*").alias("boxes"))


def split_summary(files: DataFrame, keys: list[str]) -> DataFrame:
    """By keys: images, missing_labels, files_with_errors, boxes and errors of files (has_label, n_errors, n_boxes)."""
    return files.groupBy(*keys).agg(
        F.count("*").alias("images"),
        F.count_if(~F.col("has_label")).alias("missing_labels"),
        F.count_if(F.col("n_errors") > 0).alias("files_with_errors"),
        F.coalesce(F.sum("n_boxes"), F.lit(0)).alias("boxes"),
        F.coalesce(F.sum("n_errors"), F.lit(0)).alias("errors"),
    )


def qa_report(files: DataFrame, boxes: DataFrame, rows: DataFrame, threshold: int, examples: int = 10) -> DataFrame:
    """By split: images, unreadable, without_label, label_errors (files), errors_total of the three, boxes, class_counts (map), duplicate_pairs and the first examples (array of a, b, d).

    files (split, readable, has_label, n_errors), valid boxes (split, cls), rows (id, h, split) of the readable images.
    """
    per = files.groupBy("split").agg(
        F.count("*").alias("images"), F.count_if(~F.col("readable")).alias("unreadable"), F.count_if(~F.col("has_label")).alias("without_label"),
        F.count_if(F.col("has_label") & (F.col("n_errors") > 0)).alias("label_errors"),
    ).withColumn("errors_total", F.col("unreadable") + F.col("without_label") + F.col("label_errors"))
    classes = boxes.groupBy("split", "cls").agg(F.count("*").alias("n")).groupBy("split").agg(F.sum("n").alias("boxes"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("cls", "n")))).alias("class_counts"))
    pairs = distance_histogram(rows, threshold, "split").groupBy("split").agg(F.sum("pairs").alias("duplicate_pairs"))
    shown = first_pairs(rows, threshold, examples, "split").groupBy("split").agg(F.array_sort(F.collect_list(F.struct("a", "b", "d"))).alias("examples"))
    made = per.join(classes, "split", "left").join(pairs, "split", "left").join(shown, "split", "left")
    return made.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("boxes", "duplicate_pairs")})


def composition(boxes: DataFrame, first: int, second: int, *keys: str) -> DataFrame:
    """Images by the classes they hold: only_first, only_second, both, neither, and the boxes of each. Rows without a class stand for images without boxes."""
    has = boxes.groupBy(*keys).agg(F.count_if(F.col("cls") == first).alias("a"), F.count_if(F.col("cls") == second).alias("b"))
    a, b = F.col("a") > 0, F.col("b") > 0
    return has.agg(
        F.count_if(a & ~b).alias("only_first"), F.count_if(b & ~a).alias("only_second"), F.count_if(a & b).alias("both"), F.count_if(~a & ~b).alias("neither"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("first_boxes"), F.coalesce(F.sum("b"), F.lit(0)).alias("second_boxes"),
    )


def box_histogram(images: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """n_boxes, images, from 0."""
    per = boxes.groupBy(key).agg(F.count("*").alias("n_boxes"))
    return images.select(key).join(per, key, "left").groupBy(F.coalesce("n_boxes", F.lit(0)).alias("n_boxes")).agg(F.count("*").alias("images"))


def sorted_elements(rows: DataFrame, keys: list[str], value: str, places: dict[str, Column]) -> DataFrame:
    """By keys: the element of the sorted values at each place (from 0, of n); null where all values are. Distinct values are counted, and ranks are running sums over them."""
    counts = rows.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    placed = cumulative(counts, keys, [F.col(value)], F.col("_n"), "_upto", "n")
    at = {name: F.min(F.when((F.col("_n") > 0) & (F.col("_upto") > place), F.col(value))).alias(name) for name, place in places.items()}
    return placed.groupBy(*keys).agg(*at.values())


def upper_median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The element at n div 2 of the sorted values of each key, 0.0 where all are null."""
    return sorted_elements(rows, keys, value, {"upper_median": F.floor(F.col("n") / 2)}).select(*keys, F.coalesce("upper_median", F.lit(0.0)).alias("upper_median"))


def statistics(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """mean, median, sample deviation, min and max."""
    c = F.col(value)
    middle = sorted_elements(rows, keys, value, {"_low": F.floor((F.col("n") - 1) / 2), "_high": F.floor(F.col("n") / 2)})
    plain = rows.groupBy(*keys).agg(F.avg(c).alias("mean"), F.stddev_samp(c).alias("stdev"), F.min(c).alias("min"), F.max(c).alias("max"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = plain.alias("a").join(middle.alias("b"), same)
    return both.select(*(f"a.{k}" for k in keys), "mean", ((F.col("_low") + F.col("_high")) / 2).alias("median"), "stdev", "min", "max")


def rates(rows: DataFrame, keys: list[str], seconds: str) -> DataFrame:
    """frames, seconds, frames a second and seconds a frame; null where nothing was measured."""
    total = F.sum(seconds)
    return rows.groupBy(*keys).agg(F.count("*").alias("frames"), total.alias("seconds"), F.try_divide(F.count("*"), total).alias("fps"), F.try_divide(total, F.count("*")).alias("per_frame"))


def package_manifest(entries: DataFrame, keys: list[str]) -> DataFrame:
    """By keys: files, bytes and a digest over the sorted (name, sha) of the files (name, length, sha), taken over digests of 4096 parts."""
    part = F.pmod(F.xxhash64("name"), F.lit(4096))
    parts = entries.groupBy(*keys, part.alias("part")).agg(F.count("*").alias("n"), F.sum("length").alias("b"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "name", "sha"))), "\n"), 256).alias("s"))
    listed = F.array_sort(F.collect_list(F.struct("part", "s")))
    return parts.groupBy(*keys).agg(F.sum("n").alias("files"), F.sum("b").alias("bytes"), F.sha2(F.array_join(F.transform(listed, lambda x: x["s"]), ""), 256).alias("digest"))


def unexpected_classes(boxes: DataFrame, expected: list[int], keys: list[str]) -> DataFrame:
    """By keys: the classes seen, those not expected, those not seen, and whether they agree."""
    seen = boxes.groupBy(*keys).agg(F.array_sort(F.collect_set("cls")).alias("seen"))
    want = F.array(*map(F.lit, sorted(expected)))
    return seen.withColumns({"extra": F.array_except("seen", want), "lacking": F.array_except(want, F.col("seen"))}).withColumn("ok", (F.size("extra") == 0) & (F.size("lacking") == 0))


def check(metrics: DataFrame, expected: DataFrame) -> DataFrame:
    """quantity, expected, measured, difference, ok for each expectation; an unmeasured quantity is not ok."""
    both = expected.join(metrics, "quantity", "left")
    difference = F.col("measured") - F.col("expected")
    return both.select("quantity", "expected", "measured", difference.alias("difference"), F.coalesce(difference == 0, F.lit(False)).alias("ok"))


def verdict(checks: DataFrame, ok: str | Column = "ok") -> DataFrame:
    """One row: status PASS or FAIL, checks, failed."""
    c = F.col(ok) if isinstance(ok, str) else ok
    return checks.agg(F.when(F.coalesce(F.every(c), F.lit(True)), "PASS").otherwise("FAIL").alias("status"), F.count("*").alias("checks"), F.count_if(~c).alias("failed"))


def coverage(images: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """cls, objects, images, percent of all images."""
    n = images.select(key).distinct().agg(F.count("*").alias("all_images"))
    per = boxes.groupBy("cls").agg(F.count("*").alias("objects"), F.count_distinct(key).alias("images"))
    return per.join(F.broadcast(n)).select("cls", "objects", "images", (100 * F.col("images") / F.col("all_images")).alias("percent"))


def foreign(rows: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys that the source does not have."""
    return rows.select(key).distinct().join(source.select(key).distinct(), key, "left_anti")


def credential_hits(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.where(scalars.has_credentials(F.col(text))).select(key)
