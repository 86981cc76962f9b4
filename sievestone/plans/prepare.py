"""Preparation of a labelled dataset: parse, remap, set copies aside, keep the rest."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import labels, quarantine
from ..sources.files import label_files
from ..sources.scratch import save


class Prepared(NamedTuple):
    #: id, split, text: the label files of the images that stay; an image without boxes has an empty text.
    files: DataFrame
    #: type, source, kept, split, distance, count of all that was set aside or skipped.
    manifest: DataFrame


def prepare(images: DataFrame, lines: DataFrame, names: dict[int, str], threshold: int, empty: DataFrame | None = None) -> Prepared:
    """images (id, split, sha, h), lines (id, line_no, line), empty (id of images with an empty label file).

    Exact copies go first, then what is near to an image of a split of higher priority among the rest;
    images without a label file are listed and left out.
    """
    images = images.withColumn("split", quarantine.split_name(F.col("split")))
    checked = save(labels.validate(lines, "prepare", sorted(names), ("id", "line_no")), "prepare-lines")
    bad = checked.where(~F.col("is_box")).groupBy(F.col("id").alias("removed")).agg(F.count("*").alias("count"))
    bad = bad.join(images.select(F.col("id").alias("removed"), "split"), "removed")
    labelled = lines.select("id").distinct() if empty is None else lines.select("id").union(empty.select("id")).distinct()
    missing = images.join(labelled, "id", "left_anti").select(F.col("id").alias("removed"), "split")
    whole = images.join(labelled, "id", "left_semi")
    exact = save(quarantine.exact_quarantine(whole), "prepare-exact")
    rest = quarantine.keep(whole, exact)
    near = save(quarantine.near_quarantine(rest, threshold), "prepare-near")
    stay = quarantine.keep(rest, near).select("id", "split")
    boxes = labels.remap(checked.where("is_box"), names)
    files = label_files(stay.join(boxes.drop("errors", "is_box", "degenerate"), "id", "left"), "id", "split")
    as_text = lambda rows: rows.withColumn("removed", F.col("removed").cast("string"))
    kept = lambda rows: as_text(rows).withColumn("kept", F.col("kept").cast("string"))
    return Prepared(files, quarantine.manifest(kept(exact), kept(near), as_text(bad), as_text(missing)))
