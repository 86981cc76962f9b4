"""The last gate before a dataset is used: every count is taken again, nothing is taken from a stored report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import has_credentials
from ..operators import audit, labels, splitting
from ..sources.scratch import save


def checks(images: DataFrame, lines: DataFrame, classes: list[int], threshold: int, texts: DataFrame) -> DataFrame:
    """quantity, expected, measured, difference, ok.

    images (id, split, path, h), whose near pairs are those within threshold, lines (id, line_no, line), texts (name, text)
    of the files that go out. Errors and degenerate boxes are both counted; only errors have to be none.
    """
    # Kept, as three counts read it, and each time every line would be taken apart.
    checked = save(labels.validate(lines, "final", classes, ("id", "line_no")).select("cls", F.size("errors").alias("n_errors"), "degenerate", "is_box"), "final-lines")
    one = lambda rows, name, c: rows.agg(F.lit(name).alias("quantity"), F.coalesce(c, F.lit(0)).cast("long").alias("measured"))
    measured = [
        one(images.join(lines.select("id").distinct(), "id", "left_anti"), "missing_labels", F.count("*")),
        one(checked, "label_errors", F.sum("n_errors")),
        one(checked, "degenerate_boxes", F.count_if("degenerate")),
        one(splitting.collisions(images.select(F.col("path").alias("entry"))), "path_collisions", F.count("*")),
        one(splitting.crossing_histogram(images, threshold).where("crossing"), "crossing_pairs", F.sum("pairs")),
        one(texts, "credential_files", F.count_if(has_credentials(F.col("text")))),
        one(checked.where("is_box"), "unexpected_classes", F.count_distinct(F.when(~F.col("cls").isin(*classes), F.col("cls")))),
    ]
    rows = measured[0]
    for m in measured[1:]:
        rows = rows.unionByName(m)
    free = F.col("quantity") == "degenerate_boxes"
    expected = rows.select("quantity", F.when(free, F.col("measured")).otherwise(0).cast("long").alias("expected"))
    return audit.check(rows, expected)


def validate(images: DataFrame, lines: DataFrame, classes: list[int], threshold: int, texts: DataFrame) -> DataFrame:
    """One row: status PASS or FAIL, checks, failed."""
    return audit.verdict(checks(images, lines, classes, threshold, texts))
