"""Nested annotation documents to label rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import scalars


def class_order(categories: DataFrame) -> DataFrame:
    """category_id, cls: the rank of each category by id, from 0. A table of categories is small: one row for each class."""
    return categories.select(F.col("id").alias("category_id"), (F.row_number().over(W.orderBy("id")) - 1).alias("cls"))


def to_boxes(images: DataFrame, categories: DataFrame, annotations: DataFrame, clamped: bool = True) -> DataFrame:
    """image_id, file_name, line_no, cls, xc, yc, w, h; images without boxes keep a row of nulls. Clamped to 0..1, or dropped unless the size is valid."""
    sized = annotations.join(class_order(categories), "category_id").join(images.select(F.col("id").alias("image_id"), "width", "height"), "image_id")
    at = lambda k: F.get("bbox", F.lit(k))
    box = scalars.centred(at(0), at(1), at(2), at(3), F.col("width"), F.col("height"), clamped)
    boxes = sized.select("image_id", F.col("id").alias("line_no"), "cls", box.alias("b"))
    if not clamped:
        boxes = boxes.where(scalars.valid_size(F.col("b")))
    return images.select(F.col("id").alias("image_id"), "file_name").join(boxes.select("image_id", "line_no", "cls", "b.*"), "image_id", "left")


def of_category(categories: DataFrame, annotations: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Annotations of the one category of a name that are no crowds, and a row with the number of crowds dropped."""
    ids = [r["id"] for r in categories.where(F.col("name") == name).select("id").limit(2).collect()]
    if len(ids) != 1:
        raise ValueError(f"{name}: one category is needed, found {len(ids)}")
    own = annotations.where(F.col("category_id") == ids[0])
    crowd = F.coalesce(F.col("iscrowd"), F.lit(0)) == 1
    return own.where(~crowd), own.agg(F.count_if(crowd).alias("crowds_dropped"))
