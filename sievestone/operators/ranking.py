"""Ranks, samples and splits in an order that does not depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.parameters import parse_ratio
from ..sources.scratch import save


def seeded(seed: int, *keys: str) -> Column:
    """A fixed pseudo-random order: the digest of seed and keys, the same in any SQL engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def cumulative(rows: DataFrame, keys: list[str], order: list[Column], amount: Column, name: str, total: str | None = None) -> DataFrame:
    """Adds the running sum of a whole amount within keys, and its sum over the key as total, without gathering a key's rows in one task.

    Rows are dealt by range over keys and order; a row's sum is that in its own partition plus the
    sums of its key in the partitions before. order must be a total order of ascending columns.
    """
    dealt = rows.withColumn("_amount", amount)
    for k, c in enumerate(order):
        dealt = dealt.withColumn(f"_order{k}", c)
    by = [f"_order{k}" for k in range(len(order))]
    dealt = save(dealt.repartitionByRange(*[*keys, *by]).withColumn("_part", F.spark_partition_id()), "ranked")
    of_key = W.partitionBy(*keys)
    parts = dealt.groupBy(*keys, "_part").agg(F.sum("_amount").alias("_sum"))  # a row for each key and partition
    before = F.coalesce(F.sum("_sum").over(of_key.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumns({"_before": before, "_total": F.sum("_sum").over(of_key)}).drop("_sum")
    here = F.sum("_amount").over(W.partitionBy(*keys, "_part").orderBy(*by).rowsBetween(W.unboundedPreceding, 0))
    shared = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_part"]]
    joined = dealt.withColumn("_here", here).alias("a").join(parts.alias("b"), shared)
    sums = [(F.col("a._here") + F.col("b._before")).alias(name), *([F.col("b._total").alias(total)] if total else [])]
    return joined.select("a.*", *sums).drop("_part", "_here", "_amount", *by)


def ranked(rows: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the rank from 1 within keys in a total order of ascending columns, without gathering a key's rows in one task."""
    return cumulative(rows, keys, order, F.lit(1).cast("long"), name)


def first_rows(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows in a total order."""
    return rows.orderBy(*order).limit(n)


def capped(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """At most n rows for each key, the first in a total order."""
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def stride_sample(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Every k-th row in a total order, n at most, for the largest k that gives n."""
    step = max(1, rows.count() // n)
    return ranked(rows.withColumn("_all", F.lit(0)), ["_all"], order, "_rank").where(((F.col("_rank") - 1) % step == 0) & ((F.col("_rank") - 1) / step < n)).drop("_all", "_rank")


def area_sample(areas: DataFrame, id_column: str, n: int, least: float = 0.02) -> DataFrame:
    """A stride sample by falling area of rows (id, first, second: the areas of two classes, 0 where there is none); where both classes occur the smaller area counts."""
    area = F.when(F.col("second") > 0, F.least("first", "second")).otherwise(F.col("first"))
    return stride_sample(areas.withColumn("area", area).where(F.col("area") > least), [-F.col("area"), F.col(id_column)], n)


def seeded_sample(rows: DataFrame, keys: list[str], id_column: str, n: int, seed: int) -> DataFrame:
    """n rows of each key in seeded order."""
    return capped(rows, keys, [seeded(seed, id_column), F.col(id_column)], n)


def warm_up_and_timed(rows: DataFrame, id_column: str, warm_up: int, timed: int, seed: int) -> DataFrame:
    """Two disjoint seeded samples: adds role."""
    few = rows.orderBy(seeded(seed, id_column), id_column).limit(warm_up + timed)
    rank = F.row_number().over(W.orderBy(seeded(seed, id_column), id_column))  # warm_up + timed rows
    return few.withColumn("_rank", rank).withColumn("role", F.when(F.col("_rank") <= warm_up, "warm_up").otherwise("timed")).drop("_rank")


def split_sizes(n: int, ratio: str) -> tuple[int, int, int]:
    """Rows for train, val and test, rounded half to even; a test row where there are three, all train below that."""
    if n < 3:
        return n, 0, 0
    train, val, _ = parse_ratio(ratio, n)
    n_train, n_val = max(1, round(n * train)), max(1, round(n * val))
    n_test = n - n_train - n_val
    return (n_train, n_val, n_test) if n_test >= 1 else (n - n_val - 1, n_val, 1)


def ratio_split(rows: DataFrame, id_column: str, ratio: str = "auto", seed: int = 42) -> DataFrame:
    """Adds split, by ranges of the seeded order."""
    n_train, n_val, _ = split_sizes(rows.count(), ratio)
    placed = ranked(rows.withColumn("_all", F.lit(0)), ["_all"], [seeded(seed, id_column), F.col(id_column)], "_rank")
    return placed.withColumn("split", F.when(F.col("_rank") <= n_train, "train").when(F.col("_rank") <= n_train + n_val, "val").otherwise("test")).drop("_all", "_rank")
