"""All pairs of 64-bit hashes, block against block, for thresholds at which an index would look up more than it tells apart.

Rows are dealt into blocks by hash. A task gets two blocks at a time and folds their pairs where they are: into counts, a
spanning forest, least neighbours, or the pairs themselves. So memory is that of two blocks, and what is shuffled
are blocks and folded rows, never all pairs. The time is the square of the number of distinct hashes, divided by the cores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import save

#: Rows of a block: at most, and at least where there are as many.
LARGE, SMALL = 16384, 512
#: Distances that are held at once.
CELLS = 1 << 17
#: Links that are handed on at once, about.
GATHERED = 1 << 16
#: Distances that one partition works out, about; more partitions than that many only wait for each other.
TASK_CELLS, MAX_TASKS = 1 << 25, 4096

#: Folds take two blocks as struct arrays with h, and whether they are the same block; they give columns by name.
Fold = Callable[[pa.StructArray, pa.StructArray, bool], Iterator[dict]]


def hashes_of(block: pa.StructArray) -> np.ndarray:
    return block.field("h").to_numpy(zero_copy_only=False).view(np.uint64)


def links(a: np.ndarray, b: np.ndarray, threshold: int, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in a and in b and distances of the pairs within the threshold; of one block with itself those of a first and a later place."""
    low, parts = 0, []
    while low < len(a):
        others = b[low:] if own else b
        step = max(1, CELLS // max(1, len(others)))
        d = np.bitwise_count(a[low : low + step, None] ^ others[None, :]).ravel()
        at = np.flatnonzero(d <= threshold)
        i, j = np.divmod(at, len(others))
        d = d[at]
        if own:
            later = i < j
            i, j, d = i[later], j[later] + low, d[later]
        parts.append((i + low, j, d))
        low += step
        if low >= len(a) or sum(len(x[2]) for x in parts) >= GATHERED or len(parts) >= 64:
            yield tuple(np.concatenate(x) for x in zip(*parts))
            parts = []


def put(block: pa.StructArray, name: str, at: np.ndarray) -> pa.Array:
    return block.field(name).take(pa.array(at))


def pairs(threshold: int, name: str) -> Fold:
    """a, b (of the column), d."""

    def fold(a, b, own):
        for i, j, d in links(hashes_of(a), hashes_of(b), threshold, own):
            yield {"a": put(a, name, i), "b": put(b, name, j), "d": pa.array(d, pa.int32())}

    return fold


def counts(threshold: int) -> Fold:
    """d, pairs: of rows counted by n."""

    def fold(a, b, own):
        na, nb = (x.field("n").to_numpy() for x in (a, b))
        sums = np.zeros(threshold + 1, np.int64)
        if own:
            sums[0] = (na * (na - 1) // 2).sum()
        for i, j, d in links(hashes_of(a), hashes_of(b), threshold, own):
            np.add.at(sums, d, na[i] * nb[j])
        yield {"d": pa.array(np.flatnonzero(sums), pa.int32()), "pairs": pa.array(sums[sums > 0])}

    return fold


def merge(roots: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Unite the ends of links; each place points to the smallest of its component, before and after."""
    while True:
        rx, ry = roots[x], roots[y]
        apart = rx != ry
        if not apart.any():
            return
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(roots, np.maximum(rx, ry), np.minimum(rx, ry))
        while (up := roots[roots]).tobytes() != roots.tobytes():
            roots[:] = up


def forest(threshold: int) -> Fold:
    """a, b: hashes, as edges that connect what the pairs of the blocks connect; one less than hashes at most."""

    def fold(a, b, own):
        ha, hb = hashes_of(a), hashes_of(b)
        every = ha if own else np.concatenate([ha, hb])
        roots = np.arange(len(every))
        for i, j, _ in links(ha, hb, threshold, own):
            merge(roots, i, j if own else j + len(ha))
        hung = np.flatnonzero(roots != np.arange(len(roots)))
        every = every.view(np.int64)
        yield {"a": pa.array(every[roots[hung]]), "b": pa.array(every[hung])}

    return fold


def ranks(*ids: pa.Array) -> list[np.ndarray]:
    """Places of the ids in the order of all of them; equal ones have one place."""
    joined = pc.rank(pa.concat_arrays(ids), sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
    return np.split(joined, np.cumsum([len(x) for x in ids])[:-1])


def nearest(threshold: int) -> Fold:
    """h, b, d: for each hash of the first block the smallest id of the second within the threshold, and its distance."""

    def fold(a, b, own):
        (order,) = ranks(b.field("id"))
        free = np.iinfo(np.int64).max
        best = np.full(len(a), free)
        for i, j, d in links(hashes_of(a), hashes_of(b), threshold, False):
            # One id has one row, or the nearer of several.
            np.minimum.at(best, i, order[j] * 128 + d)
        found = np.flatnonzero(best < free)
        first = np.zeros(order.max(initial=0) + 1, np.int64)
        first[order] = np.arange(len(order))
        yield {"h": put(a, "h", found), "b": put(b, "id", first[best[found] // 128]), "d": pa.array(best[found] % 128, pa.int32())}

    return fold


def first(threshold: int, n: int) -> Fold:
    """a < b, d: the first n pairs of ids by a and b."""

    def fold(a, b, own):
        ids = pa.concat_arrays([a.field("id"), b.field("id")])
        ra, rb = ranks(a.field("id"), b.field("id"))
        kept = np.empty((3, 0), np.int64)  # key, places in a and b times 128 and d
        width = len(ids) + 1
        for i, j, d in links(hashes_of(a), hashes_of(b), threshold, own):
            x, y = ra[i], rb[j]
            apart = x != y
            i, j, d, x, y = i[apart], j[apart], d[apart].astype(np.int64), x[apart], y[apart]
            swapped = x > y
            one, two = np.where(swapped, j + len(a), i), np.where(swapped, i, j + len(a))
            new = np.stack([np.minimum(x, y) * width + np.maximum(x, y), one, two * 128 + d])
            kept = np.concatenate([kept, new], axis=1)
            if kept.shape[1] > n:
                kept = kept[:, np.argsort(kept[0], kind="stable")[:n]]
        take = lambda at: ids.take(pa.array(at))
        yield {"a": take(kept[1]), "b": take(kept[2] // 128), "d": pa.array(kept[2] % 128, pa.int32())}

    return fold


def dealt(rows: DataFrame, keys: list[str], columns: list[str], n: int) -> DataFrame:
    """at, keys, rows: the rows (h and other columns) in blocks of one value of the keys."""
    blocks = max(1, -(-n // min(LARGE, max(SMALL, n // 12))))
    block = F.pmod(F.xxhash64(*columns), F.lit(blocks)).alias("_block")
    made = rows.where("h IS NOT NULL").groupBy(*keys, block).agg(F.collect_list(F.struct(*columns)).alias("rows")).drop("_block")
    return save(made.withColumn("at", F.monotonically_increasing_id()), "blocks")


def crossed(left: DataFrame, right: DataFrame | None, keys: list[str], columns: list[str], n: int, fold: Fold, schema: str, meet: Callable[[tuple, tuple], bool] = lambda a, b: True) -> DataFrame:
    """a_key and b_key for each key, and the fold's columns, of all pairs of blocks of two tables whose keys meet; without right, of the left with itself.

    Of two blocks of one table meet() decides for either order, and the first order that meets is taken. The
    driver gets the keys of the blocks and gives back their pairs, some thousands for a million rows.
    """
    a = dealt(left, keys, columns, n)
    b = a if right is None else dealt(right, keys, columns, n)
    ends = [[(r["at"], tuple(r[k] for k in keys)) for r in x.select("at", *keys).orderBy("at").collect()] for x in ((a,) if right is None else (a, b))]
    if right is None:
        two = [(x, y) for k, x in enumerate(ends[0]) for y in ends[0][k:]]
        two = [(x, y) if meet(x[1], y[1]) else (y, x) for x, y in two if meet(x[1], y[1]) or meet(y[1], x[1])]
    else:
        two = [(x, y) for x in ends[0] for y in ends[1] if meet(x[1], y[1])]
    spark = left.sparkSession
    tasks = max(1, min(len(two), MAX_TASKS, n * n // TASK_CELLS))
    listed = spark.createDataFrame([(k, x[0], y[0]) for k, (x, y) in enumerate(two)], "pair long, a long, b long")
    side = lambda rows, c: F.broadcast(listed).join(rows.withColumnRenamed("at", c), c).select(F.col("pair"), F.col(c), *(F.col(k).alias(f"{c}_{k}") for k in keys), F.col("rows").alias(f"rows_{c}")).repartition(tasks, "pair")
    met = side(a, "a").join(side(b, "b"), "pair")
    own, names = right is None, [f"{c}_{k}" for k in keys for c in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                x, y = (batch.column(f"rows_{c}").slice(r, 1).flatten() for c in "ab")
                same = own and batch.column("a")[r].as_py() == batch.column("b")[r].as_py()
                for made in fold(x, y, same):
                    rows = len(next(iter(made.values())))
                    if rows:
                        fixed = {k: pa.repeat(batch.column(k)[r], rows) for k in names}
                        yield pa.RecordBatch.from_pydict(fixed | made)

    kinds = dict(met.dtypes)
    return met.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in names), schema]))

