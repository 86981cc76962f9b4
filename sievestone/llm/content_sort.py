"""Exact duplicates by a distributed sort of normalised content.

Rows are dealt by sampled splitters over (first bytes, digest, doc_id) of the normalised text, so that
a text which a third of all rows share spreads over many partitions. Within a partition an external
sort puts equal texts next to each other; a scan compares each text in full with its neighbour and
closes runs. A text whose run touches a partition's end may continue in the next partition: those runs,
two for each partition at most, are compared in full once more and joined.

Results for odd input: a null text counts as empty; a null doc_id sorts after all others, and in a
group of null ids alone one row stays with a null keep_id; of rows that repeat id and text one stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Characters of the text in the range key. The sampled keys stay small however long the texts are.
PREFIX_CHARS = 48
RUNS = "doc_id long, run long, first boolean, run_keep long, run_size long, text_sha256 string, edge binary"


def normalise(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), common.SPACE_CLASS + "+", " ")


def close_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in a sorted partition; needs (doc_id, norm), keeps one text and the ids of one run."""
    base, run = TaskContext.get().partitionId() << 36, -1
    current, ids, out = None, [], []

    def close(last: bool) -> None:
        keep = next((i for i in ids if i is not None), None)
        digest, edge = hashlib.sha256(current).hexdigest(), run == 0 or last
        out.extend((i, base + run, k == 0, keep, len(ids), digest, current if edge and k == 0 else None) for k, i in enumerate(ids))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 7
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "run", "first", "run_keep", "run_size", "text_sha256", "edge"])
        out.clear()
        return made

    for b in batches:
        for i, text in zip(b.column("doc_id").to_pylist(), b.column("norm").cast(pa.binary()).to_pylist()):
            if text != current:
                if current is not None:
                    close(False)
                current, ids, run = text, [], run + 1
            ids.append(i)
        yield batch()
    if current is not None:
        close(True)
        yield batch()


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of docs."""
    common.python_batches(docs.sparkSession)
    norm = docs.select("doc_id", normalise(F.col("text")).alias("norm"))
    keys = [F.substring("norm", 1, PREFIX_CHARS), F.xxhash64("norm")]
    order = F.col("doc_id").asc_nulls_last()
    dealt = norm.repartitionByRange(*keys, order).sortWithinPartitions(*keys, "norm", order)
    runs = common.save(dealt.mapInArrow(close_runs, RUNS), "content-runs")
    edges = runs.where("edge IS NOT NULL").groupBy("edge").agg(
        F.min("run_keep").alias("all_keep"),
        F.sum("run_size").alias("all_size"),
        F.min_by("run", F.struct(F.col("run_keep").isNull(), "run_keep", "run")).alias("win"),
        F.collect_list("run").alias("runs"),
    )
    # At most two rows for each partition.
    spanning = edges.where(F.size("runs") > 1).select(F.explode("runs").alias("run"), "all_keep", "all_size", "win")
    return runs.join(F.broadcast(spanning), "run", "left").select(
        "doc_id",
        F.when(F.col("win").isNull(), F.col("run_keep")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("first") & (F.col("win").isNull() | (F.col("win") == F.col("run")))).alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n
"""
