"""Helpers that the corpus operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import Tables, drop, new_folder, remove, save  # noqa: F401

#: ASCII white space, \x20 and \x09-\x0D, as a regular expression and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Arrow batches that go to Python hold at most this many bytes; long texts make small batches.
ARROW_BATCH_BYTES = 16 << 20


def python_batches(spark: SparkSession) -> None:
    """Bound the bytes of the Arrow batches that Python workers of this session get."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. lower() does that, fast, where every character is ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def strip_space(c: Column) -> Column:
    return F.trim(c, F.lit(SPACE_CHARS))


def fold(n: int, id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def worker_cache() -> dict:
    """A dictionary that outlives a task within its Python worker.

    It hangs on sys: where a function of this package is sent to a worker as a copy with its globals, a
    module's own dictionary would be a new one in each task.
    """
    return sys.__dict__.setdefault("_sievestone_worker_cache", {})


def release_memory() -> None:
    """Give freed memory of this Python worker back to the machine; an idle worker keeps it otherwise."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over the batches of a task, whose memory goes back when it ends."""

    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return tidied
