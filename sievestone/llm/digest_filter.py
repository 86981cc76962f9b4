"""Which of many rows have a key from a list, without moving the others.

A Bloom filter with one hash function and bounded size goes to all executors. Rows that it cannot hold are
decided where they are; only the rest, those on the list and few others, are shuffled for the exact join.
A list for which even the largest filter is small makes more rows move, with the same result.

Everything is DataFrame functions. Results for odd input: a null key is on no list; an empty list or table
is no special case. Columns _page, _bit, _bits and _maybe must not be among those of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap, as bitmap_construct_agg makes them.
PAGE = 1 << 15
#: Bits wanted for each key, and the most pages of a filter (32 MB).
BITS_EACH, MAX_PAGES = 16, 1 << 13


def place(key: list[str], pages: int) -> tuple[Column, Column]:
    """Page and bit of a key."""
    h = F.xxhash64(*key)
    return F.pmod(F.shiftright(h, 15), F.lit(pages)).cast("int").alias("_page"), h.bitwiseAND(F.lit(PAGE - 1)).alias("_bit")


def split(rows: DataFrame, listed: DataFrame, key: list[str], max_pages: int = MAX_PAGES) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be listed, and those whose is not."""
    pages = max(1, min(max_pages, listed.count() * BITS_EACH // PAGE))
    at = place(key, pages)
    bloom = listed.select(*at).repartition("_page").groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))  # max_pages rows of 4 KB at most
    asked = rows.select("*", *at).join(F.broadcast(bloom), "_page", "left")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod("_bit", F.lit(8)).cast("int")).bitwiseAND(F.lit(1))
    asked = asked.withColumn("_maybe", F.coalesce(bit == 1, F.lit(False)))
    return tuple(asked.where(c).select(*rows.columns) for c in ("_maybe", "NOT _maybe"))


def without(rows: DataFrame, listed: DataFrame, key: list[str], max_pages: int = MAX_PAGES) -> DataFrame:
    """The rows whose key is not listed."""
    maybe, free = split(rows, listed, key, max_pages)
    return free.unionByName(maybe.join(listed, key, "left_anti"))


def among(rows: DataFrame, listed: DataFrame, key: list[str], max_pages: int = MAX_PAGES) -> DataFrame:
    """The rows whose key is listed."""
    return split(rows, listed, key, max_pages)[0].join(listed, key, "left_semi")
