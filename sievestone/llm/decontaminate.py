"""Benchmark passages inside documents, by SimHash of item-sized windows.

Words are lower-cased runs without ASCII white space; shingles are five words, with repeats. Each window
of a document with as many shingles as an item, or fewer at the document's head and tail, could hold that
item; only a window that shares a shingle with it can be similar. For a weighted Jaccard similarity of S a
window must hold ceil(S * n) of an item's n shingles, so it holds one of any n - ceil(S * n) + 1 of them:
windows are taken around these anchors, the item's shingles that the fewest items have, and no other
window can reach S. Each such window gets a SimHash. Two fingerprints within RADIUS bits are equal in one of
RADIUS + 1 blocks of bits: windows look the values of their blocks up among those of the items that own the
anchor, the distance of the whole fingerprints is verified, and the weighted similarity of the shingles
themselves decides. At similarity 0.8 a bit differs with probability 0.15, so 21 of 64 bits lose about one in
ten thousand of the pairs just at the limit, and practically none well above.

Items of the same words are one item until the end. Everything is DataFrame functions. The anchors, some
tenth of the benchmark's shingles, go to all executors in blocks of BLOCK_ANCHORS; a larger benchmark
takes more passes over the documents.

Results for odd input: items and documents of fewer than five words have no shingle and match nothing, as
do null texts; repeated rows match each; null ids are carried; empty tables give an empty result; other
columns are ignored by matches() and pass through without_benchmark(), whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common, digest_filter

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS = 64, 21
BLOCK_ANCHORS = 200_000
#: Up to this many index rows of 28 bytes go to all executors; more are joined by a shuffle.
BROADCAST_INDEX = 400_000
#: Counts of 4 bits of a fingerprint share a long, in lanes of 16 bits; of more shingles than this they are counted apart.
LANES, LANE_BITS = 0x0001000100010001, 14
LANE_ROOM = 1 << LANE_BITS


def words(trimmed: Column) -> Column:
    """The words of a text that is lower-cased and stripped."""
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, common.SPACE_CLASS + "+"))


def shingle_hashes(word_array: str) -> tuple[Column, Column]:
    """Hashes of all shingles of the word array column of that name."""
    hashed = F.transform(word_array, lambda w: F.xxhash64(w))
    made = F.transform(F.sequence(F.lit(0), F.size(word_array) - SHINGLE), lambda i: F.xxhash64(*(F.get(F.col("_hashed"), i + k) for k in range(SHINGLE))))
    return F.when(F.size(word_array) >= SHINGLE, made).otherwise(F.array().cast("array<bigint>")), hashed


def with_shingles(rows: DataFrame, text: Column) -> DataFrame:
    """rows with _words and _shingles (hashes). No filter here: it would be pushed below and split each text twice."""
    made, hashed = shingle_hashes("_words")
    rows = rows.withColumn("_trimmed", common.strip_space(common.ascii_lower(text))).withColumn("_words", words(F.col("_trimmed")))
    return rows.withColumn("_hashed", hashed).withColumn("_shingles", made).drop("_hashed", "_trimmed")


def shifted(c: Column, by: int, left: bool = False) -> Column:
    return F.call_function("shiftleft" if left else "shiftrightunsigned", c, F.lit(by)) if by else c


def simhash(rows: DataFrame, shingles: str, fp: str) -> DataFrame:
    """rows with the fingerprint of an array of hashes: bit b is 1 if more than half of them have it."""
    many, lanes = F.size(shingles), F.lit(LANES)
    sums = [lane_sum(shingles, b) for b in range(16)]
    # Bit LANE_BITS of a lane is set if its count is over half.
    over = (F.lit((1 << LANE_BITS) - 1) - F.floor(many / 2)).cast("long") * lanes
    fast = reduce(lambda a, b: a.bitwiseOR(b), (shifted(shifted(F.col(f"_sum{b}") + over, LANE_BITS).bitwiseAND(lanes), b, left=True) for b in range(16)))
    ones = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.struct(b.alias("b"), F.size(F.filter(shingles, lambda h: F.getbit(h, b) == 1)).alias("n")))
    slow = F.aggregate(ones, F.lit(0).cast("long"), lambda acc, x: F.when(2 * x["n"] > many, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["b"]))).otherwise(acc))
    rows = rows.withColumns({f"_sum{b}": s for b, s in enumerate(sums)})
    return rows.withColumn(fp, F.when(many < LANE_ROOM, fast).otherwise(slow)).drop(*(f"_sum{b}" for b in range(16)))


def lane_sum(shingles: str, b: int) -> Column:
    """How many hashes have the bits b, b + 16, b + 32 and b + 48, each in its lane."""
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda a, h: a + shifted(h, b).bitwiseAND(F.lit(LANES)))


def block_masks() -> list[int]:
    """The bits of each block, as signed longs. If every block changes, the fingerprint does by more than RADIUS bits."""
    edges = [BITS * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    masks = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def block_values(fp: Column) -> Column:
    """(block, value) for each block of a fingerprint."""
    return F.array(*(F.struct(F.lit(k).alias("block"), fp.bitwiseAND(F.lit(m).cast("long")).alias("value")) for k, m in enumerate(block_masks())))


def first_equal(a: Column, b: Column) -> Column:
    """The first block in which two fingerprints are equal."""
    return F.coalesce(*(F.when(a.bitwiseXOR(b).bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(k)) for k, m in enumerate(block_masks())))


def least_held(n: Column, similarity: float) -> Column:
    """Of an item's n shingles, how many a similar window must hold."""
    return F.ceil(n * F.lit(similarity) - 1e-9).cast("int")


def item_tables(benchmark: DataFrame, tables: common.Tables) -> tuple[DataFrame, DataFrame]:
    """item, n, shingles (hashes), words, fp of the distinct items that have a shingle; item, item_id of all of them."""
    rows = with_shingles(benchmark.select("item_id", common.whole_text().alias("_text")), F.col("_text")).where(F.size("_shingles") > 0)
    rows = tables.save(rows.select("item_id", F.col("_shingles").alias("shingles"), F.col("_words").alias("words"), F.sha2(F.array_join("_words", " "), 256).alias("digest")), "decontaminate-items")
    one = rows.groupBy("digest").agg(F.first(F.struct("shingles", "words")).alias("c")).select("digest", "c.*")
    one = simhash(one.withColumn("n", F.size("shingles")), "shingles", "fp").withColumn("item", F.monotonically_increasing_id())
    items = tables.save(one.select("digest", "item", "n", "shingles", "words", "fp"), "decontaminate-items")
    return items.drop("digest"), items.select("digest", "item").join(rows.select("digest", "item_id"), "digest").select("item", "item_id")


def anchors(items: DataFrame, similarity: float) -> DataFrame:
    """(h, item, n): for each item, as many of its rarest shingles as no similar window can lack all."""
    placed = items.select("item", "n", F.explode("shingles").alias("h"))
    spread = placed.select("item", "h").distinct().groupBy("h").agg(F.count("*").alias("items"))
    ranked = placed.join(spread, "h").withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy("items", "h")))
    return ranked.where(F.col("rank") <= F.col("n") - least_held(F.col("n"), similarity) + 1).select("h", "item", "n").distinct()


def anchor_hits(docs: DataFrame, items: DataFrame, similarity: float, tables: common.Tables) -> DataFrame:
    """For each anchor in a document and each item that owns it, the words of all windows of the item's size that contain it."""
    found = tables.save(anchors(items, similarity), "decontaminate-anchors")
    blocks = -(-found.count() // BLOCK_ANCHORS)
    rows = with_shingles(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("_text")), F.col("_text"))
    all_hits = None
    for k in range(max(1, blocks)):
        some = found.where(F.pmod(F.xxhash64("h", "item"), F.lit(max(1, blocks))) == k)  # about BLOCK_ANCHORS rows of 20 bytes
        placed = rows.select("row", "doc_id", "_text", "_words", F.size("_shingles").alias("size"), F.posexplode_outer("_shingles").alias("at", "h"))
        first = F.greatest(F.col("at") - F.col("n") + 1, F.lit(0))
        last = F.least(F.col("at") + F.col("n") - 1, F.col("size") - 1)
        hits = placed.join(F.broadcast(some), "h").select(
            "row", "doc_id", F.sha2("_text", 256).alias("text_sha256"), "item", "n", "at", first.alias("first"), "size", F.slice("_words", first + 1, last - first + SHINGLE).alias("words")
        )
        all_hits = hits if all_hits is None else all_hits.unionByName(hits)
    return tables.save(all_hits, "decontaminate-hits")


def contents(hits: DataFrame) -> DataFrame:
    """text_sha256, item, n, at, first, size, words: the hits of each distinct text once, however many documents repeat it."""
    one = hits.groupBy("text_sha256", "item", "at").agg(F.first(F.struct("n", "first", "size", "words")).alias("c"))
    return one.select("text_sha256", "item", "at", "c.*")


def extent(size: Column) -> tuple[Column, Column]:
    """Where the window (start, n) of a document of that size begins and how many shingles it has; start is negative for short ones at the head."""
    low = F.greatest(F.col("start"), F.lit(0))
    return low, F.least(F.col("start") + F.col("n"), size) - low


def windows(content: DataFrame, similarity: float) -> DataFrame:
    """text_sha256, item, n, at, start, fp: each window around an item's anchor that is long enough, once. Only fingerprints are kept of it."""
    spark = content.sparkSession
    # Many rows in few bytes: as many tasks as a shuffle has.
    content = content.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "text_sha256", "item")
    before = F.lag("at").over(W.partitionBy("text_sha256", "item").orderBy("at"))
    held = least_held(F.col("n"), similarity)
    begin = F.greatest(F.col("at") - F.col("n") + 1, held - F.col("n"), F.coalesce(F.col("before") + 1, held - F.col("n")))
    end = F.least(F.col("at"), F.col("size") - held)
    made, hashed = shingle_hashes("words")
    rows = content.withColumn("before", before).withColumns({"begin": begin, "end": end}).where("begin <= end").withColumn("_hashed", hashed).withColumn("_shingles", made)
    rows = rows.select("text_sha256", "item", "n", "at", "first", "size", "_shingles", F.explode(F.sequence("begin", "end")).alias("start"))
    low, length = extent(F.col("size"))
    rows = rows.withColumn("_window", F.slice("_shingles", low - F.col("first") + 1, length))
    return simhash(rows, "_window", "fp").select("text_sha256", "item", "n", "at", "start", "fp")


def text_shingles(word_array: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(word_array) - SHINGLE), lambda i: F.concat_ws(" ", F.slice(word_array, i + 1, SHINGLE)))


def near_items(placed: DataFrame, items: DataFrame, tables: common.Tables) -> DataFrame:
    """The windows (text_sha256, item, n, at, start, fp) within RADIUS bits of an item that owns their anchor."""
    index = tables.save(items.select("item", F.col("fp").alias("item_fp"), F.inline(block_values(F.col("fp")))), "decontaminate-index")
    few = index.count() <= BROADCAST_INDEX
    probes = placed.select("text_sha256", "item", "n", "at", "start", "fp", F.inline(block_values(F.col("fp"))))
    near = probes.join(F.broadcast(index) if few else index, ["item", "block", "value"])
    within = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    return near.where(within & (F.col("block") == first_equal(F.col("fp"), F.col("item_fp")))).select("text_sha256", "item", "n", "at", "start")


def text_matches(hits: DataFrame, items: DataFrame, similarity: float, tables: common.Tables) -> DataFrame:
    """text_sha256, item, start_word, similarity: the best window of each distinct text and item."""
    content = tables.save(contents(hits), "decontaminate-contents")
    pairs = near_items(windows(content, similarity), items, tables)
    made, hashed = shingle_hashes("words")
    region = content.withColumn("_hashed", hashed).withColumn("_shingles", made).select("text_sha256", "item", "at", "first", "size", "words", "_shingles")
    both = pairs.join(region, ["text_sha256", "item", "at"]).join(items.select("item", F.col("shingles").alias("_item")), "item")
    low, length = extent(F.col("size"))
    skip = low - F.col("first") + 1
    both = both.withColumn("_window", F.slice("_shingles", skip, length))
    # Distinct hashes in common and repeats are at least the shingles in common: windows that cannot reach the similarity go.
    repeats = F.least(F.size("_window") - F.size(F.array_distinct("_window")), F.size("_item") - F.size(F.array_distinct("_item")))
    most = F.size(F.array_intersect("_window", "_item")) + repeats
    both = both.where(most >= similarity * (F.size("_window") + F.size("_item") - most) - 1e-9)
    chosen = tables.save(both.select("text_sha256", "item", "n", "start", F.slice("words", skip, length + SHINGLE - 1).alias("w")), "decontaminate-chosen")
    # Weighted similarity of the shingles themselves.
    shingled = chosen.withColumn("w", text_shingles(F.col("w")))
    counted = shingled.select("text_sha256", "item", "n", "start", F.size("w").alias("size"), F.explode_outer("w").alias("s")).groupBy("text_sha256", "item", "n", "start", "size", "s").agg(F.count("*").alias("a"))
    item_counts = items.select("item", F.explode(text_shingles(F.col("words"))).alias("s")).groupBy("item", "s").agg(F.count("*").alias("b"))
    shared = counted.join(item_counts, ["item", "s"]).groupBy("text_sha256", "item", "n", "start", "size").agg(F.sum(F.least("a", "b")).alias("both"))
    alike = shared.select("text_sha256", "item", F.greatest("start", F.lit(0)).alias("start"), (F.col("both") / (F.col("size") + F.col("n") - F.col("both"))).alias("similarity")).where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("start", "similarity"), F.struct("similarity", -F.col("start")))
    found = alike.groupBy("text_sha256", "item").agg(best.alias("best"))
    return found.select("text_sha256", "item", F.col("best.start").cast("long").alias("start_word"), "best.similarity")


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start_word, similarity: the best window of each document and item of that similarity or more."""
    tables = common.Tables()
    items, members = item_tables(benchmark, tables)
    hits = anchor_hits(docs, items, similarity, tables)
    holders = hits.select("row", "doc_id", "text_sha256", "item").distinct()
    found = holders.join(text_matches(hits, items, similarity, tables), ["text_sha256", "item"])
    found = common.save(found.join(members, "item").select("doc_id", "item_id", "start_word", "similarity"), "decontaminate-found")
    tables.drop()
    return found


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, similarity for each document and item that it holds."""
    return matches(docs, benchmark).withColumn("similarity", F.round("similarity", 6))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that hold no item, with their columns. What a document holds depends on its text alone."""
    tables = common.Tables()
    items, _ = item_tables(benchmark, tables)
    held = text_matches(anchor_hits(docs, items, similarity, tables), items, similarity, tables).select("text_sha256").distinct()
    held = common.save(held, "decontaminate-held")
    tables.drop()
    packed = docs.select(F.struct("*").alias("row"), F.sha2(common.whole_text(), 256).alias("text_sha256"))
    return digest_filter.without(packed, held, ["text_sha256"]).select("row.*")
