"""Near copies: texts whose five-word shingles have a weighted Jaccard similarity of 0.8 or more.

Words are lower-cased runs without ASCII white space; the k-th repeat of a shingle counts as an element
of its own, so that the weighted similarity is that of sets. Texts of equal words are one node.

Near copies are found by SimHash and the generalised pigeonhole, with the steps of simhash.py: a fingerprint
of the elements, parts of correlated bits, thresholds of each fingerprint by a dynamic programme over
candidate counts, probes, and the distance of the whole fingerprints. The elements of a pair within the
radius then decide. The radius is the widest that costs at most PROBE_COST probes and candidates a text, so
it shrinks as tables grow: 9 bits for 10,000 texts, 6 for 200,000, 3 for 13 million.

No radius that a large table can afford reaches all pairs of similarity 0.8: at just 0.8 a bit differs with
probability 0.15, which takes 21 bits, and then 5 to 29 % of all pairs share a part. So what SimHash has not
linked meets in buckets by minimum hashes, in BANDS bands of ROWS: a pair at just 0.8 shares none with
probability (1 - 0.8^5)^30, seven in a million, and less above. The elements decide here too.

In a bucket of up to SMALL texts all pairs not linked yet are candidates. In a larger one each text meets the bucket's
hub and its neighbours by length first, which links most of a crowd. What is left of a bucket in different
components is compared by sketches: two texts have at least as many elements apart as the bits in which the
parities of their elements by SKETCH cells differ, so a pair with too many such bits cannot be similar. All
other pairs are verified, and no pair of a bucket is left out but those that are linked already or cannot
be similar. Buckets of more than BLOCK texts are compared block by block in tasks of their own; only sketches
meet there, but their number is the square of the texts of a bucket that stay apart.

Results for odd input: texts of fewer than five words, and empty and null ones, are near copies only of
texts with the same words; the row with the smallest doc_id stays, null ids last; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from . import common, simhash
from .simhash import majority

SHINGLE, SEED = 5, 42
#: Similarity 4/5, compared in whole numbers.
SIMILAR, OF = 4, 5
#: Probes and candidates of a text by SimHash, and the radius that loses one in ten thousand of the pairs at just 0.8.
PROBE_COST, MAX_RADIUS = 256, 21
#: A fingerprint is in a crowd if it costs so many times as much as an evenly spread one.
CROWDED = 1.5
BANDS, ROWS = 30, 5
SMALL = 16
AT_ONCE = 1 << 12
#: Bits of a sketch, and texts of a bucket that are compared in one task.
SKETCH, BLOCK = 2048, 1024
#: Up to this many texts with candidates are named to all executors; more are joined by a shuffle.
BROADCAST_NODES = 200_000

_odd = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
FLIP, TIMES = _odd[0][:, None], _odd[1][:, None]
PLACE = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
REPEAT = np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * PLACE[4]
    return x ^ (x >> np.uint64(29))


def elements(words: list[bytes]) -> np.ndarray:
    """Sorted hashes of the shingles, repeats told apart."""
    import xxhash

    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    w = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in words), np.uint64, count=len(words))
    h = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        h = mixed(h + w[k : k + n] * PLACE[k])
    h.sort()
    new = np.concatenate(([True], h[1:] != h[:-1]))
    if not new.all():
        at = np.arange(n)
        nth = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        h = np.where(nth > 0, mixed(h + nth * REPEAT), h)
        h.sort()
    return h


def band_keys(x: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(x), AT_ONCE):
        np.minimum(least, ((x[None, k : k + AT_ONCE] ^ FLIP) * TIMES).min(1), out=least)
    bands, key = least.reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * REPEAT + bands[:, k])
    return key


def texts_of(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    for t in batch.column("text").cast(pa.binary()):
        yield (t.as_py() or b"").lower().split()


def add_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for b in batches:
        digests, sizes, prints, keys = [], [], [], []
        for words in texts_of(b):
            x = elements(words)
            digests.append(xxhash.xxh3_128_digest(b" ".join(words), SEED))
            sizes.append(len(x))
            prints.append(majority(x))
            keys.append(band_keys(x).view(np.int64) if len(x) else np.zeros(0, np.int64))
        columns = [b.column("row"), b.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "digest", "n", "fp", "keys"])


def add_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = pa.array([elements(words).tobytes() for words in texts_of(b)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("row"), made], names=["node", "x"])


def add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parity of a text's elements in each of SKETCH cells."""
    for b in batches:
        made = []
        for v in b.column("x"):
            cells = (np.frombuffer(v.as_buffer(), np.uint64) & np.uint64(SKETCH - 1)).astype(np.int64)
            made.append(np.packbits(np.bincount(cells, minlength=SKETCH) & 1).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(made, pa.binary())], names=["node", "sketch"])


def numbers(column: pa.Array) -> np.ndarray:
    """A column as an array, of a row for each sketch."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), SKETCH // 64) if pa.types.is_binary(column.type) else column.to_numpy()


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns (key first) of sorted batches, cut where the key changes, without keys of one row."""
    kept = None
    for b in batches:
        new = tuple(map(numbers, b.columns))
        kept = new if kept is None else tuple(np.concatenate(x) for x in zip(kept, new))
        end = np.searchsorted(kept[0], kept[0][-1]) if len(kept[0]) else 0
        yield from several(tuple(c[:end] for c in kept))
        kept = tuple(c[end:] for c in kept)
    if kept is not None:
        yield from several(kept)


def several(columns: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    _, start, count = np.unique(columns[0], return_index=True, return_counts=True)
    for s, c in zip(start[count > 1], count[count > 1]):
        yield tuple(x[s : s + c] for x in columns)


def like_sizes(n: np.ndarray, i: np.ndarray | int, j: np.ndarray | slice) -> np.ndarray:
    return SIMILAR * np.maximum(n[i], n[j]) <= OF * np.minimum(n[i], n[j])


def gathered(made: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Batches (kind, a, b) of some size."""
    parts, rows = [], 0
    for kind, a, b in made:
        parts.append((np.full(len(a), kind, np.int32), a, b))
        rows += len(a)
        if rows >= 1 << 16:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["kind", "a", "b"])
            parts, rows = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["kind", "a", "b"])


def first_pairs(batches: Iterator[pa.RecordBatch], small: int) -> Iterator[pa.RecordBatch]:
    """kind 0: candidate pairs of different labels; 1: members of larger buckets (key, node)."""

    def made() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for key, n, node, label in by_key(batches):
            m = len(node)
            if (label == label[0]).all():
                continue
            if m <= small:
                i, j = np.triu_indices(m, 1)
            else:
                hub = int(mixed(node.view(np.uint64) ^ key.view(np.uint64)).argmin())
                at = np.arange(m)
                i, j = np.concatenate((np.full(m - 1, hub), at[:-1])), np.concatenate((at[at != hub], at[1:]))
                yield 1, key, node
            like = like_sizes(n, i, j) & (label[i] != label[j])
            a, b = node[i[like]], node[j[like]]
            yield 0, np.minimum(a, b), np.maximum(a, b)

    return gathered(made())


def pairs_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a block (key, n, node, label, side, sketch) that are in different components and can be similar by their sketches; of two sides, only pairs across."""

    def made() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for _, n, node, label, side, sketch in by_key(batches):
            if (label == label[0]).all():
                continue
            sides = (side != side[0]).any()
            for k in range(len(node) - 1):
                apart = (label[k + 1 :] != label[k]) & like_sizes(n, k, slice(k + 1, None))
                if sides:
                    apart &= side[k + 1 :] != side[k]
                j = k + 1 + np.flatnonzero(apart)
                # Similar by 4/5 means that the elements apart are at most a ninth of both together.
                j = j[n[k] + n[j] >= (SIMILAR + OF) * np.bitwise_count(sketch[j] ^ sketch[k]).sum(1, dtype=np.int32)]
                yield 0, np.minimum(node[k], node[j]), np.maximum(node[k], node[j])

    return gathered(made())


def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column("xa"), b.column("xb")):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(OF * both >= SIMILAR * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def contents(named: DataFrame, rows: DataFrame, tables: common.Tables) -> DataFrame:
    """node, x: the elements of the texts named (_node) of rows (row, text)."""
    named = tables.save(named.distinct(), "near-named")
    some = F.broadcast(named) if named.count() <= BROADCAST_NODES else named
    return tables.save(rows.join(some, F.col("row") == F.col("_node"), "left_semi").select("row", "text").mapInArrow(common.tidy(add_elements), "node long, x binary"), "near-elements")


def verified(pairs: DataFrame, content: DataFrame, tables: common.Tables) -> DataFrame:
    """The pairs that are similar enough."""
    a, b = content.select(F.col("node").alias("a"), F.col("x").alias("xa")), content.select(F.col("node").alias("b"), F.col("x").alias("xb"))
    return tables.save(pairs.join(a, "a").join(b, "b").select("a", "b", "xa", "xb").mapInArrow(common.tidy(alike), "a long, b long"), "near-links")


def in_blocks(members: DataFrame, block: int) -> DataFrame:
    """members (key, n, node, ...) of buckets with side, and a key for each two blocks of a bucket, or for its only one."""
    blocks = F.ceil(F.col("texts") / block).cast("int")
    placed = members.join(members.groupBy("key").agg(F.count("*").alias("texts")), "key").withColumn("side", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return placed.withColumn("key", F.xxhash64("key", F.least("side", "other"), F.greatest("side", "other"))).drop("texts", "other")


def in_buckets(members: DataFrame, pairs: Callable) -> DataFrame:
    """kind, a, b from members (key, n, node, ...), which meet by key."""
    dealt = members.repartition("key").sortWithinPartitions("key", "n", "node")
    return dealt.mapInArrow(common.tidy(pairs), "kind int, a long, b long")


def close_links(nodes: DataFrame, rows: DataFrame, tables: common.Tables) -> DataFrame:
    """Edges (a, b) between similar nodes (node, n, fp) whose fingerprints are equal or within the radius; of equal ones the least node stands for all."""
    sized = nodes.where("n > 0")
    prints = tables.save(sized.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("first")), "near-prints")
    radius, cost = simhash.widest(prints.count(), PROBE_COST, MAX_RADIUS)
    edges = simhash.links(prints.select("fp"), radius, CROWDED * cost, tables)
    a, b = (prints.select(F.col("fp").alias(side), F.col("first").alias(f"_{side}")) for side in "ab")
    apart = edges.join(a, "a").join(b, "b").select("_a", "_b")
    same = sized.join(prints, "fp").select(F.col("first").alias("_a"), F.struct("node", "n").alias("_b"))
    like = SIMILAR * F.greatest("_a.n", "_b.n") <= OF * F.least("_a.n", "_b.n")
    ends = apart.unionByName(same).where(like & (F.col("_a.node") != F.col("_b.node"))).select(F.least("_a.node", "_b.node").alias("a"), F.greatest("_a.node", "_b.node").alias("b"))
    pairs = tables.save(ends.distinct(), "near-close")
    return verified(pairs, contents(pairs.select(F.explode(F.array("a", "b")).alias("_node")), rows, tables), tables)


def links(nodes: DataFrame, rows: DataFrame, tables: common.Tables) -> DataFrame:
    """Edges (a, b) between nodes (node, n, fp, keys) that connect all similar ones; rows (row, text) has their texts."""
    close = close_links(nodes, rows, tables)
    return close.unionByName(other_links(nodes, close, rows, tables))


def other_links(nodes: DataFrame, close: DataFrame, rows: DataFrame, tables: common.Tables) -> DataFrame:
    """Edges (a, b) that connect all similar nodes (node, n, keys) together with those that are close."""
    small = SMALL
    groups = tables.save(connected_components(close).select(F.col("node").alias("_labelled"), "label"), "near-groups")
    known = nodes.select("node", "n", "keys").join(groups, F.col("node") == F.col("_labelled"), "left")
    members = known.select(F.explode("keys").alias("key"), "n", "node", F.coalesce("label", "node").alias("label"))
    found = tables.save(in_buckets(members, lambda batches: first_pairs(batches, small)), "near-buckets")
    pairs = tables.save(found.where("kind = 0").select("a", "b").distinct(), "near-pairs")
    crowds = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node"))
    content = contents(pairs.select(F.explode(F.array("a", "b")).alias("_node")).unionByName(crowds.select(F.col("node").alias("_node"))), rows, tables)
    near = verified(pairs, content, tables)
    if not crowds.limit(1).count():
        return near
    labels = connected_components(close.unionByName(near)).select(F.col("node").alias("_labelled"), "label")
    sketches = crowds.select("node").distinct().join(content, "node").select("node", "x").mapInArrow(common.tidy(add_sketches), "node long, sketch binary")
    sized = nodes.select("node", "n").join(sketches, "node").join(labels, F.col("node") == F.col("_labelled"), "left")
    sized = tables.save(sized.select("node", "n", F.coalesce("label", "node").alias("label"), "sketch"), "near-sketches")
    blocks = in_blocks(crowds.join(sized, "node"), BLOCK).select("key", "n", "node", "label", "side", "sketch")
    left = tables.save(in_buckets(blocks, pairs_across).select("a", "b").distinct(), "near-across")
    return near.unionByName(verified(left, content, tables)) if left.limit(1).count() else near


def keep_one(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each component of near copies in docs, with the columns of docs, whatever their names."""
    common.python_batches(docs.sparkSession)
    rows = common.save(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "near-docs")
    texts = rows.select("row", "doc.doc_id", "doc.text")
    prints = texts.mapInArrow(common.tidy(add_keys), f"row long, doc_id {dict(docs.dtypes)['doc_id']}, digest binary, n int, fp long, keys array<long>")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    least = prints.groupBy("digest").agg(F.min(rank).alias("rank"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
    nodes = common.save(least.select(F.col("rank.row").alias("node"), "rank", "n", "fp", "keys"), "near-nodes")
    tables = common.Tables()
    components = connected_components(links(nodes, texts, tables))
    tables.drop()
    labels = components.select(F.col("node").alias("_labelled"), "label")
    known = nodes.select("node", "rank").join(labels, F.col("node") == F.col("_labelled"), "left")
    best = known.groupBy(F.coalesce("label", "node")).agg(F.min("rank").alias("rank")).select(F.col("rank.row").alias("row"))
    return rows.join(best, "row", "left_semi").select("doc.*")
