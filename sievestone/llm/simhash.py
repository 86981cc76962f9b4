"""SimHash near-duplicates by the generalised pigeonhole principle.

If two 64-bit fingerprints differ in at most R bits and the bits are divided into parts with thresholds
t_1..t_m that sum to R - m + 1 (each -1 or more; -1 skips the part), then some part differs in at most
its t_i bits. Correlated bits share a part, so that the other parts tell texts apart; each fingerprint
gets thresholds of its own from a dynamic programme over the number of candidates it would meet,
estimated from a histogram of part values over all fingerprints. It then probes an index of all
fingerprints by the part values within its thresholds, and each candidate is verified on all 64 bits.

In a crowd of near copies every part may be crowded. A fingerprint for which every division costs more
than CROWD_COST does not probe. Crowded fingerprints meet at the 65 points within one bit of them: two
fingerprints differ in at most two bits exactly if they share such a point, and a point has 65 members
at most. Links between a crowded and another fingerprint come from the probe of the other. So work is
linear in the fingerprints, whatever their distribution, and no link is lost. Rows with equal
fingerprints are one node.

The stage of near copies (near_copies.py) uses fingerprints of five-word shingles and a wider radius: the
widest whose probes and candidates have a given cost among evenly spread fingerprints. There crowded
fingerprints are linked to each other within two bits only; the stage finds the rest of a crowd itself.

Results for odd input: null and empty texts have fingerprint zero; texts of one or two words have one
shingle; rows with a null doc_id get a fingerprint and never give a component its id unless all its
ids are null; repeated rows each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from . import common

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
#: Cells of a part's histogram. Parts of up to 16 bits are counted exactly; wider ones share cells, which only raises an estimate.
CELLS = 1 << 16
#: Probes and expected candidates from which on a fingerprint counts as crowded: three times the 65 rows of the other way.
CROWD_COST = 3 * (BITS + 1)
SHINGLES_AT_ONCE = 1 << 16
#: Most bits within which a part is probed, and the numbers of parts to choose from for a radius wider than RADIUS.
MAX_EACH, PARTS = 2, range(2, 9)


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text in UTF-8, as a signed 64-bit integer."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes: Iterator[int] = iter([xxhash.xxh64_intdigest(b" ".join(words), SEED)])
        n = 1
    else:
        n = len(words) - SHINGLE + 1
        digest = xxhash.xxh64_intdigest
        hashes = (digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)))))
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        h = np.fromiter(hashes, np.uint64, count=min(SHINGLES_AT_ONCE, n - start))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of hashes (unsigned) that are at hand, as a signed 64-bit integer."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), SHINGLES_AT_ONCE):
        h = np.ascontiguousarray(hashes[start : start + SHINGLES_AT_ONCE])
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def add_fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = b.schema.get_field_index("text")
        fp = pa.array([fingerprint(t or b"") for t in b.column(at).cast(pa.binary()).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([fp if k == at else c for k, c in enumerate(b.columns)], names=["fp" if k == at else n for k, n in enumerate(b.schema.names)])


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns named and fp, one row for each row of docs."""
    common.python_batches(docs.sparkSession)
    rows = docs.select(*keep, "text")
    kinds = ", ".join(f"{c} {k}" for c, k in rows.dtypes if c != "text")
    return rows.mapInArrow(add_fingerprint, f"{kinds}, fp long")


def bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two bits are both 1 in a partition; on the diagonal, how often one is."""
    both = np.zeros((BITS, BITS))
    for b in batches:
        bits = np.unpackbits(b.column("fp").to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        for k in range(0, len(bits), 1 << 14):
            both += bits[k : k + (1 << 14)].T @ bits[k : k + (1 << 14)]
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS), pa.int32()), pa.array(both.ravel().astype(np.int64))], names=["cell", "n"])


def group_bits(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Divide the bits into parts of like size, greedily by absolute correlation; ties by bit number."""
    p = np.diag(both) / max(total, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(total, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            nearest = max(left, key=lambda b: (corr[b, group].sum(), -b))
            left.remove(nearest)
            group.append(nearest)
        groups.append(sorted(group))
    return groups


def part_values(fp: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [sum(((u >> np.uint64(b)) & np.uint64(1)) << np.uint64(k) for k, b in enumerate(g)) for g in groups]


def cells(values: np.ndarray) -> np.ndarray:
    return ((values ^ (values >> np.uint64(16))) & np.uint64(CELLS - 1)).astype(np.int64)


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of the values within a radius, by growing distance."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.uint64)


def allocate(values: list[np.ndarray], widths: list[int], histogram: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds (rows x parts) and their cost. Shifted by one, thresholds are 0..radius+1 and sum to radius + 1."""
    n, most = len(values[0]), radius + 1
    best = np.full((most + 1, n), np.inf)
    best[0] = 0
    picks = []
    for v, w, h in zip(values, widths, histogram):
        cost, met, start = np.zeros((most + 1, n)), np.zeros(n), 0
        cost[MAX_EACH + 2 :] = np.inf
        for s in range(1, min(most, MAX_EACH + 1) + 1):
            masks = ball(w, s - 1)
            for m in masks[start:]:
                met = met + h[cells(v ^ m)]
            start = len(masks)
            cost[s] = met + start
        paths = np.stack([np.stack([best[s - use] + cost[use] if use <= s else np.full(n, np.inf) for use in range(most + 1)]) for s in range(most + 1)])
        picks.append(paths.argmin(1))
        best = paths.min(1)
    thresholds, left = np.zeros((n, len(values)), np.int64), np.full(n, most)
    for k in range(len(values) - 1, -1, -1):
        use = picks[k][left, np.arange(n)]
        thresholds[:, k] = use - 1
        left = left - use
    return thresholds, best[most]


def even_cost(total: int, parts: int, radius: int) -> float:
    """Probes and expected candidates of a fingerprint among so many evenly spread ones."""
    widths = [BITS * (k + 1) // parts - BITS * k // parts for k in range(parts)]
    histogram = np.stack([np.full(CELLS, total / (1 << w)) for w in widths])
    return float(allocate([np.zeros(1, np.uint64)] * parts, widths, histogram, radius)[1][0])


def widest(total: int, cost: float, most: int) -> tuple[int, float]:
    """The widest radius up to most, RADIUS at least, that costs so much at most among total evenly spread fingerprints; and what it costs."""
    for radius in range(most, RADIUS, -1):
        needed = min(even_cost(total, parts, radius) for parts in PARTS)
        if needed <= cost:
            break
    else:
        radius, needed = RADIUS, min(even_cost(total, parts, RADIUS) for parts in PARTS)
    return radius, needed


def single_values(histogram: np.ndarray, widths: list[int], total: int) -> np.ndarray:
    """How many fingerprints have one value of a part: where values share a cell, its even share and what the cell has beyond chance."""
    shared = total / CELLS
    beyond = np.maximum(histogram - shared - 4 * math.sqrt(shared), 0)
    return np.stack([h if 1 << w <= CELLS else total / (1 << w) + more for h, w, more in zip(histogram, widths, beyond)])


def links(nodes: DataFrame, radius: int = RADIUS, crowd_cost: float | None = None, tables: common.Tables | None = None) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of nodes (fp) that connect all pairs within radius.

    If the radius is wider than RADIUS, crowded fingerprints, those that cost more than crowd_cost, are connected
    to each other within RADIUS only.
    """
    if radius < RADIUS:
        raise ValueError("crowded fingerprints meet at single-bit neighbours, which links two bits")
    limit = CROWD_COST if crowd_cost is None else crowd_cost
    spark, total = nodes.sparkSession, nodes.count()
    # About as many values in a part as there are fingerprints, or more: two parts for very many.
    parts = max(2, min(4, BITS // max(1, math.ceil(math.log2(max(total, 2))))))
    if radius > RADIUS:
        parts = min(PARTS, key=lambda n: even_cost(total, n, radius))
    pairs = nodes.mapInArrow(bit_counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for row in pairs:  # 4096 rows
        both[row.cell] = row.n
    groups = group_bits(both.reshape(BITS, BITS), total, parts)
    widths = [len(g) for g in groups]

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((parts, CELLS), np.int64)
        for b in batches:
            for k, v in enumerate(part_values(b.column("fp").to_numpy(), groups)):
                seen[k] += np.bincount(cells(v), minlength=CELLS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen.ravel()[at])], names=["cell", "n"])

    histogram = np.zeros(parts * CELLS)
    found = nodes.mapInArrow(counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # parts * CELLS rows at most
    histogram[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    histogram = histogram.reshape(parts, CELLS)
    shared = spark.sparkContext.broadcast(single_values(histogram, widths, total) if radius > RADIUS else histogram)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: index entries, 1: probes, both with a key of part and value; 2: points next to crowded fingerprints."""
        for b in batches:
            for fp in np.array_split(b.column("fp").to_numpy(), max(1, b.num_rows >> 13)):
                values = part_values(fp, groups)
                thresholds, cost = allocate(values, widths, shared.value, radius)
                out = [(0, (v | np.uint64(k << 56)).view(np.int64), fp) for k, v in enumerate(values)]
                crowded = cost > limit
                for k, v in enumerate(values):
                    for t in range(min(radius, MAX_EACH) + 1):
                        who = ~crowded & (thresholds[:, k] == t)
                        if who.any():
                            masks = ball(widths[k], t)
                            keys = (v[who][:, None] ^ masks) | np.uint64(k << 56)
                            out.append((1, keys.view(np.int64).ravel(), np.repeat(fp[who], len(masks))))
                if crowded.any():
                    points = fp[crowded].view(np.uint64)[:, None] ^ ball(BITS, 1)
                    out.append((2, points.view(np.int64).ravel(), np.repeat(fp[crowded], BITS + 1)))
                for kind, keys, owners in out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(owners)], names=["kind", "key", "fp"])

    rows = (tables.save if tables else common.save)(nodes.mapInArrow(common.tidy(probes) if tables else probes, "kind int, key long, fp long"), "simhash-probes")
    index, asked = rows.where("kind = 0").select("key", F.col("fp").alias("a")), rows.where("kind = 1").select("key", F.col("fp").alias("b"))
    probed = index.join(asked, "key").where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
    at_point = rows.where("kind = 2").groupBy("key").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("members")).where("size(members) > 1")
    return probed.unionByName(at_point.select("a", F.explode("members").alias("b")).where("a <> b"))


def fingerprint_components(prints: DataFrame, rank: str = "doc_id") -> DataFrame:
    """(fp, component_id) for each distinct fp of prints (fp, rank): the smallest rank reachable."""
    nodes = common.save(prints.groupBy("fp").agg(F.min(rank).alias("least_id")), "simhash-nodes")
    labels = connected_components(links(nodes.select("fp")))
    known = nodes.join(labels, nodes["fp"] == labels["node"], "left").select("fp", "least_id", F.coalesce("label", "fp").alias("label"))
    least = known.groupBy("label").agg(F.min("least_id").alias("component_id"))
    return known.join(least, "label").select("fp", "component_id")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for each row of docs."""
    prints = common.save(fingerprints(docs, "doc_id"), "simhash-prints")
    groups = fingerprint_components(prints)
    return prints.join(groups, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each group of near copies; see near_copies."""
    from . import near_copies  # which uses this module

    return near_copies.keep_one(docs)
