"""Toxicity by a factorization machine over hashed terms.

A text is the set of its lower-cased letter runs and their beginnings, hashed into buckets. The score is the logistic of
bias + sum of weights + sum over pairs of <v_i, v_j>, so two terms can say together what neither says
alone, such as an insult next to the mention of a group. Weights are learnt with follow-the-regularised-
leader and an L1 penalty, so that the buckets of the countless neutral words stay exactly zero and long
texts do not add up noise; a bucket gets a vector once its weight is not zero.

The model is fitted on the driver from a bounded sample: the max_train labelled documents of the training
fold with the smallest hashed ids, as far as they have MAX_TERMS terms together. Everything else reads whole tables
and texts. EPOCHS and L1 have the least log loss in a threefold cross-validation within the training folds (three
numbers of epochs by four penalties, summed over sf0.1 and check_s); held-out labels took no part.

Results for odd input: a null or empty text scores the bias alone; null labels are skipped and a document
with several labels counts as toxic if one says so; null ids form a fold of their own (crc32 of the
empty string); without training rows every score is 0.5 and nothing is predicted; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: The bounds of the training sample: documents, and terms of all of them.
MAX_TRAIN, MAX_TERMS = 12_000, 20_000_000
BUCKETS, FACTORS = 1 << 20, 4
EPOCHS, ALPHA, BETA, L1, L2, V_RATE, V_L2, SEED = 5, 0.3, 1.0, 9.0, 1.0, 0.05, 0.01, 42
PREFIXES = (3, 4, 5, 6)
LETTERS = re.compile(r"[^\W\d_]+")
#: Words of which a worker keeps the buckets; beyond them it starts anew.
MAX_WORDS = 200_000


def word_terms(word: str) -> list[str]:
    """The word and its beginnings: insults are inflected and compounded."""
    return [word, *(f"{word[:k]}-" for k in PREFIXES if k < len(word))]


class Terms:
    """Hashed term sets of texts, of active buckets only where those are given; words that were met are kept."""

    def __init__(self, active: dict[int, float] | None = None) -> None:
        self.active = active
        self.known: dict[str, tuple[int, ...]] = {}

    def buckets(self, text: str) -> list[int]:
        import xxhash

        words = set(LETTERS.findall(text.lower()))
        if len(self.known) > MAX_WORDS:
            self.known = {}
        known, active = self.known, self.active
        for w in words.difference(known):
            hashed = [xxhash.xxh32_intdigest(t.encode(), SEED) % BUCKETS for t in word_terms(w)]
            known[w] = tuple(b for b in hashed if active is None or b in active)
        return sorted(set().union(*map(known.__getitem__, words)))


@dataclass
class FactorizationMachine:
    bias: float
    weights: dict[int, float]
    vectors: dict[int, np.ndarray]

    def score(self, buckets: list[int]) -> float:
        known = [b for b in buckets if b in self.weights]
        raw = self.bias + sum(self.weights[b] for b in known)
        v = [self.vectors[b] for b in known if b in self.vectors]
        if len(v) > 1:
            m = np.array(v)
            raw += 0.5 * float((m.sum(0) ** 2).sum() - (m**2).sum())
        return 1 / (1 + float(np.exp(-np.clip(raw, -30, 30))))


def fit(examples: list[np.ndarray], labels: list[int]) -> FactorizationMachine:
    """Follow-the-regularised-leader for weights, adaptive gradients for vectors; the order is fixed by SEED."""
    if not labels:
        return FactorizationMachine(0.0, {}, {})
    rng = np.random.default_rng(SEED)
    used = np.unique(np.concatenate([*examples, np.zeros(0, np.int64)])).astype(np.int64)
    rows = [np.searchsorted(used, e).astype(np.int32) for e in examples]
    z, n = np.zeros(len(used)), np.zeros(len(used))
    v, g2 = rng.normal(0, 0.05, (len(used), FACTORS)).astype(np.float32), np.full((len(used), FACTORS), 1e-2, np.float32)
    share = min(max(sum(labels) / len(labels), 1e-3), 1 - 1e-3)
    bias, bias_g2 = float(np.log(share / (1 - share))), 1.0

    def weights(r: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z[r]) <= L1, 0.0, -(z[r] - np.sign(z[r]) * L1) / ((BETA + np.sqrt(n[r])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for k in rng.permutation(len(labels)):
            r = rows[k]
            w = weights(r)
            active = r[w != 0]
            total = v[active].sum(0)
            raw = bias + w.sum() + 0.5 * ((total**2).sum() - (v[active] ** 2).sum())
            g = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[k]
            bias_g2 += g * g
            bias -= 0.1 * g / np.sqrt(bias_g2)
            grown = np.sqrt(n[r] + g * g)
            z[r] += g - (grown - np.sqrt(n[r])) / ALPHA * w
            n[r] += g * g
            if len(active) > 1:
                gv = g * (total - v[active]) + V_L2 * v[active]
                g2[active] += gv * gv
                v[active] -= V_RATE * gv / np.sqrt(g2[active])
    everything = np.arange(len(used))
    w = weights(everything)
    at = np.flatnonzero(w)
    return FactorizationMachine(bias, {int(used[k]): float(w[k]) for k in at}, {int(used[k]): v[k].astype(np.float32) for k in at})


def training_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, text, toxic: at most max_train labelled documents of the training fold."""
    one = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(common.fold(FOLDS) != HELD_OUT)
    one = one.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # max_train rows of 12 bytes
    return docs.select("doc_id", common.whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> FactorizationMachine:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            found = pa.array([terms.buckets(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), found, b.column("toxic")], names=["doc_id", "buckets", "toxic"])

    common.python_batches(docs.sparkSession)
    sample = training_sample(docs, labels, max_train).withColumn("toxic", F.col("toxic").cast("int"))
    rows = common.save(sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic").mapInArrow(common.tidy(run), "doc_id long, buckets array<int>, toxic int"), "toxicity-sample")
    sizes = rows.groupBy("doc_id").agg(F.sum(F.size("buckets")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # max_train rows at most
    within = int(np.searchsorted(np.cumsum(sizes.column("n").to_numpy()), MAX_TERMS, side="right"))
    if within < sizes.num_rows:
        rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in sizes.column("doc_id").to_pylist()[:within]], "doc_id long")), "doc_id", "left_semi")
    got = rows.toArrow()
    got = got.take(np.argsort(got.column("doc_id").to_numpy(), kind="stable"))  # the sample comes in any order
    lists = got.column("buckets").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    return fit([flat[a:b] for a, b in zip(offsets, offsets[1:])], [int(t > 0) for t in got.column("toxic").to_pylist()])


def scores(docs: DataFrame, model: FactorizationMachine, *keep: str) -> DataFrame:
    """The columns named and score, one row for each row of docs."""
    common.python_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = FactorizationMachine(*shared.value)
        terms = Terms(m.weights)
        for b in batches:
            at = b.schema.get_field_index("_text")
            found = pa.array([m.score(terms.buckets(t)) for t in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([c for k, c in enumerate(b.columns) if k != at] + [found], names=[x for x in b.schema.names if x != "_text"] + ["_score"])

    rows = docs.select(*keep, common.whole_text().alias("_text"))
    kinds = "".join(f"`{c}` {k}, " for c, k in docs.select(*keep).dtypes)
    return rows.mapInArrow(common.tidy(run), f"{kinds}_score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    rows = scores(docs, train(docs, labels), "doc_id")
    return rows.select("doc_id", (common.fold(FOLDS) == HELD_OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score below the threshold, with their columns."""
    columns = docs.columns
    model = train(docs, labels)
    packed = docs.select("text", F.struct(*columns).alias("_row"))
    return scores(packed, model, "_row").where(F.col("_score") < THRESHOLD).select("_row.*")
