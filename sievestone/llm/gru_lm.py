"""Log-probabilities of whole documents by a gated recurrent language model in numpy.

Tokens are lower-cased words and one end a document. Counts of all training tokens make a table of word
counts; its most frequent words form the model's vocabulary, the others share a tail class in which a
word's probability follows its count. The output softmax is factored: first the class, then the word in
its class of CLASS_SIZE words; both start from the corpus counts, as biases. A gated recurrent unit
carries its state from window to window, so a document's probability is that of the whole text.

Training reads every training document in full, by truncated backpropagation over windows of WINDOW
tokens with the state carried on, in ROUNDS rounds. In a round a part of the partitions trains, each on its own
documents from the model of the round before; the models and the sums of squared gradients are averaged by
their tokens in a tree, whose last level has at most FAN_IN models, and the step from round to round
keeps some momentum. Small partitions are joined until each trainer has TRAINER_TOKENS, so that a model does not
get worse by being trained in many places.

Word counts grow with the corpus and stay distributed. Only words at least as frequent as a count that at most HOT
words reach (of at most HOT_BYTES bytes each) go to the workers; what a document has of other words is counted,
joined with the table by word and added.

Results for odd input: a null or empty text is the end alone; null ids belong to the training fold
(crc32 of the empty string is 0); repeated rows count and score each; without training rows all
counts are zero and the base is that of an unseen token; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS, HELD_OUT = 7, 2
END = b""
HOT, HOT_BYTES = 1 << 17, 64
CLASSES, CLASS_SIZE = 32, 64
#: Words of the model: the end first, then by falling count.
WORDS = CLASSES * CLASS_SIZE
HIDDEN, WINDOW, LANES = 8, 32, 512
RATE, CLIP, SEED = 0.05, 1.0, 42
FAN_IN = 32
ROUNDS, MOMENTUM, TRAINER_TOKENS = 4, 0.5, 2_000_000
#: Padded tokens of documents that run side by side.
CELLS = 1_000_000
COUNTED_AT_ONCE = 500_000
NAMES = ("x", "u", "wc", "bc", "ww", "bw")


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a partition, given out whenever there are many distinct words."""
    seen: Counter = Counter()

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
        seen.clear()
        return made

    for b in batches:
        for text in b.column("text").cast(pa.binary()).to_pylist():
            seen.update(tokens(text))
            if len(seen) > COUNTED_AT_ONCE:
                yield batch()
    yield batch()


def by_class(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of each word, the order by class, and where each class begins in it. Small integers sort by radix."""
    of = (words // CLASS_SIZE + 1).astype(np.uint8)
    of[words >= WORDS] = 0
    order = np.argsort(of, kind="stable")
    return of, order, np.searchsorted(of.take(order), np.arange(CLASSES + 2))


def exponentials(states: np.ndarray, weights: np.ndarray, biases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of the logits of each state, divided by a number of its own, and the row sums.

    States are between -1 and 1, so no logit exceeds its bias plus the absolute weights; shifted by the largest
    such bound nothing overflows, at no cost for each row. Rows that this leaves too small are shifted by
    their own maximum instead.
    """
    z = states @ weights
    z += biases - (biases + np.abs(weights).sum(0)).max()
    np.exp(z, out=z)
    sums = z @ np.ones(z.shape[1], z.dtype)  # faster than a sum over short rows
    low = np.flatnonzero(~(sums > 1e-30))
    if len(low):
        again = states.take(low, axis=0) @ weights + biases
        again = np.exp(again - again.max(1, keepdims=True))
        z[low], sums[low] = again, again.sum(1)
    return z, sums


def log_softmax_at(states: np.ndarray, weights: np.ndarray, biases: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each state the logarithm of the softmax at one column."""
    z, sums = exponentials(states, weights, biases)
    one = z[np.arange(len(z)), at] / sums
    if one.min() >= 1e-30:
        return np.log(one)
    out = np.log(np.maximum(one, 1e-30))
    low = np.flatnonzero(one < 1e-30)
    if len(low):
        again = (states.take(low, axis=0) @ weights + biases).astype(np.float64)
        top = again.max(1)
        out[low] = again[np.arange(len(low)), at[low]] - top - np.log(np.exp(again - top[:, None]).sum(1))
    return out


def softmax_rows(states: np.ndarray, weights: np.ndarray, biases: np.ndarray) -> np.ndarray:
    z, sums = exponentials(states, weights, biases)
    z /= sums[:, None]
    return z


@dataclass
class Gru:
    """Class 0 is the tail; word k < WORDS is in class 1 + k // CLASS_SIZE; input WORDS is any tail word."""

    x: np.ndarray  # (WORDS + 1, 3 HIDDEN): what a word adds to update, reset and new state
    u: np.ndarray  # (HIDDEN, 3 HIDDEN)
    wc: np.ndarray  # (HIDDEN, CLASSES + 1)
    bc: np.ndarray
    ww: np.ndarray  # (CLASSES, HIDDEN, CLASS_SIZE)
    bw: np.ndarray  # (CLASSES, CLASS_SIZE)

    @classmethod
    def start(cls, counts: np.ndarray, tail: float) -> Gru:
        """counts of the model's words and of all other tokens; the biases are their logarithms, plus one each."""
        rng = np.random.default_rng(SEED)
        by_class = np.zeros((CLASSES, CLASS_SIZE))
        by_class.ravel()[: len(counts)] = counts
        of_class = np.concatenate([[tail + 1], (by_class + 1).sum(1)])
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return cls(
            small(WORDS + 1, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN) * 3, small(HIDDEN, CLASSES + 1), np.log(of_class / of_class.sum()).astype(np.float32),
            small(CLASSES, HIDDEN, CLASS_SIZE), np.log((by_class + 1) / (by_class + 1).sum(1, keepdims=True)).astype(np.float32),
        )

    def params(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in NAMES]

    def blob(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.params()]).astype(np.float32).tobytes()

    @classmethod
    def from_blob(cls, blob: bytes) -> Gru:
        shapes = [p.shape for p in cls.start(np.zeros(1), 0).params()]
        flat, made, at = np.frombuffer(blob, np.float32), [], 0
        for s in shapes:
            made.append(flat[at : at + int(np.prod(s))].reshape(s).copy())
            at += int(np.prod(s))
        return cls(*made)

    def step(self, h: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next states and what backpropagation needs."""
        a, b = self.x.take(words, axis=0), h @ self.u
        gates = a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN]
        gates *= -1
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        inner = b[:, 2 * HIDDEN :]
        new = reset * inner
        new += a[:, 2 * HIDDEN :]
        np.tanh(new, out=new)
        out = h - new
        out *= update
        out += new
        return out, update, reset, inner, new

    def log_probs(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural log-probability of each word after a state; of the tail class for a tail word."""
        of, order, ends = by_class(words)
        out = log_softmax_at(states, self.wc, self.bc, of)
        for c in range(1, CLASSES + 1):
            who = order[ends[c] : ends[c + 1]]
            if len(who):
                out[who] += log_softmax_at(states.take(who, axis=0), self.ww[c - 1], self.bw[c - 1], words.take(who) % CLASS_SIZE)
        return out

    def output_gradient(self, states: np.ndarray, words: np.ndarray, grads: dict[str, np.ndarray]) -> np.ndarray:
        """Of the loss by the states; adds to the gradients of the output."""
        p = softmax_rows(states, self.wc, self.bc)
        of, order, ends = by_class(words)
        p[np.arange(len(of)), of] -= 1
        grads["wc"] += states.T @ p
        grads["bc"] += p.sum(0)
        back = p @ self.wc.T
        for c in range(1, CLASSES + 1):
            who = order[ends[c] : ends[c + 1]]
            if len(who):
                own = states.take(who, axis=0)
                z = softmax_rows(own, self.ww[c - 1], self.bw[c - 1])
                z[np.arange(len(who)), words.take(who) % CLASS_SIZE] -= 1
                grads["ww"][c - 1] += own.T @ z
                grads["bw"][c - 1] += z.sum(0)
                back[who] += z @ self.ww[c - 1].T
        return back


def lanes_of(ids: list[np.ndarray], lanes: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Documents side by side, from long to short: which, their tokens by step, and how many still run at each step."""
    order = sorted(range(len(ids)), key=lambda k: -len(ids[k]))
    while order:
        group = order[: max(1, min(lanes, CELLS // len(ids[order[0]])))]
        order = order[len(group) :]
        lengths = np.array([len(ids[k]) for k in group])
        at = np.full((lengths[0], len(group)), WORDS, np.int32)
        for n, k in enumerate(group):
            at[: len(ids[k]), n] = ids[k]
        yield group, at, np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")


def document_scores(model: Gru, ids: list[np.ndarray], lanes: int = 2 * LANES) -> np.ndarray:
    """Natural log-probability of each list of tokens, the state carried through all windows."""
    out = np.zeros(len(ids))
    for group, at, running in lanes_of(ids, lanes):
        total, h = np.zeros(len(group)), np.zeros((len(group), HIDDEN), np.float32)
        for start in range(0, len(at), WINDOW):
            states, words, owners = [], [], []
            for t in range(start, min(start + WINDOW, len(at))):
                n = running[t]
                h = h[:n]
                states.append(h)
                words.append(at[t, :n])
                owners.append(np.arange(n))
                h = model.step(h, at[t, :n])[0]
            total += np.bincount(np.concatenate(owners), weights=model.log_probs(np.concatenate(states), np.concatenate(words)), minlength=len(group))
        out[group] = total
    return out


class Trainer:
    """Truncated backpropagation with adaptive gradients."""

    def __init__(self, model: Gru, squares: bytes | None = None) -> None:
        self.model, self.seen = model, 0
        sums = Gru.from_blob(squares) if squares else None
        self.squares = {n: getattr(sums, n) if sums else np.full_like(getattr(model, n), 1e-3) for n in NAMES}

    def blob(self) -> bytes:
        """The parameters, and the sums of squared gradients in the same order."""
        return self.model.blob() + np.concatenate([self.squares[n].ravel() for n in NAMES]).astype(np.float32).tobytes()

    def learn(self, ids: list[np.ndarray]) -> None:
        for _, at, running in lanes_of(ids, LANES):
            h = np.zeros((at.shape[1], HIDDEN), np.float32)
            for start in range(0, len(at), WINDOW):
                stop = min(start + WINDOW, len(at))
                h = self.window(h, [at[t, : running[t]] for t in range(start, stop)])

    def window(self, h: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
        m, kept, states = self.model, [], []
        for w in words:
            h = h[: len(w)]
            states.append(h)
            h, *rest = m.step(h, w)
            kept.append(rest)
        sizes = np.array([len(w) for w in words])
        flat, total = np.concatenate(words), int(sizes.sum())
        grads = {n: np.zeros_like(getattr(m, n)) for n in NAMES[1:]}
        out = m.output_gradient(np.concatenate(states), flat, grads)
        inputs = np.zeros((total, 3 * HIDDEN), np.float32)
        ends = np.cumsum(sizes)
        back = np.zeros((sizes[-1], HIDDEN), np.float32)  # nothing flows in from the next window
        for t in range(len(words) - 1, -1, -1):
            before, (update, reset, inner, new) = states[t], kept[t]
            if len(back) < len(before):  # documents that end here
                back = np.concatenate([back, np.zeros((len(before) - len(back), HIDDEN), np.float32)])
            d_new = back * (1 - update) * (1 - new * new)
            d_update = back * (before - new) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            a = inputs[ends[t] - sizes[t] : ends[t]]
            a[:, :HIDDEN], a[:, HIDDEN : 2 * HIDDEN], a[:, 2 * HIDDEN :] = d_update, d_reset, d_new
            by_state = np.concatenate([d_update, d_reset, d_new * reset], 1)
            grads["u"] += before.T @ by_state
            back = back * update + by_state @ m.u.T + out[ends[t] - sizes[t] : ends[t]]
        self.apply(flat, inputs, grads, total)
        return h

    def apply(self, words: np.ndarray, inputs: np.ndarray, grads: dict[str, np.ndarray], total: int) -> None:
        scale = 1 / max(1, total) ** 0.5
        for n, g in grads.items():
            g *= scale
            np.clip(g, -CLIP, CLIP, out=g)
            self.squares[n] += g * g
            getattr(self.model, n)[...] -= RATE * g / np.sqrt(self.squares[n])
        order = np.argsort(words.astype(np.int16), kind="stable")
        sorted_words = words.take(order)
        starts = np.flatnonzero(np.r_[True, sorted_words[1:] != sorted_words[:-1]])
        rows = sorted_words[starts]
        g = np.clip(np.add.reduceat(inputs.take(order, axis=0), starts, axis=0) * scale, -CLIP, CLIP)
        self.squares["x"][rows] += g * g
        self.model.x[rows] -= RATE * g / np.sqrt(self.squares["x"][rows])
        self.seen += total


class Numbers(dict):
    """Numbers of words; any other word has the number given for it, without being stored."""

    other = WORDS

    def __missing__(self, word: bytes) -> int:
        return self.other


def numbered(words: list[bytes], other: int) -> Numbers:
    made = Numbers(zip(words, range(len(words))))
    made.other = other
    return made


@dataclass
class Lexicon:
    """What the workers know of the corpus: the hot words with their counts, and totals."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int

    def __post_init__(self) -> None:
        self.in_model = min(len(self.words), WORDS)
        head = int(self.counts[: self.in_model].sum())
        seen = int((self.counts[: self.in_model] > 0).sum())
        self.tail_total, self.tail_distinct = self.total - head, self.distinct - seen


def count_bin(n: Column) -> Column:
    """Counts below 1,024 by themselves, larger ones by eighths of an octave."""
    return F.when(n < 1024, n).otherwise(1024 + F.floor(F.log2(n) * 8)).cast("int")


def lexicon(table: DataFrame) -> Lexicon:
    """table: word, n."""
    total, distinct = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = table.where((F.octet_length("word") <= HOT_BYTES) & (F.octet_length("word") > 0))
    bins = short.groupBy(count_bin(F.col("n")).alias("bin")).agg(F.count("*").alias("words")).collect()  # some 1,500 rows at most
    least, seen = 0, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        seen += r["words"]
        if seen > HOT:
            least = r["bin"] + 1
            break
    hot = short.where(count_bin(F.col("n")) >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])  # HOT rows at most
    end = table.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = [END, *hot.column("word").to_pylist()]
    counts = np.concatenate([[end], hot.column("n").to_numpy()]).astype(np.int64)
    return Lexicon(words, counts, int(total), int(distinct))


def train(texts: DataFrame, lex: Lexicon) -> Gru:
    """texts: text, of the training documents. Which partition a document is in must not change from job to job."""
    spark, kind = texts.sparkSession, "part long, seen long, model binary"
    now = np.frombuffer(Gru.start(lex.counts[:WORDS], lex.tail_total).blob(), np.float32)
    squares, step = np.full(len(now), 1e-3, np.float32), np.zeros(len(now), np.float32)
    trainers = max(1, lex.total // TRAINER_TOKENS)
    rounds = min(ROUNDS, trainers)
    placed = texts.coalesce(trainers).withColumn("part", F.spark_partition_id())

    def average(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("part").to_pylist(), table.column("seen").to_pylist(), table.column("model").to_pylist()))
        seen = sum(s for _, s, _ in parts)
        mean = sum(np.frombuffer(m, np.float32) * np.float32(s / seen) for _, s, m in parts)
        return pa.table({"part": pa.array([parts[0][0]], pa.int64()), "seen": pa.array([seen], pa.int64()), "model": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})

    for k in range(rounds):
        shared = spark.sparkContext.broadcast((lex.words[:WORDS], now.tobytes(), squares.tobytes()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, blob, sums = shared.value
            get = numbered(words, WORDS).__getitem__
            trainer = Trainer(Gru.from_blob(blob), sums)
            for b in batches:
                trainer.learn([np.fromiter(map(get, tokens(t)), np.int32) for t in b.column("text").cast(pa.binary()).to_pylist()])
            if trainer.seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([trainer.seen], pa.int64()), pa.array([trainer.blob()], pa.binary())], names=["part", "seen", "model"])

        models = common.save(placed.where(F.pmod("part", F.lit(rounds)) == k).select("text").mapInArrow(run, kind), "lm-models")
        left = models.count()
        while left > FAN_IN:
            left = -(-left // FAN_IN)
            models = common.save(models.groupBy(F.pmod("part", F.lit(left)).alias("group")).applyInArrow(average, kind), "lm-models")
        got = models.toArrow()
        if got.num_rows:
            both = np.frombuffer(average(got).column("model")[0].as_py(), np.float32)
            made, squares = both[: len(now)], both[len(now) :]
            step = MOMENTUM * step + (made - now)
            now = made + MOMENTUM * step if rounds > 1 else made
    return Gru.from_blob(now.tobytes())


def document_log_probs(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs."""
    common.python_batches(docs.sparkSession)
    held_out = common.fold(FOLDS) == HELD_OUT
    training = docs.where(~held_out).select(common.whole_text().alias("text"))
    table = common.save(training.mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    lex = lexicon(table)
    model = train(training, lex)
    shared = docs.sparkSession.sparkContext.broadcast((lex.words, lex.counts, lex.total, lex.distinct, model.blob()))
    base_of = lex.total + lex.distinct + 1
    tail_of = lex.tail_total + lex.tail_distinct + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *known, blob = shared.value
        lexicon_here, gru = Lexicon(*known), Gru.from_blob(blob)
        counts, hot = lexicon_here.counts, len(lexicon_here.words)
        get = numbered(lexicon_here.words, hot).__getitem__
        base = np.append(np.log10((counts + 1) / base_of), 0)
        in_tail = np.append(np.log10((counts + 1) / tail_of), 0)
        in_tail[: lexicon_here.in_model] = 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, numbers, offsets, tail_words, tail_counts = [], [], [0], [], []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                words = tokens(text)
                at = np.fromiter(map(get, words), np.int32, len(words))
                rest = Counter(map(words.__getitem__, np.flatnonzero(at == hot).tolist()))
                tail_words += rest.keys()
                tail_counts += rest.values()
                offsets.append(len(tail_words))
                numbers.append((len(words), int((counts[at[at < hot]] > 0).sum()), float(base[at].sum()), float(in_tail[at].sum())))
                ids.append(np.where((at == hot) | (at > WORDS), WORDS, at))
            n_tokens, known_here, base_here, tail_here = zip(*numbers)
            model_scores = document_scores(gru, ids) / np.log(10)
            pairs = pa.StructArray.from_arrays([pa.array(tail_words, pa.binary()), pa.array(tail_counts, pa.int64())], names=["word", "k"])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("row"), b.column("doc_id"), b.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(known_here, pa.int64()), pa.array(base_here, pa.float64()),
                    pa.array(model_scores + np.array(tail_here), pa.float64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "tail"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), common.whole_text().alias("text"))
    kind = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, tail array<struct<word:binary,k:long>>"
    scored = common.save(rows.mapInArrow(run, kind), "lm-scored")
    tail = scored.select("row", F.inline("tail")).join(table, "word", "left").select("row", "k", F.coalesce("n", F.lit(0)).alias("c"))
    tail = tail.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("k") * F.log10((F.col("c") + 1) / base_of)).alias("tail_base"),
        F.sum(F.col("k") * F.log10((F.col("c") + 1) / tail_of)).alias("tail_model"),
    )
    zero = F.lit(0.0)
    return scored.drop("tail").join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("tail_model", zero)).alias("score"),
    )
