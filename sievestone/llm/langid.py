"""Language of texts and of the spans inside them.

A word is a run of letters. Its script, from ranges of code points, leaves the languages that use this
script as candidates. Each candidate scores the word by the mean log-probability of its hashed letter
trigrams and the word itself, times its letters up to eight; a Viterbi path over the words, with a penalty for each switch of language,
labels spans. A text's language is the one with the most letters on its path.

The counts behind the scores come from a bounded sample: the max_train documents of the training fold
with a language and the smallest hashed ids. Prediction reads whole texts.

Results for odd input: a text that is null or has no letter is `und` with score 0; without training rows
every text is `und`; ties go to the language first in order; null ids form a fold of their own; other
columns are ignored; more than MAX_LANGUAGES languages are an error.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS, HELD_OUT = 3, 1
#: The bound of the training sample.
MAX_TRAIN = 20_000
BUCKETS = 1 << 16
#: Cost, in nats, of a switch of language between two words.
SWITCH = 6.0
SMOOTH = 0.5
#: A language uses a script if this share of its training words does.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"
#: More languages in the sample than this are an error: each has a row of 65,536 scores on the driver and in each worker.
MAX_LANGUAGES = 500


def other_numbers() -> str:
    """Ranges of the characters that are alphanumeric to regular expressions, but neither letters nor digits, such as a half."""
    odd = [k for k in range(0x110000) if (c := chr(k)).isalnum() and not c.isalpha()]
    starts = [k for k in odd if not (chr(k - 1).isalnum() and not chr(k - 1).isalpha())]
    ends = [k for k in odd if not (chr(k + 1).isalnum() and not chr(k + 1).isalpha())]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


LETTERS = re.compile(rf"[^\W\d_{other_numbers()}]+")
MAX_WORDS = 200_000
#: Words of a group of texts times texts, padded; bounds the memory of back pointers.
CELLS = 1_000_000

#: First code points of script ranges (Unicode blocks); what stands between counts as other.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"), (0xFE00, "other"),
)
STARTS = [s for s, _ in SCRIPTS]
NAMES = sorted({n for _, n in SCRIPTS})


NUMBERS = [NAMES.index(n) for _, n in SCRIPTS]


def script(word: str) -> int:
    return NUMBERS[bisect_right(STARTS, ord(word[0])) - 1]


class Buckets(dict):
    """Buckets of strings; those of at most three letters are kept."""

    def __missing__(self, part: str) -> int:
        import xxhash

        bucket = xxhash.xxh32_intdigest(part.encode()) % BUCKETS
        if len(part) <= 3 and len(self) < MAX_WORDS:
            self[part] = bucket
        return bucket


def features(word: str, buckets: Buckets) -> list[int]:
    """Buckets of the padded word's trigrams and of the word itself."""
    padded = f"<{word}>"
    parts = {padded[k : k + 3] for k in range(len(padded) - 2)}
    parts.add(padded)
    return [buckets[p] for p in parts]


class Words(dict):
    """Numbers of words, given in the order in which they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class LanguageModel:
    languages: list[str]
    #: languages x BUCKETS, and languages x scripts.
    log_prob: np.ndarray
    uses: np.ndarray
    words: Words = field(default_factory=Words)
    buckets: Buckets = field(default_factory=Buckets)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    letters: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def parts(self) -> tuple:
        return self.languages, self.log_prob, self.uses

    def scores(self, words: list[str]) -> np.ndarray:
        """words x languages."""
        found = [features(w, self.buckets) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        means = np.add.reduceat(self.log_prob.take(flat, axis=1), np.cumsum(sizes) - sizes, axis=1) / sizes
        fit = means * np.minimum(np.fromiter(map(len, words), np.int64, len(words)), 8)
        allowed = self.uses[:, [script(w) for w in words]]
        return np.where(allowed | ~allowed.any(0), fit, -1e6).T.astype(np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))

    def learn(self) -> None:
        """Score the words that got a number since the last time, some thousands at once."""
        new = list(islice(self.words, len(self.letters), None))
        made = [self.scores(new[k : k + 20_000]) for k in range(0, len(new), 20_000)]
        if made:
            self.table = np.concatenate([self.table, *made] if len(self.table) else made)
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, new), np.int64, len(new))])

    def forget(self) -> None:
        if len(self.words) > MAX_WORDS:
            self.words, self.table, self.letters = Words(), self.table[:0], self.letters[:0]

    def paths(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """For each text's word numbers, the language number of each word."""
        self.learn()
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(ids)
        order = sorted((k for k in range(len(ids)) if len(ids[k])), key=lambda k: -len(ids[k]))
        while order:
            lanes = max(1, CELLS // len(ids[order[0]]))
            for k, path in zip(order[:lanes], self._viterbi([ids[k] for k in order[:lanes]], self.table)):
                out[k] = path
            order = order[lanes:]
        return out

    def _viterbi(self, ids: list[np.ndarray], emit: np.ndarray) -> list[np.ndarray]:
        """Lanes go from long to short, so those that still run are the first ones at each step."""
        lengths = np.array([len(i) for i in ids])
        steps, lanes = int(lengths[0]), len(ids)
        at = np.zeros((steps, lanes), np.int32)
        for k, i in enumerate(ids):
            at[: len(i), k] = i
        running = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        best = np.zeros((steps, lanes), np.int8)
        moved = np.zeros((steps, lanes, len(self.languages)), bool)
        state = emit[at[0]]
        for t in range(1, steps):
            n = running[t]
            s = state[:n]
            top = s.argmax(1)
            jump = (s[np.arange(n), top] - SWITCH)[:, None]
            best[t, :n], moved[t, :n] = top, jump > s
            state[:n] = np.maximum(s, jump) + emit[at[t, :n]]
        label = np.zeros((steps, lanes), np.int8)
        now = state.argmax(1)
        lane = np.arange(lanes)
        for t in range(steps - 1, -1, -1):
            n = running[t]
            label[t, :n] = now[:n]
            now[:n] = np.where(moved[t, lane[:n], now[:n]], best[t, :n], now[:n])
        return [label[: len(i), k] for k, i in enumerate(ids)]


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> LanguageModel:
    common.python_batches(docs.sparkSession)
    fit = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").where(common.fold(FOLDS) != HELD_OUT)
    chosen = fit.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # max_train ids
    sample = fit.select("doc_id", "lang", common.whole_text().alias("text")).join(F.broadcast(chosen), "doc_id").select("lang", "text")
    scripts = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts by language: buckets 0..BUCKETS-1 are features, the rest scripts."""
        seen: dict[str, np.ndarray] = {}
        kept: dict[str, np.ndarray] = {}
        buckets = Buckets()
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                counts = seen.setdefault(lang, np.zeros(BUCKETS + scripts, np.int64))
                rows = []
                for w in LETTERS.findall(text.lower()):
                    if w not in kept:
                        if len(kept) > MAX_WORDS:
                            kept.clear()
                        kept[w] = np.array([*features(w, buckets), BUCKETS + script(w)])
                    rows.append(kept[w])
                if rows:
                    counts += np.bincount(np.concatenate(rows), minlength=len(counts))
        for lang, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["lang", "cell", "n"])

    spoken = sample.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if spoken > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the training sample")
    # BUCKETS + scripts rows for each language at most.
    got = sample.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names, cells, ns = got.column("lang").to_pylist(), got.column("cell").to_numpy(), got.column("n").to_numpy()
    languages = sorted(set(names))
    number = {x: k for k, x in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS + scripts))
    np.add.at(counts, (np.array([number[x] for x in names], np.int64), cells.astype(np.int64)), ns)
    grams, script_counts = counts[:, :BUCKETS] + SMOOTH, counts[:, BUCKETS:]
    uses = script_counts >= SCRIPT_SHARE * np.maximum(script_counts.sum(1, keepdims=True), 1)
    return LanguageModel(languages, np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32), uses & (script_counts > 0))


def vote(path: np.ndarray, letters: np.ndarray, languages: list[str]) -> tuple[str, float]:
    if not len(path) or not languages:
        return UNKNOWN, 0.0
    share = np.bincount(path, weights=letters, minlength=len(languages)) / letters.sum()
    return languages[int(share.argmax())], float(share.max())


def stretches(path: np.ndarray) -> int:
    """How many spans of one language a path has."""
    return int(np.count_nonzero(path[1:] != path[:-1])) + (len(path) > 0)


def languages(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, lang_pred, score, n_spans (as spans() gives) for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast((model or train(docs)).parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        for b in batches:
            m.forget()
            ids = [m.numbers(LETTERS.findall(t.lower()) if m.languages else []) for t in b.column("text").to_pylist()]
            votes = [(*vote(p, m.letters[i], m.languages), stretches(p)) for p, i in zip(m.paths(ids), ids)]
            made = [pa.array([v[k] for v in votes], t) for k, t in enumerate((pa.string(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *made], names=["doc_id", "lang_pred", "score", "n_spans"])

    common.python_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, n_spans long")


def spans(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, start, end (code points, end exclusive), lang for each span of one language."""
    shared = docs.sparkSession.sparkContext.broadcast((model or train(docs)).parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        for b in batches:
            m.forget()
            found = [list(LETTERS.finditer(t)) if m.languages else [] for t in b.column("text").to_pylist()]
            paths = m.paths([m.numbers([x[0].lower() for x in f]) for f in found])
            rows = []
            for i, words, path in zip(b.column("doc_id").to_pylist(), found, paths):
                for k, lang in enumerate(path):
                    if k and path[k - 1] == lang:
                        rows[-1][2] = words[k].end()
                    else:
                        rows.append([i, words[k].start(), words[k].end(), m.languages[lang]])
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "start", "end", "lang"])

    common.python_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, end long, lang string")


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans for each row of docs."""
    return languages(docs).select("doc_id", (common.fold(FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "n_spans")
