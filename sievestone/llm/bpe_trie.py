"""BPE encoding by a walk over a trie of distinct words, and decoding.

The BPE encoding of a byte string is the one sequence of tokens in which each two neighbours are
compatible: merging the bytes of both gives these two tokens again. So the last token of each prefix of
a word is known from shorter prefixes: among the tokens that end the prefix, it is the one compatible
with the last token of what stands before it. Distinct words of a batch go into a trie; a depth-first
walk gives each node its last token, so a prefix that many words share is worked out once.

Results for odd input: a null or empty text has no tokens; special strings inside a text become their
own tokens, as the library does by default; ids of repeated rows are equal; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bpe_words import ByteVocabulary

assert array("I").itemsize == 4 and sys.byteorder == "little"
#: Nodes of the trie, stored words and compatible pairs of a worker; beyond one of them, that store starts anew.
MAX_NODES, MAX_WORDS, MAX_PAIRS = 600_000, 250_000, 300_000
#: Words longer than this many bytes are encoded without staying in the trie.
LONG_WORD = 64


class TrieEncoder:
    def __init__(self, vocabulary: ByteVocabulary) -> None:
        self.vocabulary = vocabulary
        #: By left << 20 | right.
        self.compatible_pairs: dict[int, bool] = {}
        self.blobs: dict[str, bytes] = {}
        self._clear()

    def _clear(self) -> None:
        #: A node is a number; child[node << 8 | byte] is the next. Its last token and that token's start node.
        self.child: dict[int, int] = {}
        self.last: list[int] = [-1]
        self.before: list[int] = [-1]

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: the leftmost pair of lowest rank merges first."""
        merged = self.vocabulary.merged
        ids = [self.vocabulary.tokens[data[k : k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            rank, at, made = min(((*merged[p][:1], k, merged[p][1]) for k, p in enumerate(zip(ids, ids[1:])) if p in merged), default=(0, -1, 0))
            if at < 0:
                break
            ids[at : at + 2] = [made]
        return ids

    def compatible(self, a: int, b: int) -> bool:
        if len(self.compatible_pairs) > MAX_PAIRS:
            self.compatible_pairs.clear()
        found = self.compatible_pairs[a << 20 | b] = self.merge(self.vocabulary.bytes_of[a] + self.vocabulary.bytes_of[b]) == [a, b]
        return found

    def walk(self, word: bytes, before: bytes = b"", path: list[int] | None = None) -> list[int]:
        """The nodes of all prefixes of a word, the root first. New nodes get their last token; in byte order, which makes this a depth-first walk, the path of the word before is shared as far as the words are equal."""
        child, last, token_of, known = self.child, self.last, self.vocabulary.tokens.get, self.compatible_pairs.get
        longest, shared = self.vocabulary.longest, 0
        for x, y in zip(word, before):
            if x != y:
                break
            shared += 1
        path = path[: shared + 1] if path else [0]
        node = path[-1]
        for end in range(len(path), len(word) + 1):
            key = node << 8 | word[end - 1]
            node = child.get(key, 0)
            if not node:
                for start in range(max(0, end - longest), end):
                    token = token_of(word[start:end])
                    if token is None:
                        continue
                    if start:
                        left = last[path[start]]
                        fits = known(left << 20 | token)
                        if not (self.compatible(left, token) if fits is None else fits):
                            continue
                    break
                node = child[key] = len(last)
                last.append(token)
                self.before.append(path[start])
            path.append(node)
        return path

    def read(self, node: int) -> list[int]:
        ids = []
        while node:
            ids.append(self.last[node])
            node = self.before[node]
        return ids[::-1]

    def encode_word(self, word: bytes) -> list[int]:
        return self.read(self.walk(word)[-1])

    def learn(self, words: Iterable[str]) -> None:
        """Store the ids of words as little-endian 32-bit integers."""
        before, path = b"", None
        for word in sorted(map(str.encode, words)):
            if len(word) > LONG_WORD:
                once = TrieEncoder(self.vocabulary)
                once.compatible_pairs = self.compatible_pairs
                ids = once.encode_word(word)
            else:
                path = self.walk(word, before, path)
                before = word
                ids = self.read(path[-1])
            self.blobs[word.decode()] = array("I", ids).tobytes()
            if len(self.last) > MAX_NODES:
                self._clear()
                before, path = b"", None

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text, its ids as little-endian unsigned 32-bit integers."""
        out = []
        if len(self.blobs) > MAX_WORDS:
            self.blobs = {}
        split = [[self.vocabulary.words(p) if isinstance(p, str) else p for p in self.vocabulary.pieces(t)] for t in texts]
        new = set()
        for parts in split:
            for p in parts:
                if not isinstance(p, int):
                    new.update(p)
        self.learn(new.difference(self.blobs))
        stored = self.blobs
        for parts in split:
            blob = []
            for p in parts:
                if isinstance(p, int):
                    blob.append(np.array([p], "<u4").tobytes())
                else:
                    blob.extend(map(stored.__getitem__, p))
            out.append(b"".join(blob))
        return out

    def decode(self, blob: bytes) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(blob, "<u4").tolist())).decode("utf-8", "replace")


#: Texts that are split and encoded together, in bytes.
TEXTS_AT_ONCE = 4 << 20


def slices(texts: list[str]) -> Iterator[list[str]]:
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size > TEXTS_AT_ONCE:
            yield texts[start : k + 1]
            start, size = k + 1, 0
    if start < len(texts):
        yield texts[start:]


def encoder(path: str | None) -> TrieEncoder:
    """A fresh encoder for a task: only the vocabulary and the compatible pairs stay in the worker, whose memory other stages need."""
    made = TrieEncoder(ByteVocabulary.cached(path))
    made.compatible_pairs = common.worker_cache().setdefault(("compatible pairs", path), made.compatible_pairs)
    return made


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded for each row of docs."""
    common.python_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            at = 0
            for texts in slices(b.column("text").to_pylist()):
                blobs = e.encode(texts)
                ids = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in blobs], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(texts)), ids, pa.array([e.decode(x) for x in blobs], pa.string())], names=["doc_id", "ids", "decoded"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text")).mapInArrow(common.tidy(run), "doc_id long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests are taken where the ids are, so that neither ids nor decoded texts travel back."""
    common.python_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            at = 0
            for texts in slices(b.column("text").to_pylist()):
                blobs = e.encode(texts)
                columns = [
                    b.column("doc_id").slice(at, len(texts)),
                    pa.array([len(x) // 4 for x in blobs], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in blobs], pa.string()),
                    pa.array([hashlib.sha256(e.decode(x).encode()).hexdigest() for x in blobs], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(common.tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
