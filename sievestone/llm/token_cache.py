"""Token counts through a cache of content digests.

The cache is a Parquet table (content_sha256, tokenizer_sha256, n_tokens). Distinct contents are
anti-joined with it, only the misses are encoded, each once, and their counts are appended; then every
row takes its count from the cache by digest. The content's normal form is the whole text with null as
empty: any stronger normalisation would change counts. The tokenizer's version is the digest of its file.

Within the encoding of misses a worker keeps the token counts of words it has met, as merges never cross
a word.

Results for odd input: a null or empty text has no tokens; rows that repeat a text share one encoding;
null ids stay null; an empty table gives an empty result and appends nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bpe_words import ByteVocabulary, file_digest

LIMIT = 512
CACHE = "content_sha256 string, tokenizer_sha256 string, n_tokens long"
#: Words of which a task keeps the counts; beyond them it starts anew.
MAX_WORDS = 300_000


class WordCounts:
    """Token counts of texts by the library, with those of words kept."""

    def __init__(self, vocabulary: ByteVocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        split = [[self.vocabulary.words(p) if isinstance(p, str) else p for p in self.vocabulary.pieces(t)] for t in texts]
        if len(self.known) > MAX_WORDS:
            self.known = {}
        new = set()
        for parts in split:
            for p in parts:
                if not isinstance(p, int):
                    new.update(p)
        new = list(new.difference(self.known))
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            self.known.update(zip(part, (len(e.ids) for e in self.vocabulary.library.encode_batch(part, add_special_tokens=False))))
        get = self.known.__getitem__
        return [sum(1 if isinstance(p, int) else sum(map(get, p)) for p in parts) for parts in split]


class TokenCache:
    """A cache table at a path; with none, a fresh one in the shared folder."""

    def __init__(self, spark, path: str | None = None, tokenizer: str | None = None) -> None:
        self.spark, self.tokenizer = spark, tokenizer
        self.path = path or common.new_folder(spark, "token-cache")
        self.version = file_digest(tokenizer)

    def read(self) -> DataFrame:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], CACHE)
        return self.spark.read.schema(CACHE).parquet(self.path)

    def stored(self) -> DataFrame:
        """Counts of this tokenizer by content digest. Two jobs may have appended the same content at a time."""
        return self.read().where(F.col("tokenizer_sha256") == self.version).groupBy("content_sha256").agg(F.first("n_tokens").alias("n_tokens"))

    def add_missing(self, docs: DataFrame) -> None:
        tokenizer, version = self.tokenizer, self.version

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = WordCounts(ByteVocabulary.cached(tokenizer))
            for b in batches:
                texts = b.column("text").to_pylist()
                n = [x for k in range(0, len(texts), 1024) for x in counts.count(texts[k : k + 1024])]
                yield pa.RecordBatch.from_arrays([b.column("content_sha256"), pa.array([version] * b.num_rows, pa.string()), pa.array(n, pa.int64())], names=["content_sha256", "tokenizer_sha256", "n_tokens"])

        distinct = docs.select(F.sha2(common.whole_text(), 256).alias("content_sha256"), common.whole_text().alias("text")).dropDuplicates(["content_sha256"])
        misses = distinct.join(self.stored(), "content_sha256", "left_anti").select("content_sha256", "text")
        misses.mapInArrow(run, CACHE).write.mode("append").parquet(self.path)

    def counts(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_bytes, n_tokens for each row of docs, encoding what the cache lacks."""
        common.python_batches(self.spark)
        self.add_missing(docs)
        text = common.whole_text()
        rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("content_sha256"))
        # Stored once more, without the grouping above it, so that the join may split a content that many rows share.
        return rows.join(common.save(self.stored(), "token-counts"), "content_sha256", "left").select("doc_id", "n_bytes", "n_tokens")


def token_counts(docs: DataFrame, limit: int = LIMIT, cache: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs."""
    return TokenCache(docs.sparkSession, cache, tokenizer).counts(docs).withColumn("over_limit", F.col("n_tokens") > limit)
