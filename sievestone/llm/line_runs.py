"""Removal of lines that many documents repeat, over levelled sorted runs of line digests.

Documents come in batches. A batch's distinct line digests, with the number of its documents that hold
them, are anti-joined by merge with the digests that the runs have already settled (found in enough
documents), and the rest is added as a new sorted run of level 0. FANOUT runs of a level are compacted
into one of the next. A digest is the pair of two independent 64-bit hashes of the line's key. Runs are
tables in the shared folder, divided by digest into as many buckets as a shuffle has partitions and sorted in
each, so that merges of runs neither shuffle nor sort them again.

Which lines of a text go depends on the text alone once the counts stand, so positions are joined
back by the text's digest.

Everything is DataFrame functions. Results for odd input: a null or empty text is one empty line, and
empty keys never go; a text that loses all its lines becomes empty; each row counts as one document,
repeated rows and null ids too; an empty table gives an empty result; other columns pass through, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, digest_filter

MIN_CHARS, MIN_DOCS = 1, 10
BATCHES, FANOUT = 4, 2
#: Up to this many frequent lines, of 16 bytes each, go to all executors; of more a filter goes, and what it lets through is joined by a shuffle.
BROADCAST_LINES = 500_000


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_keys(text: Column) -> Column:
    return F.transform(lines(common.ascii_lower(text)), common.strip_space)


def digests(c: Column) -> tuple[Column, Column]:
    return F.xxhash64(c), F.xxhash64(F.lit("line"), c)


#: A bucket is read by one task, and in its order.
SCANS = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


@contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made inside know the order of bucketed tables."""
    before = {k: spark.conf.get(k) for k in SCANS}
    for k, v in SCANS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class LineRuns:
    """Sorted runs (h1, h2, docs) by level."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.written: list[tuple[str, str]] = []

    def write(self, rows: DataFrame) -> DataFrame:
        """rows, which are dealt by (h1, h2), as a bucketed and sorted table."""
        name = f"line_run_{uuid4().hex}"
        path = common.new_folder(self.spark, "line-run")
        self.written.append((name, path))
        rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Remove all tables of these runs; nothing that reads them works afterwards."""
        for name, path in self.written:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            common.remove(self.spark, path)
        self.levels, self.written = [], []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """One run of several, two at a time. (A union would be shorter, but Spark 4.1.2 aggregates one of bucketed tables as if their buckets lay together.)"""
        while len(runs) > 1:
            one, two, *rest = runs
            both = one.hint("merge").join(two.withColumnRenamed("docs", "more"), ["h1", "h2"], "full")
            with sorted_scans(self.spark):
                made = self.write(both.select("h1", "h2", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs")))
            runs = [*rest, made]
        return runs[0]

    def total(self) -> DataFrame | None:
        """Documents for each digest over all runs."""
        return self.merged(self.runs()) if self.runs() else None

    def add(self, batch: DataFrame, dealt: bool = False) -> None:
        """batch: h1, h2, docs of new documents; dealt if it comes from a table that write() has made."""
        with sorted_scans(self.spark):
            rows = batch if dealt else batch.repartition(self.buckets, "h1", "h2")
            seen = F.lit(0)
            for k, run in enumerate(self.runs()):
                rows = rows.join(run.select("h1", "h2", F.col("docs").alias(f"docs_{k}")).hint("merge"), ["h1", "h2"], "left")
                seen = seen + F.coalesce(f"docs_{k}", F.lit(0))
            made = self.write(rows.where(seen < self.min_docs).select("h1", "h2", "docs"))
        self.levels = self.levels or [[]]
        self.levels[0].append(made)
        self.compact()

    def compact(self) -> None:
        """Merge the runs of each full level into one of the next."""
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                merged = self.merged(self.levels[k])
                self.levels[k] = []
                self.levels[k + 1 : k + 2] = [[*(self.levels[k + 1] if k + 1 < len(self.levels) else []), merged]]
            k += 1

    def frequent(self) -> DataFrame:
        return self.total().where(F.col("docs") >= self.min_docs).select("h1", "h2")


def frequent_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Digests (h1, h2) of the line keys found in min_docs documents or more."""
    h1, h2 = digests(F.col("key"))
    # What is worked out for a text stands below the explode, else it would be for each of its lines.
    dealt = docs.select(F.pmod(F.xxhash64("text"), F.lit(batches)).alias("batch"), F.array_distinct(line_keys(common.whole_text())).alias("keys"))
    found = dealt.select("batch", F.explode_outer("keys").alias("key")).where(F.length("key") >= min_chars).select("batch", h1.alias("h1"), h2.alias("h2"))
    counted = found.groupBy("h1", "h2").agg(*(F.count_if(F.col("batch") == b).alias(f"docs_{b}") for b in range(batches)))
    runs = LineRuns(docs.sparkSession, min_docs)
    counted = runs.write(counted.repartition(runs.buckets, "h1", "h2"))
    for b in range(batches):
        runs.add(counted.where(F.col(f"docs_{b}") > 0).select("h1", "h2", F.col(f"docs_{b}").alias("docs")), dealt=True)
    found = common.save(runs.frequent(), "line-frequent")
    runs.drop()
    return found


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """row (the columns of docs), lines (all), kept (positions that stay, from 0) for each row of docs."""
    docs = docs.select(F.struct("*").alias("row"), "text")
    frequent = frequent_lines(docs, min_chars, min_docs)
    t1, t2 = digests(common.whole_text())
    h1, h2 = digests(F.col("key"))
    digested = docs.select(t1.alias("t1"), t2.alias("t2"), line_keys(common.whole_text()).alias("keys"))
    placed = digested.select("t1", "t2", F.posexplode_outer("keys").alias("at", "key")).where(F.length("key") >= min_chars)
    placed = placed.select("t1", "t2", "at", h1.alias("h1"), h2.alias("h2"))
    gone = placed.join(F.broadcast(frequent), ["h1", "h2"], "left_semi") if frequent.count() <= BROADCAST_LINES else digest_filter.among(placed, frequent, ["h1", "h2"])
    gone = common.save(gone.groupBy("t1", "t2").agg(F.collect_set("at").alias("gone")), "line-positions")
    rows = docs.select("row", t1.alias("t1"), t2.alias("t2")).join(gone, ["t1", "t2"], "left").withColumn("text", F.col("row.text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return rows.withColumn("lines", lines(common.whole_text())).withColumn("kept", kept).select("row", "lines", "kept")


def kept_text() -> Column:
    return F.array_join(F.transform("kept", lambda k: F.get("lines", k)), "\n")


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for each row of docs."""
    rows = drop_lines(docs.select("doc_id", "text"))
    n = F.size("lines").cast("long")
    return rows.select("row.doc_id", n.alias("n_lines"), (n - F.size("kept")).alias("n_dropped"), F.sha2(kept_text(), 256).alias("kept_sha256"))


def without_lines(docs: DataFrame) -> DataFrame:
    """docs with the remaining lines as text and their length as n_chars, where docs has that column."""
    rows, whole = drop_lines(docs), F.size("kept") == F.size("lines")
    row = F.col("row").withField("text", F.when(whole, F.col("row.text")).otherwise(kept_text()))
    if "n_chars" in docs.columns:
        n = F.aggregate(F.transform("kept", lambda k: F.length(F.get("lines", k)) + 1), F.lit(-1), lambda a, x: a + x)
        row = row.withField("n_chars", F.when(whole, F.col("row.n_chars")).otherwise(F.greatest(n, F.lit(0))).cast(dict(docs.dtypes)["n_chars"]))
    return rows.select(row.alias("row")).select("row.*")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM d),
n AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM n WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT n.*, f.key IS NOT NULL AS gone FROM n LEFT JOIN f ON n.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
