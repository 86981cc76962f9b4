"""Sources and sinks: images, label files, lists, nested annotation documents, reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars

COCO = (
    "images ARRAY<STRUCT<id: BIGINT, file_name: STRING, width: INT, height: INT>>, "
    "categories ARRAY<STRUCT<id: BIGINT, name: STRING>>, "
    "annotations ARRAY<STRUCT<id: BIGINT, image_id: BIGINT, category_id: BIGINT, bbox: ARRAY<DOUBLE>, iscrowd: INT>>"
)
SIDECAR = ("title", "source", "source_url", "thumb_url", "license_short", "license_long", "license_url", "artist", "credit", "datetime")
HASHES = "path STRING, official_split STRING, kind STRING, h BIGINT"
DETECTIONS = "frame_no BIGINT, cls STRING, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, conf DOUBLE"


def scan_files(spark: SparkSession, folder: str, pattern: str = "*", suffixes: tuple[str, ...] = (), content: bool = False) -> DataFrame:
    """path, stem, suffix, length (and content) of files below a folder. Contents are only read if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    rows = files.select("path", scalars.stem(F.col("path")).alias("stem"), scalars.suffix(F.col("path")).alias("suffix"), "length", *(["content"] if content else []))
    return rows.where(F.col("suffix").isin(*suffixes)) if suffixes else rows


def scan_lists(spark: SparkSession, path: str) -> DataFrame:
    """path: one row for each line that is not blank; spaces belong to it."""
    return spark.read.text(path).select(F.rtrim("value").alias("path")).where(F.trim("path") != "")


def scan_labels(spark: SparkSession, folder: str) -> DataFrame:
    """path, stem, text: one row for each label file; an empty one has an empty text."""
    found = scan_files(spark, folder, "*.txt", content=True)
    # File scans leave empty files out, but these stand for images without boxes: their names come from the listing.
    listed = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string").select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    both = listed.select(plain(F.col("path")).alias("path")).join(found.select(plain(F.col("path")).alias("path"), "content"), "path", "left")
    return both.select("path", scalars.stem(F.col("path")).alias("stem"), F.coalesce(F.col("content").cast("string"), F.lit("")).alias("text"))


def label_lines(files: DataFrame, *keys: str) -> DataFrame:
    """keys, line_no (from 0), line. A last line end starts no line."""
    text = F.regexp_replace(F.regexp_replace(F.col("text"), "\r\n?", "\n"), "\n$", "")
    return files.where(text != "").select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))


def scan_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, categories and annotations of nested annotation documents."""
    return coco_tables(spark.read.schema(COCO).option("multiLine", True).json(path))


def coco_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    images, categories, annotations = (documents.select(F.inline(c)) for c in ("images", "categories", "annotations"))
    return images, categories, annotations


def scan_report(spark: SparkSession, path: str, schema: str | None = None, lines: bool = False) -> DataFrame:
    """Reports, of a document each or as write_report() gives them, of a line for each row; a file of lines read as a document gives its first row alone."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def read_or_compute(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A stored table, made on the first call; the caller drops it when its input changes."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        make().write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scan_sidecars(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Licence records, of a file each or as write_sidecars() gives them, of a line each."""
    return spark.read.schema(", ".join(f"{c} STRING" for c in SIDECAR)).option("multiLine", not lines).json(path)


# Slots for decoders and models: the schema is fixed, the function comes from outside


def hash_images(files: DataFrame, decode: Callable[[bytes], list[bool]], kind: str) -> DataFrame:
    """path, kind, h: decode gives 64 comparisons for the bytes of an image; one that can't be decoded has none."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for b in batches:
            rows = [(p, decode(bytes(c))) for p, c in zip(b["path"], b["content"])]
            yield pd.DataFrame({"path": [p for p, _ in rows], "bits": [x if x is None else list(map(bool, x)) for _, x in rows]})

    bits = files.select("path", "content").mapInPandas(run, "path string, bits array<boolean>")
    return bits.select("path", F.lit(kind).alias("kind"), F.when(F.size("bits") == 64, scalars.pack_bits(F.col("bits"))).alias("h"))


def detect(frames: DataFrame, predict: Callable[[bytes], list[tuple]], confidence: float = 0.25, classes: tuple[str, ...] = ()) -> DataFrame:
    """Detections of frames (frame_no, content): predict gives (cls, x1, y1, x2, y2, conf) tuples."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for b in batches:
            rows = [(n, *d) for n, c in zip(b["frame_no"], b["content"]) for d in predict(bytes(c))]
            yield pd.DataFrame(rows, columns=["frame_no", "cls", "x1", "y1", "x2", "y2", "conf"])

    found = frames.select("frame_no", "content").mapInPandas(run, DETECTIONS).where(F.col("conf") >= confidence)
    return found.where(F.col("cls").isin(*classes)) if classes else found


# Sinks


def write_split_lists(assignment: DataFrame, folder: str) -> None:
    """Sorted text files of paths, in a folder for each split."""
    assignment.select("path", "split").repartitionByRange("split", "path").sortWithinPartitions("split", "path").write.mode("errorifexists").partitionBy("split").text(folder)


def write_manifest(rows: DataFrame, folder: str) -> None:
    rows.write.mode("errorifexists").option("header", True).csv(folder)


def write_report(metrics: DataFrame, folder: str) -> None:
    """Lines of JSON."""
    metrics.write.mode("errorifexists").json(folder)


def label_files(boxes: DataFrame, *keys: str) -> DataFrame:
    """keys, text: the lines of boxes (cls, xc, yc, w, h, line_no) in order, with a line end unless there is none."""
    line = scalars.label_line(*(F.col(c) for c in ("cls", "xc", "yc", "w", "h")))
    lines = F.transform(F.array_sort(F.collect_list(F.when(F.col("cls").isNotNull(), F.struct("line_no", line.alias("line"))))), lambda x: x["line"])
    grouped = boxes.groupBy(*keys).agg(lines.alias("lines"))
    return grouped.select(*keys, F.when(F.size("lines") > 0, F.concat(F.array_join("lines", "\n"), F.lit("\n"))).otherwise("").alias("text"))


def write_by_split(rows: DataFrame, folder: str) -> None:
    """A new table in a folder for each split; never over an old one."""
    rows.write.mode("errorifexists").partitionBy("split").parquet(folder)


def write_sidecars(rows: DataFrame, folder: str) -> None:
    rows.select(*SIDECAR).write.mode("errorifexists").json(folder)


def markdown(metrics: DataFrame, title: str, limit: int = 200) -> str:
    """A report of (section, name, value) rows; limit bounds what a page can hold."""
    lines, last = [f"# {title}"], None
    for r in metrics.orderBy("section", "name").limit(limit).collect():
        if r["section"] != last:
            lines += ["", f"## {r['section']}", "", "| metric | value |", "|---|---|"]
            last = r["section"]
        lines.append(f"| {r['name']} | {r['value']} |")
    return "\n".join(lines) + "\n"
