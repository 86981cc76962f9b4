import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from sievestone.operators import coco, labels
from sievestone.sources import files, search
from sievestone.streaming import frames, gate

REPO = Path(__file__).resolve().parent.parent


def test_label_files_round_trip(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.2 0.2\r\n\n1 0.5 0.5 0.2 0.2\n")
    (tmp_path / "empty.txt").write_text("")
    found = files.scan_labels(spark, str(tmp_path))
    lines = files.label_lines(found, "stem")
    assert sorted((r["stem"], r["line_no"], r["line"]) for r in lines.collect()) == [("a", 0, "0 0.5 0.5 0.2 0.2"), ("a", 1, ""), ("a", 2, "1 0.5 0.5 0.2 0.2")]
    boxes = found.select("stem").join(labels.validate(lines, "prepare", [0, 1]), "stem", "left")
    texts = {r["stem"]: r["text"] for r in files.label_files(boxes, "stem").collect()}
    assert texts == {"a": "0 0.500000 0.500000 0.200000 0.200000\n1 0.500000 0.500000 0.200000 0.200000\n", "empty": ""}


def test_lists_scans_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("/d/b 1.jpg", "train"), ("/d/a.jpg", "train"), ("/d/c.jpg", "val")], "path string, split string")
    files.write_split_lists(rows, str(tmp_path / "lists"))
    assert sorted(r["path"] for r in files.scan_lists(spark, str(tmp_path / "lists/split=train")).collect()) == ["/d/a.jpg", "/d/b 1.jpg"]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        files.write_split_lists(rows, str(tmp_path / "lists"))
    files.write_manifest(rows, str(tmp_path / "manifest"))
    assert spark.read.option("header", True).csv(str(tmp_path / "manifest")).count() == 3
    files.write_report(rows, str(tmp_path / "report"))
    assert files.scan_report(spark, str(tmp_path / "report"), "path string, split string").count() == 3
    files.write_by_split(rows, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).where("split = 'val'").count() == 1
    assert files.scan_files(spark, str(tmp_path), suffixes=(".csv",)).count() >= 1
    page = files.markdown(spark.createDataFrame([("s", "n", "1")], "section string, name string, value string"), "T")
    assert "## s" in page and "| n | 1 |" in page
    made = []
    for _ in range(2):
        assert files.read_or_compute(spark, str(tmp_path / "stored"), lambda: made.append(1) or rows).count() == 3
    assert made == [1]


def test_sidecars(spark, tmp_path):
    rows = spark.createDataFrame([tuple("abcdefghij")], ", ".join(f"{c} string" for c in files.SIDECAR))
    files.write_sidecars(rows, str(tmp_path / "s"))
    assert spark.read.schema(rows.schema).json(str(tmp_path / "s")).first() == rows.first()


def test_coco_documents(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 100, "height": 50}, {"id": 2, "file_name": "b.jpg", "width": 100, "height": 50}],
        "categories": [{"id": 9, "name": "zebra"}, {"id": 4, "name": "person"}, {"id": 5, "name": "ant"}],
        "annotations": [{"id": 1, "image_id": 1, "category_id": 4, "bbox": [90, 0, 20, 50], "iscrowd": 0}, {"id": 2, "image_id": 1, "category_id": 4, "bbox": [0, 0, 0, 5], "iscrowd": 0}, {"id": 3, "image_id": 1, "category_id": 4, "bbox": [0, 0, 5, 5], "iscrowd": 1}],
    }
    (tmp_path / "c.json").write_text(json.dumps(doc))
    images, categories, notes = files.scan_coco(spark, str(tmp_path / "c.json"))
    assert {r["category_id"]: r["cls"] for r in coco.class_order(categories).collect()} == {4: 0, 5: 1, 9: 2}
    own, dropped = coco.of_category(categories, notes, "person")
    assert own.count() == 2 and dropped.first()[0] == 1
    kept = {r["image_id"]: r["xc"] for r in coco.to_boxes(images, categories, own, clamped=False).collect()}
    assert kept == {1: 1.0, 2: None}
    with pytest.raises(ValueError, match="found 0"):
        coco.of_category(categories, notes, "dog")


def test_slots_for_decoders_and_models(spark):
    frames = spark.createDataFrame([("p", 1, bytearray(b"x")), ("q", 2, bytearray(b""))], "path string, frame_no long, content binary")
    hashed = {r["path"]: r["h"] for r in files.hash_images(frames, lambda c: [True] + [False] * 63 if c else None, "test").collect()}
    assert hashed == {"p": -(1 << 63), "q": None}
    found = files.detect(frames, lambda c: [("helmet", 0.0, 0.0, 1.0, 1.0, 0.9), ("truck", 0.0, 0.0, 1.0, 1.0, 0.9), ("helmet", 0.0, 0.0, 1.0, 1.0, 0.1)], 0.25, ("helmet",))
    assert found.count() == 2


def test_gate_state_lasts_across_micro_batches(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kind = "frame long, track_id long, missing array<string>"
    for k, bads in enumerate(([1, 1], [1, 0], [0, 1], [1, 1])):
        rows = [(2 * k + n, t, ["vest", "helmet"] if b else []) for n, b in enumerate(bads) for t in (1, -5)]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    gate.alerts(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    made = sorted((r["frame"], r["track_id"], tuple(r["missing"]), r["confirmed"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert made == [(2, 1, ("helmet", "vest"), True), (7, 1, ("helmet", "vest"), True)]
    ids = [r[0] for r in spark.range(3).withColumn("f", F.lit(2)).select(gate.fallback_track("f", "id")).collect()]
    assert ids == [-(2 << 20) - k for k in (1, 2, 3)]


def test_report_of_many_rows_in_a_file(spark, tmp_path):
    """AQE writes the rows of a larger table to one file."""
    rows = spark.range(5).selectExpr("cast(id AS string) AS quantity", "id AS measured").coalesce(1)
    files.write_report(rows, str(tmp_path / "report"))
    made = files.scan_report(spark, str(tmp_path / "report"), "quantity string, measured long", lines=True)
    assert sorted((r["quantity"], r["measured"]) for r in made.collect()) == [(str(k), k) for k in range(5)]
    (tmp_path / "one.json").write_text('{\n "quantity": "a",\n "measured": 1\n}\n')
    assert files.scan_report(spark, str(tmp_path / "one.json"), "quantity string, measured long").first()["measured"] == 1


def test_search_source(spark):
    def pages(text, token):
        """A search service of three pages with two hits each."""
        page = int(token or 0)
        hits = [{"title": f"{text} {page}{k}", "url": "u", "thumburl": "" if k else "t", "mime": "image/png", "extmetadata": {"Artist": {"value": "<b>A</b>  B"}}} for k in range(2)]
        return hits, str(page + 1) if page < 2 else None

    made = search.search(spark, {"helmet": ["q1", "q2", "q3"], "vest": ["v"]}, pages, per_query=5, per_label=8)
    found = sorted((r["label"], r["query"], r["position"]) for r in made.collect())
    assert found == [("helmet", q, k) for q in ("q1", "q2") for k in range(5)][:8] + [("vest", "v", k) for k in range(5)]
    records = search.sidecars(made).collect()
    assert {(r["artist"], r["license_short"], r["suffix"]) for r in records} == {("A B", "Unknown", ".png")}
    assert {r["thumb_url"] for r in records} == {"t", "u"} and set(files.SIDECAR) <= set(records[0].asDict())


def test_alerts_from_a_stream_of_frames(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    person, places = (0.0, 0.0, 100.0, 200.0), {"helmet": 28.0, "goggles": 52.0, "vest": 104.0, "gloves": 136.0}
    item = lambda c: (c, (45.0, places[c] - 5, 55.0, places[c] + 5), 0.9)
    worn = [["helmet", "goggles", "vest", "gloves"]] * 2 + [["helmet", "vest", "gloves"]] * 4
    rows = [(n, [(7, person), (-1, (500.0, 0.0, 600.0, 200.0))], [item(c) for c in cs]) for n, cs in enumerate(worn)]
    spark.createDataFrame(rows, frames.FRAMES).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frames.FRAMES).parquet(str(tmp_path / "in"))
    frames.compliance_alerts(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert [(r["frame"], r["track_id"], r["missing"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(4, 7, ["goggles"])]


def test_entry_works_without_the_corpus_part():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("sievestone.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 50 and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=REPO, timeout=120).returncode == 0
