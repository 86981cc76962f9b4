"""Queries over the driver's tables, one for each operator, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import audit, coco, compliance, evaluate, graph, hamming, labels, quarantine, ranking, splitting
from ..sources import files
from ..sources.scratch import new_folder, save
from ..streaming import frames, gate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def by_sql(spark: SparkSession, d: str, sql: str, *names: str) -> DataFrame:
    """Rows of a SELECT that both engines understand."""
    return spark.sql(sql, **{n: table(spark, d, n) for n in names})


# Base tables, as SQL for both engines; {name} stands for a driver table.

SPLIT = "CASE WHEN {k} % 10 < 6 THEN 'train' WHEN {k} % 10 < 8 THEN 'val' ELSE 'test' END"
IMAGES = f"""SELECT doc_id AS id, {SPLIT.format(k='doc_id')} AS split, source, lang, text,
 '/data/' || source || '/images/' || upper(lang) || cast(doc_id AS string) || '.jpg' AS path FROM {{documents}}"""
LINES = f"""SELECT cast(l_orderkey AS string) AS stem, {SPLIT.format(k='l_orderkey')} AS split, l_linenumber - 1 AS line_no,
 CASE l_partkey % 50 WHEN 0 THEN '0 0.5 0.5 0.2' WHEN 1 THEN 'a 0.5 0.5 0.2 0.2' WHEN 2 THEN '1.0 0.5 0.5 0.2 0.2'
 WHEN 3 THEN '7 0.5 0.5 0.2 0.2' WHEN 4 THEN '0 1.2 -0.1 0.2 0.2' WHEN 5 THEN '0 0.5 0.5 0 0.2' WHEN 6 THEN ''
 ELSE cast(l_suppkey % 2 AS string) || ' 0.' || lpad(cast(l_partkey % 1000 AS string), 3, '0') || '  0.' || lpad(cast(l_suppkey % 1000 AS string), 3, '0')
 || ' 0.' || lpad(cast(1 + l_partkey % 99 AS string), 3, '0') || ' 0.250 ' END AS line, l_partkey FROM {{lineitem}}"""
#: The same lines where none is broken.
GOOD_LINES = f"SELECT stem, split, line_no, {LINES[LINES.index('cast(l_suppkey % 2') : LINES.index(' END AS line')]} AS line FROM (SELECT *, cast(l_orderkey AS string) AS stem, {SPLIT.format(k='l_orderkey')} AS split, l_linenumber - 1 AS line_no FROM {{lineitem}})"
BOXES = f"""SELECT cast(l_orderkey AS string) AS image, {SPLIT.format(k='l_orderkey')} AS split, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS int) AS idx, l_suppkey % 5 AS cls5, cast(l_suppkey % 2 AS int) AS cls,
 (l_partkey % 97) / 97.0D AS xc, (l_partkey % 89) / 89.0D AS yc, (5 + l_partkey % 20) / 50.0D AS w, (5 + l_partkey % 30) / 60.0D AS h,
 cast(l_partkey % 1000 AS int) AS px, cast(l_suppkey % 700 AS int) AS py, cast(l_partkey % 300 AS int) AS pw, cast(l_suppkey % 200 AS int) AS ph, l_quantity FROM {{lineitem}}"""
BITS = "SELECT vec_id AS id, label, {bits} AS h FROM {embeddings}"


def duck(base: str) -> str:
    """The base table's SQL for DuckDB: plain table names and literals."""
    for t in ("documents", "lineitem", "embeddings", "orders", "labels", "events", "customer", "supplier", "part"):
        base = base.replace("{" + t + "}", t)
    return base.replace(".0D", ".0").replace("{bits}", "array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')")


def images(spark: SparkSession, d: str) -> DataFrame:
    return by_sql(spark, d, IMAGES, "documents")


def lines(spark: SparkSession, d: str) -> DataFrame:
    return by_sql(spark, d, LINES, "lineitem")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return by_sql(spark, d, BOXES, "lineitem")


def hashes(spark: SparkSession, d: str, *more: Column) -> DataFrame:
    """id, label, h, split (and more): the signs of the vectors as 64 bits."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", S.pack_bits(F.transform("embedding", lambda x: x > 0)).alias("h"), *more)
    return rows.withColumn("split", F.expr(SPLIT.format(k="id")))


D_IMAGES, D_LINES, D_BOXES, D_BITS = map(duck, (IMAGES, LINES, BOXES, BITS))
D_PAIRS = f"b AS ({D_BITS}), p AS (SELECT x.id AS a, y.id AS b, cast(hamming(x.h, y.h) AS int) AS d FROM b x JOIN b y ON x.id < y.id WHERE hamming(x.h, y.h) <= {{t}})"
D_SPLIT_ID = SPLIT.format(k="id")
NEAR = 20

# Content copies


@query(f"""WITH i AS ({D_IMAGES}), r AS (SELECT *, row_number() OVER w AS rn, first_value(id) OVER w AS kept FROM i
WINDOW w AS (PARTITION BY sha256(text) ORDER BY CASE split WHEN 'test' THEN 3 WHEN 'val' THEN 2 ELSE 1 END DESC, id))
SELECT id AS removed, kept, split FROM r WHERE rn > 1""")
def exact_quarantine(spark, d):
    return quarantine.exact_quarantine(images(spark, d).select("id", "split", F.sha2("text", 256).alias("sha")))


@query(f"""WITH i AS ({D_IMAGES}), r AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY CASE split WHEN 'test' THEN 3 WHEN 'val' THEN 2 ELSE 1 END DESC, id) AS rn FROM i)
SELECT lang, count(*) AS documents, count(*) FILTER (WHERE rn > 1) AS removed, count(*) FILTER (WHERE rn = 1) AS kept FROM r GROUP BY lang""")
def curation_report(spark, d):
    rows = images(spark, d).select("id", "split", "lang", F.sha2("text", 256).alias("sha"))
    removed = quarantine.exact_quarantine(rows).select(F.col("removed").alias("gone")).withColumn("hit", F.lit(True))
    flagged = rows.join(removed, rows["id"] == removed["gone"], "left")
    return flagged.groupBy("lang").agg(F.count("*").alias("documents"), F.count("hit").alias("removed"), (F.count("*") - F.count("hit")).alias("kept"))


@query(f"WITH i AS ({D_IMAGES}) SELECT id, first_value(id) OVER (PARTITION BY sha256(text) ORDER BY split, path) AS first_id FROM i")
def first_occurrence(spark, d):
    rows = images(spark, d).select("id", "split", "path", F.sha2("text", 256).alias("sha"))
    return quarantine.first_copies(rows, "sha", ["split", "path", "id"]).select("id", F.col("first.id").alias("first_id"))


@query(f"""WITH i AS ({D_IMAGES}), f AS (SELECT id, first_value(id) OVER (PARTITION BY sha256(text) ORDER BY id) AS first FROM i)
SELECT id AS removed, first AS kept FROM f WHERE id <> first""")
def report_targets(spark, d):
    rows = images(spark, d).select("id", F.sha2("text", 256).alias("sha"))
    pairs = quarantine.first_copies(rows, "sha", ["id"]).where("id <> first.id").select(F.col("id").alias("later"), F.col("first.id").alias("first"))
    return quarantine.report_targets(pairs)


@query(f"""WITH i AS ({D_IMAGES}), r AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY id) AS rn FROM i)
SELECT split, count(*) AS kept FROM r WHERE rn = 1 GROUP BY split""")
def kept_after_quarantine(spark, d):
    rows = images(spark, d).select("id", "split", F.sha2("text", 256).alias("h"))
    return quarantine.keep(rows, quarantine.clique_quarantine(rows)).groupBy("split").agg(F.count("*").alias("kept"))


@query(f"""WITH i AS ({D_IMAGES}) SELECT split, count(*) AS files, cast(sum(strlen(text)) AS bigint) AS bytes FROM i GROUP BY split""")
def package_manifest(spark, d):
    rows = images(spark, d).select("split", F.col("path").alias("name"), F.octet_length("text").cast("long").alias("length"), F.sha2("text", 256).alias("sha"))
    return audit.package_manifest(rows, ["split"]).select("split", "files", "bytes")


@query(f"WITH i AS ({D_IMAGES}) SELECT source AS entry, count(*) AS times FROM i GROUP BY source HAVING count(*) > 1")
def package_collisions(spark, d):
    return splitting.collisions(images(spark, d).select(F.col("source").alias("entry")))


# Label lines

D_PARSED = f"""l AS ({D_LINES}), q AS (SELECT *, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS t FROM l),
f AS (SELECT *, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS fs FROM q),
pl AS (SELECT *, len(fs) AS n_fields, CASE WHEN regexp_matches(fs[1], '^[+-]?[0-9]+$') THEN try_cast(fs[1] AS int) END AS cls,
 try_cast(fs[2] AS double) AS xc, try_cast(fs[3] AS double) AS yc, try_cast(fs[4] AS double) AS w, try_cast(fs[5] AS double) AS h FROM f),
v AS (SELECT *, coalesce(cls IS NOT NULL AND xc IS NOT NULL AND yc IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL, false) AS numeric,
 cls IN (0, 1) AS known, xc < 0 OR xc > 1 OR yc < 0 OR yc > 1 AS bad_centre, w <= 0 OR w > 1 OR h <= 0 OR h > 1 AS bad_size FROM pl)"""


@query(f"WITH {D_PARSED} SELECT stem, line_no, cast(n_fields AS int) AS n_fields, cls, xc, yc, w, h FROM v")
def label_parse(spark, d):
    return labels.parse(lines(spark, d)).select("stem", "line_no", "n_fields", "cls", "xc", "yc", "w", "h")


#: Modes that raise on broken lines.
STRICT = ("profile", "scan")


def validated(mode: str):
    def f(spark, d):
        rows = by_sql(spark, d, GOOD_LINES if mode in STRICT else LINES, "lineitem")
        return labels.validate(rows, mode, [0, 1]).select("stem", "line_no", "cls", F.array_join("errors", ";").alias("errors"), "is_box", "degenerate")

    f.__name__ = f"label_validate_{mode}"
    return f


D_AUDIT = """CASE WHEN n_fields <> 5 THEN 'bad_field_count:' || n_fields WHEN NOT numeric THEN 'non_numeric' ELSE concat_ws(';', CASE WHEN NOT known THEN 'bad_class:' || cls END,
 CASE WHEN xc < 0 OR xc > 1 THEN 'xc_out_of_range' END, CASE WHEN yc < 0 OR yc > 1 THEN 'yc_out_of_range' END, CASE WHEN w <= 0 OR w > 1 THEN 'w_out_of_range' END, CASE WHEN h <= 0 OR h > 1 THEN 'h_out_of_range' END) END"""
D_QA = """CASE WHEN n_fields <> 5 THEN 'not_5_fields' WHEN NOT numeric THEN 'non_numeric' WHEN NOT known THEN 'class_id_' || cls || '_unexpected' WHEN bad_centre THEN 'center_out_of_range' WHEN bad_size THEN 'size_out_of_range' ELSE '' END"""
D_FINAL = """CASE WHEN n_fields <> 5 THEN 'not_5_fields' WHEN NOT numeric THEN 'non_numeric' ELSE concat_ws(';', CASE WHEN NOT known THEN 'class_' || cls || '_not_in_mapping' END, CASE WHEN bad_centre THEN 'coord_range' END) END"""
D_DEGENERATE = "n_fields = 5 AND numeric AND (w <= 0 OR h <= 0)"
for _mode, _errors, _box, _where in (
    ("audit", D_AUDIT, "n_fields = 5 AND numeric", "n_fields > 0"),
    ("qa", D_QA, f"({D_QA}) = ''", "true"),
    ("final", D_FINAL, "n_fields > 0", "true"),
    ("prepare", "CASE WHEN n_fields <> 5 OR NOT numeric OR NOT known OR bad_centre OR bad_size THEN 'bad' ELSE '' END", "n_fields = 5 AND numeric AND known AND NOT bad_centre AND NOT bad_size", "n_fields > 0"),
    ("profile", "''", "n_fields = 5", "true"),
    ("transfer", "CASE WHEN cls IS NULL THEN 'parse_error' ELSE '' END", "cls IS NOT NULL", "n_fields > 0"),
    ("scan", "''", "true", "true"),
):
    query(f"WITH {D_PARSED.replace(D_LINES, duck(GOOD_LINES)) if _mode in STRICT else D_PARSED} SELECT stem, line_no, cls, {_errors} AS errors, coalesce({_box}, false) AS is_box, coalesce({D_DEGENERATE}, false) AS degenerate FROM v WHERE {_where}")(validated(_mode))


@query(f"""WITH {D_PARSED}, n AS (SELECT * FROM v WHERE n_fields > 0), k AS (SELECT stem, min(line_no) FILTER (WHERE cls IS NULL) AS broken FROM n GROUP BY stem)
SELECT n.stem, coalesce(array_to_string(list_sort(list_distinct(list(n.cls) FILTER (WHERE broken IS NULL OR line_no < broken))), ','), '') AS classes, any_value(broken) IS NOT NULL AS parse_error
FROM n JOIN k USING (stem) GROUP BY n.stem""")
def label_first_tokens(spark, d):
    return labels.first_tokens(lines(spark, d), "stem").withColumn("classes", F.array_join("classes", ","))


@query(f"""WITH {D_PARSED} SELECT split, count(DISTINCT stem) AS images, 0 AS missing_labels, count(DISTINCT stem) FILTER (WHERE ({D_QA}) <> '') AS files_with_errors,
count(*) FILTER (WHERE ({D_QA}) = '') AS boxes, count(*) FILTER (WHERE ({D_QA}) <> '') AS errors FROM v GROUP BY split""")
def qa_summary(spark, d):
    checked = labels.validate(lines(spark, d), "qa", [0, 1], ("stem", "split", "line_no"))
    per = checked.groupBy("split", "stem").agg(F.count_if("is_box").alias("n_boxes"), F.sum(F.size("errors")).alias("n_errors")).withColumn("has_label", F.lit(True))
    return audit.split_summary(per, ["split"]).withColumn("missing_labels", F.col("missing_labels").cast("int"))


@query(f"""WITH b AS ({D_BOXES}) SELECT split, cls, count(*) AS boxes FROM b GROUP BY ROLLUP (split, cls)""")
def class_rollup(spark, d):
    return audit.class_counts(boxes(spark, d))


@query(f"""WITH b AS ({D_BOXES}) SELECT image, idx, CASE cls5 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END AS cls FROM b WHERE cls5 <> 3""")
def class_remap(spark, d):
    rows = boxes(spark, d).select("image", "idx", F.col("cls5").cast("int").alias("cls"))
    return labels.remap(rows, {0: "Helmet", 1: " gloves", 2: "safety-vest", 3: "truck", 4: "Safety_Vest"})


@query(f"""WITH b AS ({D_BOXES}), s AS (SELECT image, array_to_string(list_sort(list_distinct(list(cls))), ',') AS k FROM b GROUP BY image)
SELECT CASE k WHEN '0' THEN 'smoke_only' WHEN '1' THEN 'fire_only' WHEN '0,1' THEN 'fire_and_smoke' ELSE 'negative' END AS profile, count(*) AS images FROM s GROUP BY 1""")
def label_profiles(spark, d):
    names = {(): "negative", (0,): "smoke_only", (1,): "fire_only", (0, 1): "fire_and_smoke"}
    return labels.profiles(boxes(spark, d), names, "image").groupBy("profile").agg(F.count("*").alias("images"))


@query("""WITH h AS (SELECT d.doc_id, count(*) FILTER (WHERE l.quality = 1) AS a, count(*) FILTER (WHERE l.toxic = 1) AS b FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.doc_id)
SELECT count(*) FILTER (WHERE a > 0 AND b = 0) AS only_first, count(*) FILTER (WHERE b > 0 AND a = 0) AS only_second, count(*) FILTER (WHERE a > 0 AND b > 0) AS both,
count(*) FILTER (WHERE a = 0 AND b = 0) AS neither, cast(sum(a) AS bigint) AS first_boxes, cast(sum(b) AS bigint) AS second_boxes FROM h""")
def class_composition(spark, d):
    marks = table(spark, d, "labels").select("doc_id", F.explode(F.array_compact(F.array(F.when(F.col("quality") == 1, 0), F.when(F.col("toxic") == 1, 1)))).alias("cls"))
    return audit.composition(table(spark, d, "documents").select("doc_id").join(marks, "doc_id", "left"), 0, 1, "doc_id")


@query("""SELECT doc_id, d.k IS NOT NULL AS has_image, l.k IS NOT NULL AS has_label FROM (SELECT DISTINCT doc_id, 1 AS k FROM documents WHERE length(text) > 300) d FULL JOIN (SELECT DISTINCT doc_id, 1 AS k FROM labels) l USING (doc_id)""")
def image_label_pairs(spark, d):
    return audit.pair_up(table(spark, d, "documents").where("length(text) > 300"), table(spark, d, "labels"), ["doc_id"])


@query(f"""WITH i AS ({D_IMAGES}) SELECT path FROM i WHERE id NOT IN (SELECT doc_id FROM labels)""")
def missing_labels(spark, d):
    rows = images(spark, d)
    have = rows.join(table(spark, d, "labels").select(F.col("doc_id").alias("id")), "id").select(S.label_path(F.col("path")).alias("path"))
    return audit.missing_labels(rows.select("path"), have)


@query(f"""WITH b AS ({D_BOXES}) SELECT split, array_to_string(list_sort(list_distinct(list(cls5))), ',') AS seen, '3' AS extra, '9' AS lacking, false AS ok FROM b GROUP BY split""")
def unexpected_classes(spark, d):
    rows = audit.unexpected_classes(boxes(spark, d).select("split", F.col("cls5").cast("int").alias("cls")), [0, 1, 2, 4, 9], ["split"])
    return rows.select("split", *(F.array_join(c, ",").alias(c) for c in ("seen", "extra", "lacking")), "ok")


@query("SELECT n_boxes, count(*) AS images FROM (SELECT o_orderkey, count(l_orderkey) AS n_boxes FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 25) ON o_orderkey = l_orderkey GROUP BY o_orderkey) GROUP BY n_boxes")
def box_histogram(spark, d):
    return audit.box_histogram(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("k")), "k")


@query(f"""WITH b AS ({D_BOXES}), n AS (SELECT count(DISTINCT image) AS n FROM b) SELECT cls5 AS cls, count(*) AS objects, count(DISTINCT image) AS images, round(100.0 * count(DISTINCT image) / any_value(n), 6) AS percent FROM b, n GROUP BY cls5""")
def class_coverage(spark, d):
    rows = boxes(spark, d).select("image", F.col("cls5").alias("cls"))
    return audit.coverage(rows, rows, "image").withColumn("percent", F.round("percent", 6))


@query("SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000)")
def foreign_keys(spark, d):
    return audit.foreign(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), table(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("k")), "k")


# Scalar functions


@query("SELECT p_partkey, trim(regexp_replace(translate(lower(p_type || '__' || p_name || '- '), '_-', '  '), '\\s+', ' ', 'g')) AS name FROM part")
def normalised_names(spark, d):
    return table(spark, d, "part").select("p_partkey", S.normalise_name(F.concat("p_type", F.lit("__"), "p_name", F.lit("- "))).alias("name"))


@query(f"""WITH i AS ({D_IMAGES}) SELECT id, replace(replace(path, '/images/', '/labels/'), '.jpg', '.txt') AS label, 'pack/' || substr(path, 7) AS moved, upper(lang) AS prefix, id AS number,
upper(lang) || id AS source FROM i""")
def path_functions(spark, d):
    rows = images(spark, d)
    exported = F.concat(F.regexp_replace("path", r"\.jpg$", ".rf."), F.md5("path"), F.lit(".jpg"))
    series = S.series_key(F.col("path"))
    return rows.select("id", S.label_path(F.col("path")).alias("label"), S.relocate(F.col("path"), "/data", "pack").alias("moved"), series["prefix"].alias("prefix"), series["number"].alias("number"), S.source_key(exported).alias("source"))


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g'), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) AS text, CASE WHEN url LIKE '%png%' THEN '.png' WHEN url LIKE '%gif%' THEN '.gif' ELSE '.jpg' END AS suffix FROM pages""")
def stripped_pages(spark, d):
    return table(spark, d, "pages").select("page_id", S.strip_html(F.col("html")).alias("text"), S.mime_suffix(F.col("url")).alias("suffix"))


@query("""SELECT event_id, coalesce(nullif(json_extract_string(props, '$.k'), ''), 'Unknown') AS k, coalesce(nullif(json_extract_string(props, '$.artist'), ''), 'Unknown') AS artist FROM events""")
def json_defaults(spark, d):
    return table(spark, d, "events").select("event_id", S.json_text(F.col("props"), "$.k").alias("k"), S.json_text(F.col("props"), "$.artist").alias("artist"))


D_CREDENTIALS = S.CREDENTIALS.replace("'", "''")


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{D_CREDENTIALS}')")
def credentials_documents(spark, d):
    return audit.credential_hits(table(spark, d, "documents"), "doc_id", "text")


@query(f"SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, '{D_CREDENTIALS}')")
def credentials_conversations(spark, d):
    rows = table(spark, d, "conversations").withColumn("at", F.struct("conv_id", "turn"))
    return audit.credential_hits(rows, "at", "text").select("at.*")


@query(f"SELECT page_id FROM pages WHERE regexp_matches(html, '{D_CREDENTIALS}')")
def credentials_pages(spark, d):
    return audit.credential_hits(table(spark, d, "pages"), "page_id", "html")


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'webcam' WHEN 1 THEN 'image' ELSE 'video' END AS kind FROM customer""")
def source_kinds(spark, d):
    name = F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).when(F.col("c_custkey") % 3 == 1, F.concat("c_name", F.lit(".PNG"))).otherwise(F.concat(F.lit("/v/"), "c_name", F.lit(".mp4")))
    return table(spark, d, "customer").select("c_custkey", S.source_kind(name).alias("kind"))


@query()
def file_inventory(spark, d):
    """Every file below the tables' folder; tests compare it with a listing."""
    return files.scan_files(spark, d).select("stem", "suffix", "length")


# Boxes

@query(f"""WITH b AS ({D_BOXES}) SELECT image, idx, round(xc - w / 2, 6) AS x1, round(yc - h / 2, 6) AS y1, round(xc + w / 2, 6) AS x2, round(yc + h / 2, 6) AS y2, cast(trunc((xc - w / 2) * 640) AS int) AS left_px FROM b""")
def box_corners(spark, d):
    box = S.corners(*(F.col(c) for c in ("xc", "yc", "w", "h")))
    rows = boxes(spark, d).withColumn("b", box).withColumn("px", S.scaled(F.col("b"), F.lit(640), F.lit(480)))
    return rows.select("image", "idx", *(F.round(f"b.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")), F.col("px.x1").alias("left_px"))


@query(f"""WITH b AS ({D_BOXES}) SELECT image, idx, round(least(greatest((px + px + pw) / 2.0 / 640, 0), 1), 8) AS xc, round(least(greatest((py + py + ph) / 2.0 / 480, 0), 1), 8) AS yc,
round(least(greatest(pw / 640.0, 0.001), 1), 8) AS w, round(least(greatest(ph / 480.0, 0.001), 1), 8) AS h, cls || ' 0.5 0.5 1.0 1.0' AS whole FROM b""")
def box_from_pixels(spark, d):
    corners = F.struct(F.col("px").alias("x1"), F.col("py").alias("y1"), (F.col("px") + F.col("pw")).alias("x2"), (F.col("py") + F.col("ph")).alias("y2"))
    rows = boxes(spark, d).withColumn("b", S.centred_from_corners(corners, F.lit(640), F.lit(480)))
    return rows.select("image", "idx", *(F.round(f"b.{c}", 8).alias(c) for c in ("xc", "yc", "w", "h")), S.whole_image_line(F.col("cls")).alias("whole"))


@query(f"""WITH b AS ({D_BOXES}), l AS (SELECT image, idx, cls || printf(' %.6f %.6f %.6f %.6f', (idx % 8) / 8.0, (cls5 % 4) / 4.0, 0.5, 0.25) AS line FROM b)
SELECT image, string_agg(line, chr(10) ORDER BY idx) || chr(10) AS text FROM l GROUP BY image""")
def label_file_texts(spark, d):
    rows = boxes(spark, d).select("image", F.col("idx").alias("line_no"), "cls", (F.col("idx") % 8 / 8.0).alias("xc"), (F.col("cls5") % 4 / 4.0).alias("yc"), F.lit(0.5).alias("w"), F.lit(0.25).alias("h"))
    return files.label_files(rows, "image")


COCO_NOTES = "SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS image_id, (l_suppkey % 5) * 3 + 1 AS category_id, cast(l_partkey % 700 AS double) AS x, cast(l_suppkey % 500 AS double) AS y, cast(l_partkey % 300 AS double) AS w, cast(l_partkey % 200 AS double) AS h, CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS iscrowd FROM {lineitem}"


def coco_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    images = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat("o_orderstatus", F.col("o_orderkey").cast("string")).alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    categories = table(spark, d, "region").select((F.col("r_regionkey") * 3 + 1).cast("long").alias("id"), F.lower("r_name").alias("name"))
    notes = by_sql(spark, d, COCO_NOTES, "lineitem").select("id", "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"), "iscrowd")
    return images, categories, notes


D_COCO = f"n AS ({duck(COCO_NOTES)}), k AS (SELECT o_orderkey AS image_id FROM orders), c AS (SELECT r_regionkey * 3 + 1 AS category_id, row_number() OVER (ORDER BY r_regionkey) - 1 AS cls, lower(r_name) AS name FROM region)"


@query(f"""WITH {D_COCO}, b AS (SELECT image_id, id AS line_no, cls, round(least(greatest((x + w / 2) / 640, 0), 1), 8) AS xc, round(least(greatest((y + h / 2) / 480, 0), 1), 8) AS yc,
round(least(greatest(w / 640, 0), 1), 8) AS w, round(least(greatest(h / 480, 0), 1), 8) AS h FROM n JOIN c USING (category_id)) SELECT image_id, line_no, cls, xc, yc, w, h FROM k LEFT JOIN b USING (image_id)""")
def coco_clamped(spark, d):
    return coco.to_boxes(*coco_tables(spark, d)).select("image_id", "line_no", F.col("cls").cast("long").alias("cls"), *(F.round(c, 8).alias(c) for c in ("xc", "yc", "w", "h")))


@query(f"""WITH {D_COCO}, b AS (SELECT n.*, cls FROM n JOIN c USING (category_id) WHERE name = 'asia' AND iscrowd = 0 AND w > 0 AND w <= 640 AND h > 0 AND h <= 480),
p AS (SELECT image_id, count(*) AS n FROM b GROUP BY image_id), z AS (SELECT count(*) AS crowds_dropped FROM n JOIN c USING (category_id) WHERE name = 'asia' AND iscrowd = 1)
SELECT coalesce(p.n, 0) AS n_boxes, count(*) AS images, any_value(crowds_dropped) AS crowds_dropped FROM k LEFT JOIN p USING (image_id), z GROUP BY 1""")
def coco_category(spark, d):
    images, categories, notes = coco_tables(spark, d)
    own, dropped = coco.of_category(categories, notes, "asia")
    found = coco.to_boxes(images, categories, own, clamped=False)
    per = found.groupBy("image_id").agg(F.count("cls").alias("n_boxes")).groupBy("n_boxes").agg(F.count("*").alias("images"))
    return per.join(F.broadcast(dropped))


@query("SELECT r_regionkey * 3 + 1 AS category_id, row_number() OVER (ORDER BY r_regionkey) - 1 AS cls FROM region")
def class_order(spark, d):
    return coco.class_order(coco_tables(spark, d)[1]).select("category_id", F.col("cls").cast("long").alias("cls"))


def truth_and_predictions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    # Kept, as both are read more than once, and each time the boxes would be dealt out and numbered again.
    rows = save(boxes(spark, d).select("image", "idx", "cls", "xc", "yc", "w", "h", "px", "l_quantity"), "boxes")
    truth = rows.select("image", "idx", "cls", S.corners(*(F.col(c) for c in ("xc", "yc", "w", "h"))).alias("box"))
    moved = S.corners(F.col("xc") + (F.col("px") % 7 - 3) / 100.0, F.col("yc"), F.col("w"), F.col("h"))
    predictions = rows.where("l_quantity > 4").select("image", "idx", F.when(F.col("px") % 13 == 0, 1 - F.col("cls")).otherwise(F.col("cls")).alias("cls"), moved.alias("box"), (F.col("px") / 1000.0).alias("conf"))
    return truth, predictions


D_IOU = f"""b AS ({D_BOXES}), g AS (SELECT image, idx, cls, xc - w / 2 AS x1, yc - h / 2 AS y1, xc + w / 2 AS x2, yc + h / 2 AS y2 FROM b),
p AS (SELECT image, idx, CASE WHEN px % 13 = 0 THEN 1 - cls ELSE cls END AS cls, xc + (px % 7 - 3) / 100.0 - w / 2 AS x1, yc - h / 2 AS y1, xc + (px % 7 - 3) / 100.0 + w / 2 AS x2, yc + h / 2 AS y2 FROM b WHERE l_quantity > 4),
o AS (SELECT p.image, p.idx AS pred, g.idx AS gt, greatest(least(p.x2, g.x2) - greatest(p.x1, g.x1), 0) * greatest(least(p.y2, g.y2) - greatest(p.y1, g.y1), 0) AS i, (p.x2 - p.x1) * (p.y2 - p.y1) + (g.x2 - g.x1) * (g.y2 - g.y1) AS s FROM p JOIN g USING (image, cls))"""


@query(f"WITH {D_IOU} SELECT image, pred, gt, round(i / greatest(s - i, 1e-9), 6) AS iou FROM o WHERE i / greatest(s - i, 1e-9) >= 0.5")
def iou_candidates(spark, d):
    truth, predictions = truth_and_predictions(spark, d)
    return evaluate.candidates(predictions, truth).withColumn("iou", F.round("iou", 6))


D_GREEDY = f"""{D_IOU}, c AS (SELECT image, pred, gt, i / greatest(s - i, 1e-9) AS iou, row_number() OVER (PARTITION BY image ORDER BY i / greatest(s - i, 1e-9) DESC, pred, gt) AS k FROM o WHERE i / greatest(s - i, 1e-9) >= 0.5),
t AS (SELECT image, k, pred, gt, iou, [pred] AS ps, [gt] AS gs, true AS hit FROM c WHERE k = 1 UNION ALL
SELECT c.image, c.k, c.pred, c.gt, c.iou, CASE WHEN list_contains(ps, c.pred) OR list_contains(gs, c.gt) THEN ps ELSE list_append(ps, c.pred) END,
CASE WHEN list_contains(ps, c.pred) OR list_contains(gs, c.gt) THEN gs ELSE list_append(gs, c.gt) END, NOT (list_contains(ps, c.pred) OR list_contains(gs, c.gt)) FROM t JOIN c ON c.image = t.image AND c.k = t.k + 1),
m AS (SELECT image, pred, gt, iou FROM t WHERE hit)"""
D_OUTCOMES = f"""{D_GREEDY}, u AS (SELECT g.image, g.cls, CASE WHEN m.gt IS NULL THEN 'fn' ELSE 'tp' END AS outcome FROM g LEFT JOIN m ON m.image = g.image AND m.gt = g.idx
UNION ALL SELECT p.image, p.cls, 'fp' FROM p LEFT JOIN m ON m.image = p.image AND m.pred = p.idx WHERE m.pred IS NULL)"""


@query(f"WITH RECURSIVE {D_GREEDY} SELECT image, pred, gt, round(iou, 6) AS iou FROM m")
def greedy_matches(spark, d):
    truth, predictions = truth_and_predictions(spark, d)
    return evaluate.greedy_matches(predictions, truth).withColumn("iou", F.round("iou", 6))


def box_outcomes(spark: SparkSession, d: str) -> DataFrame:
    truth, predictions = truth_and_predictions(spark, d)
    return evaluate.outcomes(predictions, truth, save(evaluate.greedy_matches(predictions, truth), "matches"))  # truth and predictions both read them


@query(f"WITH RECURSIVE {D_OUTCOMES} SELECT cls, count(*) FILTER (WHERE outcome = 'tp') AS tp, count(*) FILTER (WHERE outcome = 'fn') AS fn, count(*) FILTER (WHERE outcome = 'fp') AS fp FROM u GROUP BY ROLLUP (cls)")
def match_totals(spark, d):
    return evaluate.totals(box_outcomes(spark, d))


@query(f"""WITH RECURSIVE {D_OUTCOMES}, e AS (SELECT image, count(*) FILTER (WHERE outcome = 'fn') AS fn, count(*) FILTER (WHERE outcome = 'fp') AS fp,
coalesce(array_to_string(list_sort(list(cls) FILTER (WHERE outcome = 'fn')), ','), '') AS fn_classes, coalesce(array_to_string(list_sort(list(cls) FILTER (WHERE outcome = 'fp')), ','), '') AS fp_classes FROM u GROUP BY image)
SELECT * FROM e WHERE fn + fp > 0 ORDER BY fn + fp DESC, image LIMIT 50""")
def worst_images(spark, d):
    return evaluate.worst_images(box_outcomes(spark, d)).withColumns({c: F.array_join(c, ",") for c in ("fn_classes", "fp_classes")})


D_OVERLAPS = ", ".join(f"({x})" for x in evaluate.OVERLAPS)


@query(f"""WITH s AS (SELECT cast(l_suppkey % 5 AS int) AS cls, (l_partkey % 100) / 100.0 AS conf, (l_orderkey % 60) / 60.0 AS iou FROM lineitem), n AS (SELECT cls, count(*) AS n FROM s GROUP BY 1),
t AS (SELECT least, cls, conf, count(*) FILTER (WHERE iou >= least) AS hits, count(*) AS a FROM s, (VALUES {D_OVERLAPS}) l(least) GROUP BY ALL),
u AS (SELECT *, sum(hits) OVER w AS tp, sum(a) OVER w AS seen FROM t WINDOW w AS (PARTITION BY least, cls ORDER BY conf DESC)),
v AS (SELECT *, max(tp / seen) OVER (PARTITION BY least, cls ORDER BY conf DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best FROM u),
ap AS (SELECT least, cls, sum(best * hits / n) AS ap FROM v JOIN n USING (cls) GROUP BY ALL), f AS (SELECT cls, tp / seen AS p, tp / n AS r, row_number() OVER (PARTITION BY cls ORDER BY 2 * tp / (n + seen) DESC, conf DESC) AS k FROM u JOIN n USING (cls) WHERE least = 0.5),
z AS (SELECT cls, p, r, (SELECT ap FROM ap WHERE ap.cls = f.cls AND least = 0.5) AS a, (SELECT avg(ap) FROM ap WHERE ap.cls = f.cls) AS b FROM f WHERE k = 1)
SELECT cls, round(p, 6) AS precision, round(r, 6) AS recall, round(a, 6) AS ap50, round(b, 6) AS ap50_95 FROM z UNION ALL SELECT NULL, round(avg(p), 6), round(avg(r), 6), round(avg(a), 6), round(avg(b), 6) FROM z""")
def detection_report(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_suppkey") % 5).cast("int").alias("cls"), (F.col("l_partkey") % 100 / 100.0).alias("conf"), (F.col("l_orderkey") % 60 / 60.0).alias("iou"))
    return evaluate.detection_report(rows, rows).select("cls", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "ap50", "ap50_95")))


@query("""WITH s AS (SELECT cast(l_suppkey % 5 AS int) AS cls, (l_partkey % 100) / 100.0 AS conf, l_quantity > 25 AS hit FROM lineitem), n AS (SELECT cast(l_suppkey % 5 AS int) AS cls, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT cls, conf, count(*) FILTER (WHERE hit) AS hits, count(*) AS a FROM s GROUP BY cls, conf),
u AS (SELECT *, sum(hits) OVER w / sum(a) OVER w AS p FROM t WINDOW w AS (PARTITION BY cls ORDER BY conf DESC)), v AS (SELECT *, max(p) OVER (PARTITION BY cls ORDER BY conf DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best FROM u)
SELECT cls, round(sum(best * hits / n), 6) AS ap FROM v JOIN n USING (cls) GROUP BY cls""")
def average_precision(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_suppkey") % 5).cast("int").alias("cls"), (F.col("l_partkey") % 100 / 100.0).alias("conf"), (F.col("l_quantity") > 25).alias("hit"))
    return evaluate.average_precision(rows, rows).withColumn("ap", F.round("ap", 6))


# Hashes and groups


@query(f"{D_BITS.replace('vec_id AS id, label', 'vec_id AS id').replace(' AS h', ' AS bits')}")
def sign_bits(spark, d):
    return hashes(spark, d).select("id", F.lpad(F.bin("h"), 64, "0").alias("bits"))


@query(f"WITH {D_PAIRS.format(t=NEAR)} SELECT a, b, d FROM p")
def hamming_pairs(spark, d):
    return hamming.hamming_pairs(hashes(spark, d), NEAR)


@query(f"""WITH o AS ({D_BITS}), b AS (SELECT id, h FROM o UNION ALL SELECT -1 - id, left(h, 64 - id % 12) || translate(right(h, id % 12), '01', '10') FROM o)
SELECT x.id AS a, y.id AS b, cast(hamming(x.h, y.h) AS int) AS d FROM b x JOIN b y ON x.id < y.id WHERE hamming(x.h, y.h) <= 8""")
def hamming_pairs_close(spark, d):
    """Each hash beside a copy of it in which the last 0 to 11 bits are turned."""
    rows = hashes(spark, d).select("id", "h")
    turned = rows.select((-1 - F.col("id")).alias("id"), F.col("h").bitwiseXOR(F.expr("shiftleft(1L, cast(id % 12 AS int)) - 1")).alias("h"))
    return hamming.hamming_pairs(rows.unionByName(turned), 8)


@query(f"WITH {D_PAIRS.format(t=NEAR)} SELECT d, count(*) AS pairs FROM p GROUP BY d")
def hamming_histogram(spark, d):
    return hamming.distance_histogram(hashes(spark, d), NEAR)


@query(f"""WITH b AS ({D_BITS}), x AS (SELECT hamming(l.h, r.h) AS d FROM b l, b r WHERE l.id % 2 = 0 AND r.id % 2 = 1)
SELECT t AS threshold, count(d) AS pairs FROM (SELECT unnest([16, 18, 20]) AS t) LEFT JOIN x ON d <= t GROUP BY t""")
def overlap_counts(spark, d):
    rows = hashes(spark, d)
    return hamming.overlap_counts(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"), (16, 18, 20))


D_RANDOM = "md5('1|' || id)"


@query(f"""WITH b AS ({D_BITS}), r AS (SELECT id, h, row_number() OVER (ORDER BY {D_RANDOM}, id) - 1 AS k FROM b), t AS (SELECT k // 2 AS pair, min(h) AS x, max(h) AS y, count(*) AS n FROM r GROUP BY 1)
SELECT round(avg(hamming(x, y)), 6) AS mean_distance, count(*) AS pairs FROM t WHERE n = 2""")
def random_pair_distance(spark, d):
    return hamming.random_pair_distance(hashes(spark, d)).withColumn("mean_distance", F.round("mean_distance", 6))


D_GROUPS = f"""{D_PAIRS.format(t=NEAR)}, e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(node, reach) AS (SELECT id, id FROM b UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a), g AS (SELECT node AS id, min(reach) AS group_id FROM r GROUP BY node)"""


def groups(spark: SparkSession, d: str) -> DataFrame:
    rows = hashes(spark, d)
    return graph.grouped(rows, hamming.copy_edges(rows, NEAR), "id")


@query(f"WITH RECURSIVE {D_GROUPS} SELECT id, group_id FROM g")
def components(spark, d):
    return groups(spark, d).select("id", "group_id")


@query(f"WITH RECURSIVE {D_GROUPS} SELECT id AS removed, group_id AS kept FROM g WHERE id <> group_id")
def clique_quarantine(spark, d):
    return quarantine.clique_quarantine(hashes(spark, d), NEAR)


@query(f"""WITH RECURSIVE {D_GROUPS}, s AS (SELECT group_id, count(*) AS n FROM g GROUP BY group_id)
SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 50 THEN '6-50' WHEN n <= 500 THEN '51-500' ELSE '>500' END AS bucket, count(*) AS groups FROM s GROUP BY 1""")
def group_size_buckets(spark, d):
    return graph.size_buckets(groups(spark, d))


@query(f"WITH RECURSIVE {D_GROUPS} SELECT group_id, count(*) AS members FROM g GROUP BY group_id ORDER BY members DESC, group_id LIMIT 10")
def largest_groups(spark, d):
    return graph.largest_groups(groups(spark, d))


@query(f"""WITH RECURSIVE {D_GROUPS}, c AS (SELECT group_id, label, count(*) AS n, min(id) AS f FROM g JOIN b USING (id) GROUP BY group_id, label), m AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY n DESC, f) AS rn, sum(n) OVER (PARTITION BY group_id) AS members FROM c)
SELECT group_id, label, cast(members AS bigint) AS members FROM m WHERE rn = 1""")
def dominant_profiles(spark, d):
    return graph.dominant(groups(spark, d), "label", "id")


D_PRIORITY = "CASE {0} % 10 WHEN 8 THEN 3 WHEN 9 THEN 3 WHEN 6 THEN 2 WHEN 7 THEN 2 ELSE 1 END"


@query(f"""WITH {D_PAIRS.format(t=NEAR)}, e AS (SELECT a, b, d FROM p UNION ALL SELECT b, a, d FROM p), n AS (SELECT * FROM e WHERE {D_PRIORITY.format('a')} < {D_PRIORITY.format('b')}),
m AS (SELECT a, min(b) AS kept FROM n GROUP BY a) SELECT n.a AS removed, m.kept, {SPLIT.format(k='n.a')} AS split, n.d AS distance FROM m JOIN n ON m.a = n.a AND m.kept = n.b""")
def near_quarantine(spark, d):
    return quarantine.near_quarantine(hashes(spark, d), NEAR)


@query(f"WITH {D_PAIRS.format(t=NEAR)} SELECT d, ({SPLIT.format(k='a')}) <> ({SPLIT.format(k='b')}) AS crossing, count(*) AS pairs FROM p GROUP BY 1, 2")
def crossing_histogram(spark, d):
    return splitting.crossing_histogram(hashes(spark, d), NEAR)


@query(f"WITH {D_PAIRS.format(t=NEAR)}, s AS (SELECT d, {SPLIT.format(k='a')} AS x, {SPLIT.format(k='b')} AS y FROM p) SELECT least(x, y) AS first_split, greatest(x, y) AS second_split, d, count(*) AS pairs FROM s GROUP BY 1, 2, 3")
def split_pair_counts(spark, d):
    return splitting.split_pair_counts(hashes(spark, d), NEAR)


@query(f"""WITH b AS ({D_BITS}), s AS (SELECT id, h, lag(id) OVER w AS pid, lag(h) OVER w AS ph FROM b WINDOW w AS (PARTITION BY label ORDER BY id))
SELECT pid AS a, id AS b, cast(hamming(h, ph) AS int) AS d FROM s WHERE id - pid <= 20 AND hamming(h, ph) <= 32""")
def series_links(spark, d):
    rows = hashes(spark, d).select("id", F.col("label").alias("prefix"), F.col("id").alias("number"), "h")
    return splitting.series_links(rows, 20, 32)


@query(f"WITH i AS ({D_IMAGES}), m AS (SELECT source, min(id) AS a FROM i GROUP BY source) SELECT a, id AS b FROM i JOIN m USING (source) WHERE id <> a")
def source_links(spark, d):
    return splitting.source_links(images(spark, d))


@query()
def leakage_free_split(spark, d):
    from .resplit import resplit

    rows = hashes(spark, d).withColumn("profile", F.concat(F.lit("label"), F.col("label").cast("string")))
    return resplit(rows, NEAR, (0.8, 0.1, 0.1)).select("id", "group_id", "profile", "split")


@query()
def resplit_crossings(spark, d):
    from .resplit import resplit, verify

    rows = hashes(spark, d).withColumn("profile", F.concat(F.lit("label"), F.col("label").cast("string")))
    return verify(rows, resplit(rows, NEAR, (0.8, 0.1, 0.1)), NEAR)


D_RULES = f"""{D_PAIRS.format(t=NEAR)}, y AS (SELECT id, h, lag(id) OVER w AS pid, lag(h) OVER w AS ph FROM b WINDOW w AS (PARTITION BY label ORDER BY id)),
l AS (SELECT a, b FROM p UNION SELECT (id // 7) * 7, id FROM b WHERE id % 7 <> 0 UNION SELECT pid, id FROM y WHERE id - pid <= 20 AND hamming(h, ph) <= 24), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reach) AS (SELECT id, id FROM b UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a)"""


def ruled(spark: SparkSession, d: str) -> DataFrame:
    """Rows of sources of seven ids and of series by label."""
    rows = hashes(spark, d).withColumn("profile", F.concat(F.lit("label"), F.col("label").cast("string")))
    return rows.withColumns({"source": F.floor(F.col("id") / 7), "prefix": F.col("label"), "number": F.col("id")})


@query(f"WITH RECURSIVE {D_RULES} SELECT node AS id, min(reach) AS group_id FROM r GROUP BY node")
def rule_groups(spark, d):
    """Groups by near copies, sources and series together."""
    from .resplit import rule_links

    rows = ruled(spark, d)
    source, series = rule_links(rows, 20, 24)
    return graph.grouped(rows, hamming.copy_edges(rows, NEAR).unionByName(source).unionByName(series), "id").select("id", "group_id")


@query()
def rule_leakage(spark, d):
    """Pairs within and across the official split, what the quarantine keeps of it, and the new split by all three rules."""
    from .resplit import leakage, resplit_by_rules

    rows = ruled(spark, d)
    return leakage(rows, save(resplit_by_rules(rows, NEAR, (0.8, 0.1, 0.1), 20, 24), "resplit"), NEAR)


@query(f"""WITH i AS ({D_IMAGES}), a AS (SELECT id AS a, text FROM i WHERE split = 'train'), b AS (SELECT id AS b, text FROM i WHERE split <> 'train') SELECT a, b FROM a JOIN b USING (text) ORDER BY a, b LIMIT 10""")
def overlap_examples(spark, d):
    rows = images(spark, d).select("id", "split", F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("h"))
    return hamming.first_equal_pairs(rows.where("split = 'train'"), rows.where("split <> 'train'"))


@query(f"""WITH {D_PAIRS.format(t=NEAR)}, {D_PARSED}, k AS (SELECT cast(stem AS bigint) AS id, count(*) FILTER (WHERE ({D_QA}) <> '') AS errors FROM v GROUP BY 1), i AS (SELECT id, label, {D_SPLIT_ID} AS split FROM b),
fl AS (SELECT split, label <> 3 AS readable, errors IS NOT NULL AS has_label, coalesce(errors, 0) AS errors FROM i LEFT JOIN k USING (id)),
n AS (SELECT split, count(*) AS images, count(*) FILTER (WHERE NOT readable) AS unreadable, count(*) FILTER (WHERE NOT has_label) AS without_label, count(*) FILTER (WHERE errors > 0) AS label_errors FROM fl GROUP BY split),
x AS (SELECT i.split, cls, count(*) AS c FROM v JOIN i ON i.id = cast(stem AS bigint) WHERE ({D_QA}) = '' GROUP BY ALL), y AS (SELECT split, cast(sum(c) AS bigint) AS boxes, string_agg(cls || ':' || c, ',' ORDER BY cls) AS class_counts FROM x GROUP BY split),
s AS (SELECT i.split, a, b, d, row_number() OVER (PARTITION BY i.split ORDER BY a, b) AS rn FROM p JOIN i ON i.id = a JOIN i j ON j.id = b AND j.split = i.split WHERE i.label <> 3 AND j.label <> 3),
e AS (SELECT split, count(*) AS duplicate_pairs, string_agg(a || '-' || b || ':' || d, ',' ORDER BY a, b) FILTER (WHERE rn <= 10) AS examples FROM s GROUP BY split)
SELECT n.*, unreadable + without_label + label_errors AS errors_total, coalesce(boxes, 0) AS boxes, class_counts, coalesce(duplicate_pairs, 0) AS duplicate_pairs, examples FROM n LEFT JOIN y USING (split) LEFT JOIN e USING (split)""")
def qa_report(spark, d):
    checked = labels.validate(lines(spark, d), "qa", [0, 1], ("stem", "line_no"))
    checked = save(checked.select(F.col("stem").cast("long").alias("id"), "cls", "is_box", (F.size("errors") > 0).alias("wrong")), "qa-lines")  # read twice
    rows = hashes(spark, d)
    per = checked.groupBy("id").agg(F.count_if("wrong").alias("errors"))
    files_ = rows.join(per, "id", "left").select("split", (F.col("label") != 3).alias("readable"), F.col("errors").isNotNull().alias("has_label"), F.coalesce("errors", F.lit(0)).alias("n_errors"))
    valid = checked.where("is_box").join(rows.select("id", "split"), "id").select("split", "cls")
    made = audit.qa_report(files_, valid, rows.where("label <> 3"), NEAR)
    counts = F.array_join(F.transform(F.map_entries("class_counts"), lambda x: F.concat_ws(":", x["key"].cast("string"), x["value"].cast("string"))), ",")
    shown = F.array_join(F.transform("examples", lambda x: F.concat(x["a"].cast("string"), F.lit("-"), x["b"].cast("string"), F.lit(":"), x["d"].cast("string"))), ",")
    return made.withColumns({"class_counts": counts, "examples": shown})


# Sinks, and the sources that read them back


@query(f"WITH i AS ({D_IMAGES}) SELECT path, split FROM i")
def split_lists(spark, d):
    folder = new_folder(spark, "split-lists")
    files.write_split_lists(images(spark, d).select("path", "split"), folder)
    parts = [files.scan_lists(spark, f"{folder}/split={s}").withColumn("split", F.lit(s)) for s in splitting.SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(ORACLES["exact_quarantine"].replace("SELECT id AS removed, kept, split", "SELECT cast(id AS varchar) AS removed, cast(kept AS varchar) AS kept, split"))
def quarantine_manifest_file(spark, d):
    folder = new_folder(spark, "manifest")
    files.write_manifest(exact_quarantine(spark, d), folder)
    return spark.read.option("header", True).csv(folder).select("removed", "kept", "split")


@query(f"WITH i AS ({D_IMAGES}) SELECT split, count(*) AS documents, cast(sum(length(text)) AS bigint) AS characters FROM i GROUP BY split")
def table_by_split(spark, d):
    folder = new_folder(spark, "by-split")
    files.write_by_split(images(spark, d).select("id", "split", "text"), folder)
    rows = spark.read.schema("id long, text string, split string").parquet(folder)
    return rows.groupBy("split").agg(F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters"))


@query("SELECT p_name AS title, p_brand AS artist, p_type AS license_short, CASE WHEN p_size > 25 THEN p_brand END AS credit FROM part")
def license_records(spark, d):
    folder = new_folder(spark, "sidecars")
    own = {"title": F.col("p_name"), "artist": F.col("p_brand"), "license_short": F.col("p_type"), "credit": F.when(F.col("p_size") > 25, F.col("p_brand"))}
    files.write_sidecars(table(spark, d, "part").select(*(own.get(c, F.lit("Unknown")).alias(c) for c in files.SIDECAR)), folder)
    return files.scan_sidecars(spark, folder, lines=True).select("title", "artist", "license_short", "credit")


@query("""SELECT s_suppkey AS line_no, s_nationkey AS image_id, n_regionkey AS cls, round((s_suppkey % 100 + 20) / 640.0, 8) AS xc, 0.25 AS yc FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT NULL, n_nationkey, NULL, NULL, NULL FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)""")
def annotation_document(spark, d):
    """A nested document of images, categories and annotations, written, scanned and converted."""
    nation = table(spark, d, "nation")
    image = F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    category = F.struct((F.col("r_regionkey") * 3 + 1).cast("long").alias("id"), F.col("r_name").alias("name"))
    note = F.struct(F.col("s_suppkey").cast("long").alias("id"), F.col("s_nationkey").cast("long").alias("image_id"), (F.col("n_regionkey") * 3 + 1).cast("long").alias("category_id"),
                    F.array((F.col("s_suppkey") % 100).cast("double"), F.lit(100.0), F.lit(40.0), F.lit(40.0)).alias("bbox"), F.lit(0).alias("iscrowd"))
    # A document for each image's annotations; images and categories in the document of image 0.
    notes = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("s_nationkey").agg(F.collect_list(note).alias("annotations")).drop("s_nationkey")
    heads = nation.agg(F.collect_list(image).alias("images")).join(table(spark, d, "region").agg(F.collect_list(category).alias("categories")))
    folder = new_folder(spark, "annotations")
    notes.withColumns({"images": F.lit(None), "categories": F.lit(None)}).unionByName(heads.withColumn("annotations", F.lit(None))).write.json(folder)
    scanned = files.coco_tables(spark.read.schema(files.COCO).json(folder))
    rows = coco.to_boxes(*scanned)
    return rows.select("line_no", "image_id", F.col("cls").cast("long").alias("cls"), F.round("xc", 8).alias("xc"), "yc")


@query(f"{D_BITS.replace('vec_id AS id, label', 'vec_id AS id').replace(' AS h', ' AS bits')}")
def cached_hashes(spark, d):
    """Hashes made on the first call and read on the second."""
    at = new_folder(spark, "hash-cache")
    made = lambda: hashes(spark, d).select("id", F.lpad(F.bin("h"), 64, "0").alias("bits"))
    files.read_or_compute(spark, at, made)
    return files.read_or_compute(spark, at, lambda: made().where("false"))


@query("""WITH h AS (SELECT label, label || '-' || q AS query, p AS position FROM (VALUES ('a', 3), ('b', 1), ('c', 0)) l(label, n), range(4) r(q), range(9) s(p) WHERE q < n AND p < 2 + 3 * q AND p < 5)
SELECT label, query, cast(position AS int) AS position, query || '#' || position AS title FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY query, position) AS rn FROM h) WHERE rn <= 8""")
def search_hits(spark, d):
    """Hits of a service with pages of three, at most five for each query and eight for each label."""
    from ..sources.search import search, sidecars

    def fetch(text, token):
        last, first = 2 + 3 * int(text[-1]), int(token or 0)
        hits = [{"title": f"{text}#{k}"} for k in range(first, min(last, first + 3))]
        return hits, str(first + 3) if first + 3 < last else None

    hits = search(spark, {"a": ["a-0", "a-1", "a-2"], "b": ["b-0"], "c": []}, fetch, 5, 8)
    return hits.select("label", "query", "position", F.get_json_object("info", "$.title").alias("title"))


# Aggregates, checks


@query("""WITH r AS (SELECT l_returnflag, l_quantity AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rn, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, v AS upper_median FROM r WHERE rn = n // 2 + 1""")
def upper_median(spark, d):
    return audit.upper_median(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity")


@query("SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS stdev, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY o_orderpriority")
def statistics(spark, d):
    rows = audit.statistics(table(spark, d, "orders"), ["o_orderpriority"], "o_totalprice")
    return rows.select("o_orderpriority", *(F.round(c, 4).alias(c) for c in ("mean", "median", "stdev")), "min", "max")


@query("SELECT event_type, count(*) AS frames, round(sum(value), 4) AS seconds, round(count(*) / nullif(sum(value), 0), 6) AS fps, round(sum(value) / count(*), 6) AS per_frame FROM events GROUP BY event_type")
def frame_rates(spark, d):
    rows = audit.rates(table(spark, d, "events"), ["event_type"], "value")
    return rows.select("event_type", "frames", F.round("seconds", 4).alias("seconds"), F.round("fps", 6).alias("fps"), F.round("per_frame", 6).alias("per_frame"))


EXPECTED = (("A", 10), ("N", 20), ("R", 30), ("X", 40))


def checked(spark: SparkSession, d: str) -> DataFrame:
    measured = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("quantity")).agg((F.count("*") % 50).alias("measured"))
    return audit.check(measured, spark.createDataFrame(EXPECTED, "quantity string, expected long"))


D_CHECK = "c AS (SELECT e.quantity, expected, measured, measured - expected AS difference, coalesce(measured = expected, false) AS ok FROM (VALUES ('A', 10), ('N', 20), ('R', 30), ('X', 40)) e(quantity, expected) LEFT JOIN (SELECT l_returnflag AS quantity, count(*) % 50 AS measured FROM lineitem GROUP BY 1) m USING (quantity))"


@query(f"WITH {D_CHECK} SELECT * FROM c")
def expectations(spark, d):
    return checked(spark, d)


@query(f"WITH {D_CHECK} SELECT CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS checks, count(*) FILTER (WHERE NOT ok) AS failed FROM c")
def verdict(spark, d):
    return audit.verdict(checked(spark, d))


@query(f"WITH {D_CHECK} SELECT * FROM c")
def report_file(spark, d):
    folder = new_folder(spark, "report")
    files.write_report(checked(spark, d), folder)
    return files.scan_report(spark, f"{folder}/*.json", "quantity string, expected long, measured long, difference long, ok boolean", lines=True)


# Compliance

WORKERS = "SELECT c_custkey % 40 AS frame_no, c_custkey AS track_id, c_custkey AS pos, cast(c_custkey % 7 * 100 AS double) AS x1, 0.0D AS y1, cast(c_custkey % 7 * 100 + 80 AS double) AS x2, 200.0D AS y2 FROM {customer}"
ITEMS = "SELECT p_partkey % 40 AS frame_no, p_partkey AS item, CASE p_size % 5 WHEN 0 THEN 'helmet' WHEN 1 THEN 'gloves' WHEN 2 THEN 'goggles' WHEN 3 THEN 'vest' ELSE 'boots' END AS cls, cast(p_partkey % 700 AS double) AS x1, cast(p_size % 150 AS double) AS y1, cast(p_partkey % 700 + 20 AS double) AS x2, cast(p_size % 150 + 20 AS double) AS y2, 0.5D AS conf FROM {part}"
D_ASSIGN = f"""w AS ({duck(WORKERS)}), i AS ({duck(ITEMS).replace('0.5D', '0.5')}), s AS (SELECT w.frame_no, item, cls, track_id, pos, (i.x1 + i.x2) / 2 AS cx, (i.y1 + i.y2) / 2 AS cy, w.x1, w.y1, w.x2 - w.x1 AS bw, w.y2 - w.y1 AS bh FROM i JOIN w ON i.frame_no = w.frame_no WHERE cls <> 'boots'),
n AS (SELECT *, (cx - x1) / greatest(bw, 1) - 0.5 AS nx, (cy - y1) / greatest(bh, 1) - CASE cls WHEN 'helmet' THEN 0.14 WHEN 'goggles' THEN 0.26 WHEN 'vest' THEN 0.52 ELSE 0.68 END AS ny, cx BETWEEN x1 - 0.2 * bw AND x1 + bw + 0.2 * bw AND cy BETWEEN y1 - 0.2 * bh AND y1 + bh + 0.2 * bh AS inside FROM s),
c AS (SELECT *, CASE WHEN inside THEN 0.65 ELSE 0 END + 0.35 * greatest(0, 1 - least(sqrt(CASE WHEN cls = 'gloves' THEN 0.15 ELSE 0.3 END * nx * nx + CASE WHEN cls IN ('helmet', 'goggles') THEN 0.7 ELSE 0.55 END * ny * ny) / 0.75, 1)) + 0.05 * 0.5 AS score FROM n),
a AS (SELECT frame_no, item, cls, track_id, score FROM (SELECT *, row_number() OVER (PARTITION BY frame_no, item ORDER BY round(score, 9) DESC, pos) AS rn FROM c) WHERE rn = 1 AND score >= 0.45)"""


def workers_and_items(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    box = F.struct("x1", "y1", "x2", "y2").alias("box")
    return by_sql(spark, d, WORKERS, "customer").select("frame_no", "track_id", "pos", box), by_sql(spark, d, ITEMS, "part").select("frame_no", "item", "cls", "conf", box)


@query(f"WITH {D_ASSIGN} SELECT frame_no, item, cls, track_id, round(score, 6) AS score FROM a")
def item_assignment(spark, d):
    return compliance.assign_items(*workers_and_items(spark, d)).withColumn("score", F.round("score", 6))


@query(f"""WITH {D_ASSIGN}, r AS (SELECT w.frame_no, w.track_id, k.cls, k.o, count(a.item) AS n FROM w CROSS JOIN (VALUES ('helmet', 1), ('gloves', 2), ('goggles', 3), ('vest', 4)) k(cls, o) LEFT JOIN a ON a.frame_no = w.frame_no AND a.track_id = w.track_id AND a.cls = k.cls GROUP BY ALL)
SELECT frame_no, track_id, coalesce(string_agg(cls, ',' ORDER BY o) FILTER (WHERE n > 0), '') AS present, coalesce(string_agg(cls, ',' ORDER BY o) FILTER (WHERE n = 0), '') AS missing, count(*) FILTER (WHERE n = 0) = 0 AS compliant FROM r GROUP BY frame_no, track_id""")
def worker_status(spark, d):
    workers, items = workers_and_items(spark, d)
    rows = compliance.status(workers, compliance.assign_items(workers, items))
    return rows.select("frame_no", "track_id", F.array_join("present", ",").alias("present"), F.array_join("missing", ",").alias("missing"), "compliant")


@query(ORACLES["worker_status"].replace("SELECT frame_no, track_id, coalesce(string_agg(cls, ',' ORDER BY o) FILTER (WHERE n > 0), '') AS present, coalesce", "SELECT frame_no AS frame, track_id, coalesce").replace(", count(*) FILTER (WHERE n = 0) = 0 AS compliant", ""))
def frame_statuses(spark, d):
    """The same statuses row by row, as a stream computes them."""
    workers, items = workers_and_items(spark, d)
    w = workers.groupBy("frame_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "track_id", "box"))), lambda x: F.struct(x["track_id"].alias("track_id"), x["box"].alias("box"))).alias("workers"))
    i = items.groupBy("frame_no").agg(F.collect_list(F.struct("cls", "box", "conf")).alias("items"))
    rows = frames.frame_statuses(w.join(i, "frame_no", "left").withColumn("items", F.coalesce("items", F.array().cast(dict(i.dtypes)["items"]))))
    return rows.withColumn("missing", F.array_join("missing", ","))


@query("""WITH e AS (SELECT user_id, event_type, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS zone FROM events), z AS (SELECT * FROM (VALUES ('a', 'click'), ('a', 'view'), ('b', 'signup'), ('b', 'purchase'), ('b', 'error')) z(zone, need)),
u AS (SELECT DISTINCT user_id, zone FROM e), m AS (SELECT u.user_id, u.zone, need FROM u JOIN z USING (zone) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = u.user_id AND e.event_type = need))
SELECT u.user_id, u.zone, coalesce(string_agg(need, ',' ORDER BY need), '') AS missing, count(need) = 0 AS compliant FROM u LEFT JOIN m ON u.user_id = m.user_id GROUP BY 1, 2""")
def zone_status(spark, d):
    worn = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("present")).withColumn("zone", F.when(F.col("user_id") % 2 == 0, "a").otherwise("b"))
    zones = spark.createDataFrame([("a", ["click", "view"]), ("b", ["signup", "purchase", "error"])], "zone string, required array<string>")
    return compliance.zone_status(worn, zones).select("user_id", "zone", F.array_join(F.array_sort("missing"), ",").alias("missing"), "compliant")


@query(f"""WITH w AS ({duck(WORKERS)}), i AS ({duck(ITEMS).replace('0.5D', '0.5')}), h AS (SELECT * FROM i WHERE cls = 'helmet'),
s AS (SELECT h.frame_no, item AS head, track_id, greatest(least(w.x2, h.x2) - greatest(w.x1, h.x1), 0) * greatest(least(w.y2, h.y2) - greatest(w.y1, h.y1), 0) / ((h.x2 - h.x1) * (h.y2 - h.y1)) AS share FROM h JOIN w ON h.frame_no = w.frame_no)
SELECT frame_no, head, track_id FROM (SELECT *, row_number() OVER (PARTITION BY frame_no, head ORDER BY share DESC, track_id) AS rn FROM s) WHERE rn = 1 AND share >= 0.5""")
def head_assignment(spark, d):
    workers, items = workers_and_items(spark, d)
    return compliance.assign_heads(workers, items.where("cls = 'helmet'").withColumnRenamed("item", "idx"), 0.5)


@query(f"""WITH w AS ({duck(WORKERS)}), i AS ({duck(ITEMS).replace('0.5D', '0.5')}), s AS (SELECT w.frame_no, track_id, greatest(least(w.x2, i.x2) - greatest(w.x1, i.x1), 0) * greatest(least(w.y2, i.y2) - greatest(w.y1, i.y1), 0) AS c FROM w JOIN i ON i.frame_no = w.frame_no AND cls = 'vest')
SELECT frame_no, track_id FROM w WHERE (frame_no, track_id) NOT IN (SELECT (frame_no, track_id) FROM s WHERE c / (16000 + 400 - c) >= 0.02)""")
def people_without_vest(spark, d):
    workers, items = workers_and_items(spark, d)
    return compliance.uncovered(workers, items.where("cls = 'vest'"), 0.02).select("frame_no", "track_id")


@query("SELECT c_custkey, -(((c_custkey % 40) << 20) + c_custkey + 1) AS track FROM customer")
def fallback_tracks(spark, d):
    return table(spark, d, "customer").withColumn("frame", F.col("c_custkey") % 40).select("c_custkey", gate.fallback_track("frame", "c_custkey").alias("track"))


@query(f"WITH b AS ({D_BOXES}) SELECT CASE cls5 WHEN 0 THEN 'smoke' WHEN 1 THEN 'fire' END AS name, count(*) AS boxes FROM b WHERE cls5 < 2 GROUP BY 1")
def named_classes(spark, d):
    from ..functions.parameters import parse_class_map, require_classes

    names = parse_class_map("0:smoke,1:fire")
    require_classes(names.values(), ["fire", "smoke"])
    rows = boxes(spark, d).join(F.broadcast(spark.createDataFrame(list(names.items()), "cls5 long, name string")), "cls5")
    return rows.groupBy("name").agg(F.count("*").alias("boxes"))


D_GATE = """WITH e AS (SELECT *, event_type = 'error' AS bad FROM events), r AS (SELECT *, CASE WHEN bad THEN sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER w ELSE sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER w END AS run FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, bad, run ORDER BY ts, event_id) AS rl FROM r), p AS (SELECT *, sum(CASE WHEN NOT bad AND rl = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS ep FROM n),
a AS (SELECT *, row_number() OVER (PARTITION BY user_id, ep ORDER BY ts, event_id) AS k FROM p WHERE bad AND rl >= 2)
SELECT user_id, event_id FROM a WHERE k = 1"""


@query(D_GATE)
def persistent_violations(spark, d):
    rows = table(spark, d, "events").withColumn("bad", F.col("event_type") == "error")
    return compliance.persistent(rows, "user_id", ["ts", "event_id"], "bad", confirm=2, clear=2).select("user_id", "event_id")


@query(D_GATE)
def persistent_violations_stream(spark, d):
    """The same alerts from a stateful stream; its frames are the times in microseconds, made unique by the event's number."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = table(spark, d, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    statuses = rows.select((micros * 1000 + F.col("event_id") % 1000).alias("order"), F.col("event_id"), F.col("user_id").alias("track_id"), F.when(F.col("event_type") == "error", F.array(F.lit("error"))).otherwise(F.array().cast("array<string>")).alias("missing"))
    out = new_folder(spark, "gate-events")
    events = gate.alerts(statuses.withColumn("frame", F.col("order")), confirm=2, clear=2)
    events.writeStream.format("parquet").option("checkpointLocation", new_folder(spark, "gate-checkpoint")).trigger(availableNow=True).start(out).awaitTermination()
    found = spark.read.schema(gate.EVENTS).parquet(out)
    key = table(spark, d, "events").select("user_id", "event_id", (micros * 1000 + F.col("event_id") % 1000).alias("frame"))
    return found.select(F.col("track_id").alias("user_id"), "frame").join(key, ["user_id", "frame"]).select("user_id", "event_id")


@query(f"WITH g AS ({D_BOXES}) SELECT count(*) AS boxes, count(*) FILTER (WHERE xc >= 0.25 AND xc <= 0.75 AND yc >= 0.25 AND yc <= 0.75) AS central FROM g")
def expanded_containment(spark, d):
    area = F.struct(*(F.lit(v).alias(n) for n, v in (("x1", 0.375), ("y1", 0.375), ("x2", 0.625), ("y2", 0.625))))
    point = F.struct(F.col("xc").alias("x"), F.col("yc").alias("y"))
    return boxes(spark, d).agg(F.count("*").alias("boxes"), F.count_if(S.contains(area, point, 0.5)).alias("central"))


# Order, limits, samples

D_SEED = "md5('{0}|' || {1})"


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def first_rows(spark, d):
    return ranking.first_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 50)


@query("SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 3")
def capped_rows(spark, d):
    return ranking.capped(table(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey")


@query("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS k, greatest(1, count(*) OVER () // 12) AS step FROM orders WHERE o_totalprice > 50000) SELECT o_orderkey FROM r WHERE k % step = 0 AND k // step < 12")
def stride_sample(spark, d):
    rows = table(spark, d, "orders").where("o_totalprice > 50000")
    return ranking.stride_sample(rows, [-F.col("o_totalprice"), F.col("o_orderkey")], 12).select("o_orderkey")


@query(f"""WITH b AS ({D_BOXES}), m AS (SELECT image, cls, w * h AS a, row_number() OVER (PARTITION BY image, cls ORDER BY w * h) AS rn, count(*) OVER (PARTITION BY image, cls) AS n FROM b),
u AS (SELECT image, coalesce(max(a) FILTER (WHERE cls = 0), 0) AS first, coalesce(max(a) FILTER (WHERE cls = 1), 0) AS second FROM m WHERE rn = n // 2 + 1 GROUP BY image),
r AS (SELECT image, CASE WHEN second > 0 THEN least(first, second) ELSE first END AS area FROM u), k AS (SELECT *, row_number() OVER (ORDER BY area DESC, image) - 1 AS k, greatest(1, count(*) OVER () // 20) AS step FROM r WHERE area > 0.02)
SELECT image, round(area, 8) AS area FROM k WHERE k % step = 0 AND k // step < 20""")
def area_sample(spark, d):
    medians = audit.upper_median(boxes(spark, d).withColumn("a", F.col("w") * F.col("h")), ["image", "cls"], "a")
    of = lambda c: F.coalesce(F.max(F.when(F.col("cls") == c, F.col("upper_median"))), F.lit(0.0))
    areas = medians.groupBy("image").agg(of(0).alias("first"), of(1).alias("second"))
    return ranking.area_sample(areas, "image", 20).select("image", F.round("area", 8).alias("area"))


@query(f"SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {D_SEED.format(11, 'c_custkey')}, c_custkey) AS rn FROM customer) WHERE rn <= 5")
def seeded_sample(spark, d):
    return ranking.seeded_sample(table(spark, d, "customer"), ["c_mktsegment"], "c_custkey", 5, 11).select("c_mktsegment", "c_custkey")


@query(f"SELECT p_partkey, CASE WHEN rn <= 5 THEN 'warm_up' ELSE 'timed' END AS role FROM (SELECT *, row_number() OVER (ORDER BY {D_SEED.format(22, 'p_partkey')}, p_partkey) AS rn FROM part) WHERE rn <= 35")
def warm_up_and_timed(spark, d):
    return ranking.warm_up_and_timed(table(spark, d, "part"), "p_partkey", 5, 30, 22).select("p_partkey", "role")


@query(f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {D_SEED.format(42, 'doc_id')}, doc_id) AS rn, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN rn <= greatest(1, round_even(n * 0.6, 0)) THEN 'train' WHEN rn <= greatest(1, round_even(n * 0.6, 0)) + greatest(1, round_even(n * 0.3, 0)) THEN 'val' ELSE 'test' END AS split FROM r""")
def ratio_split(spark, d):
    return ranking.ratio_split(table(spark, d, "documents").select("doc_id"), "doc_id", "6:3:1").select("doc_id", "split")


@query("SELECT CASE l_shipmode WHEN 'valid' THEN 'val' ELSE l_shipmode END AS split, count(*) AS n FROM (SELECT CASE l_linenumber % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'valid' WHEN 2 THEN 'val' ELSE 'test' END AS l_shipmode FROM lineitem) GROUP BY 1")
def split_aliases(spark, d):
    name = F.when(F.col("l_linenumber") % 4 == 0, "train").when(F.col("l_linenumber") % 4 == 1, "valid").when(F.col("l_linenumber") % 4 == 2, "val").otherwise("test")
    return table(spark, d, "lineitem").select(quarantine.split_name(name).alias("split")).groupBy("split").agg(F.count("*").alias("n"))


# Whole plans


@query(f"""WITH {D_PAIRS.format(t=NEAR)}, {D_PARSED}, lab AS (SELECT DISTINCT cast(stem AS bigint) AS id FROM l), i AS (SELECT id, {D_SPLIT_ID} AS split FROM b),
w AS (SELECT i.* FROM i JOIN lab USING (id)), e AS (SELECT a, b, d FROM p UNION ALL SELECT b, a, d FROM p), n AS (SELECT e.a, min(e.b) AS kept FROM e JOIN w x ON e.a = x.id JOIN w y ON e.b = y.id
WHERE {D_PRIORITY.format('e.a')} < {D_PRIORITY.format('e.b')} GROUP BY e.a),
bad AS (SELECT cast(stem AS bigint) AS id, count(*) AS c FROM v WHERE n_fields > 0 AND (n_fields <> 5 OR NOT numeric OR NOT known OR bad_centre OR bad_size) GROUP BY 1)
SELECT 'near_duplicate' AS type, cast(a AS varchar) AS source, cast(kept AS varchar) AS kept, {SPLIT.format(k='a')} AS split, cast(NULL AS bigint) AS count FROM n
UNION ALL SELECT 'invalid_label_lines_skipped', cast(id AS varchar), NULL, split, c FROM bad JOIN i USING (id)
UNION ALL SELECT 'missing_label', cast(id AS varchar), NULL, split, NULL FROM i WHERE id NOT IN (SELECT id FROM lab)""")
def preparation_manifest(spark, d):
    from .prepare import prepare

    images = hashes(spark, d, F.sha2(F.col("embedding").cast("string"), 256).alias("sha"))  # the vector is the content: equal signs alone are no exact copy
    rows = lines(spark, d).select(F.col("stem").cast("long").alias("id"), "line_no", "line")
    return prepare(images, rows, {0: "helmet", 1: "gloves"}, NEAR).manifest.select("type", "source", "kept", "split", "count")


@query(f"""WITH {D_PAIRS.format(t=NEAR)}, {D_PARSED}, i AS (SELECT id, {D_SPLIT_ID} AS split, 'label' || label AS path FROM b),
m AS (SELECT 'missing_labels' AS quantity, count(*) AS measured FROM i WHERE id NOT IN (SELECT cast(stem AS bigint) FROM l)
UNION ALL SELECT 'label_errors', sum(len(string_split(nullif({D_FINAL}, ''), ';'))) FROM v
UNION ALL SELECT 'degenerate_boxes', count(*) FILTER (WHERE {D_DEGENERATE}) FROM v
UNION ALL SELECT 'path_collisions', count(*) FROM (SELECT path FROM i GROUP BY path HAVING count(*) > 1)
UNION ALL SELECT 'crossing_pairs', count(*) FROM p WHERE ({SPLIT.format(k='a')}) <> ({SPLIT.format(k='b')})
UNION ALL SELECT 'credential_files', count(*) FILTER (WHERE regexp_matches(text, '{D_CREDENTIALS}')) FROM documents
UNION ALL SELECT 'unexpected_classes', count(DISTINCT cls) FILTER (WHERE cls NOT IN (0, 1)) FROM v WHERE n_fields > 0)
SELECT quantity, cast(CASE WHEN quantity = 'degenerate_boxes' THEN measured ELSE 0 END AS bigint) AS expected, cast(measured AS bigint) AS measured,
cast(CASE WHEN quantity = 'degenerate_boxes' THEN 0 ELSE measured END AS bigint) AS difference, quantity = 'degenerate_boxes' OR measured = 0 AS ok FROM m""")
def final_validation(spark, d):
    from .validate import checks

    rows = hashes(spark, d).withColumn("path", F.concat(F.lit("label"), F.col("label").cast("string")))
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("name"), "text")
    own = lines(spark, d).select(F.col("stem").cast("long").alias("id"), "line_no", "line")
    return checks(rows, own, [0, 1], NEAR, texts)
