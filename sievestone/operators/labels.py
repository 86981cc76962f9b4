"""Label lines: one parser with the strictness modes that stages of a dataset's life ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars

MODES = ("audit", "qa", "final", "prepare", "profile", "transfer", "scan")
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
FIELDS = ("xc", "yc", "w", "h")


def parse(lines: DataFrame) -> DataFrame:
    """Adds fields (array), n_fields, numeric, cls (INT) and xc, yc, w, h (DOUBLE) to rows with a line.

    The class must be written as an integer: `1.0` is not one.
    """
    rows = lines.withColumn("fields", F.regexp_extract_all("line", F.lit(r"\S+"), F.lit(0)))
    get = lambda k: F.get("fields", F.lit(k))
    whole = F.regexp_like(get(0), F.lit(r"^[+-]?[0-9]+$"))
    rows = rows.withColumns({"n_fields": F.size("fields"), "_whole": F.coalesce(whole, F.lit(False))})
    for k, name in enumerate(FIELDS, 1):
        rows = rows.withColumn(name, F.when(F.regexp_like(get(k), F.lit(NUMBER)), get(k).try_cast("double")))
    numeric = F.col("_whole")
    for name in FIELDS:
        numeric = numeric & F.col(name).isNotNull()  # what has the form of a number is one
    return rows.withColumns({"numeric": numeric, "cls": F.when(F.col("_whole"), get(0).try_cast("int"))}).drop("_whole")


def outside(name: str, low_open: bool) -> Column:
    c = F.col(name)
    return ((c <= 0) if low_open else (c < 0)) | (c > 1)


def validate(lines: DataFrame, mode: str, classes: list[int], keep: tuple[str, ...] = ("stem", "line_no")) -> DataFrame:
    """keep, cls, xc, yc, w, h, errors (array of codes), is_box (counts as a box), degenerate.

    audit keeps boxes with a wrong class or range and names each field; qa names the first failure; final
    treats an empty size as degenerate and not as an error; prepare has one code; profile and scan take
    what parses; transfer looks at the first token only. Blank lines: audit, prepare, transfer and
    profile skip them, qa and final take an inner one for a line with too few fields.
    """
    if mode not in MODES:
        raise ValueError(mode)
    # A line without fields is told by its text: a filter on their number would take each line apart once more.
    rows = parse(lines if mode in ("qa", "final") else lines.where(F.regexp_like("line", F.lit(r"\S"))))
    five, known = F.col("n_fields") == 5, F.col("cls").isin(*classes)
    good = five & F.col("numeric")
    centre, size = outside("xc", False) | outside("yc", False), outside("w", True) | outside("h", True)
    degenerate = good & ((F.col("w") <= 0) | (F.col("h") <= 0))
    cls_code = lambda pattern: F.format_string(pattern, F.col("cls"))
    one = lambda c: F.when(c.isNull(), nothing).otherwise(F.array(c))
    nothing = F.array().cast("array<string>")
    if mode == "audit":
        ranges = F.array_compact(F.array(F.when(~known, cls_code("bad_class:%d")), *(F.when(outside(n, n in "wh"), F.lit(f"{n}_out_of_range")) for n in FIELDS)))
        errors = F.when(good & known & ~centre & ~size, nothing).when(~five, F.array(F.format_string("bad_field_count:%d", F.col("n_fields")))).when(~F.col("numeric"), F.array(F.lit("non_numeric"))).otherwise(ranges)
        is_box = good
    elif mode == "qa":
        first = F.when(~five, "not_5_fields").when(~F.col("numeric"), "non_numeric").when(~known, cls_code("class_id_%d_unexpected")).when(centre, "center_out_of_range").when(size, "size_out_of_range")
        errors, is_box = one(first), first.isNull()
    elif mode == "final":
        first = F.when(~five, "not_5_fields").when(~F.col("numeric"), "non_numeric")
        more = F.array_compact(F.array(F.when(~known, cls_code("class_%d_not_in_mapping")), F.when(centre, F.lit("coord_range"))))
        errors, is_box = F.when(first.isNotNull(), one(first)).otherwise(more), F.col("n_fields") > 0
    elif mode == "prepare":
        bad = ~good | ~known | centre | size
        errors, is_box = F.when(bad, F.array(F.lit("bad"))).otherwise(nothing), ~bad
    elif mode == "profile":
        errors = F.when(five & F.col("cls").isNull(), F.array(F.raise_error(F.lit("class is no integer")))).otherwise(nothing)
        is_box = five
    elif mode == "transfer":
        errors, is_box = F.when(F.col("cls").isNull(), F.array(F.lit("parse_error"))).otherwise(nothing), F.col("cls").isNotNull()
    else:
        fails = (F.col("n_fields") < 5) | ~F.col("numeric")
        errors, is_box = F.when(fails, F.array(F.raise_error(F.lit("label line can't be read")))).otherwise(nothing), F.lit(True)
    return rows.select(*keep, "cls", *FIELDS, errors.alias("errors"), F.coalesce(is_box, F.lit(False)).alias("is_box"), F.coalesce(degenerate, F.lit(False)).alias("degenerate"))


def first_tokens(lines: DataFrame, *keys: str) -> DataFrame:
    """keys, classes, parse_error: a file's classes by first token, up to the first that is no integer."""
    rows = validate(lines, "transfer", [], (*keys, "line_no"))
    broken = F.min(F.when(~F.col("is_box"), F.col("line_no")))
    first = rows.groupBy(*keys).agg(broken.alias("broken"), F.collect_list(F.struct("line_no", "cls")).alias("seen"))
    before = F.filter("seen", lambda x: F.col("broken").isNull() | (x["line_no"] < F.col("broken")))
    return first.select(*keys, F.array_sort(F.array_distinct(F.transform(before, lambda x: x["cls"]))).alias("classes"), F.col("broken").isNotNull().alias("parse_error"))


def remap(boxes: DataFrame, names: dict[int, str], targets: dict[str, int] = scalars.TARGET_CLASSES) -> DataFrame:
    """Boxes of target classes under their target ids; others are dropped. names and targets are parameters of a few entries."""
    pairs = {k: targets[n] for k, v in names.items() if (n := normal(v)) in targets}
    table = F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)) if pairs else F.create_map().cast("map<int,int>")
    return boxes.withColumn("cls", F.element_at(table, F.col("cls"))).where("cls IS NOT NULL")


def normal(name: str) -> str:
    return " ".join(name.strip().lower().replace("_", " ").replace("-", " ").split())


def profiles(boxes: DataFrame, names: dict[tuple[int, ...], str], *keys: str) -> DataFrame:
    """keys, profile: the name of the set of classes, or `classes(..)`. Rows without a class give the empty set."""
    sets = boxes.groupBy(*keys).agg(F.array_sort(F.collect_set("cls")).alias("classes"))
    text = F.concat(F.lit("classes("), F.array_join(F.col("classes").cast("array<string>"), ","), F.lit(")"))
    named = text
    for classes, name in names.items():
        named = F.when(F.col("classes") == F.array(*map(F.lit, classes)).cast("array<int>"), F.lit(name)).otherwise(named)
    return sets.select(*keys, "classes", named.alias("profile"))
