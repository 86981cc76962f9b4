"""Column expressions: names, paths, hashes, boxes and texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
#: Class names of the target schema, with their aliases, by normalised name.
TARGET_CLASSES = {"helmet": 0, "gloves": 1, "goggles": 2, "vest": 3, "safety vest": 3}
REQUIRED_ITEMS = ("helmet", "gloves", "goggles", "vest")
#: Where an item is expected inside a person's box, as shares of width and height.
ANCHORS = {"helmet": (0.50, 0.14), "goggles": (0.50, 0.26), "vest": (0.50, 0.52), "gloves": (0.50, 0.68)}
SPLIT_ALIASES = {"train": "train", "valid": "val", "val": "val", "test": "test"}
SPLIT_PRIORITY = {"test": 3, "val": 2, "train": 1}
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tif", ".tiff")
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv")
SECRET_SUFFIXES = (".env", ".key", ".pem")
CREDENTIALS = (
    r"(?i)(api[_-]?key|apikey|secret|password|token\s*[:=]|kaggle\.json|AKIA[0-9A-Z]{16}"
    r"|ghp_[A-Za-z0-9]{20,}|gho_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}"
    r"|sk-[A-Za-z0-9]{20,}|Bearer\s+[A-Za-z0-9._-]{20,})"
)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


# Names and paths


def normalise_name(c: Column) -> Column:
    """Trimmed, lower case, underscores and dashes as single spaces."""
    return F.trim(F.regexp_replace(F.translate(F.lower(c), "_-", "  "), r"\s+", " "))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def label_path(image_path: Column) -> Column:
    return F.regexp_replace(F.replace(image_path, F.lit("/images/"), F.lit("/labels/")), r"\.[^./]+$", ".txt")


def relocate(path: Column, root: str, name: str) -> Column:
    """The path below root, under name instead."""
    root = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(root)), F.concat(F.lit(name + "/"), F.substring(path, len(root) + 1, 1 << 30)))


def source_key(path: Column, strip_export_hash: bool = True) -> Column:
    """The stem, without the hash that an export appends to copies of one source."""
    return F.regexp_replace(stem(path), r"\.rf\.[0-9a-f]{32}$", "") if strip_export_hash else stem(path)


def series_key(path: Column, without: tuple[str, ...] = ("WEB",)) -> Column:
    """Struct of prefix and number for a stem of letters and digits; null for other stems and the prefixes left out."""
    prefix, number = (F.regexp_extract(stem(path), r"^([A-Za-z]+)([0-9]+)$", k) for k in (1, 2))
    return F.when((prefix != "") & ~prefix.isin(*without), F.struct(prefix.alias("prefix"), number.cast("long").alias("number")))


def source_kind(source: Column) -> Column:
    """webcam, image or video; anything else raises."""
    return (
        F.when(F.regexp_like(source, F.lit("^[0-9]+$")), "webcam")
        .when(suffix(source).isin(*IMAGE_SUFFIXES), "image")
        .when(suffix(source).isin(*VIDEO_SUFFIXES), "video")
        .otherwise(F.raise_error(F.concat(F.lit("unknown kind of source: "), source)))
    )


def mime_suffix(mime: Column) -> Column:
    return F.when(mime.contains("png"), ".png").when(mime.contains("gif"), ".gif").otherwise(".jpg")


# Texts


def strip_html(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", ""), r"\s+", " "))


def json_text(c: Column, path: str, default: str = "Unknown") -> Column:
    """A value of a JSON text; missing and empty ones give the default."""
    return F.coalesce(F.nullif(F.get_json_object(c, path), F.lit("")), F.lit(default))


def has_credentials(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(CREDENTIALS)), F.lit(False))


def is_secret_file(path: Column) -> Column:
    return suffix(path).isin(*SECRET_SUFFIXES) | F.endswith(path, F.lit("/kaggle.json"))


# Hashes


def pack_bits(bits: Column) -> Column:
    """64 booleans as a long, the first the highest bit."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: F.call_function("shiftleft", acc, F.lit(1)).bitwiseOR(b.cast("long")))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


# Boxes: structs are (xc, yc, w, h) for centres, (x1, y1, x2, y2) for corners


def corners(xc: Column, yc: Column, w: Column, h: Column) -> Column:
    return F.struct((xc - w / 2).alias("x1"), (yc - h / 2).alias("y1"), (xc + w / 2).alias("x2"), (yc + h / 2).alias("y2"))


def scaled(box: Column, width: Column, height: Column) -> Column:
    """Corners in pixels, cut to whole ones."""
    return F.struct(*((box[n] * s).cast("int").alias(n) for n, s in (("x1", width), ("y1", height), ("x2", width), ("y2", height))))


def centred(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, clamped: bool) -> Column:
    """A pixel box given by its corner and size, normalised by the image's size."""
    cut = (lambda c: clamp(c, 0.0, 1.0)) if clamped else (lambda c: c)
    return F.struct(cut((x + w / 2) / width).alias("xc"), cut((y + h / 2) / height).alias("yc"), cut(w / width).alias("w"), cut(h / height).alias("h"))


def centred_from_corners(box: Column, width: Column, height: Column, least: float = 0.001) -> Column:
    """Centres clamped to 0..1 and sizes to least..1."""
    return F.struct(
        clamp((box["x1"] + box["x2"]) / 2 / width, 0.0, 1.0).alias("xc"),
        clamp((box["y1"] + box["y2"]) / 2 / height, 0.0, 1.0).alias("yc"),
        clamp((box["x2"] - box["x1"]) / width, least, 1.0).alias("w"),
        clamp((box["y2"] - box["y1"]) / height, least, 1.0).alias("h"),
    )


def valid_size(box: Column) -> Column:
    return (box["w"] > 0) & (box["w"] <= 1) & (box["h"] > 0) & (box["h"] <= 1)


def label_line(cls: Column, xc: Column, yc: Column, w: Column, h: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", cls, xc, yc, w, h)


def whole_image_line(cls: Column) -> Column:
    return F.concat(cls.cast("string"), F.lit(" 0.5 0.5 1.0 1.0"))


def iou(a: Column, b: Column) -> Column:
    side = lambda low, high: F.greatest(F.least(a[high], b[high]) - F.greatest(a[low], b[low]), F.lit(0.0))
    area = lambda x: (x["x2"] - x["x1"]) * (x["y2"] - x["y1"])
    both = side("x1", "x2") * side("y1", "y2")
    return both / F.greatest(area(a) + area(b) - both, F.lit(1e-9))


def centre(box: Column) -> Column:
    return F.named_struct(F.lit("x"), (box["x1"] + box["x2"]) * 0.5, F.lit("y"), (box["y1"] + box["y2"]) * 0.5)


def contains(box: Column, point: Column, margin: float = 0.15) -> Column:
    """Whether a point lies in a box widened by a share of its sides; bounds included."""
    within = lambda v, low, high: (v >= box[low] - margin * (box[high] - box[low])) & (v <= box[high] + margin * (box[high] - box[low]))
    return within(point["x"], "x1", "x2") & within(point["y"], "y1", "y2")


def association_score(person: Column, item: Column, cls: Column, confidence: Column) -> Column:
    """How well an item's box fits a person's: inside it, near the usual place, detected with confidence."""
    at = centre(item)
    place = lambda k: reduce(lambda acc, n: F.when(cls == n, F.lit(ANCHORS[n][k])).otherwise(acc), ANCHORS, F.lit(0.5))
    across = (at["x"] - person["x1"]) / F.greatest(person["x2"] - person["x1"], F.lit(1.0)) - place(0)
    down = (at["y"] - person["y1"]) / F.greatest(person["y2"] - person["y1"], F.lit(1.0)) - place(1)
    weight_x = F.when(cls == "gloves", 0.15).otherwise(0.30)
    weight_y = F.when(cls.isin("helmet", "goggles"), 0.70).otherwise(0.55)
    distance = F.sqrt(weight_x * across * across + weight_y * down * down)
    near = F.greatest(F.lit(0.0), 1 - F.least(distance / 0.75, F.lit(1.0)))
    return F.when(contains(person, at, 0.20), 0.65).otherwise(0.0) + 0.35 * near + 0.05 * clamp(confidence, 0.0, 1.0)
