"""Model answers with bounding boxes: F25-F27 parsing and repair, P8 coordinate
predicate, F28 denormalisation, F29-F30 padding and clamping, F31 fit to the
output canvas, F32 output names, S14 image inventory, A8 success counts.

Boxes are on a 0..1000 scale; image width and height come with each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.functions.text import try_double

# Accepted image extensions, canvas size, default label,
# padding shares, crop percentages.
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp"]
CANVAS_W, CANVAS_H = 1080, 1350
DEFAULT_LABEL = "Object"
SCALE = 1000.0
CROP_PERCENT_CLI = 100
CROP_PERCENT_FN = 92

# Coordinates are read as text and converted like Python's float() (a numeric
# string such as "12" is accepted in the single-box path).
BOX_SCHEMA = "xmin string, ymin string, xmax string, ymax string, _corrupt_record string"
OBJECTS_SCHEMA = "array<struct<xmin:double,ymin:double,xmax:double,ymax:double,label:string>>"
JSON_OPTS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"}
KEYS = ["xmin", "ymin", "xmax", "ymax"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_json(text) -> Column:
    """the first ``{...}`` (shortest) if any, else the whole text; then
    ``[n]`` -> ``n``."""
    t = _c(text)
    first = F.regexp_extract(t, r"(?s)\{.*?\}", 0)
    s = F.when(t.rlike(r"(?s)\{.*?\}"), first).otherwise(t)
    return F.regexp_replace(s, r"\[\s*(\d+)\s*\]", "$1")


def with_box(df: DataFrame, text_col: str, name: str = "box") -> DataFrame:
    """F25 + F26 + P8: adds struct ``name`` = (xmin, ymin, xmax, ymax, method).
    JSON first; when it is malformed, four regex coordinates (all or none).
    Missing coordinates give a null box (P8). Staged so the repair and the JSON
    parse run once per row."""
    d = df.withColumn("_rep", repair_json(F.col(text_col)))
    rep = F.col("_rep")
    d = d.withColumn("_j", F.from_json(rep, BOX_SCHEMA, JSON_OPTS)).withColumn(
        "_rx", F.array(*[F.regexp_extract(rep, rf'"{k}":\s*\[?(\d+)', 1) for k in KEYS]))
    j, rx = F.col("_j"), F.col("_rx")
    malformed = j["_corrupt_record"].isNotNull()
    rx_all = F.forall(rx, lambda v: F.length(v) > 0)
    num = {k: try_double(j[k]) for k in KEYS}
    # every key present with a value float() accepts (missing, null or
    # non-numeric values fail, without falling back to the regexes)
    json_all = (~malformed) & num["xmin"].isNotNull() & num["ymin"].isNotNull() & num["xmax"].isNotNull() \
        & num["ymax"].isNotNull()
    d = d.withColumn("_m", F.when(json_all, F.lit("json")).when(malformed & rx_all, F.lit("regex")))
    m = F.col("_m")
    vals = [F.when(m == "json", try_double(j[k])).when(m == "regex", rx[i].cast("double")) for i, k in enumerate(KEYS)]
    return d.withColumn(name, F.when(m.isNotNull(), F.struct(*[v.alias(k) for v, k in zip(vals, KEYS)], m.alias("method")))) \
        .drop("_rep", "_j", "_rx", "_m")


def parse_objects(text) -> Column:
    """a JSON array of boxes (``[n]`` repaired), default label ``Object``;
    objects without numeric coordinates are null, so that the others keep their
    place in the whole list. Null when not an array."""
    rep = F.regexp_replace(_c(text), r"\[\s*(\d+)\s*\]", "$1")
    arr = F.from_json(rep, OBJECTS_SCHEMA, {"allowSingleQuotes": "false"})
    withlab = F.transform(arr, lambda o: o.withField("label", F.coalesce(o["label"], F.lit(DEFAULT_LABEL))))
    return F.transform(withlab, lambda o: F.when(o["xmin"].isNotNull() & o["ymin"].isNotNull()
                                                 & o["xmax"].isNotNull() & o["ymax"].isNotNull(), o))


# Whole numbers up to this are exact in a double; pixels beyond are taken as this far out.
FAR = 1 << 52


def _trunc(x: Column) -> Column:
    """Towards zero as bigint, numbers of any size (``FAR`` at most)."""
    return F.when(x.isNotNull(), F.greatest(F.least(x.cast("double"), F.lit(float(FAR))), F.lit(float(-FAR)))).cast("bigint")


def _pixel(x: Column) -> Column:
    """A bigint as int, the nearest one where it doesn't fit."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit((1 << 31) - 1)), F.lit(-(1 << 31)))).cast("int")


def to_pixels(box: Column, width: Column, height: Column) -> Column:
    """0..1000 -> pixels, truncating. Pixels are bigints, so that a coordinate far
    outside the image stays outside and is clamped by the padding."""
    px = lambda v, size: F.when(~F.isnan(v), _trunc(v / F.lit(SCALE) * size))
    return F.struct(px(box["xmin"], width).alias("xmin"), px(box["ymin"], height).alias("ymin"),
                    px(box["xmax"], width).alias("xmax"), px(box["ymax"], height).alias("ymax"))


def pad_main(px: Column, width: Column, height: Column, crop: bool, crop_percent: int = CROP_PERCENT_FN) -> Column:
    """5% of the width on both sides, 5% of the box height on top; bottom
    +10% of the box height (drawing) or cut at ``crop_percent`` of it (cropping)."""
    bh = px["ymax"] - px["ymin"]
    hpad = _trunc(width * 0.05)
    top = _trunc(bh * 0.05)
    bottom = (F.least(height.cast("bigint"), px["ymin"] + _trunc(bh * crop_percent / 100.0)) if crop
              else F.least(height.cast("bigint"), px["ymax"] + _trunc(bh * 0.10)))
    return F.struct(_pixel(F.greatest(F.lit(0).cast("bigint"), px["xmin"] - hpad)).alias("xmin"),
                    _pixel(F.greatest(F.lit(0).cast("bigint"), px["ymin"] - top)).alias("ymin"),
                    _pixel(F.least(width.cast("bigint"), px["xmax"] + hpad)).alias("xmax"), _pixel(bottom).alias("ymax"))


def pad_objects(px: Column, width: Column, height: Column, crop: bool) -> Column:
    """3% of the width on both sides; 5% (crop) or 8% (draw) of the box height top and bottom."""
    bh = px["ymax"] - px["ymin"]
    hpad = _trunc(width * 0.03)
    vpad = _trunc(bh * (0.05 if crop else 0.08))
    return F.struct(_pixel(F.greatest(F.lit(0).cast("bigint"), px["xmin"] - hpad)).alias("xmin"),
                    _pixel(F.greatest(F.lit(0).cast("bigint"), px["ymin"] - vpad)).alias("ymin"),
                    _pixel(F.least(width.cast("bigint"), px["xmax"] + hpad)).alias("xmax"),
                    _pixel(F.least(height.cast("bigint"), px["ymax"] + vpad)).alias("ymax"))


def fit_canvas(width: Column, height: Column) -> Column:
    """size and offsets of an image fitted into the 1080x1350 canvas."""
    aspect = width / height
    wide = aspect > F.lit(CANVAS_W / CANVAS_H)
    nw = F.when(wide, F.lit(CANVAS_W)).otherwise(_pixel(_trunc(CANVAS_H * aspect)))
    nh = F.when(wide, _pixel(_trunc(CANVAS_W / aspect))).otherwise(F.lit(CANVAS_H))
    return F.struct(nw.alias("width"), nh.alias("height"),
                    F.floor((CANVAS_W - nw) / 2).cast("int").alias("x"), F.floor((CANVAS_H - nh) / 2).cast("int").alias("y"))


def _split_ext(name: Column):
    stem = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)
    ext = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    # a leading dot alone is not an extension (".hidden" has no extension)
    no_ext = stem == ""
    return F.when(no_ext, name).otherwise(stem), F.when(no_ext, F.lit("")).otherwise(ext)


def output_name(name: Column, crop: bool) -> Column:
    """F32: ``<stem>_cropped<ext>`` or ``<stem>_bbox<ext>``."""
    stem, ext = _split_ext(name)
    return F.concat(stem, F.lit("_cropped" if crop else "_bbox"), ext)


def object_name(name: Column, index: Column, label: Column) -> Column:
    """F32: ``<stem>_<i+1>_<label lower, spaces as _><ext>``."""
    stem, ext = _split_ext(name)
    return F.concat(stem, F.lit("_"), (index + 1).cast("string"), F.lit("_"),
                    F.replace(F.lower(label), F.lit(" "), F.lit("_")), ext)


def larger_name(name: Column) -> Column:
    stem, ext = _split_ext(name)
    return F.concat(stem, F.lit("_larger"), ext)


def is_image(path: Column) -> Column:
    """Not hidden and a known image extension, case-insensitive."""
    base = F.element_at(F.split(path, "/"), -1)
    _, ext = _split_ext(base)
    return ~base.startswith(".") & F.lower(ext).isin(IMAGE_EXTENSIONS)


def image_inventory(spark, root: str) -> DataFrame:
    """S14 over a folder: file listing only (no content read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    return files.filter(is_image(F.col("path")))


def outcome_counts(df: DataFrame, ok_col: str = "ok") -> DataFrame:
    """Successes and failures."""
    return df.agg(F.count_if(F.col(ok_col)).alias("success"), F.count_if(~F.col(ok_col)).alias("failure"))
