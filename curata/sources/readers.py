"""Typed scans: CSV, label files, COCO and CVAT documents, file and image inventories."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from curata.functions import labels, strings
from curata.operators import validation as va

COCO = (
    "images array<struct<id:bigint,file_name:string,width:int,height:int>>, categories array<struct<id:int,name:string>>, "
    "annotations array<struct<id:bigint,image_id:bigint,category_id:int,bbox:array<double>,area:double,segmentation:string>>"
)
CVAT = "_name string, _width int, _height int, box array<struct<_label:string,_xtl:double,_ytl:double,_xbr:double,_ybr:double,_rotation:double>>"
#: What ends a line: more than a line feed.
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
IMAGES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")


def root_from(name: str, default: str) -> str:
    """A folder that the environment names, without a trailing slash."""
    return (os.environ.get(name) or default).rstrip("/")


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """A header, a fixed schema, and an error for a malformed row or a missing required column; a byte order mark is no part of the header."""
    df = spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=False)
    missing = set(required or []) - set(df.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    return df


def read_csv_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The same, or no rows where there is no file."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_strings(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """All cells as text by the names of the header, which must hold the required ones."""
    df = spark.read.csv(path, header=True, inferSchema=False, mode="FAILFAST")
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    return df.na.fill("")


def read_tables(spark: SparkSession, root: str, tables: Mapping[str, Sequence[str]], documents: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Several CSV tables with their required columns, and JSON documents, by name."""
    out = {name: read_strings(spark, f"{root}/{name}.csv", columns) for name, columns in tables.items()}
    return out | {name: spark.read.json(f"{root}/{name}.json", multiLine=True) for name in documents}


def read_reviews(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A manifest of reviews; one without any row is an error, as its columns cannot be told."""
    return va.require_rows(read_strings(spark, path, required), f"reviews in {path}")


def read_audit(spark: SparkSession, path: str, flags: Sequence[str], label: str, allowed: Sequence[str], key: str, files: DataFrame | None = None) -> DataFrame:
    """An audited manifest: ``true`` or ``false`` in the flags, known labels, unique keys and, if given, existing files; else an error."""
    rows = read_strings(spark, path, [key, label, *flags])
    rules = {f"not_boolean:{f}": labels.strict_bool(F.col(f)).isNull() for f in flags} | {"unknown_label": ~F.col(label).isin(*allowed)}
    found = va.violations(rows, key, rules)
    found = found.unionAll(rows.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated").alias("rule"), "key"))
    if files is not None:
        found = found.unionAll(rows.join(files, "relative_path", "left_anti").select(F.lit("no_file").alias("rule"), F.col(key).alias("key")))
    va.require(found, f"audit {path}")
    return rows.withColumns({f: labels.strict_bool(F.col(f)) for f in flags})


def read_split(spark: SparkSession, path: str, schema: str | T.StructType, split: str) -> DataFrame:
    """The rows of one split, filtered as they are read; none is an error."""
    return va.require_rows(read_csv(spark, path, schema).where(F.col("split") == split), f"rows of split {split} in {path}")


def list_files(spark: SparkSession, path: str, extensions: Sequence[str] = IMAGES) -> DataFrame:
    """``path, length, stem`` of files with one of the extensions, below a folder, in order; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    wanted = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*extensions)
    return files.where(wanted).withColumn("stem", F.lower(strings.stem(F.col("path")))).orderBy(F.lower("path"))


def paired_files(spark: SparkSession, images: str, texts: str) -> DataFrame:
    """``stem, image, label, problem`` of images and label files by their names in lower case, full outer."""
    left = list_files(spark, images).select("stem", F.col("path").alias("image"))
    right = list_files(spark, texts, ("txt",)).select("stem", F.col("path").alias("label"))
    both = left.join(right, "stem", "full")
    return both.withColumn("problem", F.when(F.col("label").isNull(), "image_without_label").when(F.col("image").isNull(), "label_without_image"))


def label_texts(spark: SparkSession, path: str) -> DataFrame:
    """``file, text, error`` of whole files; bytes that are no UTF-8 are an error and give no text."""
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("content").cast("string").alias("text"))
    good = F.is_valid_utf8("text")
    return raw.select("file", F.when(good, F.regexp_replace("text", "^\ufeff", "")).alias("text"), F.when(~good, "not_utf8").alias("error"))


def lines_of(text: Column) -> Column:
    """The lines of a text; a line end at the end of the text begins no further line, and an empty text has none."""
    whole = F.regexp_replace(text, f"(?:{LINE_ENDS})\\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(whole, LINE_ENDS))


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_number, raw_line`` of every line of text files, blank ones too."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = text.select("file", F.posexplode(lines_of(F.col("value"))).alias("pos", "raw_line"))
    return lines.select("file", (F.col("pos") + 1).alias("line_number"), "raw_line")


def instance_index(lines: DataFrame) -> DataFrame:
    """``lines`` and ``instance``: the number of a line among those of its file that are not blank."""
    filled = F.when(F.trim("raw_line") != "", 1).otherwise(0)
    own = Window.partitionBy("file").orderBy("line_number").rowsBetween(Window.unboundedPreceding, 0)  # the lines of one file
    return lines.withColumn("instance", F.when(F.trim("raw_line") != "", F.sum(filled).over(own)))


def valid_polygons(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``file, line_number, class_id, points`` of lines that are valid polygons; with ``strict`` any other line is an error."""
    parsed = lines.withColumn("p", labels.parse_polygon_line(F.col("raw_line")))
    if strict:
        va.require(parsed.where("not p.valid").select("file", "line_number", "p.issues"), "invalid label lines")
    return parsed.where("p.valid").select("file", "line_number", "p.class_id", "p.points")


def nth_line(text: Column, n: Column) -> Column:
    """The n-th line that is not blank, or null."""
    return F.when(n >= 1, F.get(F.filter(lines_of(text), lambda s: F.trim(s) != ""), n - 1))


def read_coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The images, categories and annotations of COCO documents; a segmentation stays JSON text of any shape.

    ``index`` has annotations with their image and category, and how many
    images have that file name, so that ambiguous names can be told apart.
    """
    doc = spark.read.schema(COCO).json(path, multiLine=True)
    out = {c: doc.select(F.inline(c)) for c in ("images", "categories", "annotations")}
    names = out["images"].groupBy("file_name").agg(F.count("*").alias("images_of_name"))
    images = out["images"].join(names, "file_name").select(F.col("id").alias("image_id"), "file_name", "width", "height", "images_of_name")
    categories = out["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    out["index"] = images.join(out["annotations"], "image_id", "left").join(categories, "category_id", "left")
    return out


def segmentation_detail(segmentation: Column) -> Column:
    """``kind`` (polygon, rle or missing), ``components`` and ``outline`` (of a single component) of a segmentation's JSON text."""
    text = F.trim(F.coalesce(segmentation, F.lit("")))
    parts = F.when(text.startswith("[["), F.from_json(text, "array<array<double>>"))
    kind = F.when(F.size(F.coalesce(parts, F.array().cast("array<array<double>>"))) > 0, "polygon").when(text.startswith("{"), "rle").otherwise("missing")
    return F.struct(kind.alias("kind"), F.coalesce(F.size(parts), F.lit(0)).alias("components"), F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).alias("outline"))


def read_cvat(spark: SparkSession, path: str) -> DataFrame:
    """One row per box of CVAT image elements; images without boxes have one row of nulls."""
    images = spark.read.schema(CVAT).format("xml").options(rowTag="image", attributePrefix="_").load(path)
    return images.select(F.col("_name").alias("name"), F.col("_width").alias("width"), F.col("_height").alias("height"), F.inline_outer("box"))


def yaml_names(text: Column) -> Column:
    """The entries of a one-line ``names: [a, b]``, without quotes."""
    inner = F.regexp_extract(text, r"(?m)^names:\s*\[([^\]]*)\]", 1)
    return F.filter(F.transform(F.split(inner, ","), lambda s: F.trim(F.regexp_replace(s, "['\"]", ""))), lambda s: s != "")


def licence_name(text: Column) -> Column:
    """What a readme names after ``license:``, or null."""
    found = F.trim(F.regexp_extract(text, r"(?im)^\W*licen[sc]e\W*:\s*(.+)$", 1))
    return F.when(found != "", found)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length, sha256`` and whether a file begins and ends as a JPEG does."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    jpeg = (F.hex(F.substring("content", 1, 2)) == "FFD8") & (F.hex(F.substring("content", -2, 2)) == "FFD9")
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), jpeg.alias("is_whole_jpeg"))


def inventory_totals(files: DataFrame) -> DataFrame:
    """Files, bytes and broken JPEGs of ``read_files``."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count_if(~F.col("is_whole_jpeg")).alias("not_whole"))


def image_header(data: bytes) -> tuple[str | None, int | None, int | None, str | None]:
    """Format, upright width and height from the first bytes of a PNG, GIF, BMP or JPEG, or what is wrong."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return ("png", *struct.unpack(">II", data[16:24]), None)
        if data[:4] == b"GIF8":
            return ("gif", *struct.unpack("<HH", data[6:10]), None)
        if data[:2] == b"BM":
            width, height = struct.unpack("<ii", data[18:26])
            return "bmp", width, abs(height), None
        if data[:2] != b"\xff\xd8":
            return None, None, None, "unknown_format"
        at, turned = 2, False
        while True:
            marker, size = struct.unpack(">HH", data[at : at + 4])
            if marker >> 8 != 0xFF:
                return "jpeg", None, None, "broken_marker"
            if marker == 0xFFE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                turned = _exif_turned(data[at + 10 : at + 2 + size])
            if 0xFFC0 <= marker <= 0xFFCF and marker not in (0xFFC4, 0xFFC8, 0xFFCC):
                height, width = struct.unpack(">HH", data[at + 5 : at + 9])
                return ("jpeg", height, width, None) if turned else ("jpeg", width, height, None)
            at += 2 + size
    except struct.error:
        return None, None, None, "truncated"


def _exif_turned(tiff: bytes) -> bool:
    """Whether the orientation of an EXIF block swaps the sides."""
    order = "<" if tiff[:2] == b"II" else ">"
    (first,) = struct.unpack(order + "I", tiff[4:8])
    (entries,) = struct.unpack(order + "H", tiff[first : first + 2])
    for k in range(entries):
        at = first + 2 + 12 * k
        tag, _, _, value = struct.unpack(order + "HHIH", tiff[at : at + 10])
        if tag == 0x0112:
            return 5 <= value <= 8
    return False


def read_image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, format, width, height, error`` of image files; errors are rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(zip(*(image_header(x.as_py()) for x in b.column("content")))) or [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("length"), *(pa.array(f, k) for f, k in zip(found, kinds))], ["path", "length", "format", "width", "height", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.substring("content", 1, 1 << 16).alias("content"))
    return files.mapInArrow(run, "path string, length long, format string, width int, height int, error string")
