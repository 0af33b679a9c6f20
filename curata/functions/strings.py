"""Names, keys and reasons as Column expressions.

Case folding is ``lower``: names are taken to be ASCII, for which both agree.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: extensions that an export tool writes into a name before its own suffix.
EXPORT_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tif", "tiff", "webp")


def file_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """A file name without its last extension; a leading dot is part of the stem."""
    name = file_name(path)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def export_base(path: Column) -> Column:
    """The stem that a file had before it was exported as ``<stem>_<extension>.rf.<hash>``, else its own stem."""
    own = stem(path)
    pattern = "(?is)^(.+?)_(?:" + "|".join(EXPORT_EXTENSIONS) + r")\.rf\.[^.]+$"
    base = F.regexp_extract(own, pattern, 1)
    return F.when(base != "", base).otherwise(own)


def base_key(path: Column) -> Column:
    """``export_base`` without surrounding blanks, in lower case."""
    return F.lower(F.trim(export_base(path)))


def short_digest(prefix: str, text: Column) -> Column:
    """A prefix and the first 16 hexadecimal digits of the text's SHA-256."""
    return F.concat(F.lit(prefix), F.left(F.sha2(text, 256), F.lit(16)))


def variant_id(source: Column, path: Column) -> Column:
    """One id for all exports of one original of a source."""
    return short_digest("rfv_", F.concat(source, F.lit("\0"), F.lower(export_base(path))))


def composite_key(*parts: Column) -> Column:
    """Trimmed parts between bars; a null part is empty."""
    return F.concat_ws("|", *[F.trim(F.coalesce(p.cast("string"), F.lit(""))) for p in parts])


def case_id(*parts: Column) -> Column:
    return short_digest("review_", composite_key(*parts))


def coordinate(value: Column) -> Column:
    """Twelve decimals without trailing zeros or a trailing dot."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.12f", value.cast("double")), "0+$", ""), r"\.$", "")


def relative_key(path: Column, root: str) -> Column:
    """A path below ``root`` without its extension, in lower case."""
    below = F.when(F.startswith(path, F.lit(root.rstrip("/") + "/")), F.substr(path, F.lit(len(root.rstrip("/")) + 2))).otherwise(path)
    return F.lower(F.regexp_replace(below, r"(?<=[^/])\.[^./]+$", ""))


def split_of(path: Column, splits: tuple[str, ...] = ("train", "val", "test")) -> Column:
    """The split that a file is named after, or null."""
    own = F.lower(stem(path))
    return F.when(own.isin(*splits), own)


def split_list(text: Column) -> Column:
    """Names between commas or blanks, each once, in order."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[,\s]+"), lambda s: s != ""))


def reason_text(decision: Column, reasons: Mapping[str, str], detail: Column) -> Column:
    """The text of a decision, and after a colon what is known about the case."""
    text = None
    for k, v in reasons.items():
        text = F.when(decision == k, v) if text is None else text.when(decision == k, v)
    text = F.coalesce(text, decision)
    return F.when(F.coalesce(detail, F.lit("")) != "", F.concat(text, F.lit(": "), detail)).otherwise(text)


def tokens(line: Column) -> Column:
    """What lies between white space of any kind."""
    return F.filter(F.split(F.coalesce(line, F.lit("")), "(?U)[\\s\x1c-\x1f]+"), lambda t: t != "")


def resolve_path(path: Column, image_root: Column, manifest_folder: Column) -> Column:
    """An absolute path as it is, others below the image root, or below the manifest's folder where there is none."""
    root = F.coalesce(F.when(image_root != "", image_root), manifest_folder)
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"), path))


def json_or_column(document: Column, key: str, fallback: Column) -> Column:
    """A field of a JSON text, or the flat column where the text has none or is no JSON."""
    return F.coalesce(F.get_json_object(document, f"$.{key}"), fallback.cast("string"))
