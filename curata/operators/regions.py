"""Regions of interest drawn by hand: import with cardinality rules, validation, duplicates by severity, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions import boxes, labels
from curata.functions.binding import let
from curata.operators.relational import exact_quantiles

#: What an annotator can say, and the states that a row of the manifest can have.
SAID = ("annotated", "ambiguous", "rejected")
KNOWN = ("annotated", "pending", "ambiguous", "rejected")
SIDES = ("x1", "y1", "x2", "y2")
_EMPTY = "struct<status:string,box:struct<x1:int,y1:int,x2:int,y2:int>,area_ratio:double,clipped:boolean,note:string>"


def _state(status: Column | str, note: Column | str) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    none = F.lit(None)
    return F.struct(lit(status).alias("status"), none.alias("box"), none.alias("area_ratio"), F.lit(False).alias("clipped"), lit(note).alias("note")).cast(_EMPTY)


def imported(images: DataFrame, annotations: DataFrame, key: str, width: str, height: str, min_area_ratio: float) -> DataFrame:
    """Images with what their annotations say: none is pending, several are ambiguous, one is measured.

    Of several rows only their number matters, so no list of them is built.
    """
    one = annotations.groupBy(key).agg(F.count("*").alias("__n"), F.min(F.struct("status", "notes", *SIDES)).alias("__a"))
    rows = images.join(one, key, "left")
    a, said = F.col("__a"), F.lower(F.trim(F.coalesce("__a.status", F.lit(""))))
    box = F.struct(*[labels.finite(a[s]).alias(s) for s in SIDES])
    drawn = let(box, lambda b: boxes.annotation_of(b, F.col(width), F.col(height), min_area_ratio)).cast(_EMPTY)
    state = (
        F.when(F.col("__n").isNull(), _state("pending", "no_annotation"))
        .when(F.col("__n") > 1, _state("ambiguous", F.concat(F.lit("duplicates="), F.col("__n").cast("string"))))
        .when(~said.isin(*SAID), _state("ambiguous", "unknown_status"))
        .when(said != "annotated", _state(said, F.trim(F.coalesce(a["notes"], F.lit("")))))
        .otherwise(drawn)
    )
    return rows.withColumn("annotation", state).drop("__n", "__a")


def single_box(text: Column, width: Column, height: Column, min_area_ratio: float) -> Column:
    """A label text with one box of class 0, or why it cannot be used; a null text is a missing file."""
    lines = F.filter(F.transform(F.split(F.regexp_replace(text, "^\ufeff", ""), "\r\n|[\n\r]"), lambda s: F.trim(s)), lambda s: s != "")

    def of_line(n: Column, c: Column, fields: Column) -> Column:
        return (
            F.when(n == 0, _state("ambiguous", "empty_label"))
            .when(n > 1, _state("ambiguous", F.concat(F.lit("boxes="), n.cast("string"))))
            .when(fields > 5, _state("ambiguous", "polygon"))
            .when(fields != 5, _state("ambiguous", "format"))
            .when(F.coalesce(c["class_id"] != 0, F.lit(True)), _state("ambiguous", "class"))
            .when(c["kind"] != "bbox", _state("ambiguous", "coordinates"))
            .otherwise(let(boxes.real_pixels_of_unit(c["box"], width, height), lambda b: boxes.annotation_of(b, width, height, min_area_ratio)).cast(_EMPTY))
        )

    first = lambda ls: F.get(ls, F.lit(0))
    found = let(lines, lambda ls: let(labels.classify_line(first(ls)), lambda c: of_line(F.size(ls), c, F.size(F.split(first(ls), r"\s+")))))
    return F.when(text.isNull(), _state("pending", "no_label")).otherwise(found)


def manifest_row(annotation: Column) -> Column:
    """The region's cells, blank unless it is annotated."""
    a, box = annotation, annotation["box"]
    own = lambda v: F.when(a["status"] == "annotated", v)
    cells = {f"roi_{s}": own(box[s]) for s in SIDES}
    cells |= {"roi_width": own(boxes.width(box)), "roi_height": own(boxes.height(box)), "roi_area_ratio": own(a["area_ratio"])}
    return F.struct(a["status"].alias("annotation_status"), *[v.alias(k) for k, v in cells.items()])


def cell_errors(cells: Mapping[str, Column], width: Column, height: Column, min_area_ratio: float) -> Column:
    """What is wrong with a row's region: cells where there should be none, no numbers, a bad box, or measures that disagree with it."""
    status = cells["annotation_status"]
    fields = (*SIDES, "width", "height", "area_ratio")
    blank = lambda c: F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""
    filled = F.lit(False)
    for k in fields:
        filled = filled | ~blank(cells[f"roi_{k}"])
    none = F.array().cast("array<string>")

    def measured(x: Column) -> Column:
        box = F.struct(*[x[s].alias(s) for s in SIDES])
        missing = F.array_compact(F.array(*[F.when(x[s].isNull(), f"roi_{s}") for s in SIDES]))

        def judged(v: Column) -> Column:
            b = v["box"]
            close = F.abs(x["area_ratio"] - v["area_ratio"]) <= 1e-6 * F.greatest(F.abs(x["area_ratio"]), F.abs(v["area_ratio"]))
            inside = F.array_compact(
                F.array(
                    F.when(boxes.needs_clipping(box, width, height), "outside_image"),
                    *[F.when(x[k].isNull(), f"roi_{k}") for k in ("width", "height", "area_ratio")],
                    F.when(x["width"] != boxes.width(b), "inconsistent_width"),
                    F.when(x["height"] != boxes.height(b), "inconsistent_height"),
                    F.when(~close, "inconsistent_area_ratio"),
                )
            )
            return F.when(~v["detected"], F.array(v["reason"])).otherwise(inside)

        return let(missing, lambda m: F.when(F.size(m) > 0, m).otherwise(let(boxes.validate(box, width, height, min_area_ratio), judged)))

    idle = F.array_compact(F.array(F.when(filled, "cells_not_blank"), F.when(status == "pending", "pending")))
    known = F.when(F.coalesce(status.isin(*KNOWN), F.lit(False)), none).otherwise(F.array(F.lit("unknown_status")))
    values = F.struct(*[labels.finite(cells[f"roi_{k}"]).alias(k) for k in fields])
    own = F.when(F.coalesce(status != "annotated", F.lit(True)), idle).otherwise(let(values, measured))
    return F.concat(known, own)


def repeated_values(rows: DataFrame, row: str, split: str, keys: Sequence[tuple[str, str, bool]], digest: str) -> DataFrame:
    """``row, severity, message`` of rows that share a value: ids (blank ones too), paths and names, and digests.

    ``keys`` are (name, column, whether it is an error and blanks count); rows
    that share a digest are an error across splits and a warning within one.
    """
    out = None
    for name, column, error in keys:
        value = F.coalesce(F.col(column).cast("string"), F.lit(""))
        some = rows if error else rows.where(value != "")
        shared = some.groupBy(value.alias("__value")).agg(F.count("*").alias("__n")).where("__n > 1")
        one = some.withColumn("__value", value).join(shared, "__value").select(row, F.lit("error" if error else "warning").alias("severity"), F.lit(f"repeated_{name}").alias("message"))
        out = one if out is None else out.unionAll(one)
    some = rows.where(F.coalesce(F.col(digest), F.lit("")) != "")
    shared = some.groupBy(digest).agg(F.count("*").alias("__n"), F.min(split).alias("__a"), F.max(split).alias("__b")).where("__n > 1")
    crossing = F.col("__a") != F.col("__b")
    one = some.join(shared, digest).select(row, F.when(crossing, "error").otherwise("warning").alias("severity"), F.when(crossing, "leak_between_splits").otherwise("repeated_in_split").alias("message"))
    return one if out is None else out.unionAll(one)


def coverage(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``section, value, n`` of each column's values (blank ones are ``unknown``) in one aggregation."""
    names = list(columns)
    keyed = rows.select(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(c).cast("string")).otherwise("unknown").alias(f"__{n}") for n, c in columns.items()])
    parts = F.array(*[F.struct(F.lit(n).alias("section"), F.col(f"__{n}").alias("value")) for n in names])
    return keyed.select(F.inline(parts)).groupBy("section", "value").agg(F.count("*").alias("n"))


def area_summary(rows: DataFrame, area: str) -> DataFrame:
    """Count, extremes, mean and exact median of the areas that are known."""
    known = rows.where(F.col(area).isNotNull()).withColumn("__all", F.lit(1))
    spread = exact_quantiles(known, ["__all"], area, (0.5,))
    return spread.join(known.groupBy("__all").agg(F.avg(area).alias("mean")), "__all").select("n", "lo", "hi", "mean", F.get("q", F.lit(0)).alias("median"))
