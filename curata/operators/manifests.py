"""Manifests: their rows, canonical order, hold-out keys, roll-ups, and what survives a review."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions import strings

SPLIT_ORDER = ("train", "val", "test")


def split_place(split: Column) -> Column:
    """A split's place in the canonical order; unknown ones last."""
    place = F.array_position(F.array(*[F.lit(s) for s in SPLIT_ORDER]), split)
    return F.when(place > 0, place).otherwise(len(SPLIT_ORDER) + 1)


def canonical_order(rows: DataFrame, split: str, name: str) -> DataFrame:
    """Rows by split and name, whatever its case; a range sort."""
    return rows.orderBy(split_place(F.col(split)), F.lower(F.col(name)), name)


def split_rows(records: DataFrame, method: str = "copy") -> DataFrame:
    """The rows of a split's manifest: paths before and after, and mask areas with twelve decimals."""
    name, own = F.col("filename"), strings.stem(F.col("filename"))
    area = lambda c: F.format_string("%.12f", F.coalesce(c, F.lit(0.0))).alias
    areas = F.col("mask_areas")
    mean = F.try_divide(F.aggregate(areas, F.lit(0.0), lambda a, v: a + v), F.size(areas))
    return records.select(
        "split",
        "group_id",
        "source_dataset",
        "filename",
        F.concat(F.lit("all/images/"), name).alias("source_image_path"),
        F.concat(F.lit("all/labels/"), own, F.lit(".txt")).alias("source_label_path"),
        F.concat(F.lit("images/"), "split", F.lit("/"), name).alias("materialized_image_path"),
        F.concat(F.lit("labels/"), "split", F.lit("/"), own, F.lit(".txt")).alias("materialized_label_path"),
        area(F.array_min(areas))("mask_area_min"),
        area(F.array_max(areas))("mask_area_max"),
        area(mean)("mask_area_mean"),
        F.lit(method).alias("materialization_method"),
    )


def held_out_keys(rows: DataFrame, path: str, digest: str) -> dict[str, DataFrame]:
    """Distinct paths and names, whatever their case, and digests that later selections must not have."""
    one = lambda c, n: rows.where(F.coalesce(c, F.lit("")) != "").select(c.alias(n)).distinct()
    return {"path": one(F.lower(path), "path"), "name": one(F.lower(strings.file_name(F.col(path))), "name"), "digest": one(F.col(digest), "digest")}


def roll_ups(rows: DataFrame, sections: Mapping[str, Sequence[str]]) -> DataFrame:
    """``section, key, n``: counts by the columns of each section, joined by bars; all sections in one aggregation."""
    parts = [F.struct(F.lit(s).alias("section"), strings.composite_key(*[F.col(c) for c in columns]).alias("key")) for s, columns in sections.items()]
    return rows.select(F.inline(F.array(*parts))).groupBy("section", "key").agg(F.count("*").alias("n"))


def surviving(manifest: DataFrame, path: str, images: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Manifest rows of images that are left, and the names that have none or several; one each is right."""
    keyed = manifest.withColumn("__name", strings.file_name(F.col(path)))
    kept = keyed.join(images.select(F.col(name).alias("__name")).distinct(), "__name", "left_semi")
    per = kept.groupBy("__name").agg(F.count("*").alias("rows"))
    wrong = images.select(F.col(name).alias("__name")).distinct().join(per, "__name", "left").where("rows is null or rows > 1")
    return kept.drop("__name"), wrong.select(F.col("__name").alias("name"), F.coalesce("rows", F.lit(0)).alias("rows"))


def method_counts(manifest: DataFrame, method: str, status: str) -> DataFrame:
    """How many images were normalised, mended without loss, and encoded anew."""
    return manifest.agg(
        F.count("*").alias("images"),
        F.count_if(F.col(status) == "normalized").alias("normalized"),
        F.count_if(F.col(method) == "append_ffd9").alias("mended"),
        F.count_if(F.startswith(method, F.lit("reencode_"))).alias("reencoded"),
    )


def latest(rows: DataFrame, time: str, name: str) -> DataFrame:
    """The newest row; of equal times the last by name."""
    return rows.agg(F.max_by(F.struct(*rows.columns), F.struct(time, name)).alias("r")).where("r is not null").select("r.*")


def payload(parts: Sequence[DataFrame], path: str, forbidden: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct paths of all parts in order, and those that lead through a forbidden folder or file."""
    every = parts[0].select(path)
    for p in parts[1:]:
        every = every.unionByName(p.select(path))
    every = every.distinct()
    bad = F.exists(F.split(path, "/"), lambda p: p.isin(*forbidden))
    return every.where(~bad).orderBy(path), every.where(bad)
