"""Two annotations of the same images: comparison by image, and geometry from the first source that has any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_image(rows: DataFrame, image: str, kind: str, valid: Column, points: Column, area: Column, prefix: str) -> DataFrame:
    """Counts, classes, vertices and area of an image's annotations; classes are an array of (name, n) in order."""
    kinds = rows.groupBy(image, kind).agg(F.count("*").alias("n"), F.count_if(valid).alias("v"), F.sum(points).alias("p"), F.sum(area).alias("a"))
    classes = F.array_sort(F.collect_list(F.struct(F.col(kind).alias("name"), "n")))  # one entry a class
    out = [F.sum("n").alias("count"), F.sum("v").alias("valid"), F.sum("p").alias("points"), F.sum("a").alias("area"), classes.alias("classes")]
    return kinds.groupBy(image).agg(*[c.alias(f"{prefix}_{n}") for c, n in zip(out, ("count", "valid", "points", "area", "classes"))])


def compared(left: DataFrame, right: DataFrame, image: str, a: str = "yolo", b: str = "coco") -> DataFrame:
    """Full outer by image: which side has it, how the counts differ, and whether the classes are the same multiset."""
    both = left.join(right, image, "full")
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    filled = {f"{s}_{c}": number(f"{s}_{c}") for s in (a, b) for c in ("count", "valid", "points", "area")}
    same = F.col(f"{a}_classes").eqNullSafe(F.col(f"{b}_classes"))
    marks = {f"in_{a}": F.col(f"{a}_count").isNotNull(), f"in_{b}": F.col(f"{b}_count").isNotNull(), "class_names_match": same, "count_delta": number(f"{a}_count") - number(f"{b}_count")}
    return both.withColumns(marks | filled).drop(f"{a}_classes", f"{b}_classes")


def first_known(rows: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame]], value: str) -> DataFrame:
    """``rows`` with ``origin`` and ``value`` from the first source, in order, that has one for the key."""
    out, found, origin = rows, None, None
    for name, df in sources:
        one = df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(f"__{name}"))
        out = out.join(one, key, "left")
        hit = F.col(f"__{name}")
        found = F.when(hit.isNotNull(), hit) if found is None else found.when(hit.isNotNull(), hit)
        origin = F.when(hit.isNotNull(), name) if origin is None else origin.when(hit.isNotNull(), name)
    return out.withColumns({"origin": F.coalesce(origin, F.lit("unresolved")), value: found}).drop(*[f"__{n}" for n, _ in sources])


def totals_by_source(parts: Sequence[tuple[str, DataFrame]], source: str) -> DataFrame:
    """One row a source with the aggregate of each part, 0 where a part has none of it."""
    out = None
    for name, df in parts:
        one = df.groupBy(source).agg(F.count("*").alias(name))
        out = one if out is None else out.join(one, source, "full")
    return out.na.fill(0, [n for n, _ in parts])


def source_decision(images: Column, polygons: Column, invalid: Column, licensed: Column, full_leaf: Column) -> Column:
    """Whether a source can be used: not without images, a licence or whole leaves; with review where lines are broken."""
    return (
        F.when((images == 0) | (polygons == 0), "reject_empty")
        .when(~licensed, "reject_licence")
        .when(full_leaf == 0, "reject_no_full_leaf")
        .when(invalid > 0, "accept_with_review")
        .otherwise("accept")
    )


def instance_counts(images: DataFrame, instances: DataFrame, key: str, group: Sequence[str]) -> DataFrame:
    """How many images have none, one, two and more instances, the most, mean and median, by group."""
    per = instances.groupBy(key).agg(F.count("*").alias("__n"))
    rows = images.join(per, key, "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    cells = rows.groupBy(*group, "__n").agg(F.count("*").alias("__c"))  # few distinct counts
    exactly = lambda k: F.sum(F.when(F.col("__n") == k, F.col("__c")).otherwise(0))
    return cells.groupBy(*group).agg(
        F.sum("__c").alias("images"),
        exactly(0).alias("with_0"),
        exactly(1).alias("with_1"),
        exactly(2).alias("with_2"),
        F.sum(F.when(F.col("__n") >= 3, F.col("__c")).otherwise(0)).alias("with_3_or_more"),
        F.max("__n").alias("most"),
        (F.sum(F.col("__n") * F.col("__c")) / F.sum("__c")).alias("mean"),
        F.percentile("__n", F.lit(0.5), F.col("__c")).alias("median"),
    )
