"""Evaluation of masks and gates: pair metrics, grouped summaries, confusion of statuses, choice of thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("reliable", "uncertain", "failed")
#: Means of these columns are part of every summary.
MEANS = ("leaf_pixel_recall", "leaf_pixel_precision", "iou", "dice", "under_segmentation_ratio", "over_segmentation_ratio", "cropped_leaf_percent")


def pair_metrics(truth: Column, predicted: Column, shared: Column, total: Column, min_area: float = 0.01) -> Column:
    """Overlap measures of a mask and its prediction, given their sizes, that of what they share and that of the image."""
    union = truth + predicted - shared
    recall = F.try_divide(shared, truth)
    or_zero = lambda up, down: F.when(down > 0, F.try_divide(up, down)).otherwise(0.0)
    return F.struct(
        (F.try_divide(predicted, total) >= min_area).alias("detected"),
        recall.alias("leaf_pixel_recall"),
        or_zero(shared, predicted).alias("leaf_pixel_precision"),
        or_zero(shared, union).alias("iou"),
        or_zero(2 * shared, truth + predicted).alias("dice"),
        (1 - recall).alias("under_segmentation_ratio"),
        F.try_divide(F.greatest(F.lit(0.0), predicted - shared), truth).alias("over_segmentation_ratio"),
        (100 * (1 - recall)).alias("cropped_leaf_percent"),
        F.try_divide(truth, total).alias("truth_area_fraction"),
        F.try_divide(predicted, total).alias("predicted_area_fraction"),
    )


def with_predictions(truth: DataFrame, predictions: DataFrame, on: Sequence[str], areas: Sequence[str]) -> DataFrame:
    """Truth with its prediction; where there is none its areas are 0."""
    return truth.join(predictions, list(on), "left").withColumns({a: F.coalesce(a, F.lit(0.0)) for a in areas})


def outputs() -> list[Column]:
    """The aggregates of a summary over metric rows with ``detected, fallback, multi_leaf`` and ``MEANS``."""
    rate = lambda c: F.count_if(c) / F.count("*")
    out = [
        F.count("*").alias("images"),
        F.count_if(~F.col("detected")).alias("images_without_detection"),
        rate(~F.col("detected")).alias("images_without_detection_rate"),
        F.count_if(F.col("fallback")).alias("fallback_images"),
        rate(F.col("fallback")).alias("fallback_rate"),
    ]
    out += [F.avg(c).alias(f"mean_{c}") for c in MEANS]
    out += [
        F.max("cropped_leaf_percent").alias("worst_cropped_leaf_percent"),
        F.coalesce(F.avg(F.when(F.col("detected"), F.col("iou"))), F.lit(0.0)).alias("mean_iou_detected_only"),
        F.count_if(F.col("multi_leaf")).alias("multi_leaf_images"),
        F.avg(F.when(F.col("multi_leaf"), F.col("leaf_pixel_recall"))).alias("mean_leaf_pixel_recall_multi_leaf"),
    ]
    return out


def grouped_summary(rows: DataFrame, groupings: Mapping[str, Column]) -> DataFrame:
    """``section, value`` and ``outputs`` over all rows and over each grouping's values, in one aggregation."""
    names = list(groupings)
    keyed = rows.withColumns({f"__{k}": v.cast("string") for k, v in groupings.items()})
    keys = [F.col(f"__{k}") for k in names]
    found = keyed.groupingSets([[], *[[k] for k in keys]], *keys).agg(F.grouping_id().alias("__set"), *outputs())
    whole = (1 << len(names)) - 1  # a bit is 0 where its key is grouped by; the first key has the highest
    section, value = F.when(F.col("__set") == whole, "overall"), F.when(F.col("__set") == whole, "")
    for i, k in enumerate(names):
        own = whole ^ (1 << (len(names) - 1 - i))
        section, value = section.when(F.col("__set") == own, k), value.when(F.col("__set") == own, F.col(f"__{k}"))
    measures = [c for c in found.columns if not c.startswith("__")]
    return found.select(section.alias("section"), value.alias("value"), *measures)


def confusion(status: str, label: str, good: str = "GOOD") -> list[Column]:
    """Counts of a gate's statuses against labels; precision and coverage are null without rows."""
    reliable, fine = F.col(status) == "reliable", F.col(label) == good
    return [
        F.count("*").alias("total_audited"),
        *[F.count_if(F.col(status) == s).alias(s) for s in STATUSES],
        F.count_if(reliable & fine).alias("reliable_good"),
        F.count_if(reliable & ~fine).alias("false_reliable"),
        F.count_if(~reliable & fine).alias("good_masks_rejected"),
        F.try_divide(F.count_if(reliable & fine), F.count_if(reliable)).alias("reliability_precision"),
        F.try_divide(F.count_if(reliable), F.count("*")).alias("segmentation_coverage"),
    ]


def wrong_ids(rows: DataFrame, key: str, status: str, label: str, good: str = "GOOD") -> DataFrame:
    """``kind, key`` of rows that a gate lets through or turns away against their label."""
    reliable, fine = F.col(status) == "reliable", F.col(label) == good
    kind = F.when(reliable & ~fine, "false_reliable").when(~reliable & fine, "good_rejected")
    return rows.select(kind.alias("kind"), key).where("kind is not null")


def compare_gates(rows: DataFrame, tags: Column, before: str, after: str, label: str) -> DataFrame:
    """Per tag (a row may have several) the confusion of two gates, and what the second changes."""
    tagged = rows.withColumn("subgroup", F.explode(tags))
    one = lambda status, prefix: [c.alias(f"{prefix}_{n}") for c, n in zip(confusion(status, label), ("n", *STATUSES, "good", "false", "rejected", "precision", "coverage"))]
    out = tagged.groupBy("subgroup").agg(*one(before, "old"), *one(after, "new"))
    return out.withColumns({f"delta_{c}": F.col(f"new_{c}") - F.col(f"old_{c}") for c in ("precision", "coverage", "false", "rejected")})


def choose_threshold(candidates: DataFrame, min_recall: float = 0.97) -> DataFrame:
    """The candidate with the best Dice of those that reach a recall; where none does, that with the best recall.

    Ties go on to recall, precision, fallback rate and the larger threshold.
    """
    viable = F.col("mean_leaf_pixel_recall") >= min_recall
    first, second = F.col("mean_dice"), F.col("mean_leaf_pixel_recall")
    rank = F.struct(
        viable.alias("a"),
        F.when(viable, first).otherwise(second).alias("b"),
        F.when(viable, second).otherwise(first).alias("c"),
        F.when(viable, F.col("mean_leaf_pixel_precision")).otherwise(0.0).alias("d"),
        (-F.col("fallback_rate")).alias("e"),
        F.col("selection_threshold").alias("f"),
    )
    best = candidates.agg(F.max_by(F.struct(*candidates.columns), rank).alias("best"))
    return best.where("best is not null").select("best.*")


def recommend_gate(swept: DataFrame, production: Mapping[str, float], min_precision: float = 0.95) -> DataFrame:
    """Of gates with ``reliable_good, reliable, good, n`` the best one that reaches a precision; an error where none does.

    Best is: most good masks kept, then the larger share of them, precision,
    coverage, nearness to the gate in production, and the smaller limits.
    """
    far = F.round(sum((F.abs(F.col(k) - v) for k, v in production.items()), F.lit(0.0)), 9)
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision = share("reliable_good", "reliable")
    rank = F.struct(
        F.col("reliable_good").alias("a"),
        share("reliable_good", "good").alias("b"),
        precision.alias("c"),
        share("reliable", "n").alias("d"),
        (-far).alias("e"),
        *[(-F.col(k)).alias(f"f_{k}") for k in production],
    )
    best = swept.where(precision >= min_precision).agg(F.max_by(F.struct(*production, "reliable_good", "reliable"), rank).alias("best"))
    found = F.coalesce("best", F.raise_error(F.lit(f"no gate reaches a precision of {min_precision}")).cast(best.schema["best"].dataType))
    return best.select(found.alias("best")).select("best.*")
