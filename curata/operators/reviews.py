"""Human reviews: keys, problems, precedence, and what they do to a manifest of annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.functions import strings
from curata.functions.hashing import canonical_json

#: Fixed values of a review and of a manifest.
STATUSES = ("pending", "completed")
DECISIONS = ("approved", "exclude", "needs_reannotation")
INCLUDED = ("include_after_remap", "recover_from_coco")
KEY = ("source_dataset", "filename", "original_line_number", "original_class_id")


def normalised(rows: DataFrame, origin: str) -> DataFrame:
    """Trimmed cells, the review's key and id, and where the row comes from; null cells are empty."""
    cells = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in rows.columns]
    keys = [F.col(c) for c in KEY]
    clean = rows.select(*cells)
    return clean.withColumns({"review_key": strings.composite_key(*keys), "review_case_id": strings.case_id(*keys), "origin": F.lit(origin)})


def problems() -> Column:
    """What is wrong with a normalised row, in the order of the rules."""
    status, decision, reason = F.col("review_status"), F.col("reviewer_decision"), F.col("review_reason")
    return F.array_compact(
        F.array(
            F.when(~status.isin(*STATUSES), "invalid_status"),
            F.when((decision != "") & ~decision.isin(*DECISIONS), "invalid_decision"),
            F.when((status == "completed") & (decision == ""), "completed_without_decision"),
            F.when((status == "completed") & (reason == ""), "completed_without_reason"),
            F.when((decision != "") & (status != "completed"), "decision_without_completion"),
        )
    )


def contradictions(reviews: DataFrame) -> DataFrame:
    """Keys whose completed reviews disagree in decision or reason."""
    said = reviews.where("review_status = 'completed'").groupBy("review_key").agg(F.min(F.struct("reviewer_decision", "review_reason")).alias("a"), F.max(F.struct("reviewer_decision", "review_reason")).alias("b"))
    return said.where("a != b").select("review_key")


def unique_reviews(mandatory: DataFrame, general: DataFrame, position: str) -> DataFrame:
    """One row a key: a mandatory one goes before a general one, and a later one before an earlier."""
    both = mandatory.withColumn("__m", F.lit(1)).unionByName(general.withColumn("__m", F.lit(0)))
    last = both.groupBy("review_key").agg(F.max_by(F.struct(*mandatory.columns), F.struct("__m", F.col(position).cast("long"))).alias("r"))
    return last.select("r.*")


def decisions_fingerprint(reviews: DataFrame) -> DataFrame:
    """``part, unique_cases, sha256``: digests of the decisions in canonical JSON, by the first two digits of the case id."""
    names = ("review_case_id", "review_key", "reviewer_decision", "review_reason", "review_status")
    rows = reviews.select("review_key", F.substr("review_case_id", F.lit(8), F.lit(2)).alias("part"), canonical_json(**{n: F.col(n) for n in names}).alias("json"))
    ordered = F.array_sort(F.collect_list(F.struct("review_key", "json")))
    text = F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda r: r["json"]), ","), F.lit("]"))
    return rows.groupBy("part").agg(F.count("*").alias("unique_cases"), F.sha2(text, 256).alias("sha256"))


def matched(manifest: DataFrame, reviews: DataFrame, exact: Sequence[str], loose: Sequence[str]) -> DataFrame:
    """Manifest rows with the reviews that fit: equal in ``exact``, and in each of ``loose`` where the review names a value."""
    r = reviews.select(*[F.col(c).alias(f"__{c}") if c in (*exact, *loose) else F.col(c) for c in reviews.columns])
    on = F.lit(True)
    for c in exact:
        on = on & (F.col(c) == F.col(f"__{c}"))
    for c in loose:
        on = on & (F.col(f"__{c}").isNull() | (F.col(c) == F.col(f"__{c}")))
    return manifest.join(r, on).drop(*[f"__{c}" for c in (*exact, *loose)])


def applied(manifest: DataFrame, reviews: DataFrame, row: Sequence[str], exact: Sequence[str], loose: Sequence[str], label: str, line: str) -> DataFrame:
    """The manifest after its reviews: decisions, the kept annotations' new line numbers, and whether their label file is left.

    Reviews act in the order of their keys: the last that fits is recorded, the
    first that does not approve takes the row out if it was included.  Lines
    of a label file close up; a file without lines goes with its image.
    """
    fits = matched(manifest.select(*row, "decision", *[c for c in (*exact, *loose) if c not in row]), reviews, exact, loose)
    said = F.struct("reviewer_decision", "review_reason")
    against = F.when((F.col("reviewer_decision") != "approved") & F.col("decision").isin(*INCLUDED), F.col("review_key"))
    per = fits.groupBy(*row).agg(F.max_by(said, "review_key").alias("last"), F.min_by(said, against).alias("out"), F.min(against).alias("hit"), F.count("*").alias("reviews"))
    rows = manifest.join(per, list(row), "left")
    gone = F.col("hit").isNotNull()
    after = F.when(gone & (F.col("out.reviewer_decision") == "exclude"), "exclude_human_review").when(gone, "exclude_needs_reannotation").otherwise(F.col("decision"))
    rows = rows.withColumns({"final_decision": after, "reviewer_decision": F.col("last.reviewer_decision"), "reviews": F.coalesce("reviews", F.lit(0))})
    kept = rows.where(F.col("final_decision").isin(*INCLUDED))
    new = kept.select(*row, F.row_number().over(Window.partitionBy(label).orderBy(line)).alias("final_line"))  # the lines of one file
    files = kept.select(label).distinct().withColumn("__left", F.lit(True))
    return rows.join(new, list(row), "left").join(files, label, "left").withColumn("file_left", F.coalesce("__left", F.lit(False))).drop("__left", "last", "out", "hit")


def renumbered(rows: DataFrame, label: str, line: str) -> DataFrame:
    """Old and new line numbers of what is left of each label file."""
    return rows.select(label, F.col(line).alias("old_line"), F.row_number().over(Window.partitionBy(label).orderBy(line)).alias("new_line"))


def lock_document(images: Column, masks: Column, pending: Column, invalid: Column, rebuilt: Column) -> Column:
    """Status and blockers of a data set's lock."""
    blockers = F.array_compact(
        F.array(
            F.when(pending > 0, F.concat(F.lit("manual_reviews_pending="), pending.cast("string"))),
            F.when(invalid > 0, F.concat(F.lit("invalid_review_rows="), invalid.cast("string"))),
            F.when(~rebuilt, "decisions_not_rebuilt_from_original_sources"),
        )
    )
    status = F.when(F.size(blockers) == 0, "ready_for_split_generation").otherwise("blocked_by_manual_review")
    return F.struct(status.alias("status"), blockers.alias("blockers"), images.alias("images"), masks.alias("masks"))
