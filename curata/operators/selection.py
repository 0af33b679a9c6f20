"""Choosing rows: exclusions by first failing reason, priorities, quotas and spreads, the same in every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.functions.hashing import seeded_rank
from curata.operators.relational import numbered


def screened(rows: DataFrame, position: str, early: Sequence[tuple[str, Column]], path: str, digest: str, held: DataFrame) -> DataFrame:
    """``rows`` with ``reason``: null for accepted ones, else the first rule that a row fails.

    ``early`` are (reason, condition) of a row by itself.  Then come digests of
    ``held``, and of the rows that are left with one digest the first by
    ``position`` is accepted; the others repeat its path or only its content.
    """
    own = None
    for name, condition in early:
        own = F.when(condition, name) if own is None else own.when(condition, name)
    checked = rows.withColumn("__early", own)
    held = held.select(F.col(digest).alias("__held")).distinct()
    passed = checked.where(F.col("__early").isNull())
    free = passed.join(held, F.col(digest) == F.col("__held"), "left_anti")
    first = free.groupBy(digest).agg(F.min_by(F.struct(F.col(position).alias("at"), F.col(path).alias("path")), position).alias("__first"))
    judged = checked.join(first, digest, "left")
    late = F.when(F.col("__first").isNull(), "held_out_hash").when(F.col("__first.at") == F.col(position), None).when(F.col("__first.path") == F.col(path), "duplicate_path").otherwise("duplicate_hash")
    return judged.withColumn("reason", F.coalesce("__early", F.when(F.col("__early").isNull(), late))).drop("__early", "__first")


def priority_scores(rows: DataFrame, path: str, position: str) -> DataFrame:
    """``path, rank, probability``: wrong predictions (rank 0) before right ones; a path's last row counts."""
    said = F.lower(F.trim(F.coalesce("correct", F.lit(""))))
    labelled = (F.coalesce("label", F.lit("")) != "") & (F.coalesce("pred_label", F.lit("")) != "")
    wrong = F.when(labelled, F.col("label") != F.col("pred_label")).otherwise(said.isin("false", "0", "no"))
    scored = rows.where(F.trim(F.col(path)) != "").select(path, position, F.when(wrong, 0).otherwise(1).alias("rank"), F.coalesce(F.col("pred_prob").try_cast("double"), F.lit(1.0)).alias("probability"))
    return scored.groupBy(path).agg(F.max_by(F.struct("rank", "probability"), position).alias("s")).select(path, "s.rank", "s.probability")


def first_of_path(rows: DataFrame, path: str, position: str) -> DataFrame:
    """The first row of each path, whatever its case."""
    first = rows.groupBy(F.lower(F.col(path)).alias("__path")).agg(F.min(position).alias("__first"))
    return rows.withColumn("__path", F.lower(F.col(path))).join(first, "__path").where(F.col(position) == F.col("__first")).drop("__path", "__first")


def pilot(rows: DataFrame, group: str, path: str, real: Column, scores: DataFrame, quota: int, seed: int = 42) -> DataFrame:
    """``quota`` rows taken from the groups in turn: in each wrong predictions first, then unsure ones, real scenes, and by a seeded digest."""
    known = rows.join(scores, path, "left").withColumns({"__rank": F.coalesce("rank", F.lit(2)), "__p": F.coalesce("probability", F.lit(1.0)), "__real": F.when(real, 0).otherwise(1), "__seed": seeded_rank(seed, F.col(path))})
    place = F.row_number().over(Window.partitionBy(group).orderBy("__rank", "__p", "__real", "__seed", path))
    some = known.withColumn("turn", place).where(F.col("turn") <= quota)
    return some.orderBy("turn", group).limit(quota).select(*rows.columns, "turn")


def interleaved(rows: DataFrame, group: Sequence[str], bucket: Sequence[str], key: str, quota: int, seed: int = 42) -> DataFrame:
    """``rows`` and ``turn``, ``spread``: within a group buckets give one row after the other, in a seeded order; ``quota`` a bucket at most."""
    place = F.row_number().over(Window.partitionBy(*group, *bucket).orderBy(seeded_rank(seed, F.col(key)), key))
    some = rows.withColumn("turn", place).where(F.col("turn") <= quota)
    return some.withColumn("spread", F.row_number().over(Window.partitionBy(*group).orderBy("turn", *bucket)))  # at most quota x buckets rows a group


def even_quotas(classes: DataFrame, name: str, count: int) -> DataFrame:
    """``count`` in equal parts; what is left goes to the first classes by name.  One row a class."""
    ranked = numbered(classes.select(name).distinct(), [name], "__at")
    total = ranked.agg(F.count("*").alias("__k"))
    quota = F.floor(F.lit(count) / F.col("__k")) + F.when(F.col("__at") <= F.lit(count) % F.col("__k"), 1).otherwise(0)
    return ranked.join(F.broadcast(total)).select(name, quota.cast("long").alias("quota"))  # one row


def filled_quotas(capacities: DataFrame, name: str, capacity: str, count: int) -> DataFrame:
    """``count`` units given in turn to classes that still have room.  One row a class with room."""
    units = capacities.where(F.col(capacity) > 0).select(name, F.explode(F.sequence(F.lit(1), F.least(F.col(capacity), F.lit(count)).cast("int"))).alias("__unit"))
    return units.orderBy("__unit", name).limit(count).groupBy(name).agg(F.count("*").alias("quota"))


def detector_sample(rows: DataFrame, label: str, lab: Column, bucket: Sequence[str], key: str, count: int, real_share: float = 0.8, seed: int = 42) -> DataFrame:
    """``count`` rows with equal classes, spread over buckets, a share of them real scenes; classes fill up from what they have.

    Lab rows get quotas in turn up to the class's quota and their number; real
    rows fill the rest of the class, then any row of it, then any row at all.
    """
    quotas = even_quotas(rows, label, count)
    lab_target = count - int(round(count * real_share))
    have = rows.where(lab).groupBy(label).agg(F.count("*").alias("__lab")).join(quotas, label).withColumn("__room", F.least("__lab", "quota"))
    lab_quota = filled_quotas(have, label, "__room", lab_target).withColumnRenamed("quota", "lab_quota")
    plan = quotas.join(lab_quota, label, "left").withColumn("lab_quota", F.coalesce("lab_quota", F.lit(0)))
    ranked = interleaved(rows.withColumn("__is_lab", lab), [label, "__is_lab"], bucket, key, count, seed).where(F.col("spread") <= count)
    ranked = ranked.join(F.broadcast(plan), label)  # one row a class
    need = F.when(F.col("__is_lab"), F.col("lab_quota")).otherwise(F.col("quota") - F.col("lab_quota"))
    # 0: within its quota, 1: may fill up its class, and beyond that the whole
    stage = F.when(F.col("spread") <= need, 0).otherwise(1)
    in_class = F.row_number().over(Window.partitionBy(label).orderBy("__stage", "spread", key))  # at most 2 x count rows a class
    ranked = ranked.withColumn("__stage", stage).withColumn("__place", in_class)
    order = [F.when(F.col("__place") <= F.col("quota"), 0).otherwise(1), "__place", label, key]
    return ranked.orderBy(*order).limit(count).select(*rows.columns)


def top_rows(rows: DataFrame, key: str, order: Sequence[Column | str], n: int = 12) -> DataFrame:
    """The ``n`` first by an order, each key once at its first place (a list for a report)."""
    best = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("__o"))
    return best.orderBy("__o", key).limit(n).select(key)
