"""Validators: a violation is a row, a data set passes if there is none."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def violations(rows: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """``rule, key`` of every rule that a row breaks; a rule that gives null is not broken."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return rows.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"))


def verdicts(found: DataFrame, rules: Sequence[str]) -> DataFrame:
    """``rule, broken, passed`` for all rules, those that hold too."""
    every = found.sparkSession.createDataFrame([(r,) for r in rules], "rule string")  # one row a rule
    counts = found.groupBy("rule").agg(F.count("*").alias("broken"))
    return every.join(counts, "rule", "left").select("rule", F.coalesce("broken", F.lit(0)).alias("broken"), (F.coalesce("broken", F.lit(0)) == 0).alias("passed"))


def examples(found: DataFrame, kind: str, order: str, n: int = 10) -> DataFrame:
    """Every problem's full count and its first ``n`` examples (a report's list)."""
    counts = found.groupBy(kind).agg(F.count("*").alias("total"))
    first = found.withColumn("place", F.row_number().over(Window.partitionBy(kind).orderBy(order))).where(F.col("place") <= n)
    return first.join(counts, kind)


def unequal(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows that only one side has, and which; none if the sets are equal."""
    a, b = left.select(*columns).distinct(), right.select(*columns).distinct()
    return a.exceptAll(b).withColumn("only_in", F.lit("left")).unionByName(b.exceptAll(a).withColumn("only_in", F.lit("right")))


def changed_digests(manifest: DataFrame, files: DataFrame, key: str, digest: str) -> DataFrame:
    """``key, problem``: manifest rows whose file is missing or has another digest."""
    own = files.select(key, F.col(digest).alias("__own"))
    both = manifest.select(key, digest).join(own, key, "left")
    return both.select(key, F.when(F.col("__own").isNull(), "missing").when(F.col("__own") != F.col(digest), "changed").alias("problem")).where("problem is not null")


def only_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that both sides have exactly once."""
    once = lambda df: df.groupBy(key).agg(F.count("*").alias("__n")).where("__n = 1").select(key)
    return once(left).join(once(right), key)


def resolved(rows: DataFrame, exact: str, loose: str, index: DataFrame, exact_key: str, loose_key: str, value: str) -> DataFrame:
    """``rows`` with ``match``: the index entry by the exact name, else the only one by the loose name."""
    by_name = index.groupBy(F.col(exact_key).alias("__exact")).agg(F.min(value).alias("__a"))
    by_base = index.groupBy(F.col(loose_key).alias("__loose")).agg(F.min(value).alias("__b"), F.count("*").alias("__n")).where("__n = 1").drop("__n")
    out = rows.join(by_name, F.col(exact) == F.col("__exact"), "left").join(by_base, F.col(loose) == F.col("__loose"), "left")
    return out.withColumn("match", F.coalesce("__a", "__b")).drop("__exact", "__loose", "__a", "__b")


def metric_table(rows: DataFrame, group: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Counts of each kind by group, as columns, and their sum."""
    wide = rows.groupBy(group).pivot(kind, list(kinds)).count().na.fill(0, list(kinds))
    return wide.withColumn("total", sum((F.col(k) for k in kinds[1:]), F.col(kinds[0])))


def long_table(wide: DataFrame, section: str, name: str) -> DataFrame:
    """``section, name, metric, value`` of a wide table of counts."""
    metrics = [c for c in wide.columns if c != name]
    return wide.unpivot(name, metrics, "metric", "value").select(F.lit(section).alias("section"), F.col(name).cast("string").alias("name"), "metric", "value")


def finite_metrics(values: Column, required: Sequence[str]) -> Column:
    """Of a map of metrics the required ones that are missing, null or not finite."""
    bad = [F.when(F.coalesce(F.isnan(F.try_element_at(values, F.lit(k))) | (F.abs(F.try_element_at(values, F.lit(k))) == float("inf")), F.lit(True)), k) for k in required]
    return F.array_compact(F.array(*bad))


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """``rows``, or an error where there are none."""
    if rows.isEmpty():
        raise ValueError(f"no {what}")
    return rows


def require(found: DataFrame, what: str) -> None:
    """An error that names the first violations where there are any."""
    some = [tuple(r) for r in found.limit(5).collect()]  # examples for the message
    if some:
        raise ValueError(f"{what}: {some}")


def forbidden_path(path: Column, parts: Sequence[str]) -> Column:
    """Whether a path leads through a folder or file of such a name."""
    return F.exists(F.split(path, "/"), lambda p: p.isin(*parts))


def same_twice(build: Callable[[], DataFrame]) -> bool:
    """Whether a plan that is run twice gives the same rows, repeated ones counted, in any order."""

    def state() -> tuple:
        df = build()
        row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        return tuple(df.agg(F.count("*"), F.bit_xor(row), F.sum(row.cast("decimal(38,0)"))).first())

    return state() == state()


def lock_problems(locks: DataFrame, expected: Mapping[str, object]) -> DataFrame:
    """``field, found, expected`` of every field in which a lock differs from what a run needs; none may be missing."""
    lit = lambda v: F.lit(None if v is None else str(v))
    rows = [F.struct(F.lit(k).alias("field"), (F.col(k).cast("string") if k in locks.columns else F.lit(None).cast("string")).alias("found"), lit(v).alias("expected")) for k, v in expected.items()]
    return locks.select(F.inline(F.array(*rows))).where(~F.col("found").eqNullSafe(F.col("expected")))


def split_counts(rows: DataFrame, split: str, masks: str, expected: Mapping[str, tuple[int, int]]) -> DataFrame:
    """``split, images, masks`` where they are not the expected numbers."""
    have = rows.groupBy(split).agg(F.count("*").alias("images"), F.coalesce(F.sum(masks), F.lit(0)).alias("masks"))
    want = rows.sparkSession.createDataFrame([(k, *v) for k, v in expected.items()], f"{split} string, want_images long, want_masks long")  # one row a split
    both = have.join(want, split, "full")
    return both.where(~F.col("images").eqNullSafe(F.col("want_images")) | ~F.col("masks").eqNullSafe(F.col("want_masks")))
