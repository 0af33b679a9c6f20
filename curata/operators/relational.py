"""DataFrame operators for curation: duplicates, near pairs, leakage, samples, splits and roll-ups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.functions.hashing import hamming, seeded_rank
from curata.storage import materialize


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` and ``is_first``: whether a row is its key's first by ``order``.

    The first row is a pre-aggregated minimum that is joined back, so a key
    with a third of all rows never meets in one task as a window would make it.
    """
    first = df.groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    return df.join(first, key).withColumn("is_first", F.struct(*order) == F.col("__first")).drop("__first")


def numbered(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """``df`` and each row's position (from 1) by ``order``, in its group or in all.

    Rows are range-partitioned by group and order, counted by partition, and
    numbered within partitions from the counts before them: neither a hot group
    nor the whole table meets in one task.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    counts = ranged.groupBy(*group, "__part").agg(F.count("*").alias("__n"))  # one row per group and partition
    frame = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*group, "__part", F.coalesce(F.sum("__n").over(frame), F.lit(0)).alias("__before"))
    on = F.col("r.__part") == F.col("b.__part")
    for g in group:
        on = on & F.col(f"r.{g}").eqNullSafe(F.col(f"b.{g}"))
    own = F.row_number().over(Window.partitionBy(*[f"r.{g}" for g in group], "r.__part").orderBy(*[f"r.{c}" for c in order]))
    rows = ranged.alias("r").join(before.alias("b"), on)
    return rows.select(*[F.col(f"r.{c}") for c in df.columns], (own + F.col("b.__before")).alias(name))


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """Keys with two rows or more: their size and a number by key order."""
    return numbered(df.groupBy(key).agg(F.count("*").alias("size")).where("size > 1"), [key], "number")


def _masks(values: DataFrame, name: str, n: int, bits: int, whole: bool = False) -> tuple[list[int], list[int]]:
    """``n`` masks that deal ``bits`` bits evenly by how much they tell, and the bits that differ between the values at all.

    With ``whole`` the last slice, which is compared as it is only, tells as
    much less than another as brings either as many candidates.
    """
    ones = values.agg(F.count("*"), *[F.sum(F.shiftrightunsigned(name, i).bitwiseAND(F.lit(1))) for i in range(bits)]).first()
    share = [(c or 0) / max(1, ones[0]) for c in ones[1:]]
    told = [-math.log2(p * p + (1 - p) * (1 - p)) for p in share]
    masks, load = [0] * n, [0.0] * n
    if whole:
        load[-1] = math.log2(1 + sum(0 < p < 1 for p in share) / n)
    for i in sorted(range(bits), key=lambda i: -told[i]):
        k = load.index(min(load))
        masks[k] |= 1 << i
        load[k] += told[i]
    return masks, [i for i in range(bits) if 0 < share[i] < 1]


def _near_values(left: DataFrame, right: DataFrame | None, most: int, bits: int, ends: str | None = None) -> DataFrame:
    """``x, y, distance`` of distinct values x of left and y of right that differ in at most ``most`` bits; x <= y of left alone without ``right``.

    With ``ends``, another column of left, it is ``src, dst``: that column of
    two different values, which then need not be joined to it again.
    """
    spare = most % 2 == 0  # then two slices differ in exactly one bit, or one in none
    masks, varying = _masks(left.select("x") if right is None else left.select("x").union(right.select("y")).distinct(), "x", most // 2 + 1, bits, spare)
    signed = lambda v: F.lit(v - (1 << 64) if v >> 63 else v)
    column = lambda at, mask, bit: F.struct(F.lit(at).alias("slice"), signed(mask).alias("mask"), signed(bit).alias("bit"))
    whole = F.array(*[column(k, m, 0) for k, m in enumerate(masks)])
    single = [column(k, m, 1 << i) for k, m in enumerate(masks[:-1] if spare else masks) for i in varying if m >> i & 1]

    def keyed(df: DataFrame, name: str, own: bool, less: bool) -> DataFrame:
        """Slices of a value as they are (``own``) and with one of their ones taken out (``less``)."""
        v = F.col(name)
        taken = F.filter(F.array(*single), lambda s: v.bitwiseAND(s["bit"]) != 0) if less and single else F.slice(whole, 1, 0)
        parts = F.transform(F.concat(whole, taken) if own else taken, lambda s: F.struct(s["slice"].alias("slice"), v.bitwiseAND(s["mask"]).bitwiseXOR(s["bit"]).alias("part")))
        return df.select(*df.columns, F.inline(parts))

    differ = F.col("x").bitwiseXOR(F.col("y"))
    first = F.lit(True)
    for k, m in enumerate(masks[:-1]):
        first = first & ((F.lit(k) >= F.col("slice")) | (F.bit_count(differ.bitwiseAND(signed(m))) > 1))
    close = (F.bit_count(differ) <= most) & first
    on = ["part", "slice"]  # a sort compares the first of them before it looks at rows
    if right is None:
        same = F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.element_at(F.array(*[signed(m) for m in masks]), F.col("slice") + 1)) == 0
        other = left.select(F.col("x").alias("y"), *[F.col(c).alias("dst") for c in (ends,) if c])
        own = left.select("x", *[F.col(c).alias("src") for c in (ends,) if c])
        found = keyed(own, "x", True, True).join(keyed(other, "y", True, False), on).where(close & (~same | (F.col("x") <= F.col("y"))))
        if ends:
            return found.where("x != y").select("src", "dst")
        found = found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    else:
        found = keyed(left, "x", True, True).join(keyed(right, "y", True, False), on).where(close)
        found = found.select("x", "y").unionAll(keyed(left, "x", True, False).join(keyed(right, "y", False, True), on).where(close).select("x", "y"))
    return found.select("x", "y", hamming(F.col("x"), F.col("y")).alias("distance"))


def hamming_join(left: DataFrame, right: DataFrame, key: str, value: str, most: int, bits: int = 64, once: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Pairs of keys ``a`` of left and ``b`` of right whose ``bits``-bit values differ in at most ``most`` bits, and the distance.

    Pigeonhole: of ``most // 2 + 1`` slices of the value one differs in one bit
    or none, and then one of the two has a one where the other has none.  So an
    equi-join on (slice number, slice) finds every pair, if slices come as they
    are and with each of their ones taken out; the distance is the residual
    condition and a pair is kept at its first such slice only.  If ``most`` is
    even and no slice is equal, two of them differ in one bit, so the last slice
    comes only as it is.  The bits are
    dealt to the slices by how much they tell, since a slice of bits that are
    nearly constant would bring all rows together.  Only distinct values are
    compared; keys come in at the end, where the pairs asked for are listed.
    With ``once``, for one table with itself, only pairs ``a < b`` are given.
    ``carry`` names columns that come along as ``a_<name>`` and ``b_<name>``.
    Null values are near nothing.
    """
    kept = list(dict.fromkeys([key, value, *carry]))
    read = lambda df: materialize(df.select(*kept), "hashes").where(F.col(value).isNotNull())
    first = read(left)
    second = first if right is left else read(right)
    member = F.struct(F.col(key).alias("key"), *[F.col(c).alias(c) for c in carry])
    x = first.select(F.col(value).alias("x"), member.alias("p"))
    y = second.select(F.col(value).alias("y"), member.alias("q"))
    alone = once and right is left
    near = _near_values(x.select("x").distinct(), None if alone else y.select("y").distinct(), most, bits)
    pairs = near.join(x, "x").join(y, "y")
    if alone:
        pairs = pairs.where((F.col("p.key") < F.col("q.key")) | ((F.col("x") != F.col("y")) & (F.col("p.key") != F.col("q.key"))))
        pairs = pairs.select("distance", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
    elif once:
        pairs = pairs.where("p.key < q.key")
    ends = [F.col(f"{s}.{c}").alias(f"{n}_{c}") for c in carry for s, n in (("p", "a"), ("q", "b"))]
    return pairs.select(F.col("p.key").alias("a"), F.col("q.key").alias("b"), "distance", *ends)


def hamming_pairs(df: DataFrame, key: str, value: str, most: int, bits: int = 64) -> DataFrame:
    """Pairs ``a < b`` of keys whose values differ in at most ``most`` bits, and the distance."""
    return hamming_join(df, df, key, value, most, bits, once=True)


def hamming_links(df: DataFrame, key: str, value: str, most: int, bits: int = 64) -> DataFrame:
    """Links ``src, dst`` that connect the same keys as all pairs do, without listing the pairs of equal values."""
    stars = materialize(df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("x")).agg(F.min(key).alias("root")), "hashes")
    roots = stars.select(F.col("x").alias("__value"), F.col("root").alias("__root"))
    equal = df.join(roots, F.col(value) == F.col("__value")).select(F.col(key).alias("src"), F.col("__root").alias("dst")).where("src != dst")
    return equal.unionAll(_near_values(stars, None, most, bits, "root"))


def values_across(df: DataFrame, value: str, split: str) -> DataFrame:
    """Values that lie in several splits."""
    found = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.array_sort(F.collect_set(split)).alias("splits"), F.count("*").alias("n"))
    return found.where(F.size("splits") > 1)


def hash_top(df: DataFrame, group: str, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """A sample of ``n`` rows of each group that is the same in every run."""
    order = Window.partitionBy(group).orderBy(seeded_rank(seed, F.col(key)), key)
    return df.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def round_robin(df: DataFrame, group: str, order: Sequence[str], quota: int) -> DataFrame:
    """Rows taken from the groups in turn until ``quota`` are taken (a quota is the feature).

    No group gives more than ``quota``, so what comes later is dropped before
    groups are ranked.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("turn", place).where(F.col("turn") <= quota).orderBy("turn", group, *order).limit(quota)


def oversample(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Every group repeated in order up to the size of the largest: ``copy`` numbers the rounds."""
    sizes = df.groupBy(group).agg(F.count("*").alias("__n"))
    most = sizes.agg(F.max("__n").alias("__m"))
    rows = numbered(df, order, "__i", [group]).withColumn("__i", F.col("__i") - 1)
    rows = rows.join(sizes, group).join(F.broadcast(most))  # one row
    times = F.floor((F.col("__m") - F.col("__i") - 1) / F.col("__n")).cast("int")
    return rows.where(F.col("__i") < F.col("__m")).withColumn("copy", F.explode(F.sequence(F.lit(0), times))).drop("__i", "__n", "__m")


def snap_down(value: Column, limits: Sequence[float]) -> Column:
    """The largest of the limits that a value reaches, -1 below all: it compares with each limit (``>=``, ``<``) as the value does."""
    out = F.when(value.isNull(), None)
    for x in sorted(limits, reverse=True):
        out = out.when(value >= x, float(x))
    return out.otherwise(-1.0)


def snap_up(value: Column, limits: Sequence[float]) -> Column:
    """The smallest limit that a value does not pass, infinite beyond all: it compares with each limit (``>``) as the value does."""
    out = F.when(value.isNull(), None)
    for x in sorted(limits):
        out = out.when(value <= x, float(x))
    return out.otherwise(float("inf"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], bins: int = 4096) -> DataFrame:
    """Linearly interpolated quantiles per group: ``keys, n, lo, hi, q`` (an array in the order of ``shares``).

    Values are counted in ``bins`` equal steps between a group's extremes; only
    the steps that hold an asked rank are looked at value by value, so no task
    holds a group's values.  Nulls are not counted.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    ends = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))  # one row per group
    step = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("__v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)).otherwise(0)
    counted = rows.join(ends, keys).withColumn("__bin", step).groupBy(*keys, "__bin", "__v").agg(F.count("*").alias("__c"))
    counted = materialize(counted, "values")
    per_bin = counted.groupBy(*keys, "__bin").agg(F.sum("__c").alias("__b"))
    frame = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bin.select(*keys, "__bin", "__b", F.coalesce(F.sum("__b").over(frame), F.lit(0)).alias("__before"))
    wanted = F.array(*[F.struct(F.lit(i).alias("__i"), F.lit(float(p)).alias("__p"), F.lit(o).alias("__o")) for i, p in enumerate(shares) for o in (0, 1)])
    ranks = ends.select(*keys, "n", F.inline(wanted))
    exact = (F.col("n") - 1) * F.col("__p")
    ranks = ranks.withColumn("__rank", F.least(F.floor(exact) + F.col("__o"), F.col("n") - 1)).withColumn("__part", exact - F.floor(exact))
    place = ranks.join(before, keys).where("__rank >= __before and __rank < __before + __b")
    inner = Window.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.join(place.select(*keys, "__bin").distinct(), [*keys, "__bin"], "left_semi")
    inside = inside.withColumn("__first", F.coalesce(F.sum("__c").over(inner), F.lit(0)))
    found = place.join(inside, [*keys, "__bin"]).where("__rank - __before >= __first and __rank - __before < __first + __c")
    weight = F.when(F.col("__o") == 0, 1 - F.col("__part")).otherwise(F.col("__part"))
    per = found.groupBy(*keys, "__i").agg(F.sum(weight * F.col("__v")).alias("__q"))
    per = per.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", "__q"))), lambda s: s["__q"]).alias("q"))
    return ends.join(per, keys)


def largest_remainder(total: Column, shares: Sequence[float]) -> list[Column]:
    """Whole numbers in the shares that sum to ``total``; left-over units go to the largest remainders, ties to the first."""
    exact = [total * s for s in shares]
    base = [F.floor(e) for e in exact]
    left = total - sum(base[1:], base[0])
    rest = [e - b for e, b in zip(exact, base)]
    out = []
    for i in range(len(shares)):
        before = sum(((F.when((rest[j] > rest[i]) if j > i else (rest[j] >= rest[i]), 1).otherwise(0)) for j in range(len(shares)) if j != i), F.lit(0))
        out.append((base[i] + F.when(before < left, 1).otherwise(0)).cast("long"))
    return out


def equal_width_histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Bin numbers and counts between minimum and maximum; the last bin is closed."""
    edge = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    rows = df.where(F.col(value).isNotNull()).join(F.broadcast(edge))  # one row
    step = (F.col("hi") - F.col("lo")) / bins
    number = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / F.when(step > 0, step)))).otherwise(0)
    return rows.groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def within(left: DataFrame, right: DataFrame, on: Sequence[str], a: str, b: str, most: float) -> DataFrame:
    """Join on equal keys and values that differ by at most ``most``: buckets of that width meet their neighbours."""
    wide = lambda c: F.floor(F.col(c) / most)
    near = left.withColumn("__bucket", F.explode(F.array(wide(a) - 1, wide(a), wide(a) + 1)))
    both = near.join(right.withColumn("__bucket", wide(b)), [*on, "__bucket"])
    return both.where(F.abs(F.col(a) - F.col(b)) <= most).drop("__bucket")


def unique_match(both: DataFrame, key: str, pick: str) -> DataFrame:
    """Of matches the one of each key that has only one; keys with several are left out."""
    return both.groupBy(key).agg(F.count("*").alias("candidates"), F.min(pick).alias(pick)).where("candidates = 1").drop("candidates")
