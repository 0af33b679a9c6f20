"""Splits without leakage: groups of related records, their assignment, and what crosses the splits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from curata.operators.graph import contracted_components
from curata.operators.relational import hamming_join, hamming_links
from curata.storage import materialize

SPLITS = ("train", "val", "test")
#: Groups that are assigned together in one task.
BLOCK_GROUPS = 2_000
#: What a squared deviation weighs; other counts weigh 1, other shares 2.
WEIGHTS = {"images": 18.0, "masks": 8.0, "border_images": 2.0, "multi_instance_images": 3.0}
SOURCE_WEIGHT, AREA_WEIGHT, SHARE_WEIGHT = 12.0, 4.0, 2.0


def related(records: DataFrame, key: str, equal: Sequence[Sequence[str]], hashed: str | None = None, most: int = 4, carry: Sequence[str] = ()) -> DataFrame:
    """``key, group_root`` and the columns of ``carry``: components over equal signals (blank ones never tie, several columns together always do) and near hashes."""
    edges = None
    for signal in equal:
        rows = records.where(F.col(signal[0]).isNotNull() & (F.col(signal[0]) != "")) if len(signal) == 1 else records
        value = F.struct(*signal)
        low = rows.groupBy(value.alias("__value")).agg(F.min(key).alias("dst"))
        star = rows.select(F.col(key).alias("src"), value.alias("__value")).join(low, "__value").select("src", "dst").where("src != dst")
        edges = star if edges is None else edges.unionAll(star)
    if hashed:
        edges = edges.unionAll(hamming_links(records.select(key, hashed), key, hashed, most))
    found = contracted_components(edges)
    return records.select(key, *carry).join(found, F.col(key) == F.col("node"), "left").select(key, *carry, F.coalesce("component", key).alias("group_root"))


def group_ids(members: DataFrame, root: str, order: str, digest: str) -> DataFrame:
    """``root, group_id, group_size``: an id from the members' digests, joined by line breaks in order.

    The joined text is hashed as its members stream by, so it is never built,
    however large the group.
    """
    out = T.StructType([members.schema[root], T.StructField("group_id", T.StringType()), T.StructField("group_size", T.LongType())])
    arrow = to_arrow_schema(out)
    rows = members.select(root, order, digest).repartition(root).sortWithinPartitions(root, order, digest)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        at, whole, size, some = None, None, 0, False

        def ready() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
            done.clear()
            return batch

        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if whole is None or group != at:
                    if whole is not None:
                        done.append((at, "grp_" + whole.hexdigest()[:16], size))
                    at, whole, size, some = group, hashlib.sha256(), 0, False
                if text is not None:
                    whole.update(("\n" + text if some else text).encode())
                    some = True
                size += 1
            if done:
                yield ready()
        if whole is not None:
            done.append((at, "grp_" + whole.hexdigest()[:16], size))
            yield ready()

    return rows.select(root, digest).mapInArrow(digested, out)


def group_features(records: DataFrame, group: str, counts: Mapping[str, Column], shares: Mapping[str, Column]) -> DataFrame:
    """``group, feature, n``: sums of the counts and occurrences of the shares' values, zero ones left out."""
    parts = [F.struct(F.lit(k).alias("feature"), v.cast("long").alias("n")) for k, v in counts.items()]
    parts += [F.struct(F.concat(F.lit(k + ":"), F.coalesce(v.cast("string"), F.lit(""))).alias("feature"), F.lit(1).cast("long").alias("n")) for k, v in shares.items()]
    rows = records.select(group, F.inline(F.array(*parts)))
    return rows.groupBy(group, "feature").agg(F.sum("n").alias("n")).where("n > 0")


def _weight(feature: str) -> float:
    if feature.startswith("source:"):
        return SOURCE_WEIGHT
    if feature.startswith("area:"):
        return AREA_WEIGHT
    return WEIGHTS.get(feature, SHARE_WEIGHT if ":" in feature else 1.0)


def _digest(*parts: object) -> str:
    return hashlib.sha256("\0".join(map(str, parts)).encode()).hexdigest()


def targets(total: int, ratios: Sequence[float]) -> list[int]:
    """Whole numbers in the ratios that sum to ``total``; what is left goes to the largest remainders, ties to the first."""
    exact = [total * r for r in ratios]
    whole = [int(e) for e in exact]
    order = sorted(range(len(ratios)), key=lambda k: (whole[k] - exact[k], k))
    for k in order[: total - sum(whole)]:
        whole[k] += 1
    return whole


class Assignment:
    """Groups, as rows of a count matrix, in splits whose sums are near ``ratios`` of the whole."""

    def __init__(self, ids: Sequence[str], features: Sequence[str], counts: np.ndarray, ratios: Sequence[float], seed: int):
        self.ids, self.counts, self.seed = list(ids), counts.astype(np.float64), seed
        self.total = self.counts.sum(0)
        goal = np.outer(ratios, self.total)
        self.goal, self.scale = goal, np.array([_weight(f) for f in features]) / np.maximum(1.0, goal)
        self.images = self.counts[:, list(features).index("images")]
        self.wanted = targets(int(self.images.sum()), ratios)
        spread = [k for k, f in enumerate(features) if f.startswith(("source:", "orientation:", "resolution:", "area:"))]
        rarity = (self.counts[:, spread] / np.maximum(1, self.total[spread])).sum(1)
        masks = self.counts[:, list(features).index("masks")] if "masks" in features else np.zeros(len(ids))
        rank = [_digest(seed, i) for i in self.ids]
        self.order = sorted(range(len(self.ids)), key=lambda k: (-self.images[k], -rarity[k], -masks[k], rank[k]))
        self.state = np.zeros_like(goal)
        self.split = np.zeros(len(self.ids), np.int64)
        self.swapped = np.zeros(len(self.ids), bool)

    def cost(self, split: int, states: np.ndarray) -> np.ndarray:
        """Weighted squared deviations of states of a split from its goal."""
        return ((states - self.goal[split]) ** 2 * self.scale[split]).sum(-1)

    def greedy(self) -> None:
        """Each group, large and rare ones first, to where the deviations grow least; too many images cost extra."""
        largest = max(1.0, self.images.max(initial=1))
        held = np.zeros(len(self.goal))
        for k in self.order:
            best = None
            for s in range(len(self.goal)):
                over = max(0.0, held[s] + self.images[k] - self.wanted[s])
                rise = float(self.cost(s, self.state[s] + self.counts[k]) - self.cost(s, self.state[s])) + 1000.0 * (over / largest) ** 2
                rank = (round(rise, 9), int(_digest(self.seed, self.ids[k], SPLITS[s]), 16))
                if best is None or rank < best[0]:
                    best = (rank, s)
            s = best[1]
            self.split[k] = s
            self.state[s] += self.counts[k]
            held[s] += self.images[k]

    def swap(self, rounds: int = 6) -> None:
        """Exchange groups of equal size between two splits where that lowers the cost, best partner first.

        Groups of equal counts cost the same, so one of them is tried, as a
        partner the first by its id, and not again until one of the two splits
        has changed.
        """
        by_id = np.argsort(np.array(self.ids, dtype=object))
        kind = np.unique(self.counts, axis=0, return_inverse=True)[1].ravel()
        age = [0] * len(self.goal)
        vain: dict[tuple, tuple] = {}  # the ages of two splits when no partner in the second was found for a kind in the first
        for _ in range(rounds):
            improved = False
            for a in range(len(self.goal)):
                for b in range(a + 1, len(self.goal)):
                    firsts, seconds = (by_id[self.split[by_id] == s] for s in (a, b))
                    partners: dict[float, tuple] = {}
                    swapped = False
                    for k in firsts:
                        if vain.get((a, b, kind[k])) == (age[a], age[b]):
                            continue
                        size = self.images[k]
                        if size not in partners:
                            others = seconds[(self.split[seconds] == b) & (self.images[seconds] == size)]
                            others = others[np.sort(np.unique(kind[others], return_index=True)[1])]
                            partners[size] = others, self.counts[others]
                        others, theirs = partners[size]
                        if len(others):
                            moved = theirs - self.counts[k]
                            trial = self.cost(a, self.state[a] + moved) + self.cost(b, self.state[b] - moved)
                            at = int(trial.argmin())  # the first of equals, and those are in the order of their ids
                            if trial[at] + 1e-12 < self.cost(a, self.state[a]) + self.cost(b, self.state[b]):
                                j = int(others[at])
                                self.state[a] = self.state[a] + moved[at]
                                self.state[b] = self.state[b] - moved[at]
                                self.split[k], self.split[j] = b, a
                                self.swapped[[k, j]] = True
                                improved = swapped = True
                                age[a], age[b] = age[a] + 1, age[b] + 1
                                partners.clear()
                                continue
                        vain[a, b, kind[k]] = age[a], age[b]
                    if swapped:  # the next list of seconds has those that came
                        age[a], age[b] = age[a] + 1, age[b] + 1
            if not improved:
                return


def assign_splits(features: DataFrame, group: str, ratios: Sequence[float] = (0.7, 0.15, 0.15), seed: int = 42, block: int = BLOCK_GROUPS) -> DataFrame:
    """``group, split, reason`` of every group of ``group_features``: balanced by images first, then by all other counts.

    The choice for a group depends on all before it, so groups are dealt by a
    hash into blocks of about ``block``, each of which is balanced by itself:
    up to that many groups it is one assignment over all of them, beyond that
    the deviations of the blocks, each below one group, add up.
    """
    if len(ratios) != len(SPLITS) or abs(sum(ratios) - 1) > 1e-9:
        raise ValueError("ratios must be three and sum to 1")
    features = materialize(features, "features")
    blocks = max(1, -(-features.select(group).distinct().count() // block))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, names = np.unique(pdf[group].astype(str)), np.unique(pdf.feature)
        counts = np.zeros((len(ids), len(names)))
        counts[np.searchsorted(ids, pdf[group].astype(str)), np.searchsorted(names, pdf.feature)] = pdf.n
        a = Assignment(ids.tolist(), names.tolist(), counts, ratios, seed)
        a.greedy()
        a.swap()
        return pd.DataFrame({group: ids, "split": [SPLITS[s] for s in a.split], "reason": np.where(a.swapped, "greedy+equal_size_swap", "greedy")})

    dealt = features.withColumn(group, F.col(group).cast("string")).withColumn("__block", F.pmod(F.xxhash64(group), F.lit(blocks)))
    return dealt.groupBy("__block").applyInPandas(lambda pdf: place(pdf), f"{group} string, split string, reason string")


def preserved_problems(records: DataFrame, key: str, group: str, kept: DataFrame) -> DataFrame:
    """``problem, value``: keys without an old split, old keys that are gone, unknown splits, groups in several."""
    both = records.select(key, group).join(kept.select(key, "split"), key, "full")
    text = lambda c: F.col(c).cast("string").alias("value")
    missing = records.join(kept, key, "left_anti").select(F.lit("missing").alias("problem"), text(key))
    extra = kept.join(records, key, "left_anti").select(F.lit("extra").alias("problem"), text(key))
    invalid = kept.where(~F.col("split").isin(*SPLITS)).select(F.lit("invalid").alias("problem"), text(key))
    crossing = both.where(F.col(group).isNotNull() & F.col("split").isNotNull()).groupBy(group).agg(F.min("split").alias("x"), F.max("split").alias("y")).where("x != y")
    return missing.unionAll(extra).unionAll(invalid).unionAll(crossing.select(F.lit("crossing").alias("problem"), text(group)))


def crossing_values(records: DataFrame, signals: Sequence[tuple[str, str]], split: str = "split") -> DataFrame:
    """``leakage_type, value, splits, n`` of values, blank ones too, that lie in several splits."""
    out = None
    for name, column in signals:
        value = F.coalesce(F.col(column).cast("string"), F.lit(""))
        per = records.groupBy(value.alias("value"), split).agg(F.count("*").alias("c"))
        one = per.groupBy("value").agg(F.array_join(F.array_sort(F.collect_list(split)), "|").alias("splits"), F.sum("c").alias("n"), F.count("*").alias("k")).where("k > 1")
        one = one.select(F.lit(name).alias("leakage_type"), "value", "splits", "n")
        out = one if out is None else out.unionAll(one)
    return out


def crossing_pairs(records: DataFrame, key: str, hashed: str, most: int, split: str = "split") -> DataFrame:
    """``a, b, splits, distance`` of near hashes in different splits, ``a`` before ``b``."""
    near = hamming_join(records, records, key, hashed, most, once=True, carry=[split])
    both = near.where(F.col(f"a_{split}") != F.col(f"b_{split}"))
    return both.select("a", "b", F.concat_ws("|", f"a_{split}", f"b_{split}").alias("splits"), "distance")


def held_out_matches(records: DataFrame, held: DataFrame, key: str, equal: Sequence[tuple[str, str]], hashed: str, most: int) -> DataFrame:
    """``leakage_type, key, held_key, distance``: one row for every signal by which a record meets the held-out set."""
    out = None
    for name, column in equal:
        left = records.where(F.col(column).isNotNull() & (F.col(column) != "")).select(F.col(key).alias("record"), column)
        one = left.join(held.select(F.col(key).alias("held"), column), column).select(F.lit(name).alias("leakage_type"), "record", "held", F.lit(None).cast("int").alias("distance"))
        out = one if out is None else out.unionAll(one)
    near = hamming_join(records, held, key, hashed, most)
    return out.unionAll(near.select(F.lit("perceptual_near").alias("leakage_type"), F.col("a").alias("record"), F.col("b").alias("held"), "distance"))


def partition_overlap(rows: DataFrame, split: str, signals: Sequence[str]) -> DataFrame:
    """``left_split, right_split, signal, shared``: distinct values of each signal that two partitions have."""
    out = None
    for s in signals:
        values = rows.where(F.col(s).isNotNull() & (F.col(s).cast("string") != "")).groupBy(F.col(s).cast("string").alias("value")).agg(F.array_sort(F.collect_set(split)).alias("in"))
        pairs = F.flatten(F.transform("in", lambda a: F.transform(F.filter("in", lambda b: b > a), lambda b: F.struct(a.alias("left_split"), b.alias("right_split")))))
        one = values.where(F.size("in") > 1).select(F.inline(pairs)).groupBy("left_split", "right_split").agg(F.count("*").alias("shared")).withColumn("signal", F.lit(s))
        out = one if out is None else out.unionByName(one)
    return out


def split_summary(rows: DataFrame, split: str, sums: Sequence[str]) -> DataFrame:
    """Rows, share of all and sums of each split; a window over one row per split."""
    per = rows.groupBy(split).agg(F.count("*").alias("images"), *[F.sum(c).alias(c) for c in sums])
    return per.withColumn("share", F.col("images") / F.sum("images").over(Window.partitionBy()))


def split_records(images: DataFrame, label_files: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images with their labels and manifest rows, and what keeps them from being whole.

    ``images`` and ``label_files`` have ``stem``, the manifest ``stem`` and
    ``image_sha256``; problems are (problem, stem): a part that is missing, a
    manifest that says two things of one image, a digest that changed.
    """
    said = manifest.groupBy("stem").agg(F.min("image_sha256").alias("__a"), F.max("image_sha256").alias("__b"))
    sides = {"image": images.select("stem"), "label": label_files.select("stem"), "manifest": manifest.select("stem")}
    every = None
    for s in sides.values():
        every = s if every is None else every.unionAll(s)
    every = every.distinct()
    found = said.where("__a != __b").select(F.lit("contradicting_manifest").alias("problem"), "stem")
    for name, side in sides.items():
        found = found.unionAll(every.join(side, "stem", "left_anti").select(F.lit(f"no_{name}").alias("problem"), "stem"))
    changed = images.join(said, "stem").where("sha256 != __a").select(F.lit("changed_image").alias("problem"), "stem")
    once = manifest.dropDuplicates(["stem"])  # rows that agree, or else a problem
    return images.join(label_files, "stem").join(once, "stem"), found.unionAll(changed)
