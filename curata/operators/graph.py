"""Connected components: alternating large-star and small-star passes, and contraction by tasks before them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.storage import discard, materialize

#: Edges that a task folds at once.
FOLD_EDGES = 1 << 20


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has a link: columns ``node`` and ``component``.

    Each round links every neighbour to the smallest node it can see, first
    upwards and then downwards, until all components are stars.  Minima are
    pre-aggregated before the shuffle and joined back, so a node with a third
    of all links is split by adaptive execution; no neighbour list is built.
    Links with a null end and self-links are ignored; nodes without any other
    link are not returned.
    """
    pair = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a != b")
    current = materialize(pair.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    state = _state(current)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = materialize(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        seen = _state(step)
        discard(large)
        discard(current)
        current = step
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _fold(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges but the smallest of its component, and that smallest one."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    own = np.arange(len(ids))
    low, a, b = own.copy(), at[: len(u)], at[len(u) :]
    while len(a):
        a, b = low[a], low[b]
        a, b = a[a != b], b[a != b]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    left = low != own
    return ids[left], ids[low[left]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's edges with the smallest that it reaches there; what has grown too large goes out by itself."""
    u = v = np.zeros(0, np.int64)
    some, n = [], 0

    def folded() -> tuple[np.ndarray, np.ndarray]:
        both = [np.concatenate([old, *(b.column(k).to_numpy() for b in some)]) for k, old in enumerate((u, v))]
        some.clear()
        return _fold(*both)

    def rows() -> pa.RecordBatch:
        roots = np.unique(v)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in ((u, roots), (v, roots))], names=["u", "v"])

    for batch in batches:
        some.append(batch)
        n += batch.num_rows
        if n >= FOLD_EDGES:
            (u, v), n = folded(), 0
            if len(u) >= FOLD_EDGES:
                yield rows()
                u = v = np.zeros(0, np.int64)
    u, v = folded()
    yield rows()


def contracted_components(edges: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """``connected_components`` of whole numbers in fewer passes.

    Every task links the nodes of its edges to the smallest that they reach
    within the task.  A node takes the smallest of what its tasks say; only
    where they say different things an edge remains, between those answers, and
    goes into the next pass.  When a pass no longer halves the edges, star
    passes do the rest.  Within a pass no node has more answers than there are
    tasks.
    """
    kind = edges.schema[left].dataType
    rest = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).where("u != v")
    node = Window.partitionBy("u").orderBy("v")
    levels: list[DataFrame] = []
    before = None
    while True:
        told = rest.mapInArrow(_forest, "u long, v long")
        level = materialize(told.select("u", "v", F.min("v").over(node).alias("m"), F.row_number().over(node).alias("k")), "cc")
        levels.append(level.where("k = 1").select(F.col("u").alias("node"), F.col("m").alias("component")))
        rest = level.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        count = rest.count()
        if not count or (before is not None and 2 * count > before):
            break
        before = count
        rest = rest.repartition(F.xxhash64("u", F.lit(len(levels))))  # others meet in each pass; no v, which may be common, decides
    if count:
        levels.append(connected_components(rest, "u", "v"))
    found = levels.pop()
    while levels:
        up = found.select(F.col("node").alias("__node"), F.col("component").alias("__root"))
        found = levels.pop().join(up, F.col("component") == F.col("__node"), "left").select("node", F.coalesce("__root", "component").alias("component"))
    return found.select(*[F.col(c).cast(kind).alias(c) for c in ("node", "component")])
