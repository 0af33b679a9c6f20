"""Embedding near-duplicates with a hierarchical navigable small-world graph per shard.

Vectors are compared only within a label.  Each label is cut into shards of
bounded size, each shard gets a graph, and every vector of the label queries
every shard.  A beam is widened while links fill it, and for all queries until
an audit of sampled vectors against brute force finds every link; distances
are then verified in double precision, and links are united to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import blob, tidy
from curata.llm.vectors import matrix, usable
from curata.operators.graph import connected_components
from curata.storage import materialize

SHARD_ROWS = 2048
DEGREE, BUILD_BEAM, FIRST_BEAM = 12, 48, 32
#: Sampled vectors of an audit, and the share of their links that must be found.
AUDIT, AUDIT_RECALL = 48, 0.999
#: Margin for float32 search before the check in double precision.
MARGIN = 1e-4


class Graph:
    """Layered neighbour lists over unit vectors; all searches run for a block of queries at once.

    Layer 0 holds every vector, layer ``l`` each with probability ``DEGREE**-l``
    (here: by a fixed random order).  ``near[l]`` is [n, width], -1 where empty.
    """

    def __init__(self, x: np.ndarray, near: list[np.ndarray] | None = None, entry: int = 0):
        self.x = x
        self.near = near or []
        self.entry = entry

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 11) -> Graph:
        n = len(x)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(np.maximum(rng.random(n), 1e-12)) / np.log(DEGREE)).astype(int), 4)
        order = np.argsort(-level, kind="stable")  # upper layers first, so that each layer grows from its own members
        top = int(level.max()) if n else 0
        self = cls(x, [np.full((n, DEGREE if k else 2 * DEGREE), -1, np.int32) for k in range(top + 1)], int(order[0]) if n else 0)
        at = 1
        while at < n:
            batch = order[at : at + max(1, min(256, at))]
            self._insert(batch, level[batch])
            at += len(batch)
        return self

    def _insert(self, batch: np.ndarray, level: np.ndarray) -> None:
        q = self.x[batch]
        inner = q @ q.T
        np.fill_diagonal(inner, -np.inf)
        start = np.full(len(batch), self.entry)
        for k in range(len(self.near) - 1, -1, -1):
            here = level >= k
            beam = BUILD_BEAM if here.any() else 1
            found, sims = self.search_layer(q, start[:, None], k, beam)
            start = found[:, 0]
            if not here.any():
                continue
            mates = np.where(here[None, :], inner[here], -np.inf)
            m = min(DEGREE, len(batch))
            top = np.argpartition(-mates, m - 1, axis=1)[:, :m]
            ids = np.concatenate([found[here], np.where(np.isfinite(np.take_along_axis(mates, top, 1)), batch[top], -1)], 1)
            s = np.concatenate([sims[here], np.take_along_axis(mates, top, 1)], 1)
            chosen = self._diverse(ids, s, DEGREE)
            own = batch[here]
            self.near[k][own, :DEGREE] = chosen
            self._link_back(own, chosen, k)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of candidates per row those nearer to the row than to one already chosen, then the nearest others."""
        sims = np.where(ids < 0, -np.inf, sims)
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 4 * most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        v = self.x[np.maximum(ids, 0)]
        between = v @ v.transpose(0, 2, 1)
        n, width = ids.shape
        taken = np.zeros((n, width), bool)
        for c in range(width):
            worst = np.where(taken, between[:, c, :], -np.inf).max(1)
            taken[:, c] = np.isfinite(sims[:, c]) & (sims[:, c] > worst) & (taken.sum(1) < most)
        rank = np.where(taken, 0, np.where(np.isfinite(sims), 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(np.where(np.isfinite(sims), ids, -1), order, 1)
        if out.shape[1] < most:
            out = np.concatenate([out, np.full((n, most - out.shape[1]), -1)], 1)
        return out.astype(np.int32)

    def _link_back(self, own: np.ndarray, chosen: np.ndarray, k: int) -> None:
        width = self.near[k].shape[1]
        source = np.repeat(own, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, starts, counts = np.unique(target, return_index=True, return_counts=True)
        if not len(nodes):
            return
        room = int(counts.max())
        extra = np.full((len(nodes), room), -1, np.int64)
        extra[np.repeat(np.arange(len(nodes)), counts), np.arange(len(target)) - np.repeat(starts, counts)] = source
        both = np.concatenate([self.near[k][nodes], extra], 1)
        both = np.sort(both, axis=1)[:, ::-1]
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        simple = (both >= 0).sum(1) <= width
        both_sorted = np.sort(both, axis=1)[:, ::-1]
        self.near[k][nodes[simple]] = both_sorted[simple][:, :width] if both.shape[1] >= width else -1
        crowded = np.flatnonzero(~simple)
        for s in range(0, len(crowded), 512):
            c = crowded[s : s + 512]
            ids = both_sorted[c]
            sims = np.einsum("nd,nmd->nm", self.x[nodes[c]], self.x[np.maximum(ids, 0)])
            self.near[k][nodes[c]] = self._diverse(ids, sims, width)

    def search_layer(self, q: np.ndarray, start: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest that a best-first walk from ``start`` [queries, any] meets, nearest first, -1 where fewer."""
        n, m = len(q), len(self.x)
        seen = np.zeros((n, m), bool)
        rows = np.arange(n)
        ids = np.full((n, beam), -1, np.int64)
        sims = np.full((n, beam), -np.inf, np.float32)
        width = min(beam, start.shape[1])
        s = np.einsum("nd,nmd->nm", q, self.x[np.maximum(start, 0)])
        s = np.where(start >= 0, s, -np.inf)
        order = np.argsort(-s, axis=1)[:, :width]
        ids[:, :width], sims[:, :width] = np.take_along_axis(start, order, 1), np.take_along_axis(s, order, 1)
        seen[rows[:, None], np.maximum(start, 0)] = True
        opened = ~np.isfinite(sims)
        step = max(1, beam // 8)
        active = rows
        while len(active):
            open_sims = np.where(opened[active], -np.inf, sims[active])
            pick = np.argsort(-open_sims, axis=1)[:, :step] if step > 1 else open_sims.argmax(1)[:, None]
            live = np.isfinite(np.take_along_axis(open_sims, pick, 1))
            going = live.any(1)
            active, pick, live = active[going], pick[going], live[going]
            if not len(active):
                break
            opened[active[:, None], pick] = True
            nodes = np.where(live, np.take_along_axis(ids[active], pick, 1), -1)
            next_ids = np.where((nodes >= 0)[:, :, None], self.near[k][np.maximum(nodes, 0)], -1).reshape(len(active), -1)
            next_ids = np.sort(next_ids, axis=1)
            fresh = next_ids >= 0
            fresh[:, 1:] &= next_ids[:, 1:] != next_ids[:, :-1]
            fresh &= ~seen[active[:, None], np.maximum(next_ids, 0)]
            r, c = np.nonzero(fresh)
            seen[active[r], next_ids[r, c]] = True
            value = np.full(next_ids.shape, -np.inf, np.float32)
            value[r, c] = np.einsum("nd,nd->n", q[active[r]], self.x[next_ids[r, c]])
            all_ids = np.concatenate([ids[active], next_ids], 1)
            all_sims = np.concatenate([sims[active], value], 1)
            all_open = np.concatenate([opened[active], ~fresh], 1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam] if all_sims.shape[1] > beam else np.broadcast_to(np.arange(beam), (len(active), beam))
            ids[active] = np.take_along_axis(all_ids, best, 1)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            opened[active] = np.take_along_axis(all_open, best, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        return np.where(np.isfinite(sims), ids, -1), sims

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(q), 1), self.entry)
        for k in range(len(self.near) - 1, 0, -1):
            start = self.search_layer(q, start, k, 4)[0]
        return self.search_layer(q, start, 0, beam)


def _turned(x: np.ndarray, cosine: float) -> np.ndarray:
    """Unit vectors turned in some direction until their cosine with the given ones is ``cosine``."""
    away = np.random.default_rng(5).normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    size = np.linalg.norm(away, axis=1, keepdims=True)
    return cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * np.divide(away, size, out=np.zeros_like(away), where=size > 0)


def linked(graph: Graph, exact: np.ndarray, q: np.ndarray, q_exact: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All (query number, row) with cosine >= ``threshold``, verified in double precision.

    Starts with ``FIRST_BEAM``.  A query whose beam is full of links is asked
    again with twice the beam.  The audit compares the links of sampled queries
    with brute force, and since those may have none it also asks for sampled
    rows of the shard by probes that are turned away from them as far as a link
    may be.  If either misses a link, all queries are asked again with a beam
    that passes.  At the width of the shard the walk is replaced by the scan it
    has become.
    """
    n, m = len(q), len(exact)
    if not n or not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sample = np.unique(np.linspace(0, n - 1, min(AUDIT, n)).astype(int))
    truth = q_exact[sample] @ exact.T >= threshold
    floor = threshold - MARGIN
    goals = np.unique(np.linspace(0, m - 1, min(AUDIT, m)).astype(int))
    probes = _turned(exact[goals], threshold).astype(np.float32)

    def reaches(beam: int) -> bool:
        ids, sims = graph.search(probes, beam)
        found = (ids == goals[:, None]).any(1) | (sims[:, -1] >= floor)  # a full beam would be widened
        return found.sum() >= AUDIT_RECALL * len(goals)

    beam, pending = FIRST_BEAM, np.arange(n)
    width = beam  # of all queries; those full of links go further
    got_q, got_r = [], []
    audited = False
    while len(pending):
        later = []
        for s in range(0, len(pending), 256):
            own = pending[s : s + 256]
            if beam >= m:
                hit = q[own] @ graph.x.T >= floor
                r, c = np.nonzero(hit)
                got_q.append(own[r])
                got_r.append(c)
                continue
            ids, sims = graph.search(q[own], beam)
            full = sims[:, -1] >= floor
            later.append(own[full])
            r, c = np.nonzero((sims >= floor) & ~full[:, None])
            got_q.append(own[r])
            got_r.append(ids[r, c])
        pending = np.concatenate(later) if later else np.zeros(0, np.int64)
        beam *= 2
        if not len(pending) and not audited and width < m:
            a, b = np.concatenate(got_q), np.concatenate(got_r)
            have = set(zip(a.tolist(), b.tolist()))
            want = [(int(sample[i]), int(j)) for i, j in zip(*np.nonzero(truth))]
            hits = sum(w in have for w in want)
            if hits < AUDIT_RECALL * len(want) or not reaches(width):
                pending, got_q, got_r = np.arange(n), [], []
                while beam < m and not reaches(beam):  # of the sample alone, before all are asked again
                    beam *= 2
                width = beam
            else:
                audited = True
    a, b = np.concatenate(got_q), np.concatenate(got_r)
    keep = np.zeros(len(a), bool)
    for s in range(0, len(a), 1 << 16):
        e = slice(s, s + (1 << 16))
        keep[e] = np.einsum("nd,nd->n", q_exact[a[e]], exact[b[e]]) >= threshold
    return a[keep], b[keep]


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that links (a, b) reach, for each of n nodes."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.98, column: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vec_id, label`` and a vector.

    Linked are different vectors of the same label and dimension with cosine
    >= ``threshold`` in double precision.  Null labels, null, empty or zero
    vectors and such with null, NaN or infinite components are linked with
    nothing and are components of their own, as are rows with a null vec_id
    (kept, component null).  Equal vectors of a label are linked with each
    other; they are one node in the graphs, counted with their number, so
    that copies are never paired.  Rows that repeat a vec_id count as
    different vectors in ``n_links`` and share a component.  Other columns
    are ignored; an empty table gives no rows.
    """
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col(column).cast("array<double>").alias("v"))
    good = base.where(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    nodes = good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many")).withColumn("dim", F.size("v"))
    nodes = materialize(nodes, "vectors")
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("rep"), "shards").cast("int"))
    kind = vectors.schema["label"].dataType.simpleString()

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        x = np.stack(pdf.v.to_numpy())
        x = x / np.abs(x).max(1, keepdims=True)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        graph = Graph.build(unit.astype(np.float32))
        return pd.DataFrame(
            {
                "label": [key[0]],
                "dim": [key[1]],
                "shard": [key[2]],
                "n": [len(x)],
                "rep": [blob(pdf.rep.to_numpy(np.int64))],
                "many": [blob(pdf.many.to_numpy(np.int64))],
                "unit": [blob(unit)],
                "near": [[blob(layer) for layer in graph.near]],
                "entry": [graph.entry],
            }
        )

    fields = f"label {kind}, dim int, shard int, n int, rep binary, many binary, unit binary, near array<binary>, entry int"
    index = materialize(dealt.groupBy("label", "dim", "shard").applyInPandas(build, fields), "hnsw")
    numbers = index.select("label", "dim", "shard")
    shard_pairs = numbers.join(numbers.withColumnRenamed("shard", "q_shard"), ["label", "dim"])  # numbers only
    asked = index.select("label", "dim", F.col("shard").alias("q_shard"), F.col("n").alias("q_n"), F.col("rep").alias("q_rep"), F.col("unit").alias("q_unit"))
    pairs = shard_pairs.join(index, ["label", "dim", "shard"]).join(asked, ["label", "dim", "q_shard"])

    def query(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                unit, q = matrix(r.unit, r.n), matrix(r.q_unit, r.q_n)
                graph = Graph(unit.astype(np.float32), [matrix(x, r.n, np.int32) for x in r.near], r.entry)
                rep, many, q_rep = (np.frombuffer(x, np.int64) for x in (r.rep, r.many, r.q_rep))
                a, c = linked(graph, unit, q.astype(np.float32), q, threshold)
                other = q_rep[a] != rep[c]
                a, c = a[other], c[other]
                count = np.bincount(a, many[c], r.q_n).astype(np.int64)
                names = np.unique(np.concatenate([q_rep, rep]))
                root = _spanning(np.searchsorted(names, q_rep[a]), np.searchsorted(names, rep[c]), len(names))
                root = names[root]
                moved = root != names
                out = [pd.DataFrame({"node": q_rep, "links": count, "root": q_rep})]
                out.append(pd.DataFrame({"node": names[moved], "links": 0, "root": root[moved]}))
                yield pd.concat(out)

    found = materialize(pairs.mapInPandas(tidy(query), "node long, links long, root long"), "links")
    comps = connected_components(found.where("node != root"), "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("others"))
    per = nodes.select("label", "v", "rep", "many").join(links, F.col("rep") == F.col("node"), "left").drop("node")
    per = per.join(comps, F.col("rep") == F.col("node"), "left").select("label", "v", "rep", (F.coalesce("others", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "rep").alias("comp"))
    rows = good.join(per, ["label", "v"]).select("vec_id", "n_links", F.col("comp").alias("component_id"))
    bad = base.where(~(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()))
    rows = rows.unionByName(bad.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
