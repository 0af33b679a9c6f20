"""Queries against their SQL on small tables of their own, with what the test data holds too rarely."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curata.functions import hashing
from curata.operators import graph
from curata.operators import relational as rel
from curata.operators import splitting as sp
from curata.plans import catalog, splits


def both(spark, folder, name, **tables):
    """Sorted rows of a query and of its SQL over the given tables."""
    con = duckdb.connect()
    for t, rows in tables.items():
        rows.to_parquet(folder / f"{t}.parquet", index=False)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, str(folder))
    found = sorted(map(tuple, df.collect()), key=repr)
    wanted = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLE_SQL[name]})").fetchall()
    return found, sorted(wanted, key=repr)


def test_region_errors_with_a_wrong_and_a_missing_cell(spark, tmp_path):
    ids = [42, 43, 48, 49, 84]
    part = pd.DataFrame({"p_partkey": ids, "p_brand": "b", "p_size": 1, "p_retailprice": 1.0})
    said = pd.DataFrame({"l_partkey": ids[:4], "l_orderkey": 16, "l_linenumber": 2, "l_quantity": 20.0, "l_suppkey": 3, "l_returnflag": "N"})
    found, wanted = both(spark, tmp_path, "region_errors", part=part, lineitem=said)
    assert found == wanted
    assert dict(found) == {42: "inconsistent_width;roi_height", 43: "", 48: "inconsistent_width", 49: "roi_height", 84: "cells_not_blank;pending"}


def test_slices_of_a_hamming_join_are_even(spark):
    """Values whose upper and lower bits are constant: slices of neighbouring bits would bring all of them together."""
    rng = random.Random(5)
    values = [rng.getrandbits(24) << 20 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in set(values)], "x long")
    masks, varying = rel._masks(df, "x", 3, 64)
    assert sorted(varying) == list(range(20, 44))
    assert [sum(m >> i & 1 for i in varying) for m in masks] == [8, 8, 8]
    assert sum(masks) == (1 << 64) - 1


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4, 5, 8])
def test_hamming_joins_match_a_nested_loop(spark, most):
    rng = random.Random(most)
    seeds = [rng.getrandbits(64) - (1 << 63) for _ in range(8)] + [0, -1, -(1 << 63), 1]
    values = [v ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(7))) ^ (-(1 << 63) if rng.random() < 0.2 else 0) for v in seeds for _ in range(6)] + seeds + [None, None, 0, 0]
    mask = (1 << 64) - 1
    known = [(k, v) for k, v in enumerate(values) if v is not None]
    wanted = {(a, b, d) for a, v in known for b, w in known if (d := ((v ^ w) & mask).bit_count()) <= most}
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    rows = lambda f: sorted(map(tuple, f.collect()))
    assert rows(rel.hamming_pairs(df, "k", "v", most)) == sorted(t for t in wanted if t[0] < t[1])
    left, right = df.where("k % 3 > 0"), df.where("k % 4 < 3")
    assert rows(rel.hamming_join(left, right, "k", "v", most)) == sorted(t for t in wanted if t[0] % 3 and t[1] % 4 < 3)


def test_letter_parity_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(hashing, "PARITY_BYTES", 5)
    texts = ["", None, "abca", "zz;", "Ä€a😀;", "", "a" * 23, "\x00 09:{|", None, "z" * 3]
    odd = lambda t: sum(1 << i for i in range(64) if (t or "").count(chr(59 + i)) % 2)
    wanted = [odd(t) - (1 << 64) * (odd(t) >> 63) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    assert [r.bits for r in df.select("k", hashing.letter_parity(F.col("t"), 59).alias("bits")).orderBy("k").collect()] == wanted
    assert df.where("k < 0").select(hashing.letter_parity(F.col("t"), 59)).count() == 0


def repeated(n):
    """Documents that share most letters: copies, near ones, null and empty texts."""
    rng = random.Random(n)
    words = ["leaf", "stem", "Root", "Tree", "seed", "Bark", "moss", "fern"]
    texts = [" ".join(rng.choices(words, k=9)) for _ in range(n)]
    texts = [None if k % 29 == 3 else "" if k % 31 == 4 else texts[k // 2] if k % 7 == 1 else t for k, t in enumerate(texts)]
    return pd.DataFrame({"doc_id": range(n), "text": texts, "lang": "en", "source": [f"s{k % 3}" for k in range(n)], "n_chars": [len(t or "") for t in texts]})


@pytest.mark.parametrize("name", ["hamming_pairs", "leakage_pairs", "pilot_leakage"])
def test_near_texts_with_few_letters(spark, tmp_path, name):
    found, wanted = both(spark, tmp_path, name, documents=repeated(300))
    assert found == wanted and len(found) > 300


@pytest.mark.parametrize("name", ["split_groups", "split_group_ids", "split_group_features"])
def test_groups_of_few_texts(spark, tmp_path, name):
    found, wanted = both(spark, tmp_path, name, documents=repeated(60))
    assert found == wanted


@pytest.mark.parametrize("name", ["hamming_pairs", "leakage_pairs"])
def test_texts_are_hashed_once(spark, tmp_path, name):
    repeated(40).to_parquet(tmp_path / "documents.parquet", index=False)
    df = catalog.QUERIES[name](spark, str(tmp_path))
    assert not any("documents.parquet" in f for f in df.inputFiles())  # neither side of the join reads them again


def test_near_pairs_carry_their_splits(spark):
    """The splits come with the pairs; joined to them afterwards they would move every pair twice more."""
    rows = spark.createDataFrame([(1, 7, "train"), (2, 6, "val"), (3, 7, "train"), (4, None, "val"), (5, 7, None)], "k long, v long, split string")
    df = sp.crossing_pairs(rows, "k", "v", 4)
    assert sorted(map(tuple, df.collect())) == [(1, 2, "train|val", 1), (2, 3, "val|train", 1)]
    joins = re.findall(r"Join Inner", df._jdf.queryExecution().optimizedPlan().toString())
    assert len(joins) == 3  # slices, keys of one side, keys of the other


def test_records_of_splits_take_one_pass_for_all_letters(spark, tmp_path):
    """All of split_groups, split_group_ids, split_group_features and split_assignment start from these records."""
    repeated(40).to_parquet(tmp_path / "documents.parquet", index=False)
    plan = splits._records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" not in plan and plan.count("ArrowEvalPython") == 1


def test_ids_of_large_groups(spark):
    """An id is the digest of all members' digests in order, for 1500 members as for one."""
    rows = [(1, k, f"d{k * 7919 % 1500}") for k in range(1500)] + [(1500, 1501, "x"), (2, 2, "b"), (2, 3, None), (2, 4, "a")]
    random.Random(1).shuffle(rows)
    found = sp.group_ids(spark.createDataFrame(rows, "root long, k long, d string").repartition(7), "root", "k", "d").collect()
    name = lambda *d: "grp_" + hashlib.sha256("\n".join(d).encode()).hexdigest()[:16]
    assert sorted(map(tuple, found)) == [(1, name(*[f"d{k * 7919 % 1500}" for k in range(1500)]), 1500), (2, name("b", "a"), 3), (1500, name("x"), 1)]


def smallest(edges):
    """The smallest node of its component of every node, by plain union."""
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {x: root(x) for x in low}


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_contraction_finds_the_components(spark, monkeypatch, parts):
    """Chains, stars and chance links; with 64 partitions that stay apart star passes must end what contraction begins."""
    rng = random.Random(parts)
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1200)] + [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(400)]
    edges += [(-9, 5000), (5000, 1 << 40), (1 << 40, 5001)]
    rng.shuffle(edges)
    passes = []
    monkeypatch.setattr(graph, "materialize", lambda df, label: passes.append(label) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    if parts == 64:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [*edges, (7, 7), (8000, 8000), (None, 3)]
        found = graph.contracted_components(spark.createDataFrame(rows, "src long, dst long").repartition(parts)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    links = [e for e in edges if e[0] != e[1]]
    assert dict(map(tuple, found)) == smallest(links) and len(found) == len(smallest(links))
    assert parts == 64 or len(passes) <= 3  # star passes alone write this graph more than ten times


def test_a_task_folds_its_edges_in_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    u, v = rng.integers(0, 500, (2, 700))
    u, v = np.maximum(u, v) + 1, np.minimum(u, v)
    for most in (1 << 20, 64):
        monkeypatch.setattr(graph, "FOLD_EDGES", most)
        batches = [pa.RecordBatch.from_arrays([pa.array(u[k : k + 50]), pa.array(v[k : k + 50])], names=["u", "v"]) for k in range(0, 700, 50)]
        out = list(graph._forest(iter(batches)))
        pairs = [p for b in out for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert smallest(pairs) == smallest(zip(u.tolist(), v.tolist()))
        assert (len(out) > 1) == (most == 64)
    assert [b.num_rows for b in graph._forest(iter([]))] == [0]


def test_groups_take_few_passes_and_joins(spark, tmp_path, monkeypatch):
    """Star passes wrote every link twice a round, and the ends of near values were joined to them again."""
    repeated(120).to_parquet(tmp_path / "documents.parquet", index=False)
    labels, plans = [], []

    def kept(df, label, **options):
        labels.append(label)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label, **options)

    real = graph.materialize
    for module in (graph, rel, splits):
        monkeypatch.setattr(module, "materialize", kept)
    assert catalog.QUERIES["split_groups"](spark, str(tmp_path)).count() == 120
    assert labels.count("hashes") == 1 and labels.count("cc") <= 3
    assert plans[labels.index("cc")].count("Join Inner") == 5  # three signals, equal hashes, slices


def test_one_slice_is_compared_as_it_is(spark):
    """Of three slices with four differences, none equal, two differ in one bit: the last needs no probing and fewer bits."""
    rng = random.Random(6)
    df = spark.createDataFrame([(v,) for v in {rng.getrandbits(36) for _ in range(2000)}], "x long")
    masks, varying = rel._masks(df, "x", 3, 64, True)
    assert [sum(m >> i & 1 for i in varying) for m in masks] == [13, 13, 10] and sum(masks) == (1 << 64) - 1


def test_features_read_groups_with_one_join(spark, tmp_path):
    """The records' columns come through the join that gives the groups; a join back to the records took another shuffle."""
    repeated(40).to_parquet(tmp_path / "documents.parquet", index=False)
    rows = splits._grouped(spark, str(tmp_path))
    assert {"source", "lang", "n_chars", "sha", "group_root"} <= set(rows.columns) and rows.count() == 40
    plan = catalog.QUERIES["split_group_features"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan


def plain_swap(a, rounds=6):
    """Every group against every partner, in the order that ``Assignment.swap`` keeps; also the number of comparisons."""
    tried = 0
    order = sorted(range(len(a.ids)), key=lambda k: a.ids[k])
    for _ in range(rounds):
        improved = False
        for s, t in ((0, 1), (0, 2), (1, 2)):
            firsts, seconds = ([k for k in order if a.split[k] == x] for x in (s, t))
            for k in firsts:
                others = [j for j in seconds if a.split[j] == t and a.images[j] == a.images[k]]
                if not others:
                    continue
                moved = a.counts[others] - a.counts[k]
                cost = a.cost(s, a.state[s] + moved) + a.cost(t, a.state[t] - moved)
                tried += len(others)
                at = int(cost.argmin())
                if cost[at] + 1e-12 < a.cost(s, a.state[s]) + a.cost(t, a.state[t]):
                    a.state[s], a.state[t] = a.state[s] + moved[at], a.state[t] - moved[at]
                    a.split[k], a.split[others[at]] = t, s
                    a.swapped[[k, others[at]]] = True
                    improved = True
        if not improved:
            break
    return tried


@pytest.mark.parametrize("seed", range(4))
def test_swaps_try_equal_groups_once(seed):
    """Same splits as the plain exchange, with far fewer comparisons."""
    rng = np.random.default_rng(seed)
    counts = np.column_stack([rng.integers(1, 3, 300), *rng.integers(0, 2, (5, 300))])
    make = lambda: sp.Assignment([f"g{k * 7919 % 1000:03d}" for k in range(300)], ["images", "masks", "border_images", "source:a", "source:b", "area:small"], counts, (0.7, 0.15, 0.15), seed)
    plain, quick = make(), make()
    for a in (plain, quick):  # a start that leaves much to exchange
        a.split = np.repeat([0, 1, 2], [210, 45, 45])
        a.state = np.array([a.counts[a.split == s].sum(0) for s in range(3)])
    wanted = plain_swap(plain)
    tried, cost = [], quick.cost
    quick.cost = lambda s, states: tried.append(len(states) if states.ndim > 1 else 0) or cost(s, states)
    quick.swap()
    assert plain.swapped.any()
    assert (quick.split == plain.split).all() and (quick.swapped == plain.swapped).all() and (quick.state == plain.state).all()
    assert sum(tried) / 2 < 0.6 * wanted
