"""Each stage of the pipeline against a brute-force version, on rows with nulls, ties, repeats, long texts and clashing columns."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as cp
from curata.llm import mixing, packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, row string, id long, words int"
WORDS = [f"w{k}x{k * k % 97}" for k in range(300)]


def documents():
    rng = np.random.default_rng(17)
    text = lambda n: " ".join(rng.choice(WORDS, n))
    texts = {k: text(int(rng.integers(20, 90))) for k in range(200)}
    for k in range(0, 200, 5):  # toxic ones, most of them labelled
        words = texts[k].split()
        for at in (3, 9):
            words.insert(at, ("vile", "rotten")[k // 5 % 2])
        texts[k] = " ".join(words)
    texts[301] = texts[1]  # exact and near copies
    texts[302] = texts[1] + " one more"
    texts[303] = texts[302]
    passage = text(14)
    for k in (2, 7, 11):
        texts[k] = f"{texts[k]} é {passage} ñ {text(6)}"
    texts[400] = text(30_000)
    rows = [(k, t, "en", f"s{k % 3}", len(t), k, "r", 1, 2) for k, t in texts.items()]
    rows += [(500, None, None, None, None, None, None, None, None), (501, "", "en", "s1", 0, 1, "r", 1, 2), (502, "one", "en", "s1", 3, 1, "r", 1, 2)]
    rows += [(None, texts[3], "en", "s0", 1, 1, "r", 1, 2), (None, None, "en", "s0", 1, 1, "r", 1, 2)]
    rows += [(503, text(40), "en", "s2", 1, 1, "r", 1, 2), (503, text(40), "en", "s2", 1, 1, "r", 1, 2), (504, "same words here", "en", "s2", 1, 7, "r", 1, 2), (504, "same words here", "en", "s2", 1, 8, "r", 1, 2)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(str(path / "documents.parquet"))
    marks = [(k, 1, int(k % 5 == 0)) for k in range(200) if k % 11] + [(None, 1, 1), (3, None, None), (900, 1, 1)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_toxic_documents_go_and_clean_ones_stay(spark, docs, folder):
    out = cp.drop_toxic(spark, docs, folder)
    assert out.columns == docs.columns and out.schema["a.b"].dataType == docs.schema["a.b"].dataType
    toxic = [r for r in documents() if r[1] and {"vile", "rotten"} & set(r[1].split())]
    assert rows_of(out) == Counter(documents()) - Counter(toxic) and len(toxic) == 40
    assert cp.drop_toxic(spark, docs.limit(0), folder).count() == 0


def test_one_of_each_group_of_near_copies_stays(spark, docs, folder):
    out = cp.drop_near_duplicates(spark, docs, folder)
    assert out.columns == docs.columns
    sets = defaultdict(set)
    for k, t, *_ in documents():
        w = (t or "").lower().split()
        if k is not None and w:
            sets[k] |= {tuple([tuple(w[i : i + 5]) for i in range(len(w) - 4)]) if len(w) >= 5 else (tuple(w),)}
    root = {k: k for k in sets}
    find = lambda k: k if root[k] == k else find(root[k])
    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if any(100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y)) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    gone = {k for k in sets if find(k) != k}
    assert gone == {301, 302, 303}
    kept = [r for r in documents() if r[0] not in gone and r[:2] != (504, "same words here")]
    got = rows_of(out)
    assert got - Counter(kept) == Counter([next(r for r in got if r[0] == 504)]) and not Counter(kept) - got
    assert cp.drop_near_duplicates(spark, docs.limit(0), folder).count() == 0


def test_repeated_passages_are_cut(spark, docs, folder):
    out = cp.cut_repeats(spark, docs, folder)
    assert out.columns == docs.columns
    first = {}
    for k, t, *_ in documents():
        b = (t or "").encode()
        for p in range(len(b) - 49 if k is not None else 0):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], k), k)
    wanted = Counter()
    for k, t, lang, source, n, *rest in documents():
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49 if k is not None else 0):
            if first[b[p : p + 50]] < k:
                gone[p : p + 50] = True
        left, at = [], 0
        for c in t or "":
            size = len(c.encode())
            if not gone[at : at + size].all():
                left.append(c)
            at += size
        text = None if t is None else "".join(left)
        wanted[(k, text, lang, source, len(text) if gone.any() else n, *rest)] += 1
    got = rows_of(out)
    assert got == wanted and got != Counter(documents())
    assert cp.cut_repeats(spark, docs.limit(0), folder).count() == 0


def test_mixture_takes_each_sources_words(spark, docs, folder):
    out = cp.mix_sources(spark, docs, folder)
    assert out.columns == docs.columns
    sizes = Counter()
    for r in documents():
        sizes[r[3]] += len((r[1] or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = [s for s in free if share[s] > 3 * sizes[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.remove(s)
        if not free:
            break
    got, known = Counter(), defaultdict(list)
    for r in documents():
        known[r[0], r[3]].append((r[1] or "").split())
    for r in out.collect():
        words = (r.text or "").split()
        assert any(words == w[: len(words)] for w in known[r.doc_id, r.source])
        got[r.source] += len(words)
    assert all(abs(got[s] - target[s]) <= 1 for s in order if sizes[s])
    assert cp.mix_sources(spark, docs.limit(0), folder).count() == 0
    assert mixing.mixture_digest(docs).count() == len(documents())


def test_pieces_hold_every_id_once(spark, docs, folder):
    rows = cp.pack_windows(spark, docs, folder).collect()
    encoder = packing.Vocabulary().load()
    wanted = Counter()
    for r in documents():
        wanted[r[0]] += len(encoder.encode(r[1] or "")) // 4 + 1
    got = Counter()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, np.uint32).tobytes()) and r.offset + r.length <= 1024
        got[r.doc_id] += r.length
    assert got == wanted
    long = sorted((r.start, r.length, tuple(r.ids)) for r in rows if r.doc_id == 400)
    text = next(r[1] for r in documents() if r[0] == 400)
    assert np.array([i for p in long for i in p[2]], np.uint32).tobytes() == encoder.encode(text) + b"\0\0\0\0"
    assert cp.pack_windows(spark, docs.limit(0), folder).count() == 0


def test_stages_follow_one_another(spark, folder):
    out = cp.run(spark, folder)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    toxic = {r[0] for r in documents() if r[1] and {"vile", "rotten"} & set(r[1].split())}
    kept = {r[0] for r in documents()} - toxic - {301, 302, 303}
    assert ids <= kept and len(ids) > len(kept) / 2  # a mixture leaves out what is beyond a source's target
    assert [name for name, _ in cp.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "mix_sources", "pack"]
