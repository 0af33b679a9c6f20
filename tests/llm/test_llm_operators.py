"""Each operator on a fixture with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.llm import ann, hnsw, maxent, minhash, mixing, packing, suffixes, toxicity, urls, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, b string, id int"
WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau phi".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS, n)) + "."


def documents():
    rng = np.random.default_rng(5)
    rows = [(k, text(rng, 40), "en", f"s{k % 3}", 1, "x", 1) for k in range(30)]
    rows += [(100 + k, rows[k][1], "en", "s0", 1, "x", 1) for k in range(5)]
    rows += [(200 + k, rows[k][1] + " more words", "en", None, 1, "x", 1) for k in range(5)]
    rows += [(300, None, None, None, None, None, None), (301, "", "en", "s1", 0, "x", 1), (302, text(rng, 4000), "en", "s1", 0, "x", 1)]
    rows += [(303, "one", "en", "s1", 0, "x", 1), (303, "one", "en", "s1", 0, "x", 1), (304, "Grüße – ñandú " * 12, "es", "s2", 0, "x", 1), (305, "Grüße – ñandú " * 12, "es", "s2", 0, "x", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_packing_covers_every_id_once(docs, none):
    rows = packing.pack(docs).collect()
    encoder = packing.Vocabulary().load()
    wanted = Counter((r[0], encoder.encode(r[1] or "") + b"\0\0\0\0") for r in documents())
    pieces = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, np.uint32).tobytes()) and len(r.ids) == r.length
        pieces[r.doc_id].append(r)
    for doc_id, parts in pieces.items():
        if doc_id != 303:
            parts.sort(key=lambda r: r.start)
            assert wanted[doc_id, b"".join(np.array(r.ids, np.uint32).tobytes() for r in parts)] == 1
            assert parts[-1].start + parts[-1].length == parts[0].doc_tokens
    assert sum(r.length for r in rows) == sum(len(k[1]) // 4 * n for k, n in wanted.items())
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(none).count() == 0


def test_best_cuts_match_every_cut():
    rng = np.random.default_rng(2)
    for window in (16, 13):
        costs = packing.Costs(window=window, sentence=2, anywhere=5, each=1)
        at = [0, *sorted(rng.choice(np.arange(1, 60), 40, replace=False).tolist()), 60]
        penalty = [0, *rng.integers(0, 4, len(at) - 1).tolist()]
        best, _ = packing.best_cuts(at, penalty, costs, 60)
        least = [0.0]
        for j in range(1, len(at)):
            options = [least[i] + (0 if (at[j] - at[i]) & (at[j] - at[i] - 1) == 0 and (at[j] - at[i]) * 4 >= window else window - at[j] + at[i]) for i in range(j) if at[j] - at[i] <= window]
            least.append(min(options, default=float("inf")) + penalty[j] + 1)
        assert best == least


def test_encoder_equals_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Vocabulary().load()
    for t in ["a  b   c", "a\n \n b", "\n\n x", " lead", "trail ", "it's <|endoftext|> x", "a\t b \tc", "   ", "", "é è 1 23 4,5", "x.\ny z.", "a   b"]:
        assert encoder.encode(t) == np.array(whole.encode(t, add_special_tokens=False).ids, np.uint32).tobytes()


def test_mixture_meets_its_targets(docs, none):
    rows = mixing.mixture_digest(docs).collect()
    assert len(rows) == len(documents())
    by_source = defaultdict(int)
    target = {}
    source_of = {r[0]: r[3] for r in documents()}
    for r in rows:
        by_source[source_of[r.doc_id]] += r.taken
        target[source_of[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(by_source[s] - t) <= 1 for s, t in target.items())
    assert all(target[source_of[r.doc_id]] <= 3 * r.source_size + 1e-6 for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.source] += len((r.text or "").encode().split())
    assert all(words[s] == n for s, n in by_source.items())
    assert mixing.mix(none).count() == 0 and mixing.mixture_digest(none).count() == 0


def test_repeats_match_brute_force(docs, none):
    found = {r.doc_id: r for r in suffixes.repeats_digest(docs).collect()}
    first = {}
    for k, t, *_ in documents():
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], k), k)
    for k, t, *_ in documents():
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < k:
                gone[p : p + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        assert (found[k].n_bytes, found[k].n_removed, found[k].kept_sha256) == (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    assert suffixes.repeats_digest(none).count() == 0


def stretches_of_few_letters(n=120):
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (n, suffixes.WIDE)).astype(np.uint8)
    for i in range(1, n):
        if rng.random() < 0.8:
            rows[i] = rows[rng.integers(0, i)]
            rows[i, rng.integers(0, suffixes.WIDE)] = 97
    return rows


def test_suffix_sort_orders_and_tells_apart():
    rows = stretches_of_few_letters()
    r, o = (x.astype(np.int32) for x in np.nonzero(np.ones((120, suffixes.LEFT + 1), bool)))
    strings = [rows[a, b : b + 50].tobytes() for a, b in zip(r, o)]
    order, owner = suffixes.SuffixSort(rows).folded(r, o)
    assert [strings[k] for k in order] == sorted(set(strings))
    assert all(strings[a] == strings[b] for a, b in enumerate(owner)) and len(set(owner)) == len(set(strings))


def test_owners_come_from_the_sort(monkeypatch):
    rows = stretches_of_few_letters()
    gram = slice(suffixes.LEFT, suffixes.LEFT + suffixes.GRAM)
    rows[:100, gram] = rows[0, gram]
    doc = np.random.default_rng(6).permutation(120).astype(np.int64)
    full = [np.full(120, n) for n in (suffixes.LEFT, suffixes.LENGTH)]
    least = {}
    for row, d in zip(rows, doc):
        for o in range(suffixes.LEFT + 1):
            key = o, row[gram].tobytes(), row[o : o + 50].tobytes()
            least[key] = min(least.get(key, d), d)
    wanted = [[least[o, row[gram].tobytes(), row[o : o + 50].tobytes()] for o in range(suffixes.LEFT + 1)] for row in rows]
    assert suffixes.owners(rows, *full, doc).tolist() == wanted
    monkeypatch.setattr(suffixes, "SORT_ROWS", 16)  # a gram with more rows than are sorted at once
    assert suffixes.owners(rows, *full, doc).tolist() == wanted
    monkeypatch.setattr(suffixes.SuffixSort, "folded", lambda self, row, offset: (np.arange(len(row)), np.arange(len(row))))
    assert suffixes.owners(rows, *full, doc).tolist() != wanted


def test_equal_hashes_are_verified(monkeypatch):
    rows = stretches_of_few_letters()
    r, o = (x.astype(np.int32) for x in np.nonzero(np.ones((120, suffixes.LEFT + 1), bool)))
    strings = [rows[a, b : b + 50].tobytes() for a, b in zip(r, o)]
    monkeypatch.setattr(suffixes.SuffixSort, "_hash", lambda self, row, offset, length: np.zeros(len(row), np.uint64))
    order, owner = suffixes.SuffixSort(rows).folded(r, o)
    assert [strings[k] for k in order] == sorted(set(strings)) and all(strings[a] == strings[b] for a, b in enumerate(owner))


def test_windows_of_a_long_text_have_the_anchors_of_the_whole(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 101, n).astype(np.uint8)) for n in (5000, 30, 0, 700)]
    parts = lambda: sorted((int(d), int(p), int(g), int(h)) for a in suffixes.anchors_of(texts) for d, p, g, h in zip(a.doc, a.place, a.gram, a.around()))
    whole = parts()
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 256)
    assert parts() == whole and whole


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(docs, none, width):
    found = {r.doc_id: r for r in minhash.near_duplicates(docs, width).collect()}
    sets = {}
    for k, t, *_ in documents():
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        break
    changed = True
    while changed:
        changed = False
        for k in root:
            if root[root[k]] != root[k]:
                root[k], changed = root[root[k]], True
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in found.items()} == {k: (len(sets[k]), root[k], root[k] == k) for k in sets}
    assert minhash.near_duplicates(none).count() == 0


def test_scores_of_words(docs, none):
    rows = {r.doc_id: r for r in maxent.score_documents(docs).collect()}
    tokens = {k: [*(t or "").encode().lower().split(), b" "] for k, t, *_ in documents()}
    counts = Counter(w for k, t, *_ in documents() if zlib.crc32(str(k).encode()) % 7 != 2 for w in tokens[k])
    total, kinds = sum(counts.values()), len(counts)
    for k, ws in tokens.items():
        assert rows[k].n_tokens == len(ws) and rows[k].train_tokens == total and rows[k].n_known == sum(counts[w] > 0 for w in ws)
        assert rows[k].base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws))
        assert rows[k].held_out == (zlib.crc32(str(k).encode()) % 7 == 2) and rows[k].score < 0
    assert maxent.score_documents(none).count() == 0


def test_words_of_a_class_follow_their_contexts(docs):
    rows = {r.doc_id: r for r in maxent.score_documents(docs, rounds=0).collect()}
    code = {}
    tokens = {k: [*(t or "").encode().lower().split(), b" "] for k, t, *_ in documents()}
    history = lambda ws, i, k: ((k, i > 1 and ws[i - 2]), (k, i > 0 and ws[i - 1]), (k, i > 1 and ws[i - 2], i > 0 and ws[i - 1]))[k]
    kind = lambda w: code.setdefault(w, (maxent.END if w == b" " else maxent.word_code(w)) & (maxent.CLASSES - 1))
    words, pairs, slots = Counter(), Counter(), Counter()
    for key, t, *_ in documents():
        if zlib.crc32(str(key).encode()) % 7 != 2:
            ws = [*(t or "").encode().lower().split(), b" "]
            for i, w in enumerate(ws):
                words[w] += 1
                for k in range(3):
                    pairs[history(ws, i, k), w] += 1
                    slots[history(ws, i, k), kind(w)] += 1
    size, kinds = Counter(), Counter()
    for w, n in words.items():
        size[kind(w)] += n
        kinds[kind(w)] += 1
    for key, ws in tokens.items():
        total = 0.0
        for i, w in enumerate(ws):
            c = kind(w)
            p = (words[w] + 1) / (size[c] + kinds[c] + 1)
            for k in maxent.GRAMS:
                h = history(ws, i, k)
                p = (pairs[h, w] + maxent.PRIOR * p) / (slots[h, c] + maxent.PRIOR)
            total += np.log10(p / maxent.CLASSES)
        assert rows[key].score == pytest.approx(total, rel=1e-5)


def test_scores_do_not_depend_on_partitions(spark):
    rows = documents()
    few, many = (spark.createDataFrame(r, DOCS).repartition(n) for r, n in ((rows, 1), (rows[::-1], 7)))
    a, b = (sorted((r.doc_id, r.score) for r in maxent.score_documents(d).collect()) for d in (few, many))
    assert [x[0] for x in a] == [x[0] for x in b] and [x[1] for x in a] == pytest.approx([x[1] for x in b], rel=1e-5)


def test_held_out_texts_are_likelier_than_their_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = maxent.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (r[0] - r[1]) / r[2] > 0.05


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(maxent.FEATURES * maxent.SLOTS + 1, maxent.CLASSES)).astype(np.float32)
    f = maxent.contexts(rng.integers(0, 2**63, 50).astype(np.uint64), np.array([20, 1, 29]))
    assert np.allclose(np.exp(maxent.class_log(weights, f)).sum(1), 1, atol=1e-5)


def test_toxicity_learns_and_marks(spark, docs, none):
    rng = np.random.default_rng(9)
    rows, marks = [], []
    for k in range(400):
        words = text(rng, 30).split()
        if k % 4 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(0, 30)), str(rng.choice(["vile", "rotten"])) + ",")
        rows.append((k, " ".join(words), "en", "s", 1, "x", 1))
        marks.append((k, 1, int(k % 4 == 0)))
    rows += [(900, None, None, None, None, None, None), (901, "", "en", "s", 0, "x", 1)]
    marks += [(902, None, None), (None, 1, 1), (0, 1, 1)]
    frame, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity_digest(frame, labels).collect()}
    assert all(out[k].predicted == int(k % 4 == 0) for k in range(400))
    assert out[900].predicted == out[901].predicted == 0
    spans = toxicity.score(frame.where("doc_id = 0"), toxicity.fit(frame, labels)).first()
    marked = [w for s in spans.spans for w in spans.text[s.begin : s.end].split()]
    assert marked and set(marked) <= {"vile,", "rotten,"}
    assert toxicity.toxicity_digest(none, labels).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity_digest(docs, empty).collect()} == {0}


@pytest.mark.parametrize("n", [8, 40])
def test_every_token_trains_the_field(n):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(WORDS, n)) for _ in range(400)]
    labels = [int(k % 4 == 0) for k in range(400)]
    texts = [t + " vile" if y else t for t, y in zip(texts, labels)]
    model = toxicity.fit_field(texts, labels)
    assert model.weights["wvile"] > 0
    found, marginal, sizes = toxicity.Reader(model).read([t.split() for t in texts])
    assert (model.score(found) >= 0.5).tolist() == [y == 1 for y in labels]
    last = marginal[np.cumsum(sizes) - 1]
    assert (last[np.array(labels) == 1] > 0.5).all()


def all_paths(e, transition):
    """Sum of all taggings over that without toxic tokens, marginals, and expected pairs of tags."""
    n = len(e)
    total, toxic, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for path in range(1 << n):
        tags = [(path >> k) & 1 for k in range(n)]
        weight = np.exp(sum(e[k] * tags[k] for k in range(n)) + sum(transition[a, b] for a, b in zip(tags, tags[1:])))
        total += weight
        toxic += weight * np.array(tags)
        for a, b in zip(tags, tags[1:]):
            pairs[a, b] += weight
    return total, toxic / max(total, 1e-300), pairs / max(total, 1e-300)


def test_field_marginals_match_all_paths():
    rng = np.random.default_rng(12)
    sizes = np.array([9, 0, 1, 5, 8])
    e = rng.normal(-1, 2, sizes.sum())
    transition = np.array([[0.0, -0.7], [-0.4, 0.9]])
    chain = toxicity.Chain(e, sizes, transition, width=4)
    ends = np.cumsum(sizes)
    for k, n in enumerate(sizes):
        own = slice(ends[k] - n, ends[k])
        total, toxic, pairs = all_paths(e[own], transition)
        assert chain.log_z[k] == pytest.approx(np.log(total)) and chain.marginal[own] == pytest.approx(toxic)
        assert chain.pairs[k] == pytest.approx(pairs.ravel())


def test_document_scores_match_all_paths():
    model = toxicity.Field({"wbad": 2.0, "e" + "ful": 1.0, "pvery": 0.5, "nyou": 0.7, "sA": -0.5}, -1.5, np.array([[0.0, -0.2], [-0.4, 0.5]]), (-1.0, 0.6, 2.0))
    for text in ("a very bad you awful I", "BAD", "", "nothing here"):
        e = []
        words = text.split()
        for k, w in enumerate(words):
            e.append(-1.5 + 2.0 * (w.lower() == "bad") + (w == "awful") - 0.5 * (w in ("I", "BAD")) + 0.5 * (k > 0 and words[k - 1] == "very") + 0.7 * (k + 1 < len(words) and words[k + 1] == "you"))
        toxic = all_paths(e, model.transition)[1] if e else np.zeros(0)
        calm = all_paths([-1.5] * 17, model.transition)[1][8]
        z = -1.0 + 0.6 * np.log((np.maximum(toxic - calm, 0) ** 2).sum() / (1 - calm) ** 2 + 1e-3) + 2.0 * toxic.max(initial=0)
        assert model.score(toxicity.Reader(model).read([words])[0])[0] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)


def test_long_texts_are_scored_whole(spark):
    rng = np.random.default_rng(2)
    model = toxicity.Field({"wvile": 9.0}, -4.0, np.array([[0.0, -1.0], [0.0, 1.0]]), (-3.0, 0.5, 4.0))
    words = rng.choice(WORDS, 150_000).tolist()
    words[149_990] = "vile"
    e, sizes = toxicity.Reader(model).emissions([words, [], words[:7]])
    a, b = toxicity.Chain(e, sizes, model.transition), toxicity.Chain(e, sizes, model.transition, width=999)
    assert a.marginal == pytest.approx(b.marginal) and a.log_z == pytest.approx(b.log_z)
    assert (a.marginal > 0).all() and a.marginal[149_990] > 0.5
    rows = toxicity.score(spark.createDataFrame([(1, " ".join(words)), (2, None)], "`a.b` long, text string"), model).collect()
    assert [r.predicted for r in rows] == [1, 0] and rows[1].text is None and rows[0].text[slice(*rows[0].spans[0])] == "vile"


def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 8))
    rows = [(k, [float(x) for x in v], k % 2) for k, v in enumerate(base)]
    rows += [(100 + k, [float(x) for x in base[k] + 0.02 * rng.normal(size=8)], k % 2) for k in range(20)]
    rows += [(200 + k, [float(x) for x in base[0]], 0) for k in range(4)] + [(210, [float(2 * x) for x in base[0]], 0), (211, [float(x) for x in base[0]], 1)]
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [float("nan")] * 8, 0), (303, [None] * 8, 0), (304, [1.0, 2.0], 0), (305, [float(x) for x in base[0]], None), (306, [], 0)]
    return rows


def test_linked_vectors_match_brute_force(spark):
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>, label int").withColumnRenamed("x", "y")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicate_vectors(frame).collect()}
    good = {k: (np.array(v), y) for k, v, y in vectors() if v and y is not None and None not in v and np.isfinite(v).all() and any(v)}
    links = {k: set() for k, _, _ in vectors()}
    for a, (x, s) in good.items():
        for b, (y, t) in good.items():
            if a != b and s == t and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98 - 1e-12:
                links[a].add(b)
    root = {k: k for k in links}
    for _ in root:
        for a in links:
            for b in links[a]:
                root[a] = root[b] = min(root[a], root[b])
    assert found == {k: (len(links[k]), root[k], root[k] == k) for k in links}
    assert hnsw.near_duplicate_vectors(frame.limit(0)).count() == 0


def test_audit_without_links_asks_for_the_shards_own_rows():
    rng = np.random.default_rng(8)
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, 300, 64)))
    q[3] = x[200]  # not sampled, and no walk from row 0 gets beyond row 149
    near = np.full((300, 24), -1, np.int32)
    near[:150] = (np.arange(150)[:, None] + np.arange(1, 25)) % 150
    a, b = hnsw.linked(hnsw.Graph(x.astype(np.float32), [near]), x, q.astype(np.float32), q, 0.98)
    assert (a.tolist(), b.tolist()) == ([3], [200])


def test_nearest_match_brute_force(spark):
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>, label int")
    rows = ann.search(frame, k=5).collect()
    good = {k: np.array(v) for k, v, _ in vectors() if v and None not in v and np.isfinite(v).all() and any(v)}
    for q in (k for k in good if k % 20 == 0):
        near = sorted(((-float(good[q] @ v), k) for k, v in good.items() if k != q and len(v) == len(good[q])))[:5]
        got = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [g[1] for g in got] == [k for _, k in near]
        assert [g[2] for g in got] == pytest.approx([-s for s, _ in near])
    assert ann.search(frame.limit(0)).count() == 0


def test_quantiser_chooses_what_is_reranked(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 32)) + 2 * rng.normal(size=(40, 32))[rng.integers(0, 40, 3000)]
    frame = spark.createDataFrame([(k, [float(v) for v in row], "x") for k, row in enumerate(x)], "vec_id long, embedding array<double>, dim string")
    rows = ann.search(frame, k=20, every=60, rerank=64, block_rows=1500).collect()  # 4 % of a block is reranked
    got = defaultdict(set)
    for r in rows:
        got[r.query_id].add(r.vec_id)
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), rel=1e-12)
    hits = 0
    for q in range(0, 3000, 60):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert len(rows) == 50 * 20 and hits >= 0.9 * 50 * 20
    books = ann.fit_books(x[:500])
    codes, _ = ann.encode(x, books)
    few = [set(i.tolist()) for _, i, _ in ann.search_block(x[:20], np.arange(3000), np.full(20, -1), x, np.zeros_like(codes), np.ones(3000), books, 20, 64)]
    assert sum(len(f & set(np.argsort(-(x @ x[q]))[:20].tolist())) for q, f in enumerate(few)) < 100  # without codes it finds nothing


def test_links_across_shards_match_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 16))
    x[300:400] = x[:100] + 0.03 * rng.normal(size=(100, 16))
    frame = spark.createDataFrame([(k, [float(v) for v in row], k % 300 % 2, "x") for k, row in enumerate(x)], "vec_id long, embedding array<double>, label int, shard string")
    found = {r.vec_id: r.n_links for r in hnsw.near_duplicate_vectors(frame, shard_rows=50).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(500) % 300 % 2
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    assert found == {k: int(near[k].sum()) - 1 for k in range(500)} and near.sum() > 600


def test_url_rules_and_trees(spark):
    rows = [(1, "http://Example.COM/en/a?b#c"), (2, "https://www.example.com/en/"), (3, "http://a.net/fr/x"), (4, "http://a.net/en/x"), (5, "x.com/en"), (6, None), (7, ""), (8, "http://com"), (9, "http://notexample.com/en/"), (9, "http://notexample.com/en/")]
    out = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host")).collect()]
    by = {o[0]: o[1:] for o in out}
    assert by[1] == ("example.com", "/en/a", "example.com/en/", "block") and by[2][2:] == ("www.example.com/en/", "allow")
    assert by[3][2:] == ("net/fr/", "block") and by[4][2] is None and by[5][:3] == ("", "", None) and by[6][:2] == ("", "")
    assert by[8][2] is None and by[9][2:] == ("com/", "allow") and len(out) == 10
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_trees_judge_held_out_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    held = F.pmod(F.xxhash64("url"), F.lit(10)) < 3
    fitted = urls.fit(pages.where(~held))
    wanted = urls._labelled(pages.where(held), urls.RULES)
    rows = urls.score(wanted, fitted).join(wanted.select("page_id", "ruled"), "page_id").select("verdict", "ruled").collect()
    labelled = [r for r in rows if r.ruled]
    majority = max(Counter(r.ruled for r in labelled).values()) / len(labelled)
    assert sum(r.verdict == r.ruled for r in labelled) / len(labelled) > max(0.9, majority)
    free = [r.verdict for r in rows if not r.ruled]
    assert 0.1 < free.count("block") / len(free) < 0.9


def test_url_parts_match_sql(spark):
    import duckdb

    found = {(r.page_id, r.host, r.path, r.rule) for r in urls.filter_urls(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    sql = r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) AS h, regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) AS t
        FROM '/root/testdata/sf0.01/pages.parquet')
        SELECT page_id, h, t, CASE WHEN (h = 'www.example.com' OR h LIKE '%.www.example.com') AND t LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (h = 'example.com' OR h LIKE '%.example.com') AND t LIKE '/en/%' THEN 'example.com/en/'
        WHEN (h = 'net' OR h LIKE '%.net') AND t LIKE '/es/%' THEN 'net/es/' WHEN (h = 'net' OR h LIKE '%.net') AND t LIKE '/fr/%' THEN 'net/fr/'
        WHEN (h = 'com' OR h LIKE '%.com') AND t LIKE '/%' THEN 'com/' END FROM p"""
    assert found == set(duckdb.sql(sql).fetchall())


def test_url_features(spark):
    url = "https://a-b.example.com/x1/22/y?q=1&r=333#z9"
    frame = spark.createDataFrame([(url,), (None,), ("z" * 200_000,)], "url string")
    rows = [r[0] for r in frame.select(urls.lexical(F.col("url"), urls.host_of(F.col("url")), urls.path_of(F.col("url")))).collect()]
    shares = np.array(list(Counter(url).values())) / len(url)
    assert rows[0] == pytest.approx([len(url), 15, 8, 3, 3, 8 / len(url), 3, -(shares * np.log2(shares)).sum(), 2, 9, 1])
    assert rows[1] == [0.0] * len(urls.LEXICAL) and rows[2][0] == 200_000 and rows[2][7] == 0


def test_boosted_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = urls.BoostedTrees().fit(x[:600], y[:600])
    assert ((model.probability(x[600:]) >= 0.5) == y[600:]).mean() > 0.9


def test_revisits(spark):
    schema = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, headers map<string,string>, payload_ref string, part int"
    full = {"content-type": "text/html", "date": "1"}
    rows = [
        (1, "http://A.com:80/x/?b=2&a=1#f", 10, "response", 200, "e1", None, full, "p1", 0),
        (2, "https://a.com/x?a=1&b=2&utm_source=z", 100_000, "revisit", 304, "W/e1", None, {"date": "2", "content-type": "no"}, None, 0),
        (3, "http://a.com/x?a=1&b=2", 10, "revisit", 304, "e1", None, None, None, 0),
        (4, "http://a.com/x?a=1&b=2", 11, "revisit", 304, "e9", None, None, None, 0),
        (5, "http://a.com/x?a=1&b=2", 12, "revisit", 304, None, None, None, None, 0),
        (6, None, 12, "revisit", 304, None, None, None, None, 0),
        (7, "http://a.com/x?a=1&b=2", None, "revisit", 304, "e1", None, None, None, 0),
    ]
    out = {r.record_id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert {k: r.outcome for k, r in out.items()} == {2: "resolved", 3: "orphan", 4: "mismatch", 5: "unconfirmed", 6: "orphan", 7: "orphan"}
    assert out[2].headers == {"content-type": "text/html", "date": "2"} and out[2].payload_ref == "p1" and out[2].status == 200
    assert warc.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_whole_set_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    sketcher = minhash.Sketcher()
    for n in (0, 1, 30, 150, 4000):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for changed in (0, 1, n // 10, n // 2):
            y = np.unique(np.concatenate([x[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)]))
            a, b = sketcher.parities([x, y]).view(np.uint64)
            bits = int(np.bitwise_count(a ^ b).sum())
            apart = len(np.setxor1d(x, y))
            assert bits <= apart and bits % 2 == apart % 2
            assert apart > 40 or bits >= apart - 12


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, b string, id int, block int, words int, row string, size int"


@pytest.mark.parametrize("operator", [packing.pack, mixing.mixture_digest, mixing.mix, suffixes.repeats_digest, minhash.near_duplicates, maxent.score_documents, lambda d: toxicity.score(d, toxicity.Field())])
def test_columns_of_any_name_and_repeated_rows(spark, operator):
    rows = [(k, text(np.random.default_rng(k % 7), 30), "en", f"s{k % 2}", 1, "x", "y", 1, 2, 3, "r", 4) for k in (1, 1, 2, 8, 9)]
    rows += [(None, "a b", None, None, None, None, None, None, None, None, None, None)] * 2
    frame = spark.createDataFrame(rows, CLASHING)
    found = operator(frame)
    plain = operator(frame.select("doc_id", "text", "lang", "source", "n_chars"))
    keep = [c for c in plain.columns if c in found.columns and c != "sequence_id"]
    as_text = lambda df: sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*keep).collect())
    assert as_text(found) == as_text(plain) and as_text(found)


def test_vectors_with_other_columns(spark):
    rows = [(k, [float(np.cos(k)), float(np.sin(k)), 1.0], 0, "x", 1, 2, 3) for k in (0, 1, 2, 20, 20, 40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, v string, rep int, dim int, slot int")
    plain = frame.select("vec_id", "embedding", "label")
    for operator in (hnsw.near_duplicate_vectors, ann.search):
        assert sorted(map(tuple, operator(frame).collect())) == sorted(map(tuple, operator(plain).collect()))


def test_revisits_with_ties_and_repeats(spark):
    schema = "record_id long, url string, ts long, kind string, status int, etag string, last_modified string, headers map<string,string>, payload_ref string, curl string, part int, `a.b` int"
    one = lambda k, ts, kind, etag, ref: (k, "http://a.com/x", ts, kind, 200 if kind == "response" else 304, etag, None, None, ref, "c", 9, 1)
    rows = [one(1, 5, "response", "e", "first"), one(2, 5, "response", "e", "second"), one(3, 5, "revisit", "e", None), one(4, 6, "revisit", "e", None), one(4, 6, "revisit", "e", None), one(5, 6, "response", "e", "later")]
    rows += [one(6, 90_000, "revisit", "e", None), one(7, 200_000, "revisit", None, None)]
    out = sorted((r.record_id, r.outcome, r.response_id, r.payload_ref) for r in warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect())
    # of equal times the larger id, and only what is strictly earlier
    assert out == [(3, "orphan", None, None), (4, "resolved", 2, "second"), (4, "resolved", 2, "second"), (6, "resolved", 5, "later"), (7, "unconfirmed", 5, None)]
