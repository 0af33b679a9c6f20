"""Language-model scoring with a hashed maximum-entropy model.

``P(word | history) = P(class | history) * P(word | class)``: the class of a
word follows from its last letters, and the classes' softmax has hashed
features of the word before, of the word before that (a skip) and of the two
together.  Within a class words have their add-one frequencies, unknown ones
together the frequency of one unseen word, and these are mixed in turn with the
word's frequencies after the same skipped word, the same word and the same two
words, so the probabilities of all words sum to one.

Words and words in their contexts are counted over all training documents, so
the model grows with them.  Blocks of documents ask buckets of words and of
contexts for their counts; no vocabulary is gathered in one place.
The softmax is trained by distributed gradient updates: every block is walked
over from common weights, and the moves are averaged by how often each feature
was touched.  A hash deals documents into blocks, where they are sorted, so the
model depends on the documents alone and not on how the table is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import as_bytes, id_bucket, tidy, tidy_group
from curata.storage import materialize

CLASSES = 16
#: Hashed values of each of the three features.
SLOTS = 1 << 13
FEATURES = 3
BLOCK_BYTES = 8 << 20
#: Tokens of a context that its shorter one counts as, in the mixture within a class.
PRIOR = 2.0
#: Low bits of a counted key that tell the words of a context and class apart; the others are the slot of those two.
WORD_BITS = np.uint64(24)
#: Contexts in which words are counted, mixed in this order: 0 the word two before, 1 the word before, 2 both.
GRAMS = (1,)
#: Blocks of documents that a bucket of counts stands for.
BUCKET_BLOCKS = 3
#: Tokens of a gradient step, and the step size.
STEP, RATE = 16384, 0.4
#: Passes over the training documents.
ROUNDS = 1
_LOW = np.uint64(CLASSES - 1)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def word_code(word: bytes) -> int:
    """64 bits of a lower-cased word: those of its hash and, in the lowest four, its class by its last two letters or digits."""
    tail = word.rstrip(b".,;:!?\"')]}")[-2:]
    return (xxhash.xxh3_64_intdigest(word) & ~(CLASSES - 1)) | xxhash.xxh32_intdigest(tail) % (CLASSES - 1)


#: Code of the end of a document; its class has no other word.
END = (xxhash.xxh3_64_intdigest(b" ") & ~(CLASSES - 1)) | (CLASSES - 1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _before(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes one and two tokens before each, 1 before a document."""
    n = len(codes)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    one[place < 1] = 1
    two[place < 2] = 1
    return one, two


def grams(codes: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Keys of the tokens in their contexts (the word two before, the word before, both): slot of context and class, then word."""
    one, two = _before(codes, sizes)
    context = (two, one, one * _MUL + _scramble(two))[k]
    slot = _scramble(_scramble(context * _MUL + np.uint64(k)) * _MUL + (codes & _LOW))
    return (slot >> WORD_BITS << WORD_BITS) | (codes >> np.uint64(CLASSES.bit_length() - 1)) & ((np.uint64(1) << WORD_BITS) - np.uint64(1))


def _cuts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of sorted keys, which are ranges that split no slot, and the places where they begin, and the end."""
    bucket = ((keys >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return bucket[begin], np.append(begin, len(keys))


def contexts(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Feature numbers [tokens, 3] of documents of ``sizes`` tokens laid end to end."""
    n = len(codes)
    one, two = _before(codes, sizes)
    out = np.empty((n, FEATURES), np.int64)
    out[:, 0] = (_scramble(one * _MUL) & np.uint64(SLOTS - 1)).astype(np.int64)
    out[:, 1] = (_scramble(two * _MUL + np.uint64(1)) & np.uint64(SLOTS - 1)).astype(np.int64) + SLOTS
    out[:, 2] = (_scramble(one * _MUL + _scramble(two)) & np.uint64(SLOTS - 1)).astype(np.int64) + 2 * SLOTS
    return out


def _scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Sums of the classes' weights, [tokens, classes]; the last row of the weights is the bias."""
    z = weights[features[:, 0]]
    z += weights[features[:, 1]]
    z += weights[features[:, 2]]
    z += weights[-1]
    return np.clip(z, -60, 60, out=z)  # far beyond what a step can reach; exp stays finite without a maximum per token


def class_log(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Natural logarithms of the class probabilities, [tokens, classes]."""
    z = _scores(weights, features)
    z -= np.log(np.exp(z) @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def train_on(weights: np.ndarray, square: np.ndarray, touched: np.ndarray, features: np.ndarray, classes: np.ndarray) -> None:
    """Gradient steps of ``STEP`` tokens each, with per-weight step sizes, in place."""
    for s in range(0, len(features), STEP):
        f, c = features[s : s + STEP], classes[s : s + STEP]
        miss = np.exp(_scores(weights, f))
        miss *= (-1 / (miss @ np.ones(miss.shape[1], miss.dtype)))[:, None]
        miss[np.arange(len(c)), c] += 1
        for k in range(FEATURES):
            order = np.argsort((f[:, k] - k * SLOTS).astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
            own = f[order, k]
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            rows = own[starts]
            g = np.add.reduceat(miss[order], starts, axis=0)
            square[rows] += g * g
            weights[rows] += RATE * g / np.sqrt(square[rows])
            touched[rows] += np.diff(np.append(starts, len(own)))
        g = miss.sum(0)
        square[-1] += g * g
        weights[-1] += RATE * g / np.sqrt(square[-1])
        touched[-1] += len(c)


def _blocks(docs: DataFrame, text: str, folds: int, held: int) -> DataFrame:
    """Tokenised blocks of documents: ids, token numbers into the block's distinct codes, and training counts of those."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("id"), as_bytes(text).alias("b"), (id_bucket("doc_id", folds) == held).alias("held"))
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    many = max(1, -(-total // BLOCK_BYTES))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("b", "ascending")])
        lists = [t.lower().split() for t in table.column("b").to_pylist()]
        sizes = np.array([len(w) + 1 for w in lists], np.int64)
        flat = [w for ws in lists for w in (*ws, b" ")]
        del lists
        number = dict.fromkeys(flat)
        number.update(zip(number, range(len(number))))
        local = np.fromiter(map(number.__getitem__, flat), np.int32, len(flat))
        del flat
        codes = np.fromiter((END if w == b" " else word_code(w) for w in number), np.uint64, len(number))
        distinct, where = np.unique(codes, return_inverse=True)
        tokens = where.astype(np.int32)[local]
        out = table.column("held").to_numpy().astype(bool)
        counts = np.bincount(tokens[np.repeat(~out, sizes)], minlength=len(distinct))
        values = [table.column("block")[0].as_py(), _pack(sizes), _pack(out), _pack(distinct), _pack(counts.astype(np.int64)), _pack(tokens)]
        kinds = [pa.int64(), *[pa.binary()] * 5]
        columns = [pa.array([v], k) for v, k in zip(values, kinds)]
        columns.append(pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())))
        return pa.table(columns, ["block", "sizes", "held", "codes", "counts", "tokens", "ids"])

    dealt = slim.withColumn("block", F.pmod(F.xxhash64("id", "b"), F.lit(many)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), many // 4)
    dealt = dealt.repartition(parts, "block")
    return dealt.groupBy("block").applyInArrow(tidy_group(run), "block long, sizes binary, held binary, codes binary, counts binary, tokens binary, ids array<long>")


def _counted(blocks: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """Training counts of every block's codes by bucket, and totals by class: words and distinct words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "codes", "counts"))):
                c, n = _unpack(codes, np.uint64), _unpack(counts, np.int64)
                bucket = (_scramble(c) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order))
                cut = [order[s:e] for s, e in zip(edges[:-1], edges[1:])]
                columns = [
                    pa.array([int(bucket[k[0]]) for k in cut], pa.int32()),
                    pa.array([block] * len(cut), pa.int64()),
                    pa.array([_pack(np.diff(c[k], prepend=np.uint64(0))) for k in cut], pa.binary()),
                    pa.array([_pack(n[k]) for k in cut], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "codes", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        codes = [np.cumsum(_unpack(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("codes")]
        counts = np.concatenate([_unpack(x.as_py(), np.int64) for x in table.column("counts")])
        distinct, inverse = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, counts)
        known = total > 0
        kind = (distinct & _LOW).astype(np.int64)
        per_class = np.stack([np.bincount(kind, total, CLASSES), np.bincount(kind[known], minlength=CLASSES)]).astype(np.int64)
        ends = np.cumsum([len(x) for x in codes])
        blocks = [*table.column("block").to_pylist(), None]
        packed = [*(_pack(total[inverse[e - len(x) : e]]) for x, e in zip(codes, ends)), None]
        stats = [*[None] * len(codes), per_class.ravel().tolist()]
        bucket = table.column("bucket")[0].as_py()
        return pa.table({"bucket": pa.array([bucket] * len(blocks), pa.int32()), "block": pa.array(blocks, pa.int64()), "counts": pa.array(packed, pa.binary()), "stats": pa.array(stats, pa.list_(pa.int64()))})

    asked = blocks.select("block", "codes", "counts").mapInArrow(tidy(ask), "bucket int, block long, codes binary, counts binary")
    replies = materialize(asked.groupBy("bucket").applyInArrow(tidy_group(answer), "bucket int, block long, counts binary, stats array<long>"), "counts")
    totals = replies.where("block is null").select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n"))
    return replies.where("block is not null").select("bucket", "block", "counts"), totals


def _counted_grams(blocks: DataFrame, parts: int) -> DataFrame:
    """Training counts of every block's ``grams`` and of their slots; buckets are numbered after those of the words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "sizes", "held", "codes", "tokens"))):
                sizes, out, codes, tokens = (_unpack(x, t) for x, t in zip(row, (np.int64, bool, np.uint64, np.int32)))
                stream, train = codes[tokens], np.repeat(~out, sizes)
                for k in GRAMS:
                    distinct, which = np.unique(grams(stream, sizes, k), return_inverse=True)
                    counts = np.bincount(which[train], minlength=len(distinct))
                    bucket, edges = _cuts(distinct, parts)
                    ends = list(zip(edges[:-1], edges[1:]))
                    for some in range(0, len(ends), 256):
                        cut = ends[some : some + 256]
                        columns = [
                            pa.array((bucket[some : some + 256] + parts * (1 + k)).astype(np.int32)),
                            pa.array([block] * len(cut), pa.int64()),
                            pa.array([_pack(np.diff(distinct[b:e], prepend=np.uint64(0))) for b, e in cut], pa.binary()),
                            pa.array([_pack(counts[b:e]) for b, e in cut], pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "codes", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpack(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("codes")]
        distinct = np.unique(np.concatenate(keys))
        total = np.zeros(len(distinct), np.int64)
        for own, counts in zip(keys, table.column("counts")):
            total[np.searchsorted(distinct, own)] += _unpack(counts.as_py(), np.int64)
        slot = distinct >> WORD_BITS
        new = np.append(True, slot[1:] != slot[:-1])
        slots = np.add.reduceat(total, np.flatnonzero(new))[np.cumsum(new) - 1]
        at = [np.searchsorted(distinct, own) for own in keys]
        values = [pa.array([_pack(x[a]) for a in at], pa.binary()) for x in (total, slots)]
        return pa.table([table.column("bucket"), table.column("block"), *values], ["bucket", "block", "counts", "slots"])

    asked = blocks.select("block", "sizes", "held", "codes", "tokens").mapInArrow(tidy(ask), "bucket int, block long, codes binary, counts binary")
    return materialize(asked.groupBy("bucket").applyInArrow(tidy_group(answer), "bucket int, block long, counts binary, slots binary"), "grams", compression="none")


def _trained(blocks: DataFrame, rounds: int) -> np.ndarray:
    """The weights after ``rounds`` passes over all training documents."""
    spark = blocks.sparkSession
    weights = np.zeros((FEATURES * SLOTS + 1, CLASSES), np.float32)
    pieces = 16
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(weights)  # FEATURES * SLOTS * CLASSES numbers, whatever the input

        @tidy
        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start = sent.value
            total, often = np.zeros(start.shape, np.float64), np.zeros(len(start), np.int64)
            for batch in batches:
                for sizes, out, codes, tokens in zip(*(batch.column(c).to_pylist() for c in ("sizes", "held", "codes", "tokens"))):
                    sizes, out = _unpack(sizes, np.int64), _unpack(out, bool)
                    flat = _unpack(codes, np.uint64)[_unpack(tokens, np.int32)]
                    use = np.flatnonzero(np.repeat(~out, sizes))
                    own, square, touched = start.copy(), np.full(start.shape, 1.0, np.float32), np.zeros(len(start), np.int64)
                    train_on(own, square, touched, contexts(flat, sizes)[use], (flat[use] & _LOW).astype(np.int64))
                    own -= start
                    total += own * touched[:, None].astype(np.float64)
                    often += touched
            if often.any():
                for k in range(pieces):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([total[k::pieces].tobytes()], pa.binary()), pa.array([often[k::pieces].tobytes()], pa.binary())],
                        ["piece", "move", "touched"],
                    )

        def add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            move = touched = None
            for batch in tables:
                for m, t in zip(batch.column("move"), batch.column("touched")):
                    m, t = np.frombuffer(m.as_buffer()), np.frombuffer(t.as_buffer(), np.int64)
                    move, touched = (m.copy(), t.copy()) if move is None else (move + m, touched + t)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([move.tobytes()], pa.binary()), pa.array([touched.tobytes()], pa.binary())], ["piece", "move", "touched"])

        fields = "piece int, move binary, touched binary"
        moves = blocks.select("sizes", "held", "codes", "tokens").mapInArrow(walk, fields)
        moves = materialize(moves.groupBy("piece").applyInArrow(add, fields), "moves").collect()  # one row per piece of the weights
        for piece, move, touched in moves:
            t = np.frombuffer(touched, np.int64)[:, None]
            weights[piece::pieces] += (np.frombuffer(move).reshape(-1, CLASSES) / np.maximum(t, 1)).astype(np.float32)
        sent.unpersist()
    return weights


def score_documents(docs: DataFrame, text: str = "text", folds: int = 7, held: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Tokens are the words between ASCII white space, A-Z in lower case, and one
    end; a null text is an empty one and has just that.  Documents whose
    crc32(doc_id) mod ``folds`` is ``held`` are scored but neither counted nor
    trained on; a null id counts as the empty text there.  ``base_score`` is the
    add-one unigram log10 probability, ``score`` the model's.  Words are told
    apart by 60-bit hashes; contexts share 2^40 slots with the classes, and in a
    slot words are told apart by 24 bits.  Repeated rows are documents of their own, other
    columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    blocks = materialize(_blocks(docs, text, folds, held), "tokens", compression="none")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // BUCKET_BLOCKS))
    replies, totals = _counted(blocks, parts)
    replies = replies.withColumn("slots", F.lit(None).cast("binary")).unionByName(_counted_grams(blocks, parts))
    flat = np.zeros(2 * CLASSES, np.int64)
    for pos, n in totals.collect():  # two numbers per class
        flat[pos] = n
    words, distinct = flat[:CLASSES], flat[CLASSES:]
    n_all, v_all = int(words.sum()), int(distinct.sum())
    weights = _trained(blocks, rounds)
    sent = spark.sparkContext.broadcast(weights)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        model = sent.value
        by_bucket = {b: pair for b, *pair in zip(*(right.column(c).to_pylist() for c in ("bucket", "counts", "slots")))}
        done = []
        for k in range(left.num_rows):
            r = {c: left.column(c)[k].as_py() for c in ("sizes", "held", "codes", "tokens", "ids")}
            sizes, out, codes, tokens = _unpack(r["sizes"], np.int64), _unpack(r["held"], bool), _unpack(r["codes"], np.uint64), _unpack(r["tokens"], np.int32)
            bucket = (_scramble(codes) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            count = np.zeros(len(codes), np.int64)
            edges = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order))
            for s, e in zip(edges[:-1], edges[1:]):
                count[order[s:e]] = _unpack(by_bucket[int(bucket[order[s]])][0], np.int64)
            kind = (codes & _LOW).astype(np.int64)
            base = np.log10((count + 1) / (n_all + v_all + 1))
            inside = ((count + 1) / (words[kind] + distinct[kind] + 1))[tokens]
            stream = codes[tokens]
            features = contexts(stream, sizes)
            for k in GRAMS:
                keys, where = np.unique(grams(stream, sizes, k), return_inverse=True)
                answers = [by_bucket[int(b) + parts * (1 + k)] for b in _cuts(keys, parts)[0]]
                n, whole = (np.concatenate([_unpack(x[c], np.int64) for x in answers])[where] for c in (0, 1))
                inside = (n + PRIOR * inside) / (whole + PRIOR)
            token_class = kind[tokens]
            own = np.empty(len(tokens))
            for s in range(0, len(tokens), STEP):
                e = slice(s, s + STEP)
                own[e] = class_log(model, features[e])[np.arange(len(token_class[e])), token_class[e]]
            starts = np.cumsum(sizes) - sizes
            total = lambda x: np.add.reduceat(x, starts)
            done.append(
                pa.table(
                    {
                        "doc_id": pa.array(r["ids"], pa.int64()),
                        "held_out": pa.array(out),
                        "n_tokens": pa.array(sizes),
                        "n_known": pa.array(total((count[tokens] > 0).astype(np.int64))),
                        "train_tokens": pa.array(np.full(len(sizes), n_all, np.int64)),
                        "base_score": pa.array(total(base[tokens])),
                        "score": pa.array(total(own / np.log(10) + np.log10(inside))),
                    }
                )
            )
        return pa.concat_tables(done)

    slim = blocks.select("block", "sizes", "held", "codes", "tokens", "ids")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return slim.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(tidy_group(judge), schema)
