"""MinHash near-duplicates with odd sketches.

Every document's set of word shingles gives ``SAMPLES`` MinHash values.  Bands
of them find candidates; folded into a bitmap whose bits are parities (an odd
sketch), they tell by the population count of an XOR how many samples differ,
which for high similarities is precise enough to drop nearly every candidate
that is no link.  A second bitmap, the odd sketch of the whole set, bounds the
symmetric difference from below, so it drops near misses and never a link.
What is left is confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import Bounded, as_bytes, chunks, map_arrow
from curata.operators.graph import connected_components
from curata.storage import materialize

SAMPLES = 240
#: Bands of rows: a pair at a similarity of 0.8 shares no band once in 190,000 times, at 0.85 once in 10^8;
#: a pair at 0.1 shares one once in 25,000 times.
BANDS, ROWS = 40, 6
#: Bits of an odd sketch, in 64-bit words.
SKETCH_WORDS = 16
#: A candidate is dropped only if its estimate is this far below the threshold: over five standard deviations of a
#: pair at 0.8, which are 0.026 by the samples and 0.013 by the bitmap.
SLACK = 0.15
#: Bytes of text that are sketched at once.
SKETCH_BYTES = 1 << 20


_MUL = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[bytes], words_each: int, cache: dict) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of ``words_each`` words; fewer words are one shingle, none an empty set.

    A-Z are lower-cased; words are what lies between ASCII white space.
    """
    lists = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in lists], np.int64)
    flat = np.fromiter(map(cache.__getitem__, [w for ws in lists for w in ws]), np.uint64, int(counts.sum()))
    joined = _scramble(flat)
    n = len(flat)
    for j in range(1, words_each):
        if n > j:
            joined[: n - j] = _scramble(joined[: n - j] * _MUL + flat[j:])
    out = []
    begin = 0
    for c in counts.tolist():
        if c >= words_each:
            s = np.sort(joined[begin : begin + c - words_each + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif c:
            one = flat[begin : begin + 1].copy()
            for k in range(1, c):
                one = _scramble(one * _MUL + flat[begin + k])
            out.append(_scramble(one + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        begin += c
    return out


class Sketcher:
    def __init__(self, samples: int = SAMPLES, bands: int = BANDS, rows: int = ROWS, words: int = SKETCH_WORDS):
        rng = np.random.default_rng(20_240_601)
        self.xor = rng.integers(0, 2**32, samples, np.uint32)[:, None]
        self.mul = (rng.integers(0, 2**31, samples, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.bands, self.rows, self.bits = bands, rows, words * 64
        self.salt = rng.integers(0, 2**63, samples, np.uint64)

    def samples(self, s: np.ndarray) -> np.ndarray:
        x = (s >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.xor), 0xFFFFFFFF, np.uint32)
        for a in range(0, len(x), 2048):
            low = np.minimum(low, ((x[None, a : a + 2048] ^ self.xor) * self.mul).min(1))
        return low

    def parities(self, sets: list[np.ndarray]) -> np.ndarray:
        """Odd sketches [n, words] of whole sets: two of them differ in no more bits than the sets differ in elements."""
        odd = np.zeros((len(sets), self.bits), np.uint8)
        for row, s in zip(odd, sets):
            at = (_scramble(s * _MUL + self.salt[0]) % np.uint64(self.bits)).astype(np.int64)
            row[:] = np.bincount(at, minlength=self.bits) & 1
        return np.packbits(odd, axis=1).view(np.int64)

    def fold(self, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys [n, bands] and odd sketches [n, words] of signatures [n, samples]."""
        sig = signatures.astype(np.uint64)
        keys = np.zeros((len(sig), self.bands), np.uint64)
        for r in range(self.rows):
            keys = _scramble(keys * _MUL + sig[:, r : self.bands * self.rows : self.rows] + np.uint64(1))
        keys = _scramble(keys + np.arange(self.bands, dtype=np.uint64))
        at = (_scramble(sig * _MUL + self.salt) % np.uint64(self.bits)).astype(np.int64)
        cells = (np.arange(len(sig))[:, None] * self.bits + at).ravel()
        odd = (np.bincount(cells, minlength=len(sig) * self.bits) & 1).astype(np.uint8).reshape(len(sig), -1)
        return keys.view(np.int64), np.packbits(odd, axis=1).view(np.int64)


def differing_bits(similarity: float, samples: int = SAMPLES, bits: int = SKETCH_WORDS * 64) -> int:
    """Bits in which the odd sketches of two sets of this similarity differ, on average."""
    return round(bits / 2 * (1 - math.exp(-4 * samples * (1 - similarity) / bits)))


#: Words of the odd sketch of the samples, and of that of the whole set.
SAMPLE_COLUMNS, SET_COLUMNS = [f"s{k}" for k in range(SKETCH_WORDS)], [f"w{k}" for k in range(SKETCH_WORDS)]
SKETCH_COLUMNS = SAMPLE_COLUMNS + SET_COLUMNS


def sketches(docs: DataFrame, words_each: int, text: str = "text") -> DataFrame:
    """``id, n, c0, c1, bands, s0..``: set size, two hashes of the whole set, band keys and the words of both odd sketches."""
    schema = "id long, n long, c0 long, c1 long, bands array<long>, " + ", ".join(f"{c} long" for c in SKETCH_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, sketcher = Bounded(xxhash.xxh3_64_intdigest), Sketcher()
        for batch in chunks(batches, "b", SKETCH_BYTES):
            sets = shingle_sets(batch.column("b").to_pylist(), words_each, cache)
            keys, odd = sketcher.fold(np.stack([sketcher.samples(s) for s in sets]))
            odd = np.concatenate([odd, sketcher.parities(sets)], 1)
            n = np.array([len(s) for s in sets], np.int64)
            c = np.array([[xxhash.xxh3_64_intdigest(s.tobytes(), k) for k in (0, 1)] for s in sets], np.uint64).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            columns = [batch.column("id"), pa.array(n), pa.array(c[:, 0]), pa.array(c[:, 1]), flat, *(pa.array(odd[:, k]) for k in range(odd.shape[1]))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "c0", "c1", "bands", *SKETCH_COLUMNS])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("id"), as_bytes(text).alias("b")), run, schema)


def full_sets(docs: DataFrame, words_each: int, text: str) -> DataFrame:
    """``id, shingles`` with the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Bounded(xxhash.xxh3_64_intdigest)
        for batch in chunks(batches, "b", SKETCH_BYTES):
            sets = shingle_sets(batch.column("b").to_pylist(), words_each, cache)
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "shingles"])

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("id"), as_bytes(text).alias("b")), run, schema)


def _differ(columns: list[str]) -> Column:
    """Population count of the XOR of ``a_*`` and ``b_*`` of these columns."""
    total = None
    for c in columns:
        one = F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}")))
        total = one if total is None else total + one
    return total


def _may_link(percent: int) -> Column:
    """Whether sizes and odd sketches of a and b leave a link possible."""
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    whole = _differ(SET_COLUMNS) * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)
    return sizes & whole & (_differ(SAMPLE_COLUMNS) <= differing_bits(percent / 100 - SLACK))


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Two documents are linked if ``100 * |intersection| >= percent * |union|``
    of their sets of ``words_each``-word shingles (64-bit hashes of them);
    ``component_id`` is the smallest doc_id that links reach, itself included,
    and ``kept`` says whether that is the document's own.  A null text is
    empty, and documents without words are linked with nothing.  Rows that
    share a doc_id are one node with the links of all.  A null doc_id has
    neither links nor component and is kept.  Other columns are ignored; an
    empty table gives no rows.

    Equal sets are one class, named by its smallest doc_id, before anything
    is paired.  First every class is paired with one other, the smallest that
    it shares a bucket of a band with; then, in each bucket, members that are
    not connected to its smallest with that one; then what is still not
    connected to it with all others of another component.  After that every
    pair that shares a bucket has been tried or is connected, and no bucket's
    pairs were listed.
    """
    spark = docs.sparkSession
    sk = materialize(sketches(docs, words_each, text), "sketch")
    known = sk.where("n > 0 and id is not null")
    firsts = [F.first(c).alias(c) for c in ["n", "bands", *SKETCH_COLUMNS]]
    classes = materialize(known.groupBy("c0", "c1").agg(F.min("id").alias("rep"), *firsts), "class")
    buckets = classes.select("rep", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("m")).where("m > 1")
    buckets = materialize(buckets.join(leaders, "key"), "bucket")
    odd = classes.select("rep", "n", *SKETCH_COLUMNS)

    def side(name: str) -> DataFrame:
        return odd.select(F.col("rep").alias(name), F.col("n").alias(f"{name}_n"), *[F.col(c).alias(f"{name}_{c}") for c in SKETCH_COLUMNS])

    def possible(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those that the sketches leave."""
        return pairs.join(side("b"), "b").join(side("a"), "a").where(_may_link(percent)).select("a", "b")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those that are links, by the full sets."""
        likely = materialize(pairs, "pair")
        need = likely.select(F.col("a").alias("doc_id")).unionAll(likely.select("b")).distinct()
        if need.isEmpty():
            return spark.createDataFrame([], "a long, b long")
        plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
        sets = materialize(full_sets(plain.join(need, "doc_id", "left_semi"), words_each, "text").dropDuplicates(["id", "shingles"]), "set")
        left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
        both = likely.join(right, "b").join(left, "a")
        shared = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - shared
        return materialize(both.where(shared * 100 >= union * percent).select("a", "b").distinct(), "link")

    def apart(links: DataFrame) -> DataFrame:
        """The buckets' rows with the components of member and smallest as far as ``links`` go."""
        comps = connected_components(links, "a", "b")
        rows = buckets.join(comps.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep", "left")
        rows = rows.join(comps.select(F.col("node").alias("leader"), F.col("component").alias("lead_comp")), "leader", "left")
        return rows.withColumns({"comp": F.coalesce("comp", "rep"), "lead_comp": F.coalesce("lead_comp", "leader")})

    pairs = buckets.where("rep != leader").groupBy("rep").agg(F.min("leader").alias("a")).select("a", F.col("rep").alias("b"))
    links = confirmed(possible(pairs))
    pairs = apart(links).where("comp != lead_comp").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = links.unionAll(confirmed(possible(pairs)))
    # doc_ids with several rows tie the classes of those rows
    owned = known.join(classes.select("c0", "c1", "rep"), ["c0", "c1"]).select("id", "rep").distinct()
    several = owned.groupBy("id").agg(F.min("rep").alias("a"), F.count("*").alias("k")).where("k > 1")
    same = owned.join(several, "id").where("rep != a").select("a", F.col("rep").alias("b"))
    named = materialize(apart(links).where("m > 2 and rep != leader").select("key", "rep", "comp", "lead_comp"), "named")
    bands = classes.select("rep", "bands")
    rest = named.where("comp != lead_comp").select("key", F.col("rep").alias("a"), F.col("comp").alias("a_comp"))
    rest = rest.join(side("a"), "a").join(bands.select(F.col("rep").alias("a"), F.col("bands").alias("a_bands")), "a")
    some = named.join(rest.select("key").distinct(), "key", "left_semi").select("key", F.col("rep").alias("b"), F.col("comp").alias("b_comp"))
    some = some.join(side("b"), "b").join(bands.select(F.col("rep").alias("b"), F.col("bands").alias("b_bands")), "b")
    once = F.get(F.array_intersect("a_bands", "b_bands"), F.lit(0)) == some["key"]
    more = some.join(rest, (some["key"] == rest["key"]) & (F.col("a_comp") != F.col("b_comp")) & _may_link(percent) & once)
    more = more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.unionAll(confirmed(more))
    comps = connected_components(links.unionAll(same), "a", "b")
    out = sk.join(classes.select("c0", "c1", "rep"), ["c0", "c1"], "left")
    out = out.withColumn("rep", F.when(F.col("n") > 0, F.col("rep")))
    out = out.join(comps, out.rep == comps.node, "left")
    found = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), found.alias("component_id"), F.coalesce(found == F.col("id"), F.lit(True)).alias("kept"))
