"""Removing repeated passages with a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id.  Sorting every suffix of a corpus would move
each byte many times over, so the sort gets only what can matter:

1. Of each run of ``LENGTH - GRAM + 1`` grams the smallest hash is an anchor,
   so equal strings of ``LENGTH`` bytes have an equal anchor at the same place.
   Anchors (48-bit hashes) are dealt into buckets; one that two documents have
   is a candidate.
2. Every group of documents gathers the distinct surroundings of its candidate
   anchors: all strings of ``LENGTH`` bytes around it, with the smallest and
   largest doc_id of the group.
3. An anchor with one surrounding needs no sort.  Of the others the suffixes
   are sorted.  Prefix polynomial hashes and binary search give the common
   extension of two suffixes, so a comparison takes a logarithmic number of
   steps.  Where a merge meets two suffixes that agree on ``LENGTH`` bytes,
   verified byte by byte, it folds one into the other with the smaller doc_id;
   what is folded together at the end is one string and has one smallest doc_id.
4. The groups remove what a smaller doc_id has.

Buckets and groups are numbered in proportion to the bytes of the input, so
each stays at a few megabytes; long texts are looked at in overlapping windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import as_bytes, chunks, map_arrow, tidy_group
from curata.storage import discard, materialize, sweep

LENGTH, GRAM = 50, 24
LEFT = LENGTH - GRAM
WIDE = LEFT + LENGTH
#: Bytes of text in a group of documents, and in what a bucket of anchors stands for.
GROUP_BYTES = 4 << 20
#: Bytes whose anchors are found at once; a longer text has windows that overlap by ``WIDE`` on both sides.
PIECE_BYTES = 1 << 19
#: Anchors that a task deals into buckets at once.
DEAL = 600_000
#: Surroundings whose suffixes are sorted at once.
SORT_ROWS = 12_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[int(base)] = have
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes: a substring's hash is ``(p[j] - p[i]) * base**-i``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=out[1:])
    return out


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (a ufunc like minimum) over every ``width`` neighbours."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


class Anchors:
    """Anchors of stretches of documents laid end to end: document, place in it, gram hash, and what lies around them.

    ``spans`` has (number of the text, first byte laid out, end, first byte whose anchors count, end of those).
    """

    def __init__(self, texts: list[bytes], spans: list[tuple[int, int, int, int, int]]):
        of, low, high, begin, stop = (np.array(x, np.int64) for x in zip(*spans))
        sizes = high - low
        ends = np.cumsum(sizes)
        shift = ends - sizes - low  # from a place in a document to one in the data
        self.data = np.frombuffer(b"".join(texts[k][a:b] for k, a, b, *_ in spans), np.uint8)
        n = len(self.data)
        none = np.zeros(0, np.int64)
        self.at, self.doc, self.place, self.left, self.right, self.gram = none, none, none, none, none, np.zeros(0, np.uint64)
        if n < LENGTH or not (sizes >= LENGTH).any():
            self.prefix = np.zeros(n + 1, np.uint64)
            return
        self.prefix = prefix_hashes(self.data)
        h = self.prefix[GRAM:] - self.prefix[:-GRAM]
        h *= _power(_BACK, n + 1)[: n - GRAM + 1]
        h = _mix(h)
        rank = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # 0 is kept for strings that no document holds
        best = _slide(rank, LEFT + 1, np.minimum)  # of the string that starts at each place
        for e in ends[:-1]:
            best[max(0, e - LENGTH + 1) : e] = 0
        edge = np.zeros(LEFT, np.uint32)
        self.at = np.flatnonzero(_slide(np.concatenate((edge, best, edge)), LEFT + 1, np.maximum) == rank)
        span = np.searchsorted(ends, self.at, "right")
        place = self.at - shift[span]
        own = (place >= begin[span]) & (place < stop[span])
        self.at, span, self.place = self.at[own], span[own], place[own]
        self.doc = of[span]
        self.gram = (h[self.at] >> np.uint64(16)) + np.uint64(1)
        self.left = np.minimum(LEFT, self.place - low[span])
        self.right = np.minimum(LENGTH, high[span] - self.place)

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("at", "doc", "place", "left", "right", "gram"):
            setattr(self, name, getattr(self, name)[chosen])

    def around(self) -> np.ndarray:
        """Hashes of the bytes from ``left`` (up to LEFT) before to ``right`` (up to LENGTH) after each anchor in its document."""
        start, stop = self.at - self.left, self.at + self.right
        h = (self.prefix[stop] - self.prefix[start]) * _power(_BACK, len(self.data) + 1)[start]
        return _mix(h + _mix((self.left * 64 + self.right).astype(np.uint64)))

    def stretches(self) -> np.ndarray:
        """The bytes around the anchors, [n, WIDE], zero where the document has none."""
        index = self.at[:, None] + np.arange(-LEFT, LENGTH)
        k = np.arange(WIDE)
        there = (k >= LEFT - self.left[:, None]) & (k < LEFT + self.right[:, None])
        return np.where(there, self.data[np.clip(index, 0, len(self.data) - 1)], 0).astype(np.uint8)


def anchors_of(texts: list[bytes]) -> Iterator[Anchors]:
    """The anchors of whole texts; of one that is long, window by window."""
    held, size = [], 0
    for k, t in enumerate(texts):
        n = len(t)
        for begin in range(0, n, PIECE_BYTES):
            stop = min(n, begin + PIECE_BYTES)
            held.append((k, max(0, begin - WIDE), min(n, stop + WIDE), begin, stop))
            size += stop - begin
            if size >= PIECE_BYTES:
                yield Anchors(texts, held)
                held, size = [], 0
    if held:
        yield Anchors(texts, held)


class SuffixSort:
    """Sorts suffixes, given as (row, offset), of rows of bytes by their first ``LENGTH`` bytes and folds equal ones."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n, width = rows.shape
        self.prefix = np.zeros((n, width + 1), np.uint64)
        np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * _power(_BASE, width), axis=1, out=self.prefix[:, 1:])
        self.back = _power(_BACK, width + 1)
        flat = np.ascontiguousarray(rows).ravel()
        # the eight bytes from every place on, as one big-endian number
        self.words = np.zeros(len(flat), np.uint64)
        for j in range(8):
            self.words[: len(flat) - j] |= flat[j:].astype(np.uint64) << np.uint64(56 - 8 * j)

    def _hash(self, row: np.ndarray, offset: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[row, offset + length] - self.prefix[row, offset]) * self.back[offset]

    def common(self, r1: np.ndarray, o1: np.ndarray, r2: np.ndarray, o2: np.ndarray, least: int = 0) -> np.ndarray:
        """Length of the common extension, up to LENGTH, by binary search over prefix hashes; ``least`` bytes are known to agree."""
        low = np.full(len(r1), least, np.int64)
        high = np.full(len(r1), LENGTH, np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._hash(r1, o1, middle) == self._hash(r2, o2, middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def compare(self, r1: np.ndarray, o1: np.ndarray, r2: np.ndarray, o2: np.ndarray, least: int = 0) -> np.ndarray:
        """-1, 0 or 1."""
        out = np.zeros(len(r1), np.int8)
        apart = np.flatnonzero(self._hash(r1, o1, LENGTH) != self._hash(r2, o2, LENGTH))
        r1, o1, r2, o2 = r1[apart], o1[apart], r2[apart], o2[apart]
        last = np.minimum(self.common(r1, o1, r2, o2, least), LENGTH - 1)
        a, b = self.rows[r1, o1 + last], self.rows[r2, o2 + last]
        out[apart] = np.where(a < b, -1, 1)
        return out

    def folded(self, row: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct strings in order, each by one suffix that has it, and for every suffix the one that has its string.

        The first 16 bytes are sorted as two words.  What ties there goes
        through a bottom-up mergesort, all pairs of runs at once: an element of
        a right run finds its rank in the left one by binary search, or the
        equal element there that it is folded into.  So runs hold distinct
        strings, and what many rows share shrinks from level to level.
        """
        n, width = len(row), self.rows.shape[1]
        owner = np.arange(n)
        if not n:
            return owner, owner
        place = row.astype(np.int64) * width + offset
        first, second = self.words[place], self.words[place + 8]
        item = np.lexsort((second, first))
        head = np.append(True, (first[item[1:]] != first[item[:-1]]) | (second[item[1:]] != second[item[:-1]]))
        segment = np.cumsum(head) - 1
        sizes = np.bincount(segment)
        run = np.arange(n) - (np.cumsum(sizes) - sizes)[segment]
        done_items, done_segments = [], []
        while True:
            several = (np.bincount(segment, run, len(sizes)) > 0)[segment]  # a segment with more than one run
            done_items.append(item[~several])
            done_segments.append(segment[~several])
            item, segment, run = item[several], segment[several], run[several]
            if not len(item):
                break
            new = np.append(True, (segment[1:] != segment[:-1]) | (run[1:] >> 1 != run[:-1] >> 1))
            begin = np.flatnonzero(new)  # of the pairs of runs
            pair = np.cumsum(new) - 1
            odd = (run & 1).astype(bool)
            lefts = np.bincount(pair, ~odd, len(begin)).astype(np.int64)
            me = np.flatnonzero(odd)
            low = begin[pair[me]]
            high = low + lefts[pair[me]]
            base = low.copy()
            match = np.full(len(me), -1)
            active = np.flatnonzero(low < high)
            while len(active):
                middle = (low[active] + high[active]) >> 1
                p, q = item[middle], item[me[active]]
                sign = self.compare(row[p], offset[p], row[q], offset[q], 16)
                low[active] = np.where(sign < 0, middle + 1, low[active])
                high[active] = np.where(sign < 0, high[active], middle)
                match[active] = np.where(sign == 0, middle, -1)
                active = active[(sign != 0) & (low[active] < high[active])]
            equal = match >= 0
            a, b = item[match[equal]], item[me[equal]]
            if self.differ(place[a], place[b]):
                return self._by_bytes(row, offset)
            owner[b] = a
            stays = np.ones(len(item), bool)
            stays[me[equal]] = False
            me, rank = me[~equal], (low - base)[~equal]
            left_items = np.flatnonzero(~odd)
            kept = np.bincount(pair[stays], minlength=len(begin))
            start = np.cumsum(kept) - kept
            rights = np.bincount(pair[me], minlength=len(begin))
            nth = np.arange(len(me)) - (np.cumsum(rights) - rights)[pair[me]]
            target = start[pair[me]] + rank + nth
            order = np.empty(int(kept.sum()), np.int64)
            free = np.ones(len(order), bool)
            free[target] = False
            order[target] = me
            order[free] = left_items
            item, segment, run = item[order], segment[order], run[order] >> 1
        items, segments = np.concatenate(done_items), np.concatenate(done_segments)
        while True:
            up = owner[owner]
            if (up == owner).all():
                return items[np.argsort(segments, kind="stable")], owner
            owner = up

    def differ(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Collision verification: whether strings at two places that hashes call equal differ in a byte."""
        return any((self.words[a + k] != self.words[b + k]).any() for k in (0, 8, 16, 24, 32, 40, LENGTH - 8))

    def _by_bytes(self, row: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same without hashes, for the case that two strings have one hash."""
        whole = self.rows[row[:, None], offset[:, None] + np.arange(LENGTH)]
        _, some, of = np.unique(whole, axis=0, return_index=True, return_inverse=True)
        return some, some[of.ravel()]


def smallest_owner(rows: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every row and string offset 0..LEFT the smallest ``doc`` of a row that has this string; int64 max where there is none."""
    out = np.full((len(rows), LEFT + 1), np.iinfo(np.int64).max)
    o = np.arange(LEFT + 1)
    row, offset = np.nonzero((o >= LEFT - left[:, None]) & (o + LENGTH <= LEFT + right[:, None]))
    if not len(row):
        return out
    row, offset = row.astype(np.int32), offset.astype(np.int32)
    _, owner = SuffixSort(rows).folded(row, offset)
    least = np.full(len(row), np.iinfo(np.int64).max)
    np.minimum.at(least, owner, doc[row])
    out[row, offset] = least[owner]
    return out


def owners(rows: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """``smallest_owner`` of many rows, by anchors: equal strings lie around equal grams at the same place.

    A gram with one row needs no sort, and the others are sorted a few at a
    time; one with very many rows offset by offset, by the first bytes there.
    """
    out = np.full((len(rows), LEFT + 1), np.iinfo(np.int64).max)
    o = np.arange(LEFT + 1)
    valid = (o >= LEFT - left[:, None]) & (o + LENGTH <= LEFT + right[:, None])
    grams = np.ascontiguousarray(rows[:, LEFT : LEFT + GRAM]).view(np.uint64).reshape(len(rows), -1)
    order = np.lexsort(grams.T)
    starts = np.flatnonzero(np.append(True, (grams[order[1:]] != grams[order[:-1]]).any(1)))
    sizes = np.diff(np.append(starts, len(rows)))
    alone = order[starts[sizes == 1]]
    out[alone] = np.where(valid[alone], doc[alone][:, None], out[alone])
    many = np.flatnonzero(sizes > 1)
    batch, held = [], 0
    for k in many:
        if sizes[k] > SORT_ROWS:
            own = order[starts[k] : starts[k] + sizes[k]]
            for at in range(LEFT + 1):
                _one_offset(rows, own[valid[own, at]], at, doc, out)
            continue
        batch.append(order[starts[k] : starts[k] + sizes[k]])
        held += sizes[k]
        if held >= SORT_ROWS:
            own = np.concatenate(batch)
            out[own] = smallest_owner(rows[own], left[own], right[own], doc[own])
            batch, held = [], 0
    if batch:
        own = np.concatenate(batch)
        out[own] = smallest_owner(rows[own], left[own], right[own], doc[own])
    return out


def _one_offset(rows: np.ndarray, own: np.ndarray, at: int, doc: np.ndarray, out: np.ndarray) -> None:
    """The strings of very many rows at one offset: rows that agree on the first 32 bytes are sorted together."""
    if not len(own):
        return
    words = np.ascontiguousarray(rows[own, at : at + 32]).view(np.uint64).reshape(len(own), -1)
    order = np.lexsort(words.T)
    cuts = np.flatnonzero((words[order[1:]] != words[order[:-1]]).any(1)) + 1
    begin = 0
    while begin < len(own):
        k = np.searchsorted(cuts, begin + SORT_ROWS)
        stop = int(cuts[k]) if k < len(cuts) else len(own)
        some = own[order[begin:stop]]
        _, owner = SuffixSort(rows[some]).folded(np.arange(len(some), dtype=np.int32), np.full(len(some), at, np.int32))
        least = np.full(len(some), np.iinfo(np.int64).max)
        np.minimum.at(least, owner, doc[some])
        out[some, at] = least[owner]
        begin = stop


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _pieces(table: pa.Table, column: str) -> Iterator[pa.RecordBatch]:
    yield from chunks(iter(table.combine_chunks().to_batches()), column, PIECE_BYTES)


def remove_repeats(docs: DataFrame, text: str = "text", carry: bool = False, characters: bool = False) -> DataFrame:
    """What is left of every document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary).

    With ``carry`` also ``row``: the other columns and ``__had``, whether there
    was a text.  With ``characters`` a character of which a byte stays, stays.

    Texts are UTF-8 bytes and used whole; null is empty, and texts under 50
    bytes neither lose nor give anything.  All strings are judged on the input.
    Equal doc_ids do not remove from one another; a null doc_id takes no part
    and its row comes back unchanged.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text]
    row = F.struct(F.col(f"`{text}`").isNotNull().alias("__had"), *[F.col(f"`{c}`") for c in others if carry])
    base = docs.select(F.col("doc_id").cast("long").alias("id"), as_bytes(text).alias("b"), row.alias("row"))
    total = base.agg(F.sum(F.octet_length("b"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_BYTES))
    base = base.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    slim = base.where("id is not null").select("id", "g", "b")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            gram, ids, groups = (np.concatenate(x) for x in zip(*held))
            bucket = (gram % np.uint64(parts)).astype(np.int32)
            order = np.lexsort((ids, gram, bucket))
            gram, ids, groups, bucket = gram[order], ids[order], groups[order], bucket[order]
            new = np.append(True, (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1]))
            gram, ids, groups, bucket = gram[new], ids[new], groups[new], bucket[new]
            starts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            cut = list(zip(starts[:-1], starts[1:]))
            columns = [
                pa.array(bucket[starts[:-1]], pa.int32()),
                pa.array([_pack(np.diff(gram[s:e], prepend=np.uint64(0))) for s, e in cut], pa.binary()),
                pa.array([_pack(ids[s:e]) for s, e in cut], pa.binary()),
                pa.array([_pack(groups[s:e]) for s, e in cut], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "grams", "ids", "groups"])

        for batch in chunks(batches, "b", PIECE_BYTES):
            ids, groups = batch.column("id").to_numpy(), batch.column("g").to_numpy()
            for a in anchors_of(batch.column("b").to_pylist()):
                if len(a.at):
                    held.append((a.gram, ids[a.doc], groups[a.doc]))
                    size += len(a.at)
            if size >= DEAL:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    def shared(table: pa.Table) -> pa.Table:
        grams = np.concatenate([np.cumsum(_unpack(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("grams")])
        ids = np.concatenate([_unpack(x.as_py(), np.int64) for x in table.column("ids")])
        groups = np.concatenate([_unpack(x.as_py(), np.int32) for x in table.column("groups")])
        order = np.argsort(grams, kind="stable")
        grams, ids, groups = grams[order], ids[order], groups[order]
        starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        lengths = np.diff(np.append(starts, len(grams)))
        several = np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts)
        pick = np.repeat(several, lengths)
        grams, groups = grams[pick], groups[pick]
        order = np.lexsort((grams, groups))
        grams, groups = grams[order], groups[order]
        if not len(grams):
            return pa.table({"g": pa.array([], pa.int32()), "grams": pa.array([], pa.binary())})
        new = np.append(True, (grams[1:] != grams[:-1]) | (groups[1:] != groups[:-1]))
        grams, groups = grams[new], groups[new]
        starts = np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups))
        cut = list(zip(starts[:-1], starts[1:]))
        return pa.table({"g": pa.array([int(groups[s]) for s, _ in cut], pa.int32()), "grams": pa.array([_pack(grams[s:e]) for s, e in cut], pa.binary())})

    names = ["bucket", "g", "bytes", "left", "right", "hash", "low", "high"]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]

    def surround(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        if not right_table.num_rows or not left_table.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        wanted = np.unique(np.concatenate([_unpack(x.as_py(), np.uint64) for x in right_table.column("grams")]))
        g = left_table.column("g")[0].as_py()
        found = []
        for batch in _pieces(left_table, "b"):
            numbers = batch.column("id").to_numpy()
            for a in anchors_of(batch.column("b").to_pylist()):
                at = np.minimum(np.searchsorted(wanted, a.gram), len(wanted) - 1)
                a.keep(wanted[at] == a.gram)
                if not len(a.at):
                    continue
                h, ids = a.around(), numbers[a.doc]
                order = np.lexsort((ids, h))
                starts = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
                first = order[starts]
                high = np.maximum.reduceat(ids[order], starts)
                a.keep(first)
                found.append((a.gram, a.stretches(), a.left.astype(np.uint8), a.right.astype(np.uint8), h[first], ids[first], high))
        if not found:
            return pa.table([pa.array([], k) for k in kinds], names)
        gram, rows, left, right, h, low, high = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((low, h))
        starts = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
        first = order[starts]
        high = np.maximum.reduceat(high[order], starts)
        gram, rows, left, right, h, low = gram[first], rows[first], left[first], right[first], h[first], low[first]
        bucket = (gram % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((gram, bucket))
        edges = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order))
        out = []
        for s, e in zip(edges[:-1], edges[1:]):
            k = order[s:e]
            out.append((int(bucket[k[0]]), g, _pack(rows[k]), _pack(left[k]), _pack(right[k]), _pack(h[k]), _pack(low[k]), _pack(high[k])))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def judge(table: pa.Table) -> pa.Table:
        sizes, cols = [], {n: [] for n in names[2:]}
        read = {"bytes": np.uint8, "left": np.uint8, "right": np.uint8, "hash": np.uint64, "low": np.int64, "high": np.int64}
        for n, kind in read.items():
            cols[n] = [_unpack(x.as_py(), kind) for x in table.column(n)]
        sizes = [len(x) for x in cols["hash"]]
        rows = np.concatenate(cols["bytes"]).reshape(-1, WIDE)
        left, right, h, low, high = (np.concatenate(cols[n]) for n in ("left", "right", "hash", "low", "high"))
        # equal stretches of several groups are sorted once, as their smallest document's
        keys, inverse = np.unique(h, return_inverse=True)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, low)
        some = np.zeros(len(keys), np.int64)
        some[inverse] = np.arange(len(h))
        owner = owners(rows[some], left[some].astype(np.int64), right[some].astype(np.int64), least)
        out = []
        ends = np.cumsum(sizes)
        for k, g in enumerate(table.column("g").to_pylist()):
            part = np.arange(ends[k] - sizes[k], ends[k])
            part = part[owner[inverse[part]].min(1) < high[part]]
            if len(part):
                out.append((g, _pack(h[part]), _pack(owner[inverse[part]])))
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], ["g", "hash", "owner"])

    out_fields = [T.StructField(n, T.LongType()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    out_schema = T.StructType([*out_fields, T.StructField("kept", T.BinaryType()), base.schema["row"]])

    def remove(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        if right_table.num_rows:
            h = np.concatenate([_unpack(x.as_py(), np.uint64) for x in right_table.column("hash")])
            owner = np.concatenate([_unpack(x.as_py(), np.int64).reshape(-1, LEFT + 1) for x in right_table.column("owner")])
            order = np.argsort(h)
            h, owner = h[order], owner[order]
        else:
            h = np.zeros(0, np.uint64)
        done = []
        for batch in _pieces(left_table, "b"):
            texts = batch.column("b").to_pylist()
            ids = batch.column("id").to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(sizes)
            goes = np.zeros(int(sizes.sum()) + 1, np.int32)
            if len(h):
                number = np.array([np.iinfo(np.int64).min if x is None else x for x in ids], np.int64)
                for a in anchors_of(texts):
                    own = a.around()
                    at = np.minimum(np.searchsorted(h, own), len(h) - 1)
                    hit = np.flatnonzero(h[at] == own)
                    earlier = owner[at[hit]] < number[a.doc[hit]][:, None]
                    k, o = np.nonzero(earlier)
                    k = hit[k]
                    start = (ends - sizes)[a.doc[k]] + a.place[k] - LEFT + o
                    np.add.at(goes, start, 1)
                    np.add.at(goes, start + LENGTH, -1)
            gone = np.cumsum(goes[:-1], dtype=np.int32) > 0
            data = np.frombuffer(b"".join(texts), np.uint8)
            if characters and gone.any():
                begins = np.flatnonzero((data & 0xC0) != 0x80)
                gone = np.repeat(np.logical_and.reduceat(gone, begins), np.diff(np.append(begins, len(data))))
            kept, removed, spans = [], [], []
            for t, e, n in zip(texts, ends, sizes):
                mask = gone[e - n : e]
                m = int(mask.sum())
                removed.append(m)
                spans.append(int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()) if m else 0)
                kept.append(t if not m else data[e - n : e][~mask].tobytes())
            done.append(pa.table([pa.array(ids, pa.int64()), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), batch.column("row")], out_schema.names))
        return pa.concat_tables(done)

    dealt = map_arrow(slim, deal, "bucket int, grams binary, ids binary, groups binary").groupBy("bucket")
    wanted = materialize(dealt.applyInArrow(tidy_group(shared), "g int, grams binary"), "anchors")
    del dealt
    sweep(spark)
    seen = slim.groupBy("g").cogroup(wanted.groupBy("g")).applyInArrow(tidy_group(surround), "bucket int, g int, bytes binary, left binary, right binary, hash binary, low binary, high binary")
    judged = materialize(seen.groupBy("bucket").applyInArrow(tidy_group(judge), "g int, hash binary, owner binary"), "owners")
    del seen
    discard(wanted)
    sweep(spark)
    out = base.select("id", "g", "b", "row").groupBy("g").cogroup(judged.groupBy("g")).applyInArrow(tidy_group(remove), out_schema)
    return out if carry else out.drop("row")


def repeats_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
