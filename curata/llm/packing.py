"""Packing documents into fixed windows by order-preserving dynamic programming.

Each task turns its documents, in the order it reads them, into one stream of
token ids and cuts the stream into sequences.  A cut may lie at the end of a
document (free), at the end of a sentence (a small penalty), or, where a
sentence is longer than a window and in the last windows of a stream, anywhere
(a large penalty).  With ``cost[j]`` the least cost of all sequences up to cut
``j``::

    cost[j] = penalty[j] + min over i, c[j]-W <= c[i] < c[j], of cost[i] + each + pad(c[j]-c[i])

where ``pad(L)`` is ``W - L``, or 0 if ``L`` is a power of two.  ``W - c[j]`` is
the same for all ``i``, so the smallest ``cost[i] + c[i]`` of a sliding window
is needed, which a monotone queue gives in constant time; the power-of-two
lengths are looked up one by one.  No row is shuffled.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import as_bytes, chunks, map_arrow


@dataclass(frozen=True)
class Costs:
    window: int = 1024
    #: Padding tokens that a cut inside a document at a sentence's end is worth.
    sentence: int = 4
    #: The same for a cut anywhere else.
    anywhere: int = 48
    #: The same for every sequence, so that small powers of two are no free lunch.
    each: int = 8


@dataclass(frozen=True)
class Vocabulary:
    """Files of one byte-level vocabulary: for ``tokenizers``, and as ranks for ``tiktoken``; names or paths."""

    tokenizer: str = "byte_bpe_50k.json"
    ranks: str = "byte_bpe_50k.tiktoken"
    end_id: int = 0

    @staticmethod
    def _file(name: str) -> str:
        if "/" in name:
            return name
        import public_tokenizers

        return public_tokenizers.path(name)

    def load(self) -> TextEncoder:
        return TextEncoder(self._file(self.tokenizer), self._file(self.ranks))


class TextEncoder:
    """Ids as ``tokenizers`` gives them, at the cost of a dictionary lookup per repeated word.

    The pre-tokenizer never joins a space with the character before it, so the
    parts of a text between spaces have their ids each on its own, unless white
    space runs over such a part.  Those texts, and texts with a special token's
    string, go to ``tokenizers`` whole.
    """

    #: Bytes that the memory of parts holds at most.
    MOST = 32 << 20

    def __init__(self, tokenizer_file: str, ranks_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        core = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._ordinary, self._piece = core.encode_ordinary, core.encode_single_piece
        self._whole = Tokenizer.from_file(tokenizer_file)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        ordinary, piece = self._ordinary, self._piece

        class Parts(dict):
            """Ids of a part with the space before it; says if one was white space, whose neighbours count too."""

            blank = False
            size = 0

            def __missing__(self, part):
                if part.isalpha():
                    ids = array("I", piece((" " + part).encode())).tobytes()
                elif not part or part.isspace():
                    self.blank = True
                    return b""
                elif part[-1] in ".," and part[:-1].isalpha():
                    return self[part[:-1]] + closing[part[-1]]
                else:
                    ids = array("I", ordinary(" " + part)).tobytes()
                    if "\n" in part:
                        return ids
                self.size += 200 + len(part) + len(ids)
                if self.size > TextEncoder.MOST:
                    self.clear()
                    self.size = 0
                self[part] = ids
                return ids

        closing = {c: array("I", ordinary(c)).tobytes() for c in ".,"}
        self._parts = Parts()
        self.ends_sentence = np.zeros(max(max(ranks.values()) + 1, self._whole.get_vocab_size()), bool)
        for raw, i in ranks.items():
            self.ends_sentence[i] = raw[-1:] in (b".", b"!", b"?", b"\n")

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if not any(x in text for x in self._special):
            first, *rest = text.split(" ")
            head = array("I", self._ordinary(first)).tobytes() if first else b""
            ids = head + b"".join(map(self._parts.__getitem__, rest))
            if not self._parts.blank:
                return ids
            self._parts.blank = False
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()


def best_cuts(at: list[int], penalty: list[int], costs: Costs, start: int = 0) -> tuple[list[float], list[int]]:
    """Least cost up to each cut position ``at[j]`` and the cut before it; ``at[0]`` is where the stream begins."""
    window, each = costs.window, costs.each
    where = {p: j for j, p in enumerate(at)}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    wide = [p for p in powers if p * 4 >= window]
    best, back = [0.0], [0]
    queue = deque([0])
    full = bool(window & (window - 1))
    for j in range(1, len(at)):
        p = at[j]
        low = p - window
        while queue and at[queue[0]] < low:
            queue.popleft()
        if queue:
            i = queue[0]
            cost = best[i] + at[i] + window - p
        else:
            i, cost = -1, float("inf")
        for q in powers if p > start else wide:
            i2 = where.get(p - q)
            if i2 is not None and best[i2] < cost:
                cost, i = best[i2], i2
        if full and low in where and best[where[low]] < cost:
            cost, i = best[where[low]], where[low]
        cost += penalty[j] + each
        best.append(cost)
        back.append(i)
        key = cost + p
        while queue and best[queue[-1]] + at[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    return best, back


class Packer:
    """Cuts one stream of documents; holds a bounded part of it."""

    BLOCK = 1 << 19
    #: Ids of pieces that are sent on at once.
    SEND = 1 << 18

    def __init__(self, ends_sentence: np.ndarray, costs: Costs, end_id: int, first_sequence: int):
        self.ends, self.costs, self.end_id, self.sequence = ends_sentence, costs, end_id, first_sequence
        self.parts: list[tuple[object, np.ndarray, int, int]] = []  # id, ids, ids of the document before them, ids of the document
        self.held = 0

    def add(self, doc_id: object, ids: bytes) -> Iterator[tuple]:
        whole = np.frombuffer(ids + np.uint32(self.end_id).tobytes(), np.uint32)
        for at in range(0, len(whole), self.BLOCK):  # a document may be longer than what is held
            self.parts.append((doc_id, whole[at : at + self.BLOCK], at, len(whole)))
            self.held += len(self.parts[-1][1])
            if self.held >= self.BLOCK:
                yield from self._cut(False)

    def close(self) -> Iterator[tuple]:
        if self.held:
            yield from self._cut(True)

    def _positions(self, stream: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
        window, n = self.costs.window, len(stream)
        kind = np.zeros(n + 1, np.int8)  # 0 none, 1 anywhere, 2 sentence, 3 document
        kind[1:][self.ends[stream]] = 2
        ends = np.cumsum([len(p[1]) for p in self.parts])
        done = np.array([p[2] + len(p[1]) == p[3] for p in self.parts])
        kind[ends[done]] = 3
        if last:
            tail = kind[max(0, n - window) :]
            tail[tail == 0] = 1
        kind[0] = kind[n] = 3
        at = np.flatnonzero(kind)
        for a in at[:-1][np.diff(at) > window // 2]:  # nothing to cut at for long
            stop = at[np.searchsorted(at, a, "right")]
            kind[a + window // 2 : stop : window // 2] = 1
        at = np.flatnonzero(kind)
        price = np.array([0, self.costs.anywhere, self.costs.sentence, 0])
        return at, price[kind[at]]

    def _cut(self, last: bool) -> Iterator[tuple]:
        stream = np.concatenate([p[1] for p in self.parts])
        at, price = self._positions(stream, last)
        n, window = len(stream), self.costs.window
        at_list = at.tolist()
        best, back = best_cuts(at_list, price.tolist(), self.costs, n - window if last else n)
        j = len(at) - 1
        if not last:  # what the last windows look like depends on what follows
            j = int(np.searchsorted(at, n - 8 * window, "right")) - 1
            low = int(np.searchsorted(at, at[j] - window // 2))
            j = min(range(max(1, low), j + 1), key=lambda k: best[k] - at_list[k] * (self.costs.each / window), default=j)
        cuts = []
        while j > 0:
            cuts.append(at_list[j])
            j = back[j]
        cuts.reverse()
        yield from self._pieces(cuts)

    def _pieces(self, cuts: list[int]) -> Iterator[tuple]:
        part, used, begin = 0, 0, 0
        for cut in cuts:
            offset = 0
            while begin + offset < cut:
                doc_id, ids, before, total = self.parts[part]
                take = min(len(ids) - used, cut - begin - offset)
                yield doc_id, before + used, ids[used : used + take], total, self.sequence, offset
                offset += take
                used += take
                if used == len(ids):
                    part, used = part + 1, 0
            self.sequence += 1
            begin = cut
        rest = self.parts[part:]
        if used:
            doc_id, ids, before, total = rest[0]
            rest[0] = (doc_id, ids[used:], before + used, total)
        self.parts = [(d, x.copy(), b, t) for d, x, b, t in rest]
        self.held = sum(len(p[1]) for p in self.parts)


def pack(docs: DataFrame, costs: Costs = Costs(), vocabulary: Vocabulary = Vocabulary(), text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked, ``ids``.

    A document is its ids and then ``end_id``; a null text is an empty one, so
    every row of ``docs`` has at least one id, and a null or repeated doc_id
    is carried through like any other.  Sequences keep the order in which the
    table is read and never cross tasks; ``sequence_id`` has the task's number
    in its upper bits.  Other columns are ignored, an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.load()
        packer = Packer(encoder.ends_sentence, costs, vocabulary.end_id, TaskContext.get().partitionId() << 32)

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, total, sequence, offset = zip(*pieces)
            columns = [
                pa.array(doc, pa.int64()),
                pa.array(start, pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                pa.array(total, pa.int64()),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).view(np.int32))))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)

        def pieces() -> Iterator[tuple]:
            for batch in chunks(batches, "b"):
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("b")):
                    yield from packer.add(doc_id, encoder.encode(data.as_py().decode("utf-8", "replace")))
            yield from packer.close()

        held: list[tuple] = []
        size = 0
        for piece in pieces():
            held.append(piece)
            size += len(piece[2]) + 16
            if size >= Packer.SEND:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes(text).alias("b")), run, schema)
