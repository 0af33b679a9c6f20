"""Digests, average hashes and Hamming distances as Column expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def average_hash(values: Column) -> Column:
    """64 bits, lowest first: whether each of 64 values reaches their mean."""
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v.cast("double"))
    mean = total / F.size(values)
    bits = F.transform(values, lambda v, i: F.when(v.cast("double") >= mean, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


#: Bytes of text whose bits are looked up at once.
PARITY_BYTES = 4 << 20


def letter_parity(text: Column, first: int) -> Column:
    """64 bits, lowest first: whether each of the 64 ASCII letters from code ``first`` on occurs an odd number of times.

    One pass over the bytes of a text: their bits are looked up and folded by
    exclusive or.  Built-ins would need a pass for each letter.  Null has no letter.
    """
    bit = np.zeros(256, np.uint64)
    bit[first : first + 64] = np.uint64(1) << np.arange(64, dtype=np.uint64)

    @F.arrow_udf("long")
    def folded(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        out = np.zeros(len(texts), np.uint64)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + PARITY_BYTES, "right")) - 1)
            some = at + np.flatnonzero(ends[at + 1 : to + 1] > ends[at:to])  # an empty range would give its first byte
            if len(some):
                out[some] = np.bitwise_xor.reduceat(bit[data[ends[at] : ends[to]]], ends[some] - ends[at])
            at = to
        return pa.array(out.view(np.int64))

    return folded(text)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def seeded_rank(seed: int | str, key: Column) -> Column:
    """A digest that orders keys the same way in every run."""
    return F.sha2(F.concat(F.lit(str(seed)), F.lit("\0"), key.cast("string")), 256)


def fingerprint(entries: Column) -> Column:
    """Digest of a group's entries in sorted order; for manifests of bounded size."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(entries)), ""), 256)


def parse_hash(text: Column) -> Column:
    """The 64 bits of ``ahash64:`` and 16 hexadecimal digits, as a signed number; null for anything else."""
    digits = F.regexp_extract(text, "^ahash64:([0-9a-fA-F]{16})$", 1)
    half = lambda at: F.conv(F.substr(digits, F.lit(at), F.lit(8)), 16, 10).try_cast("long")
    return F.when(digits != "", F.shiftleft(half(1), 32).bitwiseOR(half(9)))


def format_hash(value: Column) -> Column:
    return F.concat(F.lit("ahash64:"), F.lower(F.lpad(F.hex(value), 16, "0")))


def canonical_json(**fields: Column) -> Column:
    """A JSON text without blanks whose keys are in order; null values are written."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def fingerprints(rows: DataFrame, group: str, number: str, entry: str, fan: int = 1000) -> DataFrame:
    """``group, fingerprint, n``: a digest of a group's entries, as a tree of digests over ``fan`` numbers, then ``fan`` of those.

    No task joins more than ``fan`` entries of evenly numbered rows, or the
    digests of a group's millions.
    """
    key = lambda c: F.lpad(F.col(c).cast("string"), 16, "0")
    low = rows.select(group, F.floor(F.col(number) / fan).alias("__a"), F.col(entry).alias("__e"))
    parts = low.groupBy(group, "__a").agg(fingerprint(F.col("__e")).alias("__d"), F.count("*").alias("n"))
    parts = parts.withColumns({"__b": F.floor(F.col("__a") / fan), "__e": F.concat(key("__a"), "__d", F.lit("\n"))})
    whole = parts.groupBy(group, "__b").agg(fingerprint(F.col("__e")).alias("__d"), F.sum("n").alias("n"))
    whole = whole.withColumn("__e", F.concat(key("__b"), "__d", F.lit("\n")))
    return whole.groupBy(group).agg(fingerprint(F.col("__e")).alias("fingerprint"), F.sum("n").alias("n"))
