"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one full-dimensional codeword from each of ``books``
codebooks.  The codebooks are fitted one after the other to residuals of a
bounded sample; every row is encoded by beam search and stored with its codes
and with the ratio of its norm to that of its reconstruction.  A query scores
a block of codes with lookup tables; the best are reranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.llm.common import blob, tidy
from curata.llm.vectors import matrix, usable
from curata.storage import materialize

#: Vectors of each dimension that the codebooks are fitted on, at most; a hash of the id chooses.
TRAIN_ROWS = 4096
BOOKS, WORDS, BEAM = 16, 256, 8
#: Rows of an index block, queries of a query block.
BLOCK_ROWS, QUERY_ROWS = 4096, 512
#: Rows of a block that are reranked for each query.
RERANK = 192
#: Bytes of codebooks up to which they are broadcast.
BROADCAST_BYTES = 64 << 20


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (x @ words.T * 2 - (words**2).sum(1)).argmax(1)


def fit_books(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Codebooks [books, words, dimension] by k-means on the residuals of the books before."""
    rng = np.random.default_rng(seed)
    rest = sample.astype(np.float64)
    out = []
    for _ in range(books):
        k = min(words, len(rest))
        centre = np.zeros((words, sample.shape[1]))
        centre[:k] = rest[rng.choice(len(rest), k, replace=False)]
        for _ in range(rounds):
            own = _nearest(rest, centre)
            count = np.bincount(own, minlength=words)
            total = np.zeros_like(centre)
            np.add.at(total, own, rest)
            centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
        rest = rest - centre[_nearest(rest, centre)]
        out.append(centre)
    return np.stack(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes [n, books] by beam search over the books in turn, and the reconstructions; in single precision, as they only choose candidates."""
    n, m, k = len(x), len(books), books.shape[1]
    books = books.astype(np.float32)
    rest = x[:, None, :].astype(np.float32)
    codes = np.zeros((n, 1, 0), np.int64)
    for b in range(m):
        size = (books[b] ** 2).sum(1)
        error = (rest**2).sum(2)[:, :, None] - 2 * rest @ books[b].T + size
        error = error.reshape(n, -1)
        width = min(beam if b < m - 1 else 1, error.shape[1])
        best = np.argpartition(error, width - 1, axis=1)[:, :width]
        parent, word = best // k, best % k
        rest = np.take_along_axis(rest, parent[:, :, None], 1) - books[b][word]
        codes = np.concatenate([np.take_along_axis(codes, parent[:, :, None], 1), word[:, :, None]], 2)
    return codes[:, 0].astype(np.uint8 if k <= 256 else np.uint16), x - rest[:, 0]


def _books(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data).reshape(BOOKS, -1, dim)


def search_block(queries: np.ndarray, ids: np.ndarray, own: np.ndarray, vectors: np.ndarray, codes: np.ndarray, ratio: np.ndarray, books: np.ndarray, k: int, rerank: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query number: the ``k`` best rows of a block (sorted by id) but its own, with exact inner products."""
    n = len(ids)
    short = min(max(rerank, k + 1), n)
    for start in range(0, len(queries), 64):
        q = queries[start : start + 64]
        tables = np.einsum("qd,bkd->qbk", q, books)
        guess = np.zeros((len(q), n))
        for b in range(len(books)):
            guess += tables[:, b][:, codes[:, b]]
        guess *= ratio
        guess -= np.arange(n) * (1e-12 * (np.abs(guess).max() + 1e-300))  # of rows with equal codes the smaller id first
        best = np.argpartition(-guess, short - 1, axis=1)[:, :short] if short < n else np.broadcast_to(np.arange(n), (len(q), n))
        for j in range(len(q)):
            rows = best[j]
            exact = vectors[rows] @ q[j]
            keep = ids[rows] != own[start + j]
            rows, exact = rows[keep], exact[keep]
            order = np.lexsort((ids[rows], -exact))[:k]
            yield start + j, ids[rows][order], exact[order]


def search(vectors: DataFrame, k: int = 20, every: int = 20, column: str = "embedding", rerank: int = RERANK, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every row whose vec_id is divisible by ``every``.

    Nearness is the inner product in double precision of the stored vectors;
    ties go to the smaller vec_id.  Candidates are all rows of the same
    dimension but those with the query's own vec_id.  Vectors that are null,
    empty, zero or hold null, NaN or infinite components and rows without id
    take no part; equal rows count once, and a vec_id with several vectors is
    one query that takes the best of them.  Other columns are ignored; an
    empty table gives no rows.

    Rows lie in blocks of about ``block_rows``, queries in blocks of
    ``QUERY_ROWS``; each task scores pairs of blocks by lookup tables, reranks
    ``rerank`` rows of the block exactly, and the best ``k`` of every pair are
    merged.
    """
    base = vectors.where(usable(column) & F.col("vec_id").isNotNull())
    base = base.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).distinct()
    base = base.withColumn("dim", F.size("v"))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    per_dim = base.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"))
    rows, asking, book_bytes = per_dim.agg(F.sum("n"), F.sum("q"), F.sum(F.col("dim") * 8 * BOOKS * WORDS)).first()
    if not rows or not asking:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks_all, asks_all = -(-rows // block_rows), -(-asking // QUERY_ROWS)
    place = F.xxhash64("vec_id")

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = fit_books(np.stack(pdf.sort_values("slot").v.to_numpy()))
        return pd.DataFrame({"dim": [int(key[0])], "books": [blob(found)]})

    # one row of each of TRAIN_ROWS slots, so that no more meet in a task
    sample = base.groupBy("dim", F.pmod(place, F.lit(TRAIN_ROWS)).alias("slot")).agg(F.min_by("v", F.struct(place, "vec_id")).alias("v"))
    books = materialize(sample.groupBy("dim").applyInPandas(fit, "dim int, books binary"), "books")
    if book_bytes <= BROADCAST_BYTES:
        books = F.broadcast(books)

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        return pd.DataFrame({"dim": [int(key[0])], "block": [int(key[1])], "n": [len(pdf)], "ids": [blob(pdf.vec_id.to_numpy(np.int64))], "x": [blob(np.stack(pdf.v.to_numpy()))]})

    def gathered(df: DataFrame, many: int) -> DataFrame:
        placed = df.withColumn("block", F.pmod(place, F.lit(many)).cast("int"))
        return placed.groupBy("dim", "block").applyInPandas(gather, "dim int, block int, n int, ids binary, x binary")

    @tidy
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                x = matrix(r.x, r.n)
                codes, made = encode(x, _books(r.books, r.dim))
                ratio = np.linalg.norm(x, axis=1) / np.maximum(np.linalg.norm(made, axis=1), 1e-300)
                yield pd.DataFrame({"dim": [r.dim], "block": [r.block], "n": [r.n], "ids": [r.ids], "x": [r.x], "codes": [blob(codes)], "ratio": [blob(np.clip(ratio, 0.5, 2.0))]})

    blocks = gathered(base, blocks_all).join(books, "dim").mapInPandas(index, "dim int, block int, n int, ids binary, x binary, codes binary, ratio binary")
    ask = gathered(base.where(is_query), asks_all).select("dim", F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("x").alias("qx"))
    ask = ask.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks_all - 1))))

    @tidy
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids, own = np.frombuffer(r.ids, np.int64), np.frombuffer(r.qids, np.int64)
                codes = matrix(r.codes, r.n, np.uint8)
                found = search_block(matrix(r.qx, r.qn), ids, own, matrix(r.x, r.n), codes, np.frombuffer(r.ratio), _books(r.books, r.dim), k, rerank)
                parts = [(np.full(len(i), own[q]), i, s) for q, i, s in found]
                if parts:
                    yield pd.DataFrame({"query_id": np.concatenate([p[0] for p in parts]), "vec_id": np.concatenate([p[1] for p in parts]), "score": np.concatenate([p[2] for p in parts])})

    joined = ask.join(materialize(blocks, "ann"), ["dim", "block"]).join(books, "dim")
    found = joined.mapInPandas(pairs, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
