"""Toxicity: a linear-chain conditional random field over two tags, learned from labelled documents.

Only documents are labelled, so tags are learned as in multiple-instance
learning: a clean document has no toxic token, a toxic one at least one.  With
``Z`` the sum over all taggings, relative to the tagging without any toxic
token, their likelihoods are ``1 / Z`` and ``1 - 1 / Z``, and both gradients
are forward-backward marginals.  Every token has features: its word, the starts
and the end of it, its shape, and the words before and after it.  Marginals of
all tokens of whole texts aggregate to the document's score, and runs of tokens
that are toxic at 0.5 or more are its spans.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.llm.common import as_bytes, chunks, id_bucket, map_arrow

#: Labelled documents that the field is fitted on, about (a hash of the id chooses), and their bytes at most;
#: longer ones are scored but not fitted on.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_TEXT_BYTES = 800, 1600, 20_000
#: Letters of word starts and of the end of a word.
STARTS, END = (4, 5), 3
EDGE = ".,;:!?\"'()[]{}<>*&%$#-_"
#: Documents that must hold a feature; steps of the fit.
SUPPORT, STEPS = 3, 60
#: Penalty on the squared weight of a feature that toxic documents clearly have more often, and what is added where not at all.
PENALTY, DOUBT = 0.3, 30.0
#: Tokens of a row of the lattice that forward-backward walks through in step with all other rows.
WIDTH = 64
#: Raw tokens whose values are kept.
KEPT_TOKENS = 150_000


def _shape(raw: str) -> str:
    kinds = ("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c if c in "!?*#@" else "." for c in raw[:24])
    return "".join(k for k, _ in groupby(kinds))[:6]


def token_features(raw: str) -> tuple[list[str], str]:
    """Features of a raw token itself, and the bare word by which its neighbours know it."""
    bare = raw.lower().strip(EDGE)
    out = ["w" + bare, "s" + _shape(raw)]
    out += [f"{m}{bare[:m]}" for m in STARTS if len(bare) > m]
    if len(bare) > END:
        out.append("e" + bare[-END:])
    return out, bare


class Chain:
    """Forward-backward over documents of ``sizes`` tokens laid end to end, tags 0 and 1.

    A tagging weighs ``exp`` of the sum of the emissions ``e`` of its tokens
    with tag 1 and of ``transition[tag, next tag]``.  Documents are cut into
    rows of ``WIDTH`` tokens; the rows' transfer matrices are multiplied along
    the documents, so every marginal is exact whatever the length.
    """

    def __init__(self, e: np.ndarray, sizes: np.ndarray, transition: np.ndarray, width: int = WIDTH):
        step = np.exp(transition)
        t00, t01, t10, t11 = step.ravel()
        some = np.flatnonzero(sizes)
        rows_of = -(-sizes[some] // width)
        first = np.cumsum(rows_of) - rows_of  # first row of each document
        total = int(rows_of.sum())
        nth = np.arange(total) - np.repeat(first, rows_of)
        starts = np.repeat((np.cumsum(sizes) - sizes)[some], rows_of) + nth * width
        length = np.minimum(width, np.repeat(sizes[some], rows_of) - nth * width)
        index = starts + np.arange(width)[:, None]  # [width, rows]
        real = np.arange(width)[:, None] < length
        own = np.where(real, np.exp(np.clip(e[np.minimum(index, max(len(e) - 1, 0))], -30, 30)) if len(e) else 1.0, 1.0)
        begins = nth == 0
        self.log_z = np.zeros(len(sizes))
        self.marginal = np.zeros(len(e))
        self.pairs = np.zeros((len(sizes), 4))
        if not total:
            return
        # transfer matrices of the rows
        a00, a01, a10, a11 = np.ones(total), np.zeros(total), np.zeros(total), np.ones(total)
        scale = np.zeros(total)
        for w in range(width):
            o, m = own[w], real[w]
            b00, b01, b10, b11 = a00 * t00 + a01 * t10, (a00 * t01 + a01 * t11) * o, a10 * t00 + a11 * t10, (a10 * t01 + a11 * t11) * o
            if w == 0:
                b00, b01, b10, b11 = np.where(begins, 1.0, b00), np.where(begins, o, b01), np.where(begins, 1.0, b10), np.where(begins, o, b11)
            a00, a01, a10, a11 = np.where(m, b00, a00), np.where(m, b01, a01), np.where(m, b10, a10), np.where(m, b11, a11)
            if w % 8 == 7 or w == width - 1:
                top = np.maximum(np.maximum(a00, a01), np.maximum(a10, a11))
                a00, a01, a10, a11 = a00 / top, a01 / top, a10 / top, a11 / top
                scale += np.log(top)
        into, after = np.zeros((total, 2)), np.ones((total, 2))
        into[begins, 0] = 1
        log = np.zeros(total)
        most = int(rows_of.max())
        for k in range(1, most):
            r = first[rows_of > k] + k
            v = np.stack([into[r - 1, 0] * a00[r - 1] + into[r - 1, 1] * a10[r - 1], into[r - 1, 0] * a01[r - 1] + into[r - 1, 1] * a11[r - 1]], 1)
            s = v.sum(1)
            into[r], log[r] = v / s[:, None], log[r - 1] + np.log(s) + scale[r - 1]
        for k in range(most - 2, -1, -1):
            r = first[rows_of > k + 1] + k
            v = np.stack([a00[r + 1] * after[r + 1, 0] + a01[r + 1] * after[r + 1, 1], a10[r + 1] * after[r + 1, 0] + a11[r + 1] * after[r + 1, 1]], 1)
            after[r] = v / v.sum(1, keepdims=True)
        last = first + rows_of - 1
        z = into[last, 0] * (a00 + a01)[last] + into[last, 1] * (a10 + a11)[last]
        self.log_z[some] = log[last] + scale[last] + np.log(z)
        # within the rows
        x0, x1 = into[:, 0], into[:, 1]
        f0, f1 = np.empty((width, total)), np.empty((width, total))
        for w in range(width):
            o, m = own[w], real[w]
            y0, y1 = x0 * t00 + x1 * t10, (x0 * t01 + x1 * t11) * o
            if w == 0:
                y0, y1 = np.where(begins, 1.0, y0), np.where(begins, o, y1)
            s = y0 + y1
            x0, x1 = np.where(m, y0 / s, x0), np.where(m, y1 / s, x1)
            f0[w], f1[w] = x0, x1
        b0, b1 = after[:, 0], after[:, 1]
        p = np.empty((width, total))
        pair = np.zeros((4, total))
        for w in range(width - 1, -1, -1):
            o, m = own[w], real[w]
            one = f1[w] * b1
            p[w] = one / (f0[w] * b0 + one)
            before0, before1 = (f0[w - 1], f1[w - 1]) if w else (into[:, 0], into[:, 1])
            q = np.stack([before0 * t00 * b0, before0 * t01 * o * b1, before1 * t10 * b0, before1 * t11 * o * b1])
            use = m & ~begins if w == 0 else m
            pair += np.where(use, q / q.sum(0), 0.0)
            c0, c1 = t00 * b0 + t01 * o * b1, t10 * b0 + t11 * o * b1
            s = c0 + c1
            b0, b1 = np.where(m, c0 / s, b0), np.where(m, c1 / s, b1)
        self.marginal[index[real]] = p[real]
        self.pairs[some] = np.add.reduceat(pair, first, axis=1).T


@dataclass
class Field:
    """A fitted field: weights of features, of the neighbours' words, of tags and of their transitions."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: Document score: logistic of an intercept and weights for the ``summary`` of its marginals.
    document: tuple[float, ...] = (-3.0, 0.0, 0.0)

    def values(self, raw: str) -> tuple[float, float, float]:
        """What a raw token adds to its own emission, to that of the token after it and to that of the one before it."""
        own, bare = token_features(raw)
        get = self.weights.get
        return sum(get(f, 0.0) for f in own), get("p" + bare, 0.0), get("n" + bare, 0.0)

    def background(self) -> float:
        """The marginal of a token without features amid such tokens."""
        n = 2 * WIDTH + 1
        return float(Chain(np.full(n, self.bias), np.array([n]), self.transition).marginal[WIDTH])

    def score(self, summary: np.ndarray) -> np.ndarray:
        """Scores of documents by their ``summary`` [documents, 2]."""
        z = self.document[0] + summary @ np.array(self.document[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Reader:
    """Emissions and marginals of batches of texts; the values of tokens are kept between them, up to a bound."""

    def __init__(self, model: Field):
        self.model, self.background = model, model.background()
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((0, 3))

    def emissions(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > KEPT_TOKENS:
            self.clear()
        flat = [w for words in lists for w in words]
        fresh = [w for w in dict.fromkeys(flat) if w not in self.number]
        if fresh:
            self.number.update(zip(fresh, range(len(self.table), len(self.table) + len(fresh))))
            self.table = np.concatenate([self.table, np.array([self.model.values(w) for w in fresh])])
        at = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        sizes = np.array([len(words) for words in lists], np.int64)
        return _emissions(self.table, at, sizes, self.model.bias), sizes

    def read(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document its ``summary``; per token its marginal; the documents' sizes."""
        e, sizes = self.emissions(lists)
        chain = Chain(e, sizes, self.model.transition)
        return summary(chain.marginal, sizes, self.background), chain.marginal, sizes


def _emissions(table: np.ndarray, at: np.ndarray, sizes: np.ndarray, bias: float) -> np.ndarray:
    e = bias + table[at, 0]
    inner = np.ones(len(at), bool)  # not the first token of a document
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    inner[starts] = False
    inner = np.flatnonzero(inner)
    e[inner] += table[at[inner - 1], 1]
    e[inner - 1] += table[at[inner], 2]
    return e


def summary(marginal: np.ndarray, sizes: np.ndarray, background: float) -> np.ndarray:
    """Per document the logarithm of its mass above the background and its largest marginal.

    The mass is the sum of squares of what marginals of all tokens are above
    the background, so that a long text is not toxic by its length.
    """
    out = np.column_stack([np.full(len(sizes), math.log(1e-3)), np.zeros(len(sizes))])
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        above = (np.maximum(marginal - background, 0) / max(1 - background, 1e-9)) ** 2
        out[some, 0] = np.log(np.add.reduceat(above, starts) + 1e-3)
        out[some, 1] = np.maximum.reduceat(marginal, starts)
    return out


def _minimise(value, x: np.ndarray, steps: int) -> np.ndarray:
    """Limited-memory quasi-Newton steps with halving until the value falls; ends when it no longer does."""
    f, g = value(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, coefficients = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            coefficients.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.abs(g).sum())
        for (s, y), a in zip(pairs, reversed(coefficients)):
            q += s * (a - (y @ q) / (s @ y))
        slope, size = -(g @ q), 1.0
        while size > 1e-6:
            new_f, new_g = value(x - size * q)
            if new_f <= f + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = -size * q, new_g - g
        if s @ y > 1e-10:
            pairs = [*pairs[-7:], (s, y)]
        done = f - new_f < 1e-5 * abs(f)
        x, f, g = x + s, new_f, new_g
        if done:
            break
    return x


def _logistic(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights by Newton's method; a step is halved until the likelihood grows, and the last one is a small one."""
    gain = lambda w: y @ (x @ w) - np.logaddexp(0, x @ w).sum() - (ridge * w) @ w / 2
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(ridge + 1e-6), x.T @ (y - q) - ridge * w)
        while not gain(w + move) >= gain(w) and np.abs(move).max() > 1e-9:
            move = move / 2
        w = w + move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit_field(texts: list[str], labels: list[int], steps: int = STEPS) -> Field:
    """Fit the field on all tokens of the documents, and the document score on marginals of documents not fitted on."""
    docs = _apart(sorted({(t, int(y)) for t, y in zip(texts, labels)}))
    lists, y = [t.split() for t, _ in docs], np.array([y for _, y in docs], float)
    found = Field()
    if not len(y) or y.min() == y.max():
        prior = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        found.document = (math.log(prior / (1 - prior)) if prior else -3.0, 0.0, 0.0)
        return found
    prior = y.mean()
    # the score is fitted on marginals that a field gives documents that it has not seen
    halves = np.arange(len(y)) % 2 == 0
    seen = np.zeros((len(y), 2))
    for own in (halves, ~halves):
        part = _weights([w for w, o in zip(lists, own) if o], y[own], max(1, steps // 2))
        seen[~own] = Reader(part).read([w for w, o in zip(lists, own) if not o])[0]
    found = _weights(lists, y, steps)
    x = np.column_stack([np.ones(len(y)), seen])
    w = _logistic(x, y, np.array([0.01, 0.1, 0.1]), np.array([math.log(prior / (1 - prior)), 0.0, 0.0]))
    found.document = tuple(float(v) for v in w)
    return found


def _apart(docs: list[tuple[str, int]], words_each: int = 5) -> list[tuple[str, int]]:
    """Documents of which at most half the shingles are those of earlier ones: copies tell nothing new about words."""
    seen: set[int] = set()
    out = []
    for text, y in docs:
        words = text.split()
        own = {hash(tuple(words[k : k + words_each])) for k in range(max(1, len(words) - words_each + 1))}
        if 2 * len(own & seen) <= len(own):
            out.append((text, y))
        seen |= own
    return out


def _evidence(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """How clearly toxic documents have features more often: 1 where a likelihood ratio passes a bound for that many features."""
    t, n = with_toxic, with_toxic + with_clean
    p, base = t / np.maximum(n, 1), toxic / (toxic + clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(t > 0, t * np.log(p / base), 0) + np.where(with_clean > 0, with_clean * np.log((1 - p) / (1 - base)), 0))
    return np.clip(np.where(p > base, g, 0) / (2 * math.log(max(2, len(n))) + 2), 0, 1)


def _weights(lists: list[list[str]], y: np.ndarray, steps: int) -> Field:
    """The field's weights by multiple-instance likelihood with a penalty on their squares."""
    found = Field()
    words: dict[str, int] = {}
    at = np.array([words.setdefault(w, len(words)) for ws in lists for w in ws], np.int64)
    sizes = np.array([len(ws) for ws in lists], np.int64)
    per_word = []
    for w in words:
        own, bare = token_features(w)
        per_word.append((own, "p" + bare, "n" + bare))
    support = (Counter(), Counter())
    ends = np.cumsum(sizes)
    for k in range(len(sizes)):
        mine = set()
        for w in np.unique(at[ends[k] - sizes[k] : ends[k]]):
            own, before, after = per_word[w]
            mine.update(own)
            mine.update((before, after))
        support[int(y[k])].update(mine)
    names = sorted(n for n in support[0].keys() | support[1].keys() if support[0][n] + support[1][n] >= SUPPORT)
    number = {n: k for k, n in enumerate(names)}
    width = len(names)
    toxic = int(y.sum())
    clear = _evidence(*(np.array([support[c][n] for n in names], float) for c in (1, 0)), toxic, len(y) - toxic)
    penalty = np.append(PENALTY + DOUBT * (1 - clear) ** 2, 0.0)
    if not len(at):
        return found
    wide = max(len(own) for own, _, _ in per_word)
    own = np.full((len(words), wide), width)
    before, after = np.full(len(words), width), np.full(len(words), width)
    for k, (features, p, n) in enumerate(per_word):
        own[k, : len(features)] = [number.get(f, width) for f in features]
        before[k], after[k] = number.get(p, width), number.get(n, width)
    inner = np.ones(len(at), bool)
    inner[(ends - sizes)[sizes > 0]] = False
    inner = np.flatnonzero(inner)

    def table(theta: np.ndarray) -> np.ndarray:
        return np.stack([theta[own].sum(1), theta[before], theta[after]], 1)

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        theta = np.append(x[:width], 0.0)
        trans = np.array([[0.0, x[width + 1]], [x[width + 2], x[width + 3]]])
        chain = Chain(_emissions(table(theta), at, sizes, x[width]), sizes, trans)
        z = np.maximum(chain.log_z, 1e-12)
        loss = np.where(y > 0, -np.log(-np.expm1(-z)), z).sum() + (penalty * theta) @ theta / 2 + 0.05 * (x[width:] - start[width:]) @ (x[width:] - start[width:])
        c = np.where(y > 0, -1 / np.expm1(np.minimum(z, 700)), 1.0)  # of the expected counts
        g = np.repeat(c, sizes) * chain.marginal
        grad = np.zeros(width + 1)
        per = np.bincount(at, g, len(words))
        grad += np.bincount(own.ravel(), np.repeat(per, wide), width + 1)
        grad += np.bincount(before, np.bincount(at[inner - 1], g[inner], len(words)), width + 1)
        grad += np.bincount(after, np.bincount(at[inner], g[inner - 1], len(words)), width + 1)
        pairs = c @ chain.pairs
        tail = np.concatenate([[g.sum()], pairs[1:]]) + 0.1 * (x[width:] - start[width:])
        return float(loss), np.concatenate([(grad + penalty * theta)[:width], tail])

    start = np.concatenate([np.zeros(width), [-6.0, 0.0, 0.0, 0.5]])
    x = _minimise(value, start, steps)
    found.weights = {n: float(v) for n, v in zip(names, x[:width]) if abs(v) > 1e-3}
    found.bias, found.transition = float(x[width]), np.array([[0.0, x[width + 1]], [x[width + 2], x[width + 3]]])
    return found


def _spans(text: str, marked: np.ndarray) -> list[dict[str, int]]:
    """Character offsets of runs of marked tokens."""
    out, pos, last = [], 0, -2
    for k, word in enumerate(text.split()):
        begin = text.index(word, pos)
        pos = begin + len(word)
        if marked[k]:
            if last == k - 1:
                out[-1]["end"] = pos
            else:
                out.append({"begin": begin, "end": pos})
            last = k
    return out


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", folds: int = 5, held: int = 0) -> Field:
    """Fit on a bounded sample (``TRAIN_*``) of labelled documents outside the held-out fold.

    A hash of the id takes about that many toxic and clean ones, at most twice
    as many.  A document with several labels is toxic if one says so; null
    labels and documents without text are left out.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    known = known.where(id_bucket("doc_id", folds) != held)
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    many = {r[0]: r[1] for r in known.groupBy((F.col("y") > 0).cast("int")).count().collect()}  # two rows
    if not many:
        return Field()
    spread = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    share = {y: min(1.0, most / max(many.get(y, 0), 1)) for y, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))}
    chosen = known.where(place < F.when(F.col("y") > 0, F.lit(int(share[1] * spread))).otherwise(F.lit(int(share[0] * spread))))
    chosen = chosen.select("doc_id", (F.col("y") > 0).cast("int").alias("y"))
    ids = [(r[0], r[1]) for r in chosen.limit(2 * (TRAIN_TOXIC + TRAIN_CLEAN)).collect()]
    if not ids:
        return Field()
    kind = docs.schema["doc_id"].dataType.simpleString()
    side = docs.sparkSession.createDataFrame(ids, f"doc_id {kind}, y int")  # at most twice the sample's ids
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).where((F.octet_length("text") > 0) & (F.octet_length("text") <= TRAIN_TEXT_BYTES))
    rows = rows.join(F.broadcast(side), "doc_id").dropDuplicates(["doc_id", "text"])
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "y")).alias("r")).select("r.text", "r.y").collect()
    return fit_field([r[0] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: Field, text: str = "text", with_spans: bool = True, keep: str | None = None) -> DataFrame:
    """The columns of ``docs`` and ``score``, ``predicted`` and, if asked, ``spans`` (character offsets of toxic runs).

    Null texts count as empty and come back as null; an empty text gets the
    score of a text without any toxic token.  Columns of ``docs`` with those
    names are replaced, others with any name are kept.  Repeated rows and ids
    are rows of their own, and an empty table gives no rows.  ``keep="clean"``
    gives only rows with ``predicted`` 0.
    """
    added = ["score", "predicted", "spans"]
    kept = [c for c in docs.columns if c not in added]
    others = F.struct(F.lit(0).alias("__one"), *[F.col(f"`{c}`") for c in kept if c != text])
    inner = docs.select(others.alias("row"), F.col(f"`{text}`").cast("binary").alias("b"))
    run_of = T.StructType().add("begin", T.IntegerType()).add("end", T.IntegerType())
    schema = T.StructType([*inner.schema.fields]).add("score", T.DoubleType()).add("predicted", T.IntegerType()).add("spans", T.ArrayType(run_of))
    span_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in chunks(batches, "b"):
            texts = [x.decode("utf-8", "replace") if x is not None else "" for x in batch.column("b").to_pylist()]
            found, marginal, sizes = reader.read([t.split() for t in texts])
            s = model.score(found)
            ends = np.cumsum(sizes)
            marked = marginal >= 0.5
            any_marked = found[:, 1] >= 0.5
            spans = [_spans(t, marked[e - n : e]) if with_spans and m else [] for t, e, n, m in zip(texts, ends, sizes, any_marked)]
            toxic = (s >= 0.5).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("b"), pa.array(s, pa.float64()), pa.array(toxic, pa.int32()), pa.array(spans, span_type)],
                ["row", "b", "score", "predicted", "spans"],
            )
            yield out.filter(pa.array(toxic == 0)) if keep == "clean" else out

    out = map_arrow(inner, run, schema)
    back = {text: F.col("b").cast(docs.schema[text].dataType)}
    columns = [back.get(c, F.col(f"row.`{c}`")).alias(c) for c in kept]
    return out.select(*columns, "score", "predicted", *(["spans"] if with_spans else []))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_spans`` for every document.

    Rows of the fold ``crc32(doc_id) mod 5 = 0`` are held out of the fit; a
    null id counts as the empty text there.  Null and empty texts, repeated
    ids and an empty table are as in ``score``; other columns are ignored.
    """
    slim = docs.select("doc_id", "text")
    out = score(slim, fit(slim, labels))
    return out.select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))
