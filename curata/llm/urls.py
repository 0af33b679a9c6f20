"""URL filter: host rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones.  Features are built-in
functions of a URL's text and block rates of what it shares with others: its
suffix and the first segment of its path.  A labelled URL gets the rates of the
folds it is not in, and some get none at all, so that the trees also learn what
to do with a suffix that no labelled URL has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.common import tidy

#: (verdict, host, path); a rule holds for its host and all subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labelled URLs that the trees are fitted on, about (a hash chooses); the statistics cover all of them.
TRAIN_ROWS = 20_000
#: Keys up to which their statistics are broadcast, and the letters of a key.
BROADCAST_KEYS, KEY_LENGTH = 20_000, 64
#: Folds of the labelled URLs, and one in how many trains as if nothing were known of its keys.
FOLDS, UNSEEN = 5, 6
#: Labelled URLs at the overall rate that a key's own rate is drawn towards.
DRAWN = 10.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, url, host, path, rule, ruled``: the longest rule that fits and its verdict, else null."""
    base = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule = verdict = None
    for kind, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return base.withColumns({"rule": none if rule is None else rule, "ruled": none if verdict is None else verdict})


def suffix_of(host: Column) -> Column:
    """The last two labels of a host, or what fits into ``KEY_LENGTH`` letters of them."""
    return F.left(F.substring_index(host, ".", -2), F.lit(KEY_LENGTH))


def segment_of(path: Column) -> Column:
    """The first segment of a path."""
    return F.left(F.regexp_extract(path, "^/+([^/]*)", 1), F.lit(KEY_LENGTH))


LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "longest_digits", "entropy", "parameters", "query_length", "hyphens")
KEYS = {"suffix": suffix_of, "segment": segment_of}
FEATURES = (*LEXICAL, *(f"{k}_{x}" for k in KEYS for x in ("rate", "seen")))


def lexical(url: Column, host: Column, path: Column) -> Column:
    """``LEXICAL`` as an array of doubles; a null URL counts as empty."""
    u = F.coalesce(url, F.lit(""))
    n = F.length(u)
    query = F.regexp_extract(u, r"(?s)^[^?#]*\?([^#]*)", 1)
    many = lambda text, c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    # a letter at a time: the share of each that occurs
    letters = F.filter(F.array_distinct(F.split(u, "")), lambda c: c != "")
    shares = F.transform(letters, lambda c: (n - F.length(F.replace(u, c, F.lit("")))) / n)
    values = (
        n,
        F.length(host),
        F.length(path),
        many(path, "/"),
        F.when(host != "", many(host, ".") + 1).otherwise(0),
        F.when(n > 0, F.length(F.regexp_replace(u, "[^0-9]", "")) / n).otherwise(0),
        F.array_max(F.transform(F.split(u, "[^0-9]+"), F.length)),
        F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p)),
        F.when(query != "", many(query, "&") + 1).otherwise(0),
        F.length(query),
        many(u, "-"),
    )
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


@dataclass
class BoostedTrees:
    """Binary classifier: Newton boosting of complete binary trees over binned features."""

    trees: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    penalty: float = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Both classes weigh the same in all, whatever their numbers."""
        n, width = x.shape
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 0.5
        weight = np.ones(n)
        if n and y.min() < y.max():
            weight, share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())), 0.5
        self.base = float(np.log(share / (1 - share)))
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if not n or y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        binned = [np.searchsorted(edges[f], x[:, f], "left") for f in range(width)]
        score = np.full(n, self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(n, np.int64)
            split_f = np.full(2**self.depth - 1, -1)
            split_t = np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                first, k = 2**level - 1, 2**level
                gain, pick = np.zeros(k), [(-1, np.inf, 0)] * k
                for f in range(width):
                    m = len(edges[f]) + 1
                    if m == 1:
                        continue
                    cell = node * m + binned[f]
                    gs = np.bincount(cell, g, k * m).reshape(k, m).cumsum(1)
                    hs = np.bincount(cell, h, k * m).reshape(k, m).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    value = gs**2 / (hs + self.penalty) + (gt - gs) ** 2 / (ht - hs + self.penalty) - gt**2 / (ht + self.penalty)
                    cut = value[:, :-1].argmax(1)
                    for i in range(k):
                        if value[i, cut[i]] > gain[i] + 1e-9:
                            gain[i], pick[i] = value[i, cut[i]], (f, edges[f][cut[i]], cut[i])
                right = np.zeros(n, np.int64)
                for i, (f, t, c) in enumerate(pick):
                    split_f[first + i], split_t[first + i] = f, t
                    if f >= 0:
                        own = node == i
                        right[own] = binned[f][own] > c
                node = node * 2 + right
            leaves = 2**self.depth
            leaf = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.penalty)
            score += leaf[node]
            self.model.append((split_f, split_t, leaf))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for split_f, split_t, leaf in self.model:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                f = split_f[at]
                node = node * 2 + ((f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > split_t[at]))
            score += leaf[node]
        return 1 / (1 + np.exp(-score))


@dataclass
class Fitted:
    """Trees, and per kind of key the counts they go with: ``key``, ``seen`` and ``blocked`` of each fold."""

    trees: BoostedTrees
    overall: float
    stats: dict[str, tuple[DataFrame, bool]]


def _labelled(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    rows = with_rules(pages, rules)
    place = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30))
    return rows.withColumns({k: of(F.col("host" if k == "suffix" else "path")) for k, of in KEYS.items()} | {"place": place, "fold": (place % FOLDS).cast("int")})


def _with_rates(rows: DataFrame, fitted_stats: dict[str, tuple[DataFrame, bool]], overall: float, out_of_fold: bool) -> DataFrame:
    """``x``: the features of every row; out of fold, without what the row's own fold counts, and for some rows nothing."""
    parts = [lexical(F.col("url"), F.col("host"), F.col("path"))]
    for kind, (stats, small) in fitted_stats.items():
        named = stats.select(F.col("key").alias(kind), F.col("seen").alias(f"{kind}_n"), F.col("blocked").alias(f"{kind}_b"))
        rows = rows.join(F.broadcast(named) if small else named, kind, "left")
        whole = lambda c: F.aggregate(F.col(c), F.lit(0).cast("long"), lambda total, v: total + v)
        n, b = F.coalesce(whole(f"{kind}_n"), F.lit(0)), F.coalesce(whole(f"{kind}_b"), F.lit(0))
        if out_of_fold:
            known = F.pmod(F.xxhash64("place"), F.lit(UNSEEN)) != 0
            n, b = (F.when(known, v - F.coalesce(F.get(f"{kind}_{c}", "fold"), F.lit(0))).otherwise(0) for v, c in ((n, "n"), (b, "b")))
        parts.append(F.array((b + DRAWN * overall) / (n + DRAWN), F.log1p(n.cast("double"))))
    return rows.withColumn("x", F.concat(*parts))


def fit(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, train_rows: int = TRAIN_ROWS) -> Fitted:
    """Trees on about ``train_rows`` URLs that rules decide, and the block rates of suffixes and segments over all of those."""
    rows = _labelled(pages, rules).where("ruled is not null").withColumn("blocks", (F.col("ruled") == "block").cast("long"))
    total = rows.agg(F.count("*"), F.sum("blocks"), *[F.approx_count_distinct(k) for k in KEYS]).first()
    overall = float(total[1] or 0) / total[0] if total[0] else 0.5
    stats = {}
    for i, kind in enumerate(KEYS):
        per = lambda c: F.array(*[F.sum(F.when(F.col("fold") == f, c).otherwise(0)) for f in range(FOLDS)])
        one = rows.groupBy(F.col(kind).alias("key")).agg(per(F.lit(1)).alias("seen"), per(F.col("blocks")).alias("blocked"))
        stats[kind] = (one, 2 * total[2 + i] <= BROADCAST_KEYS)  # twice the estimate: its error is 5 %
    share = min(1.0, train_rows / max(total[0], 1))
    sample = _with_rates(rows.where(F.col("place") < int(share * (1 << 30))), stats, overall, True)
    got = sample.select("x", "blocks").orderBy("blocks", "x").collect()
    x = np.array([r[0] for r in got], np.float64).reshape(len(got), len(FEATURES))
    trees = BoostedTrees().fit(x, np.array([r[1] for r in got], np.float64))
    if not got:
        trees.base = -1.0
    return Fitted(trees, overall, stats)


def score(rows: DataFrame, fitted: Fitted) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of rows of ``_labelled`` as the trees judge them, rules or not."""
    trees = fitted.trees

    @tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x")
            p = trees.probability(np.asarray(x.flatten(), np.float64).reshape(len(x), len(FEATURES)))
            verdict = pa.array(np.where(p >= 0.5, "block", "allow"), pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "host", "path", "rule")), verdict, pa.array(p)], ["page_id", "host", "path", "rule", "verdict", "block_score"])

    slim = _with_rates(rows, fitted.stats, fitted.overall, False).select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "x")
    return slim.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string, block_score double")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` for every row of ``pages``.

    A rule decides the URLs that it fits (score null); the trees judge the
    others and block at a score of 0.5 or more, where both verdicts of the
    rules weigh the same.  Where no rule decides any URL, all are allowed; where
    all rules that do agree, so do the trees.  Null, empty, very long and
    repeated URLs and null ids are ordinary rows, each judged by itself; other
    columns are ignored; an empty table gives no rows.
    """
    rows = _labelled(pages, rules)
    columns = [F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule"]
    ruled = rows.where("ruled is not null").select(*columns, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    return ruled.unionByName(score(rows.where("ruled is null"), fit(pages, rules, train_rows)))
