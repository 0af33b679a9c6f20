"""Registered queries over the driver's tables and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curata.functions import geometry as geo
from curata.functions import hashing, labels
from curata.operators import evaluation as ev
from curata.operators import relational as rel
from curata.operators.graph import connected_components
from curata.plans.registry import ORACLE_SQL, QUERIES, query, table

@query(
    "dedup_keep_first",
    """
    WITH h AS (SELECT doc_id, source, sha256(coalesce(text, '')) AS sha FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY source, doc_id) AS position FROM h)
    SELECT doc_id, source, sha, CASE WHEN position = 1 THEN 'include' ELSE 'exclude_exact_duplicate' END AS decision
    FROM r
    """,
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    marked = rel.keep_first(docs, "sha", ["source", "doc_id"])
    return marked.select("doc_id", "source", "sha", F.when(F.col("is_first"), "include").otherwise("exclude_exact_duplicate").alias("decision"))


def _sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))


@query(
    "duplicate_groups",
    """
    SELECT sha, count(*) AS size, row_number() OVER (ORDER BY sha) AS number
    FROM (SELECT sha256(coalesce(text, '')) AS sha FROM documents) GROUP BY sha HAVING count(*) > 1
    """,
)
def duplicate_groups(spark, sf_dir):
    return rel.duplicate_groups(_sha(spark, sf_dir), "sha")


@query(
    "duplicate_matrix",
    """
    WITH s AS (SELECT DISTINCT sha256(coalesce(text, '')) AS sha, source FROM documents)
    SELECT a.source AS left_source, b.source AS right_source, count(*) AS shared
    FROM s a JOIN s b ON a.sha = b.sha AND a.source < b.source GROUP BY 1, 2
    """,
)
def duplicate_matrix(spark, sf_dir):
    # a digest has at most as many entries as there are sources
    sets = _sha(spark, sf_dir).groupBy("sha").agg(F.array_sort(F.collect_set("source")).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("left_source"), b.alias("right_source")))))
    return sets.select(F.inline(pairs)).groupBy("left_source", "right_source").agg(F.count("*").alias("shared"))


@query(
    "group_summary_listagg",
    """
    SELECT lang, count(*) AS n, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM documents GROUP BY lang
    """,
)
def group_summary_listagg(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"))


METRICS = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
    l_extendedprice AS truth, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS pred,
    least(l_extendedprice, l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS inter FROM lineitem
"""
ROWS = f"""
SELECT *, CASE WHEN truth + pred - inter > 0 THEN inter / (truth + pred - inter) ELSE 0.0 END AS iou,
    CASE WHEN truth + pred > 0 THEN 2 * inter / (truth + pred) ELSE 0.0 END AS dice,
    CASE WHEN truth > 0 THEN inter / truth ELSE 0.0 END AS recall,
    CASE WHEN pred > 0 THEN inter / pred ELSE 0.0 END AS prec,
    CASE WHEN truth > 0 THEN (truth - inter) / truth ELSE 0.0 END AS under_ratio,
    CASE WHEN truth > 0 THEN (pred - inter) / truth ELSE 0.0 END AS over_ratio FROM ({METRICS})
"""


def _metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap metrics of a truth and a prediction, each a size, with the size of what they share."""
    line = table(spark, sf_dir, "lineitem")
    truth = F.col("l_extendedprice").cast("double")
    pred = truth * (1 - F.col("l_discount").cast("double")) * (1 + F.col("l_tax").cast("double"))
    rows = line.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", truth.alias("truth"), pred.alias("pred"))
    rows = rows.withColumn("inter", F.least("truth", "pred"))
    t, p, i = F.col("truth"), F.col("pred"), F.col("inter")
    share = lambda up, down: F.when(down > 0, up / down).otherwise(0.0)
    return rows.withColumns({"iou": share(i, t + p - i), "dice": share(2 * i, t + p), "recall": share(i, t), "prec": share(i, p), "under_ratio": share(t - i, t), "over_ratio": share(p - i, t)})


@query(
    "metric_rows",
    f"""SELECT l_orderkey, l_linenumber, round(iou, 6) AS iou, round(dice, 6) AS dice, round(recall, 6) AS recall,
    round(prec, 6) AS prec, round(under_ratio, 6) AS under_ratio, round(over_ratio, 6) AS over_ratio FROM ({ROWS})""",
)
def metric_rows(spark, sf_dir):
    return _metric_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("iou", "dice", "recall", "prec", "under_ratio", "over_ratio")])


@query(
    "metric_rollup_grouping_sets",
    f"""
    SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, round(avg(iou), 6) AS mean_iou, round(avg(dice), 6) AS mean_dice,
        round(max(over_ratio), 6) AS worst_over, count(*) FILTER (WHERE recall < 1) AS cropped,
        round(avg(CASE WHEN recall < 1 THEN under_ratio END), 6) AS mean_under_cropped
    FROM ({ROWS}) GROUP BY GROUPING SETS ((), (l_returnflag), (l_linestatus), (l_linenumber))
    """,
)
def metric_rollup_grouping_sets(spark, sf_dir):
    rows = _metric_rows(spark, sf_dir)
    keys = [F.col(c) for c in ("l_returnflag", "l_linestatus", "l_linenumber")]
    return rows.groupingSets([[], *[[k] for k in keys]], *keys).agg(
        F.count("*").alias("n"),
        F.round(F.avg("iou"), 6).alias("mean_iou"),
        F.round(F.avg("dice"), 6).alias("mean_dice"),
        F.round(F.max("over_ratio"), 6).alias("worst_over"),
        F.count_if(F.col("recall") < 1).alias("cropped"),
        F.round(F.avg(F.when(F.col("recall") < 1, F.col("under_ratio"))), 6).alias("mean_under_cropped"),
    )


AUDIT = """
SELECT d.doc_id, CASE WHEN (d.n_chars % 1000) >= 250 AND (d.n_chars * 7) % 1000 < 800 AND (d.n_chars * 3) % 120 > 60 THEN 'BAD'
    WHEN d.doc_id % 3 > 1 AND d.doc_id % 100 < 38 THEN 'AMBIGUOUS' WHEN l.toxic = 1 AND d.doc_id % 9 = 0 THEN 'BAD' ELSE 'GOOD' END AS label,
    (d.doc_id % 11 <> 0) AS available, (d.doc_id % 13 = 0) AS fallback, d.doc_id % 3 AS eligible,
    CASE WHEN d.doc_id % 5 <> 0 THEN (d.doc_id % 100) / 100.0::DOUBLE END AS margin,
    (d.n_chars % 1000)::DOUBLE / 1000 AS area, ((d.n_chars * 7) % 1000)::DOUBLE / 1000 AS bbox_ratio,
    ((d.n_chars * 3) % 120)::DOUBLE / 10 AS perimeter FROM documents d JOIN labels l USING (doc_id)
"""
STATUS = """CASE WHEN NOT available OR fallback OR eligible < 1 THEN 'failed'
    WHEN eligible > 1 AND coalesce(margin < {min_margin}, true) THEN 'uncertain' WHEN area >= {max_area} THEN 'uncertain'
    WHEN area >= {large_area} AND bbox_ratio < {min_bbox_ratio} AND perimeter > {max_perimeter} THEN 'uncertain' ELSE 'reliable' END"""
#: The production gate.
GATE = {"max_area": 0.999, "large_area": 0.25, "min_bbox_ratio": 0.80, "max_perimeter": 8.0, "min_margin": 0.33}


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.select("doc_id", "n_chars").join(marks, "doc_id")
    i, n = F.col("doc_id"), F.col("n_chars")
    return rows.select(
        "doc_id",
        F.when((n % 1000 >= 250) & (n * 7 % 1000 < 800) & (n * 3 % 120 > 60), "BAD")
        .when((i % 3 > 1) & (i % 100 < 38), "AMBIGUOUS")
        .when((F.col("toxic") == 1) & (i % 9 == 0), "BAD")
        .otherwise("GOOD")
        .alias("label"),
        (i % 11 != 0).alias("available"),
        (i % 13 == 0).alias("fallback"),
        (i % 3).alias("eligible"),
        F.when(i % 5 != 0, (i % 100) / 100.0).alias("margin"),
        ((n % 1000).cast("double") / 1000).alias("area"),
        ((n * 7 % 1000).cast("double") / 1000).alias("bbox_ratio"),
        ((n * 3 % 120).cast("double") / 10).alias("perimeter"),
    )


def _status(gate: dict) -> F.Column:
    names = ("available", "fallback", "eligible", "margin", "area", "bbox_ratio", "perimeter")
    return labels.gate_status({c: F.col(c) for c in names}, {k: v if hasattr(v, "cast") else F.lit(v) for k, v in gate.items()})


@query("gate_status", f"SELECT doc_id, label, {STATUS.format(**GATE)} AS status FROM ({AUDIT})")
def gate_status(spark, sf_dir):
    return _audit(spark, sf_dir).select("doc_id", "label", _status(GATE).alias("status"))


@query(
    "gate_metrics",
    f"""
    SELECT count(*) AS audited, count(*) FILTER (WHERE status = 'reliable') AS reliable,
        count(*) FILTER (WHERE status = 'reliable' AND label = 'GOOD') AS reliable_good,
        count(*) FILTER (WHERE status = 'reliable' AND label <> 'GOOD') AS false_reliable,
        round(count(*) FILTER (WHERE status = 'reliable' AND label = 'GOOD') / nullif(count(*) FILTER (WHERE status = 'reliable'), 0), 9) AS prec
    FROM (SELECT *, {STATUS.format(**GATE)} AS status FROM ({AUDIT}))
    """,
)
def gate_metrics(spark, sf_dir):
    rows = _audit(spark, sf_dir).withColumn("status", _status(GATE))
    ok, good = F.col("status") == "reliable", F.col("label") == "GOOD"
    out = rows.agg(F.count("*").alias("audited"), F.count_if(ok).alias("reliable"), F.count_if(ok & good).alias("reliable_good"), F.count_if(ok & ~good).alias("false_reliable"))
    return out.withColumn("prec", F.round(F.try_divide("reliable_good", "reliable"), 9))


@query(
    "gate_subgroups",
    f"""
    SELECT tag, count(*) AS n, count(*) FILTER (WHERE status = 'reliable') AS reliable FROM (
        SELECT *, {STATUS.format(**GATE)} AS status,
            unnest(list_filter(['all', CASE WHEN eligible > 1 THEN 'several' END, CASE WHEN area >= 0.5 THEN 'large' END,
            CASE WHEN label = 'GOOD' THEN 'good' END], lambda x: x IS NOT NULL)) AS tag FROM ({AUDIT})) GROUP BY tag
    """,
)
def gate_subgroups(spark, sf_dir):
    rows = _audit(spark, sf_dir).withColumn("status", _status(GATE))
    tags = F.array_compact(F.array(F.lit("all"), F.when(F.col("eligible") > 1, "several"), F.when(F.col("area") >= 0.5, "large"), F.when(F.col("label") == "GOOD", "good")))
    return rows.withColumn("tag", F.explode(tags)).groupBy("tag").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "reliable").alias("reliable"))


#: Values of the calibration grid: 640 gates.
GRID = {
    "max_area": (0.995, 0.999),
    "large_area": (0.25, 0.35, 0.50, 0.60),
    "min_bbox_ratio": (0.60, 0.70, 0.80, 0.90),
    "max_perimeter": (6.0, 7.0, 8.0, 9.0),
    "min_margin": (0.20, 0.30, 0.33, 0.40, 0.50),
}
_GRID_SQL = " CROSS JOIN ".join(f"(SELECT unnest([{', '.join(f'{v}::DOUBLE' for v in vs)}]) AS {k})" for k, vs in GRID.items())
_STATUS_G = STATUS.format(**{k: f"g.{k}" for k in GRID})
SWEEP = f"""
SELECT {', '.join(GRID)}, count(*) FILTER (WHERE status = 'reliable' AND label = 'GOOD') AS reliable_good,
    count(*) FILTER (WHERE status = 'reliable') AS reliable, count(*) FILTER (WHERE label = 'GOOD') AS good, count(*) AS n
FROM (SELECT g.*, a.label, {_STATUS_G} AS status FROM ({AUDIT}) a CROSS JOIN (SELECT * FROM {_GRID_SQL}) g) GROUP BY ALL
"""


def _grid(spark: SparkSession) -> DataFrame:
    grid = spark.range(1).select(F.lit(0).alias("none"))
    for name, values in GRID.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.drop("none")


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gate of the grid against every audited row; rows that no gate of the grid tells apart are counted first."""
    audit = _audit(spark, sf_dir).withColumns(
        {
            "eligible": F.least("eligible", F.lit(2)),
            "margin": rel.snap_down(F.col("margin"), GRID["min_margin"]),
            "area": rel.snap_down(F.col("area"), GRID["max_area"] + GRID["large_area"]),
            "bbox_ratio": rel.snap_down(F.col("bbox_ratio"), GRID["min_bbox_ratio"]),
            "perimeter": rel.snap_up(F.col("perimeter"), GRID["max_perimeter"]),
        }
    )
    reads = ["label", "available", "fallback", "eligible", "margin", "area", "bbox_ratio", "perimeter"]
    kinds = audit.groupBy(*reads).agg(F.count("*").alias("w"))  # some thousands of cells, whatever the input
    grid = F.broadcast(_grid(spark))  # 640 rows, whatever the input
    both = kinds.join(grid).withColumn("status", _status({k: F.col(k) for k in GRID}))
    ok, good, w = F.col("status") == "reliable", F.col("label") == "GOOD", F.col("w")
    total = lambda c: F.sum(F.when(c, w).otherwise(0))
    return both.groupBy(*GRID).agg(total(ok & good).alias("reliable_good"), total(ok).alias("reliable"), total(good).alias("good"), F.sum("w").alias("n"))


@query("gate_sweep", SWEEP)
def gate_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)


_DISTANCE = " + ".join(f"abs({k} - {v})" for k, v in GATE.items())


@query(
    "gate_recommended",
    f"""
    SELECT {', '.join(GRID)}, reliable_good, reliable FROM (SELECT *, round({_DISTANCE}, 9) AS far FROM ({SWEEP}))
    WHERE CASE WHEN reliable > 0 THEN reliable_good / reliable ELSE 0.0 END >= 0.95
    ORDER BY reliable_good DESC, reliable_good / good DESC, reliable_good / reliable DESC, reliable / n DESC, far,
        {', '.join(GRID)} LIMIT 1
    """,
)
def gate_recommended(spark, sf_dir):
    return ev.recommend_gate(_sweep(spark, sf_dir), GATE)


@query(
    "threshold_choice",
    """
    WITH s AS (SELECT conv_id, turn, (length(text) % 100) / 100.0::DOUBLE AS score FROM conversations),
    t AS (SELECT unnest(range(20, 51, 5)) / 100.0::DOUBLE AS threshold),
    m AS (SELECT threshold, conv_id, count(*) AS n, count(*) FILTER (WHERE score >= threshold) AS taken FROM s CROSS JOIN t GROUP BY ALL)
    SELECT threshold, round(avg(taken / n), 6) AS mean_recall, count(*) FILTER (WHERE taken = 0) AS empty FROM m GROUP BY threshold
    """,
)
def threshold_choice(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", ((F.length("text") % 100) / 100.0).alias("score"))
    grid = [k / 100.0 for k in range(20, 51, 5)]
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"), *[F.count_if(F.col("score") >= t).alias(f"t{k}") for k, t in enumerate(grid)])
    rows = counts.select("n", F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{k}").alias("taken")) for k, t in enumerate(grid)])))
    return rows.groupBy("threshold").agg(F.round(F.avg(F.col("taken") / F.col("n")), 6).alias("mean_recall"), F.count_if(F.col("taken") == 0).alias("empty"))


@query(
    "feature_distributions",
    f"""
    SELECT feature, label, count(v) AS n, min(v) AS lo, round(quantile_cont(v, 0.25), 9) AS q1, round(quantile_cont(v, 0.5), 9) AS q2,
        round(quantile_cont(v, 0.75), 9) AS q3, max(v) AS hi
    FROM (UNPIVOT (SELECT label, area, bbox_ratio, perimeter FROM ({AUDIT})) ON area, bbox_ratio, perimeter INTO NAME feature VALUE v) GROUP BY ALL
    """,
)
def feature_distributions(spark, sf_dir):
    rows = _audit(spark, sf_dir).select("label", "area", "bbox_ratio", "perimeter").unpivot("label", ["area", "bbox_ratio", "perimeter"], "feature", "v")
    out = rel.exact_quantiles(rows, ["feature", "label"], "v", (0.25, 0.5, 0.75))
    return out.select("feature", "label", "n", "lo", *[F.round(F.get("q", F.lit(k)), 9).alias(f"q{k + 1}") for k in range(3)], "hi")


_AHASH = """
SELECT vec_id, label, list_sum(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i]::DOUBLE >= m AND i < 64 THEN (1::HUGEINT << (i - 1)::HUGEINT)
    WHEN embedding[i]::DOUBLE >= m THEN -(1::HUGEINT << 63::HUGEINT) ELSE 0::HUGEINT END))::BIGINT AS ahash
FROM (SELECT *, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / 64 AS m FROM embeddings)
"""


def _ahash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", hashing.average_hash(F.col("embedding")).alias("ahash"))


@query("ahash64", _AHASH)
def ahash64(spark, sf_dir):
    return _ahash(spark, sf_dir)


#: 64 bits of a text: whether each of 64 letters occurs an odd number of times, so near copies differ in few.
_PARITY = """SELECT doc_id, list_sum(list_transform(range(0, 64), lambda i: CASE WHEN (len(text) - len(replace(text, chr((59 + i)::INTEGER), ''))) % 2 = 0 THEN 0::HUGEINT
    WHEN i < 63 THEN 1::HUGEINT << i::HUGEINT ELSE -(1::HUGEINT << 63::HUGEINT) END))::BIGINT AS bits FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)"""


def parity_hash(text: F.Column) -> F.Column:
    return hashing.letter_parity(text, 59)


@query("text_hash64", _PARITY)
def text_hash64(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", parity_hash(F.col("text")).alias("bits"))


@query(
    "hamming_pairs",
    f"""WITH h AS ({_PARITY}) SELECT a.doc_id AS a, b.doc_id AS b, bit_count(xor(a.bits, b.bits))::INTEGER AS distance
    FROM h a JOIN h b ON a.doc_id < b.doc_id AND bit_count(xor(a.bits, b.bits)) <= 4""",
)
def hamming_pairs(spark, sf_dir):
    return rel.hamming_pairs(text_hash64(spark, sf_dir), "doc_id", "bits", 4)


@query(
    "cross_split_leakage",
    """
    SELECT sha, list_sort(list(DISTINCT split)) AS splits, count(*) AS n FROM (
        SELECT sha256(coalesce(text, '')) AS sha, CASE doc_id % 3 WHEN 0 THEN 'test' WHEN 1 THEN 'train' ELSE 'val' END AS split FROM documents)
    GROUP BY sha HAVING count(DISTINCT split) > 1
    """,
)
def cross_split_leakage(spark, sf_dir):
    i = F.col("doc_id") % 3
    docs = _sha(spark, sf_dir).withColumn("split", F.when(i == 0, "test").when(i == 1, "train").otherwise("val"))
    return rel.values_across(docs, "sha", "split")


@query(
    "components",
    """
    WITH RECURSIVE s AS (SELECT doc_id, sha256(coalesce(text, '')) AS sha, source || ':' || n_chars AS variant FROM documents),
    e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sha = b.sha UNION SELECT a.doc_id, b.doc_id FROM s a JOIN s b ON a.variant = b.variant),
    r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
    SELECT doc_id, min(other) AS group_root FROM r GROUP BY doc_id
    """,
)
def components(spark, sf_dir):
    docs = _sha(spark, sf_dir).withColumn("variant", F.concat_ws(":", "source", F.col("n_chars").cast("string")))
    edges = None
    for key in ("sha", "variant"):
        low = docs.groupBy(key).agg(F.min("doc_id").alias("root"))
        star = docs.join(low, key).select(F.col("doc_id").alias("src"), F.col("root").alias("dst"))
        edges = star if edges is None else edges.unionAll(star)
    found = connected_components(edges)
    return docs.join(found, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("group_root"))


@query(
    "target_counts",
    """
    WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    e AS (SELECT source, n, n * 0.7::DOUBLE AS a, n * 0.15::DOUBLE AS b FROM c),
    f AS (SELECT *, floor(a)::BIGINT AS fa, floor(b)::BIGINT AS fb FROM e),
    g AS (SELECT *, n - fa - 2 * fb AS rest, a - fa AS ra, b - fb AS rb FROM f)
    SELECT source, n, fa + CASE WHEN (CASE WHEN rb > ra THEN 2 ELSE 0 END) < rest THEN 1 ELSE 0 END AS train,
        fb + CASE WHEN (CASE WHEN ra >= rb THEN 1 ELSE 0 END) < rest THEN 1 ELSE 0 END AS val,
        fb + CASE WHEN (1 + CASE WHEN ra >= rb THEN 1 ELSE 0 END) < rest THEN 1 ELSE 0 END AS test FROM g
    """,
)
def target_counts(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    train, val, test = rel.largest_remainder(F.col("n"), (0.7, 0.15, 0.15))
    return counts.select("source", "n", train.alias("train"), val.alias("val"), test.alias("test"))


_SPLIT = "CASE WHEN doc_id % 20 < 14 THEN 'train' WHEN doc_id % 20 < 17 THEN 'val' ELSE 'test' END"


def _split() -> F.Column:
    i = F.col("doc_id") % 20
    return F.when(i < 14, "train").when(i < 17, "val").otherwise("test")


@query(
    "source_split_matrix",
    f"""
    WITH s AS (SELECT source, {_SPLIT} AS split FROM documents), d AS (SELECT * FROM (SELECT DISTINCT source FROM s), (SELECT unnest(['test', 'train', 'val']) AS split))
    SELECT d.source, d.split, count(s.source) AS n, round(count(s.source) / sum(count(s.source)) OVER (PARTITION BY d.source), 9) AS share
    FROM d LEFT JOIN s ON s.source = d.source AND s.split = d.split GROUP BY d.source, d.split
    """,
)
def source_split_matrix(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", _split().alias("split"))
    wide = rows.groupBy("source").pivot("split", ["test", "train", "val"]).count().na.fill(0)
    cells = wide.unpivot("source", ["test", "train", "val"], "split", "n")
    return cells.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 9))


_ENTRY = "doc_id || chr(9) || sha256(coalesce(text, '')) || chr(10)"


@query(
    "split_fingerprint",
    f"""
    WITH e AS (SELECT {_SPLIT} AS split, doc_id // 1000 AS a, {_ENTRY} AS entry FROM documents),
    p AS (SELECT split, a, a // 1000 AS b, lpad(a::VARCHAR, 16, '0') || sha256(string_agg(entry, '' ORDER BY entry)) || chr(10) AS entry, count(*) AS n FROM e GROUP BY split, a),
    q AS (SELECT split, lpad(b::VARCHAR, 16, '0') || sha256(string_agg(entry, '' ORDER BY entry)) || chr(10) AS entry, sum(n) AS n FROM p GROUP BY split, b)
    SELECT split, sha256(string_agg(entry, '' ORDER BY entry)) AS fingerprint, sum(n)::BIGINT AS n FROM q GROUP BY split
    """,
)
def split_fingerprint(spark, sf_dir):
    docs = _sha(spark, sf_dir).withColumn("split", _split())
    entry = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), "sha", F.lit("\n"))
    return hashing.fingerprints(docs.select("split", "doc_id", entry.alias("entry")), "split", "doc_id", "entry")


_TURNS = "SELECT conv_id, turn, length(text) AS area, (length(text) * 37 % 1000) / 1000.0::DOUBLE AS score FROM conversations"


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", n.alias("area"), ((n * 37 % 1000) / 1000.0).alias("score"))


@query(
    "instance_selection",
    f"""SELECT conv_id, turn, round(area / nullif(max(area) OVER (PARTITION BY conv_id), 0), 9) AS relative_area, score FROM ({_TURNS})
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, area DESC, turn) = 1""",
)
def instance_selection(spark, sf_dir):
    best = F.max_by(F.struct("turn", "area", "score"), F.struct("score", "area", -F.col("turn")))
    rows = _turns(spark, sf_dir).groupBy("conv_id").agg(best.alias("b"), F.max("area").alias("most"))
    return rows.select("conv_id", "b.turn", F.round(F.try_divide(F.col("b.area"), F.col("most")), 9).alias("relative_area"), "b.score")


@query(
    "score_margin",
    f"""SELECT conv_id, round(max(score) FILTER (WHERE k = 1) - max(score) FILTER (WHERE k = 2), 9) AS margin
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS k FROM ({_TURNS})) GROUP BY conv_id""",
)
def score_margin(spark, sf_dir):
    ranked = _turns(spark, sf_dir).withColumn("k", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "turn"))).where("k <= 2")
    top = ranked.groupBy("conv_id").agg(F.max(F.when(F.col("k") == 1, F.col("score"))).alias("a"), F.max(F.when(F.col("k") == 2, F.col("score"))).alias("b"))
    return top.select("conv_id", F.round(F.col("a") - F.col("b"), 9).alias("margin"))


_POINTS = """
SELECT vec_id, list_transform(range(0, 32), lambda i: {'x': round((embedding[2 * i + 1]::DOUBLE + 1) / 2, 9), 'y': round((embedding[2 * i + 2]::DOUBLE + 1) / 2, 9)}) AS p FROM embeddings
"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.round((F.get("embedding", i).cast("double") + 1) / 2, 9)
    p = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(at(i * 2).alias("x"), at(i * 2 + 1).alias("y")))
    return table(spark, sf_dir, "embeddings").select("vec_id", p.alias("p"))


@query(
    "polygon_stats",
    f"""
    SELECT vec_id, round(abs(list_sum(list_transform(range(1, 33), lambda i: p[i].x * p[i % 32 + 1].y - p[i % 32 + 1].x * p[i].y))) / 2, 6) AS area,
        list_min(list_transform(p, lambda q: q.x)) AS x1, list_max(list_transform(p, lambda q: q.y)) AS y2 FROM ({_POINTS})
    """,
)
def polygon_stats(spark, sf_dir):
    rows = _points(spark, sf_dir)
    box = geo.bounds(F.col("p"))
    return rows.select("vec_id", F.round(geo.polygon_area(F.col("p")), 6).alias("area"), box["x1"].alias("x1"), box["y2"].alias("y2"))


@query(
    "box_iou_pairs",
    """
    WITH b AS (SELECT vec_id, abs(embedding[1]::DOUBLE) AS cx, abs(embedding[2]::DOUBLE) AS cy, abs(embedding[3]::DOUBLE) + 0.1 AS w, abs(embedding[4]::DOUBLE) + 0.1 AS h FROM embeddings),
    n AS (SELECT a.vec_id, a.vec_id + 1 AS other, greatest(0, least(a.cx + a.w / 2, b.cx + b.w / 2) - greatest(a.cx - a.w / 2, b.cx - b.w / 2))
        * greatest(0, least(a.cy + a.h / 2, b.cy + b.h / 2) - greatest(a.cy - a.h / 2, b.cy - b.h / 2)) AS i, a.w * a.h + b.w * b.h AS s FROM b a JOIN b ON b.vec_id = a.vec_id + 1)
    SELECT vec_id, other, round(CASE WHEN s - i > 0 THEN i / (s - i) ELSE 0 END, 6) AS iou FROM n
    """,
)
def box_iou_pairs(spark, sf_dir):
    e = lambda k: F.abs(F.get("embedding", F.lit(k)).cast("double"))
    box = F.struct(e(0).alias("cx"), e(1).alias("cy"), (e(2) + 0.1).alias("w"), (e(3) + 0.1).alias("h"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", box.alias("a"))
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("other"), F.col("a").alias("b"))
    return rows.join(other, "vec_id").select("vec_id", "other", F.round(geo.box_iou(F.col("a"), F.col("b")), 6).alias("iou"))


@query(
    "decision_counts",
    """
    SELECT decision, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'exclude_unknown_class' WHEN o_orderpriority = '1-URGENT' THEN 'exclude_lesion'
        WHEN o_orderpriority <> '2-HIGH' THEN 'manual_review' WHEN o_orderkey % 2 = 0 THEN 'include_after_remap' WHEN o_orderkey % 3 = 0 THEN 'recover_from_coco' ELSE 'manual_review' END AS decision FROM orders)
    GROUP BY decision
    """,
)
def decision_counts(spark, sf_dir):
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    role = F.when(p == "1-URGENT", "lesion").when(p == "2-HIGH", "full_leaf").otherwise("other")
    return table(spark, sf_dir, "orders").groupBy(labels.decide(role, k % 7 != 0, k % 2 == 0, k % 3 == 0).alias("decision")).agg(F.count("*").alias("n"))


@query(
    "wildcard_review_join",
    """
    SELECT l_orderkey, l_linenumber, r.rule FROM lineitem l JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 1 + o_orderkey % 4 END AS line, 'review' || o_orderkey % 5 AS rule FROM orders) r
    ON r.o_orderkey = l.l_orderkey AND (r.line IS NULL OR r.line = l.l_linenumber)
    """,
)
def wildcard_review_join(spark, sf_dir):
    k = F.col("o_orderkey")
    reviews = table(spark, sf_dir, "orders").select(k.alias("l_orderkey"), F.when(k % 3 != 0, 1 + k % 4).alias("line"), F.concat(F.lit("review"), (k % 5).cast("string")).alias("rule"))
    both = table(spark, sf_dir, "lineitem").join(reviews, "l_orderkey").where(F.col("line").isNull() | (F.col("line") == F.col("l_linenumber")))
    return both.select("l_orderkey", "l_linenumber", "rule")


@query(
    "line_renumber",
    """SELECT l_orderkey, l_linenumber AS old_line, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS new_line
    FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linenumber % 2 = 0)""",
)
def line_renumber(spark, sf_dir):
    kept = table(spark, sf_dir, "lineitem").where(~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 2 == 0)))
    return kept.select("l_orderkey", F.col("l_linenumber").alias("old_line"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")).alias("new_line"))


@query(
    "outer_mismatch",
    """SELECT doc_id, 'document_without_label' AS problem FROM documents ANTI JOIN labels USING (doc_id)
    UNION ALL SELECT doc_id, 'label_without_document' FROM labels ANTI JOIN documents USING (doc_id)""",
)
def outer_mismatch(spark, sf_dir):
    docs, marks = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    left = docs.join(marks, "doc_id", "left_anti").withColumn("problem", F.lit("document_without_label"))
    return left.unionAll(marks.join(docs, "doc_id", "left_anti").withColumn("problem", F.lit("label_without_document")))


@query(
    "exclusion_reasons",
    """
    WITH h AS (SELECT doc_id, lang, n_chars, sha256(coalesce(text, '')) AS sha FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY sha, coalesce(n_chars, 0) < 200, lang = 'es' ORDER BY doc_id) AS k FROM h)
    SELECT CASE WHEN coalesce(n_chars, 0) < 200 THEN 'too_short' WHEN lang = 'es' THEN 'held_out_language' WHEN k > 1 THEN 'duplicate_hash' ELSE 'accepted' END AS reason, count(*) AS n FROM r GROUP BY 1
    """,
)
def exclusion_reasons(spark, sf_dir):
    """Only rows that pass the earlier checks can make a later one a duplicate."""
    first = F.when(F.coalesce("n_chars", F.lit(0)) < 200, "too_short").when(F.col("lang") == "es", "held_out_language")
    rows = _sha(spark, sf_dir).withColumn("reason", first)
    passed = rows.where("reason is null").groupBy("sha").agg(F.count("*").alias("k"))
    early = rows.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
    late = passed.agg(F.count("*").alias("accepted"), F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("duplicate_hash")).unpivot([], ["accepted", "duplicate_hash"], "reason", "n")
    return early.unionByName(late).where("n > 0")


@query(
    "class_summary_dense",
    """SELECT n_nationkey, n_name, count(c_custkey) AS customers, count(DISTINCT c_mktsegment) AS segments FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9000 GROUP BY ALL""",
)
def class_summary_dense(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.count_distinct("c_mktsegment").alias("segments"))
    nations = table(spark, sf_dir, "nation").join(rich, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return nations.select("n_nationkey", "n_name", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("segments", F.lit(0)).alias("segments"))


@query(
    "instance_histogram",
    """SELECT least(n, 3) AS orders_each, count(*) AS customers, max(n) AS most FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) GROUP BY 1""",
)
def instance_histogram(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    each = table(spark, sf_dir, "customer").select("c_custkey").join(counts, "c_custkey", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return each.groupBy(F.least("n", F.lit(3)).alias("orders_each")).agg(F.count("*").alias("customers"), F.max("n").alias("most"))


@query(
    "hash_topn",
    """SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('42' || chr(0) || doc_id), doc_id) AS position FROM documents QUALIFY position <= 5""",
)
def hash_topn(spark, sf_dir):
    return rel.hash_top(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 5)


@query(
    "round_robin_pick",
    """SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn FROM documents ORDER BY turn, source, doc_id LIMIT 50""",
)
def round_robin_pick(spark, sf_dir):
    return rel.round_robin(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"], 50)


@query(
    "balanced_oversample",
    """
    WITH r AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS i, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
    m AS (SELECT max(n) AS m FROM r)
    SELECT s_nationkey, s_suppkey, (k // n)::INTEGER AS copy FROM r, m, LATERAL (SELECT unnest(range(0, m)) AS k) WHERE k % n = i
    """,
)
def balanced_oversample(spark, sf_dir):
    return rel.oversample(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", ["s_suppkey"])


@query(
    "equal_width_histogram",
    """WITH e AS (SELECT min(p_retailprice)::DOUBLE AS lo, max(p_retailprice)::DOUBLE AS hi FROM part)
    SELECT least(19, floor((p_retailprice::DOUBLE - lo) / ((hi - lo) / 20)))::INTEGER AS bin, count(*) AS n FROM part, e GROUP BY 1""",
)
def equal_width_histogram(spark, sf_dir):
    return rel.equal_width_histogram(table(spark, sf_dir, "part").select(F.col("p_retailprice").cast("double").alias("v")), "v")


@query(
    "unique_theta_match",
    """
    SELECT l_orderkey, min(s_suppkey) AS s_suppkey FROM (SELECT o.o_orderkey AS l_orderkey, s.s_suppkey FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN supplier s ON s.s_nationkey = c.c_nationkey AND abs(s.s_acctbal::DOUBLE - c.c_acctbal::DOUBLE) <= 500) GROUP BY l_orderkey HAVING count(*) = 1
    """,
)
def unique_theta_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").cast("double").alias("a"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_acctbal").cast("double").alias("b"))
    matches = rel.unique_match(rel.within(customers, suppliers, ["nation"], "a", "b", 500.0), "c_custkey", "s_suppkey")
    return orders.join(matches, "c_custkey").select("l_orderkey", "s_suppkey")


@query(
    "resolution_and_orientation",
    """SELECT CASE WHEN w > h THEN 'horizontal' WHEN h > w THEN 'vertical' ELSE 'square' END AS orientation, CASE WHEN w > h * 1.1 THEN 'horizontal' WHEN h > w * 1.1 THEN 'vertical' ELSE 'square' END AS loose,
    CASE WHEN w * h < 500000 THEN 'small' WHEN w * h < 2000000 THEN 'medium' ELSE 'large' END AS pixels, CASE WHEN w * h / 1e6 <= 0.1 THEN 'low_<=0.10mp' WHEN w * h / 1e6 <= 1.0 THEN 'medium_<=1.00mp' ELSE 'high_>1.00mp' END AS mega, count(*) AS n
    FROM (SELECT 200 + p_partkey * 13 % 1900 AS w, 200 + p_partkey * 29 % 1700 AS h FROM part) GROUP BY ALL""",
)
def resolution_and_orientation(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    rows = table(spark, sf_dir, "part").select((200 + k * 13 % 1900).alias("w"), (200 + k * 29 % 1700).alias("h"))
    w, h = F.col("w"), F.col("h")
    keys = [geo.orientation(w, h).alias("orientation"), geo.orientation_with_tolerance(w, h).alias("loose"), geo.resolution_by_pixels(w, h).alias("pixels"), geo.resolution_by_megapixels(w, h).alias("mega")]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


from curata.plans import annotations, evaluation, outlines, reviews, selection, splits  # noqa: E402, F401  (they register their queries)
