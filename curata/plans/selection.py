"""Queries that choose rows: exclusions, priorities, quotas, spreads and lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.operators import selection as se
from curata.plans.registry import query, table

_CANDIDATES = "SELECT doc_id, source, lang, n_chars, lower(coalesce(source, '') || '/' || n_chars % 400) AS path, sha256(coalesce(text, '')) AS sha FROM documents"


def _candidates(spark, sf_dir):
    n = F.col("n_chars") % 400
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.lower(F.concat(F.coalesce("source", F.lit("")), F.lit("/"), n.cast("string"))).alias("path"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))


@query(
    "screening",
    f"""
    WITH c AS ({_CANDIDATES}), h AS (SELECT DISTINCT sha FROM c WHERE doc_id % 37 = 0), e AS (SELECT *, CASE WHEN n_chars % 11 = 0 THEN 'unsupported_extension' WHEN path IN (SELECT path FROM c WHERE doc_id % 53 = 0) THEN 'held_out_path' END AS early FROM c),
    f AS (SELECT sha, min(doc_id) AS first, arg_min(path, doc_id) AS first_path FROM e WHERE early IS NULL AND sha NOT IN (SELECT sha FROM h) GROUP BY sha)
    SELECT doc_id, CASE WHEN early IS NOT NULL THEN early WHEN first IS NULL THEN 'held_out_hash' WHEN first = doc_id THEN NULL WHEN first_path = path THEN 'duplicate_path' ELSE 'duplicate_hash' END AS reason FROM e LEFT JOIN f USING (sha)
    """,
)
def screening(spark, sf_dir):
    rows = _candidates(spark, sf_dir)
    held_paths = rows.where("doc_id % 53 = 0").select("path").distinct().withColumn("__hit", F.lit(True))
    known = rows.join(held_paths, "path", "left")
    early = [("unsupported_extension", F.col("n_chars") % 11 == 0), ("held_out_path", F.col("__hit").isNotNull())]
    return se.screened(known, "doc_id", early, "path", "sha", rows.where("doc_id % 37 = 0")).select("doc_id", "reason")


_SCORES = """
SELECT path, arg_max(r, o_orderkey) AS rank, arg_max(p, o_orderkey) AS probability FROM (SELECT 'c' || o_custkey AS path, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderstatus <> 'F')::INTEGER ELSE (o_orderkey % 5 <> 0)::INTEGER END AS r, coalesce(try_cast(CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE printf('%.2f', (o_orderkey % 100) / 100.0) END AS DOUBLE), 1.0) AS p FROM orders) GROUP BY path
"""


def _scores(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("path"),
        "o_orderkey",
        F.when(k % 3 == 0, "F").alias("label"),
        F.when(F.col("o_orderstatus") == "F", "wrong").otherwise("F").alias("pred_label"),
        F.when(k % 5 == 0, "False").otherwise("yes").alias("correct"),
        F.when(k % 4 == 0, "x").otherwise(F.format_string("%.2f", (k % 100) / 100.0)).alias("pred_prob"),
    )
    return se.priority_scores(rows, "path", "o_orderkey")


@query("priority_scores", _SCORES)
def priority_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


@query(
    "pilot_rows",
    f"""
    WITH c AS (SELECT c_custkey, c_mktsegment, 'c' || c_custkey AS path, c_acctbal > 5000 AS real FROM customer), s AS ({_SCORES}), r AS (SELECT c.*, row_number() OVER (PARTITION BY c_mktsegment ORDER BY coalesce(rank, 2), coalesce(probability, 1.0), NOT real, sha256('42' || chr(0) || path), path) AS turn FROM c LEFT JOIN s USING (path))
    SELECT c_custkey, c_mktsegment, turn FROM r ORDER BY turn, c_mktsegment LIMIT 60
    """,
)
def pilot_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("path"), "c_acctbal")
    return se.pilot(rows, "c_mktsegment", "path", F.col("c_acctbal") > 5000, _scores(spark, sf_dir), 60).select("c_custkey", "c_mktsegment", "turn")


@query("first_of_path", "SELECT p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_type) || p_size % 10 ORDER BY p_partkey) = 1")
def first_of_path(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_type", (F.col("p_size") % 10).cast("string")).alias("path"))
    return se.first_of_path(rows, "path", "p_partkey").select("p_partkey")


@query(
    "interleaved_rows",
    """
    WITH t AS (SELECT p_partkey, p_brand, p_size % 3 AS bucket, row_number() OVER (PARTITION BY p_brand, p_size % 3 ORDER BY sha256('42' || chr(0) || p_partkey), p_partkey) AS turn FROM part)
    SELECT p_partkey, turn, row_number() OVER (PARTITION BY p_brand ORDER BY turn, bucket) AS spread FROM t WHERE turn <= 5
    """,
)
def interleaved_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", (F.col("p_size") % 3).alias("bucket"))
    return se.interleaved(rows, ["p_brand"], ["bucket"], "p_partkey", 5).select("p_partkey", "turn", "spread")


@query(
    "class_quotas",
    """WITH b AS (SELECT p_brand, count(*) FILTER (WHERE p_size > 45) AS room FROM part GROUP BY p_brand), n AS (SELECT *, row_number() OVER (ORDER BY p_brand) AS pos, count(*) OVER () AS k FROM b),
    u AS (SELECT p_brand, unnest(range(1, room + 1)) AS unit FROM b), f AS (SELECT p_brand, count(*) AS taken FROM (SELECT * FROM u ORDER BY unit, p_brand LIMIT 37) GROUP BY p_brand)
    SELECT p_brand, 103 // k + (pos <= 103 % k)::INTEGER AS quota, coalesce(taken, 0) AS taken FROM n LEFT JOIN f USING (p_brand)""",
)
def class_quotas(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_brand", "p_size")
    room = parts.groupBy("p_brand").agg(F.count_if(F.col("p_size") > 45).alias("room"))
    filled = se.filled_quotas(room, "p_brand", "room", 37).withColumnRenamed("quota", "taken")
    return se.even_quotas(parts, "p_brand", 103).join(filled, "p_brand", "left").select("p_brand", "quota", F.coalesce("taken", F.lit(0)).alias("taken"))


@query("detector_sample")
def detector_sample(spark, sf_dir):
    """A hundred parts with equal brands, four in five of them not small, spread over sizes."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", (F.col("p_size") % 4).alias("bucket"))
    return se.detector_sample(rows, "p_brand", F.col("p_size") <= 10, ["bucket"], "p_partkey", 100)


@query("top_rows", "SELECT source FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY min(-n_chars), source LIMIT 12")
def top_rows(spark, sf_dir):
    return se.top_rows(table(spark, sf_dir, "documents").where("source is not null").withColumn("far", -F.col("n_chars")), "source", ["far"])
