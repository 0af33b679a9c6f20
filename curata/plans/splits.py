"""Queries about splits of documents without leakage."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.functions import geometry as geo
from curata.operators import relational as rel
from curata.operators import splitting as sp
from curata.plans import catalog
from curata.plans.registry import query, table
from curata.storage import materialize

RECORDS_SQL = f"""
SELECT doc_id, source, lang, n_chars, sha256(coalesce(text, '')) AS sha, lower(left(trim(coalesce(text, '')), 12)) AS base, CASE WHEN doc_id % 4 = 0 THEN source || ':' || n_chars ELSE '' END AS variant, bits,
    CASE WHEN doc_id % 20 < 14 THEN 'train' WHEN doc_id % 20 < 17 THEN 'val' ELSE 'test' END AS split FROM documents JOIN ({catalog._PARITY}) USING (doc_id)
"""
COMPONENTS_SQL = f"""
s AS ({RECORDS_SQL}), e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sha = b.sha UNION SELECT a.doc_id, b.doc_id FROM s a JOIN s b ON a.variant = b.variant AND a.variant <> ''
    UNION SELECT a.doc_id, b.doc_id FROM s a JOIN s b ON a.source = b.source AND a.base = b.base UNION SELECT a.doc_id, b.doc_id FROM s a JOIN s b ON bit_count(xor(a.bits, b.bits)) <= 4),
r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a), g AS (SELECT doc_id, min(other) AS group_root FROM r GROUP BY doc_id)
"""


def _records(spark, sf_dir):
    i = F.col("doc_id")
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        "n_chars",
        F.sha2(text, 256).alias("sha"),
        F.lower(F.left(F.trim(text), F.lit(12))).alias("base"),
        F.when(i % 4 == 0, F.concat("source", F.lit(":"), F.col("n_chars").cast("string"))).otherwise("").alias("variant"),
        catalog.parity_hash(F.col("text")).alias("bits"),
        F.when(i % 20 < 14, "train").when(i % 20 < 17, "val").otherwise("test").alias("split"),
    )


def _grouped(spark, sf_dir):
    records = materialize(_records(spark, sf_dir), "records")  # texts are read and hashed once
    return sp.related(records, "doc_id", [["sha"], ["variant"], ["source", "base"]], "bits", 4, carry=[c for c in records.columns if c != "doc_id"])


@query("split_groups", f"WITH RECURSIVE {COMPONENTS_SQL} SELECT doc_id, group_root FROM g")
def split_groups(spark, sf_dir):
    return _grouped(spark, sf_dir).select("doc_id", "group_root")


@query(
    "split_group_ids",
    f"""WITH RECURSIVE {COMPONENTS_SQL} SELECT group_root, 'grp_' || left(sha256(string_agg(sha, chr(10) ORDER BY doc_id)), 16) AS group_id, count(*) AS group_size, string_agg(DISTINCT source, '|' ORDER BY source) AS sources,
    count(DISTINCT sha) AS exact_hash_count FROM g JOIN s USING (doc_id) GROUP BY group_root""",
)
def split_group_ids(spark, sf_dir):
    rows = _grouped(spark, sf_dir)
    known = rows.groupBy("group_root").agg(F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"), F.count_distinct("sha").alias("exact_hash_count"))
    return sp.group_ids(rows.select("group_root", "doc_id", "sha"), "group_root", "doc_id", "sha").join(known, "group_root")


_COUNTS_SQL = "count(*) AS images, sum(1 + n_chars % 3)::BIGINT AS masks"


def _features(rows):
    return sp.group_features(
        rows,
        "group_root",
        {"images": F.lit(1), "masks": 1 + F.coalesce("n_chars", F.lit(0)) % 3, "border_images": (F.col("n_chars") % 5 == 0).cast("int"), "multi_instance_images": (F.col("n_chars") % 3 > 0).cast("int")},
        {"source": F.col("source"), "orientation": F.col("lang"), "area": geo.area_bin(F.col("n_chars") / 10000.0)},
    )


@query(
    "split_group_features",
    f"""WITH RECURSIVE {COMPONENTS_SQL}, f AS (SELECT group_root, unnest([{{'feature': 'images', 'n': 1}}, {{'feature': 'masks', 'n': 1 + coalesce(n_chars, 0) % 3}}, {{'feature': 'border_images', 'n': (n_chars % 5 = 0)::INTEGER}},
        {{'feature': 'multi_instance_images', 'n': (n_chars % 3 > 0)::INTEGER}}, {{'feature': 'source:' || coalesce(source, ''), 'n': 1}}, {{'feature': 'orientation:' || coalesce(lang, ''), 'n': 1}},
        {{'feature': 'area:' || CASE WHEN n_chars / 10000.0 < 0.05 THEN 'small' WHEN n_chars / 10000.0 > 0.5 THEN 'large' ELSE 'medium' END, 'n': 1}}], recursive := true) FROM g JOIN s USING (doc_id))
    SELECT group_root, feature, sum(n)::BIGINT AS n FROM f GROUP BY ALL HAVING sum(n) > 0""",
)
def split_group_features(spark, sf_dir):
    return _features(_grouped(spark, sf_dir))


@query("split_assignment")
def split_assignment(spark, sf_dir):
    """Whole groups in splits of 70, 15 and 15 percent; a sequence of choices, so no SQL."""
    return sp.assign_splits(_features(_grouped(spark, sf_dir)), "group_root")


@query(
    "split_summary",
    f"SELECT split, count(*) AS images, sum(n_chars)::BIGINT AS n_chars, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM ({RECORDS_SQL}) GROUP BY split",
)
def split_summary(spark, sf_dir):
    return sp.split_summary(_records(spark, sf_dir), "split", ["n_chars"]).withColumn("share", F.round("share", 9))


@query(
    "leakage_values",
    f"""WITH s AS ({RECORDS_SQL}) SELECT 'exact_hash' AS leakage_type, sha AS value, string_agg(DISTINCT split, '|' ORDER BY split) AS splits, count(*) AS n FROM s GROUP BY sha HAVING count(DISTINCT split) > 1
    UNION ALL SELECT 'variant', variant, string_agg(DISTINCT split, '|' ORDER BY split), count(*) FROM s GROUP BY variant HAVING count(DISTINCT split) > 1""",
)
def leakage_values(spark, sf_dir):
    return sp.crossing_values(_records(spark, sf_dir), [("exact_hash", "sha"), ("variant", "variant")])


@query(
    "leakage_pairs",
    f"""WITH s AS ({RECORDS_SQL}) SELECT a.doc_id AS a, b.doc_id AS b, a.split || '|' || b.split AS splits, bit_count(xor(a.bits, b.bits))::INTEGER AS distance
    FROM s a JOIN s b ON a.doc_id < b.doc_id AND a.split <> b.split AND bit_count(xor(a.bits, b.bits)) <= 4""",
)
def leakage_pairs(spark, sf_dir):
    return sp.crossing_pairs(_records(spark, sf_dir), "doc_id", "bits", 4)


@query(
    "pilot_leakage",
    f"""WITH s AS ({RECORDS_SQL}), h AS (SELECT * FROM s WHERE doc_id % 17 = 0), d AS (SELECT * FROM s WHERE doc_id % 17 <> 0)
    SELECT 'exact_hash' AS leakage_type, d.doc_id AS record, h.doc_id AS held, NULL::INTEGER AS distance FROM d JOIN h ON d.sha = h.sha
    UNION ALL SELECT 'original_base_name', d.doc_id, h.doc_id, NULL FROM d JOIN h ON d.base = h.base AND d.base <> ''
    UNION ALL SELECT 'variant', d.doc_id, h.doc_id, NULL FROM d JOIN h ON d.variant = h.variant AND d.variant <> ''
    UNION ALL SELECT 'perceptual_near', d.doc_id, h.doc_id, bit_count(xor(d.bits, h.bits))::INTEGER FROM d JOIN h ON bit_count(xor(d.bits, h.bits)) <= 4""",
)
def pilot_leakage(spark, sf_dir):
    records = _records(spark, sf_dir)
    held = F.col("doc_id") % 17 == 0
    return sp.held_out_matches(records.where(~held), records.where(held), "doc_id", [("exact_hash", "sha"), ("original_base_name", "base"), ("variant", "variant")], "bits", 4)


@query(
    "partition_overlap",
    f"""WITH s AS ({RECORDS_SQL}), v AS (SELECT DISTINCT 'sha' AS signal, sha AS value, split FROM s UNION SELECT DISTINCT 'base', base, split FROM s WHERE base <> '')
    SELECT a.split AS left_split, b.split AS right_split, count(*) AS shared, a.signal FROM v a JOIN v b ON a.signal = b.signal AND a.value = b.value AND a.split < b.split GROUP BY ALL""",
)
def partition_overlap(spark, sf_dir):
    return sp.partition_overlap(_records(spark, sf_dir), "split", ["sha", "base"])


@query(
    "preserved_problems",
    f"""WITH s AS ({RECORDS_SQL}), k AS (SELECT doc_id + 3 AS doc_id, CASE WHEN doc_id % 50 = 7 THEN 'dev' ELSE split END AS split FROM s WHERE doc_id % 40 <> 5), b AS (SELECT s.doc_id, s.sha, k.split FROM s JOIN k USING (doc_id))
    SELECT 'missing' AS problem, doc_id::VARCHAR AS value FROM s ANTI JOIN k USING (doc_id) UNION ALL SELECT 'extra', doc_id::VARCHAR FROM k ANTI JOIN s USING (doc_id)
    UNION ALL SELECT 'invalid', doc_id::VARCHAR FROM k WHERE split NOT IN ('train', 'val', 'test') UNION ALL SELECT 'crossing', sha FROM b GROUP BY sha HAVING count(DISTINCT split) > 1""",
)
def preserved_problems(spark, sf_dir):
    i = F.col("doc_id")
    records = _records(spark, sf_dir)
    kept = records.where(i % 40 != 5).select((i + 3).alias("doc_id"), F.when(i % 50 == 7, "dev").otherwise(F.col("split")).alias("split"))
    return sp.preserved_problems(records, "doc_id", "sha", kept)


@query(
    "numbered_ids",
    """SELECT doc_id, lang || '_' || lpad(row_number() OVER (PARTITION BY lang ORDER BY doc_id)::VARCHAR, 6, '0') AS id FROM documents""",
)
def numbered_ids(spark, sf_dir):
    rows = rel.numbered(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"], "at", ["lang"])
    return rows.select("doc_id", F.concat("lang", F.lit("_"), F.lpad(F.col("at").cast("string"), 6, "0")).alias("id"))
