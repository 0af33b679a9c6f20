"""Queries about reviews, regions of interest and validators."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.operators import regions, reviews
from curata.operators import validation as va
from curata.plans.registry import query, table

_GENERAL = """SELECT o_custkey % 40 AS k, o_orderkey AS position, 'src' || o_custkey % 3 AS source_dataset, 'f' || o_custkey % 40 || ' ' AS filename, CASE WHEN o_custkey % 5 = 0 THEN '' ELSE (o_custkey % 4)::VARCHAR END AS original_line_number, '1' AS original_class_id,
    CASE o_orderkey % 7 WHEN 0 THEN 'approved' WHEN 1 THEN 'exclude' WHEN 2 THEN 'needs_reannotation' WHEN 3 THEN 'maybe' ELSE '' END AS reviewer_decision, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'seen' END AS review_reason,
    CASE WHEN o_orderkey % 7 < 4 OR o_orderkey % 9 = 0 THEN 'completed' WHEN o_orderkey % 8 = 0 THEN 'done' ELSE 'pending' END AS review_status FROM orders"""
_NORMAL = f"SELECT position, trim(source_dataset) AS source_dataset, trim(filename) AS filename, original_line_number, original_class_id, reviewer_decision, review_reason, review_status, concat_ws('|', trim(source_dataset), trim(filename), original_line_number, original_class_id) AS review_key, k FROM ({_GENERAL})"


def _general(spark, sf_dir):
    c, o = F.col("o_custkey"), F.col("o_orderkey")
    text = lambda v: v.cast("string")
    return table(spark, sf_dir, "orders").select(
        text(o).alias("position"),
        F.concat(F.lit("src"), text(c % 3)).alias("source_dataset"),
        F.concat(F.lit("f"), text(c % 40), F.lit(" ")).alias("filename"),
        F.when(c % 5 == 0, "").otherwise(text(c % 4)).alias("original_line_number"),
        F.lit("1").alias("original_class_id"),
        F.when(o % 7 == 0, "approved").when(o % 7 == 1, "exclude").when(o % 7 == 2, "needs_reannotation").when(o % 7 == 3, "maybe").otherwise("").alias("reviewer_decision"),
        F.when(o % 6 == 0, "").otherwise("seen").alias("review_reason"),
        F.when((o % 7 < 4) | (o % 9 == 0), "completed").when(o % 8 == 0, "done").otherwise("pending").alias("review_status"),
    )


@query(
    "review_problems",
    f"""SELECT position::VARCHAR AS position, 'review_' || left(sha256(review_key), 16) AS review_case_id, concat_ws(';', CASE WHEN review_status NOT IN ('pending', 'completed') THEN 'invalid_status' END, CASE WHEN reviewer_decision NOT IN ('', 'approved', 'exclude', 'needs_reannotation') THEN 'invalid_decision' END,
        CASE WHEN review_status = 'completed' AND reviewer_decision = '' THEN 'completed_without_decision' END, CASE WHEN review_status = 'completed' AND review_reason = '' THEN 'completed_without_reason' END,
        CASE WHEN reviewer_decision <> '' AND review_status <> 'completed' THEN 'decision_without_completion' END) AS problems FROM ({_NORMAL})""",
)
def review_problems(spark, sf_dir):
    rows = reviews.normalised(_general(spark, sf_dir), "general")
    return rows.select("position", "review_case_id", F.array_join(reviews.problems(), ";").alias("problems"))


@query(
    "review_contradictions",
    f"SELECT review_key FROM ({_NORMAL}) WHERE review_status = 'completed' GROUP BY review_key HAVING count(DISTINCT (reviewer_decision, review_reason)) > 1",
)
def review_contradictions(spark, sf_dir):
    return reviews.contradictions(reviews.normalised(_general(spark, sf_dir), "general"))


@query(
    "unique_reviews",
    f"""SELECT review_key, reviewer_decision, review_status, CASE WHEN position % 10 = 1 THEN 'mandatory' ELSE 'general' END AS origin FROM ({_NORMAL})
    QUALIFY row_number() OVER (PARTITION BY review_key ORDER BY (position % 10 = 1) DESC, position DESC) = 1""",
)
def unique_reviews(spark, sf_dir):
    rows = _general(spark, sf_dir)
    is_first = F.col("position").cast("long") % 10 == 1
    both = reviews.unique_reviews(reviews.normalised(rows.where(is_first), "mandatory"), reviews.normalised(rows.where(~is_first), "general"), "position")
    return both.select("review_key", "reviewer_decision", "review_status", "origin")


@query(
    "decisions_fingerprint",
    f"""WITH u AS (SELECT *, 'review_' || left(sha256(review_key), 16) AS case_id FROM ({_NORMAL}) QUALIFY row_number() OVER (PARTITION BY review_key ORDER BY position DESC) = 1)
    SELECT substr(case_id, 8, 2) AS part, count(*) AS unique_cases, sha256('[' || string_agg('{{"review_case_id":"' || case_id || '","review_key":"' || review_key || '","review_reason":"' || review_reason || '","review_status":"' || review_status || '","reviewer_decision":"' || reviewer_decision || '"}}', ',' ORDER BY review_key) || ']') AS sha256 FROM u GROUP BY 1""",
)
def decisions_fingerprint(spark, sf_dir):
    rows = reviews.normalised(_general(spark, sf_dir), "general")
    return reviews.decisions_fingerprint(reviews.unique_reviews(rows.limit(0), rows, "position"))


_MANIFEST = "SELECT l_orderkey, l_linenumber, l_linenumber % 2 AS class_id, CASE WHEN min(l_returnflag) = 'A' THEN 'exclude_lesion' WHEN l_linenumber % 4 = 0 THEN 'recover_from_coco' ELSE 'include_after_remap' END AS decision FROM lineitem GROUP BY l_orderkey, l_linenumber"
_SAID = """SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 12, '0') || '|' || p AS review_key, CASE WHEN (o_orderkey + p) % 5 = 0 THEN NULL ELSE 1 + (o_orderkey + p) % 4 END AS line, CASE WHEN (o_orderkey + p) % 3 = 0 THEN NULL ELSE (o_orderkey + p) % 2 END AS class_id,
    CASE (o_orderkey + p) % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'exclude' WHEN 2 THEN 'needs_reannotation' ELSE 'exclude' END AS reviewer_decision, 'r' || p AS review_reason FROM orders, (SELECT unnest([0, 1]) AS p) WHERE o_orderpriority < '3'"""


@query(
    "reviews_applied",
    f"""
    WITH m AS ({_MANIFEST}), r AS ({_SAID}), j AS (SELECT m.l_orderkey, m.l_linenumber, m.decision, r.review_key, r.reviewer_decision FROM m JOIN r ON r.o_orderkey = m.l_orderkey AND (r.line IS NULL OR r.line = m.l_linenumber) AND (r.class_id IS NULL OR r.class_id = m.class_id)),
    a AS (SELECT l_orderkey, l_linenumber, count(*) AS reviews, arg_max(reviewer_decision, review_key) AS said, arg_min(reviewer_decision, review_key) FILTER (WHERE reviewer_decision <> 'approved' AND decision NOT LIKE 'exclude%') AS against FROM j GROUP BY ALL),
    d AS (SELECT m.*, coalesce(reviews, 0) AS reviews, said AS reviewer_decision, CASE WHEN against = 'exclude' THEN 'exclude_human_review' WHEN against IS NOT NULL THEN 'exclude_needs_reannotation' ELSE decision END AS final_decision FROM m LEFT JOIN a USING (l_orderkey, l_linenumber))
    SELECT l_orderkey, l_linenumber, reviews, reviewer_decision, final_decision, CASE WHEN final_decision NOT LIKE 'exclude%' THEN row_number() OVER (PARTITION BY l_orderkey, final_decision LIKE 'exclude%' ORDER BY l_linenumber)::INTEGER END AS final_line,
        bool_or(final_decision NOT LIKE 'exclude%') OVER (PARTITION BY l_orderkey) AS file_left FROM d
    """,
)
def reviews_applied(spark, sf_dir):
    k, n = F.col("o_orderkey"), F.col("o_orderkey") + F.col("p")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"))
    manifest = lines.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linenumber") % 2).alias("class_id"),
        F.when(F.col("l_returnflag") == "A", "exclude_lesion").when(F.col("l_linenumber") % 4 == 0, "recover_from_coco").otherwise("include_after_remap").alias("decision"),
    )
    said = table(spark, sf_dir, "orders").where("o_orderpriority < '3'").withColumn("p", F.explode(F.array(F.lit(0), F.lit(1))))
    said = said.select(
        k.alias("l_orderkey"),
        F.concat(F.lpad(k.cast("string"), 12, "0"), F.lit("|"), F.col("p").cast("string")).alias("review_key"),
        F.when(n % 5 != 0, 1 + n % 4).alias("l_linenumber"),
        F.when(n % 3 != 0, n % 2).alias("class_id"),
        F.when(n % 4 == 0, "approved").when(n % 4 == 2, "needs_reannotation").otherwise("exclude").alias("reviewer_decision"),
        F.concat(F.lit("r"), F.col("p").cast("string")).alias("review_reason"),
    )
    out = reviews.applied(manifest, said, ["l_orderkey", "l_linenumber"], ["l_orderkey"], ["l_linenumber", "class_id"], "l_orderkey", "l_linenumber")
    return out.select("l_orderkey", "l_linenumber", "reviews", "reviewer_decision", "final_decision", "final_line", "file_left")


@query(
    "dataset_lock",
    f"""SELECT CASE WHEN pending > 0 OR invalid > 0 THEN 'blocked_by_manual_review' ELSE 'ready_for_split_generation' END AS status, concat_ws(';', CASE WHEN pending > 0 THEN 'manual_reviews_pending=' || pending END, CASE WHEN invalid > 0 THEN 'invalid_review_rows=' || invalid END) AS blockers, images, masks FROM
    (SELECT count(DISTINCT filename) AS images, count(*) AS masks, count(*) FILTER (WHERE review_status <> 'completed') AS pending, count(*) FILTER (WHERE review_status NOT IN ('pending', 'completed')) AS invalid FROM ({_NORMAL}))""",
)
def dataset_lock(spark, sf_dir):
    rows = reviews.normalised(_general(spark, sf_dir), "general")
    one = rows.agg(F.count_distinct("filename").alias("i"), F.count("*").alias("m"), F.count_if(F.col("review_status") != "completed").alias("p"), F.count_if(~F.col("review_status").isin(*reviews.STATUSES)).alias("x"))
    lock = one.select(reviews.lock_document(F.col("i"), F.col("m"), F.col("p"), F.col("x"), F.lit(True)).alias("d"))
    return lock.select("d.status", F.array_join("d.blockers", ";").alias("blockers"), "d.images", "d.masks")


_ANN = """SELECT l_partkey AS id, l_returnflag, CASE l_linenumber % 5 WHEN 0 THEN 'Rejected' WHEN 1 THEN 'unclear' ELSE ' annotated' END AS status, 'n' || l_linenumber AS notes, (l_quantity::DOUBLE * 5 - 30)::VARCHAR AS x1, (l_suppkey % 50)::VARCHAR AS y1,
    CASE WHEN l_linenumber = 6 THEN 'wide' ELSE (l_quantity::DOUBLE * 5 + 40)::VARCHAR END AS x2, (l_suppkey % 50 + 60)::VARCHAR AS y2 FROM lineitem WHERE l_orderkey % 16 < 3"""
_DRAWN = f"""
WITH p AS (SELECT p_partkey AS id, 250 AS w, 100 AS h FROM part), a AS (SELECT id, count(*) AS n, min((status, notes, x1, y1, x2, y2)) AS r FROM ({_ANN}) GROUP BY id), j AS (SELECT p.*, n, lower(trim(r[1])) AS said, trim(r[2]) AS notes,
    try_cast(r[3] AS DOUBLE) AS x1, try_cast(r[4] AS DOUBLE) AS y1, try_cast(r[5] AS DOUBLE) AS x2, try_cast(r[6] AS DOUBLE) AS y2 FROM p LEFT JOIN a USING (id)),
c AS (SELECT *, least(greatest(floor(x1), 0), w)::INTEGER AS a1, least(greatest(floor(y1), 0), h)::INTEGER AS b1, least(greatest(ceil(x2), 0), w)::INTEGER AS a2, least(greatest(ceil(y2), 0), h)::INTEGER AS b2 FROM j),
v AS (SELECT *, (a2 - a1) * (b2 - b1) / (w * h)::DOUBLE AS share, CASE WHEN x1 IS NULL OR x2 IS NULL THEN 'not_finite' WHEN a2 <= a1 OR b2 <= b1 THEN 'outside_image' WHEN (a2 - a1) * (b2 - b1) / (w * h)::DOUBLE < 0.1 THEN 'too_small' END AS bad FROM c),
s AS (SELECT *, CASE WHEN n IS NULL THEN 'pending' WHEN n > 1 THEN 'ambiguous' WHEN said NOT IN ('annotated', 'ambiguous', 'rejected') THEN 'ambiguous' WHEN said <> 'annotated' THEN said WHEN bad IS NOT NULL THEN 'ambiguous' ELSE 'annotated' END AS st,
    n = 1 AND said = 'annotated' AS measured FROM v)
"""


def _annotated(spark, sf_dir):
    q, n, s = F.col("l_quantity").cast("double"), F.col("l_linenumber"), F.col("l_suppkey") % 50
    text = lambda v: v.cast("string")
    said = table(spark, sf_dir, "lineitem").where("l_orderkey % 16 < 3").select(
        F.col("l_partkey").alias("id"),
        F.when(n % 5 == 0, "Rejected").when(n % 5 == 1, "unclear").otherwise(" annotated").alias("status"),
        F.concat(F.lit("n"), text(n)).alias("notes"),
        text(q * 5 - 30).alias("x1"),
        text(s).alias("y1"),
        F.when(n == 6, "wide").otherwise(text(q * 5 + 40)).alias("x2"),
        text(s + 60).alias("y2"),
    )
    images = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit(250).alias("w"), F.lit(100).alias("h"), "p_brand", "p_size", "p_retailprice")
    return regions.imported(images, said, "id", "w", "h", 0.1)


@query(
    "region_import",
    f"""{_DRAWN} SELECT id, st AS status, CASE WHEN n IS NULL THEN 'no_annotation' WHEN n > 1 THEN 'duplicates=' || n WHEN said NOT IN ('annotated', 'ambiguous', 'rejected') THEN 'unknown_status' WHEN said <> 'annotated' THEN notes WHEN bad IS NOT NULL THEN bad
        WHEN floor(x1) <> a1 OR ceil(x2) <> a2 OR floor(y1) <> b1 OR ceil(y2) <> b2 THEN 'clipped_to_image' END AS note, CASE WHEN st = 'annotated' THEN a1 END AS x1, CASE WHEN st = 'annotated' THEN b2 END AS y2, CASE WHEN st = 'annotated' THEN round(share, 9) END AS area_ratio FROM s""",
)
def region_import(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "annotation.status", "annotation.note", "annotation.box.x1", "annotation.box.y2", F.round("annotation.area_ratio", 9).alias("area_ratio"))


@query(
    "region_errors",
    f"""{_DRAWN} SELECT id, concat_ws(';', CASE WHEN st <> 'annotated' AND id % 6 = 0 THEN 'cells_not_blank' END, CASE WHEN st = 'pending' THEN 'pending' END, CASE WHEN st = 'annotated' AND id % 6 = 0 THEN 'inconsistent_width' END,
        CASE WHEN st = 'annotated' AND id % 7 = 0 THEN 'roi_height' END) AS errors FROM s""",
)
def region_errors(spark, sf_dir):
    rows = _annotated(spark, sf_dir).select("id", "w", "h", regions.manifest_row(F.col("annotation")).alias("m"))
    cells = {f: F.col(f"m.{f}") for f in ("annotation_status", *[f"roi_{k}" for k in ("x1", "y1", "x2", "y2", "width", "height", "area_ratio")])}
    cells["roi_width"] = F.when(F.col("id") % 6 == 0, 7).otherwise(cells["roi_width"])
    cells["roi_height"] = F.when(F.col("id") % 7 != 0, cells["roi_height"])
    found = regions.cell_errors(cells, F.col("w"), F.col("h"), 0.1)  # missing cells before inconsistent ones; the SQL has them by name
    return rows.select("id", F.array_join(F.array_sort(found), ";").alias("errors"))


@query(
    "region_duplicates",
    """
    WITH r AS (SELECT doc_id, CASE WHEN doc_id % 90 = 3 THEN '' ELSE 'p' || doc_id // 2 * 2 + (doc_id % 30 > 0)::INTEGER * (doc_id % 2) END AS pilot_id, source || '/' || n_chars AS path, lower(left(coalesce(text, ''), 6)) AS name, sha256(coalesce(text, '')) AS sha, CASE WHEN doc_id % 20 < 14 THEN 'train' ELSE 'val' END AS split FROM documents)
    SELECT doc_id, 'error' AS severity, 'repeated_id' AS message FROM r QUALIFY count(*) OVER (PARTITION BY pilot_id) > 1
    UNION ALL SELECT doc_id, 'warning', 'repeated_name' FROM r WHERE name <> '' QUALIFY count(*) OVER (PARTITION BY name) > 1
    UNION ALL SELECT doc_id, CASE WHEN k > 1 THEN 'error' ELSE 'warning' END, CASE WHEN k > 1 THEN 'leak_between_splits' ELSE 'repeated_in_split' END FROM r JOIN (SELECT sha, count(*) AS n, count(DISTINCT split) AS k FROM r GROUP BY sha HAVING count(*) > 1) USING (sha)
    """,
)
def region_duplicates(spark, sf_dir):
    i = F.col("doc_id")
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(i % 90 == 3, "").otherwise(F.concat(F.lit("p"), (F.floor(i / 2) * 2 + F.when(i % 30 > 0, i % 2).otherwise(0)).cast("string"))).alias("pilot_id"),
        F.lower(F.left(text, F.lit(6))).alias("name"),
        F.sha2(text, 256).alias("sha"),
        F.when(i % 20 < 14, "train").otherwise("val").alias("split"),
    )
    return regions.repeated_values(rows, "doc_id", "split", [("id", "pilot_id", True), ("name", "name", False)], "sha")


@query(
    "region_coverage",
    f"""{_DRAWN}, t AS (SELECT s.*, p_brand, p_size % 5 AS size FROM s JOIN part ON p_partkey = id) SELECT 'by_class' AS section, p_brand AS value, count(*) AS n FROM t GROUP BY p_brand UNION ALL SELECT 'by_size', size::VARCHAR, count(*) FROM t GROUP BY size
    UNION ALL SELECT 'by_status', st, count(*) FROM t GROUP BY st""",
)
def region_coverage(spark, sf_dir):
    rows = _annotated(spark, sf_dir).withColumns({"size": F.col("p_size") % 5, "status": F.col("annotation.status")})
    return regions.coverage(rows, {"by_class": "p_brand", "by_size": "size", "by_status": "status"})


@query(
    "region_areas",
    f"""{_DRAWN} SELECT count(*) AS n, round(min(share), 9) AS lo, round(max(share), 9) AS hi, round(avg(share), 6) AS mean, round(quantile_cont(share, 0.5), 6) AS median FROM s WHERE st = 'annotated' HAVING count(*) > 0""",
)
def region_areas(spark, sf_dir):
    out = regions.area_summary(_annotated(spark, sf_dir).withColumn("area", F.col("annotation.area_ratio")), "area")
    return out.select("n", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"), F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


RULES = ("empty_text", "missing_source", "wrong_length", "unknown_language")
_BROKEN = """
SELECT unnest(list_filter([CASE WHEN coalesce(text, '') = '' THEN 'empty_text' END, CASE WHEN source IS NULL THEN 'missing_source' END, CASE WHEN n_chars <> length(text) THEN 'wrong_length' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'unknown_language' END], lambda x: x IS NOT NULL)) AS rule, doc_id::VARCHAR AS key FROM documents
"""


def _broken(spark, sf_dir):
    rules = {"empty_text": F.coalesce("text", F.lit("")) == "", "missing_source": F.col("source").isNull(), "wrong_length": F.col("n_chars") != F.length("text"), "unknown_language": ~F.col("lang").isin("en", "de")}
    return va.violations(table(spark, sf_dir, "documents"), "doc_id", rules)


@query("dataset_verdicts", f"SELECT r AS rule, count(key) AS broken, count(key) = 0 AS passed FROM (SELECT unnest(['{"', '".join(RULES)}']) AS r) LEFT JOIN ({_BROKEN}) ON rule = r GROUP BY r")
def dataset_verdicts(spark, sf_dir):
    return va.verdicts(_broken(spark, sf_dir), RULES)


@query("problem_examples", f"SELECT rule, key, row_number() OVER w AS place, count(*) OVER (PARTITION BY rule) AS total FROM ({_BROKEN}) WINDOW w AS (PARTITION BY rule ORDER BY key) QUALIFY row_number() OVER w <= 10")
def problem_examples(spark, sf_dir):
    return va.examples(_broken(spark, sf_dir), "rule", "key")


@query(
    "metric_table",
    """WITH c AS (SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS F, count(*) FILTER (WHERE l_linestatus = 'O') AS O, count(*) FILTER (WHERE l_linestatus IN ('F', 'O')) AS total FROM lineitem GROUP BY 1)
    SELECT 'lines' AS section, l_returnflag AS name, metric, value FROM (UNPIVOT c ON F, O, total INTO NAME metric VALUE value)""",
)
def metric_table(spark, sf_dir):
    wide = va.metric_table(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus"), "l_returnflag", "l_linestatus", ["F", "O"])
    return va.long_table(wide, "lines", "l_returnflag")


@query(
    "set_differences",
    "SELECT o_custkey AS key, 'left' AS only_in FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O') UNION ALL SELECT o_custkey, 'right' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def set_differences(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderstatus")
    return va.unequal(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"), ["key"])


@query(
    "unique_pairs",
    "SELECT k AS key FROM (SELECT o_orderkey % 40000 AS k FROM orders GROUP BY 1 HAVING count(*) = 1) JOIN (SELECT (l_orderkey * 7 + l_linenumber) % 50000 AS k FROM lineitem GROUP BY 1 HAVING count(*) = 1) USING (k)",
)
def unique_pairs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 50000).alias("key"))
    return va.only_pairs(table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 40000).alias("key")), lines, "key")


@query(
    "resolved_names",
    """WITH i AS (SELECT p_partkey, p_name, p_brand || p_size AS base FROM part WHERE p_partkey % 3 > 0), b AS (SELECT base, min(p_partkey) AS v FROM i GROUP BY base HAVING count(*) = 1), e AS (SELECT p_name, min(p_partkey) AS v FROM i GROUP BY p_name)
    SELECT p.p_partkey, coalesce(e.v, b.v) AS match FROM part p LEFT JOIN e USING (p_name) LEFT JOIN b ON b.base = p.p_brand || p.p_size""",
)
def resolved_names(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat("p_brand", F.col("p_size").cast("string")).alias("base"))
    found = va.resolved(parts, "p_name", "base", parts.where("p_partkey % 3 > 0"), "p_name", "base", "p_partkey")
    return found.select("p_partkey", "match")


@query(
    "changed_digests",
    """SELECT d.doc_id, CASE WHEN f.doc_id IS NULL THEN 'missing' ELSE 'changed' END AS problem FROM documents d LEFT JOIN (SELECT doc_id, sha256(coalesce(text, '') || CASE WHEN doc_id % 31 = 0 THEN '!' ELSE '' END) AS sha FROM documents WHERE doc_id % 29 <> 0) f USING (doc_id)
    WHERE f.doc_id IS NULL OR f.sha <> sha256(coalesce(d.text, ''))""",
)
def changed_digests(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    manifest = docs.select("doc_id", F.sha2(text, 256).alias("sha"))
    files = docs.where("doc_id % 29 <> 0").select("doc_id", F.sha2(F.concat(text, F.when(F.col("doc_id") % 31 == 0, "!").otherwise("")), 256).alias("sha"))
    return va.changed_digests(manifest, files, "doc_id", "sha")
