"""Queries that compare annotations and count them by image and source; orders are images, their lines annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.functions import boxes, strings
from curata.operators import annotations as an
from curata.operators import manifests as mf
from curata.operators import masks
from curata.plans.registry import query, table

_SIDE = """SELECT l_orderkey, sum(n)::BIGINT AS {p}_count, sum(v)::BIGINT AS {p}_valid, sum(q)::BIGINT AS {p}_points, round(sum(a), 4) AS {p}_area, list_sort(list((l_shipmode, n))) AS classes FROM
    (SELECT l_orderkey, l_linestatus || l_linenumber % 2 AS l_shipmode, count(*) AS n, count(*) FILTER (WHERE l_tax > 0.02) AS v, sum(l_linenumber) AS q, sum(l_discount::DOUBLE) AS a FROM lineitem WHERE {w} GROUP BY ALL) GROUP BY l_orderkey"""


@query(
    "annotation_comparison",
    f"""SELECT l_orderkey, y.yolo_count IS NOT NULL AS in_yolo, c.coco_count IS NOT NULL AS in_coco, y.classes IS NOT DISTINCT FROM c.classes AS class_names_match, coalesce(yolo_count, 0) - coalesce(coco_count, 0) AS count_delta,
    {', '.join(f"coalesce({s}_{k}, 0) AS {s}_{k}" for s in ('yolo', 'coco') for k in ('count', 'valid', 'points', 'area'))} FROM ({_SIDE.format(p='yolo', w="l_returnflag <> 'A'")}) y FULL JOIN ({_SIDE.format(p='coco', w="l_quantity > 8")}) c USING (l_orderkey)""",
)
def annotation_comparison(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("kind", F.concat("l_linestatus", (F.col("l_linenumber") % 2).cast("string")))
    side = lambda df, p: an.per_image(df, "l_orderkey", "kind", F.col("l_tax") > 0.02, F.col("l_linenumber").cast("long"), F.col("l_discount").cast("double"), p)
    out = an.compared(side(lines.where("l_returnflag <> 'A'"), "yolo"), side(lines.where("l_quantity > 8"), "coco"), "l_orderkey")
    return out.withColumns({c: F.round(c, 4) for c in ("yolo_area", "coco_area")})


@query(
    "geometry_cascade",
    """SELECT o_orderkey, CASE WHEN a.v IS NOT NULL THEN 'source' WHEN b.v IS NOT NULL THEN 'coco' WHEN c.v IS NOT NULL THEN 'recovered' ELSE 'unresolved' END AS origin, coalesce(a.v, b.v, c.v) AS geometry FROM orders
    LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a ON a.l_orderkey = o_orderkey LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS v FROM lineitem WHERE l_quantity > 45 GROUP BY 1) b ON b.l_orderkey = o_orderkey
    LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS v FROM lineitem WHERE l_linenumber = 2 GROUP BY 1) c ON c.l_orderkey = o_orderkey""",
)
def geometry_cascade(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("geometry"), "l_returnflag", "l_quantity", "l_linenumber")
    sources = [("source", lines.where("l_returnflag = 'R'")), ("coco", lines.where("l_quantity > 45")), ("recovered", lines.where("l_linenumber = 2"))]
    return an.first_known(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", sources, "geometry").select("o_orderkey", "origin", "geometry")


@query(
    "source_totals",
    """WITH a AS (SELECT source, count(*) AS images FROM documents GROUP BY 1), b AS (SELECT source, count(*) AS polygons FROM documents JOIN labels USING (doc_id) GROUP BY 1), c AS (SELECT source, count(*) AS invalid FROM documents JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY 1),
    d AS (SELECT source, count(*) AS full_leaf FROM documents JOIN labels USING (doc_id) WHERE toxic = 0 GROUP BY 1), t AS (SELECT source, images, coalesce(polygons, 0) AS polygons, coalesce(invalid, 0) AS invalid, coalesce(full_leaf, 0) AS full_leaf FROM a LEFT JOIN b USING (source) LEFT JOIN c USING (source) LEFT JOIN d USING (source))
    SELECT *, CASE WHEN images = 0 OR polygons = 0 THEN 'reject_empty' WHEN length(source) % 5 = 0 THEN 'reject_licence' WHEN full_leaf = 0 THEN 'reject_no_full_leaf' WHEN invalid > 0 THEN 'accept_with_review' ELSE 'accept' END AS decision FROM t""",
)
def source_totals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    known = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    out = an.totals_by_source([("images", docs), ("polygons", known), ("invalid", known.where("quality = 0")), ("full_leaf", known.where("toxic = 0"))], "source")
    n = {c: F.col(c) for c in ("images", "polygons", "invalid", "full_leaf")}
    return out.withColumn("decision", an.source_decision(n["images"], n["polygons"], n["invalid"], F.length("source") % 5 != 0, n["full_leaf"]))


@query(
    "instance_counts",
    """WITH n AS (SELECT c_mktsegment, c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderkey % 5 = 0 GROUP BY ALL)
    SELECT c_mktsegment, count(*) AS images, count(*) FILTER (WHERE n = 0) AS with_0, count(*) FILTER (WHERE n = 1) AS with_1, count(*) FILTER (WHERE n = 2) AS with_2, count(*) FILTER (WHERE n >= 3) AS with_3_or_more, max(n) AS most, round(avg(n), 6) AS mean, quantile_cont(n, 0.5) AS median FROM n GROUP BY 1""",
)
def instance_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderkey % 5 = 0").select(F.col("o_custkey").alias("c_custkey"))
    out = an.instance_counts(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), orders, "c_custkey", ["c_mktsegment"])
    return out.withColumn("mean", F.round("mean", 6))


@query("mask_geometry")
def mask_geometry(spark, sf_dir):
    """Outlines of eight points around the middle, filled on 64 x 64 pixels and measured; tested against a flood fill."""
    point = lambda i: F.struct((0.5 + F.cos(i * 0.785398) * F.least(F.lit(0.45), 0.1 + F.abs(F.get("embedding", i).cast("double")))).alias("x"), (0.5 + F.sin(i * 0.785398) * F.least(F.lit(0.45), 0.1 + F.abs(F.get("embedding", i).cast("double")))).alias("y"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.array(F.transform(F.sequence(F.lit(0), F.lit(7)), point)).alias("o"))
    return masks.measured(masks.rasterised(rows, "vec_id", "o", 64), "vec_id", 64)


REASONS = {"include_after_remap": "valid polygon", "exclude_lesion": "lesion class", "manual_review": "needs a look"}


@query(
    "decision_reasons",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'valid polygon' WHEN o_orderkey % 3 = 1 THEN 'lesion class' ELSE 'exclude_duplicate' END || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ': ' || o_orderpriority END AS reason,
    CASE WHEN o_orderkey % 5 = 0 THEN '/abs/' || o_orderkey WHEN o_orderkey % 2 = 0 THEN '/root/img/r/' || o_orderkey ELSE '/manifests/r/' || o_orderkey END AS path, CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus ELSE (o_orderkey % 100)::VARCHAR END AS evidence FROM orders""",
)
def decision_reasons(spark, sf_dir):
    k = F.col("o_orderkey")
    decision = F.when(k % 3 == 0, "include_after_remap").when(k % 3 == 1, "exclude_lesion").otherwise("exclude_duplicate")
    path = F.concat(F.when(k % 5 == 0, "/abs/").otherwise("r/"), k.cast("string"))
    evidence = F.when(k % 7 == 0, "no json").otherwise(F.to_json(F.struct((k % 100).alias("n"))))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        strings.reason_text(decision, REASONS, F.when(k % 4 == 0, "").otherwise(F.col("o_orderpriority"))).alias("reason"),
        strings.resolve_path(path, F.when(k % 2 == 0, "/root/img/").otherwise(""), F.lit("/manifests")).alias("path"),
        strings.json_or_column(evidence, "n", F.col("o_orderstatus")).alias("evidence"),
    )


@query(
    "report_flows",
    """WITH m AS (SELECT coalesce(l_returnflag, '') AS s, coalesce(l_linestatus, '') AS c, CASE WHEN l_linenumber % 3 = 0 THEN 'exclude_lesion' ELSE 'include_after_remap' END AS d FROM lineitem)
    SELECT 'source' AS section, s || '|' || d AS key, count(*) AS n FROM m GROUP BY ALL UNION ALL SELECT 'class', c || '|' || d, count(*) FROM m GROUP BY ALL UNION ALL SELECT 'decision', d, count(*) FROM m GROUP BY ALL""",
)
def report_flows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("d", F.when(F.col("l_linenumber") % 3 == 0, "exclude_lesion").otherwise("include_after_remap"))
    return mf.roll_ups(lines, {"source": ["l_returnflag", "d"], "class": ["l_linestatus", "d"], "decision": ["d"]})


@query(
    "split_manifest",
    """SELECT CASE WHEN p_partkey % 20 < 14 THEN 'train' WHEN p_partkey % 20 < 17 THEN 'val' ELSE 'test' END AS split, p_brand AS group_id, p_type AS source_dataset, 'P' || p_partkey || '.jpg' AS filename, 'all/images/P' || p_partkey || '.jpg' AS source_image_path, 'all/labels/P' || p_partkey || '.txt' AS source_label_path,
    'images/' || split || '/P' || p_partkey || '.jpg' AS materialized_image_path, 'labels/' || split || '/P' || p_partkey || '.txt' AS materialized_label_path, printf('%.12f', least(p_size / 64.0::DOUBLE, 0.25)) AS mask_area_min, printf('%.12f', greatest(p_size / 64.0::DOUBLE, 0.25)) AS mask_area_max,
    printf('%.12f', (p_size / 64.0::DOUBLE + 0.25) / 2) AS mask_area_mean, 'copy' AS materialization_method FROM part""",
)
def split_manifest(spark, sf_dir):
    k = F.col("p_partkey") % 20
    records = table(spark, sf_dir, "part").select(
        F.when(k < 14, "train").when(k < 17, "val").otherwise("test").alias("split"),
        F.col("p_brand").alias("group_id"),
        F.col("p_type").alias("source_dataset"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("filename"),
        F.array((F.col("p_size") / 64.0), F.lit(0.25)).alias("mask_areas"),
    )
    return mf.canonical_order(mf.split_rows(records), "split", "filename")


@query(
    "method_counts",
    "SELECT count(*) AS images, count(*) FILTER (WHERE o_orderstatus = 'F') AS normalized, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS mended, count(*) FILTER (WHERE o_orderkey % 3 = 1) AS reencoded FROM orders WHERE o_orderkey % 5 < 4",
)
def method_counts(spark, sf_dir):
    k = F.col("o_orderkey")
    manifest = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("all/images/"), k.cast("string"), F.lit(".jpg")).alias("derived_path"),
        F.when(F.col("o_orderstatus") == "F", "normalized").otherwise("unchanged").alias("status"),
        F.when(k % 3 == 0, "append_ffd9").when(k % 3 == 1, "reencode_quality_95").otherwise("copy").alias("method"),
    )
    images = table(spark, sf_dir, "orders").where(k % 5 < 4).select(F.concat(k.cast("string"), F.lit(".jpg")).alias("name"))
    kept, _ = mf.surviving(manifest, "derived_path", images, "name")
    return mf.method_counts(kept, "method", "status")


@query(
    "crop_plans",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE * 7.3 - 40 AS x1, l_discount::DOUBLE * 2000 - 20.5 AS y1, l_quantity::DOUBLE * 7.3 - 40 + (l_partkey % 300) - 20.25 AS x2, l_discount::DOUBLE * 2000 - 20.5 + (l_suppkey % 90) AS y2, 300 AS w, 200 AS h FROM lineitem),
    c AS (SELECT *, least(greatest(floor(x1), 0), w)::INTEGER AS a1, least(greatest(floor(y1), 0), h)::INTEGER AS b1, least(greatest(ceil(x2), 0), w)::INTEGER AS a2, least(greatest(ceil(y2), 0), h)::INTEGER AS b2 FROM b),
    v AS (SELECT *, CASE WHEN x2 <= x1 THEN 'x_inverted' WHEN y2 <= y1 THEN 'y_inverted' WHEN a2 <= a1 OR b2 <= b1 THEN 'outside_image' WHEN (a2 - a1) * (b2 - b1) / (w * h)::DOUBLE < 0.02 THEN 'too_small' END AS r FROM c),
    p AS (SELECT *, CASE WHEN r IS NULL THEN greatest(0, floor(a1 - (a2 - a1) * 0.1)) ELSE 30 END::INTEGER AS c1, CASE WHEN r IS NULL THEN greatest(0, floor(b1 - (b2 - b1) * 0.1)) ELSE 20 END::INTEGER AS d1, CASE WHEN r IS NULL THEN least(w, ceil(a2 + (a2 - a1) * 0.1)) ELSE 270 END::INTEGER AS c2, CASE WHEN r IS NULL THEN least(h, ceil(b2 + (b2 - b1) * 0.1)) ELSE 180 END::INTEGER AS d2 FROM v)
    SELECT l_orderkey, l_linenumber, c1 AS x1, d1 AS y1, c2 AS x2, d2 AS y2, r IS NOT NULL AS fallback, CASE WHEN r IS NOT NULL THEN r WHEN floor(x1) <> a1 OR floor(y1) <> b1 OR ceil(x2) <> a2 OR ceil(y2) <> b2 THEN 'clipped_to_image' END AS note,
        least(224, greatest(1, round_even((c2 - c1) * least(224.0::DOUBLE / (c2 - c1), 224.0::DOUBLE / (d2 - d1)), 0)))::INTEGER AS width FROM p""",
)
def crop_plans(spark, sf_dir):
    q, d = F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")
    x1, y1 = q * 7.3 - 40, d * 2000 - 20.5
    box = F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + F.col("l_partkey") % 300 - 20.25).alias("x2"), (y1 + F.col("l_suppkey") % 90).alias("y2"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b"))
    plan = boxes.crop_plan(F.col("b"), F.lit(300), F.lit(200), 0.02, 0.1, (224, 224))
    return rows.select("l_orderkey", "l_linenumber", plan.alias("p")).select("l_orderkey", "l_linenumber", "p.crop.*", "p.fallback", "p.note", "p.fitted.width")
