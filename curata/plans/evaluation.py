"""Queries that evaluate masks and gates; masks are sizes taken from order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.functions import geometry as geo
from curata.functions import labels
from curata.operators import evaluation as ev
from curata.plans.registry import query, table

PAIRS_SQL = """
SELECT t.*, coalesce(p.predicted, 0) AS predicted, least(t.truth, coalesce(p.predicted, 0)) * 0.9::DOUBLE AS shared FROM
    (SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE AS truth, l_returnflag AS source, CASE WHEN l_linestatus = 'F' THEN 'horizontal' ELSE 'vertical' END AS orientation, l_linenumber = 1 AS border,
        l_quantity > 40 AS multi_leaf, 100 + l_partkey * 13 % 1400 AS w, 100 + l_suppkey * 7 % 1100 AS h FROM lineitem) t
    LEFT JOIN (SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE * (1 - l_discount::DOUBLE) * (1 + l_tax::DOUBLE) AS predicted FROM lineitem WHERE (l_orderkey + l_linenumber) % 7 <> 0) p USING (l_orderkey, l_linenumber)
"""
METRICS_SQL = f"""
SELECT *, predicted / 200000.0::DOUBLE >= 0.05 AS detected, predicted / 200000.0::DOUBLE < 0.05 AS fallback, shared / truth AS leaf_pixel_recall, CASE WHEN predicted > 0 THEN shared / predicted ELSE 0 END AS leaf_pixel_precision,
    CASE WHEN truth + predicted - shared > 0 THEN shared / (truth + predicted - shared) ELSE 0 END AS iou, CASE WHEN truth + predicted > 0 THEN 2 * shared / (truth + predicted) ELSE 0 END AS dice, 1 - shared / truth AS under_segmentation_ratio,
    greatest(0, predicted - shared) / truth AS over_segmentation_ratio, 100 * (1 - shared / truth) AS cropped_leaf_percent, truth / 200000.0::DOUBLE AS truth_area_fraction FROM ({PAIRS_SQL})
"""
OUTPUTS_SQL = (
    "count(*) AS images, count(*) FILTER (WHERE NOT detected) AS images_without_detection, round(count(*) FILTER (WHERE NOT detected) / count(*), 9) AS images_without_detection_rate, count(*) FILTER (WHERE fallback) AS fallback_images, "
    "round(count(*) FILTER (WHERE fallback) / count(*), 9) AS fallback_rate, " + ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in ev.MEANS) + ", round(max(cropped_leaf_percent), 6) AS worst_cropped_leaf_percent, "
    "round(coalesce(avg(iou) FILTER (WHERE detected), 0), 6) AS mean_iou_detected_only, count(*) FILTER (WHERE multi_leaf) AS multi_leaf_images, round(avg(leaf_pixel_recall) FILTER (WHERE multi_leaf), 6) AS mean_leaf_pixel_recall_multi_leaf"
)
GROUPS_SQL = {
    "by_source": "source",
    "by_orientation": "orientation",
    "by_truth_area_bin": "CASE WHEN truth_area_fraction < 0.05 THEN 'small' WHEN truth_area_fraction > 0.5 THEN 'large' ELSE 'medium' END",
    "by_border_contact": "CASE WHEN border THEN 'touching' ELSE 'interior' END",
    "by_resolution_bin": "CASE WHEN w * h / 1e6 <= 0.1 THEN 'low_<=0.10mp' WHEN w * h / 1e6 <= 1.0 THEN 'medium_<=1.00mp' ELSE 'high_>1.00mp' END",
    "by_leaf_count": "CASE WHEN multi_leaf THEN 'multiple' ELSE 'single' END",
}


def _metric_rows(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    price, k = F.col("l_extendedprice").cast("double"), ["l_orderkey", "l_linenumber"]
    truth = line.select(
        *k,
        price.alias("truth"),
        F.col("l_returnflag").alias("source"),
        F.when(F.col("l_linestatus") == "F", "horizontal").otherwise("vertical").alias("orientation"),
        (F.col("l_linenumber") == 1).alias("border"),
        (F.col("l_quantity") > 40).alias("multi_leaf"),
        (100 + F.col("l_partkey") * 13 % 1400).alias("w"),
        (100 + F.col("l_suppkey") * 7 % 1100).alias("h"),
    )
    predicted = price * (1 - F.col("l_discount").cast("double")) * (1 + F.col("l_tax").cast("double"))
    some = line.where((F.col("l_orderkey") + F.col("l_linenumber")) % 7 != 0).select(*k, predicted.alias("predicted"))
    rows = ev.with_predictions(truth, some, k, ["predicted"]).withColumn("shared", F.least("truth", "predicted") * 0.9)
    rows = rows.withColumn("m", ev.pair_metrics(F.col("truth"), F.col("predicted"), F.col("shared"), F.lit(200000.0), 0.05))
    return rows.select(*k, "source", "orientation", "border", "multi_leaf", "w", "h", "m.*", (~F.col("m.detected")).alias("fallback"))


@query("downstream_rows", f"SELECT l_orderkey, l_linenumber, detected, {', '.join(f'round({c}, 6) AS {c}' for c in ev.MEANS)} FROM ({METRICS_SQL})")
def downstream_rows(spark, sf_dir):
    return _metric_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", "detected", *[F.round(c, 6).alias(c) for c in ev.MEANS])


@query(
    "downstream_summary",
    f"WITH m AS ({METRICS_SQL}) SELECT 'overall' AS section, '' AS value, {OUTPUTS_SQL} FROM m"
    + "".join(f" UNION ALL SELECT '{k}', {v} AS value, {OUTPUTS_SQL} FROM m GROUP BY {v}" for k, v in GROUPS_SQL.items()),
)
def downstream_summary(spark, sf_dir):
    groups = {
        "by_source": F.col("source"),
        "by_orientation": F.col("orientation"),
        "by_truth_area_bin": geo.area_bin(F.col("truth_area_fraction")),
        "by_border_contact": F.when(F.col("border"), "touching").otherwise("interior"),
        "by_resolution_bin": geo.resolution_by_megapixels(F.col("w"), F.col("h")),
        "by_leaf_count": F.when(F.col("multi_leaf"), "multiple").otherwise("single"),
    }
    out = ev.grouped_summary(_metric_rows(spark, sf_dir), groups)
    nine = ("images_without_detection_rate", "fallback_rate")
    return out.withColumns({f.name: F.round(f.name, 9 if f.name in nine else 6) for f in out.schema.fields if f.dataType.simpleString() == "double"})


CASES_SQL = """
SELECT d.doc_id, d.source, d.lang, CASE WHEN l.quality = 0 THEN 'BAD' WHEN l.toxic = 1 THEN 'AMBIGUOUS' ELSE 'GOOD' END AS label, d.doc_id % 13 = 0 AS fallback, d.doc_id % 11 <> 0 AS complete, d.doc_id % 3 AS eligible,
    CASE WHEN d.doc_id % 5 <> 0 THEN (d.doc_id % 100) / 100.0::DOUBLE END AS margin, (d.n_chars % 1000)::DOUBLE / 1000 AS area, ((d.n_chars * 7) % 1000)::DOUBLE / 1000 AS bbox_ratio, ((d.n_chars * 3) % 120)::DOUBLE / 10 AS perimeter,
    CASE WHEN d.doc_id % 26 = 0 THEN 'no_detection' WHEN d.doc_id % 39 = 0 THEN 'low_segmentation_confidence' WHEN d.doc_id % 65 = 0 THEN 'invalid_mask' ELSE 'no_reliable_instance' END AS failure FROM documents d JOIN labels l USING (doc_id)
"""
ASSESS_SQL = f"""
SELECT *, CASE WHEN fallback THEN 'failed' WHEN eligible > 1 THEN 'uncertain' WHEN NOT complete OR eligible <> 1 THEN 'failed' ELSE 'reliable' END AS legacy,
    CASE WHEN fallback THEN [failure] WHEN NOT complete OR eligible < 1 THEN ['incomplete_segmentation_evidence'] WHEN eligible > 1 AND coalesce(margin < 0.33, true) THEN ['ambiguous_instance_score_margin']
        ELSE list_filter([CASE WHEN area >= 0.9 THEN 'excessive_mask_area_ratio' END, CASE WHEN area >= 0.25 AND bbox_ratio < 0.8 AND perimeter > 8 THEN 'suspicious_large_mask_geometry' END], lambda x: x IS NOT NULL) END AS reasons FROM ({CASES_SQL})
"""
STATUS_SQL = f"SELECT *, CASE WHEN fallback OR NOT complete OR eligible < 1 THEN 'failed' WHEN len(reasons) > 0 THEN 'uncertain' ELSE 'reliable' END AS status FROM ({ASSESS_SQL})"
GATE = {"max_area": 0.9, "large_area": 0.25, "min_bbox_ratio": 0.8, "max_perimeter": 8.0, "min_margin": 0.33}


def _cases(spark, sf_dir):
    i, n = F.col("doc_id"), F.col("n_chars")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    # one trace a case shows how each failure is named
    trace = lambda reason: F.array(F.struct(F.lit(False).alias("eligible"), F.lit(reason).alias("reason")))
    traces = F.when(i % 39 == 0, trace("confidence_below_threshold 0.2")).when(i % 65 == 0, trace("mask_too_small")).otherwise(trace("touches_border"))
    return docs.select(
        "doc_id",
        "source",
        "lang",
        F.when(F.col("quality") == 0, "BAD").when(F.col("toxic") == 1, "AMBIGUOUS").otherwise("GOOD").alias("label"),
        (i % 13 == 0).alias("fallback"),
        (i % 11 != 0).alias("complete"),
        (i % 3).alias("eligible"),
        F.when(i % 5 != 0, (i % 100) / 100.0).alias("margin"),
        ((n % 1000).cast("double") / 1000).alias("area"),
        ((n * 7 % 1000).cast("double") / 1000).alias("bbox_ratio"),
        ((n * 3 % 120).cast("double") / 10).alias("perimeter"),
        labels.failure_reason(F.when(i % 26 == 0, 0).otherwise(1), traces).alias("failure"),
    )


def _assessed(spark, sf_dir):
    rows = _cases(spark, sf_dir)
    r = {c: F.col(c) for c in rows.columns}
    gate = {k: F.lit(v) for k, v in GATE.items()}
    return rows.withColumns({"old": labels.legacy_status(r), "new": labels.assess(r, gate, reject_multiple=False)})


@query("quality_assessment", f"SELECT doc_id, legacy, status, reasons[1] AS reason, reasons FROM ({STATUS_SQL})")
def quality_assessment(spark, sf_dir):
    return _assessed(spark, sf_dir).select("doc_id", F.col("old.status").alias("legacy"), "new.status", "new.reason", "new.reasons")


_CONFUSION = "count(*) AS {p}_n, count(*) FILTER (WHERE {s} = 'reliable') AS {p}_reliable, count(*) FILTER (WHERE {s} = 'uncertain') AS {p}_uncertain, count(*) FILTER (WHERE {s} = 'failed') AS {p}_failed, count(*) FILTER (WHERE {s} = 'reliable' AND label = 'GOOD') AS {p}_good, count(*) FILTER (WHERE {s} = 'reliable' AND label <> 'GOOD') AS {p}_false, count(*) FILTER (WHERE {s} <> 'reliable' AND label = 'GOOD') AS {p}_rejected, count(*) FILTER (WHERE {s} = 'reliable' AND label = 'GOOD') / nullif(count(*) FILTER (WHERE {s} = 'reliable'), 0) AS {p}_precision, count(*) FILTER (WHERE {s} = 'reliable') / count(*) AS {p}_coverage"


@query(
    "gate_comparison",
    f"""
    SELECT * REPLACE (round(old_precision, 9) AS old_precision, round(new_precision, 9) AS new_precision, round(old_coverage, 9) AS old_coverage, round(new_coverage, 9) AS new_coverage),
        round(new_precision - old_precision, 9) AS delta_precision, round(new_coverage - old_coverage, 9) AS delta_coverage, new_false - old_false AS delta_false, new_rejected - old_rejected AS delta_rejected
    FROM (SELECT tag AS subgroup, {_CONFUSION.format(p='old', s='legacy')}, {_CONFUSION.format(p='new', s='status')} FROM (SELECT *, unnest(list_filter(['all', 'source:' || source, CASE WHEN eligible > 1 THEN 'multi_leaf' END, CASE WHEN area < 0.05 THEN 'small_leaf' END], lambda x: x IS NOT NULL)) AS tag FROM ({STATUS_SQL})) GROUP BY tag)
    """,
)
def gate_comparison(spark, sf_dir):
    rows = _assessed(spark, sf_dir).withColumns({"before": F.col("old.status"), "after": F.col("new.status")})
    tags = F.array_compact(F.array(F.lit("all"), F.concat(F.lit("source:"), "source"), F.when(F.col("eligible") > 1, "multi_leaf"), F.when(F.col("area") < 0.05, "small_leaf")))
    out = ev.compare_gates(rows, tags, "before", "after", "label")
    return out.withColumns({f.name: F.round(f.name, 9) for f in out.schema.fields if f.dataType.simpleString() == "double"})


@query("gate_wrong_ids", f"SELECT CASE WHEN status = 'reliable' THEN 'false_reliable' ELSE 'good_rejected' END AS kind, doc_id FROM ({STATUS_SQL}) WHERE (status = 'reliable') <> (label = 'GOOD')")
def gate_wrong_ids(spark, sf_dir):
    return ev.wrong_ids(_assessed(spark, sf_dir).withColumn("status", F.col("new.status")), "doc_id", "status", "label")


_CANDIDATES = """
SELECT threshold AS selection_threshold, round(avg(CASE WHEN score >= threshold THEN score ELSE 0.2 END), 6) AS mean_leaf_pixel_recall, round(avg(abs(score - threshold)), 6) AS mean_dice, round(avg(CASE WHEN score >= threshold THEN 1 ELSE 0 END), 6) AS mean_leaf_pixel_precision,
    round(count(*) FILTER (WHERE score < threshold) / count(*), 6) AS fallback_rate FROM (SELECT (length(text) % 100) / 100.0::DOUBLE AS score FROM conversations) CROSS JOIN (SELECT unnest(range(20, 51, 5)) / 100.0::DOUBLE AS threshold) GROUP BY threshold
"""


def _candidates(spark, sf_dir):
    """A row per threshold; scores are counted first (a hundred values), so that thresholds meet cells and not rows."""
    cells = table(spark, sf_dir, "conversations").groupBy(((F.length("text") % 100) / 100.0).alias("score")).agg(F.count("*").alias("w"))
    grid = F.broadcast(spark.range(7).select(((F.col("id") * 5 + 20) / 100.0).alias("threshold")))  # seven rows
    both, s, t, w = cells.join(grid), F.col("score"), F.col("threshold"), F.col("w")
    mean = lambda c: F.round(F.sum(c * w) / F.sum(w), 6)
    return both.groupBy(t.alias("selection_threshold")).agg(
        mean(F.when(s >= t, s).otherwise(0.2)).alias("mean_leaf_pixel_recall"),
        mean(F.abs(s - t)).alias("mean_dice"),
        mean(F.when(s >= t, 1).otherwise(0)).alias("mean_leaf_pixel_precision"),
        mean(F.when(s < t, 1).otherwise(0)).alias("fallback_rate"),
    )


@query(
    "threshold_selected",
    f"""WITH c AS ({_CANDIDATES}), v AS (SELECT *, mean_leaf_pixel_recall >= 0.45 AS viable FROM c)
    SELECT * EXCLUDE (viable) FROM v ORDER BY viable DESC, CASE WHEN viable THEN mean_dice ELSE mean_leaf_pixel_recall END DESC, CASE WHEN viable THEN mean_leaf_pixel_recall ELSE mean_dice END DESC,
        CASE WHEN viable THEN mean_leaf_pixel_precision ELSE 0 END DESC, fallback_rate, selection_threshold DESC LIMIT 1""",
)
def threshold_selected(spark, sf_dir):
    return ev.choose_threshold(_candidates(spark, sf_dir), 0.45)
