"""Queries over label lines, outlines and boxes made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from curata.functions import boxes, labels, strings
from curata.functions import geometry as geo
from curata.plans.registry import query, table

#: Lines of sixteen coordinates; five in six are broken, each in its own way.
LINES_SQL = """
SELECT vec_id, concat_ws(' ', CASE WHEN vec_id % 11 = 10 THEN 'x1' ELSE '0' END, list_aggregate(list_transform(embedding[1:16], lambda v: printf('%.6f', abs(v::DOUBLE))), 'string_agg', ' '),
    CASE vec_id % 6 WHEN 1 THEN 'abc 0.5' WHEN 2 THEN '1.5 0.5 0.25.75 0.5' WHEN 3 THEN 'nan 0.1 -inf 0.2' WHEN 4 THEN '0.5' WHEN 5 THEN printf('%.6f', abs(embedding[1]::DOUBLE)) || ' ' || printf('%.6f', abs(embedding[2]::DOUBLE)) END) AS whole
FROM embeddings
"""
CUT_SQL = f"""
SELECT vec_id, list_filter(string_split_regex(CASE WHEN vec_id % 13 = 5 THEN '  ' WHEN vec_id % 13 = 6 THEN array_to_string(list_slice(string_split(whole, ' '), 1, 5), ' ')
    WHEN vec_id % 13 = 7 THEN array_to_string(list_slice(string_split(whole, ' '), 1, 6), ' ') ELSE whole END, '\\s+'), lambda t: t <> '') AS tok FROM ({LINES_SQL})
"""
NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
PARSED_SQL = f"""
c AS ({CUT_SQL}), n AS (SELECT *, len(tok) AS n FROM c),
f AS (SELECT vec_id, unnest(range(2, n + 1)) AS field, unnest(tok[2:]) AS t, n FROM n WHERE n > 1),
v AS (SELECT *, CASE WHEN regexp_full_match(t, '{NUMBER}') THEN t::DOUBLE WHEN regexp_full_match(t, '(?i)[+-]?(nan|inf|infinity)') THEN t::DOUBLE END AS x FROM f),
p AS (SELECT a.vec_id, (a.field // 2) AS k, a.x AS x, b.x AS y FROM v a JOIN v b ON a.vec_id = b.vec_id AND b.field = a.field + 1 WHERE a.field % 2 = 0 AND a.x IS NOT NULL AND b.x IS NOT NULL AND a.n <> 5),
q AS (SELECT vec_id, x, y, row_number() OVER w AS i, count(*) OVER (PARTITION BY vec_id) AS m, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
    FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY k)),
s AS (SELECT vec_id, any_value(m) AS m, count(DISTINCT (x, y)) AS distinct_points, bool_or(x = x2 AND y = y2) AS zero_edge, abs(sum(x * y2 - x2 * y)) / 2 AS area FROM q GROUP BY vec_id),
e AS (SELECT DISTINCT a.vec_id FROM q a JOIN q b ON a.vec_id = b.vec_id AND b.i >= a.i + 2 AND NOT (a.i = 1 AND b.i = b.m) WHERE a.m >= 4
    AND (((a.x2 - a.x) * (b.y - a.y) - (a.y2 - a.y) * (b.x - a.x) > 1e-12 AND (a.x2 - a.x) * (b.y2 - a.y) - (a.y2 - a.y) * (b.x2 - a.x) < -1e-12)
        OR ((a.x2 - a.x) * (b.y - a.y) - (a.y2 - a.y) * (b.x - a.x) < -1e-12 AND (a.x2 - a.x) * (b.y2 - a.y) - (a.y2 - a.y) * (b.x2 - a.x) > 1e-12))
    AND (((b.x2 - b.x) * (a.y - b.y) - (b.y2 - b.y) * (a.x - b.x) > 1e-12 AND (b.x2 - b.x) * (a.y2 - b.y) - (b.y2 - b.y) * (a.x2 - b.x) < -1e-12)
        OR ((b.x2 - b.x) * (a.y - b.y) - (b.y2 - b.y) * (a.x - b.x) < -1e-12 AND (b.x2 - b.x) * (a.y2 - b.y) - (b.y2 - b.y) * (a.x2 - b.x) > 1e-12))),
t AS (SELECT n.vec_id, n.n, coalesce(s.m, 0) AS m, coalesce(s.distinct_points, 0) AS d, coalesce(s.zero_edge, false) AS z, coalesce(s.area, 0) AS area, e.vec_id IS NOT NULL AS crossing
    FROM n LEFT JOIN s USING (vec_id) LEFT JOIN e USING (vec_id)),
issues AS (
    SELECT vec_id, 'empty_line' AS issue, NULL::INTEGER AS field, NULL::VARCHAR AS token FROM n WHERE n = 0
    UNION ALL SELECT vec_id, 'invalid_class_id', 1, tok[1] FROM n WHERE n > 0 AND NOT regexp_full_match(tok[1], '[+-]?[0-9]+')
    UNION ALL SELECT vec_id, 'bbox_format_in_segmentation_label', NULL, NULL FROM n WHERE n = 5
    UNION ALL SELECT vec_id, 'fewer_than_three_points', NULL, NULL FROM n WHERE n <> 5 AND n < 7 AND n > 0
    UNION ALL SELECT vec_id, 'incomplete_coordinate_pair', NULL, NULL FROM n WHERE n <> 5 AND n > 0 AND n % 2 = 0
    UNION ALL SELECT vec_id, CASE WHEN x IS NULL AND len(t) - len(replace(t, '.', '')) > 1 THEN 'concatenated_numeric_token' WHEN x IS NULL THEN 'non_numeric_token'
        WHEN isnan(x) OR isinf(x) THEN 'non_finite_coordinate' ELSE 'coordinate_out_of_range' END, field, t FROM v WHERE x IS NULL OR isnan(x) OR isinf(x) OR x < 0 OR x > 1
    UNION ALL SELECT vec_id, 'insufficient_unique_vertices', NULL, NULL FROM t WHERE n > 0 AND n <> 5 AND (m < 3 OR d < 3)
    UNION ALL SELECT vec_id, 'self_intersection', NULL, NULL FROM t WHERE n <> 5 AND m >= 3 AND crossing
    UNION ALL SELECT vec_id, 'repeated_vertex', NULL, NULL FROM t WHERE n <> 5 AND m >= 3 AND d < m
    UNION ALL SELECT vec_id, 'zero_length_edge', NULL, NULL FROM t WHERE n <> 5 AND m >= 3 AND z
    UNION ALL SELECT vec_id, 'zero_or_near_zero_area', NULL, NULL FROM t WHERE n <> 5 AND m >= 3 AND area <= 1e-12
    UNION ALL SELECT vec_id, 'non_simple_polygon', NULL, NULL FROM t WHERE n <> 5 AND m >= 3 AND (crossing OR d < m OR z OR d < 3 OR area <= 1e-12))
"""


def _lines(spark, sf_dir):
    i = F.col("vec_id")
    text = lambda k: F.format_string("%.6f", F.abs(F.get("embedding", F.lit(k)).cast("double")))
    values = F.transform(F.slice("embedding", 1, 16), lambda v: F.format_string("%.6f", F.abs(v.cast("double"))))
    broken = F.when(i % 6 == 1, "abc 0.5").when(i % 6 == 2, "1.5 0.5 0.25.75 0.5").when(i % 6 == 3, "nan 0.1 -inf 0.2").when(i % 6 == 4, "0.5").when(i % 6 == 5, F.concat_ws(" ", text(0), text(1)))
    whole = F.concat_ws(" ", F.when(i % 11 == 10, "x1").otherwise("0"), F.array_join(values, " "), broken)
    part = lambda n: F.array_join(F.slice(F.split(whole, " "), 1, n), " ")
    line = F.when(i % 13 == 5, "  ").when(i % 13 == 6, part(5)).when(i % 13 == 7, part(6)).otherwise(whole)
    return table(spark, sf_dir, "embeddings").select("vec_id", line.alias("line"))


@query("label_line_issues", f"WITH {PARSED_SQL} SELECT vec_id, issue, field, token FROM issues")
def label_line_issues(spark, sf_dir):
    """Every issue of every line, with the field and token that it concerns."""
    parsed = _lines(spark, sf_dir).select("vec_id", labels.parse_polygon_line(F.col("line")).alias("p"))
    return parsed.select("vec_id", F.inline("p.issues"))


@query(
    "polygon_topology",
    f"""WITH {PARSED_SQL}, k AS (SELECT vec_id, count(*) AS issues, count(*) FILTER (WHERE issue = 'self_intersection') AS crossings FROM issues GROUP BY vec_id)
    SELECT t.vec_id, t.m::INTEGER AS points, coalesce(k.issues, 0) AS issues, coalesce(k.issues, 0) = 0 AS valid, coalesce(k.crossings, 0) AS crossings FROM t LEFT JOIN k USING (vec_id)""",
)
def polygon_topology(spark, sf_dir):
    parsed = _lines(spark, sf_dir).select("vec_id", labels.parse_polygon_line(F.col("line")).alias("p"))
    crossed = F.array_contains(labels.topology_subset(F.col("p.issues")), "self_intersection")
    return parsed.select("vec_id", F.size("p.points").alias("points"), F.size("p.issues").cast("long").alias("issues"), "p.valid", crossed.cast("long").alias("crossings"))


_FIVE = "concat_ws(' ', (l_linenumber - 2)::VARCHAR, printf('%.4f', l_discount::DOUBLE * 12), printf('%.4f', l_tax::DOUBLE * 10), printf('%.4f', l_quantity::DOUBLE / 50), printf('%.4f', (l_partkey % 100) / 90.0::DOUBLE))"


def _five():
    n = lambda c: F.format_string("%.4f", c)
    parts = [n(F.col("l_discount").cast("double") * 12), n(F.col("l_tax").cast("double") * 10), n(F.col("l_quantity").cast("double") / 50), n((F.col("l_partkey") % 100) / 90.0)]
    return F.concat_ws(" ", (F.col("l_linenumber") - 2).cast("string"), *parts)


@query(
    "annotation_kinds",
    f"""
    WITH f AS (SELECT string_split({_FIVE}, ' ') AS t FROM lineitem), v AS (SELECT t[1]::BIGINT AS class_id, t[2]::DOUBLE AS cx, t[3]::DOUBLE AS cy, t[4]::DOUBLE AS w, t[5]::DOUBLE AS h FROM f),
    e AS (SELECT *, concat_ws(';', CASE WHEN cx NOT BETWEEN 0 AND 1 THEN 'center_x' END, CASE WHEN cy NOT BETWEEN 0 AND 1 THEN 'center_y' END, CASE WHEN w <= 0 OR w > 1 THEN 'width' END, CASE WHEN h <= 0 OR h > 1 THEN 'height' END) AS errors FROM v)
    SELECT CASE WHEN class_id >= 0 AND errors = '' THEN 'bbox' ELSE 'invalid' END AS kind,
        CASE WHEN class_id < 0 THEN 'class_negative' WHEN errors <> '' THEN errors WHEN cx - w / 2 < 0 OR cy - h / 2 < 0 OR cx + w / 2 > 1 OR cy + h / 2 > 1 THEN 'crosses_border' END AS message, count(*) AS n
    FROM e GROUP BY ALL
    """,
)
def annotation_kinds(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(labels.classify_line(_five()).alias("a"))
    return rows.groupBy("a.kind", "a.message").agg(F.count("*").alias("n"))


_BOX = """SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE * 7.3 - 40 AS x1, l_discount::DOUBLE * 2000 - 20.5 AS y1, l_quantity::DOUBLE * 7.3 - 40 + (l_partkey % 300) - 20.25 AS x2,
    l_discount::DOUBLE * 2000 - 20.5 + (l_suppkey % 90) AS y2, 300 AS iw, 200 AS ih FROM lineitem"""
_CLIPPED = f"""SELECT *, least(greatest(floor(x1), 0), iw)::INTEGER AS a1, least(greatest(floor(y1), 0), ih)::INTEGER AS b1, least(greatest(ceil(x2), 0), iw)::INTEGER AS a2, least(greatest(ceil(y2), 0), ih)::INTEGER AS b2 FROM ({_BOX})"""


def _boxes(spark, sf_dir):
    q, d = F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")
    x1, y1 = q * 7.3 - 40, d * 2000 - 20.5
    box = F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + F.col("l_partkey") % 300 - 20.25).alias("x2"), (y1 + F.col("l_suppkey") % 90).alias("y2"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b"), F.lit(300).alias("iw"), F.lit(200).alias("ih"))


@query(
    "box_validation",
    f"""
    SELECT l_orderkey, l_linenumber, r IS NULL AS detected, CASE WHEN r IS NULL OR r = 'too_small' THEN a1 END AS x1, CASE WHEN r IS NULL OR r = 'too_small' THEN b2 END AS y2,
        CASE WHEN r IS NULL OR r = 'too_small' THEN round(share, 9) END AS area_ratio, r AS reason,
        CASE WHEN r IS NULL THEN floor(x1) <> a1 OR floor(y1) <> b1 OR ceil(x2) <> a2 OR ceil(y2) <> b2 ELSE false END AS clipped FROM (
        SELECT *, (a2 - a1) * (b2 - b1) / (iw * ih)::DOUBLE AS share, CASE WHEN x2 <= x1 THEN 'x_inverted' WHEN y2 <= y1 THEN 'y_inverted' WHEN a2 <= a1 OR b2 <= b1 THEN 'outside_image'
            WHEN (a2 - a1) * (b2 - b1) / (iw * ih)::DOUBLE < 0.01 THEN 'too_small' END AS r FROM ({_CLIPPED}))
    """,
)
def box_validation(spark, sf_dir):
    b, iw, ih = F.col("b"), F.col("iw"), F.col("ih")
    rows = _boxes(spark, sf_dir).select("l_orderkey", "l_linenumber", boxes.validate(b, iw, ih, 0.01).alias("v"), boxes.annotation_of(b, iw, ih, 0.01).alias("a"))
    return rows.select("l_orderkey", "l_linenumber", "v.detected", "v.box.x1", "v.box.y2", F.round("v.area_ratio", 9).alias("area_ratio"), "v.reason", "a.clipped")


@query(
    "box_margins",
    f"""
    SELECT l_orderkey, l_linenumber, greatest(0, floor(a1 - (a2 - a1) * 0.15))::INTEGER AS x1, greatest(0, floor(b1 - (b2 - b1) * 0.15))::INTEGER AS y1,
        least(iw, ceil(a2 + (a2 - a1) * 0.15))::INTEGER AS x2, least(ih, ceil(b2 + (b2 - b1) * 0.15))::INTEGER AS y2,
        printf('0 %.8f %.8f %.8f %.8f', (a1 + a2) / 2.0::DOUBLE / iw, (b1 + b2) / 2.0::DOUBLE / ih, (a2 - a1) / iw::DOUBLE, (b2 - b1) / ih::DOUBLE) AS line
    FROM ({_CLIPPED}) WHERE x2 > x1 AND y2 > y1 AND a2 > a1 AND b2 > b1
    """,
)
def box_margins(spark, sf_dir):
    b, iw, ih = F.col("b"), F.col("iw"), F.col("ih")
    rows = _boxes(spark, sf_dir).where(F.coalesce(boxes.validate(b, iw, ih, 0.0)["detected"], F.lit(False)))
    return rows.select("l_orderkey", "l_linenumber", boxes.expand(b, iw, ih, 0.15).alias("e"), boxes.unit_of_pixels(boxes.clip(b, iw, ih), iw, ih).alias("line")).select("l_orderkey", "l_linenumber", "e.*", "line")


@query(
    "rotated_boxes",
    """
    WITH b AS (SELECT p_partkey, (p_partkey % 50)::DOUBLE AS x1, (p_partkey % 31)::DOUBLE AS y1, p_partkey % 50 + p_size::DOUBLE AS x2, p_partkey % 31 + (p_partkey % 7)::DOUBLE AS y2, radians((p_partkey * 17 % 360)::DOUBLE) AS a FROM part),
    c AS (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, abs((x2 - x1) / 2 * cos(a)) + abs((y2 - y1) / 2 * sin(a)) AS dx, abs((x2 - x1) / 2 * sin(a)) + abs((y2 - y1) / 2 * cos(a)) AS dy FROM b)
    SELECT p_partkey, CASE WHEN x2 > x1 AND y2 > y1 THEN round(cx - dx, 6) END AS x1, CASE WHEN x2 > x1 AND y2 > y1 THEN round(cy + dy, 6) END AS y2 FROM c
    """,
)
def rotated_boxes(spark, sf_dir):
    k = F.col("p_partkey")
    box = F.struct((k % 50).cast("double").alias("x1"), (k % 31).cast("double").alias("y1"), (k % 50 + F.col("p_size")).cast("double").alias("x2"), (k % 31 + k % 7).cast("double").alias("y2"))
    hull = boxes.hull_of_rotated(box, (k * 17 % 360).cast("double"))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(hull["x1"], 6).alias("x1"), F.round(hull["y2"], 6).alias("y2"))


@query(
    "letterbox_geometry",
    """
    WITH s AS (SELECT p_partkey, (50 + p_partkey * 13 % 900)::INTEGER AS w, (40 + p_partkey * 29 % 700)::INTEGER AS h FROM part), k AS (SELECT *, least(640.0::DOUBLE / w, 480.0::DOUBLE / h) AS scale FROM s),
    r AS (SELECT *, least(640, greatest(1, round_even(w * scale, 0)))::INTEGER AS rw, least(480, greatest(1, round_even(h * scale, 0)))::INTEGER AS rh, greatest(1, round_even(w * 0.7::DOUBLE, 0))::INTEGER AS cw FROM k)
    SELECT p_partkey, round(scale, 9) AS scale, rw AS width, rh AS height, (640 - rw) // 2 AS left, (480 - rh) // 2 AS top, 640 - rw - (640 - rw) // 2 AS right, 480 - rh - (480 - rh) // 2 AS bottom,
        (w - cw) // 2 AS crop_left, round(greatest(0, least(1, 1 - sqrt(power(p_partkey % w - (w - 1) / 2.0::DOUBLE, 2) + power(p_partkey % h - (h - 1) / 2.0::DOUBLE, 2)) / sqrt(power((w - 1) / 2.0::DOUBLE, 2) + power((h - 1) / 2.0::DOUBLE, 2)))), 9) AS proximity
    FROM r
    """,
)
def letterbox_geometry(spark, sf_dir):
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", (50 + k * 13 % 900).cast("int").alias("w"), (40 + k * 29 % 700).cast("int").alias("h"))
    w, h = F.col("w"), F.col("h")
    near = boxes.center_proximity((k % w).cast("double"), (k % h).cast("double"), w, h)
    rows = rows.select("p_partkey", boxes.letterbox(w, h, 640, 480).alias("l"), boxes.center_crop(w, h, 0.7)["x1"].alias("crop_left"), F.round(near, 9).alias("proximity"))
    return rows.select("p_partkey", F.round("l.scale", 9).alias("scale"), "l.width", "l.height", "l.left", "l.top", "l.right", "l.bottom", "crop_left", "proximity")


@query(
    "pixel_boxes",
    """
    WITH b AS (SELECT vec_id, abs(embedding[1]::DOUBLE) * 2 AS cx, abs(embedding[2]::DOUBLE) * 2 AS cy, abs(embedding[3]::DOUBLE) * 3 AS w, abs(embedding[4]::DOUBLE) * 3 AS h FROM embeddings)
    SELECT vec_id, least(greatest(round_even((cx - w / 2) * 640, 0), 0), 639)::INTEGER AS x1, least(greatest(round_even((cy - h / 2) * 480, 0), 0), 479)::INTEGER AS y1,
        least(greatest(round_even((cx + w / 2) * 640, 0), 0), 639)::INTEGER AS x2, least(greatest(round_even((cy + h / 2) * 480, 0), 0), 479)::INTEGER AS y2 FROM b
    WHERE cx <= 1 AND cy <= 1 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1
    """,
)
def pixel_boxes(spark, sf_dir):
    e = lambda k, m: F.abs(F.get("embedding", F.lit(k)).cast("double")) * m
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.struct(e(0, 2).alias("cx"), e(1, 2).alias("cy"), e(2, 3).alias("w"), e(3, 3).alias("h")).alias("b"))
    rows = rows.where(F.size(labels.box_errors(*[F.col(f"b.{k}") for k in ("cx", "cy", "w", "h")])) == 0)
    clamped = boxes.clamp(boxes.pixels_of_unit(F.col("b"), F.lit(640), F.lit(480)), F.lit(640), F.lit(480))
    return rows.select("vec_id", clamped.alias("p")).select("vec_id", "p.*")


_EXPORT = "'d/' || replace(p_name, ' ', '_') || CASE WHEN p_partkey % 3 = 0 THEN '_JPG.rf.' || p_partkey || 'ab.jpg' WHEN p_partkey % 3 = 1 THEN '.png' ELSE '_png.rf.x' END"


@query(
    "export_names",
    rf"""
    WITH p AS (SELECT p_partkey, p_brand, p_retailprice::DOUBLE / 7 AS price, {_EXPORT} AS path FROM part), s AS (SELECT *, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\.[^.]+$', '') AS stem FROM p),
    b AS (SELECT *, CASE WHEN regexp_matches(stem, '(?i)^.+?_(jpg|jpeg|png|bmp|tif|tiff|webp)\.rf\.[^.]+$') THEN regexp_extract(stem, '(?i)^(.+?)_(jpg|jpeg|png|bmp|tif|tiff|webp)\.rf\.[^.]+$', 1) ELSE stem END AS base FROM s)
    SELECT p_partkey, base, lower(trim(base)) AS key, 'rfv_' || left(sha256(p_brand || chr(0) || lower(base)), 16) AS variant, 'review_' || left(sha256(trim(p_brand) || '|' || base || '|' || p_partkey), 16) AS case_id,
        rtrim(rtrim(printf('%.12f', price), '0'), '.') AS coordinate, regexp_replace(lower(replace(path, 'd/', '')), '\.[^./]+$', '') AS relative FROM b
    """,
)
def export_names(spark, sf_dir):
    k = F.col("p_partkey")
    tail = F.when(k % 3 == 0, F.concat(F.lit("_JPG.rf."), k.cast("string"), F.lit("ab.jpg"))).when(k % 3 == 1, ".png").otherwise("_png.rf.x")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", (F.col("p_retailprice").cast("double") / 7).alias("price"), F.concat(F.lit("d/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), tail).alias("path"))
    path, brand = F.col("path"), F.col("p_brand")
    base = strings.export_base(path)
    return rows.select(
        "p_partkey",
        base.alias("base"),
        strings.base_key(path).alias("key"),
        strings.variant_id(brand, path).alias("variant"),
        strings.case_id(brand, base, k).alias("case_id"),
        strings.coordinate(F.col("price")).alias("coordinate"),
        strings.relative_key(path, "d").alias("relative"),
    )


@query(
    "polygon_rows",
    """
    WITH p AS (SELECT vec_id, list_transform(range(0, 32), lambda i: {'x': round((embedding[2 * i + 1]::DOUBLE + 1) / 2, 9), 'y': round((embedding[2 * i + 2]::DOUBLE + 1) / 2, 9)}) AS p, 300 + vec_id % 400 AS w, 200 + vec_id % 300 AS h FROM embeddings),
    m AS (SELECT *, abs(list_sum(list_transform(range(1, 33), lambda i: p[i].x * p[i % 32 + 1].y - p[i % 32 + 1].x * p[i].y))) / 2 AS area, list_min(list_transform(p, lambda q: q.x)) AS x1, list_max(list_transform(p, lambda q: q.x)) AS x2,
        list_min(list_transform(p, lambda q: q.y)) AS y1, list_max(list_transform(p, lambda q: q.y)) AS y2 FROM p)
    SELECT vec_id, 32 AS point_count, round(area, 6) AS area_ratio, round(area * w * h, 2) AS area_pixels, x1, y1, x2, y2, round((x1 + x2) / 2, 9) AS center_x, round((y1 + y2) / 2, 9) AS center_y, round(x2 - x1, 9) AS width, round(y2 - y1, 9) AS height,
        CASE WHEN area < 0.05 THEN 'small' WHEN area > 0.5 THEN 'large' ELSE 'medium' END AS size_category, x1 <= 1e-9 OR y1 <= 1e-9 OR x2 >= 1 - 1e-9 OR y2 >= 1 - 1e-9 AS touches_border FROM m
    """,
)
def polygon_rows(spark, sf_dir):
    at = lambda i: F.round((F.get("embedding", i).cast("double") + 1) / 2, 9)
    p = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(at(i * 2).alias("x"), at(i * 2 + 1).alias("y")))
    k = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", geo.polygon_statistics(p, 300 + k % 400, 200 + k % 300).alias("s")).select("vec_id", "s.*")
    places = {"area_ratio": 6, "area_pixels": 2, "center_x": 9, "center_y": 9, "width": 9, "height": 9}
    return rows.withColumns({c: F.round(c, n) for c, n in places.items()})


_YOLO = "SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS class_id, (l_partkey % 90) / 100.0::DOUBLE AS cx, (l_suppkey % 80) / 100.0::DOUBLE AS cy, 0.1::DOUBLE AS w, 0.2::DOUBLE AS h FROM lineitem"


@query(
    "unique_recovery",
    f"""
    WITH y AS ({_YOLO}), c AS (SELECT l_orderkey, l_linenumber AS annotation, class_id, (cx - w / 2) * 640 AS x, (cy - h / 2) * 480 AS t, w * 640 AS bw, h * 480 AS bh FROM y WHERE l_linenumber % 2 = 1 OR l_orderkey % 4 = 0),
    n AS (SELECT *, (x + bw / 2) / 640 AS cx, (t + bh / 2) / 480 AS cy, bw / 640 AS w, bh / 480 AS h FROM c),
    j AS (SELECT y.l_orderkey, y.l_linenumber, n.annotation, greatest(abs(y.cx - n.cx), abs(y.cy - n.cy), abs(y.w - n.w), abs(y.h - n.h)) AS e FROM y LEFT JOIN n ON n.l_orderkey = y.l_orderkey AND n.class_id = y.class_id
        AND greatest(abs(y.cx - n.cx), abs(y.cy - n.cy), abs(y.w - n.w), abs(y.h - n.h)) <= 1e-5)
    SELECT l_orderkey, l_linenumber, count(annotation) AS candidates, CASE WHEN count(annotation) = 1 THEN min(annotation) END AS annotation,
        CASE WHEN count(annotation) = 1 THEN 'recover_from_coco' ELSE 'manual_review' END AS decision FROM j GROUP BY ALL
    """,
)
def unique_recovery(spark, sf_dir):
    """Boxes of one set against pixel boxes of another on the same image: a match counts only if it is the only one."""
    k = F.col
    base = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (k("l_linenumber") % 3).alias("class_id"),
        F.struct(((k("l_partkey") % 90) / 100.0).alias("cx"), ((k("l_suppkey") % 80) / 100.0).alias("cy"), F.lit(0.1).alias("w"), F.lit(0.2).alias("h")).alias("y"),
    )
    pixels = F.array((k("y.cx") - k("y.w") / 2) * 640, (k("y.cy") - k("y.h") / 2) * 480, k("y.w") * 640, k("y.h") * 480)
    other = base.where("l_linenumber % 2 = 1 or l_orderkey % 4 = 0").select("l_orderkey", k("l_linenumber").alias("annotation"), "class_id", geo.box_of_pixels(pixels, F.lit(640), F.lit(480)).alias("c"))
    near = base.join(other, ["l_orderkey", "class_id"]).where(geo.largest_difference(k("y"), k("c")) <= 1e-5)
    found = near.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("candidates"), F.min("annotation").alias("annotation"))
    rows = base.select("l_orderkey", "l_linenumber").distinct().join(found, ["l_orderkey", "l_linenumber"], "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))
    only = k("candidates") == 1
    return rows.select("l_orderkey", "l_linenumber", "candidates", F.when(only, k("annotation")).alias("annotation"), F.when(only, "recover_from_coco").otherwise("manual_review").alias("decision"))
