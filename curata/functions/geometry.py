"""Column expressions over boxes and polygons; a polygon is an array of (x, y) structs in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curata.functions.binding import let


def polygon_area(points: Column) -> Column:
    """Shoelace area, wrapping from the last vertex to the first; 0 below three vertices."""
    n = F.size(points)

    def term(acc: Column, i: Column) -> Column:
        a, b = F.get(points, i), F.get(points, F.pmod(i + 1, n))
        return acc + a["x"] * b["y"] - b["x"] * a["y"]

    return F.when(n >= 3, F.abs(F.aggregate(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(0.0), term)) / 2).otherwise(0.0)


def bounds(points: Column) -> Column:
    """Axis-aligned hull of a polygon."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def touches(points: Column, eps: float = 1e-9) -> Column:
    """Which borders of the unit square a polygon reaches."""
    return F.struct(
        F.exists(points, lambda p: p["x"] <= eps).alias("left"),
        F.exists(points, lambda p: p["y"] <= eps).alias("top"),
        F.exists(points, lambda p: p["x"] >= 1 - eps).alias("right"),
        F.exists(points, lambda p: p["y"] >= 1 - eps).alias("bottom"),
    )


def cross_product(a: Column, b: Column, c: Column) -> Column:
    """Twice the signed area of the triangle a, b, c."""
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def segments_cross(a: Column, b: Column, c: Column, d: Column, eps: float = 1e-12) -> Column:
    """Whether ab and cd cross in a point inside both."""
    opposite = lambda p, q: ((p > eps) & (q < -eps)) | ((p < -eps) & (q > eps))
    return opposite(cross_product(a, b, c), cross_product(a, b, d)) & opposite(cross_product(c, d, a), cross_product(c, d, b))


def self_intersects(points: Column, eps: float = 1e-12) -> Column:
    """Whether two edges that share no vertex cross; every pair is looked at, so keep to outlines of some hundred vertices."""
    n = F.size(points)
    vertex = lambda i: F.get(points, F.pmod(i, n))
    last = F.greatest(n, F.lit(4)) - 1  # sequences must not run backwards where there are few vertices

    def crossed(i: Column) -> Column:
        later = F.filter(F.sequence(F.lit(0), last), lambda j: (j >= i + 2) & (F.pmod(j + 1, n) != i))
        return F.exists(later, lambda j: segments_cross(vertex(i), vertex(i + 1), vertex(j), vertex(j + 1), eps))

    return F.when(n >= 4, F.exists(F.sequence(F.lit(0), last), crossed)).otherwise(False)


def topology_issues(points: Column, eps: float = 1e-12) -> Column:
    """Names of what is wrong with a polygon, in a fixed order; the last one says that something is."""

    def look(p: Column) -> Column:
        n = F.size(p)
        distinct = F.size(F.array_distinct(p))
        steps = F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
        zero_edge = (n > 0) & F.exists(steps, lambda i: F.get(p, i) == F.get(p, F.pmod(i + 1, F.greatest(n, F.lit(1)))))
        return F.array_compact(
            F.array(
                F.when(self_intersects(p, eps), "self_intersection"),
                F.when(distinct < n, "repeated_vertex"),
                F.when(zero_edge, "zero_length_edge"),
                F.when(distinct < 3, "insufficient_unique_vertices"),
                F.when((n >= 3) & (polygon_area(p) <= eps), "zero_or_near_zero_area"),
            )
        )

    return let(let(points, look), lambda found: F.when(F.size(found) > 0, F.concat(found, F.array(F.lit("non_simple_polygon")))).otherwise(found))


def polygon_statistics(points: Column, width: Column, height: Column) -> Column:
    """One row of measures of a polygon on an image: hull, centre, areas, size class, borders."""

    def measures(m: Column) -> Column:
        box, area, edges = m["box"], m["area"], m["edges"]
        return F.struct(
            m["n"].alias("point_count"),
            area.alias("area_ratio"),
            (area * width * height).alias("area_pixels"),
            *[box[k].alias(k) for k in ("x1", "y1", "x2", "y2")],
            ((box["x1"] + box["x2"]) / 2).alias("center_x"),
            ((box["y1"] + box["y2"]) / 2).alias("center_y"),
            (box["x2"] - box["x1"]).alias("width"),
            (box["y2"] - box["y1"]).alias("height"),
            area_bin(area).alias("size_category"),
            (edges["left"] | edges["top"] | edges["right"] | edges["bottom"]).alias("touches_border"),
        )

    basic = lambda p: F.struct(F.size(p).alias("n"), bounds(p).alias("box"), polygon_area(p).alias("area"), touches(p).alias("edges"))
    return let(let(points, basic), measures)


def box_of_points(points: Column) -> Column:
    """Centre, width and height of a polygon's hull; null below three vertices."""
    hull = lambda box: F.struct(((box["x1"] + box["x2"]) / 2).alias("cx"), ((box["y1"] + box["y2"]) / 2).alias("cy"), (box["x2"] - box["x1"]).alias("w"), (box["y2"] - box["y1"]).alias("h"))
    return let(points, lambda p: F.when(F.size(p) >= 3, let(bounds(p), hull)))


def box_of_pixels(box: Column, width: Column, height: Column) -> Column:
    """Centre, width and height in [0, 1] of ``[left, top, width, height]`` in pixels; null for another shape, no image or no numbers."""
    v = [F.get(box, F.lit(k)).cast("double") for k in range(4)]
    values = F.struct(
        F.try_divide(v[0] + v[2] / 2, width).alias("cx"),
        F.try_divide(v[1] + v[3] / 2, height).alias("cy"),
        F.try_divide(v[2], width).alias("w"),
        F.try_divide(v[3], height).alias("h"),
    )

    def checked(b: Column) -> Column:
        usable = (F.size(box) == 4) & (width > 0) & (height > 0)
        for k in ("cx", "cy", "w", "h"):
            usable = usable & b[k].isNotNull() & ~F.isnan(b[k]) & (F.abs(b[k]) < float("inf"))
        return F.when(usable, b)

    return let(values, checked)


def largest_difference(a: Column, b: Column) -> Column:
    """The largest difference of centre, width or height of two boxes."""
    return F.greatest(*[F.abs(a[k] - b[k]) for k in ("cx", "cy", "w", "h")])


def points_of_component(component: Column, width: Column, height: Column) -> Column:
    """Vertices in [0, 1] of one flat pixel outline; null unless it is a simple polygon inside the image."""
    n = F.size(component)
    half = F.greatest(F.floor(n / 2), F.lit(1)).cast("int")
    at = lambda k, size: F.try_divide(F.get(component, k).cast("double"), size)
    points = F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.struct(at(i * 2, width).alias("x"), at(i * 2 + 1, height).alias("y")))
    within = lambda p: p["x"].between(0, 1) & p["y"].between(0, 1) & ~F.isnan(p["x"]) & ~F.isnan(p["y"])
    simple = lambda ps: F.when(F.coalesce(F.forall(ps, within), F.lit(False)) & (F.size(topology_issues(ps)) == 0), ps)
    return F.when((n >= 6) & (n % 2 == 0), let(points, simple))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes given as centre, width and height; 0 without a union."""
    w = F.greatest(F.lit(0.0), F.least(a["cx"] + a["w"] / 2, b["cx"] + b["w"] / 2) - F.greatest(a["cx"] - a["w"] / 2, b["cx"] - b["w"] / 2))
    h = F.greatest(F.lit(0.0), F.least(a["cy"] + a["h"] / 2, b["cy"] + b["h"] / 2) - F.greatest(a["cy"] - a["h"] / 2, b["cy"] - b["h"] / 2))
    inter = w * h
    union = a["w"] * a["h"] + b["w"] * b["h"] - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def clip_outward(box: Column, width: Column, height: Column) -> Column:
    """Pixel box that covers a real one, half-open, inside the image."""
    return F.struct(
        F.greatest(F.lit(0), F.floor(box["x1"])).cast("int").alias("x1"),
        F.greatest(F.lit(0), F.floor(box["y1"])).cast("int").alias("y1"),
        F.least(width, F.ceil(box["x2"])).cast("int").alias("x2"),
        F.least(height, F.ceil(box["y2"])).cast("int").alias("y2"),
    )


def area_bin(fraction: Column) -> Column:
    return F.when(fraction < 0.05, "small").when(fraction > 0.50, "large").otherwise("medium")


def orientation(width: Column, height: Column) -> Column:
    """Strict comparison of the sides."""
    return F.when(width > height, "horizontal").when(height > width, "vertical").otherwise("square")


def orientation_with_tolerance(width: Column, height: Column, ratio: float = 1.1) -> Column:
    """A side counts as longer only beyond ``ratio`` times the other."""
    return F.when(width > height * ratio, "horizontal").when(height > width * ratio, "vertical").otherwise("square")


def resolution_by_pixels(width: Column, height: Column) -> Column:
    pixels = width * height
    return F.when(pixels < 500_000, "small").when(pixels < 2_000_000, "medium").otherwise("large")


def resolution_by_megapixels(width: Column, height: Column) -> Column:
    mega = width * height / 1e6
    return F.when(mega <= 0.10, "low_<=0.10mp").when(mega <= 1.0, "medium_<=1.00mp").otherwise("high_>1.00mp")


def diversity_bins(width: Column, height: Column) -> Column:
    """``orientation, resolution, aspect`` by the ratio of the sides, as the detector's sample is spread over them."""
    ratio = width / height
    return F.struct(
        F.when(ratio < 0.9, "portrait").when(ratio > 1.1, "landscape").otherwise("square").alias("orientation"),
        resolution_by_pixels(width, height).alias("resolution"),
        F.when(ratio < 0.67, "narrow").when(ratio > 1.5, "wide").otherwise("moderate").alias("aspect"),
    )
