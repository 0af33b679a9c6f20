"""Annotation lines and decisions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curata.functions.binding import let
from curata.functions.geometry import topology_issues
from curata.functions.strings import tokens

#: What is read as a number: digits may have single underscores between them, as in 1_000.
_DIGITS = "[0-9](?:_?[0-9])*"
_NUMBER = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
#: Without underscores; what it lets through beyond numbers, as 1.2.3, cannot be cast.
_PLAIN = r"^[+-]?[0-9.]+(?:[eE][+-]?[0-9]+)?$"
_NOT_FINITE = r"(?i)^[+-]?(?:nan|inf|infinity)$"
_JOINED = r"^[+-]?(?:[0-9]*\.[0-9]+){2,}$"
_ISSUE = "struct<issue:string,field:int,token:string>"


def number(token: Column) -> Column:
    """A token's value: null if it is no number, NaN for ``nan``, infinite for ``inf`` and for what is too large."""
    plain = F.when(token.rlike(_PLAIN), token.try_cast("double")).when(F.contains(token, F.lit("_")) & token.rlike(_NUMBER), F.regexp_replace(token, "_", "").try_cast("double"))
    sign = F.when(token.startswith("-"), -1.0).otherwise(1.0)
    return F.coalesce(plain, F.when(token.rlike(r"(?i)^[+-]?nan$"), float("nan")).when(token.rlike(_NOT_FINITE), sign * float("inf")))


def looks_joined(token: Column) -> Column:
    """Whether a token looks like numbers written without a blank between them."""
    dots = F.length(token) - F.length(F.replace(token, F.lit("."), F.lit("")))
    return token.rlike(_JOINED) | ((dots > 1) & token.rlike("[0-9]"))


def _one(condition: Column, name: str) -> Column:
    return F.when(condition, F.struct(F.lit(name).alias("issue"), F.lit(None).cast("int").alias("field"), F.lit(None).cast("string").alias("token")))


def parse_polygon_line(line: Column) -> Column:
    """``class_id, points, issues, valid, format`` of a line ``class x y x y ...`` with coordinates in [0, 1].

    Issues are structs of a name and, for a single field, its number (from 1)
    and token; they are in the order of the checks and none is folded into
    another.  Pairs with a field that is no number are left out of the points,
    and the topology of the rest is checked.  A line of five fields is a box:
    it has no points and is never valid here.
    """
    text = "array<string>"

    def of_fields(fields: Column) -> Column:
        n = F.size(fields)
        box, first = n == 5, F.get(fields, F.lit(0))
        coords = F.when(n > 1, F.slice(fields, F.lit(2), F.greatest(n - 1, F.lit(1)))).otherwise(F.array().cast(text))
        read = F.transform(coords, lambda t: F.struct(t.alias("t"), number(t).alias("v")))
        class_id = F.when(first.rlike(r"^[+-]?[0-9]+$"), first.try_cast("long"))
        whole = F.array_compact(
            F.array(
                F.when((n > 0) & class_id.isNull(), F.struct(F.lit("invalid_class_id").alias("issue"), F.lit(1).alias("field"), first.alias("token"))),
                _one(box, "bbox_format_in_segmentation_label"),
                _one(~box & (n < 7), "fewer_than_three_points"),
                _one(~box & (n % 2 == 0), "incomplete_coordinate_pair"),
            )
        )

        def of_values(values: Column) -> Column:
            half = F.floor(F.size(values) / 2).cast("int")
            pair = lambda i: F.struct(F.get(values, i * 2)["v"].alias("x"), F.get(values, i * 2 + 1)["v"].alias("y"))
            pairs = F.when(~box & (half > 0), F.transform(F.sequence(F.lit(0), F.greatest(half, F.lit(1)) - 1), pair)).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
            points = F.filter(pairs, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
            return let(points, lambda ps: of_points(values, ps))

        def of_field(f: Column, at: Column) -> Column:
            v, token = f["v"], f["t"]
            name = (
                F.when(v.isNull() & looks_joined(token), "concatenated_numeric_token")
                .when(v.isNull(), "non_numeric_token")
                .when(F.isnan(v) | (F.abs(v) == float("inf")), "non_finite_coordinate")
                .when((v < 0) | (v > 1), "coordinate_out_of_range")
            )
            return let(name, lambda k: F.when(k.isNotNull(), F.struct(k.alias("issue"), (at + 2).cast("int").alias("field"), token.alias("token"))))

        def of_points(values: Column, points: Column) -> Column:
            topology = F.when(box, F.array().cast(text)).when(F.size(points) < 3, F.array(F.lit("insufficient_unique_vertices"))).otherwise(topology_issues(points))
            shapes = F.transform(topology, lambda t: F.struct(t.alias("issue"), F.lit(None).cast("int").alias("field"), F.lit(None).cast("string").alias("token")))
            issues = F.when(n == 0, F.array(_one(F.lit(True), "empty_line"))).otherwise(F.concat(whole, F.array_compact(F.transform(values, of_field)), shapes)).cast(f"array<{_ISSUE}>")
            kind = F.when(n == 0, "empty").when(box, "yolo_bbox").otherwise("yolo_segmentation")
            return let(issues, lambda found: F.struct(class_id.alias("class_id"), points.alias("points"), found.alias("issues"), (F.size(found) == 0).alias("valid"), kind.alias("format")))

        return let(read, of_values)

    return let(tokens(line), of_fields)


#: The issues that concern a polygon's shape.
TOPOLOGY = ("self_intersection", "repeated_vertex", "zero_length_edge", "insufficient_unique_vertices", "zero_or_near_zero_area", "non_simple_polygon")


def topology_subset(issues: Column) -> Column:
    """Of parsed issues the names of those that concern the shape."""
    return F.array_intersect(F.transform(issues, lambda i: i["issue"]), F.array(*[F.lit(t) for t in TOPOLOGY]))


def box_errors(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """What is wrong with a box in [0, 1]; only that where a value is not finite."""
    finite = None
    for v in (cx, cy, w, h):
        one = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
        finite = one if finite is None else finite & one
    errors = F.array_compact(
        F.array(
            F.when(~cx.between(0, 1), "center_x"),
            F.when(~cy.between(0, 1), "center_y"),
            F.when(~((w > 0) & (w <= 1)), "width"),
            F.when(~((h > 0) & (h <= 1)), "height"),
        )
    )
    return F.when(~F.coalesce(finite, F.lit(False)), F.array(F.lit("not_finite"))).otherwise(errors)


def classify_line(line: Column) -> Column:
    """``kind`` (bbox, polygon or invalid), ``class_id``, ``box``, ``message`` of a line of a set of boxes."""

    def of_fields(fields: Column) -> Column:
        first = F.get(fields, F.lit(0))
        class_id = F.when(first.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(first, "_", "").try_cast("long"))
        numbers = F.transform(F.slice(fields, F.lit(2), F.greatest(F.size(fields), F.lit(1))), number)
        row = lambda values: F.struct(F.size(fields).alias("n"), class_id.alias("c"), values.alias("values"), box_errors(*[F.get(values, F.lit(k)) for k in range(4)]).alias("errors"))
        return let(let(numbers, row), judged)

    def judged(r: Column) -> Column:
        n, class_id, values, errors = r["n"], r["c"], r["values"], r["errors"]
        v = [F.get(values, F.lit(k)) for k in range(4)]
        all_finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        polygon = (n >= 7) & (n % 2 == 1) & F.coalesce(class_id >= 0, F.lit(False)) & all_finite
        message = (
            F.when(polygon, F.when(F.exists(values, lambda x: (x < 0) | (x > 1)), "polygon_out_of_range").otherwise("polygon"))
            .when(n != 5, F.concat(F.lit("fields="), n.cast("string")))
            .when(class_id.isNull(), "class_not_integer")
            .when(class_id < 0, "class_negative")
            .when(F.exists(values, lambda x: x.isNull()), "not_numeric")
            .when(F.size(errors) > 0, F.array_join(errors, ";"))
            .when((v[0] - v[2] / 2 < 0) | (v[1] - v[3] / 2 < 0) | (v[0] + v[2] / 2 > 1) | (v[1] + v[3] / 2 > 1), "crosses_border")
        )
        is_box = ~polygon & (n == 5) & F.coalesce(class_id >= 0, F.lit(False)) & all_finite & (F.size(errors) == 0)
        kind = F.when(polygon, "polygon").when(is_box, "bbox").otherwise("invalid")
        box = F.when(is_box, F.struct(*[x.alias(k) for x, k in zip(v, ("cx", "cy", "w", "h"))]))
        return F.struct(kind.alias("kind"), class_id.alias("class_id"), box.alias("box"), message.alias("message"))

    return let(tokens(line), of_fields)


def remap_class(line: Column, target: int = 0) -> Column:
    """A valid polygon line with another class; null for an invalid one."""
    coords = let(tokens(line), lambda fields: F.slice(fields, F.lit(2), F.greatest(F.size(fields), F.lit(1))))
    return F.when(parse_polygon_line(line)["valid"], F.concat_ws(" ", F.lit(str(target)), coords))


def finite(text: Column) -> Column:
    """A finite number written in a cell, else null."""
    return let(number(F.trim(text.cast("string"))), lambda v: F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v))


def ratio(text: Column) -> Column:
    """A finite number from 0 to 1, else null."""
    v = finite(text)
    return F.when(v.between(0, 1), v)


def strict_bool(text: Column) -> Column:
    """``true`` or ``false`` in any case, else null."""
    t = F.lower(F.trim(text))
    return F.when(t == "true", True).when(t == "false", False)


def decide(role: Column, known_class: Column, valid: Column, recoverable: Column) -> Column:
    """What becomes of one source annotation."""
    return (
        F.when(~known_class, "exclude_unknown_class")
        .when(role == "lesion", "exclude_lesion")
        .when(role != "full_leaf", "manual_review")
        .when(valid, "include_after_remap")
        .when(recoverable, "recover_from_coco")
        .otherwise("manual_review")
    )


def override_by_image(decision: Column, image_action: Column) -> Column:
    """An image that is a copy, or of the held-out set, takes along those of its annotations that would be kept."""
    return F.when((image_action != "keep") & decision.isin("include_after_remap", "recover_from_coco"), image_action).otherwise(decision)


def failure_reason(instances: Column, traces: Column) -> Column:
    """Why no instance could be selected, from the reasons of those that are not eligible."""
    reasons = F.transform(F.filter(traces, lambda t: ~t["eligible"]), lambda t: F.coalesce(t["reason"], F.lit("")))
    bad = F.array(*[F.lit(x) for x in INVALID_MASK])
    return (
        F.when(instances == 0, "no_detection")
        .when((F.size(reasons) > 0) & F.forall(reasons, lambda r: F.contains(r, F.lit(LOW_CONFIDENCE))), "low_segmentation_confidence")
        .when(F.exists(reasons, lambda r: F.exists(bad, lambda b: F.contains(r, b))), "invalid_mask")
        .otherwise("no_reliable_instance")
    )


#: Parts of the selector's reasons that tell kinds of failures apart.
LOW_CONFIDENCE = "confidence_below_threshold"
INVALID_MASK = ("corrupt_mask", "degenerate_mask", "mask_too_small")


def legacy_status(r: dict[str, Column], reject_multiple: bool = True) -> Column:
    """``status, reason`` of the gate without measures of the mask: evidence must be whole and the instance the only eligible one."""
    several = F.lit(reject_multiple) & (r["eligible"] > 1)
    incomplete = ~r["complete"] | (r["eligible"] != 1)
    status = F.when(r["fallback"], "failed").when(several, "uncertain").when(incomplete, "failed").otherwise("reliable")
    reason = F.when(r["fallback"], r["failure"]).when(several, "ambiguous_multiple_eligible_leaves").when(incomplete, "incomplete_segmentation_evidence")
    return F.struct(status.alias("status"), reason.alias("reason"))


def assess(r: dict[str, Column], gate: dict[str, Column], reject_multiple: bool = True) -> Column:
    """``status, reason, reasons`` by evidence and measures of the mask; ``reasons`` has all that the measures give."""
    incomplete = ~r["complete"] | (r["eligible"] < 1)
    several = r["eligible"] > 1
    close = F.coalesce(r["margin"] < gate["min_margin"], F.lit(True))
    shape = F.array_compact(
        F.array(
            F.when(r["area"] >= gate["max_area"], "excessive_mask_area_ratio"),
            F.when((r["area"] >= gate["large_area"]) & (r["bbox_ratio"] < gate["min_bbox_ratio"]) & (r["perimeter"] > gate["max_perimeter"]), "suspicious_large_mask_geometry"),
        )
    )
    early = F.when(r["fallback"], r["failure"]).when(incomplete, "incomplete_segmentation_evidence")
    early = early.when(several, "ambiguous_multiple_eligible_leaves") if reject_multiple else early.when(several & close, "ambiguous_instance_score_margin")
    reasons = let(early, lambda e: F.when(e.isNotNull(), F.array(e)).otherwise(shape))
    failed = r["fallback"] | incomplete
    status = lambda found: F.when(failed, "failed").when(F.size(found) > 0, "uncertain").otherwise("reliable")
    return let(reasons, lambda found: F.struct(status(found).alias("status"), F.get(found, F.lit(0)).alias("reason"), found.alias("reasons")))


def gate_status(r: dict[str, Column], gate: dict[str, Column], reject_multiple: bool = False) -> Column:
    """``failed``, ``uncertain`` or ``reliable`` of a mask by its persisted metrics; null comparisons do not reject."""
    failed = ~r["available"] | r["fallback"] | (r["eligible"] < 1)
    ambiguous = F.lit(True) if reject_multiple else F.coalesce(r["margin"] < gate["min_margin"], F.lit(True))
    large = (r["area"] >= gate["large_area"]) & (r["bbox_ratio"] < gate["min_bbox_ratio"]) & (r["perimeter"] > gate["max_perimeter"])
    return (
        F.when(failed, "failed")
        .when((r["eligible"] > 1) & ambiguous, "uncertain")
        .when(r["area"] >= gate["max_area"], "uncertain")
        .when(large, "uncertain")
        .otherwise("reliable")
    )
