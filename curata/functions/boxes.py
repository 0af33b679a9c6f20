"""Pixel boxes as Column expressions: half-open structs ``x1, y1, x2, y2``.

``round`` in the sense of this module goes to the even neighbour at a half.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curata.functions.binding import let

SIDES = ("x1", "y1", "x2", "y2")


def _box(values: Sequence[Column], kind: str = "int") -> Column:
    return F.struct(*[v.cast(kind).alias(k) for v, k in zip(values, SIDES)])


def _finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))


def width(box: Column) -> Column:
    return box["x2"] - box["x1"]


def height(box: Column) -> Column:
    return box["y2"] - box["y1"]


def area(box: Column) -> Column:
    return width(box).cast("long") * height(box)


def area_ratio(box: Column, image_width: Column, image_height: Column) -> Column:
    return F.try_divide(area(box).cast("double"), image_width.cast("double") * image_height)


def outward(box: Column) -> Column:
    """Whole pixels that cover a real box."""
    return _box([F.floor(box["x1"]), F.floor(box["y1"]), F.ceil(box["x2"]), F.ceil(box["y2"])], "long")


def clip(box: Column, image_width: Column, image_height: Column) -> Column:
    """Whole pixels that cover a real box, inside the image; may be empty."""
    covered = (F.floor(box["x1"]), F.floor(box["y1"]), F.ceil(box["x2"]), F.ceil(box["y2"]))
    sides = (image_width, image_height, image_width, image_height)
    return _box([F.least(F.greatest(c, F.lit(0)), s) for c, s in zip(covered, sides)])


def needs_clipping(box: Column, image_width: Column, image_height: Column) -> Column:
    return outward(box) != clip(box, image_width, image_height).cast("struct<x1:bigint,y1:bigint,x2:bigint,y2:bigint>")


def validate(box: Column, image_width: Column, image_height: Column, min_area_ratio: float, confidence: Column | None = None) -> Column:
    """``detected, box, area_ratio, reason``: the first rule that fails; too small a box is given with its ratio."""
    confidence = F.lit(1.0) if confidence is None else confidence
    finite = _finite(box["x1"]) & _finite(box["y1"]) & _finite(box["x2"]) & _finite(box["y2"])
    early = (
        F.when(~_finite(confidence), "confidence_not_finite")
        .when(~confidence.between(0, 1), "confidence_out_of_range")
        .when(~F.coalesce((image_width > 0) & (image_height > 0), F.lit(False)), "image_size")
        .when(~finite, "not_finite")
        .when(box["x2"] <= box["x1"], "x_inverted")
        .when(box["y2"] <= box["y1"], "y_inverted")
    )

    def judged(c: Column) -> Column:
        share = area_ratio(c, image_width, image_height)
        reason = early.when((c["x2"] <= c["x1"]) | (c["y2"] <= c["y1"]), "outside_image").when(share < min_area_ratio, "too_small")
        known = lambda r: r.isNull() | (r == "too_small")
        return let(reason, lambda r: F.struct(r.isNull().alias("detected"), F.when(known(r), c).alias("box"), F.when(known(r), share).alias("area_ratio"), r.alias("reason")))

    return let(F.when(finite, clip(box, image_width, image_height)), judged)


def expand(box: Column, image_width: Column, image_height: Column, margin: float) -> Column:
    """A clipped box with a margin of its own width and height on every side, inside the image."""

    def wider(c: Column) -> Column:
        dx, dy = width(c) * margin, height(c) * margin
        sides = [F.greatest(F.lit(0), F.floor(c["x1"] - dx)), F.greatest(F.lit(0), F.floor(c["y1"] - dy)), F.least(image_width, F.ceil(c["x2"] + dx)), F.least(image_height, F.ceil(c["y2"] + dy))]
        return _box(sides)

    return let(clip(box, image_width, image_height), wider)


def hull_of_rotated(box: Column, degrees: Column) -> Column:
    """Smallest upright box around one that is turned clockwise about its centre."""
    cx, cy = (box["x1"] + box["x2"]) / 2, (box["y1"] + box["y2"]) / 2
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    xs, ys = [], []
    for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2")):
        dx, dy = box[x] - cx, box[y] - cy
        xs.append(cx + dx * c - dy * s)
        ys.append(cy + dx * s + dy * c)
    hull = _box([F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)], "double")
    return F.when((box["x2"] > box["x1"]) & (box["y2"] > box["y1"]), hull)


def annotation_of(box: Column, image_width: Column, image_height: Column, min_area_ratio: float) -> Column:
    """``status, box, area_ratio, clipped, note`` of a box drawn by hand: annotated, or ambiguous with what is wrong."""

    def state(v: Column) -> Column:
        clipped = F.when(v["detected"], needs_clipping(box, image_width, image_height)).otherwise(False)
        return F.struct(
            F.when(v["detected"], "annotated").otherwise("ambiguous").alias("status"),
            F.when(v["detected"], v["box"]).alias("box"),
            F.when(v["detected"], v["area_ratio"]).alias("area_ratio"),
            clipped.alias("clipped"),
            F.when(~v["detected"], v["reason"]).when(clipped, "clipped_to_image").alias("note"),
        )

    return let(validate(box, image_width, image_height, min_area_ratio), state)


def pixels_of_unit(box: Column, image_width: Column, image_height: Column) -> Column:
    """Rounded pixel corners of a box given as centre, width and height in [0, 1]."""
    return _box([
        F.bround((box["cx"] - box["w"] / 2) * image_width),
        F.bround((box["cy"] - box["h"] / 2) * image_height),
        F.bround((box["cx"] + box["w"] / 2) * image_width),
        F.bround((box["cy"] + box["h"] / 2) * image_height),
    ])


def clamp(box: Column, image_width: Column, image_height: Column) -> Column:
    """Corners moved to valid pixel indices."""
    last = (image_width - 1, image_height - 1, image_width - 1, image_height - 1)
    return _box([F.least(F.greatest(box[k], F.lit(0)), m) for k, m in zip(SIDES, last)])


def real_pixels_of_unit(box: Column, image_width: Column, image_height: Column) -> Column:
    """Real pixel corners of a box given as centre, width and height in [0, 1]."""
    x, y, dx, dy = box["cx"] * image_width, box["cy"] * image_height, box["w"] * image_width / 2, box["h"] * image_height / 2
    return _box([x - dx, y - dy, x + dx, y + dy], "double")


def unit_of_pixels(box: Column, image_width: Column, image_height: Column) -> Column:
    """``0 cx cy w h`` with eight decimals."""
    parts = [
        (box["x1"] + box["x2"]) / 2.0 / image_width,
        (box["y1"] + box["y2"]) / 2.0 / image_height,
        (box["x2"] - box["x1"]) / image_width.cast("double"),
        (box["y2"] - box["y1"]) / image_height.cast("double"),
    ]
    return F.format_string("0 %.8f %.8f %.8f %.8f", *parts)


def center_crop(image_width: Column, image_height: Column, share: float) -> Column:
    """The middle part of an image."""
    w = F.greatest(F.lit(1), F.bround(image_width * F.lit(share)).cast("int"))
    h = F.greatest(F.lit(1), F.bround(image_height * F.lit(share)).cast("int"))
    left, top = F.floor((image_width - w) / 2), F.floor((image_height - h) / 2)
    return _box([left, top, left + w, top + h])


def letterbox(image_width: Column, image_height: Column, target_width: int, target_height: int) -> Column:
    """``scale, width, height, left, top, right, bottom``: size and padding of an image that is fitted into a canvas."""
    scale = F.least(F.lit(float(target_width)) / image_width, F.lit(float(target_height)) / image_height)
    w = F.least(F.lit(target_width), F.greatest(F.lit(1), F.bround(image_width * scale).cast("int")))
    h = F.least(F.lit(target_height), F.greatest(F.lit(1), F.bround(image_height * scale).cast("int")))
    left, top = F.floor((target_width - w) / 2).cast("int"), F.floor((target_height - h) / 2).cast("int")
    return F.struct(scale.alias("scale"), w.alias("width"), h.alias("height"), left.alias("left"), top.alias("top"), (target_width - w - left).alias("right"), (target_height - h - top).alias("bottom"))


def center_proximity(x: Column, y: Column, image_width: Column, image_height: Column) -> Column:
    """1 in the middle of an image, 0 in a corner; 0 without a point."""
    cx, cy = (image_width - 1) / 2.0, (image_height - 1) / 2.0
    far = F.hypot(x - cx, y - cy) / F.hypot(F.greatest(cx, F.lit(0.5)), F.greatest(cy, F.lit(0.5)))
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - far)), F.lit(0.0))


def crop_plan(box: Column, image_width: Column, image_height: Column, min_area_ratio: float, margin: float, target: tuple[int, int], otherwise: str = "center_crop", center_share: float = 0.8) -> Column:
    """``crop, fitted, fallback, note``: where an image is cut and how the piece is fitted into ``target`` (width, height).

    A valid box gets its margin.  Else, by ``otherwise``, the middle of the
    image is taken (``center_crop``), all of it (``full_image``) or nothing
    (``reject``), and the note says why.
    """
    if otherwise not in ("center_crop", "full_image", "reject"):
        raise ValueError(f"unknown fallback: {otherwise}")
    whole = _box([F.lit(0), F.lit(0), image_width, image_height])
    spare = {"center_crop": center_crop(image_width, image_height, center_share), "full_image": whole, "reject": F.lit(None).cast("struct<x1:int,y1:int,x2:int,y2:int>")}[otherwise]

    def planned(v: Column) -> Column:
        crop = F.when(v["detected"], expand(box, image_width, image_height, margin)).otherwise(spare)
        note = F.when(~v["detected"], v["reason"]).when(needs_clipping(box, image_width, image_height), "clipped_to_image")
        fitted = lambda c: F.when(c.isNotNull(), letterbox(width(c), height(c), *target))
        return let(crop, lambda c: F.struct(c.alias("crop"), fitted(c).alias("fitted"), (~v["detected"]).alias("fallback"), note.alias("note")))

    return let(validate(box, image_width, image_height, min_area_ratio), planned)
