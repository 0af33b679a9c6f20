"""Masks: outlines are filled to bitmaps, and bitmaps measured, in Arrow batches.

A mask is a binary of ``size * size`` bits, row by row, the first bit of a byte
the highest.  The kernels see one mask at a time, so memory is bounded by one
batch, whatever the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOMETRY = (
    "area_pixels long, image_area_pixels long, mask_area_ratio double, left int, top int, right int, bottom int, bbox_area_pixels long, bbox_area_ratio double, mask_bbox_ratio double, "
    "bbox_width_ratio double, bbox_height_ratio double, bbox_aspect_ratio double, bbox_center_x_ratio double, bbox_center_y_ratio double, border_contact_count int, connected_components int, "
    "largest_component_ratio double, perimeter_edges long, perimeter_area_ratio double, normalized_perimeter double, centroid_x double, centroid_y double"
)


def fill(outlines: Sequence[Sequence[tuple[float, float]]], size: int) -> np.ndarray:
    """Pixels whose centre lies inside an outline (even-odd rule), or on its left or top edge; outlines are united."""
    out = np.zeros((size, size), bool)
    centre = np.arange(size)
    for points in outlines:
        if len(points) < 3:
            continue
        xy = np.asarray(points, np.float64) * (size - 1)
        x1, y1 = xy[:, 0], xy[:, 1]
        x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
        crossed = (y1 <= centre[:, None]) != (y2 <= centre[:, None])  # [rows, edges]
        with np.errstate(divide="ignore", invalid="ignore"):
            at = x1 + (centre[:, None] - y1) * (x2 - x1) / (y2 - y1)
        at = np.where(crossed, at, np.inf)
        first = np.clip(np.ceil(at), 0, size)  # the first pixel that is not left of the crossing
        row, edge = np.nonzero(crossed)
        flips = np.zeros((size, size + 1), np.int32)
        np.add.at(flips, (row, first[row, edge].astype(np.int64)), 1)
        out |= (np.cumsum(flips[:, :size], axis=1) % 2).astype(bool)
    return out


def components(mask: np.ndarray) -> np.ndarray:
    """Areas of the 4-connected parts, largest first: runs of rows are tied where they overlap."""
    flat = np.pad(mask, ((0, 0), (1, 1))).astype(np.int8)
    step = np.diff(flat, axis=1)
    rows, starts = np.nonzero(step == 1)
    ends = np.nonzero(step == -1)[1]
    if not len(rows):
        return np.zeros(0, np.int64)
    width = mask.shape[1] + 2
    begin, stop = rows * width + starts, rows * width + ends
    low = np.searchsorted(stop, begin + width, "right")  # in the row below: the first run that ends behind this one's start
    high = np.searchsorted(begin, stop + width, "left")
    many = np.maximum(0, high - low)
    a = np.repeat(np.arange(len(rows)), many)
    b = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    root = np.arange(len(rows))
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            break
    areas = np.bincount(root, ends - starts, len(rows)).astype(np.int64)
    return np.sort(areas[areas > 0])[::-1]


def geometry(mask: np.ndarray) -> tuple | None:
    """The measures of ``GEOMETRY``; none of an empty mask."""
    height, width = mask.shape
    area = int(mask.sum())
    if not area:
        return None
    ys, xs = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    left, top, right, bottom = int(xs[0]), int(ys[0]), int(xs[-1]) + 1, int(ys[-1]) + 1
    box = (right - left) * (bottom - top)
    edge = np.pad(mask, 1)
    perimeter = int((edge[1:] != edge[:-1]).sum() + (edge[:, 1:] != edge[:, :-1]).sum())
    parts = components(mask)
    contacts = int(mask[0].any()) + int(mask[-1].any()) + int(mask[:, 0].any()) + int(mask[:, -1].any())
    y, x = np.nonzero(mask)
    return (
        area,
        width * height,
        area / (width * height),
        left,
        top,
        right,
        bottom,
        box,
        box / (width * height),
        area / box,
        (right - left) / width,
        (bottom - top) / height,
        (right - left) / (bottom - top),
        (left + right) / 2 / width,
        (top + bottom) / 2 / height,
        contacts,
        len(parts),
        int(parts[0]) / area,
        perimeter,
        perimeter / area,
        perimeter / area**0.5,
        float(x.mean()),
        float(y.mean()),
    )


def _unpack(data: bytes, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=size * size).reshape(size, size).astype(bool)


def rasterised(rows: DataFrame, key: str, outlines: str, size: int = 256) -> DataFrame:
    """``key, mask`` of arrays of outlines (arrays of x, y in [0, 1]); no outline gives an empty mask, null one too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks = [np.packbits(fill([[(p["x"], p["y"]) for p in o] for o in polygons or []], size)).tobytes() for polygons in b.column("o").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(masks, pa.binary())], ["k", "mask"])

    kind = rows.schema[key].dataType.simpleString()
    found = rows.select(F.col(key).alias("k"), F.col(outlines).cast("array<array<struct<x:double,y:double>>>").alias("o")).mapInArrow(run, f"k {kind}, mask binary")
    return found.withColumnRenamed("k", key)


def measured(masks: DataFrame, key: str, size: int = 256) -> DataFrame:
    """``key`` and the measures of ``GEOMETRY``, null for an empty mask."""
    names = [f.split()[0] for f in GEOMETRY.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[f.split()[1]] for f in GEOMETRY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [geometry(_unpack(m.as_py(), size)) or (None,) * len(names) for m in b.column("mask")]
            columns = [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("k"), *columns], ["k", *names])

    kind = masks.schema[key].dataType.simpleString()
    return masks.select(F.col(key).alias("k"), "mask").mapInArrow(run, f"k {kind}, {GEOMETRY}").withColumnRenamed("k", key)


def overlap(a: Column, b: Column) -> Column:
    """``truth, predicted, shared``: set bits of two masks and of both, eight bytes at a time."""
    words = lambda m: F.transform(F.sequence(F.lit(0), F.floor((F.length(m) - 1) / 7).cast("int")), lambda i: F.conv(F.hex(F.substr(m, i * 7 + 1, F.lit(7))), 16, 10).cast("long"))
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda t, v: t + F.bit_count(v))
    both = F.zip_with(words(a), words(b), lambda x, y: x.bitwiseAND(y))
    return F.struct(total(words(a)).alias("truth"), total(words(b)).alias("predicted"), total(both).alias("shared"))


def geometry_rejection(share: Column, near_full: float = 0.98) -> Column:
    """Why a mask cannot be a leaf: nothing, or the whole image; ``near_full`` only warns."""
    return F.when(share <= 0, "degenerate_mask").when(F.abs(share - 1) <= 1e-9, "degenerate_mask").when(share >= near_full, "near_full_warning")
