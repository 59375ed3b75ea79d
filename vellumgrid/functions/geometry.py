"""Scalar expressions over boxes (x0, y0, x1, y1; y grows down)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bbox(box: Column, polygon: Column) -> Column:
    """The box, else the envelope of a polygon of four points or more, else null."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    around = F.when(F.size(polygon) >= 4, F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")))
    return F.coalesce(box, around)


def overlap_x(x0: Column, x1: Column, r0: Column, r1: Column) -> Column:
    """The share of x0..x1 that lies in r0..r1."""
    return F.greatest(F.lit(0.0), F.least(x1, r1) - F.greatest(x0, r0)) / F.greatest(x1 - x0, F.lit(1.0))


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 if apart or without area."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    both = F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)
    union = area(a) + area(b) - both
    return F.when((both > 0) & (union > 0), both / union).otherwise(F.lit(0.0))


def scaled(extent: Column, size: float) -> Column:
    """Model space to pixels; 1 where the extent is missing or not positive."""
    return F.when(extent > 0, F.lit(size) / extent).otherwise(F.lit(1.0))


def font_size(height: Column, factor: float) -> Column:
    return F.when(height.isNotNull(), F.greatest(F.lit(6.0), F.least(height * factor, F.lit(72.0))))


def rgb(colour: Column) -> Column:
    part = lambda at: F.conv(F.substring(colour, at, 2), 16, 10).cast("int")
    return F.array(part(2), part(4), part(6))


def lookup(values: dict[str, str], key: Column, otherwise: Column) -> Column:
    """``values[key]``, case-sensitive."""
    held = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(held, key), otherwise)
