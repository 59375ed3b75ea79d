"""Image kernels over gray tiles: binary pixels with width and height, vectorised in numpy."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shipping import ship


def autocontrast(gray: np.ndarray, cutoff: float) -> np.ndarray:
    """Stretch what is left after cutting ``cutoff`` percent of the pixels off each end of the histogram to 0..255."""
    h = np.bincount(gray.ravel(), minlength=256)
    cut = int(gray.size * cutoff // 100)
    for side in (h, h[::-1]):
        before = np.concatenate([[0], np.cumsum(side)[:-1]])
        side -= np.clip(cut - before, 0, side)
    used = np.flatnonzero(h)
    if len(used) == 0 or used[0] == used[-1]:
        return gray.copy()
    lo, hi = int(used[0]), int(used[-1])
    scale = 255.0 / (hi - lo)
    table = np.clip((np.arange(256) * scale - lo * scale).astype(int), 0, 255).astype(np.uint8)
    return table[gray]


def tiled_autocontrast(gray: np.ndarray, tile: int = 256, step: int = 128, cutoff: float = 1.0) -> np.ndarray:
    """Each tile stretched on its own, from the original; where tiles overlap the last one stands."""
    out = gray.copy()
    for y in range(0, gray.shape[0], step):
        for x in range(0, gray.shape[1], step):
            out[y : y + tile, x : x + tile] = autocontrast(gray[y : y + tile, x : x + tile], cutoff)
    return out


def sharpen(gray: np.ndarray) -> np.ndarray:
    """3 by 3 sharpening: 32 times the pixel less twice each neighbour, over 16; the border stays."""
    out = gray.copy()
    g = gray.astype(np.int64)
    if min(g.shape) > 2:
        near = sum(g[1 + dy : g.shape[0] - 1 + dy, 1 + dx : g.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)) - g[1:-1, 1:-1]
        out[1:-1, 1:-1] = np.clip((32 * g[1:-1, 1:-1] - 2 * near + 8) // 16, 0, 255)
    return out


#: Bits after the point of a blur's weights.
POINT = 24


def box_weights(radius: float, passes: int = 3) -> tuple[int, int, int]:
    """(reach, inner weight, edge weight) of the box whose repeated average comes near a Gaussian of ``radius``.

    A box of odd width 2 * reach + 1 takes its share of each of two further pixels, so
    that its variance is the Gaussian's divided by ``passes``; weights are fixed-point.
    """
    variance = radius * radius / passes
    reach = int((math.sqrt(12 * variance + 1) - 1) / 2)
    share = (2 * reach + 1) * (reach * (reach + 1) - 3 * variance) / (6 * (variance - (reach + 1) ** 2))
    inner = int((1 << POINT) / (2 * (reach + share) + 1))
    return reach, inner, ((1 << POINT) - (2 * reach + 1) * inner) // 2


def blurred(gray: np.ndarray, radius: float = 1.5, passes: int = 3) -> np.ndarray:
    """A blur by repeated box averages, first along rows and then along columns, each rounded to whole grays; pixels beyond the edge repeat the edge."""
    reach, inner, edge = box_weights(radius, passes)
    out = gray.astype(np.int64)
    for axis in (1, 0):
        n = out.shape[axis]
        at = lambda by: np.take(out, np.clip(np.arange(n) + by, 0, n - 1), axis)  # noqa: E731, B023
        for _ in range(passes):
            total = sum(at(by) for by in range(-reach, reach + 1)) * inner + (at(-reach - 1) + at(reach + 1)) * edge
            out = (total + (1 << (POINT - 1))) >> POINT
    return out


def unsharp(gray: np.ndarray, radius: float = 1.5, amount: float = 0.35) -> np.ndarray:
    """The picture plus ``amount`` times what its blur takes away, in single precision, cut off to whole grays."""
    gained = gray.astype(np.float32) - np.float32(amount) * (blurred(gray, radius) - gray).astype(np.float32)
    return np.clip(gained, 0, 255).astype(np.uint8)


def before_reading(gray: np.ndarray) -> np.ndarray:
    return sharpen(autocontrast(gray, 2.0))


def before_layout(gray: np.ndarray) -> np.ndarray:
    return unsharp(tiled_autocontrast(gray))


def kernel(tiles: DataFrame, f: Callable[[np.ndarray], np.ndarray], key: str = "tile_id") -> DataFrame:
    """(key, width, height, pixels) with ``f`` applied to each tile; tiles without pixels stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for w, h, data in zip(*(batch.column(c).to_pylist() for c in ("width", "height", "pixels"))):
                out.append(f(np.frombuffer(data, np.uint8).reshape(h, w)).tobytes() if data and w and h else data)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (key, "width", "height")], pa.array(out, pa.binary())], names=[key, "width", "height", "pixels"])

    ship(tiles.sparkSession)
    rows = tiles.select(key, "width", "height", "pixels")
    return rows.mapInArrow(run, rows.schema)


def crop(tiles: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column, key: str = "tile_id") -> DataFrame:
    """(key, width, height, pixels) of the parts of gray tiles inside boxes, which are first cut at the tiles' edges; an empty part has no pixels."""
    within = lambda x, most: F.least(F.greatest(x, F.lit(0)), F.col(most)).cast("int")
    cut = tiles.select(key, F.col("width").alias("w"), "pixels", within(x0, "width").alias("x0"), within(y0, "height").alias("y0"),
        within(x1, "width").alias("x1"), within(y1, "height").alias("y1"))
    wide, high = F.greatest(F.lit(0), F.col("x1") - F.col("x0")), F.greatest(F.lit(0), F.col("y1") - F.col("y0"))
    rows = F.when((wide > 0) & (high > 0), F.sequence(F.col("y0"), F.col("y1") - 1)).otherwise(F.array().cast("array<int>"))
    part = F.aggregate(rows, F.lit(b""), lambda acc, y: F.concat(acc, F.substring("pixels", y * F.col("w") + F.col("x0") + 1, wide)))
    return cut.select(key, wide.alias("width"), high.alias("height"), part.alias("pixels"))
