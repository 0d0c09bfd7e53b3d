"""Closed-form geometry on coordinate columns. Edges are ax, ay, bx, by columns; no geometry library is needed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def edge_length(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))


def to_map(row: Column, col: Column, affine: tuple[float, float, float, float, float, float]) -> tuple[Column, Column]:
    """Map position of a pixel's centre; affine is (a, b, xoff, d, e, yoff)."""
    a, b, x0, d, e, y0 = affine
    return a * (col + 0.5) + b * (row + 0.5) + x0, d * (col + 0.5) + e * (row + 0.5) + y0


def to_pixel(x: Column, y: Column, affine: tuple[float, float, float, float, float, float]) -> tuple[Column, Column]:
    """(row, col), fractional, of a map position."""
    a, b, x0, d, e, y0 = affine
    det = a * e - b * d
    if not det:
        raise ValueError("the affine transform has no inverse")
    return (a * (y - y0) - d * (x - x0)) / det, (e * (x - x0) - b * (y - y0)) / det


def _linear(at: Column, slope: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """The t for which low <= at + t * slope <= high; an empty range has its ends the wrong way round."""
    first, second = (low - at) / slope, (high - at) / slope
    flat = F.when((at >= low) & (at <= high), F.lit(-1e9)).otherwise(F.lit(1e9))
    return F.when(slope == 0, flat).otherwise(F.least(first, second)), F.when(slope == 0, -flat).otherwise(F.greatest(first, second))


def _linear_range(at: np.ndarray, slope: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, second = (low - at) / slope, (high - at) / slope
    flat = np.where((at >= low) & (at <= high), -np.inf, np.inf)
    return np.where(slope == 0, flat, np.minimum(first, second)), np.where(slope == 0, -flat, np.maximum(first, second))


def capsule_intervals(edges: np.ndarray, others: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of edges (rows ax, ay, bx, by): the interval of t in [0, 1] in which the first edge lies within d of the second, as
    (low, high), low above high if empty. A capsule is convex, so the discs about both ends and the rectangle between them give one
    interval. An edge of no length has none."""
    (px, py, qx, qy), (rx, ry, sx, sy) = edges.T, others.T
    vx, vy, wx, wy, ux, uy, zx, zy = qx - px, qy - py, sx - rx, sy - ry, px - rx, py - ry, px - sx, py - sy
    a, ww = vx * vx + vy * vy, wx * wx + wy * wy
    low, high = np.full(len(a), np.inf), np.full(len(a), -np.inf)
    with np.errstate(divide="ignore", invalid="ignore"):
        for cx, cy in ((ux, uy), (zx, zy)):
            b, c = vx * cx + vy * cy, cx * cx + cy * cy - d * d
            root = np.sqrt(np.where(b * b - a * c >= 0, b * b - a * c, np.nan))
            low, high = np.fmin(low, (-b - root) / a), np.fmax(high, (-b + root) / a)
        width = d * np.sqrt(ww)
        along = _linear_range(ux * wx + uy * wy, vx * wx + vy * wy, np.zeros(len(a)), ww)
        beside = _linear_range(ux * wy - uy * wx, vx * wy - vy * wx, -width, width)
        first, last = np.maximum(along[0], beside[0]), np.minimum(along[1], beside[1])
        holds = (first <= last) & (ww > 0)
        low, high = np.where(holds, np.fmin(low, first), low), np.where(holds, np.fmax(high, last), high)
    empty = ~(a > 0)
    return np.where(empty, np.inf, np.maximum(0.0, low)), np.where(empty, -np.inf, np.minimum(1.0, high))


def clip_interval(p: tuple[Column, Column], q: tuple[Column, Column], box: tuple[Column, Column, Column, Column]) -> tuple[Column, Column]:
    """The interval of t in [0, 1] in which p + t (q - p) lies in a closed box (xmin, ymin, xmax, ymax); reversed if empty."""
    x = _linear(p[0], q[0] - p[0], box[0], box[2])
    y = _linear(p[1], q[1] - p[1], box[1], box[3])
    return F.greatest(F.lit(0.0), x[0], y[0]), F.least(F.lit(1.0), x[1], y[1])


def point_edge_distance2(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Squared distance of a point from an edge; an edge of no length is a point."""
    vx, vy = bx - ax, by - ay
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(((x - ax) * vx + (y - ay) * vy) / F.nullif(vx * vx + vy * vy, F.lit(0.0)), F.lit(0.0))))
    dx, dy = x - (ax + t * vx), y - (ay + t * vy)
    return dx * dx + dy * dy


def box_of(width: Column, height: Column, affine: tuple[Column, Column, Column, Column, Column, Column]) -> tuple[Column, Column, Column, Column]:
    """xmin, ymin, xmax, ymax of a raster of that size by its affine (a, b, xoff, d, e, yoff), whichever way its axes run."""
    a, b, x0, d, e, y0 = affine
    x, y = [x0, x0 + a * width, x0 + b * height, x0 + a * width + b * height], [y0, y0 + d * width, y0 + e * height, y0 + d * width + e * height]
    return F.least(*x), F.least(*y), F.greatest(*x), F.greatest(*y)
