"""Union of lines with nodes, by snap rounding on a stated grid.

Corners are rounded to whole multiples of the grid. Hot points are all corners and, rounded, all points where two edges cross. Every edge is
replaced by the way through the hot points whose unit square (closed below and at the left, open above and at the right) it passes. All
decisions are made in whole numbers. Edges that come of it meet at their ends only, and equal ones are kept once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import drop, stage
from terrasieve.operators.lines import EDGE, cut_edges, grid_join

#: Edges up to so many units: products of two such numbers fit 64 bits.
MOST = 1 << 30
#: Sub-edges of long edges and cells have about as many times the mean edge.
CELL = 2.0


def _columns(b: pa.RecordBatch, first: int) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns[first:]]


def _near(*d: np.ndarray) -> None:
    if any(len(x) and np.abs(x).max() >= MOST for x in d):
        raise ValueError("an edge is longer than 2^30 units of the grid")


def crossings(ax, ay, bx, by, cx, cy, dx, dy) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of edges ab and cd: which cross at a point inside of both, and that point, rounded half up."""
    ux, uy, vx, vy = bx - ax, by - ay, dx - cx, dy - cy
    _near(ux, uy, vx, vy, cx - ax, cy - ay)
    c, d = ux * (cy - ay) - uy * (cx - ax), ux * (dy - ay) - uy * (dx - ax)
    a, b = vx * (ay - cy) - vy * (ax - cx), vx * (by - cy) - vy * (bx - cx)
    holds = (np.sign(c) * np.sign(d) < 0) & (np.sign(a) * np.sign(b) < 0)
    a, b, ux, uy = (x[holds].astype(object) for x in (a, b, ux, uy))  # Python's integers: products of three numbers
    sign = np.where(a > b, 1, -1).astype(object)
    share, whole = a * sign, (a - b) * sign
    x, y = ((2 * u * share + whole) // (2 * whole) for u in (ux, uy))
    return holds, ax[holds] + x.astype(np.int64), ay[holds] + y.astype(np.int64)


def passes(ax, ay, bx, by, x, y) -> np.ndarray:
    """Whether edges pass the half-open unit squares about points. Along the edge, each pair of the square's sides is passed between two shares,
    and so are the edge's ends; three intervals of a line have a point in common if any two have."""
    ends: list[list[tuple]] = []  # of each direction: (numerator, denominator, closed) of the low and of the high share
    ok = np.ones(len(ax), dtype=bool)
    for p, q, z in ((ax, bx, x), (ay, by, y)):
        d = 2 * (q - p)
        low, high = 2 * (z - p) - 1, 2 * (z - p) + 1
        ok &= (d != 0) | ((low <= 0) & (high > 0))
        up = d > 0
        w = np.abs(d)
        ends.append([(np.where(up, low, -high), w, up), (np.where(up, high, -low), w, ~up)])
    for (n0, w, c0), (n1, _, c1) in ends:  # against the edge's ends, 0 and 1
        flat = w == 0
        ok &= flat | (((n0 < w) | ((n0 == w) & c0)) & ((n1 > 0) | ((n1 == 0) & c1)))
    for lows, highs in ((ends[0][0], ends[1][1]), (ends[1][0], ends[0][1])):
        (n0, w0, c0), (n1, w1, c1) = lows, highs
        s, t = n0 * w1, n1 * w0
        ok &= (w0 == 0) | (w1 == 0) | (s < t) | ((s == t) & c0 & c1)
    return ok


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        holds, x, y = crossings(*_columns(b, 1))
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(holds)), pa.array(x), pa.array(y)], names=["key", "x", "y"])


def _passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, key, x, y, at, inner) of the hot points that an edge passes: at is the way along it, inner whether it is none of its ends."""
    for b in batches:
        ax, ay, bx, by, x, y = _columns(b, 2)
        _near(bx - ax, by - ay)
        holds = passes(ax, ay, bx, by, x, y)
        keep = pa.array(holds)
        ax, ay, bx, by, x, y = (v[holds] for v in (ax, ay, bx, by, x, y))
        at = (bx - ax) * (x - ax) + (by - ay) * (y - ay)
        inner = ~(((x == ax) & (y == ay)) | ((x == bx) & (y == by)))
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(x), pa.array(y), pa.array(at), pa.array(inner)], names=["sid", "key", "x", "y", "at", "inner"])


def _once(edges: DataFrame) -> DataFrame:
    """Each edge (key, ax, ay, bx, by) once, whatever its direction, without those of no length."""
    a, b = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    e = edges.select("key", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct()
    return e.select("key", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def noded_whole(lines: DataFrame, key: str, grid: float = 1e-3) -> DataFrame:
    """Per key, the noded union of lines (key, ax, ay, bx, by): key, ax, ay, bx, by in whole units of the grid, each edge once, from its lesser
    corner. Null corners and edges that the rounding leaves no length go. Rounds go on until no edge passes a hot point inside; a round is
    two grid joins."""
    kind = lines.schema[key].dataType.simpleString()
    rounded = [F.floor(F.col(c) / grid + 0.5).cast("long").alias(c) for c in EDGE]
    edges = _once(lines.dropna(subset=list(EDGE)).select(F.col(key).alias("key"), *rounded))
    while True:
        edges = stage(edges.withColumn("sid", F.monotonically_increasing_id()), "noded-edges")
        mean = edges.agg(F.avg(F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay"))))).first()[0]
        cell = max(8.0, CELL * (mean or 0.0))
        left = cut_edges(edges, cell)
        pairs = grid_join(left, left, cell, on=("key",)).filter("sid < rsid")
        met = pairs.select("key", *EDGE, *[f"r{c}" for c in EDGE]).mapInArrow(_meet, f"key {kind}, x long, y long")
        corners = edges.select("key", F.explode(F.array(*[F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y")) for p in "ab"])).alias("p")).select("key", "p.*")
        hot = stage(corners.unionByName(met).distinct(), "hot-points")
        spots = hot.select("key", F.col("x").alias("hx"), F.col("y").alias("hy"), *[F.col(c[1]).cast("double").alias(c) for c in ("_x0", "_x1", "_y0", "_y1")])
        wide = left.select("sid", "key", *EDGE, *[(F.col(f"_{c}0") - 0.5).alias(f"_{c}0") for c in "xy"], *[(F.col(f"_{c}1") + 0.5).alias(f"_{c}1") for c in "xy"])
        through = grid_join(wide, spots, cell, on=("key",)).select("sid", "key", *EDGE, "rhx", "rhy")
        found = stage(through.mapInArrow(_passed, f"sid long, key {kind}, x long, y long, at long, inner boolean"), "hot-passed")
        drop(hot)
        order = Window.partitionBy("sid").orderBy("at")
        steps = found.select("key", F.col("x").alias("ax"), F.col("y").alias("ay"), F.lead("x").over(order).alias("bx"), F.lead("y").over(order).alias("by"))
        moved = not found.filter("inner").isEmpty()
        edges = _once(steps.dropna(subset=["bx"]))
        if not moved:
            return edges.withColumnRenamed("key", key)


def noded(lines: DataFrame, key: str, grid: float = 1e-3) -> DataFrame:
    """noded_whole in map units, with the length of each edge. Two lines that cross give four parts."""
    e = noded_whole(lines, key, grid)
    d2 = lambda c: (F.col(f"b{c}") - F.col(f"a{c}")).cast("double") * (F.col(f"b{c}") - F.col(f"a{c}"))
    return e.select(key, *[(F.col(c) * F.lit(grid)).alias(c) for c in EDGE], (F.sqrt(d2("x") + d2("y")) * grid).alias("length"))
