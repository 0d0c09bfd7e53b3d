"""Borders of regions in a mosaic of pixels: outer borders of 8-connected regions and borders of their holes, over any chunks.

A side lies between a set pixel and an unset neighbour above, right, below or left of it. Walked with the pixel on its right hand, a side is
followed by one other: at its end the border turns left where the pixel diagonally ahead is set, goes on where the one ahead is, and else
turns right round its own pixel. So sides form rings, and a ring is a border: its points are the pixels whose sides it passes. A thin line's
border runs there and back.

A chunk and the pixels round it tell the followers of the chunk's sides. Chunks walk what they own; where rings cross chunks their parts
are ranked by list ranking, so no task holds a ring, and points come as rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import counted, stage
from terrasieve.operators.chains import list_ranks

#: Ways out of a pixel, clockwise from above: each is a side's outward way, and the next one its heading.
WAYS = ((-1, 0), (0, 1), (1, 0), (0, -1))
_SIDE = "struct<r:long,c:long,d:int>"
_PART = f"head {_SIDE}, after {_SIDE}, rows array<long>, cols array<long>, least {_SIDE}, at int, area long"


def _followers(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a: pixels with a margin of one on all sides. Codes (place * 4 + way) of the inner pixels' sides, and of the sides that follow them."""
    h, w = a.shape
    own = np.zeros_like(a)
    own[1:-1, 1:-1] = a[1:-1, 1:-1]
    flat = a.ravel()
    codes, after = [], []
    for d, (dy, dx) in enumerate(WAYS):
        place = np.flatnonzero(own.ravel())
        place = place[flat[place + dy * w + dx] == 0]
        ahead = WAYS[(d + 1) % 4][0] * w + WAYS[(d + 1) % 4][1]
        left, on = place + dy * w + dx + ahead, place + ahead
        codes.append(place * 4 + d)
        after.append(np.where(flat[left] > 0, left * 4 + (d - 1) % 4, np.where(flat[on] > 0, on * 4 + d, place * 4 + (d + 1) % 4)))
    return np.concatenate(codes), np.concatenate(after)


def _parts(a: np.ndarray) -> list[tuple[list[int], int | None]]:
    """Rings and parts of rings over the inner pixels' sides: codes in order, and the code that follows beyond the margin (None for a ring)."""
    codes, after = _followers(a)
    follows = dict(zip(codes.tolist(), after.tolist(), strict=True))
    begun = sorted(set(follows) - set(follows.values()))
    out, left = [], set(follows)
    for heads in (begun, sorted(follows)):
        for head in heads:
            if head not in left:
                continue
            walk, at = [], head
            while at in left:
                left.discard(at)
                walk.append(at)
                at = follows[at]
            out.append((walk, None if at == head else at))
    return out


def border_parts(pixels: DataFrame, size: int) -> DataFrame:
    """Parts of borders within chunks of size x size pixels: head and after (the sides that begin it and that follow it; after is null for a whole
    ring), rows and cols (its points), least (its least side), at (the point that has it), area (what the part adds to the ring's)."""

    def near(c: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(c) - 1) / size), F.floor((F.col(c) + 1) / size)))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        top, left = int(p["chunk_row"].iloc[0]) * size - 1, int(p["chunk_col"].iloc[0]) * size - 1
        w = size + 2
        a = np.zeros((w, w), dtype=np.uint8)
        a[p["row"] - top, p["col"] - left] = 1
        spot = lambda code: (code // 4 // w + top, code // 4 % w + left, code % 4)
        out = []
        for walk, after in _parts(a):
            sides = [spot(c) for c in walk]
            points = [i for i, s in enumerate(sides) if i == 0 or s[:2] != sides[i - 1][:2]]  # where a new point begins
            if after is None and len(points) > 1 and sides[-1][:2] == sides[0][:2]:  # the ring was entered amid a point's sides
                sides = sides[points[-1] :] + sides[: points[-1]]
                points = [i for i, s in enumerate(sides) if i == 0 or s[:2] != sides[i - 1][:2]]
            least = min(range(len(sides)), key=sides.__getitem__)
            at = int(np.searchsorted(points, least, side="right")) - 1
            area = sum(c + 1 if d == 1 else -c if d == 3 else 0 for _, c, d in sides)
            out.append((sides[0], None if after is None else spot(after), [sides[i][0] for i in points], [sides[i][1] for i in points], sides[least], at, area))
        named = lambda s: s and dict(zip("rcd", s, strict=True))
        rows = [(named(h), named(f), r, c, named(s), at, area) for h, f, r, c, s, at, area in out]
        return pd.DataFrame(rows, columns=["head", "after", "rows", "cols", "least", "at", "area"])

    dealt = pixels.select("row", "col", near("row").alias("chunk_row")).select("*", near("col").alias("chunk_col"))
    return dealt.dropDuplicates(["row", "col", "chunk_row", "chunk_col"]).groupBy("chunk_row", "chunk_col").applyInPandas(run, _PART)


def border_points(pixels: DataFrame, size: int = 2048, straight: bool = True) -> DataFrame:
    """Every point of every border of the set pixels (row, col; repeats count once): border (its least side, `row col way`), hole, area (pixels
    within, less than 0 for a hole), n (points), seq, row, col. A border begins at the point that has its least side, or the next one that
    stays; outer borders run clockwise, holes the other way, rows counted downwards. straight=False leaves points inside of straight runs out,
    level, upright or diagonal ones; n and seq count what stays. The same rows for any size.

    Windows see a row a part; a part's points stay in its arrays until all is counted. Sides of joins have a row a part at most, and are
    broadcast or not by the number of parts."""
    spot = lambda i: F.struct(F.element_at("rows", i).alias("r"), F.element_at("cols", i).alias("c"))
    parts = stage(border_parts(pixels, size).withColumn("node", F.monotonically_increasing_id()), "border-parts")
    n_parts = parts.count()
    short = parts.select("node", "head", "after", "least", "at", "area", spot(1).alias("first"), spot(-1).alias("last"))
    whole = short.filter("after is null").select("node", F.col("least").alias("ring"), "at", "area", "first", "last", F.lit(0).cast("long").alias("rank"))
    cut = short.filter("after is not null")
    heads = cut.select(F.col("head").alias("_h"), F.col("node").alias("next"))
    ranks = list_ranks(cut.join(counted(heads, n_parts), F.col("after") == F.col("_h")).select("node", "next", F.col("least").alias("place")))
    ranked = cut.select("node", "at", "area", "first", "last").join(counted(ranks.select("node", F.col("first").alias("ring"), F.col("seq").alias("rank")), n_parts), "node")
    placed = whole.unionByName(ranked)
    order = Window.partitionBy("ring").orderBy("rank")  # a row a part
    rings = placed.groupBy(F.col("ring").alias("_r")).agg(F.sum("area").alias("whole_area"), F.max_by("last", "rank").alias("end"), F.min_by("first", "rank").alias("begin"))
    around = placed.withColumns({"before": F.lag("last").over(order), "next": F.lead("first").over(order)}).join(counted(rings, n_parts), F.col("ring") == F.col("_r"))
    around = around.select("node", "ring", "rank", "at", "whole_area", F.coalesce("before", "end").alias("before"), F.coalesce("next", "begin").alias("next"))
    joined = parts.select("node", "rows", "cols").join(counted(around, n_parts), "node")
    inside = F.sequence(F.lit(0), F.size("rows") - 1)
    if not straight:
        long = {c: F.concat(F.array(f"before.{k}"), c, F.array(f"next.{k}")) for c, k in (("rows", "r"), ("cols", "c"))}
        joined = joined.withColumns({f"_{c}": v for c, v in long.items()})
        goes = lambda c, i: F.get(c, i + 1) - F.get(c, i)
        turns = lambda i: (goes("_rows", i) != goes("_rows", i + 1)) | (goes("_cols", i) != goes("_cols", i + 1)) | ((goes("_rows", i) == 0) & (goes("_cols", i) == 0))
        inside = F.filter(inside, turns)
    kept = joined.withColumn("kept", inside)
    pick = lambda c: F.transform("kept", lambda i: F.get(c, i))
    skipped = F.size(F.filter("kept", lambda i: i < F.col("at"))).cast("long")
    kept = stage(kept.select("node", "ring", "rank", "whole_area", pick("rows").alias("rows"), pick("cols").alias("cols"), skipped.alias("skipped"), F.size("kept").cast("long").alias("points")), "border-kept")
    counts = kept.select("node", "ring", "rank", "points", "skipped")
    base = F.coalesce(F.sum("points").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = counts.groupBy(F.col("ring").alias("_r")).agg(F.sum("points").alias("n"), F.min_by("skipped", "rank").alias("start"))
    counts = counts.select("node", "ring", base.alias("base")).join(counted(sums, n_parts), F.col("ring") == F.col("_r")).drop("ring", "_r")
    rows = kept.select("node", "ring", F.col("whole_area").alias("area"), F.posexplode(F.arrays_zip("rows", "cols")).alias("i", "p")).join(counted(counts, n_parts), "node")
    seq = F.pmod(F.col("base") + F.col("i") - F.col("start"), F.col("n"))
    return rows.select(F.concat_ws(" ", "ring.r", "ring.c", "ring.d").alias("border"), (F.col("area") < 0).alias("hole"), "area", "n", seq.cast("long").alias("seq"), F.col("p.rows").alias("row"), F.col("p.cols").alias("col"))


def border_lines(pixels: DataFrame, affine: tuple[float, float, float, float, float, float], size: int = 2048, least: int = 5) -> DataFrame:
    """Borders as lines: those that have at least `least` points, and 2, once straight runs are cut down. border, hole, seq, x, y (map positions of
    pixel centres). Lines aren't closed: nothing leads from the last point to the first."""
    a, b, x0, d, e, y0 = affine
    kept = border_points(pixels, size, straight=False).filter(F.col("n") >= max(least, 2))
    r, c = F.col("row") + 0.5, F.col("col") + 0.5
    return kept.select("border", "hole", "seq", (a * c + b * r + x0).alias("x"), (d * c + e * r + y0).alias("y"))
