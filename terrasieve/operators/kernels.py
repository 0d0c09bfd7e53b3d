"""Pixel kernels that no column expression states: thinning and tracing of lines, chunk by chunk.

A chunk is a bounded block of pixels, so a group's size doesn't grow with the mosaic. Chunks are thinned without a border of neighbours.
Lines are those of the whole mosaic, whatever the chunks. Cells are linked to their neighbours at the sides, and diagonally where no side
way leads there; a cell pairs its links, the straightest pair first, so a line runs straight on where lines cross and an odd link ends there.
This needs a cell's neighbours only: chunks trace the links they own, and their parts are joined where a pair's links have two owners.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import drop, stage

Cell = tuple[int, int]
Line = list[Cell]
#: Clockwise from above; 2 to 5 lead to greater cells.
WAYS = ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))
ENDS, UNLINKED = -1, -2


def _neighbours(a: np.ndarray) -> list[np.ndarray]:
    """The eight neighbours of every pixel, clockwise from the one above; outside is 0."""
    p = np.pad(a, 1)
    h, w = a.shape
    return [p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] for dy, dx in ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))]


def thin(a: np.ndarray) -> np.ndarray:
    """Parallel thinning to lines one pixel wide: pixels go in two alternating passes until none does."""
    a = a.astype(np.uint8)
    while True:
        gone = 0
        for turn in (0, 1):
            n = _neighbours(a)
            total = sum(n)
            rises = sum(((n[i] == 0) & (n[(i + 1) % 8] == 1)).astype(np.uint8) for i in range(8))
            up, right, down, left = n[0], n[2], n[4], n[6]
            free = (up * right * down == 0) & (right * down * left == 0) if turn == 0 else (up * right * left == 0) & (up * down * left == 0)
            off = (a == 1) & (total >= 2) & (total <= 6) & (rises == 1) & free
            gone += int(off.sum())
            a = np.where(off, 0, a).astype(np.uint8)
        if not gone:
            return a


def _partners(mask: int) -> tuple[int, ...]:
    """For each way of a cell whose set neighbours are the bits of mask: the way that its link goes on by, ENDS or UNLINKED."""
    there = [mask >> i & 1 for i in range(8)]
    links = [i for i in range(8) if there[i] and (i % 2 == 0 or not (there[i - 1] or there[(i + 1) % 8]))]
    out = [ENDS if i in links else UNLINKED for i in range(8)]
    for _, i, j in sorted((-min(j - i, 8 - j + i), i, j) for i in links for j in links if i < j):
        if out[i] == ENDS and out[j] == ENDS:
            out[i], out[j] = j, i
    return tuple(out)


PARTNERS = [_partners(m) for m in range(256)]


def _fragments(cells: set[Cell], owned: Callable[[Cell], bool]) -> list[tuple[Line, tuple | None, tuple | None, bool]]:
    """Parts of lines over the links whose lesser cell is owned: cells, the joints at both ends (None where the line ends), and whether it is
    a ring, whose first cell is also its last. cells has all within two of the owned ones."""
    around = {}

    def partners(c: Cell) -> tuple[int, ...]:
        if c not in around:
            around[c] = PARTNERS[sum(1 << i for i, (y, x) in enumerate(WAYS) if (c[0] + y, c[1] + x) in cells)]
        return around[c]

    def link(c: Cell, way: int) -> tuple[Cell, int]:
        return (c, way) if 2 <= way <= 5 else ((c[0] + WAYS[way][0], c[1] + WAYS[way][1]), (way + 4) % 8)

    left = {(c, way) for c in cells if owned(c) for way in range(2, 6) if partners(c)[way] != UNLINKED}

    def follow(c: Cell, way: int) -> tuple[Line, tuple | None]:
        line = []
        while True:
            c = (c[0] + WAYS[way][0], c[1] + WAYS[way][1])
            line.append(c)
            back = (way + 4) % 8
            way = partners(c)[back]
            if way == ENDS:
                return line, None
            if link(c, way) not in left:  # another chunk's, or this ring's first
                return line, (*c, min(back, way), max(back, way))
            left.discard(link(c, way))

    out = []
    for start in sorted(left):
        if start not in left:
            continue
        left.discard(start)
        c, way = start
        ahead, tail = follow(c, way)
        back = partners(c)[way]
        if back == ENDS:
            out.append(([c, *ahead], None, tail, False))
        elif tail == (*c, min(back, way), max(back, way)):
            out.append(([c, *ahead], None, None, True))
        elif link(c, back) not in left:
            out.append(([c, *ahead], (*c, min(back, way), max(back, way)), tail, False))
        else:
            left.discard(link(c, back))
            behind, head = follow(c, back)
            out.append(([*behind[::-1], c, *ahead], head, tail, False))
    return out


def _in_order(line: Line, ring: bool) -> Line:
    """One of the ways to write a line: from the lesser end; a ring from its least cell, which isn't repeated."""
    if not ring:
        return min(line, line[::-1])
    line = line[:-1]
    return min(turned[i:] + turned[:i] for turned in (line, line[::-1]) for i, c in enumerate(turned) if c == min(line))


def paths(cells: set[Cell]) -> list[Line]:
    """Lines through 8-connected cells. Every link is in one line; cells without a link are lines of one point."""
    found = [_in_order(line, ring) for line, _, _, ring in _fragments(cells, lambda c: True)]
    reached = {c for line in found for c in line}
    return sorted(found + [[c] for c in cells if c not in reached])


def thin_chunks(pixels: DataFrame) -> DataFrame:
    """pixels (row, col, chunk_row, chunk_col) that are set; those that thinning leaves."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(p["row"].min()), int(p["col"].min())
        a = np.zeros((int(p["row"].max()) - r0 + 1, int(p["col"].max()) - c0 + 1), dtype=np.uint8)
        a[p["row"] - r0, p["col"] - c0] = 1
        r, c = np.nonzero(thin(a))
        return pd.DataFrame({"row": r + r0, "col": c + c0, "chunk_row": p["chunk_row"].iloc[0], "chunk_col": p["chunk_col"].iloc[0]})

    return pixels.select("row", "col", "chunk_row", "chunk_col").groupBy("chunk_row", "chunk_col").applyInPandas(run, "row long, col long, chunk_row long, chunk_col long")


def _least_of_neighbours(links: DataFrame) -> DataFrame:
    """(key, root) of every key of links (a, b): root is the same for keys that links join. Keys are hashes, so that their order along a line
    is random and the links that are left shrink by a factor in each round."""
    edges = stage(links, "line-links")
    label = stage(edges.select(F.explode(F.array("a", "b")).alias("key")).distinct().withColumn("root", F.col("key")), "line-roots")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("k"), F.least("a", "b").alias("up")), "line-up")
        before, label = label, stage(label.join(up, F.col("root") == F.col("k"), "left").select("key", F.coalesce("up", "root").alias("root")), "line-roots")
        moved = edges.join(up.select(F.col("k").alias("ka"), F.col("up").alias("ua")), F.col("a") == F.col("ka")).join(up.select(F.col("k").alias("kb"), F.col("up").alias("ub")), F.col("b") == F.col("kb"))
        last, edges = edges, stage(moved.filter("ua <> ub").select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct(), "line-links")
        drop(before, last, up)
    drop(edges)
    return label


def _joined(p: pd.DataFrame) -> pd.DataFrame:
    """The line of which p has all parts."""
    parts = {k: list(zip(r.tolist(), c.tolist(), strict=True)) for k, r, c in zip(p["key"], p["rows"], p["cols"], strict=True)}
    ends = {k: (h, t) for k, h, t in zip(p["key"], p["head"], p["tail"], strict=True)}
    at: dict[str, list[str]] = {}
    for k, joints in ends.items():
        for joint in joints:
            if joint is not None:
                at.setdefault(joint, []).append(k)
    first = min(ends, key=lambda k: (None not in ends[k], k))
    k, entry, line = first, ends[first][0] if None not in ends[first] else None, []
    while True:
        head, tail = ends[k]
        forward = head == entry
        line += (parts[k] if forward else parts[k][::-1])[bool(line) :]
        entry = tail if forward else head
        if entry is None:
            ring = False
            break
        a, b = at[entry]
        k = b if a == k else a
        if k == first:
            ring = True
            break
    r, c = zip(*_in_order(line, ring), strict=True)
    return pd.DataFrame({"rows": [r], "cols": [c]})


def trace_lines(pixels: DataFrame, affine: tuple[float, float, float, float, float, float], size: int, least: int = 5) -> DataFrame:
    """Lines of the whole mosaic of at least `least` points: chunk_row, chunk_col (of the first point), line, xs, ys (map positions of pixel
    centres). Lines aren't closed. Chunks of size x size pixels are traced apart; a line that crosses borders is joined, one task a line."""
    a, b, x0, d, e, y0 = affine

    def near(c: str):
        return F.explode(F.sequence(F.floor((F.col(c) - 2) / size), F.floor((F.col(c) + 2) / size)))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        own = int(p["chunk_row"].iloc[0]), int(p["chunk_col"].iloc[0])
        out = []
        for line, head, tail, ring in _fragments(set(zip(p["row"].tolist(), p["col"].tolist(), strict=True)), lambda c: (c[0] // size, c[1] // size) == own):
            whole = head is None and tail is None
            line = _in_order(line, ring) if whole else line
            r, c = zip(*line, strict=True)
            out.append((md5(repr((own, len(out))).encode()).hexdigest(), *(j and "_".join(map(str, j)) for j in (head, tail)), r, c))
        return pd.DataFrame(out, columns=["key", "head", "tail", "rows", "cols"])

    dealt = pixels.select("row", "col", near("row").alias("chunk_row")).select("*", near("col").alias("chunk_col"))
    parts = dealt.groupBy("chunk_row", "chunk_col").applyInPandas(run, "key string, head string, tail string, rows array<long>, cols array<long>")
    parts = stage(parts, "line-parts")
    whole = F.col("head").isNull() & F.col("tail").isNull()
    joints = parts.select("key", F.explode(F.array("head", "tail")).alias("joint")).filter("joint is not null")
    links = joints.groupBy("joint").agg(F.min("key").alias("a"), F.max("key").alias("b")).select("a", "b").distinct()
    cut = parts.filter(~whole).join(_least_of_neighbours(links), "key")
    lines = parts.filter(whole).select("rows", "cols").unionByName(cut.groupBy("root").applyInPandas(_joined, "rows array<long>, cols array<long>"))
    lines = lines.filter(F.size("rows") >= max(least, 2)).select("*", F.floor(F.col("rows")[0] / size).alias("chunk_row"), F.floor(F.col("cols")[0] / size).alias("chunk_col"))
    xs = F.zip_with("rows", "cols", lambda r, c: a * (c + 0.5) + b * (r + 0.5) + x0)
    ys = F.zip_with("rows", "cols", lambda r, c: d * (c + 0.5) + e * (r + 0.5) + y0)
    number = F.row_number().over(Window.partitionBy("chunk_row", "chunk_col").orderBy("rows", "cols")) - 1  # lines that begin in one chunk
    return lines.select("chunk_row", "chunk_col", number.cast("long").alias("line"), xs.alias("xs"), ys.alias("ys"))
