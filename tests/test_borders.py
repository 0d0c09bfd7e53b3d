"""Borders against a plain tracer of the whole mosaic, for any size of chunk."""

from collections import defaultdict

import numpy as np

from terrasieve.operators import borders

#: A pixel's neighbours.
ROUND = ((0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1))


def traced(cells):
    """Border points by walking along the lines between set and unset pixels, from corner to corner; where two ways leave a corner, the left."""
    ways = defaultdict(list)
    for r, c in cells:
        corners = [(r, c), (r, c + 1), (r + 1, c + 1), (r + 1, c)]
        for i, (y, x) in enumerate(((-1, 0), (0, 1), (1, 0), (0, -1))):
            if (r + y, c + x) not in cells:
                ways[corners[i]].append((corners[(i + 1) % 4], (r, c)))
    out = []
    while any(ways.values()):
        start = min(k for k, v in ways.items() if v)
        at, heading, pixels = start, None, []
        while True:
            options = ways[at]
            left = [o for o in options if heading and (o[0][0] - at[0], o[0][1] - at[1]) == (-heading[1], heading[0])]
            if pixels and at == start and not left:  # a ring comes back to a corner that it doesn't leave to the left
                break
            step = left[0] if left else options[0]
            options.remove(step)
            heading, at = (step[0][0] - at[0], step[0][1] - at[1]), step[0]
            if not pixels or pixels[-1] != step[1]:
                pixels.append(step[1])
        if len(pixels) > 1 and pixels[0] == pixels[-1]:
            pixels.pop()
        out.append(pixels)
    return out


def simple(points):
    """Without the points inside of straight runs."""
    n = len(points)
    step = lambda i: (points[(i + 1) % n][0] - points[i % n][0], points[(i + 1) % n][1] - points[i % n][1])
    return [p for i, p in enumerate(points) if n == 1 or step(i - 1) != step(i)]


def turned(points):
    """One way to write a ring, wherever it begins."""
    return min(points[i:] + points[:i] for i in range(len(points))) if points else points


def flooded(cells):
    """8-connected regions, and 4-connected holes."""
    rows, cols = [r for r, _ in cells], [c for _, c in cells]
    box = {(r, c) for r in range(min(rows) - 1, max(rows) + 2) for c in range(min(cols) - 1, max(cols) + 2)}

    def count(left, ways):
        n, left = 0, set(left)
        while left:
            n, todo = n + 1, [left.pop()]
            while todo:
                r, c = todo.pop()
                for y, x in ways:
                    if (r + y, c + x) in left:
                        left.discard((r + y, c + x))
                        todo.append((r + y, c + x))
        return n

    return count(cells, ROUND), count(box - cells, [w for w in ROUND if 0 in w]) - 1


def found(spark, cells, size, **how):
    rows = borders.border_points(spark.createDataFrame([*cells, *list(cells)[:3]], "row long, col long").repartition(3), size, **how).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.border].append(r)
    out = {}
    for k, v in by.items():
        v.sort(key=lambda r: r.seq)
        assert [r.seq for r in v] == list(range(len(v))) and {(r.n, r.hole, r.area) for r in v} == {(len(v), v[0].hole, v[0].area)}
        out[k] = (v[0].hole, v[0].area, [(r.row, r.col) for r in v])
    return out


SHAPES = {
    "point": {(5, 5)},
    "line": {(3, c) for c in range(2, 12)} | {(r, 11) for r in range(3, 9)},
    "ring": {(r, c) for r in range(10) for c in range(10)} - {(r, c) for r in range(3, 7) for c in range(4, 8)},
    "diagonal": {(i, i) for i in range(9)} | {(8 - i, i) for i in range(9)},
    "diamond": {(4 + dy, 4 + dx) for dy in range(-4, 5) for dx in range(-4, 5) if abs(dx) + abs(dy) in (3, 4)},
}
RNG = np.random.default_rng(7)
SHAPES |= {f"random {share}": {(int(r), int(c)) for r, c in zip(*np.nonzero(RNG.random((24, 31)) < share), strict=True)} for share in (0.15, 0.5, 0.8)}


#: All of them in one mosaic, apart from each other and about its origin.
CELLS = {(r + 40 * (i // 3) - 30, c + 40 * (i % 3) - 50) for i, name in enumerate(sorted(SHAPES)) for r, c in SHAPES[name]}


def test_borders(spark):
    got = found(spark, CELLS, 7)
    assert got == found(spark, CELLS, 1000)
    assert sorted(turned(p) for _, _, p in got.values()) == sorted(turned(p) for p in traced(CELLS))
    regions, holes = flooded(CELLS)
    assert sum(not hole for hole, _, _ in got.values()) == regions and sum(hole for hole, _, _ in got.values()) == holes
    assert sum(area for _, area, _ in got.values()) == len(CELLS)
    for key, (_, _, points) in got.items():
        assert " ".join(map(str, points[0])) == key.rpartition(" ")[0]
    short = found(spark, CELLS, 5, straight=False)
    assert {k: turned(p) for k, (_, _, p) in short.items()} == {k: turned(simple(p)) for k, (_, _, p) in got.items()}


def test_border_lines(spark):
    """Small borders go once straight runs are cut down; positions are pixel centres."""
    df = spark.createDataFrame([*SHAPES["ring"], (50, 50), *((30, c) for c in range(9))], "row long, col long")
    got = borders.border_lines(df, (2.0, 0.0, 100.0, 0.0, -2.0, 500.0), 8, least=4).collect()
    lines = defaultdict(list)
    for r in sorted(got, key=lambda r: r.seq):
        lines[r.hole].append((r.x, r.y))
    assert lines[False] == [(101.0, 499.0), (119.0, 499.0), (119.0, 481.0), (101.0, 481.0)]
    assert len(lines[True]) == 8  # a square hole's border cuts the corners
    assert borders.border_lines(df.limit(0), (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)).count() == 0
