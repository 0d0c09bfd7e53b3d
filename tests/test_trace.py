"""Lines traced over many chunks against the trace of the whole mosaic."""

import numpy as np
import pytest

from terrasieve.operators import raster as R
from terrasieve.operators.kernels import paths, thin, trace_lines

AFFINE = (1.0, 0.0, -0.5, 0.0, 1.0, -0.5)  # positions are columns and rows


def traced(spark, cells, size, least):
    px = R.chunked(spark.createDataFrame(sorted(cells), "row long, col long"), size)
    rows = trace_lines(px, AFFINE, size, least=least).collect()
    assert len({(r.chunk_row, r.chunk_col, r.line) for r in rows}) == len(rows)
    return sorted([(int(y), int(x)) for x, y in zip(r.xs, r.ys, strict=True)] for r in rows)


def drawn():
    cells = {(20, c) for c in range(3, 67)} | {(r, 40) for r in range(1, 60)}  # two lines that cross, and cross many borders
    cells |= {(30 + i, 10 + i) for i in range(25)}  # a diagonal over corners
    cells |= {(r, c) for r in range(2, 13) for c in range(5, 30) if r in (2, 12) or c in (5, 29)}  # a ring over chunks
    return cells | {(50, c) for c in range(62, 67)} | {(55, c) for c in range(63, 67)} | {(2, 50)}  # five points over a border, four, one


def noise():
    a = np.random.default_rng(5).random((60, 50)) < 0.45
    return set(zip(*map(np.ndarray.tolist, np.nonzero(a)), strict=True))


def thinned():
    a = np.random.default_rng(6).random((70, 60)) < 0.7
    return set(zip(*map(np.ndarray.tolist, np.nonzero(thin(a))), strict=True))


@pytest.mark.parametrize("cells", [drawn(), noise(), thinned()], ids=["drawn", "noise", "thinned"])
@pytest.mark.parametrize("size", [8, 64])
def test_chunks_equal_the_whole(spark, cells, size):
    assert traced(spark, cells, size, 5) == [x for x in paths(cells) if len(x) >= 5]


def test_lines_are_whole(spark):
    found = traced(spark, drawn(), 64, 5)
    assert [(50, c) for c in range(62, 67)] in found and [(20, c) for c in range(3, 67)] in found
    assert sorted(map(len, found)) == [5, 25, 59, 64, 68]


def test_paths_hold_every_link_once():
    for cells in (drawn(), noise()):
        links = [frozenset(x) for line in paths(cells) for x in zip(line, line[1:], strict=False)]
        sides = {frozenset(((r, c), x)) for r, c in cells for x in ((r, c + 1), (r + 1, c)) if x in cells}
        assert len(links) == len(set(links)) and {c for line in paths(cells) for c in line} == cells
        rings = sum(len(line) > 2 and max(abs(line[0][0] - line[-1][0]), abs(line[0][1] - line[-1][1])) == 1 for line in paths(cells))
        assert len(sides - set(links)) <= rings  # a ring's closing link isn't written
