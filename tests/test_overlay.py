"""Pieces against a dense sampler and the split, noding against a plain noder, chains against a walk."""

import random
from collections import defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import sampled

from terrasieve.operators import chains, noding
from terrasieve.operators import lines as L
from terrasieve.operators import overlay as O

EDGE = "id long, ax double, ay double, bx double, by double"
KEYED = "k string, ax double, ay double, bx double, by double"


def frame(spark, a):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(a)], EDGE)


@pytest.mark.parametrize("cell", [2.0, 20.0])
def test_pieces(spark, cell):
    rng = np.random.default_rng(5)
    edges, mask = rng.integers(0, 60, (25, 4)).astype(float), rng.integers(0, 60, (20, 4)).astype(float)
    edges[:, 2] += 0.5
    edges[0] = [5, 5, 5, 5]
    lines, layer = frame(spark, edges), frame(spark, mask)
    whole = {r.id: r for r in L.split_by_buffer(lines, layer, 3.0, cell).collect()}
    by = defaultdict(list)
    for r in O.line_pieces(lines, layer, 3.0, cell).collect():
        by[r.id].append(r)
    assert set(by) == set(range(1, 25))
    for i, pieces in by.items():
        pieces.sort(key=lambda r: r.t0)
        assert pieces[0].t0 == 0 and pieces[-1].t1 == 1 and all(p.t1 == q.t0 and p.inside != q.inside for p, q in zip(pieces, pieces[1:], strict=False))
        for side in (True, False):
            own = [p for p in pieces if p.inside == side]
            assert [p.seq for p in own] == [p.part for p in own] == list(range(len(own)))
            assert abs(sum(p.length for p in own) - (whole[i].inside if side else whole[i].outside)) < 1e-6
        assert abs(sum(p.length for p in pieces if p.inside) - sampled(edges[i], mask, 3.0)) < 0.1
        for p in pieces:  # the middle of a piece lies on its side
            mid = np.array([p.ax + p.bx, p.ay + p.by]) / 2
            d = [np.hypot(*(mid - m[:2] - np.clip(((mid - m[:2]) @ (m[2:] - m[:2])) / max((m[2:] - m[:2]) @ (m[2:] - m[:2]), 1e-12), 0, 1) * (m[2:] - m[:2]))) for m in mask]
            assert (min(d) <= 3.0) == p.inside or abs(min(d) - 3.0) < 1e-6


def test_pieces_of_lines_with_corners(spark):
    """Pieces that go on over a corner are one part; null corners and empty masks."""
    rows = [(1, 0, 0.0, 0.0, 10.0, 0.0), (1, 1, 10.0, 0.0, 10.0, 10.0), (1, 2, 10.0, 10.0, 20.0, 10.0), (2, 0, None, 0.0, 1.0, 1.0)]
    lines = spark.createDataFrame(rows, "id long, edge int, ax double, ay double, bx double, by double")
    mask = frame(spark, [(10.0, 0.0, 10.0, 1.0)])
    got = sorted((r.inside, r.seq, r.part, r.edge, round(r.length, 6)) for r in O.line_pieces(lines, mask, 3.0).collect())
    assert got == [(False, 0, 0, 0, 7.0), (False, 1, 1, 1, 6.0), (False, 2, 1, 2, 10.0), (True, 0, 0, 0, 3.0), (True, 1, 0, 1, 4.0)]
    assert [(r.inside, r.length) for r in O.line_pieces(lines, mask.limit(0), 3.0).orderBy("edge").collect()] == [(False, 10.0)] * 3


def test_comparison_and_merging(spark):
    """Kinds, and pieces of one line that overlap count once however they were cut."""
    truth = frame(spark, [(0, 0, 40, 0), (0, 20, 40, 20)])
    predicted = frame(spark, [(0, 1, 20, 1), (40, 1, 10, 1), (0, 9, 20, 9)])
    c = O.comparison(predicted, truth, 3.0)
    sums = {r.kind: r.length for r in c.groupBy("kind").agg(F.sum("length").alias("length")).collect()}
    assert sums["TP"] == 50 and sums["FP"] == 20 and abs(sums["FN"] - 40) < 1e-9
    merged = sorted((r.kind, r.ax, r.ay, r.bx, r.by, r.length) for r in O.merged_pieces(c).collect())
    assert merged[-1] == ("TP", 0.0, 1.0, 40.0, 1.0, 40.0) and len(merged) == 3


def test_long_edges_list_few_cells(spark):
    """A diagonal of 10^5 cells lists cells in line with its length; what is found doesn't depend on the parts."""
    long = spark.createDataFrame([(1, 0.0, 0.0, 1e5, 1e5)], EDGE)
    assert L.cut_edges(long, 1.0).count() == 25_000
    rng = np.random.default_rng(8)
    at = rng.uniform(0, 1e5, 200)
    mask = frame(spark, [(x, x + o, x + 5, x + o + 1) for x, o in zip(at, rng.uniform(-6, 6, 200), strict=True)])
    one = L.split_by_buffer(long, mask, 3.0, 2000.0).first()
    many = L.split_by_buffer(long, mask, 3.0, 5.0).first()
    assert one.inside > 100 and abs(one.inside - many.inside) < 1e-6
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 500.0, 400.0), ("b", 600.0, 500.0, 700.0, 550.0)], "file_name string, xmin double, ymin double, xmax double, ymax double")
    got = {r.rfile_name: r.n for r in L.clip_to_boxes(long, boxes, 10.0).groupBy("rfile_name").agg(F.sum("clipped").alias("n")).collect()}
    assert abs(got["a"] - 400 * 2**0.5) < 1e-6 and got.get("b", 0.0) < 1e-9


def plain_noded(segments):
    """Snap rounding by trying all pairs, in fractions."""
    s = {tuple(sorted(((a, b), (c, d)))) for a, b, c, d in segments if (a, b) != (c, d)}
    cross = lambda u, v: u[0] * v[1] - u[1] * v[0]
    sub = lambda p, q: (p[0] - q[0], p[1] - q[1])
    hot = {p for e in s for p in e}
    for (a, b), (c, d) in combinations(s, 2):
        w = cross(sub(b, a), sub(d, c))
        if w:
            t, u = Fraction(cross(sub(c, a), sub(d, c)), w), Fraction(cross(sub(c, a), sub(b, a)), w)
            if 0 < t < 1 and 0 < u < 1:
                hot.add(tuple((a[i] + t * (b[i] - a[i]) + Fraction(1, 2)).__floor__() for i in (0, 1)))
    out = set()
    for a, b in s:
        d = sub(b, a)
        on = []
        for p in hot:
            lo, hi, open_lo, open_hi = Fraction(0), Fraction(1), False, False
            for i in (0, 1):
                near, far = p[i] - a[i] - Fraction(1, 2), p[i] - a[i] + Fraction(1, 2)
                if d[i] == 0:
                    if not near <= 0 < far:
                        hi, lo = Fraction(-1), Fraction(2)
                    continue
                t0, t1, o0, o1 = (near / d[i], far / d[i], False, True) if d[i] > 0 else (far / d[i], near / d[i], True, False)
                if t0 > lo or (t0 == lo and o0):
                    lo, open_lo = t0, o0
                if t1 < hi or (t1 == hi and o1):
                    hi, open_hi = t1, o1
            if lo < hi or (lo == hi and not open_lo and not open_hi):
                on.append(((p[0] - a[0]) * d[0] + (p[1] - a[1]) * d[1], p))
        way = [p for _, p in sorted(on)]
        out |= {tuple(sorted(e)) for e in zip(way, way[1:], strict=False)}
    return out


def found(spark, segments, grid=1.0):
    rows = [("a", *map(float, r)) for r in segments]
    return {((r.ax, r.ay), (r.bx, r.by)) for r in noding.noded_whole(spark.createDataFrame(rows, KEYED).repartition(3), "k", grid).collect()}


@pytest.mark.parametrize(("segments", "parts"), [
    ([(0, 0, 10, 10), (0, 10, 10, 0)], 4),  # a crossing
    ([(0, 0, 10, 0), (5, 0, 5, 7)], 3),  # a T
    ([(0, 0, 10, 0), (4, 0, 20, 0), (20, 0, 4, 0)], 3),  # overlaps
    ([(0, 0, 10, 10), (0, 10, 10, 0), (5, 0, 5, 10), (0, 5, 10, 5)], 8),  # all through one point
    ([(0, 0, 10, 3), (10, 3, 0, 0), (2, 2, 2, 2)], 1),  # repeats and points
])
def test_nodes(spark, segments, parts):
    got = found(spark, segments)
    assert got == plain_noded(segments) and len(got) == parts


def test_random_nodes(spark):
    rnd = random.Random(2)
    segments = [tuple(rnd.randrange(-40, 40) for _ in range(4)) for _ in range(60)] + [(-300, -299, 310, 305), (-300, 5, 310, 6)]
    got = found(spark, segments)
    want = plain_noded(segments)
    while (again := plain_noded([(*a, *b) for a, b in want])) != want:
        want = again
    assert got == want
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    for (a, b), (c, d) in combinations(got, 2):  # parts meet at their ends only
        signs = [np.sign(v) for v in (cross(a, b, c), cross(a, b, d), cross(c, d, a), cross(c, d, b))]
        assert not (signs[0] * signs[1] < 0 and signs[2] * signs[3] < 0)
        for p, (q, r) in ((c, (a, b)), (d, (a, b)), (a, (c, d)), (b, (c, d))):
            assert p in (q, r) or cross(q, r, p) or not (min(q, r) < p < max(q, r))


def test_nodes_by_key_and_grid(spark):
    rows = [("a", 0.0, 0.0, 1.0, 1.0), ("b", 0.0, 1.0, 1.0, 0.0), ("a", 0.0004, 0.0, 0.0, 0.0), ("a", None, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 1.0, 0.0), (None, 0.5, -1.0, 0.5, 1.0)]
    got = sorted((r.k or "", round(r.length, 3)) for r in noding.noded(spark.createDataFrame(rows, KEYED), "k").collect())
    assert got == [("", 0.5), ("", 0.5), ("", 1.0), ("", 1.0), ("a", 1.414), ("b", 1.414)]
    assert noding.noded(spark.createDataFrame([], KEYED), "k").count() == 0
    with pytest.raises(Exception, match="2\\^30"):
        noding.noded(spark.createDataFrame([("a", 0.0, 0.0, 2e6, 1.0), ("a", 0.0, 1.0, 2e6, 0.0)], KEYED), "k").count()


WHOLE = "k string, ax long, ay long, bx long, by long"


def walked(edges):
    """Lines by walking from corners that don't have two edges; then rings."""
    s = {tuple(sorted((e[:2], e[2:]))) for e in edges if e[:2] != e[2:]}
    at = defaultdict(set)
    for a, b in s:
        at[a].add(b)
        at[b].add(a)
    left, out = set(s), []
    starts = sorted(p for p in at if len(at[p]) != 2)
    for ring, roots in ((False, starts), (True, sorted(at))):
        for p in roots:
            for q in sorted(at[p]):
                line = [p, q]
                if tuple(sorted(line)) not in left:
                    continue
                left.discard(tuple(sorted(line)))
                while len(at[line[-1]]) == 2 and line[-1] != line[0]:
                    (n,) = at[line[-1]] - {line[-2]}
                    line.append(n)
                    left.discard(tuple(sorted(line[-2:])))
                out.append((ring or line[0] == line[-1], tuple(min(line, line[::-1]))))
    return sorted(out)


def chained(spark, edges):
    rows = chains.chained(spark.createDataFrame([("a", *e) for e in edges], WHOLE).repartition(4), "k").collect()
    lines = defaultdict(list)
    for r in rows:
        lines[r.line].append((r.seq, (r.x, r.y), r.ring))
    out = []
    for name, points in lines.items():
        points.sort()
        assert [p[0] for p in points] == list(range(len(points)))
        assert name == " ".join(str(v) for p in points[:2] for v in p[1])
        out.append((points[0][2], tuple(p[1] for p in points)))
    return sorted(out)


def test_chains(spark):
    path = [(i, i * i % 7, i + 1, (i + 1) ** 2 % 7) for i in range(37)]
    ring = [(100, 0, 105, 1), (105, 1, 103, 9), (103, 9, 100, 0), (200, 0, 201, 0), (201, 0, 201, 1), (201, 1, 200, 1), (200, 1, 200, 0)]
    star = [(50, 50, 60, 60), (50, 50, 40, 60), (50, 50, 50, 30), (50, 30, 51, 20)]
    eye = [(300, 0, 310, 5), (310, 5, 320, 0), (300, 0, 310, -5), (310, -5, 320, 0), (320, 0, 330, 0)]  # a loop that hangs on one node
    edges = path + ring + star + eye + [e[2:] + e[:2] for e in ring[:2]] + [(1, 1, 1, 1)]
    got = chained(spark, edges)
    assert got == walked(edges) and sum(r for r, _ in got) == 3
    rnd = random.Random(4)
    for _ in range(2):
        edges = [(x, y, x + dx, y + dy) for x in range(9) for y in range(9) for dx, dy in ((1, 0), (0, 1), (1, 1)) if rnd.random() < 0.3]
        assert chained(spark, edges) == walked(edges)
    assert chains.chained(spark.createDataFrame([], WHOLE), "k").count() == 0


def test_a_long_line_takes_few_rounds(spark, monkeypatch):
    n = 20_000
    rounds = []
    monkeypatch.setattr(chains, "drop", lambda *d: rounds.append(1))
    edges = spark.range(n).select(F.lit("a").alias("k"), F.col("id").alias("ax"), (F.col("id") % 3).alias("ay"), (F.col("id") + 1).alias("bx"), ((F.col("id") + 1) % 3).alias("by")).repartition(5)
    got = chains.chained(edges, "k").agg(F.countDistinct("line"), F.max("seq"), F.count("*"), F.sum((F.col("x") == F.col("seq")).cast("int"))).first()
    assert tuple(got) == (1, n, n + 1, n + 1) and len(rounds) <= 18
