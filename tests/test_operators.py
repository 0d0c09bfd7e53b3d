"""Edge rules by hand, and geometry against a dense sampler."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasieve.functions import scalars as S
from terrasieve.operators import lines as L
from terrasieve.operators import raster as R
from terrasieve.operators import selection as C
from terrasieve.operators.kernels import paths, thin

EDGE = "id long, ax double, ay double, bx double, by double"


def sampled(edge, mask, d, n=4000):
    t = (np.arange(n) + 0.5) / n
    x, y = edge[0] + t * (edge[2] - edge[0]), edge[1] + t * (edge[3] - edge[1])
    near = np.zeros(n, dtype=bool)
    for ax, ay, bx, by in mask:
        v = np.array([bx - ax, by - ay])
        u = np.clip(((x - ax) * v[0] + (y - ay) * v[1]) / max(v @ v, 1e-12), 0, 1)
        near |= np.hypot(x - ax - u * v[0], y - ay - u * v[1]) <= d
    return near.mean() * np.hypot(edge[2] - edge[0], edge[3] - edge[1])


@pytest.mark.parametrize("cell", [5.0, 40.0])
def test_split_against_sampler(spark, cell):
    rng = np.random.default_rng(1)
    edges, mask = rng.integers(0, 60, (25, 4)).astype(float), rng.integers(0, 60, (30, 4)).astype(float)
    edges[:, 2] += 0.5
    mask[0, 2:] = mask[0, :2]  # a point
    frame = lambda a: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(a)], EDGE)
    rows = L.split_by_buffer(frame(edges), frame(mask), 3.0, cell).collect()
    assert len(rows) == 25
    for r in rows:
        assert abs(r.inside - sampled(edges[r.id], mask, 3.0)) < 0.1 and abs(r.inside + r.outside - r.length) < 1e-9


def test_clip_sums_to_the_whole(spark):
    rng = np.random.default_rng(2)
    edges = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.integers(0, 48, (40, 4)))], EDGE)
    boxes = spark.createDataFrame([(f"{i}-{j}", i * 24 - 0.5, j * 24 - 0.5, i * 24 + 23.5, j * 24 + 23.5) for i in range(3) for j in range(3)], "file_name string, xmin double, ymin double, xmax double, ymax double")
    total = edges.agg(F.sum(F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2))).first()[0]
    assert abs(L.clip_to_boxes(edges, boxes).agg(F.sum("clipped")).first()[0] - total) < 1e-6


def test_dissolve_merges_overlaps(spark):
    lines = spark.createDataFrame([("a", 0.0, 0.0, 4.0, 0.0), ("a", 6.0, 0.0, 2.0, 0.0), ("a", 0.0, 0.0, 3.0, 4.0), ("b", 1.0, 1.0, 1.0, 1.0)], "k string, ax double, ay double, bx double, by double")
    assert {r.k: r.length for r in L.dissolve(lines, "k").collect()} == {"a": 11.0}


def test_dissolve_of_floats(spark):
    rows = [("a", 0.0, 0.0, 1.5, 0.5), ("a", 0.75, 0.25, 3.0, 1.0), ("a", 0.0, 0.0, 0.5, 0.5), ("a", 0.5, 0.5, 0.25, 0.25), ("b", 2.0, 2.0, 2.0, 2.0), ("b", 0.0, 0.0, 0.0, 1.0), ("b", 0.0, 3.0, 0.0, 2.0), ("b", None, 3.0, 0.0, 2.0)]
    parts = L.dissolve_parts(spark.createDataFrame(rows, "k string, ax double, ay double, bx double, by double"), "k").collect()
    got = sorted((r.k, *(round(r[c], 6) for c in L.EDGE), round(r.length, 4)) for r in parts)
    assert got == [("a", 0.0, 0.0, 0.5, 0.5, 0.7071), ("a", 0.0, 0.0, 3.0, 1.0, 3.1623), ("b", 0.0, 0.0, 0.0, 1.0, 1.0), ("b", 0.0, 2.0, 0.0, 3.0, 1.0)]


def test_split_of_edges_without_length(spark):
    point = spark.createDataFrame([(1, 2.0, 2.0, 2.0, 2.0), (2, 0.0, 0.0, 10.0, 0.0)], EDGE)
    mask = spark.createDataFrame([(1, 2.0, 1.0, 2.0, 1.0)], EDGE)
    got = {r.id: (r.length, round(r.inside, 6)) for r in L.split_by_buffer(point, mask, 3.0).collect()}
    assert got == {1: (0.0, 0.0), 2: (10.0, round(2 + 8**0.5, 6))}
    assert L.split_by_buffer(point, mask.limit(0), 3.0).agg(F.sum("inside")).first()[0] == 0
    with pytest.raises(ValueError, match="reference systems"):
        L.split_by_buffer(L.with_crs(point, "EPSG:1"), L.with_crs(mask, "EPSG:2"), 3.0)


def test_boxes(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
    edges = spark.createDataFrame([(7, *a, *b) for a, b in zip(ring, ring[1:], strict=False)], EDGE)
    inside = lambda *box: [r.id for r in L.areas_in_box(edges, box).collect()]
    assert inside(4, 4, 5, 5) == [7] and inside(10, 10, 12, 12) == [7] and inside(10.5, 4, 12, 5) == [] and inside(-5, -5, 20, 20) == [7]
    assert L.lines_in_box(edges, (4, 4, 5, 5)).count() == 0 and L.lines_in_box(edges, (9, 9, 12, 12)).count() == 2


def test_medians(spark):
    rng = np.random.default_rng(3)
    for values in ([1.0], [2.0, 4.0], [5.0] * 7, [*rng.normal(size=301)], [*rng.integers(0, 4, 200).astype(float)], [0.0] * 50 + [1e9, None]):
        rows = [("m", None if v is None else float(v)) for v in values]
        got = R.medians(spark.createDataFrame(rows, "metric string, v double"), 16).first().median
        assert got == np.median([v for v in values if v is not None])


def test_medians_of_any_spread(spark):
    """One value far away, many sizes of numbers, both signs: few values are left to sort, and the middle is exact."""
    rng = np.random.default_rng(5)
    for values in (np.r_[rng.normal(size=3001) * 1e-3, 1e300], rng.normal(size=2000) * 10.0 ** rng.integers(-300, 300, 2000), np.r_[[-1.5e308, 1.5e308] * 20, rng.normal(size=500)], np.r_[[0.0] * 300, [1e300] * 300], np.r_[np.arange(800.0), [np.inf] * 3]):
        rows = [("m", float(v)) for v in values] + [("other", 1.0)]
        got = {r.metric: r.median for r in R.medians(spark.createDataFrame(rows, "metric string, v double").repartition(3), 4096, 20).collect()}
        assert got == {"m": np.median(values / 2) * 2, "other": 1.0}


def test_order_and_names(spark):
    files = spark.createDataFrame([(f"f{i:03}", i % 5) for i in range(100)], "path string, n int").repartition(7)
    assert [r.z_order for r in C.in_order(files, "path").orderBy("path").collect()] == list(range(100))
    assert C.latest_by_time(spark.createDataFrame([("a.x", 3), ("b.x", 3), ("c.y", 9)], "file_name string, modified int"), ".x").first()[0] == "b.x"


def test_flags_and_ratios(spark):
    rows = spark.createDataFrame([(" True",), ("1",), ("YES ",), ("no",), ("1.0",), (None,)], "f string").select(S.truthy(F.col("f")).alias("t")).collect()
    assert [r.t for r in rows] == [True, True, True, False, False, False]
    one = spark.range(1).select(S.safe_ratio(F.lit(0.0), F.lit(0.0)).alias("z"), S.f1_score(F.lit(0.0), F.lit(0.0)).alias("f"), S.base_name(F.lit("/a/b.tif/")).alias("n")).first()
    assert (one.z, one.f, one.n) == (0.0, 0.0, "b.tif")


def test_overlap_rules(spark):
    rows = [([0.5, 0.6, 0.2], [0, 1, 1]), ([0.1], [0]), ([None, 0.9], [1, None])]
    got = spark.createDataFrame(rows, "p array<double>, t array<int>").select(R.overlap_counts(F.col("p"), F.col("t")).alias("n")).select("n", R.iou(F.col("n")).alias("i"), R.dice(F.col("n")).alias("d")).collect()
    assert [(r.i, round(r.d, 6)) for r in got] == [(0.5, round(2 / 3, 6)), (1.0, 1.0), (0.0, 0.0)]


def test_thin_and_trace():
    bar = np.zeros((9, 20), dtype=np.uint8)
    bar[3:6, 2:18] = 1
    line = thin(bar)
    assert line.sum() < 20 and line.sum(axis=0).max() == 1
    found = paths(set(zip(*map(np.ndarray.tolist, np.nonzero(line)), strict=True)))
    assert len(found) == 1 and len(found[0]) == line.sum()


def test_histories(spark):
    h = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate([3.0, 2.0, 2.0, 2.5, 1.0])], "run_id string, epoch int, val_loss double")
    assert [r.bad for r in C.early_stop(h, 2).orderBy("epoch").collect()] == [0, 0, 1, 2]
    assert C.plateau_rate(h, 1.0, 1).first().rate == 0.5


def test_early_stop_of_one_hot_run(spark):
    """One run over many ranges stops where a plain loop stops it."""
    rng = np.random.default_rng(9)
    losses = {"hot": (5 + rng.normal(size=2500) - np.arange(2500) / 500).round(2), "b": np.array([3.0, 2.0, 2.0, 2.0]), None: np.array([1.0])}
    rows = [(r, i, None if i % 97 == 5 else float(v)) for r, run in losses.items() for i, v in enumerate(run)]
    h = spark.createDataFrame(rows, "run_id string, epoch int, val_loss double").repartition(6)
    for patience in (2, 60, 10_000):
        want = []
        for r in losses:
            best, bad = None, 0
            for _, i, v in (x for x in rows if x[0] == r):
                is_best = best is None or (v is not None and v < best)
                bad = 0 if is_best else bad + 1
                best = v if is_best and v is not None else best
                want.append((r, i, is_best, bad))
                if bad >= patience:
                    break
        got = C.early_stop(h, patience).collect()
        assert sorted(map(str, ((r.run_id, r.epoch, r.is_best, r.bad) for r in got))) == sorted(map(str, want))


def test_guards_and_stamps(spark):
    one = spark.sql("select timestamp'2024-03-05 06:07:08' as t, array(1, 2, 3) as b")
    assert tuple(one.select(S.stamp(F.col("t")), S.stamp(F.col("t"), S.LOG_STAMP), F.size(S.require_bands(F.col("b")))).first()) == ("20240305_060708", "2024-03-05 06:07:08", 3)
    with pytest.raises(Exception, match="3 bands, not 4"):
        one.select(S.require_bands(F.col("b"), 4)).collect()


def test_split_sizes(spark):
    d = spark.range(103).select(F.col("id").alias("k"))
    sizes = {r.split: r["count"] for r in C.ratio_split(d, "k").groupBy("split").count().collect()}
    assert sizes == {"train": 72, "val": 20, "test": 11}
    with pytest.raises(ValueError):
        C.ratio_split(d, "k", (0.5, 0.2, 0.1))
