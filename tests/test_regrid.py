"""Mosaics, windows and downscaling against plain loops, whatever the blocks and tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasieve.operators import regrid as G

IMAGE = "z long, x0 double, y0 double, px double, py double, width int, height int, pixels array<double>"
RNG = np.random.default_rng(6)


def image(z, x0, y0, px, py, width, height):
    v = RNG.normal(size=(height, width))
    v[RNG.random((height, width)) < 0.2] = -9
    return z, x0, y0, px, py, width, height, v


IMAGES = [image(0, 0.0, 20.0, 1.0, 1.0, 13, 9), image(5, 4.3, 17.1, 0.5, 0.5, 20, 11), image(2, -3.2, 24.0, 0.75, 0.5, 8, 30), image(9, 6.0, 16.0, 2.0, 2.0, 3, 3), image(3000, 11.1, 12.2, 0.5, 1.0, 5, 5)]


def frame(spark, images=IMAGES):
    return spark.createDataFrame([(*i[:7], [None if v == -9 and k % 2 else float(v) for k, v in enumerate(i[7].ravel())]) for i in images], IMAGE).repartition(3)


def plain_mosaic(g):
    out = np.full((g.rows + 2, g.cols + 2), np.nan)
    for _, x0, y0, px, py, w, h, v in sorted(IMAGES, key=lambda i: i[0]):
        for r in range(g.rows):
            for c in range(g.cols):
                y, x = g.y0 - (r + 0.5) * g.py, g.x0 + (c + 0.5) * g.px
                i, j = int(np.floor((y0 - y) / py)), int(np.floor((x - x0) / px))
                if 0 <= i < h and 0 <= j < w and v[i, j] != -9:
                    out[r, c] = v[i, j]
    return out


def plain_sample(source, r_off, c_off, r_step, c_step, rows, cols, fill):
    """Triangle weights pixel by pixel; fill None: what is missing doesn't count."""
    h, w = source.shape
    out = np.empty((rows, cols))
    for a in range(rows):
        for b in range(cols):
            y, x = r_off + (a + 0.5) * r_step, c_off + (b + 0.5) * c_step
            total = weight = every = 0.0
            for i in range(int(y - max(1, r_step)) - 2, int(y + max(1, r_step)) + 3):
                for j in range(int(x - max(1, c_step)) - 2, int(x + max(1, c_step)) + 3):
                    k = max(0, 1 - abs(i + 0.5 - y) / max(1, r_step)) * max(0, 1 - abs(j + 0.5 - x) / max(1, c_step))
                    every += k
                    if 0 <= i < h and 0 <= j < w and not np.isnan(source[i, j]):
                        total, weight = total + k * source[i, j], weight + k
            out[a, b] = total / every + (1 - weight / every) * fill if fill is not None else total / weight if weight > 1e-12 else np.nan
    return out


def gathered(tiles, rows, cols):
    out = np.full((rows, cols), -1e9)
    for r in G.tile_pixels(tiles).collect():
        assert out[r.row, r.col] == -1e9
        out[r.row, r.col] = np.nan if r.value is None else r.value
    return out


@pytest.mark.parametrize(("block", "pile"), [(4, 3), (64, 1024)])
def test_mosaic(spark, block, pile):
    images = frame(spark)
    g = G.finest_grid(images)
    assert (g.px, g.py, g.x0, g.y0) == (0.5, 0.5, -3.2, 24.0)
    blocks = G.mosaic_blocks(images, g, -9.0, block, pile)
    got = {(r.row, r.col): r.value for r in G.block_pixels(blocks, block).collect()}
    want = plain_mosaic(g)
    assert got == {(r, c): want[r, c] for r, c in zip(*np.nonzero(~np.isnan(want)), strict=True)}


@pytest.mark.parametrize(("block", "tile", "fill"), [(5, 3, 0.0), (64, 256, -2.0)])
def test_windows(spark, block, tile, fill):
    images = frame(spark)
    g = G.finest_grid(images)
    blocks = G.mosaic_blocks(images, g, -9.0, block)
    windows = [(1, 0.3, 14.2, 6.9, 19.9, 7, 9), (2, -10.0, 18.0, 2.0, 30.0, 5, 4), (3, 500.0, 500.0, 501.0, 501.0, 3, 2), (4, 0.0, 10.0, 10.0, 20.0, 40, 40)]
    df = spark.createDataFrame(windows, "key long, xmin double, ymin double, xmax double, ymax double, rows int, cols int")
    tiles = G.window_by_bounds(blocks, g, df, block, fill, tile).cache()
    source = plain_mosaic(g)
    for key, xmin, ymin, xmax, ymax, rows, cols in windows:
        want = plain_sample(source, (g.y0 - ymax) / g.py, (xmin - g.x0) / g.px, (ymax - ymin) / g.py / rows, (xmax - xmin) / g.px / cols, rows, cols, fill)
        assert np.allclose(gathered(tiles.filter(f"key = {key}"), rows, cols), want, atol=1e-9)


@pytest.mark.parametrize("ratio", [0.3, 0.5, 0.37, 1.0, 2.0])
def test_downscaling(spark, ratio):
    """The same at borders of blocks and tiles; sizes are cut as int() cuts them."""
    rng = np.random.default_rng(1)
    pixels = rng.normal(size=(23, 31))
    pixels[3:9, 4:15] = np.nan
    rows = [(7, 31, 23, 0.25, 0.5, [None if np.isnan(v) else float(v) for v in pixels.ravel()]), (8, 1, 1, 1.0, 1.0, [3.0])]
    df = spark.createDataFrame(rows, "id long, width int, height int, px double, py double, pixels array<double>")
    h, w = int(23 * ratio), int(31 * ratio)
    want = plain_sample(pixels, 0.0, 0.0, 23 / h, 31 / w, h, w, None)
    for block, tile in ((256, 256), (7, 4)):
        tiles = G.downscaled(df, "id", ratio, block, tile)
        first = tiles.filter("key = 7").first()
        assert (first.out_rows, first.out_cols) == (h, w) and abs(first.out_px - 0.25 * 31 / w) < 1e-12 and abs(first.out_py - 0.5 * 23 / h) < 1e-12
        assert np.allclose(gathered(tiles.filter("key = 7"), h, w), want, atol=1e-9, equal_nan=True)
        assert tiles.filter("key = 8").count() == (1 if ratio >= 1 else 0)
    with pytest.raises(ValueError):
        G.downscaled(df, "id", 0.0)


def test_empty_mosaic(spark):
    with pytest.raises(ValueError):
        G.finest_grid(frame(spark).limit(0))
    g = G.finest_grid(frame(spark))
    assert G.mosaic_blocks(frame(spark).limit(0), g).count() == 0


def test_windows_take_bands_of_blocks(spark):
    """Of a block only the rows that a window reaches leave the join, and no block is shuffled once a window."""
    grid = G.Grid(0.0, 512.0, 1.0, 1.0, 512, 512)
    at = F.sequence(F.lit(0), F.lit(256 * 256 - 1))
    values = F.transform(at, lambda i: (F.col("bcol") * 256 + i % 256).cast("double"))
    blocks = spark.range(4).select(F.lit(0).cast("long").alias("layer"), F.expr("id div 2").alias("brow"), (F.col("id") % 2).alias("bcol")).withColumn("values", values)
    k = F.col("id")
    windows = spark.range(300).select(k.alias("key"), (k + 100.0).alias("xmin"), (k + 60.0).alias("ymin"), (k + 104.0).alias("xmax"), (k + 63.0).alias("ymax"), F.lit(3).alias("rows"), F.lit(4).alias("cols"))
    tiles = G.window_by_bounds(blocks, grid, windows)
    plan = tiles._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(values" in plan[plan.index("RepartitionByExpression") :]
    got = G.tile_pixels(tiles).agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("value") - (F.col("key") + 100 + F.col("col")))).alias("off")).first()
    assert got.n == 300 * 12 and got.off < 1e-9
