"""Queries over mosaics of different grids, borders of regions, and sampled statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasieve.operators import borders as B
from terrasieve.operators import raster as R
from terrasieve.operators import regrid as G
from terrasieve.operators import selection as C
from terrasieve.operators.kernels import thin_chunks
from terrasieve.plans import fixtures as V
from terrasieve.plans.queries import CHUNK, MASK_BUFFER, QUERIES, query

NODATA = -9999.0


def placed_images(spark: SparkSession, d: str) -> DataFrame:
    """Every vector as an image of 8 x 8 pixels that overlaps its neighbours, with one of two pixel sizes; values below 0 are nodata."""
    k = F.col("vec_id")
    side = F.when(k % 2 == 0, 1.0).otherwise(0.5)
    pixels = F.transform("embedding", lambda v: F.when(v < 0, F.lit(NODATA)).otherwise(v.cast("double")))
    x0, y0 = (k % 50) * 5 + 0.25 * (k % 4), F.expr("vec_id div 50") * 5 + 0.125 * (k % 3)
    return V.table(spark, d, "embeddings").select("vec_id", k.alias("z"), x0.alias("x0"), y0.alias("y0"), side.alias("px"), side.alias("py"), F.lit(8).alias("width"), F.lit(8).alias("height"), pixels.alias("pixels"))


@query
def regrid_mosaic(spark, d):
    """Images of different grids laid over each other at the finest resolution."""
    images = placed_images(spark, d)
    p = G.block_pixels(G.mosaic_blocks(images, G.finest_grid(images), NODATA))
    return p.select("row", "col", F.round("value", 6).alias("value"))


@query
def window_by_bounds(spark, d):
    """A window of 6 x 5 pixels of the mosaic for each supplier, some beyond it."""
    images = placed_images(spark, d)
    grid = G.finest_grid(images)
    k = F.col("s_suppkey")
    x, y = (k * 13 % 260) - 3 + 0.3, 4.6 + (k * 7 % 50)
    w = V.table(spark, d, "supplier").select(k.alias("key"), x.alias("xmin"), (y - 4.7).alias("ymin"), (x + 3.9).alias("xmax"), y.alias("ymax"), F.lit(6).alias("rows"), F.lit(5).alias("cols"))
    p = G.tile_pixels(G.window_by_bounds(G.mosaic_blocks(images, grid, NODATA), grid, w))
    return p.select("key", "row", "col", F.round("value", 6).alias("value"))


@query
def downscale_ratio(spark, d):
    """Every image by 0.3 and by 0.5."""
    images = V.vectors(spark, d).select("vec_id", F.lit(8).alias("width"), F.lit(8).alias("height"), F.lit(0.25).alias("px"), F.lit(0.25).alias("py"), "pixels")
    out = None
    for ratio in (0.3, 0.5):
        tiles = G.downscaled(images, "vec_id", ratio, block=8)
        p = G.tile_pixels(tiles).join(tiles.select(F.col("key").alias("_k"), "out_px").distinct(), F.col("key") == F.col("_k"))
        p = p.select(F.lit(ratio).alias("ratio"), F.col("key").alias("vec_id"), "row", "col", F.round("value", 6).alias("value"), "out_px")
        out = p if out is None else out.unionByName(p)
    return out


def _skeleton(spark: SparkSession, d: str) -> DataFrame:
    return thin_chunks(R.chunked(R.rasterise(V.edges(spark, d), 1.5).filter("row >= 0 and col >= 0"), CHUNK))


@query
def thinned_pixels(spark, d):
    """What thinning leaves of the boundary mask."""
    return _skeleton(spark, d).select("row", "col")


@query
def contour_totals(spark, d):
    """The borders of the thinned mask in numbers."""
    return _totals(_skeleton(spark, d))


@query
def border_contours(spark, d):
    """Threshold, thin by chunk, follow the borders of the whole mosaic and map their corners."""
    return B.border_lines(_skeleton(spark, d), (1.0, 0.0, 0.0, 0.0, 1.0, 0.0), CHUNK, least=5)


@query
def border_totals(spark, d):
    """All borders of the boundary mask: outer ones less holes, points, and sums over them."""
    return _totals(R.rasterise(V.edges(spark, d), MASK_BUFFER).filter("row >= 0 and col >= 0"))


def _totals(pixels: DataFrame) -> DataFrame:
    p = B.border_points(pixels, CHUNK)
    first = F.col("seq") == 0
    sums = (F.sum(F.when(first, F.when(F.col("hole"), -1).otherwise(1))).alias("outer_less_holes"), F.sum(F.when(first, F.col("area"))).alias("area"), F.count(F.lit(1)).alias("points"), F.sum("row").alias("rows"), F.sum("col").alias("cols"))
    return p.agg(*sums)


@query
def scaler_sampled(spark, d):
    """Statistics of each band over a sample of a stated size, picked by a hash of each pixel's place."""
    p = V.pixel_rows(spark, d).select((F.col("col") % 4).alias("band"), "value", F.concat_ws(":", "vec_id", (F.col("row") * 8 + F.col("col")).cast("string")).alias("place"))
    s = C.bottom_k(p, "band", 1000, C.text_hash(F.col("place")))
    counts = s.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    return R.band_statistics(s).join(counts, "band").select("band", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))
