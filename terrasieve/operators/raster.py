"""Rasters as rows: tiling, mosaics, masks, resampling, rotations, pixel metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.geometry import point_edge_distance2
from terrasieve.functions.staging import broadcast_within, drop, stage


def tiles(images: DataFrame, size: int = 512, stride: int = 384) -> DataFrame:
    """images (…, width, height) with a row for each window: col_off, row_off, tile_width, tile_height (cut at the edges)."""
    if not 0 < stride <= size:
        raise ValueError("stride must be above 0 and at most size")
    t = images.filter("width > 0 and height > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("width") - 1, F.lit(stride))).alias("col_off"))
    t = t.select("*", F.explode(F.sequence(F.lit(0), F.col("height") - 1, F.lit(stride))).alias("row_off"))
    return t.select("*", F.least(F.lit(size), F.col("width") - F.col("col_off")).alias("tile_width"), F.least(F.lit(size), F.col("height") - F.col("row_off")).alias("tile_height"))


def mosaic(pixels: DataFrame, order: list[str], nodata: Column) -> DataFrame:
    """(row, col, value): the last pixel in order that isn't nodata. Equal orders: the larger value."""
    seen = pixels.filter(~nodata).groupBy("row", "col").agg(F.max(F.struct(*order, "value")).alias("top"))
    return seen.select("row", "col", F.col("top.value").alias("value"))


def chunked(pixels: DataFrame, size: int) -> DataFrame:
    """pixels with chunk_row and chunk_col, the keys of blocks that are worked on apart."""
    return pixels.select("*", F.floor(F.col("row") / size).alias("chunk_row"), F.floor(F.col("col") / size).alias("chunk_col"))


def rasterise(edges: DataFrame, distance: float) -> DataFrame:
    """(row, col) of unit pixels whose centre lies within distance of an edge. Every edge lists its own candidates, row by row only the
    columns near it, so they grow with its length, not with its box; no join is needed."""
    e = edges.select(*[F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by")])
    c, d = F.col, F.lit(float(distance))
    rows = F.sequence(F.floor(F.least("ay", "by") - d - 0.5).cast("long"), F.ceil(F.greatest("ay", "by") + d).cast("long"))
    e = e.select("*", F.explode(rows).alias("row"))
    rise, centre = F.nullif(c("by") - c("ay"), F.lit(0.0)), c("row") + 0.5
    t = [F.when(rise.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (centre + s * d - c("ay")) / rise))) for s in (-1, 1)]  # where it passes the row's band
    x = [F.coalesce(c("ax") + k * (c("bx") - c("ax")), other) for k, other in zip(t, (c("ax"), c("bx")), strict=True)]
    cols = F.sequence(F.floor(F.least(*x) - d - 0.5).cast("long"), F.ceil(F.greatest(*x) + d).cast("long"))
    e = e.select("*", F.explode(cols).alias("col"))
    near = point_edge_distance2(c("col") + 0.5, centre, c("ax"), c("ay"), c("bx"), c("by")) <= distance * distance
    return e.filter(near).select("row", "col").distinct()


def downscale(pixels: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Mean of n x n blocks; blocks at the edge that aren't whole go (sizes are cut to whole pixels)."""
    g = pixels.groupBy(*keys, F.floor(F.col("row") / n).alias("row"), F.floor(F.col("col") / n).alias("col"))
    return g.agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == n * n).drop("n")


def upsample(images: DataFrame, width: int, height: int, factor: int, array_col: str = "pixels") -> DataFrame:
    """Bilinear: images with a row-major array give (…, row, col, value) on a grid `factor` times as fine. Edges are clamped."""
    grid = images.select("*", F.explode(F.sequence(F.lit(0), F.lit(height * factor - 1))).alias("row"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(width * factor - 1))).alias("col"))
    value = _bilinear(F.col(array_col), width, height, (F.col("row") + 0.5) / factor - 0.5, (F.col("col") + 0.5) / factor - 0.5)
    return grid.withColumn("value", value).drop(array_col)


def rotated(row: Column, col: Column, k: Column, n: int) -> tuple[Column, Column]:
    """Where a pixel of an n x n image stands after k quarter turns."""
    r = F.when(k == 0, row).when(k == 1, n - 1 - col).when(k == 2, n - 1 - row).otherwise(col)
    c = F.when(k == 0, col).when(k == 1, row).when(k == 2, n - 1 - col).otherwise(n - 1 - row)
    return r, c


def turned_mean(pixels: DataFrame, keys: list[str], n: int, scorer) -> DataFrame:
    """Mean over four quarter turns of scorer(value, row, col), each result turned back: (keys, row, col, value)."""
    spun = pixels.select("*", F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("k"))
    r, c = rotated(F.col("row"), F.col("col"), F.col("k"), n)
    return spun.select(*keys, "row", "col", scorer(F.col("value"), r, c).alias("s")).groupBy(*keys, "row", "col").agg(F.avg("s").alias("value"))


def overlap_counts(predicted: Column, target: Column, threshold: float = 0.5) -> Column:
    """Struct (both, p, t) of pixel counts of two arrays: predicted above threshold (strictly), target above 0. Codegen-free fold."""
    pairs = F.zip_with(predicted, target, lambda p, t: F.struct((p > threshold).alias("p"), (t > 0).alias("t")))
    zero = F.struct(F.lit(0).alias("both"), F.lit(0).alias("p"), F.lit(0).alias("t"))
    one = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    return F.aggregate(pairs, zero, lambda s, x: F.struct((s["both"] + one(x["p"] & x["t"])).alias("both"), (s["p"] + one(x["p"])).alias("p"), (s["t"] + one(x["t"])).alias("t")))


def iou(counts: Column) -> Column:
    """1 where both are empty."""
    union = counts["p"] + counts["t"] - counts["both"]
    return F.when(union == 0, F.lit(1.0)).otherwise(counts["both"] / union)


def dice(counts: Column) -> Column:
    total = counts["p"] + counts["t"]
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * counts["both"] / total)


def confusion(predicted: Column, target: Column, threshold: float = 0.5) -> Column:
    """tp, fp, fn or tn of a pixel; a prediction just at the threshold is tn, as it is neither above nor below."""
    return F.when((predicted > threshold) & (target > 0), "tp").when(predicted > threshold, "fp").when((predicted < threshold) & (target > 0), "fn").otherwise("tn")


def _narrowed(counted: DataFrame, ranges: DataFrame, buckets: int, by_size: bool) -> DataFrame:
    """ranges (metric, which, rank, least, most, before, held) cut down to the bucket that holds the rank. by_size: buckets of equal logarithms,
    so that one holds values of about one size; otherwise of equal width."""
    v, least, most = F.col("v"), F.col("least"), F.col("most")
    if by_size:
        spread = lambda c: F.signum(c) * F.when(c == 0, F.lit(0.0)).otherwise(F.log2(F.abs(c)) + 1080)  # noqa: E731  # a double's least is 2^-1074
        v, least, most = (spread(c) for c in (v, least, most))
    share = (v / 2 - least / 2) / (most / 2 - least / 2)
    place = F.when(F.isnan(share), F.lit(buckets - 1)).otherwise(F.least(F.floor(share * buckets), F.lit(buckets - 1)))
    inside = counted.join(broadcast_within(ranges), "metric").filter((F.col("v") >= F.col("least")) & (F.col("v") <= F.col("most")))
    sizes = inside.withColumn("b", place).groupBy("metric", "which", "rank", "before", "b").agg(F.sum("n").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("metric", "which").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    sizes = sizes.withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return sizes.filter("at <= rank and rank < at + n").select("metric", "which", "rank", "least", "most", F.col("at").alias("before"), "held")


def medians(values: DataFrame, buckets: int = 4096, most: int = 100_000) -> DataFrame:
    """values (metric, v) as (metric, median), exact; nulls don't count, NaN is greater than any number. Equal values are counted first. Rounds of
    bucket counts narrow the range about the middle, first by the size of numbers, then by width, until `most` different values at most are
    left in it, which are sorted: six rounds at most with 4096 buckets, however values are spread."""
    counted = stage(values.filter("v is not null").groupBy("metric", "v").agg(F.count(F.lit(1)).alias("n")), "median-counts")
    ends = counted.groupBy("metric").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))  # a row a metric
    both = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.expr(e).alias("rank")) for i, e in enumerate(("(total - 1) div 2", "total div 2"))]))
    ranges = ends.select("metric", both.alias("w"), "least", "most", F.lit(0).cast("long").alias("before"), "held").select("metric", "w.*", "least", "most", "before", "held")
    ranges, by_size = stage(ranges, "median-ranges"), True
    wide = (F.col("held") > most) & (F.col("least") < F.col("most"))
    while not ranges.filter(wide).isEmpty():
        narrow = ranges.filter(~wide).unionByName(_narrowed(counted, ranges.filter(wide), buckets, by_size))
        old, ranges, by_size = ranges, stage(narrow, "median-ranges"), False
        drop(old)
    held = counted.join(broadcast_within(ranges), "metric").filter((F.col("v") >= F.col("least")) & (F.col("v") <= F.col("most")))
    inside = Window.partitionBy("metric", "which").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = held.withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    picked = ranked.filter("at <= rank and rank < at + n").groupBy("metric").agg(F.max(F.when(F.col("which") == 0, F.col("v"))).alias("l"), F.max(F.when(F.col("which") == 1, F.col("v"))).alias("h"))
    return picked.select("metric", (F.col("l") / 2 + F.col("h") / 2).alias("median"))


def five_numbers(df: DataFrame, *names: str) -> DataFrame:
    """Mean, median, least, greatest and population deviation of each column, a row for each."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("v")) for n in names])).alias("m")).select("m.metric", "m.v")
    rest = each.groupBy("metric").agg(F.avg("v").alias("mean"), F.min("v").alias("least"), F.max("v").alias("greatest"), F.stddev_pop("v").alias("std"))
    return rest.join(medians(each), "metric", "left")


def display_scaled(pixels: Column, is_byte: Column) -> Column:
    """An array of pixels as 0 to 1: bytes over 255, others from their least to their greatest."""
    low, high = F.array_min(pixels), F.array_max(pixels)
    return F.when(is_byte, F.transform(pixels, lambda v: v / 255.0)).otherwise(F.transform(pixels, lambda v: (v - low) / (high - low + 1e-8)))


def band_subset(bands: Column, *numbers: int) -> Column:
    """Bands by number from 1, in that order: (1, 2, 3) leaves the colours, (3, 2, 1) turns them round."""
    return F.array(*[F.get(bands, F.lit(n - 1)) for n in numbers])


def by_pixel(bands: Column) -> Column:
    """An array of bands, each an array of pixels, as an array of pixels, each an array of bands."""
    return F.transform(F.sequence(F.lit(0), F.size(F.get(bands, F.lit(0))) - 1), lambda i: F.transform(bands, lambda b: F.get(b, i)))


def window_of(pixels: Column, width: int, height: int, row_off: Column, col_off: Column, rows: int, cols: int, fill: float = 0.0) -> Column:
    """A window of a row-major array, which may lie outside the image; fill stands there."""

    def at(i: Column) -> Column:
        r, c = row_off + F.floor(i / cols), col_off + i % cols
        inside = (r >= 0) & (r < height) & (c >= 0) & (c < width)
        return F.when(inside, F.get(pixels, (r * width + c).cast("int"))).otherwise(F.lit(fill))

    return F.transform(F.sequence(F.lit(0), F.lit(rows * cols - 1)), at)


def _bilinear(pixels: Column, width: int, height: int, y: Column, x: Column) -> Column:
    """The value at a place between pixel centres of a row-major array; edges are clamped."""
    y0, x0 = F.floor(y), F.floor(x)
    fy, fx = y - y0, x - x0

    def at(r: Column, c: Column) -> Column:
        r, c = F.least(F.greatest(r, F.lit(0)), F.lit(height - 1)), F.least(F.greatest(c, F.lit(0)), F.lit(width - 1))
        return F.get(pixels, (r * width + c).cast("int")).cast("double")

    return at(y0, x0) * (1 - fx) * (1 - fy) + at(y0, x0 + 1) * fx * (1 - fy) + at(y0 + 1, x0) * (1 - fx) * fy + at(y0 + 1, x0 + 1) * fx * fy


def upsampled(pixels: Column, width: int, height: int, factor: int) -> Column:
    """A row-major array on a grid `factor` times as fine, bilinear."""
    wide = width * factor
    return F.transform(F.sequence(F.lit(0), F.lit(wide * height * factor - 1)), lambda i: _bilinear(pixels, width, height, (F.floor(i / wide) + 0.5) / factor - 0.5, (i % wide + 0.5) / factor - 0.5))


def add_band(images: DataFrame, extra: DataFrame, key: str, bands: str = "bands") -> DataFrame:
    """images with three bands get the pixels of extra (key, pixels) of the same key as a fourth, zeros where it has none; status is `added`.
    Images with four bands stay as they are (`has four`), and so do others (`skipped`)."""
    own = extra.select(F.col(key).alias("_key"), F.col("pixels").alias("_extra"))
    n = F.size(bands)
    zeros = F.transform(F.get(F.col(bands), F.lit(0)), lambda _: F.lit(0.0))
    joined = images.join(own, F.col(key) == F.col("_key"), "left")
    status = F.when(n == 3, "added").when(n == 4, "has four").otherwise("skipped")
    more = F.when(n == 3, F.concat(F.col(bands), F.array(F.coalesce("_extra", zeros)))).otherwise(F.col(bands))
    return joined.withColumn("status", status).withColumn(bands, more).drop("_key", "_extra")


def band_statistics(pixels: DataFrame, band: str = "band", value: str = "value") -> DataFrame:
    """The scaler: mean and population deviation of each band."""
    return pixels.groupBy(band).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
