"""Rasters on different grids: mosaics at the finest resolution, windows by bounds, and downscaling by any ratio.

An image is a row: z (its place in the mosaic, unique), x0, y0 (map position of its upper left corner), px, py (size of a pixel, above 0; rows
run downwards), width, height, and pixels, row by row. A mosaic is kept as blocks of `block` x `block` pixels: layer, brow, bcol, values,
where NaN stands for nothing. Tasks hold a block, or a tile of a window; neither grows with the mosaic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import counted, shuffled

#: Images of a block that are laid over each other by one task at most, before what comes of them is.
PILE = 1024


@dataclass(frozen=True)
class Grid:
    """A mosaic's grid: upper left corner, pixel size, rows and columns."""

    x0: float
    y0: float
    px: float
    py: float
    rows: int
    cols: int


def finest_grid(images: DataFrame) -> Grid:
    """The grid over all images with the least of their pixel sizes. One row goes to the driver. ValueError without images."""
    right, low = F.col("x0") + F.col("px") * F.col("width"), F.col("y0") - F.col("py") * F.col("height")
    r = images.agg(F.min("x0"), F.max("y0"), F.min("px"), F.min("py"), F.max(right), F.min(low)).first()
    if r[0] is None:
        raise ValueError("a mosaic needs images")
    x0, y0, px, py, x1, y1 = r
    return Grid(x0, y0, px, py, max(1, round((y0 - y1) / py)), max(1, round((x1 - x0) / px)))


def _list(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0)]), pa.float64()))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of all batches; list columns as numpy arrays."""
    for b in batches:
        columns = []
        for c in b.columns:
            if pa.types.is_list(c.type):
                flat, ends = c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()
                null = c.is_null().to_pylist()
                columns.append([None if n else flat[i:j] for n, i, j in zip(null, ends[:-1], ends[1:], strict=True)])
            else:
                columns.append(c.to_pylist())
        yield from zip(*columns, strict=True)


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 64) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) if held else [()] * len(kinds)
        arrays = [_list(list(c)) if pa.types.is_list(k) else pa.array(list(c), k) for c, k in zip(columns, kinds.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    yield batch()


_FLOATS = pa.list_(pa.float64())


def mosaic_blocks(images: DataFrame, grid: Grid, nodata: float | None = None, block: int = 256, pile: int = PILE) -> DataFrame:
    """The mosaic of images on grid by nearest pixels: a mosaic's pixel has the value of the image pixel that its centre lies in; of several the
    image with the greatest z, whose nodata (and null and NaN) lets others through. Blocks without a value are left out. Every image lists the
    blocks that it meets and is laid over them in order of z, `pile` of them a task, then what came of those."""
    top, left = (F.lit(grid.y0) - F.col("y0")) / F.lit(grid.py), (F.col("x0") - F.lit(grid.x0)) / F.lit(grid.px)
    first = lambda c: F.ceil(c - 0.5)  # noqa: E731  # the first centre at or after a position
    d = images.select("z", "x0", "y0", "px", "py", "width", "height", "pixels")
    d = d.withColumns({"r0": first(top), "r1": first(top + F.col("height") * F.col("py") / F.lit(grid.py)) - 1, "c0": first(left), "c1": first(left + F.col("width") * F.col("px") / F.lit(grid.px)) - 1})
    d = d.filter("r0 <= r1 and c0 <= c1")
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / block), F.floor(F.col(b) / block)))
    d = d.select("*", span("r0", "r1").alias("brow")).select("*", span("c0", "c1").alias("bcol"))

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for brow, bcol, z, x0, y0, px, py, width, height, r0, r1, c0, c1, pixels in rows:
            r = np.arange(max(r0, brow * block), min(r1, brow * block + block - 1) + 1)
            c = np.arange(max(c0, bcol * block), min(c1, bcol * block + block - 1) + 1)
            sr = np.floor((y0 - (grid.y0 - (r + 0.5) * grid.py)) / py).astype(int)
            sc = np.floor(((grid.x0 + (c + 0.5) * grid.px) - x0) / px).astype(int)
            values = pixels.astype(float).reshape(height, width)[np.clip(sr, 0, height - 1)][:, np.clip(sc, 0, width - 1)]
            if nodata is not None:
                values = np.where(values == nodata, np.nan, values)
            yield brow, bcol, z, z // pile, int(r[0] - brow * block), int(c[0] - bcol * block), len(r), len(c), values.ravel()

    def lay(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (brow, bcol, own), held in groupby(rows, key=lambda r: r[:3]):
            whole = np.full((block, block), np.nan)
            for _, _, _, _, r0, c0, n, m, values in held:
                part, new = whole[r0 : r0 + n, c0 : c0 + m], values.reshape(n, m)
                np.copyto(part, new, where=~np.isnan(new))
            yield brow, bcol, own, own, 0, 0, block, block, whole.ravel()

    kinds = {"brow": pa.int64(), "bcol": pa.int64(), "z": pa.int64(), "pile": pa.int64(), "r0": pa.int64(), "c0": pa.int64(), "n": pa.int64(), "m": pa.int64(), "values": _FLOATS}
    schema = "brow long, bcol long, z long, pile long, r0 long, c0 long, n long, m long, values array<double>"
    named = d.select("brow", "bcol", F.col("z").cast("long").alias("z"), "x0", "y0", "px", "py", "width", "height", "r0", "r1", "c0", "c1", F.transform("pixels", lambda v: v.cast("double")).alias("pixels"))
    parts = named.mapInArrow(lambda b: _batches(cut(_rows_of(b)), kinds), schema)
    for keys in (("brow", "bcol", "pile"), ("brow", "bcol")):
        # the second time all piles of a block meet in one group, each as one row
        own = parts if len(keys) == 3 else parts.withColumn("z", F.col("pile")).withColumn("pile", F.lit(0).cast("long"))
        dealt = own.repartition(*keys).sortWithinPartitions(*keys, "z").select("brow", "bcol", "pile", "z", "r0", "c0", "n", "m", "values")
        parts = dealt.mapInArrow(lambda b: _batches(lay(_rows_of(b)), kinds, 8), schema)
    some = F.exists("values", lambda v: ~F.isnan(v))
    return parts.filter(some).select(F.lit(0).cast("long").alias("layer"), "brow", "bcol", "values")


def image_blocks(images: DataFrame, key: str, block: int = 256) -> DataFrame:
    """Blocks of single images (key, width, height, pixels), each a layer of its own: layer, brow, bcol, values."""
    d = images.select(F.col(key).cast("long").alias("layer"), "width", "height", F.transform("pixels", lambda v: F.coalesce(v.cast("double"), F.lit(float("nan")))).alias("pixels"))
    span = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(c) - 1) / block)))
    d = d.select("*", span("height").alias("brow")).select("*", span("width").alias("bcol"))
    nan = F.lit(float("nan"))

    def at(i: Column) -> Column:
        r, c = F.col("brow") * block + F.floor(i / block), F.col("bcol") * block + i % block
        return F.when((r < F.col("height")) & (c < F.col("width")), F.get("pixels", (r * F.col("width") + c).cast("int"))).otherwise(nan)

    return d.select("layer", "brow", "bcol", F.transform(F.sequence(F.lit(0), F.lit(block * block - 1)), at).alias("values"))


def block_pixels(blocks: DataFrame, block: int = 256) -> DataFrame:
    """(layer, row, col, value) of every pixel of blocks that has a value."""
    p = blocks.select("layer", "brow", "bcol", F.posexplode("values").alias("i", "value")).filter(~F.isnan("value"))
    return p.select("layer", (F.col("brow") * block + F.floor(F.col("i") / block)).alias("row"), (F.col("bcol") * block + F.col("i") % block).alias("col"), "value")


def axis_weights(first: int, n: int, offset: float, step: float, low: int, count: int, size: int | None) -> np.ndarray:
    """Weights (n x count) of source pixels low … low + count - 1 in output pixels first … first + n - 1 along one axis. An output pixel's centre
    lies at offset + (i + 0.5) * step; source pixels weigh by a triangle about it, a pixel wide to either side, or a step where that is more,
    so that downscaling takes every pixel in. Weights of an output pixel sum to 1 over the pixels of the source (size), or where that is None
    over all there could be."""
    centre = offset + (first + np.arange(n) + 0.5) * step
    reach = max(1.0, step)
    out = np.zeros((n, count))
    for k, c in enumerate(centre):
        i = np.arange(np.floor(c - reach - 0.5), np.ceil(c + reach + 0.5) + 1)
        w = np.maximum(0.0, 1 - np.abs(i + 0.5 - c) / reach)
        if size is not None:
            w = np.where((i >= 0) & (i < size), w, 0.0)
        total = w.sum()
        here = (i >= low) & (i < low + count)
        if total > 0:
            out[k, (i[here] - low).astype(int)] = w[here] / total
    return out


def sampled(blocks: DataFrame, targets: DataFrame, block: int = 256, fill: float | None = 0.0, tile: int = 256, most: int | None = None) -> DataFrame:
    """targets (key long, layer, r_off, c_off, r_step, c_step, rows, cols, src_rows, src_cols) sampled from blocks by axis_weights: key, row0, col0,
    rows, cols, values: tiles of the output. Offsets and steps are in source pixels; src_rows and src_cols are the source's size, or null where
    it has no bounds. What has no value, in the source or beyond it, counts as fill by its weight; with fill None the rest is scaled up instead,
    and NaN stands where there is none. most: how many blocks there are at most, where that is known.

    Every tile lists the blocks that it reaches and is joined with them. Of a block only the rows that the tile reaches leave the join; each pair
    gives its share of the part of the tile that it touches, and shares are added up."""
    cut = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(c) - 1) / tile)))
    t = targets.filter("rows > 0 and cols > 0").select("*", cut("rows").alias("trow")).select("*", cut("cols").alias("tcol"))
    t = t.withColumns({"row0": F.col("trow") * tile, "col0": F.col("tcol") * tile})
    t = t.withColumns({"n": F.least(F.lit(tile), F.col("rows") - F.col("row0")), "m": F.least(F.lit(tile), F.col("cols") - F.col("col0"))})

    def ends(off: str, step: str, start: str, n: str) -> tuple[Column, Column]:
        reach = F.greatest(F.lit(1.0), F.col(step)) + 1
        return F.floor(F.col(off) + F.col(start) * F.col(step) - reach), F.floor(F.col(off) + (F.col(start) + F.col(n)) * F.col(step) + reach)

    for c, of in (("r", ("r_off", "r_step", "row0", "n")), ("c", ("c_off", "c_step", "col0", "m"))):
        t = t.withColumns(dict(zip((f"_{c}0", f"_{c}1"), ends(*of), strict=True)))
        t = t.select("*", F.explode(F.sequence(F.floor(F.col(f"_{c}0") / block), F.floor(F.col(f"_{c}1") / block))).alias(f"_b{c}"))
    b = blocks.select(F.col("layer").alias("_layer"), "brow", "bcol", "values")
    b = shuffled(b) if most is None else counted(b, most, 8 * block * block)
    pairs = t.join(b, (F.col("layer") == F.col("_layer")) & (F.col("_br") == F.col("brow")) & (F.col("_bc") == F.col("bcol")))
    first, last = ([f(F.lit(e), F.col(f"_{c}{i}") - F.col(k) * block).cast("int") for c, k in (("r", "brow"), ("c", "bcol"))] for f, e, i in ((F.greatest, 0, 0), (F.least, block - 1, 1)))
    band = F.slice("values", first[0] * block + 1, (last[0] - first[0] + 1) * block)
    about = ("key", "row0", "col0", "n", "m")
    named = pairs.select(*about, "r_off", "r_step", "c_off", "c_step", F.col("src_rows").cast("long").alias("sr"), F.col("src_cols").cast("long").alias("sc"), "brow", "bcol", first[0].alias("r0"), first[1].alias("c0"), last[1].alias("c1"), band.alias("values"))

    def share(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, row0, col0, n, m, r_off, r_step, c_off, c_step, sr, sc, brow, bcol, r0, c0, c1, values in rows:
            v = values.reshape(-1, block)[:, c0 : c1 + 1]
            there = ~np.isnan(v)
            y = axis_weights(row0, n, r_off, r_step, brow * block + r0, len(v), sr)
            x = axis_weights(col0, m, c_off, c_step, bcol * block + c0, c1 + 1 - c0, sc).T
            own_r, own_c = np.flatnonzero(y.any(axis=1)), np.flatnonzero(x.any(axis=0))
            if len(own_r) and len(own_c):
                i, j = own_r[0], own_c[0]
                y, x = y[i : own_r[-1] + 1], x[:, j : own_c[-1] + 1]
                yield key, row0, col0, n, m, brow, bcol, int(i), int(j), len(y), (y @ np.where(there, v, 0.0) @ x).ravel(), (y @ there.astype(float) @ x).ravel()

    whole = (*about, "brow", "bcol", "i", "j", "k")
    kinds = dict.fromkeys(whole, pa.int64()) | {"total": _FLOATS, "weight": _FLOATS}
    shares = named.mapInArrow(lambda p: _batches(share(_rows_of(p)), kinds), ", ".join(f"{c} long" for c in whole) + ", total array<double>, weight array<double>")
    base = t.dropDuplicates(["key", "row0", "col0"]).select(*[F.col(c).cast("long").alias(c) for c in about])  # tiles that reach no block get fill
    both = shares.unionByName(base, allowMissingColumns=True)

    def add(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (key, row0, col0), held in groupby(rows, key=lambda r: r[:3]):
            total = weight = None
            for _, _, _, n, m, _, _, i, j, k, own, own_weight in held:
                if total is None:
                    total, weight, rows_, cols_ = np.zeros((n, m)), np.zeros((n, m)), n, m
                if own is None:
                    continue
                own, own_weight = own.reshape(k, -1), own_weight.reshape(k, -1)
                part = slice(i, i + k), slice(j, j + own.shape[1])
                total[part] += own
                weight[part] += own_weight
            if fill is None:
                with np.errstate(invalid="ignore", divide="ignore"):
                    out = np.where(weight > 1e-12, total / weight, np.nan)
            else:
                out = total + (1 - weight) * fill
            yield key, row0, col0, rows_, cols_, out.ravel()

    found = {"key": pa.int64(), "row0": pa.int64(), "col0": pa.int64(), "rows": pa.int64(), "cols": pa.int64(), "values": _FLOATS}
    dealt = both.repartition("key", "row0", "col0").sortWithinPartitions("key", "row0", "col0", "brow", "bcol").select(*whole, "total", "weight")
    return dealt.mapInArrow(lambda p: _batches(add(_rows_of(p)), found, 8), "key long, row0 long, col0 long, rows long, cols long, values array<double>")


def window_by_bounds(blocks: DataFrame, grid: Grid, windows: DataFrame, block: int = 256, fill: float = 0.0, tile: int = 256) -> DataFrame:
    """windows (key, xmin, ymin, xmax, ymax, rows, cols) read from a mosaic on grid, bilinear, at their own resolution and also beyond the mosaic,
    where fill stands: sampled's tiles."""
    c = F.col
    where = windows.select(
        F.col("key").cast("long").alias("key"), F.lit(0).cast("long").alias("layer"),
        ((F.lit(grid.y0) - c("ymax")) / F.lit(grid.py)).alias("r_off"), ((c("xmin") - F.lit(grid.x0)) / F.lit(grid.px)).alias("c_off"),
        ((c("ymax") - c("ymin")) / F.lit(grid.py) / c("rows")).alias("r_step"), ((c("xmax") - c("xmin")) / F.lit(grid.px) / c("cols")).alias("c_step"),
        c("rows").cast("long").alias("rows"), c("cols").cast("long").alias("cols"), F.lit(None).cast("long").alias("src_rows"), F.lit(None).cast("long").alias("src_cols"),
    )
    most = (grid.rows // block + 2) * (grid.cols // block + 2)  # an image's pixels may reach a block beyond the grid's rounded size
    return sampled(blocks, where, block, fill, tile, most)


def downscaled(images: DataFrame, key: str, ratio: float, block: int = 256, tile: int = 256) -> DataFrame:
    """images (key, width, height, px, py, pixels) by a ratio: sampled's tiles with out_rows, out_cols (sizes times ratio, cut to whole numbers) and
    out_px, out_py (pixel sizes times old by new size). Pixels beyond the edge don't count. An image of which nothing is left has no row.
    ValueError for a ratio that isn't above 0."""
    if not ratio > 0:
        raise ValueError("the ratio must be above 0")
    size = lambda c: F.floor(F.col(c) * F.lit(float(ratio))).cast("long")
    sized = images.select(F.col(key).cast("long").alias("key"), "width", "height", "px", "py").withColumns({"out_rows": size("height"), "out_cols": size("width")})
    where = sized.select("key", F.col("key").alias("layer"), F.lit(0.0).alias("r_off"), F.lit(0.0).alias("c_off"), (F.col("height") / F.col("out_rows")).alias("r_step"), (F.col("width") / F.col("out_cols")).alias("c_step"), F.col("out_rows").alias("rows"), F.col("out_cols").alias("cols"), F.col("height").alias("src_rows"), F.col("width").alias("src_cols"))
    tiles = sampled(image_blocks(images, key, block), where.filter("rows > 0 and cols > 0"), block, None, tile)
    about = sized.select(F.col("key").alias("_key"), "out_rows", "out_cols", (F.col("px") * F.col("width") / F.col("out_cols")).alias("out_px"), (F.col("py") * F.col("height") / F.col("out_rows")).alias("out_py"))
    return tiles.join(about, F.col("key") == F.col("_key")).drop("_key")


def tile_pixels(tiles: DataFrame) -> DataFrame:
    """(key, row, col, value) of sampled's tiles; NaN as null."""
    p = tiles.select("key", "row0", "col0", "cols", F.posexplode("values").alias("i", "v"))
    return p.select("key", (F.col("row0") + F.floor(F.col("i") / F.col("cols"))).alias("row"), (F.col("col0") + F.col("i") % F.col("cols")).alias("col"), F.when(~F.isnan("v"), F.col("v")).alias("value"))
