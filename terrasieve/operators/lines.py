"""Line layers: grid join, split by a buffered layer, clip to boxes, dissolve, per-chip metrics.

Edges come as (id, ax, ay, bx, by). Layers are joined by grid cells, so every join is an equi-join that Spark can shuffle and split; a
pair is reported in one cell alone, so no distinct follows. An edge much longer than a cell is joined part by part, so it lists cells in
line with its length, not with its box.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.geometry import capsule_intervals, clip_interval, edge_length
from terrasieve.functions.scalars import f1_score, require_same_crs, safe_ratio
from terrasieve.functions.staging import shuffled

EDGE = ("ax", "ay", "bx", "by")


#: Edges of more cells than this are joined in parts.
SPAN = 4


def cut_edges(df: DataFrame, cell: float, margin: float = 0.0) -> DataFrame:
    """df with the box (_x0, _x1, _y0, _y1) of each edge, widened by margin; an edge longer than SPAN cells comes several times, each time with
    the box of a part of it. Columns stay as they are, and so does an edge with a null corner, whose box is null. _t0 and _t1 are the shares of the edge at which the part begins and ends."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    n = F.coalesce(F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(dx), F.abs(dy)) / (SPAN * cell)).cast("int")), F.lit(1))
    d = df.select("*", n.alias("_n")).select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_part"))
    many = F.col("_n") > 1
    slack = F.when(many, F.lit(1e-6 * cell)).otherwise(F.lit(0.0)) + margin  # rounding of the parts' ends
    at = lambda k, c, v: F.when(many, F.col(f"a{c}") + v * (F.col("_part") + k) / F.col("_n")).otherwise(F.col(f"{'ab'[k]}{c}"))
    box = {f"_{c}{i}": (f(at(0, c, v), at(1, c, v)) + sign * slack) for c, v in (("x", dx), ("y", dy)) for i, f, sign in ((0, F.least, -1), (1, F.greatest, 1))}
    return d.select("*", *[v.alias(k) for k, v in box.items()], (F.col("_part") / F.col("_n")).alias("_t0"), ((F.col("_part") + 1) / F.col("_n")).alias("_t1")).drop("_n", "_part")


def grid_join(left: DataFrame, right: DataFrame, cell: float, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs whose boxes (_x0, _x1, _y0, _y1) overlap and that have equal columns `on` (null equals null); right's columns get the prefix r.
    Boxes are closed. A crowded cell is a hot key of an equi-join, which adaptive execution splits. Both sides are shuffled, as nobody has
    counted the cells that they list."""

    def spread(df: DataFrame) -> DataFrame:
        c = df.select("*", *[F.floor(F.col(k) / cell).alias(f"_c{k[1:]}") for k in ("_x0", "_x1", "_y0", "_y1")])
        c = c.select("*", F.explode(F.sequence("_cx0", "_cx1")).alias("_cx"))
        return c.select("*", F.explode(F.sequence("_cy0", "_cy1")).alias("_cy")).drop("_cx1", "_cy1")

    a, b = spread(left), spread(right)
    b = b.select(*[F.col(c).alias(f"r{c}") for c in b.columns])
    first = (F.col("_cx") == F.greatest("_cx0", "r_cx0")) & (F.col("_cy") == F.greatest("_cy0", "r_cy0"))
    overlap = (F.col("_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("_x1")) & (F.col("_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("_y1"))
    same = (F.col("_cx") == F.col("r_cx")) & (F.col("_cy") == F.col("r_cy"))
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"r{c}"))
    out = a.join(shuffled(b), same & first & overlap)
    return out.drop(*[c for c in out.columns if c.lstrip("r").startswith("_")])


def with_crs(layer: DataFrame, crs: str) -> DataFrame:
    """layer labelled with a reference system; coordinates stay as they are."""
    return layer.withColumn("crs", F.lit(crs))


def same_crs(a: DataFrame, b: DataFrame) -> None:
    """ValueError where labelled layers have different reference systems, or one of them several. Layers without a label pass."""
    if "crs" in a.columns and "crs" in b.columns:
        found = [r[0] for r in a.select("crs").unionByName(b.select("crs")).distinct().limit(2).collect()]
        for other in found[1:]:
            require_same_crs(found[0], other)


def split_by_buffer(source: DataFrame, mask: DataFrame, distance: float, cell: float = 20.0) -> DataFrame:
    """Per source edge (ids are unique): id, length, inside, outside: the lengths within `distance` of any mask edge and beyond it. An edge
    of no length has 0 of both. Labelled layers must have one reference system."""
    same_crs(source, mask)
    source = source.select("id", *EDGE)
    # every source edge once with its length, and each interval that a mask edge covers: edges with nothing near them need no join back
    base = source.select("id", edge_length(*map(F.col, EDGE)).alias("length"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    rows = base.unionByName(covered_intervals(source, mask, distance, cell), allowMissingColumns=True)
    before = Window.partitionBy("id").orderBy(F.col("lo").asc_nulls_first(), "hi").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("hi").over(before), F.col("lo"))
    part = F.coalesce(F.greatest(F.lit(0.0), F.col("hi") - F.greatest("lo", reach)), F.lit(0.0))
    sums = rows.select("id", "length", part.alias("part")).groupBy("id").agg(F.max("length").alias("length"), F.sum("part").alias("part"))
    return sums.select("id", "length", (F.col("length") * F.col("part")).alias("inside"), (F.col("length") * (1 - F.col("part"))).alias("outside"))


def covered_intervals(source: DataFrame, mask: DataFrame, distance: float, cell: float = 20.0) -> DataFrame:
    """(id, lo, hi) of each source edge and mask edge near it: the part of the edge, from 0 to 1, within `distance`. Pairs whose boxes
    overlap, but that are further apart, give no row. An interval may come more than once where both edges are long."""
    kind = source.schema["id"].dataType.simpleString()
    near = grid_join(cut_edges(source.select("id", *EDGE), cell), cut_edges(mask.select(*EDGE), cell, distance), cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xy = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]], axis=1).astype(float)
            low, high = capsule_intervals(xy[:, :4], xy[:, 4:], distance)
            found = pa.array(low <= high)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(found), pa.array(low).filter(found), pa.array(high).filter(found)], names=["id", "lo", "hi"])

    return near.select("id", *EDGE, *[f"r{c}" for c in EDGE]).mapInArrow(run, f"id {kind}, lo double, hi double")


def line_totals(predicted: DataFrame, truth: DataFrame, distance: float) -> DataFrame:
    """One row: tp, fp, fn lengths, precision, recall, f1. Recall sets predicted length inside against true length outside."""
    p = split_by_buffer(predicted, truth, distance).agg(F.sum("inside").alias("tp"), F.sum("outside").alias("fp"))
    t = split_by_buffer(truth, predicted, distance).agg(F.sum("outside").alias("fn"))
    both = p.unionByName(t, allowMissingColumns=True).agg(*[F.coalesce(F.sum(k), F.lit(0.0)).alias(k) for k in ("tp", "fp", "fn")])
    rated = both.withColumn("precision", safe_ratio(F.col("tp"), F.col("fp"))).withColumn("recall", safe_ratio(F.col("tp"), F.col("fn")))
    return rated.withColumn("f1", f1_score(F.col("precision"), F.col("recall")))


def on_lines(lines: DataFrame, keys: list[str], grid: float) -> DataFrame:
    """Edges with corners rounded to whole multiples of grid, by supporting line: keys, ux, uy (direction in lowest terms), off, n2, the lesser
    end (lo.at, lo.x, lo.y) and the greater end hi along it, and turned: whether the edge runs from the greater end to the lesser. Whole
    numbers, so edges of one line have equal ux, uy and off. Edges that the rounding leaves no length go, and so do null corners. ValueError
    where they outgrow 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(_all_set(b, EDGE))
            ax, ay, bx, by = (np.floor(b.column(c).to_numpy(zero_copy_only=False).astype(float) / grid + 0.5) for c in EDGE)
            dx, dy = bx - ax, by - ay
            if len(ax) and max(np.abs(v).max() for v in (ax, ay, bx, by)) * max(1.0, np.abs(dx).max(), np.abs(dy).max()) * 2 >= 2.0**62:
                raise ValueError("coordinates over grid outgrow 64 bits")
            ax, ay, bx, by, dx, dy = (v.astype(np.int64) for v in (ax, ay, bx, by, dx, dy))
            holds = (dx != 0) | (dy != 0)
            turned = (dx < 0) | ((dx == 0) & (dy < 0))
            g = np.maximum(np.gcd(dx, dy), 1) * np.where(turned, -1, 1)
            ux, uy = dx // g, dy // g
            lo_x, lo_y, hi_x, hi_y = np.where(turned, bx, ax), np.where(turned, by, ay), np.where(turned, ax, bx), np.where(turned, ay, by)
            end = lambda x, y: pa.StructArray.from_arrays([pa.array(v) for v in (ux * x + uy * y, x, y)], names=["at", "x", "y"])
            columns = [*(b.column(k) for k in keys), *map(pa.array, (ux, uy, ux * ay - uy * ax)), end(lo_x, lo_y), end(hi_x, hi_y), pa.array(ux * ux + uy * uy), pa.array(turned)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "ux", "uy", "off", "lo", "hi", "n2", "turned"]).filter(pa.array(holds))

    kinds = ", ".join(f"`{k}` {lines.schema[k].dataType.simpleString()}" for k in keys)
    spot = "struct<at:long,x:long,y:long>"
    read = lines.select(*keys, *[F.col(c).cast("double").alias(c) for c in EDGE])
    return read.mapInArrow(run, f"{kinds}, ux long, uy long, off long, lo {spot}, hi {spot}, n2 long, turned boolean")


def _all_set(b: pa.RecordBatch, names: tuple[str, ...]) -> pa.Array:
    return pa.array(~np.any([b.column(c).is_null().to_numpy(zero_copy_only=False) for c in names], axis=0))


def dissolve_parts(lines: DataFrame, key: str, grid: float = 1e-3) -> DataFrame:
    """Per key, the lines without overlaps, one row a part: key, ax, ay, bx, by, length. Edges of one supporting line that overlap or touch
    are one part; lines that only cross stay whole. Corners are rounded to multiples of grid first, and edges of no length then go.
    Null corners go too. Coordinates over grid that outgrow 64 bits raise an error."""
    d = on_lines(lines, [key], grid)
    line = (key, "ux", "uy", "off")
    before = Window.partitionBy(*line).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("new", (F.coalesce(F.max("hi.at").over(before), F.col("lo.at") - 1) < F.col("lo.at")).cast("int"))
    d = d.withColumn("part", F.sum("new").over(Window.partitionBy(*line).orderBy("lo", "hi")))  # equal intervals are peers
    parts = d.groupBy(*line, "part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("n2").alias("n2"))
    ends = [(F.col(f"{e}.{c}") * F.lit(grid)).alias(n) for n, e, c in (("ax", "lo", "x"), ("ay", "lo", "y"), ("bx", "hi", "x"), ("by", "hi", "y"))]
    return parts.select(key, *ends, ((F.col("hi.at") - F.col("lo.at")) / F.sqrt("n2") * grid).alias("length"))


def dissolve(lines: DataFrame, key: str, grid: float = 1e-3) -> DataFrame:
    """Per key: the length of its lines without overlaps, by the rules of dissolve_parts. Columns key, length."""
    return dissolve_parts(lines, key, grid).groupBy(key).agg(F.sum("length").alias("length"))


def lines_in_box(lines: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """The edges that meet a closed box (xmin, ymin, xmax, ymax), whole: nothing is clipped. No join and no shuffle."""
    c = F.col
    lo, hi = clip_interval((c("ax"), c("ay")), (c("bx"), c("by")), tuple(F.lit(float(x)) for x in box))
    return lines.filter(lo <= hi)


def areas_in_box(edges: DataFrame, box: tuple[float, float, float, float], key: str = "id") -> DataFrame:
    """key of the areas, given by the edges of their rings, that meet a closed box: an edge does, or the box lies inside, which is so when a
    ray from its corner crosses the rings an odd number of times."""
    x, y = float(box[0]), float(box[1])
    c = F.col
    lo, hi = clip_interval((c("ax"), c("ay")), (c("bx"), c("by")), tuple(F.lit(float(v)) for v in box))
    crosses = ((c("ay") > y) != (c("by") > y)) & ((c("bx") - c("ax")) * (y - c("ay")) / F.nullif(c("by") - c("ay"), F.lit(0.0)) + c("ax") > x)
    met = edges.groupBy(key).agg(F.max((lo <= hi).cast("int")).alias("meets"), F.sum(F.coalesce(crosses, F.lit(False)).cast("int")).alias("crossings"))
    return met.filter("meets = 1 or crossings % 2 = 1").select(key)


def clip_to_boxes(lines: DataFrame, boxes: DataFrame, cell: float = 32.0) -> DataFrame:
    """Pairs of a box and an edge that meets it, with the boxes' columns prefixed by r and the edge's length inside as `clipped`. A long edge
    comes part by part, with what of each part is inside."""
    same_crs(lines, boxes)
    b = boxes.withColumns({"_x0": F.col("xmin"), "_x1": F.col("xmax"), "_y0": F.col("ymin"), "_y1": F.col("ymax")})
    near = grid_join(cut_edges(lines, cell).withColumns({"part_t0": F.col("_t0"), "part_t1": F.col("_t1")}), b, cell)
    c = F.col
    lo, hi = clip_interval((c("ax"), c("ay")), (c("bx"), c("by")), (c("rxmin"), c("rymin"), c("rxmax"), c("rymax")))
    share = F.greatest(F.lit(0.0), F.least(hi, c("part_t1")) - F.greatest(lo, c("part_t0")))
    return near.withColumn("clipped", edge_length(c("ax"), c("ay"), c("bx"), c("by")) * share).drop("part_t0", "part_t1")


def chip_metrics(chips: DataFrame, lines: DataFrame, keep: str = "keep") -> DataFrame:
    """chips (file_name, box, flag column `keep`) with tp, fp, fn lengths, precision, recall, f1_score: 0 for kept chips that no line meets,
    null for the others. lines: (pred_result, edge). Chips with one file_name each count all lines of their box; the merge back by name
    multiplies them, as a join by name does."""
    asked = chips.filter(keep).select("file_name", "xmin", "ymin", "xmax", "ymax")
    clipped = clip_to_boxes(lines.select("pred_result", "ax", "ay", "bx", "by"), asked)
    sums = clipped.groupBy(F.col("rfile_name").alias("file_name")).agg(*[F.sum(F.when(F.col("pred_result") == k, F.col("clipped")).otherwise(0.0)).alias(f"{k.lower()}_length") for k in ("TP", "FP", "FN")])
    found = asked.select("file_name").distinct().join(sums, "file_name", "left").na.fill(0.0)
    rated = found.withColumn("precision", safe_ratio(F.col("tp_length"), F.col("fp_length"))).withColumn("recall", safe_ratio(F.col("tp_length"), F.col("fn_length")))
    rated = rated.withColumn("f1_score", f1_score(F.col("precision"), F.col("recall")))
    stale = [c for c in rated.columns if c != "file_name"]
    return chips.drop(*stale).join(rated, "file_name", "left")
