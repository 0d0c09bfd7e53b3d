"""Line pieces: lines cut where they enter and leave a buffered layer, the comparison of two layers that comes of it, and its merged lines.

Lines come as edges (id, ax, ay, bx, by) and, if they have several, their place `edge` in the line. Buffers are exact: a point is inside
when it lies within the distance of an edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.geometry import edge_length
from terrasieve.operators.lines import EDGE, covered_intervals, on_lines, same_crs

#: Parts of an edge below this share of it are rounding, not pieces.
LEAST = 1e-9


def _edges(lines: DataFrame) -> DataFrame:
    return lines.select("id", F.col("edge").cast("int").alias("edge") if "edge" in lines.columns else F.lit(0).alias("edge"), *EDGE)


def _along(t: Column, a: str, b: str) -> Column:
    """A coordinate at share t of an edge; the ends are the corners themselves, without rounding."""
    return F.when(t == 0, F.col(a)).when(t == 1, F.col(b)).otherwise(F.col(a) + t * (F.col(b) - F.col(a)))


def line_pieces(source: DataFrame, mask: DataFrame, distance: float, cell: float = 20.0) -> DataFrame:
    """Every source line cut into pieces inside and outside of the buffered mask: id, edge, inside, seq, part, ax, ay, bx, by, length, t0, t1, and
    the source edge as sax, say, sbx, sby. seq counts a line's pieces of one side from 0 in line order; pieces that go on over a corner have one
    part, so (id, inside) is a multi-line and (id, inside, part) a line of it. An edge of no length gives no piece, and neither do null corners.
    (id, edge) is unique.

    Covered intervals and a mark at each of the edge's ends are swept in order along the edge: what the reach so far doesn't touch begins a new
    covered piece, and the gap before it is a piece outside. Nothing is gathered, so an edge with any number of neighbours streams by."""
    same_crs(source, mask)
    edges = _edges(source).dropna(subset=list(EDGE)).filter(edge_length(*map(F.col, EDGE)) > 0)
    near = covered_intervals(edges.select(F.struct("id", "edge").alias("id"), *EDGE), mask.select(*EDGE), distance, cell)
    marks = edges.select("id", "edge", *EDGE, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("lo")).withColumn("hi", F.col("lo"))
    rows = marks.unionByName(near.select("id.id", "id.edge", "lo", "hi"), allowMissingColumns=True)
    order = Window.partitionBy("id", "edge").orderBy("lo", "hi")
    reach = F.coalesce(F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    swept = rows.withColumn("reach", reach).withColumn("fresh", (F.col("lo") > F.col("reach") + LEAST).cast("int"))
    swept = swept.withColumn("group", F.sum("fresh").over(order))  # equal intervals are peers and have one group
    swept = swept.withColumns({c: F.max(c).over(order) for c in EDGE})  # from the mark at the beginning on
    groups = swept.groupBy("id", "edge", "group").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("reach").alias("from"), *[F.max(c).alias(c) for c in EDGE])
    one = lambda inside, a, b: F.struct(F.lit(inside).alias("inside"), F.col(a).alias("t0"), F.col(b).alias("t1"))
    low = F.when(F.col("from") > 0, F.col("from")).otherwise(F.lit(0.0))
    groups = groups.withColumn("from", low).withColumn("lo", F.when(F.col("lo") <= F.col("from") + LEAST, F.col("from")).otherwise(F.col("lo")))
    both = groups.select("id", "edge", *EDGE, F.explode(F.array(one(False, "from", "lo"), one(True, "lo", "hi"))).alias("p"))
    cut = both.filter(F.col("p.t1") - F.col("p.t0") > LEAST).select("id", "edge", "p.*", *EDGE)
    on = Window.partitionBy("id", "inside").orderBy("edge", "t0")
    goes_on = (F.col("t0") == 0) & (F.lag("t1").over(on) == 1) & (F.lag("edge").over(on) == F.col("edge") - 1)
    cut = cut.withColumn("seq", (F.row_number().over(on) - 1).cast("int")).withColumn("begins", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    cut = cut.withColumn("part", (F.sum("begins").over(on.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    ends = [_along(F.col(t), f"a{c}", f"b{c}").alias(f"{e}{c}") for e, t in (("a", "t0"), ("b", "t1")) for c in "xy"]
    length = edge_length(*map(F.col, EDGE)) * (F.col("t1") - F.col("t0"))
    return cut.select("id", "edge", "inside", "seq", "part", *ends, length.alias("length"), "t0", "t1", *[F.col(c).alias(f"s{c}") for c in EDGE])


def comparison(predicted: DataFrame, truth: DataFrame, distance: float, cell: float = 20.0) -> DataFrame:
    """The lines of a comparison, as line_pieces has them, with kind: TP and FP are predicted pieces inside and outside of the buffered truth, FN
    true pieces outside of the buffered prediction. True pieces inside are left out."""
    found = line_pieces(predicted, truth, distance, cell).withColumn("kind", F.when(F.col("inside"), "TP").otherwise("FP"))
    missed = line_pieces(truth, predicted, distance, cell).filter(~F.col("inside")).withColumn("kind", F.lit("FN"))
    return found.unionByName(missed).drop("inside")


def merged_pieces(pieces: DataFrame, grid: float = 1e-3) -> DataFrame:
    """Per kind, the pieces without overlaps: kind, ax, ay, bx, by, length. The supporting line is that of the source edge, whose corners are
    rounded to multiples of grid, so pieces of one line meet in whole numbers however they were cut; their ends stay as they are. Pieces that
    overlap or touch become one; lines that cross stay whole (see noding)."""
    source = pieces.select("kind", "t0", "t1", *[F.col(f"s{c}").alias(c) for c in EDGE])
    d = on_lines(source, ["kind", "t0", "t1"], grid).select("*", (F.col("hi.at") - F.col("lo.at")).alias("span"))
    # t runs from the edge's first corner; on_lines tells whether that is the greater end
    first, last = (F.when(F.col("turned"), 1 - F.col(b)).otherwise(F.col(a)) for a, b in (("t0", "t1"), ("t1", "t0")))
    d = d.select("kind", "ux", "uy", "off", "n2", F.col("lo.x").alias("x"), F.col("lo.y").alias("y"), F.col("lo.at").alias("zero"), (F.col("lo.at") + first * F.col("span")).alias("lo"), (F.col("lo.at") + last * F.col("span")).alias("hi"))
    line = ("kind", "ux", "uy", "off")
    order = Window.partitionBy(*line).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    touch = LEAST * F.greatest(F.lit(1.0), F.abs("lo"))
    d = d.withColumn("fresh", F.coalesce(F.col("lo") > reach + touch, F.lit(True)).cast("int")).withColumn("group", F.sum("fresh").over(order))
    g = d.groupBy(*line, "group").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("n2").alias("n2"), F.min(F.struct("zero", "x", "y")).alias("base"))
    at = lambda c, u, v: ((F.col(f"base.{c}") + (F.col(v) - F.col("base.zero")) / F.col("n2") * F.col(u)) * F.lit(grid))
    return g.select("kind", at("x", "ux", "lo").alias("ax"), at("y", "uy", "lo").alias("ay"), at("x", "ux", "hi").alias("bx"), at("y", "uy", "hi").alias("by"), ((F.col("hi") - F.col("lo")) / F.sqrt("n2") * grid).alias("length"))
