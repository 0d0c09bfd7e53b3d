"""Queries of the line comparison: pieces, merged and noded unions, chained lines, and the report of chips over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasieve.operators import lines as L
from terrasieve.operators import overlay as O
from terrasieve.operators import selection as C
from terrasieve.operators.chains import chained
from terrasieve.operators.noding import noded, noded_whole
from terrasieve.plans import fixtures as V
from terrasieve.plans.queries import BUFFER, QUERIES, flagged, query, r4

#: Map units of the grid that unions are noded on.
GRID = 1e-3


def compared(spark: SparkSession, d: str) -> DataFrame:
    return O.comparison(V.predictions(spark, d), V.edges(spark, d), BUFFER)


def _ends(df: DataFrame, digits: int) -> list:
    return [(F.round(df[c], digits) + F.lit(0.0)).alias(n) for c, n in (("ax", "x0"), ("ay", "y0"), ("bx", "x1"), ("by", "y1"))]


@query
def line_pieces(spark, d):
    """Every piece of the comparison: predicted lines inside and outside of the buffered truth, true lines outside of the buffered prediction."""
    p = compared(spark, d)
    return p.select("id", "kind", "seq", *_ends(p, 4), r4("length").alias("length"))


@query
def piece_totals(spark, d):
    """Lengths by kind before the union, as the comparison's summary has them."""
    return compared(spark, d).groupBy("kind").agg(F.round(F.sum("length"), 3).alias("length"), F.countDistinct("id").alias("lines"), F.count(F.lit(1)).alias("pieces"))


@query
def merged_pieces(spark, d):
    """Pieces of each kind without overlaps."""
    m = O.merged_pieces(compared(spark, d))
    return m.select("kind", *_ends(m, 3), F.round("length", 3).alias("length"))


@query
def noded_parts(spark, d):
    """The noded union of each kind's pieces."""
    n = noded(compared(spark, d), "kind", GRID)
    return n.select("kind", *_ends(n, 3), F.round("length", 4).alias("length"))


@query
def chained_lines(spark, d):
    """Whole lines of each kind's noded union, corner by corner."""
    c = chained(noded_whole(compared(spark, d), "kind", GRID), "kind")
    return c.select("kind", "line", "seq", F.round(F.col("x") * GRID, 3).alias("x"), F.round(F.col("y") * GRID, 3).alias("y"), "ring")


@query
def chip_report_compared(spark, d):
    """Chip metrics over the merged pieces of the comparison, from split to report."""
    m = O.merged_pieces(compared(spark, d)).withColumnRenamed("kind", "pred_result")
    report = C.split_lookup(L.chip_metrics(flagged(spark, d), m), V.members(spark, d))
    cols = ("tp_length", "fp_length", "fn_length", "precision", "recall", "f1_score")
    return report.select("file_name", "dataset_split", "keep", *[F.round(c, 3).alias(c) for c in cols])
