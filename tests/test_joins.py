"""Joins go by counted rows, not by the bytes of files."""

import pytest
from pyspark.sql import functions as F

from terrasieve.functions import staging as S
from terrasieve.operators import lines as L
from terrasieve.operators.borders import border_points
from terrasieve.operators.chains import list_ranks
from terrasieve.plans import fixtures as V


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    """Tables of few bytes and many rows: 100,000 parts, of which Spark sees half a megabyte, have 400,000 edges."""
    d = str(tmp_path_factory.mktemp("packed"))
    spark.range(100_000).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{d}/part.parquet")
    spark.range(0, 1_200_000, 1000).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey")).coalesce(1).write.parquet(f"{d}/orders.parquet")
    return d


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_edges_beyond_the_bound_are_not_broadcast(spark, packed):
    p = V.predictions(spark, packed)
    assert "BroadcastExchange" not in plan(p) and p.count() == 1200


def test_few_edges_are_broadcast(spark):
    assert "BroadcastExchange" in plan(V.predictions(spark, "/root/testdata/sf0.001"))


def test_grid_join_shuffles_layers_of_any_size(spark, packed):
    e = V.edges(spark, packed)
    assert "BroadcastExchange" not in plan(L.grid_join(L.cut_edges(e, 20.0), L.cut_edges(e, 20.0, 3.0), 20.0))


def test_chips_tell_their_number(spark, packed):
    c = V.chips(spark, packed)
    assert c.count() == 9 * 2084 == c.select("cx", "cy").distinct().count()
    assert c.agg(F.max("ymin")).first()[0] == 2083 * 24
    assert int(str(c._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > 30 * 9 * 2084


def test_chips_of_no_parts(spark, tmp_path):
    spark.range(0).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    assert V.chips(spark, str(tmp_path)).count() == 0


def test_counted_sides(spark, monkeypatch):
    rows = spark.range(4).select("id", F.struct("id", F.lit("x").alias("t")).alias("s"))
    width = 24 + 8 + 24 + 8 + 64
    assert S.row_bytes(rows.schema) == width
    monkeypatch.setattr(S, "BROADCAST_MB", width / 1000)
    for side, hint in ((S.counted(rows, 1000), "broadcast"), (S.counted(rows, 1001), "merge")):
        assert f"strategy={hint}" in side._jdf.queryExecution().analyzed().toString()


def test_lists_beyond_the_bound_are_ranked_by_shuffles(spark, monkeypatch):
    nodes = spark.range(50).select(F.col("id").alias("node"), F.when(F.col("id") % 10 < 9, F.col("id") + 1).alias("next"), F.col("id").alias("place"))
    monkeypatch.setattr(S, "BROADCAST_MB", 0.0)
    ranks = list_ranks(nodes)
    assert "BroadcastExchange" not in plan(ranks)
    assert sorted(r[:] for r in ranks.collect()) == [(i, i, i // 10 * 10, i // 10 * 10 + 9, i % 10) for i in range(50)]


def test_borders_beyond_the_bound_are_counted_by_shuffles(spark, monkeypatch):
    pixels = spark.range(9).select((3 * F.expr("id div 3")).alias("row"), (3 * (F.col("id") % 3)).alias("col"))
    monkeypatch.setattr(S, "BROADCAST_MB", 0.0)
    points = border_points(pixels, 4)
    assert "BroadcastExchange" not in plan(points)
    assert points.agg(F.count(F.lit(1)), F.sum("area"), F.max("seq"), F.max("n")).first()[:] == (9, 9, 0, 1)
