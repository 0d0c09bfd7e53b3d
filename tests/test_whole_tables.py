"""Queries that cover every row of their tables, against statements of the test's own."""

import duckdb
from test_queries import SF, rounded

from terrasieve.plans.catalog import QUERIES


def held_against(spark, name, sql):
    got = QUERIES[name](spark, SF)
    want = duckdb.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(want.columns).collect()
    assert rounded(rows) == rounded(want.fetchall())
    return len(rows)


def test_report_text_of_every_model(spark):
    n = held_against(
        spark,
        "q_report_text_all",
        f"""WITH m AS (SELECT strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '_checkpoint.pth' ELSE '.pth' END AS name FROM '{SF}/orders.parquet')
        SELECT name, upper(name[1:8]) AS day, replace(name, '.pth', '_analysis.png') AS plot, format('{{:,.1f}}', length(name) * 1234.56::DOUBLE) AS size FROM m""",
    )
    assert n == spark.read.parquet(f"{SF}/orders.parquet").count() > 20


def test_every_vector(spark):
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    px = f"SELECT vec_id, embedding::DOUBLE[] AS px FROM '{SF}/embeddings.parquet'"
    scaled = "round(list_sum(list_transform(px, lambda v: (v - list_min(px)) / (list_max(px) - list_min(px) + 1e-8))), 5)"
    assert held_against(spark, "q_display_scale_all", f"SELECT vec_id, {scaled} AS total FROM ({px})") == n
    got = {r.vec_id: r for r in QUERIES["q_upsample_band_all"](spark, SF).collect()}
    old = QUERIES["q_upsample_band"](spark, SF).collect()
    assert len(got) == n == len(old) and all(got[r.vec_id] == r for r in old)
    # weights of a clamped bilinear grid twice as fine sum to 4 at every pixel
    for vec_id, total in duckdb.sql(f"SELECT vec_id, 4 * list_sum(px) FROM ({px})").fetchall():
        assert abs(got[vec_id].total - total) < 2e-4


def test_split_of_kept_chips(spark):
    kept = {r.file_name for r in QUERIES["q_bg_filter"](spark, SF).collect()}
    rows = QUERIES["q_ratio_split_kept"](spark, SF).collect()
    n = len(kept)
    sizes = [sum(r.split == s for r in rows) for s in ("train", "val", "test")]
    assert {r.file_name for r in rows} == kept and len(rows) == n < 45
    assert sizes[:2] == [int(n * 0.7 + 1e-9), int(n * 0.2 + 1e-9)] and sum(sizes) == n
