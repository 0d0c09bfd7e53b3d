"""Sources and sinks: round trips, folders, guards."""

import os
import struct
import time

import pytest
from pyspark.sql import functions as F

from terrasieve.sources import files, geopackage, wkb


def test_geopackage_round_trip(spark, tmp_path):
    geopackage.register(spark)
    path = str(tmp_path / "layer")
    rows = spark.range(500).select("id", (F.col("id") * 0.5).alias("ax"), F.lit(0.0).alias("ay"), F.lit(1.0).alias("bx"), F.col("id").cast("double").alias("by"))
    named = rows.select("*", F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), F.col("id"))).alias("name"), (F.col("id") % 2 == 0).alias("flag"))
    wkb.edge_lines(named).repartition(3).write.format("gpkg").option("layer", "a b").option("srs", 27700).mode("append").save(path)
    back = spark.read.format("gpkg").option("rows", 50).load(path)
    assert back.columns == ["fid", "id", "name", "flag", "geom"] and back.rdd.getNumPartitions() >= 3
    got = wkb.edges(back, "id").drop("part", "seq")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in rows.collect()}
    assert {tuple(r) for r in back.select("id", "name", "flag").collect()} == {tuple(r) for r in named.select("id", "name", "flag").collect()}
    wkb.edge_lines(rows.limit(2)).coalesce(1).write.format("gpkg").mode("overwrite").save(path)
    assert spark.read.format("gpkg").load(path).count() == 2
    with pytest.raises(Exception, match="no layer"):
        spark.read.format("gpkg").option("layer", "none").load(path)


def test_null_geometry_and_empty_layer(spark, tmp_path):
    geopackage.register(spark)
    path = str(tmp_path / "few")
    spark.createDataFrame([(1, None)], "id long, geom binary").write.format("gpkg").mode("append").save(path)
    back = spark.read.format("gpkg").load(path)
    assert back.first().geom is None and wkb.edges(back).count() == 0
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "id long, geom binary").coalesce(1).write.format("gpkg").mode("append").save(empty)
    assert spark.read.format("gpkg").load(empty).count() == 0


def test_polygon_rings_and_heights():
    ring = struct.pack("<I", 3) + struct.pack("<9d", 0, 0, 9, 4, 0, 9, 0, 0, 9)
    polygon = struct.pack("<BII", 1, 1003, 2) + ring + ring
    point = struct.pack("<BI2d", 1, 1, 5.0, 6.0)
    many = struct.pack("<BII", 1, 7, 3) + point + polygon + wkb.line_wkb([[1, 2], [3, 4]])
    assert [x.tolist() for x in wkb.lines(many)] == [[[0, 0], [4, 0], [0, 0]]] * 2 + [[[1, 2], [3, 4]]]


def test_scan_pairs_and_splits(spark, tmp_path):
    for name in ("images/train/a.tif", "images/val/b.tif", "images/train/c.jpg", "masks/train/a.tif"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    images = files.scan(spark, str(tmp_path / "images/train"), ".tif", ".jpg")
    assert sorted(r.file_name for r in images.collect()) == ["a.tif", "c.jpg"]
    assert [r.file_name for r in files.paired(images, files.scan(spark, str(tmp_path / "masks/train"), ".tif")).collect()] == ["a.tif"]
    assert {tuple(r) for r in files.split_members(spark, str(tmp_path / "images"), ("train", "val")).collect()} == {("a.tif", "train"), ("b.tif", "val")}
    with pytest.raises(ValueError):
        files.scan(spark, str(tmp_path / "images/val"), ".jpg")


def test_scaler_log_and_models(spark, tmp_path):
    path = str(tmp_path / "scaler")
    files.write_scaler(spark.createDataFrame([(i, 0.1 * i, 0.2) for i in range(4)], "band int, mean double, std double"), path)
    assert files.read_scaler(spark, path).first().scaler["3"].std == 0.2
    with pytest.raises(Exception, match="lacks a band"):
        files.read_scaler(spark, path, 5).collect()
    with pytest.raises(Exception, match="(?i)exist"):
        files.guarded(spark.range(1), False).parquet(path)
    for i in range(2):
        files.append_log(spark.createDataFrame([(i, None)], "run int, f1 double"), str(tmp_path / "log"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "log")).collect()) == ["run: 0, f1: NA", "run: 1, f1: NA"]
    kind = "name string, arch string, encoder string, state_dict map<string,double>, model_state_dict map<string,double>"
    good = spark.createDataFrame([("m", "unet", "e", None, {"_orig_mod.w": 1.0})], kind)
    assert files.model_states(good).first().state == {"w": 1.0}
    with pytest.raises(Exception, match="incomplete checkpoint"):
        files.model_states(spark.createDataFrame([("m", "unet", None, {"w": 1.0}, None)], kind)).collect()


def test_geopackage_pushdown(spark, tmp_path, capsys):
    """Filters and boxes go to SQLite; the rest stays with Spark, and rows are right whatever goes where."""
    geopackage.register(spark)
    path = str(tmp_path / "layer")
    rows = spark.range(1000).select("id", (F.col("id") * 1.0 + 0.1).alias("ax"), F.lit(0.0).alias("ay"), (F.col("id") + 1.5).alias("bx"), F.lit(2.0).alias("by"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("n"), F.col("id") % 7)).alias("name"), (F.col("id") % 3 == 0).alias("flag"), (F.col("id") / 3).alias("size"))
    wkb.edge_lines(rows).repartition(2).write.format("gpkg").mode("append").save(path)
    back = spark.read.format("gpkg").option("bounds", True).load(path)
    assert back.columns[-4:] == ["min_x", "min_y", "max_x", "max_y"]
    box = back.filter("min_x <= 60.25 and max_x >= 50.1 and min_y <= 5 and max_y >= 1 and id < 58")
    assert {r.id for r in box.collect()} == {i for i in range(58) if i + 0.1 <= 60.25 and i + 1.5 >= 50.1}
    box.explain()
    shown = capsys.readouterr().out
    assert "id" in shown and "Python" in shown or "gpkg" in shown
    for rule in ("id = 7", "name = 'n3' and id > 500", "name is null and flag", "id in (1, 2, 5000)", "size > 300.5", "name > 'n4'", "not flag and id <= 20", "min_x = 7.1", "name is not null and size <=> null"):
        want = rows.withColumns({"min_x": F.col("ax")}).filter(rule)
        assert {r.id for r in back.filter(rule).collect()} == {r.id for r in want.collect()}, rule
    reader = geopackage.Reader(back.schema, geopackage._files(path), "layer", "geom", 500, 1 << 30)
    asked = [geopackage.GreaterThanOrEqual(("max_x",), 50.1), geopackage.LessThanOrEqual(("min_x",), 60.25), geopackage.LessThan(("id",), 58), geopackage.GreaterThan(("size",), 0.0)]
    assert list(reader.pushFilters(asked)) == [asked[0], asked[1], asked[3]]
    read = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert 9 <= read <= 12  # of 1,000
    few = spark.read.schema("id long").format("gpkg").load(path)
    assert few.columns == ["id"] and few.agg(F.sum("id")).first()[0] == 499_500


def test_geopackage_of_far_ids(spark, tmp_path):
    """Row ids 1 and 10^12 are two rows, not 10^12 of them."""
    geopackage.register(spark)
    path = str(tmp_path / "layer")
    spark.createDataFrame([(1, None), (2, None)], "id long, geom binary").coalesce(1).write.format("gpkg").mode("append").save(path)
    (name,) = geopackage._packages(path)
    with geopackage.sqlite3.connect(f"{path}/{name}") as db:
        db.execute("UPDATE layer SET fid = 1000000000000 WHERE fid = 2")
    assert [(p.first, p.end) for p in geopackage._ranges(f"{path}/{name}", "layer", 1)] == [(1, 10**12), (10**12, None)]
    back = spark.read.format("gpkg").option("rows", 1).option("split", 0).load(path)
    assert back.rdd.getNumPartitions() == 2 and sorted(r.id for r in back.collect()) == [1, 2]


def test_geopackage_writes_whole_or_not(spark, tmp_path):
    """A failed write leaves the folder as it was; a good one is seen at once."""
    geopackage.register(spark)
    path = str(tmp_path / "layer")
    good = wkb.edge_lines(spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "id long, ax double, ay double, bx double, by double"))
    good.coalesce(1).write.format("gpkg").mode("append").save(path)
    before = sorted(os.listdir(path))
    bad = spark.range(200).repartition(4).select(F.when(F.col("id") == 133, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"), F.lit(None).cast("binary").alias("geom"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception):
            bad.write.format("gpkg").mode(mode).save(path)
        for _ in range(20):  # tasks that were still at work find out when they end
            if sorted(os.listdir(path)) == before:
                break
            time.sleep(0.5)
        assert sorted(os.listdir(path)) == before and spark.read.format("gpkg").load(path).count() == 1
    good.coalesce(1).write.format("gpkg").mode("append").save(path)
    assert spark.read.format("gpkg").load(path).count() == 2 and len(os.listdir(path)) == 3
    good.coalesce(1).write.format("gpkg").mode("overwrite").save(path)
    assert spark.read.format("gpkg").load(path).count() == 1 and len(os.listdir(path)) == 2
    os.remove(f"{path}/{geopackage.MANIFEST}")  # a folder from elsewhere
    assert spark.read.format("gpkg").load(path).count() == 1
