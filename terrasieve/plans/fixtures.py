"""Geometry, chips, masks and histories derived from the driver's tables by integer rules, so two engines see the same rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.scalars import sigmoid
from terrasieve.functions.staging import counted

SIDE, CHIP, STRIDE = 10, 32, 24
# The flags' texts, by rule number.
FLAGS = (" True", "1", "no", "YES ", "1.0")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcel boundaries: id, ax, ay, bx, by."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), ((F.col("p_partkey") % 20) * SIDE).cast("double").alias("x"), (F.floor(F.col("p_partkey") / 20) * SIDE).cast("double").alias("y"))
    corners = F.array(*[F.struct((F.col("x") + dx * SIDE).alias("x"), (F.col("y") + dy * SIDE).alias("y")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    e = p.select("k", corners.alias("c")).select("k", F.posexplode(F.arrays_zip(F.slice("c", 1, 4).alias("a"), F.slice("c", 2, 4).alias("b"))).alias("i", "e"))
    return e.select((4 * F.col("k") + F.col("i")).alias("id"), F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted lines, one for each order: boundary edges with shifted ends, every edge as often as its turn comes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("o_custkey")
    n = 4 * table(spark, sf_dir, "part").count()
    e = counted(edges(spark, sf_dir), n).join(o, F.col("id") == F.col("o_orderkey") % n)
    return e.select(F.col("o_orderkey").alias("id"), (F.col("ax") + k % 9 - 4).alias("ax"), (F.col("ay") + k % 7 - 3).alias("ay"), (F.col("bx") + k % 5 - 2).alias("bx"), (F.col("by") + k % 11 - 5).alias("by"))


def chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0]
    wide, high = ceil(200 / STRIDE), 0 if last is None else ceil((last // 20 + 1) * SIDE / STRIDE)
    # a range, whose length Spark knows, so that it sees how large a side of a join is
    c = spark.range(wide * high).select((F.col("id") % wide).cast("int").alias("cx"), F.expr(f"id div {wide}").cast("int").alias("cy"))
    x, y = (F.col("cx") * STRIDE).cast("double"), (F.col("cy") * STRIDE).cast("double")
    return c.select(F.concat_ws("_", F.lit("chip"), "cx", F.concat(F.col("cy").cast("string"), F.lit(".tif"))).alias("file_name"), "cx", "cy", x.alias("xmin"), y.alias("ymin"), (x + CHIP).alias("xmax"), (y + CHIP).alias("ymax"))


def backgrounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chips(spark, sf_dir).filter("(cx + cy) % 5 <> 4")
    return c.select(F.concat(F.lit("/data/chips/"), "file_name").alias("image_file"), F.get(F.array(*[F.lit(f) for f in FLAGS], F.lit(None).cast("string")), ((7 * F.col("cx") + 3 * F.col("cy")) % 6).cast("int")).alias("is_background_only"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = (5 * F.col("cx") + F.col("cy")) % 10
    return chips(spark, sf_dir).filter(r != 9).select("file_name", F.when(r == 8, "test").when(r >= 6, "val").otherwise("train").alias("split"))


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predictions(spark, sf_dir)
    return p.withColumn("pred_result", F.get(F.array(F.lit("TP"), F.lit("FP"), F.lit("FN")), (F.col("id") % 3).cast("int")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, pixels (8 x 8, row-major)."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("pixels"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, pixels, mask (the next vector's components above 0; the first follows the last)."""
    e = vectors(spark, sf_dir)
    n = table(spark, sf_dir, "embeddings").count()
    after = e.select(F.pmod(F.col("vec_id") - 1, F.lit(n)).alias("vec_id"), F.transform("pixels", lambda v: (v > 0).cast("int")).alias("mask"))
    return e.join(after, "vec_id")


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images(spark, sf_dir).withColumn("prob", F.transform("pixels", lambda v: sigmoid(10 * v)))


def pixel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, row, col, value of every component."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    return e.select("vec_id", F.expr("i div 8").alias("row"), (F.col("i") % 8).cast("long").alias("col"), F.col("v").cast("double").alias("value"))


def histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.row_number().over(Window.partitionBy("user_id").orderBy("ts"))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), epoch.alias("epoch"), F.col("value").alias("val_loss"))


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderkey") % 4 == 0, "_checkpoint.pth").otherwise(".pth")
    return table(spark, sf_dir, "orders").select(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.col("o_orderkey").cast("string"), end).alias("name"))
