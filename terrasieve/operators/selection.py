"""Choosing rows: exact ranks without a single task, samples, splits, latest files, training histories."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import drop, stage


def hash_ranked(df: DataFrame, key: str, seed: int, name: str = "rank") -> DataFrame:
    """df with the rank from 0 of each row in the order of md5(key, seed), then key. Ranks are counted in 4096 buckets of the hash, so no
    task sees all rows."""
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    d = df.select("*", h.alias("_h")).withColumn("_b", F.substring("_h", 1, 3))
    sizes = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows at most
    sizes = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) - 1
    return d.withColumn("_r", inside).join(F.broadcast(sizes), "_b").withColumn(name, F.col("_at") + F.col("_r")).drop("_h", "_b", "_r", "_at")


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement, all if there are fewer; the same ones for one seed."""
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(h, key).limit(n)


def ratio_split(df: DataFrame, key: str, ratios: tuple[float, float, float] = (0.7, 0.2, 0.1), seed: int = 42) -> DataFrame:
    """df with `split` (train, val, test); sizes are the ratios of the row count, cut down to whole rows, the rest is test."""
    if abs(sum(ratios) - 1) > 1e-8:
        raise ValueError("ratios must sum to 1")
    total = df.count()
    train, val = int(total * ratios[0] + 1e-9), int(total * ratios[1] + 1e-9)
    rank = F.col("_rank")
    return hash_ranked(df, key, seed, "_rank").withColumn("split", F.when(rank < train, "train").when(rank < train + val, "val").otherwise("test")).drop("_rank")


def split_lookup(files: DataFrame, members: DataFrame, order: tuple[str, ...] = ("train", "val", "test"), missing: str = "NA") -> DataFrame:
    """files with dataset_split by file_name; of several splits the last in order counts."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    one = members.groupBy("file_name").agg(F.max_by("split", place).alias("dataset_split"))
    return files.join(one, "file_name", "left").withColumn("dataset_split", F.coalesce("dataset_split", F.lit(missing)))


def latest_model(models: DataFrame, name: str = "name") -> DataFrame:
    """One row: the last name of those that aren't checkpoints, or of all if there is none."""
    ready = ~F.col(name).endswith("_checkpoint.pth")
    return models.agg(F.max(F.struct(ready.alias("ready"), F.col(name).alias("name"))).alias("m")).select("m.name")


def report_strings(models: DataFrame, name: str = "name") -> DataFrame:
    """A row for each row of models: name, and the day, plot file and size that a report writes of it."""
    n = F.col(name)
    return models.select(n.alias("name"), F.upper(F.substring(n, 1, 8)).alias("day"), F.replace(n, F.lit(".pth"), F.lit("_analysis.png")).alias("plot"), F.format_number(F.length(n) * 1234.56, 1).alias("size"))


def early_stop(history: DataFrame, patience: int, run: str = "run_id", epoch: str = "epoch", loss: str = "val_loss") -> DataFrame:
    """history up to each run's stop, with is_best and bad (epochs since the best). Only a strictly smaller loss is a new best, and
    a null is one only before any other. Epochs with one number come in an order that a hash of the loss decides.

    Rows are dealt out by ranges of (run, epoch), and what a range needs of the ones before it are three numbers a run: rows, the least loss, the
    last best. So one endless run is worked on by many tasks."""
    own = {"_run": F.col(run), "_epoch": F.col(epoch), "_mix": F.xxhash64(loss)}
    dealt = history.withColumns(own).repartitionByRange("_run", "_epoch", "_mix").withColumn("_part", F.spark_partition_id())
    dealt = stage(dealt, "stop-dealt")
    inside = Window.partitionBy("_run", "_part").orderBy("_epoch", "_mix")
    ranges = Window.partitionBy("_run").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    named = lambda df, t: df.withColumnRenamed("_run", f"_run{t}").withColumnRenamed("_part", f"_part{t}")
    on = lambda t: F.col("_run").eqNullSafe(F.col(f"_run{t}")) & (F.col("_part") == F.col(f"_part{t}"))
    before = dealt.groupBy("_run", "_part").agg(F.count(F.lit(1)).alias("n"), F.min(loss).alias("least"))
    before = named(before.select("_run", "_part", F.coalesce(F.sum("n").over(ranges), F.lit(0)).alias("_start"), F.min("least").over(ranges).alias("_least")), 1)
    best = F.least("_least", F.min(loss).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    is_best = best.isNull() | F.coalesce(F.col(loss) < best, F.lit(False))
    d = dealt.join(before, on(1)).withColumn("is_best", is_best).withColumn("_i", F.col("_start") + F.row_number().over(inside))
    d = d.withColumn("_here", F.max(F.when(F.col("is_best"), F.col("_i"))).over(inside.rowsBetween(Window.unboundedPreceding, 0))).drop("_run1", "_part1", "_start", "_least")
    last = d.groupBy("_run", "_part").agg(F.max("_here").alias("last"))
    last = named(last.select("_run", "_part", F.max("last").over(ranges).alias("_last")), 2)
    d = d.join(last, on(2)).withColumn("bad", F.col("_i") - F.greatest("_last", "_here")).drop("_run2", "_part2", "_last", "_here", "_mix")
    d = stage(d, "stop-bad")
    drop(dealt)
    stops = d.filter(F.col("bad") >= patience).groupBy(F.col("_run").alias("_run3")).agg(F.min("_i").alias("_stop"))
    kept = d.join(stops, F.col("_run").eqNullSafe(F.col("_run3")), "left").filter(F.col("_stop").isNull() | (F.col("_i") <= F.col("_stop")))
    return kept.select(*history.columns, "is_best", "bad")


def plateau_rate(history: DataFrame, rate: float, patience: int, factor: float = 0.5, relative: float = 1e-3, run: str = "run_id", epoch: str = "epoch", loss: str = "val_loss") -> DataFrame:
    """Per run: the learning rate after its last epoch. It falls by factor once more than patience epochs in a row weren't better than
    best * (1 - relative); a null loss isn't better. A run's epochs stream by in order, so its length needs no memory."""
    kind = history.schema[run].dataType.simpleString()
    ordered = history.select(F.col(run).alias("run"), F.col(epoch).alias("epoch"), F.col(loss).cast("double").alias("loss")).repartition("run").sortWithinPartitions("run", "epoch", "loss")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, begun, best, bad, now = None, False, None, 0, rate
        for b in batches:
            done: list[tuple] = []
            for key, value in zip(b.column("run").to_pylist(), b.column("loss").to_pylist(), strict=True):
                if not begun or key != held:
                    if begun:
                        done.append((held, now))
                    held, begun, best, bad, now = key, True, None, 0, rate
                if value is not None and (best is None or value < best * (1 - relative)):
                    best, bad = value, 0
                else:
                    bad += 1
                if bad > patience:
                    bad, now = 0, now * factor
            kept = b.schema.field(0).type
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], kept), pa.array([v for _, v in done], pa.float64())], names=["run", "rate"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([held], kept), pa.array([now], pa.float64())], names=["run", "rate"])

    return ordered.mapInArrow(fold, f"run {kind}, rate double").select(F.col("run").alias(run), "rate")


def latest_by_time(files: DataFrame, suffix: str, name: str = "file_name", modified: str = "modified") -> DataFrame:
    """One row: the name, of those with the suffix, that was changed last; of several the greatest name. No such name gives a null."""
    own = files.filter(F.col(name).endswith(suffix))
    return own.agg(F.max(F.struct(F.col(modified).alias("m"), F.col(name).alias("n"))).alias("x")).select(F.col("x.n").alias(name))


def in_order(df: DataFrame, key: str, name: str = "z_order") -> DataFrame:
    """df with the rank from 0 of each row by key, as a mosaic's order. Rows are dealt out by ranges of key and counted, so no task sees all;
    equal keys get ranks side by side, in no stated order."""
    numbered = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    # the row's number parts what one key holds
    dealt = stage(numbered.repartitionByRange(F.col(key).asc_nulls_first(), "_row").withColumn("_p", F.spark_partition_id()), "in-order")
    drop(numbered)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    sizes = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(F.col(key).asc_nulls_first(), "_row")) - 1
    return dealt.withColumn("_r", inside).join(F.broadcast(sizes), "_p").withColumn(name, (F.col("_at") + F.col("_r")).cast("long")).drop("_p", "_r", "_at", "_row")


def bottom_k(df: DataFrame, part: str, k: int, mixed: Column) -> DataFrame:
    """Of each value of part the k rows with the least `mixed`, a whole number from 0 to 2^60 that is spread evenly over rows and decides alone,
    however rows are dealt; of equal ones any. Fewer where part has fewer. Counts come first (a row for each value of part goes to the driver),
    so that a threshold leaves little more than k rows of each for the sort."""
    counts = {r[0]: r[1] for r in df.groupBy(part).count().collect()}
    share = F.lit(None).cast("double")
    for value, n in counts.items():
        share = F.when(F.col(part).eqNullSafe(F.lit(value)), F.lit(min(1.0, (k + 8 * k**0.5 + 8) / n))).otherwise(share)
    few = df.withColumn("_h", mixed).filter(F.col("_h") <= share * float(1 << 60))
    return few.withColumn("_n", F.row_number().over(Window.partitionBy(part).orderBy("_h"))).filter(F.col("_n") <= k).drop("_h", "_n")


def text_hash(text: Column) -> Column:
    """60 bits of a text's MD5, which other engines give alike."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def shuffled(df: DataFrame, key: str, seed: int, name: str = "place") -> DataFrame:
    """df with a place from 0 for each row, in an order that only the seed and the keys decide."""
    return hash_ranked(df, key, seed, name)
