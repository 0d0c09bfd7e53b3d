"""Shared storage for intermediate tables, and broadcasts behind a size check."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType, TimestampType

#: Bytes of a column's value; strings and binaries are measured. A row of a broadcast table takes ROW_BYTES besides.
_WIDTHS = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4, LongType: 8, DoubleType: 8, TimestampType: 8}
ROW_BYTES = 24
TEXT_BYTES = 64
#: MB of a table that may be broadcast.
BROADCAST_MB = 24.0


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset and Spark is one local process (tests), a
    temporary folder; on a cluster ValueError, as other machines wouldn't see that one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="terrasieve-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


#: The folder of each application that this driver ran.
_RUNS: dict[tuple[str, str], str] = {}


def run_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one. It goes when the driver's JVM ends, with all that is in it, whatever failed."""
    own = (spark.sparkContext.applicationId, shared_dir(spark))
    if own not in _RUNS:
        path = f"{own[1]}/terrasieve/run-{own[0]}-{uuid.uuid4().hex}"
        files, where = _files(spark, path)
        files.mkdirs(where)
        files.deleteOnExit(where)
        _RUNS[own] = path
    return _RUNS[own]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in this application's folder, where nothing is yet."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def sweep(spark: SparkSession, hours: float = 72.0) -> list[str]:
    """Delete the folders that other applications left, if nothing was written into them directly for so many hours: those of drivers that were
    killed. hours must be longer than any application runs. The paths that went."""
    files, top = _files(spark, f"{shared_dir(spark)}/terrasieve")
    if not files.exists(top):
        return []
    found = [x for x in files.listStatus(top) if x.isDirectory() and x.getPath().getName().startswith("run-")]
    mine = {path.rpartition("/")[2] for path in _RUNS.values()}
    old = [x.getPath() for x in found if x.getPath().getName() not in mine and x.getModificationTime() < (time.time() - 3600 * hours) * 1000]
    for path in old:
        files.delete(path, True)
    return [path.toString() for path in old]


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, which knows every store that Spark can read."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, lost executors cost no recomputation. The table is
    deleted by drop(), or else when the driver's JVM ends; what a failed write leaves goes at once."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
    except Exception:
        files, where = _files(spark, path)
        files.delete(where, True)
        raise
    held = spark.read.schema(df.schema).parquet(path)
    held._staged_at = path
    return held


def drop(*staged: DataFrame) -> None:
    """Delete tables that stage() wrote; no later plan may read them."""
    for df in staged:
        files, where = _files(df.sparkSession, df._staged_at)
        files.delete(where, True)


def row_bytes(schema: StructType) -> int:
    """Bytes of a row in memory, where texts and other kinds without a fixed width count as TEXT_BYTES."""
    width = lambda kind: row_bytes(kind) if isinstance(kind, StructType) else _WIDTHS.get(type(kind), TEXT_BYTES)
    return ROW_BYTES + sum(width(field.dataType) for field in schema.fields)


def counted(df: DataFrame, rows: int, more: int = 0) -> DataFrame:
    """df, which has so many rows at most, as a side of a join: broadcast if they have at most BROADCAST_MB, otherwise shuffled. more: bytes of a
    row besides row_bytes."""
    return F.broadcast(df) if rows * (row_bytes(df.schema) + more) <= BROADCAST_MB * 1e6 else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that is shuffled and sorted whatever Spark takes its size to be: Spark goes by the files' bytes, which tell neither
    what explode makes of a row nor how well a column was packed, and so would send tables of any size through the driver."""
    return df.hint("merge")


def size_mb(df: DataFrame) -> float:
    """MB of df's rows in memory: counts and summed lengths of each task meet, no rows do. Over a Parquet table it reads footers, and columns
    of texts or binaries only."""
    width, measured = ROW_BYTES, F.lit(0)
    for field in df.schema.fields:
        if type(field.dataType) in (StringType, BinaryType):
            measured = measured + F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        elif type(field.dataType) in _WIDTHS:
            width += _WIDTHS[type(field.dataType)]
        else:
            raise TypeError(f"no width is known for {field.dataType.simpleString()}")
    n, more = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(measured), F.lit(0))).first()
    return (n * width + more) / 1e6


def broadcast_within(df: DataFrame, mb: float = BROADCAST_MB) -> DataFrame:
    """A broadcast hint if df, a table that is written, has at most so many MB; otherwise df, and Spark shuffles."""
    return F.broadcast(df) if size_mb(df) <= mb else df
