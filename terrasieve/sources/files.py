"""Directory scans, the CSV of flags, the JSON scaler, model tables, logs, and writes that guard what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasieve.functions.scalars import base_name, require_columns, strip_prefix
from terrasieve.operators.selection import in_order

SCALER_TYPE = "map<string,struct<mean:double,std:double>>"


def scan(spark: SparkSession, path: str, *suffixes: str) -> DataFrame:
    """(path, file_name, length, modified) of a folder's files with one of the suffixes, each once; ValueError if there is none. Contents aren't
    read. Order by path where an order matters: mosaics take it as their order column."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{{{','.join(suffixes)}}}").load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    if found.isEmpty():
        raise ValueError(f"no {' or '.join(suffixes)} in {path}")
    return found.select("path", base_name(F.col("path")).alias("file_name"), "length", "modified").dropDuplicates(["path"])


def paired(images: DataFrame, masks: DataFrame, suffix: str = ".tif") -> DataFrame:
    """Images with the suffix for which a mask of the same name exists."""
    return images.filter(F.col("file_name").endswith(suffix)).join(masks.select("file_name"), "file_name", "left_semi")


def split_members(spark: SparkSession, path: str, splits: tuple[str, ...] = ("train", "val", "test"), suffix: str = ".tif") -> DataFrame:
    """(file_name, split) of path/<split>/*suffix."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load([f"{path}/{s}" for s in splits]).select("path")
    return found.select(base_name(F.col("path")).alias("file_name"), F.element_at(F.split("path", "/"), -2).alias("split"))


def background_flags(spark: SparkSession, path: str) -> DataFrame:
    """image_file and is_background_only of a CSV with a header, both as text whatever they hold."""
    names = spark.read.option("header", True).csv(path)
    return require_columns(names, "image_file", "is_background_only")


def scaler_of(text: Column, bands: int = 4) -> Column:
    """A scaler's map from its JSON text; an error if a band is missing."""
    scaler = F.from_json(text, SCALER_TYPE)
    lacks = F.size(F.array_except(F.array(*[F.lit(str(b)) for b in range(bands)]), F.map_keys(scaler))) > 0
    return F.when(scaler.isNull() | lacks, F.raise_error(F.lit("the scaler lacks a band")).cast(SCALER_TYPE)).otherwise(scaler)


def read_scaler(spark: SparkSession, path: str, bands: int = 4) -> DataFrame:
    """One row: scaler."""
    return spark.read.option("wholetext", True).text(path).select(scaler_of(F.col("value"), bands).alias("scaler"))


def write_scaler(statistics: DataFrame, path: str, overwrite: bool = False) -> None:
    """(band, mean, std), a row a band, as one JSON object. A raster has few bands, so one row holds them."""
    entries = F.array_sort(F.collect_list(F.struct(F.col("band").cast("string").alias("key"), F.struct("mean", "std").alias("value"))))
    guarded(statistics.agg(F.to_json(F.map_from_entries(entries)).alias("value")).coalesce(1), overwrite).text(path)


def guarded(df: DataFrame, overwrite: bool):
    """A writer that fails where output exists, or replaces it if told so."""
    return df.write.mode("overwrite" if overwrite else "errorifexists")


def manifest(files: DataFrame) -> DataFrame:
    """files (path and others) with z_order, the place of each in a mosaic: by path, later ones on top. Written as a table, it stands for a
    virtual raster over the files."""
    return in_order(require_columns(files, "path"), "path")


def append_log(rows: DataFrame, path: str) -> None:
    """Each row as a line of `name: value` fields, added to the log's folder."""
    fields = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NA"))) for c in rows.columns]
    rows.select(F.concat_ws(", ", *fields).alias("value")).write.mode("append").text(path)


def model_states(models: DataFrame) -> DataFrame:
    """models (name, arch, encoder, state_dict, model_state_dict: maps) as (name, arch, encoder, state). state_dict counts first; without
    either, or without arch or encoder, an error. Compiled models' key prefix goes."""
    require_columns(models, "name", "arch", "encoder", "state_dict", "model_state_dict")
    state = F.coalesce("state_dict", "model_state_dict")
    kind = models.schema["state_dict"].dataType.simpleString()
    bad = state.isNull() | F.col("arch").isNull() | F.col("encoder").isNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("incomplete checkpoint: "), F.coalesce("name", F.lit("")))).cast(kind)).otherwise(state)
    return models.select("name", "arch", "encoder", F.transform_keys(checked, lambda k, v: strip_prefix(k)).alias("state"))
