"""Scalar rules: names, flags, ratios, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that count as true.
TRUE_TEXTS = ("true", "1", "yes")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def truthy(flag: Column) -> Column:
    """Whether a flag's text is one of TRUE_TEXTS, without regard to case and blanks round it; null is false."""
    return F.coalesce(F.lower(F.trim(flag.cast("string"))).isin(*TRUE_TEXTS), F.lit(False))


def safe_ratio(part: Column, rest: Column) -> Column:
    """part / (part + rest), 0 where the sum isn't positive."""
    return F.when(part + rest > 0, part / (part + rest)).otherwise(F.lit(0.0))


def f1_score(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def normalise(value: Column, mean: Column, std: Column, full: float = 255.0) -> Column:
    """(value - mean * full) / (std * full)."""
    return (value - mean * full) / (std * full)


def strip_prefix(key: Column, prefix: str = "_orig_mod.") -> Column:
    """Where key begins with prefix, every occurrence of it goes."""
    return F.when(key.startswith(prefix), F.replace(key, F.lit(prefix), F.lit(""))).otherwise(key)


# How files and logs write a time.
FILE_STAMP, LOG_STAMP = "yyyyMMdd_HHmmss", "yyyy-MM-dd HH:mm:ss"


def stamp(time: Column, form: str = FILE_STAMP) -> Column:
    """A timestamp as a file's name or a log's line has it."""
    return F.date_format(time, form)


def require_bands(bands: Column, *allowed: int) -> Column:
    """The array of bands, or an error in the row that has another number of them (3 or 4 unless stated)."""
    allowed = allowed or (3, 4)
    told = F.format_string(f"an image has %d bands, not {' or '.join(map(str, allowed))}", F.size(bands))
    return F.when(F.size(bands).isin(*allowed), bands).otherwise(F.raise_error(told))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_same_crs(a: str | None, b: str | None) -> None:
    if a != b:
        raise ValueError(f"layers have different reference systems: {a} and {b}")
