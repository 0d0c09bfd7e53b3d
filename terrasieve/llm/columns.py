"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, as the dedup contracts define it (fixed pattern).
ASCII_SPACE = r"[\x20\x09-\x0D]"


def whole_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null text as empty: other columns can't clash with what an operator adds."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def crc32_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text, the rule that holds rows out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def own_exchange(key: Column) -> Column:
    """key re-encoded (16 bytes to hex). Joined on it, the output of groupBy(key) gets an exchange of its own,
    so adaptive execution can split a hot key's rows; otherwise it would reuse the aggregate's partitions, which it can't split."""
    return F.hex(key)
