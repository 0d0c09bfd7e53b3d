"""Exact dedup: group by a 128-bit content hash, keep one row, compare bytes inside groups.

Two texts are equal when they are identical after deleting ASCII white space. Of equal texts the row with the most code points in
its original text stays, then the one with the smallest id (null ids last).

Defined results: null text counts as empty, and all empty texts are one group. Rows with the same id and equal texts are copies like
any others: each gives a row, exactly one of a group is kept. An empty table gives an empty result. Extra columns are not read.

Plan: rows of about 100 bytes (number, hash, id, length) are written, pre-aggregated per hash, and joined back on a key of which
adaptive execution can split hot values; a row's number settles which of several repeats stays. Texts never follow them. To compare bytes, texts are read once more for hashes with several
rows; min and max per hash are pre-aggregated in each task, so one text a hash and task is shuffled at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import broadcast_within, drop, stage
from terrasieve.llm.columns import ASCII_SPACE, own_exchange, whole_text


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text.cast("binary")))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_SPACE, "")


def _keep(rows: DataFrame) -> DataFrame:
    """Per row of (row, key, doc_id, chars, sha): keep_id, group_size and kept."""
    order = F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("row").alias("r"))
    groups = rows.groupBy("key").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(own_exchange(F.col("key")).alias("k"), F.col("best.i").alias("keep_id"), F.col("best.r").alias("stays"), "group_size")
    joined = rows.withColumn("k", own_exchange(F.col("key"))).join(groups, "k")
    return joined.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("stays")).alias("kept"), F.col("sha").alias("text_sha256"), "key")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Decisions, one row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256, key (the hash)."""
    d = whole_text(docs, id_col, text_col).withColumn("norm", normalised(F.col("text")))
    hashed = d.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.char_length("text").alias("chars"), hash_of(F.col("norm")).alias("key"), F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))
    rows = stage(hashed, "dedup-rows")
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    several = stage(several, "dedup-several")
    texts = d.select(hash_of(F.col("norm")).alias("key"), "norm").join(broadcast_within(several), "key", "left_semi")
    clash = texts.groupBy("key").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).filter("a <> b").select("key")
    clash = stage(clash, "dedup-clash")
    drop(several)
    if clash.isEmpty():
        drop(clash)
        out = _keep(rows)
    else:  # different texts under one 128-bit hash: there SHA-256 of the text joins the key
        both = F.unhex(F.md5(F.concat(F.hex("key"), F.col("sha")).cast("binary")))
        apart = rows.join(clash, "key", "left_semi").withColumn("key", both)
        out = _keep(rows.join(clash, "key", "left_anti").unionByName(apart))
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """docs without the copies, with its own columns. Where the row that stays is itself repeated, one of its repeats stays. Rows are matched
    by the SHA-256 of the normalised text, which also tells texts of one hash apart. Columns of any type are carried along."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = F.col(names[docs.columns.index(id_col)]), F.coalesce(F.col(names[docs.columns.index(text_col)]), F.lit(""))
    decided = stage(exact_dedup(docs, id_col, text_col, hash_of), "dedup-decided")
    decided = decided.select(F.unhex("text_sha256").alias("key"), "doc_id", "kept")
    rows = decided.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("stays"))
    rows = stage(rows.filter("not stays or n > 1"), "dedup-gone")
    hashed = docs.toDF(*names).withColumn("k", F.unhex(F.sha2(normalised(text).cast("binary"), 256)))
    on = doc_id.eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("key"))
    held = hashed.join(broadcast_within(rows.filter("not stays").select("key", "doc_id")), on, "left_anti")
    repeated = rows.filter("stays").select("key", "doc_id")
    if not repeated.isEmpty():
        repeated = broadcast_within(repeated)
        # the row's number settles it, as columns may have types without an order
        most = F.struct((-F.char_length(text)).alias("c"), F.monotonically_increasing_id().alias("row"))
        one = held.join(repeated, on, "left_semi").select("k", most.alias("most"), F.struct(*names).alias("all"))
        one = one.groupBy("k").agg(F.min_by("all", "most").alias("m"))
        held = held.join(repeated, on, "left_anti").select(names).unionByName(one.select(*[F.col(f"m.{c}").alias(c) for c in names]))
    return held.select(names).toDF(*docs.columns)
