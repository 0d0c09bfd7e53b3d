"""Content-addressed store of token ids.

A rolling hash over the last 16 ids cuts each document's ids into chunks; the cuts depend on nearby ids only, so passages that
documents share give the same chunks. Each different chunk is stored once under its 128-bit hash. A recipe lists a document's chunks;
recipes stand in ascending doc_id order with their place in the whole id stream. A Merkle manifest covers them: chunk hashes give a
document's root, documents a block's, blocks a part's.

Folders under the store's path, all Parquet: chunks (chunk, n, data), recipes (part, at, doc_id, n_tokens, chunks, root), manifest
(part, first_id, tokens_before, n_tokens, n_docs, root).

Defined results: null text counts as empty and gives the end id alone. Rows with one doc_id each keep their own recipe. Null ids come
first. An empty table gives an empty store. Extra columns are not read. The store stays where it was written; nothing here deletes it
(the query writes it to the application's folder, which goes with the driver).

Plan: one pass over the texts writes recipes and chunk bytes to a staged table. Chunks are counted by hash (pre-aggregated in each task);
of those used more than once the first use is kept, found by a broadcast join, or beyond its size by a shuffle of the bytes.
Recipes, about 60 bytes a document, are shuffled once by id range. Reading back, each stored chunk is
read once, its hash recomputed; only its checksum travels to the recipes, where checksums of chunks are joined to a document's by
crc32 arithmetic. A chunk that a third of all recipes use is thus one stored row and short rows of a join that Spark can split. Every read
recomputes the tree of each part from its recipes and compares it with the manifest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrasieve.functions.staging import broadcast_within, drop, stage
from terrasieve.llm.columns import whole_text
from terrasieve.llm.word_tokens import word_encoder
from terrasieve.llm.worker_memory import slices

#: Chunks hold so many ids at least, on average over it, and at most. The window is shorter than the least chunk.
LEAST, MEAN_BITS, MOST, WINDOW = 256, 9, 4096, 16  # the window is a power of two
BLOCK_DOCS = 1024
#: Words that a worker remembers, about 120 MB.
WORDS = 1_500_000
#: Random 32-bit values of ids for the rolling hash.
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 1 << 16, dtype=np.uint32)


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one document's ids."""
    n = len(ids)
    if n <= LEAST:
        return [n] if n else []
    h, span = _GEAR[ids.astype(np.uint32) & 0xFFFF], 1
    while span < WINDOW:  # a window of twice the span is two of them, the earlier one shifted
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    marks = np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + 1
    ends, at, k = [], 0, 0
    while n - at > LEAST:
        k = int(np.searchsorted(marks, at + LEAST))
        end = min(int(marks[k]) if k < len(marks) else n, at + MOST, n)
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def chunk_hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(hashes: list[bytes]) -> bytes:
    """Root of a binary hash tree; a last odd node moves up as it is."""
    level = [hashlib.blake2b(b"\0" + h, digest_size=16).digest() for h in hashes]
    while len(level) > 1:
        level = [hashlib.blake2b(b"\1" + b"".join(level[i : i + 2]), digest_size=16).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else hashlib.blake2b(b"", digest_size=16).digest()


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the crc32 polynomial, bits reflected."""
    product = 0
    for bit in range(31, -1, -1):
        if b >> bit & 1:
            product ^= a
        a = a >> 1 ^ (_POLY if a & 1 else 0)
    return product


@lru_cache(maxsize=65_536)
def _shift(n_bytes: int) -> int:
    """x to the power 8 * n_bytes."""
    result, square = 1 << 31, 1 << 23
    while n_bytes:
        if n_bytes & 1:
            result = _times(result, square)
        square = _times(square, square)
        n_bytes >>= 1
    return result


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """crc32 of the concatenation of byte strings of which (crc32, length) are known."""
    total = 0
    for crc, length in parts:
        total = _times(total, _shift(length)) ^ crc if total else crc
    return total


def _encode(tokenizer: str, end_id: int | None):
    """(row, doc_id, n_tokens, chunks, ns, data) of each text; row is unique. Bytes stand with a chunk's first use in a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, row = word_encoder(tokenizer, WORDS), TaskContext.get().partitionId() << 36
        tail = np.array([] if end_id is None else [end_id], dtype=encoder.dtype)
        for batch in batches:
            for part in slices(batch):
                rows: list[list] = [[], [], [], [], []]
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    ids = np.concatenate([ids, tail])
                    ends = cuts(ids)
                    data = [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]
                    chunks = [chunk_hash(x) for x in data]
                    if len(set(chunks)) < len(chunks):
                        first = {c: i for i, c in reversed(list(enumerate(chunks)))}
                        data = [x if first[c] == i else None for i, (c, x) in enumerate(zip(chunks, data, strict=True))]
                    for column, value in zip(rows, (doc_id, len(ids), chunks, np.diff([0, *ends]).tolist(), data), strict=True):
                        column.append(value)
                types = (batch.schema.field(0).type, pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.binary()))
                numbers = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.RecordBatch.from_arrays([numbers, *[pa.array(c, t) for c, t in zip(rows, types, strict=True)]], names=["row", "doc_id", "n_tokens", "chunks", "ns", "data"])

    return run


def _place():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            roots = [merkle(c) for c in batch.column("chunks").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(n), pa.int64()), pa.array(starts, pa.int64()), batch.column("doc_id"), batch.column("n_tokens"), batch.column("chunks"), pa.array(roots, pa.binary())],
                names=["part", "at", "doc_id", "n_tokens", "chunks", "root"],
            )

    return run


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The root over each row's listed roots, as the last column."""
    for batch in batches:
        roots = [merkle([x["root"] for x in listed]) for listed in batch.column("listed").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(roots, pa.binary())], names=[*batch.schema.names[:-1], "root"])


def _manifest(recipes: DataFrame) -> DataFrame:
    """A row for each part of the recipes: part, first_id, n_tokens, n_docs, root, tokens_before."""
    kind = recipes.schema["doc_id"].dataType.simpleString()

    def joined(rows: DataFrame, by: list[str], first: str, docs) -> DataFrame:
        listed = F.array_sort(F.collect_list(F.struct("at", "root"))).alias("listed")
        rows = rows.groupBy(*by).agg(F.min("at").alias("at"), F.min_by(first, "at").alias("first_id"), F.sum("n_tokens").alias("n_tokens"), docs.alias("n_docs"), listed)
        return rows.mapInArrow(_trees, ", ".join(f"{c} long" for c in by) + f", at long, first_id {kind}, n_tokens long, n_docs long, root binary")

    # at most BLOCK_DOCS roots meet in a block; a part has one root for each block of its rows
    reach = F.floor(F.col("at") / (1 << 20)).alias("reach")
    by_reach = Window.partitionBy("part", "reach").orderBy("at")
    rows = recipes.select("part", "at", "doc_id", "n_tokens", "root", reach)
    rows = rows.withColumn("block", F.floor((F.row_number().over(by_reach) - 1) / BLOCK_DOCS))
    blocks = joined(rows, ["part", "reach", "block"], "doc_id", F.count(F.lit(1)))
    parts = joined(blocks, ["part"], "first_id", F.sum("n_docs")).drop("at")
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row a part
    return parts.withColumn("tokens_before", F.coalesce(before, F.lit(0).cast("long")))


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append end_id, and write the store under path."""
    d = whole_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    encoded = d.mapInArrow(_encode(tokenizer, end_id), f"row long, doc_id {kind}, n_tokens long, chunks array<binary>, ns array<int>, data array<binary>")
    encoded = stage(encoded.filter("n_tokens > 0"), "store-encoded")
    uses = encoded.select("row", F.explode("chunks").alias("chunk")).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    several = stage(uses.filter("n > 1").select(F.col("chunk").alias("several"), "first"), "store-several")
    each = encoded.select("row", F.explode(F.arrays_zip("chunks", "ns", "data")).alias("c")).filter("c.data is not null").select("row", F.col("c.chunks").alias("chunk"), F.col("c.ns").alias("n"), "c.data")
    once = each.join(broadcast_within(several), F.col("chunk") == F.col("several"), "left").filter("several is null or row = first")
    once.select("chunk", "n", "data").write.option("compression", "zstd").parquet(f"{path}/chunks")
    # rows of one id go by a hash of their chunks, then by number, so ranges part what one id holds
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("chunks"), F.col("row"))
    placed = encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "chunks")
    placed = placed.mapInArrow(_place(), f"part long, at long, doc_id {kind}, n_tokens long, chunks array<binary>, root binary")
    placed.write.option("compression", "zstd").parquet(f"{path}/recipes")
    drop(encoded, several)
    _manifest(docs.sparkSession.read.parquet(f"{path}/recipes")).write.option("compression", "zstd").parquet(f"{path}/manifest")


def _check_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        for chunk, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.frombuffer(data, dtype=f"<u{len(data) // n}").astype("<u4")
            for column, value in zip(rows, (chunk, len(ids), zlib.crc32(ids.tobytes()), chunk_hash(data) == chunk), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.binary(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["chunk", "n", "crc", "intact"])


def _join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, crc, ok = [], [], []
        for used, root, said in zip(batch.column("used").to_pylist(), batch.column("root").to_pylist(), batch.column("said").to_pylist(), strict=True):
            held = [x for x in used if x["n"] is not None]  # the others' chunks are missing
            n.append(sum(x["n"] for x in held))
            crc.append(crc32_joined([(x["crc"], 4 * x["n"]) for x in held]))
            ok.append(len(held) == len(used) and all(x["intact"] for x in used) and merkle([x["chunk"] for x in used]) == root and n[-1] == said)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(ok, pa.bool_())], names=["doc_id", "start", "n_tokens", "ids_crc32", "verified"]
        )


def check_manifest(spark: SparkSession, path: str) -> None:
    """Raise if the recipes don't give the manifest's roots and counts, part by part."""
    said = spark.read.parquet(f"{path}/manifest")
    recipes = spark.read.schema("part long, at long, doc_id " + said.schema["first_id"].dataType.simpleString() + ", n_tokens long, root binary").parquet(f"{path}/recipes")
    names = ("first_id", "n_tokens", "n_docs", "root", "tokens_before")
    found = _manifest(recipes).select(F.col("part").alias("p"), *[F.col(c).alias(f"f_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"f_{c}"))
    wrong = said.join(found, F.col("part") == F.col("p"), "full").filter(F.col("part").isNull() | F.col("p").isNull() | ~same)
    parts = [r[0] for r in wrong.select(F.coalesce("part", "p").alias("part")).orderBy("part").limit(5).collect()]
    if parts:
        raise ValueError(f"recipes and manifest of {path} differ in part {', '.join(map(str, parts))}")


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    manifest = spark.read.parquet(f"{path}/manifest").select("part", "tokens_before")  # one row a part file
    recipes = spark.read.parquet(f"{path}/recipes").join(F.broadcast(manifest), "part")
    return recipes.withColumn("start", F.col("tokens_before") + F.col("at")).drop("part", "at", "tokens_before")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, verified (chunk hashes, Merkle root and length agree; false where
    a chunk is missing). Recipes that the manifest doesn't cover, or that it covers and that are gone, raise an error."""
    check_manifest(spark, path)
    recipes = _recipes(spark, path)
    kind = recipes.schema["doc_id"].dataType.simpleString()
    chunks = spark.read.parquet(f"{path}/chunks").select("chunk", "n", "data").mapInArrow(_check_chunks, "chunk binary, n long, crc long, intact boolean")
    uses = recipes.select("start", "doc_id", F.col("n_tokens").alias("said"), "root", F.posexplode("chunks").alias("seq", "chunk")).join(chunks, "chunk", "left")
    listed = F.array_sort(F.collect_list(F.struct("seq", "chunk", "n", "crc", "intact"))).alias("used")
    by_doc = uses.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.first("said").alias("said"), F.first("root").alias("root"), listed)
    return by_doc.mapInArrow(_join_chunks, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, verified boolean")


def restore(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start and its ids, chunk after chunk. A missing chunk, or recipes unlike the manifest, raise an error."""
    check_manifest(spark, path)
    chunks = spark.read.parquet(f"{path}/chunks").select("chunk", "n", "data")
    uses = _recipes(spark, path).select("start", "doc_id", F.posexplode("chunks").alias("seq", "chunk")).join(chunks, "chunk", "left")
    uses = uses.withColumn("data", F.when(F.col("data").isNull(), F.raise_error(F.lit("the store lacks a chunk"))).otherwise(F.col("data")))
    by_doc = uses.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("seq", "n", "data"))).alias("used"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[int(v) for x in used for v in np.frombuffer(x["data"], dtype=f"<u{len(x['data']) // x['n']}")] for used in b.column("used").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "start", "ids"])

    return by_doc.mapInArrow(run, f"doc_id {by_doc.schema['doc_id'].dataType.simpleString()}, start long, ids array<long>")
