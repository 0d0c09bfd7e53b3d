"""Exact top-k by Hamming distance: incremental multi-index hashing of binary codes.

A code is split into segments; a table for each segment lists the rows by its value. For a query, segment values at distance 0, then 1,
2, ... are looked up in every table. Once all segments have been searched up to radius r, each row within m * (r + 1) - 1 bits has been
seen (m segments, pigeonhole), so a query is done when its k-th verified distance is within that bound. Ties go to the smaller id.

Defined results: rows whose vector is null, or has a null or a length unlike `bits`, have no code, and rows without an id can't be named:
both are neither found nor queried. Fewer than k other rows give fewer results. A query doesn't find rows with its own id; rows with one
id are found once, at their least distance. An empty table gives no rows. Extra columns are not read.

Plan: codes (16 bytes a row), one of each repeat, are packed into blocks of rows and of queries of bounded size. A task gets one block
of rows, builds its tables once, and queries stream by. Blocks are searched in rounds of 1, 1, 2, 4, ... of them; a query takes the k-th
distance of the rounds before along as a bound, so that a round gives about k rows a query, however many blocks it has. Where blocks are
fewer than cores, a block's queries are dealt to several tasks. The work is queries times row blocks, whatever the keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import drop, stage
from terrasieve.llm.worker_memory import make_room

ROW_BLOCK, QUERY_BLOCK = 1 << 18, 1 << 8


def binary_codes(table: DataFrame, id_col: str, vector_col: str, bits: int = 64) -> DataFrame:
    """(id, code): bit i is set where component i is above 0. bits: 64 at most."""
    if not 0 < bits <= 64:
        raise ValueError("bits must be 1 to 64")
    vector = F.col(vector_col)
    # a sum of powers of two in a signed 64-bit number; the last bit is the sign
    powers = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(bits)])
    code = F.aggregate(F.zip_with(vector, powers, lambda v, p: F.when(v > 0, p).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    whole = (F.size(vector) == bits) & ~F.exists(vector, lambda v: v.isNull())
    return table.select(F.col(id_col).alias("id"), F.when(whole, code).alias("code")).filter("id is not null and code is not null")


def segment_widths(bits: int, rows: int) -> list[int]:
    """Widths of the segments: about log2(rows) bits each, 4 to 16."""
    m = max(1, round(bits / min(16, max(4, np.log2(max(rows, 2))))))
    return [bits // m + (i < bits % m) for i in range(m)]


class Block:
    """Segment tables over the codes of a block of rows."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, bits: int = 64):
        order = np.argsort(ids, kind="stable")
        self.ids, self.codes = ids[order], codes[order]
        self.tables, at = [], 0
        self.widths = segment_widths(bits, len(ids))
        for width in self.widths:
            values = ((self.codes >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << width))])
            self.tables.append((at, width, np.argsort(values, kind="stable"), starts))
            at += width
        self.masks = {(w, r): np.array([sum(1 << b for b in c) for c in combinations(range(w), r)], dtype=np.int64) for w in set(self.widths) for r in range(w + 1)}

    def search(self, query_id: int, code: np.uint64, k: int, bound: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest rows with other ids than the query's, by distance, then id; none beyond bound."""
        seen = np.zeros(len(self.ids), dtype=bool)
        seen[np.searchsorted(self.ids, query_id) : np.searchsorted(self.ids, query_id, "right")] = True  # its own rows
        where, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(max(self.widths) + 1):
            for at, width, rows, starts in self.tables:
                if radius > width:
                    continue
                value = int(code >> np.uint64(at)) & ((1 << width) - 1)
                probes = self.masks[width, radius] ^ value
                a, n = starts[probes], starts[probes + 1] - starts[probes]
                probes = np.flatnonzero(n)
                a, n = a[probes], n[probes]
                found = rows[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
                found = found[~seen[found]]
                seen[found] = True
                where = np.append(where, found)
                far = np.append(far, np.bitwise_count(self.codes[found] ^ code).astype(np.int64))
            order = np.lexsort((self.ids[where], far))
            where, far = where[order], far[order]
            ids, first = np.unique(self.ids[where], return_index=True)
            if len(ids) != len(where):
                first.sort()
                where, far = where[first], far[first]
            where, far = where[:k], far[:k]
            covered = len(self.widths) * (radius + 1) - 1
            if covered >= bound or (len(far) == k and far[-1] <= covered):
                break
        near = far <= bound
        return self.ids[where[near]], far[near]


def _search(k: int, bits: int):
    """Over records (block, lane, held, asked): the rows of a block, then its blocks of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("hamming")
        block = None
        for batch in batches:
            for held, asked in zip(batch.column("held"), batch.column("asked"), strict=True):
                if held.is_valid:
                    ids, codes = (x.to_numpy(zero_copy_only=False) for x in held.values.flatten())
                    block = Block(ids, codes.view(np.uint64), bits)
                    continue
                ids, codes, bounds = (x.to_numpy(zero_copy_only=False) for x in asked.values.flatten())
                out: list[list[np.ndarray]] = [[], [], []]
                for q, c, bound in zip(ids.tolist(), codes.view(np.uint64), bounds.tolist(), strict=True):
                    found, far = block.search(q, c, k, bound)
                    for column, value in zip(out, (np.full(len(found), q), found, far), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64), pa.int64()) for c in out], names=["query_id", "id", "distance"])

    return run


def hamming_topk(rows: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64) -> DataFrame:
    """rows, queries: (id, code). Per query: query_id, rank (from 1), id, distance."""
    # repeats of one (id, code) would all be dealt to one block; an id is found once however often it stands there
    once = lambda df: df.filter("id is not null and code is not null").dropDuplicates(["id", "code"])
    rows, queries = stage(once(rows), "hamming-rows"), stage(once(queries), "hamming-queries")
    n, chunks = (max(1, -(-df.count() // size)) for df, size in ((rows, ROW_BLOCK), (queries, QUERY_BLOCK)))
    dealt = lambda count, seed: F.pmod(F.xxhash64("id", "code", F.lit(seed)), F.lit(count))
    blocks = stage(rows.groupBy(dealt(n, 1).alias("block")).agg(F.collect_list(F.struct("id", "code")).alias("held")), "hamming-blocks")
    best, done, cores = None, 0, rows.sparkSession.sparkContext.defaultParallelism
    while done < n:
        width = min(max(1, done), n - done)
        lanes = max(1, -(-cores // width))
        # every block of queries meets every block of rows: a stated query set against all rows, in blocks
        bound = F.lit(bits).cast("long")
        asked = queries.withColumn("bound", bound)
        if best is not None:
            last = best.filter(F.col("rank") == k).select("query_id", F.col("distance").alias("known"))
            asked = queries.join(last, F.col("id") == F.col("query_id"), "left").withColumn("bound", F.coalesce("known", bound))
        asked = asked.groupBy(dealt(chunks, 2).alias("chunk")).agg(F.collect_list(F.struct("id", "code", "bound")).alias("asked"))
        asked = asked.select(F.explode(F.sequence(F.lit(done), F.lit(done + width - 1)).cast("array<long>")).alias("block"), (F.col("chunk") % lanes).cast("int").alias("lane"), "asked")
        held = blocks.filter(F.col("block").between(done, done + width - 1)).select("block", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), "held")
        both = held.unionByName(asked, allowMissingColumns=True).repartition(width * lanes, "block", "lane")
        both = both.sortWithinPartitions("block", "lane", F.col("held").isNull())
        found = both.select("held", "asked").mapInArrow(_search(k, bits), "query_id long, id long, distance long")
        if best is not None:
            found = found.unionByName(best.select("query_id", "id", "distance"))
        found = found.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
        better = stage(found.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= k), "hamming-best")
        if best is not None:
            drop(best)
        best, done = better, done + width
    drop(rows, queries, blocks)
    return best.select("query_id", "rank", "id", "distance")
