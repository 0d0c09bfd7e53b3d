"""Merkle manifest of a dataset: a tree of documents for each source, a tree of the sources' roots, and a proof for each document.

H is the lowercase hex SHA-256 of its inputs' concatenation, digests as hex text. A leaf is H of the row's columns, each `-` if null, else
its UTF-8 byte count, `:` and its value. Of each level of a tree every 16 consecutive nodes become their H, the last run without padding, as
long as a level has several nodes.

Leaves are dealt out by ranges of (source, id), so a partition holds stretches of sources that begin and end anywhere. A task runs a
mountain range over each stretch: a stack that holds one open run a level. A full aligned run carries into the level above, as a digit of
base 16 does; what can't carry, because a run began before the stretch or ends after it, is left loose, 30 nodes a level at most. Loose
nodes of all stretches are merged level by level by grouping on the parent's number: a group has at most 16 rows.

Proofs: blocks of 4096 leaves get the path above them, which all their leaves share, and fold it under their own three levels.

Defined results: null sources are one source, the first; others are ordered by their UTF-8 bytes. Null ids come first in a source and are
never tampered with; equal ids are ordered by their leaves; repeated rows each give a leaf and a row. An empty table gives no rows. Null
and empty texts differ. Other columns than those that are named aren't read.

Plan: texts are read once, by JVM hashing; rows of some 150 bytes follow. They are shuffled twice: by ranges, and by blocks for the
proofs; both split a hot source. Tables of nodes are a fifteenth of the leaves. The driver sees the largest tree's size and the root. Every
source gets its path in the tree of sources, about a kB a level, so very many sources of one row cost that much each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import broadcast_within, drop, stage
from terrasieve.llm.columns import crc32_of_id

FANOUT = 16
#: Levels of a block of leaves.
LOCAL = 3
BLOCK = FANOUT**LOCAL
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of sources.
TOP = ""
_SHIFT = 33  # monotonically_increasing_id: the partition's number stands above this bit


def h(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_hash(columns: list[Column]) -> Column:
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def counts_of(total: int) -> list[int]:
    """Nodes of each level of a tree, from its leaves to its root."""
    counts = [total]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // FANOUT))
    return counts


def _count_at(level: int) -> Column:
    """Nodes at a level of a tree with `total` leaves, in whole numbers: a double's quotient would be wrong above 2^53."""
    width = FANOUT**level
    return F.expr(f"(total + {width - 1}) div {width}")


class Mountains:
    """One stretch of a tree: push its leaves in order, then end(). rows: (tree, level, number, hash, loose, total) of every node whose run is
    settled; leaves only where they are loose."""

    def __init__(self, tree: str, total: int, rows: list[tuple]):
        self.tree, self.total, self.rows = tree, total, rows
        self.counts = counts_of(total)
        self.runs: list[tuple[int, list[str]]] = [(0, []) for _ in self.counts]

    def _settle(self, level: int, loose: bool) -> None:
        first, run = self.runs[level]
        if level or loose:
            self.rows.extend((self.tree, level, first + k, x, loose, self.total) for k, x in enumerate(run))
        self.runs[level] = (0, [])

    def push(self, number: int, digest: str, level: int = 0) -> None:
        while True:
            if not self.runs[level][1]:
                self.runs[level] = (number, [])
            first, run = self.runs[level]
            run.append(digest)
            if self.counts[level] == 1:  # the root
                return self._settle(level, False)
            if number % FANOUT < FANOUT - 1 and number < self.counts[level] - 1:
                return None
            whole = first % FANOUT == 0
            self._settle(level, not whole)
            if not whole:
                return None
            number, digest, level = number // FANOUT, h(run), level + 1

    def end(self) -> None:
        for level in range(len(self.runs)):
            self._settle(level, True)


_NODES = "tree string, level int, number long, hash string, loose boolean, total long"


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.int64())
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tree", "level", "number", "hash", "loose", "total"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A mountain range for each stretch of consecutive leaves in a task's rows (tree, number, total, hash)."""
    at, after, rows = None, -1, []
    for b in batches:
        for tree, number, total, digest in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if at is None or at.tree != tree or number != after:
                if at is not None:
                    at.end()
                at = Mountains(tree, total, rows)
            at.push(number, digest)
            after = number + 1
        yield _node_batch(rows)
        rows.clear()
    if at is not None:
        at.end()
        yield _node_batch(rows)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows (tree, …) with number (rank from 0 within tree, by order, in which trees come one after the other) and total (rows of the tree)."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("part", F.shiftright("place", _SHIFT)), "merkle-dealt")
    pieces = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    each = Window.partitionBy("tree")  # a row a partition
    before = each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(each).alias("total"))
    pieces = broadcast_within(stage(pieces, "merkle-pieces"))
    return dealt.join(pieces, ["tree", "part"]).withColumn("number", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _run(digest: str = "hash") -> Column:
    """Of a group of siblings: their hashes, left to right."""
    return F.transform(F.array_sort(F.collect_list(F.struct("number", digest))), lambda x: x[digest])


def _grown(leaves: DataFrame) -> tuple[DataFrame, int]:
    """Nodes (tree, level, number, hash, total) above the leaves (tree, number, total, hash), and how many levels the largest tree has."""
    levels = len(counts_of(leaves.agg(F.max("total")).first()[0] or 1)) - 1
    ordered = leaves.select("tree", "number", "total", "hash").sortWithinPartitions("tree", "number")
    nodes = stage(ordered.mapInArrow(_stretches, _NODES), "merkle-nodes")
    columns = ["tree", "level", "number", "hash", "total"]
    all_nodes = nodes.filter("level > 0").select(columns)
    made = None
    for level in range(levels):
        loose = nodes.filter(F.col("loose") & (F.col("level") == level)).select(columns)
        loose = loose if made is None else loose.unionByName(made.filter(_count_at(level) > 1))
        runs = loose.groupBy("tree", F.expr(f"number div {FANOUT}").alias("parent")).agg(_run().alias("run"), F.first("total").alias("total"))
        made = stage(runs.select("tree", F.lit(level + 1).alias("level"), F.col("parent").alias("number"), F.sha2(F.array_join("run", ""), 256).alias("hash"), "total"), "merkle-merged")
        all_nodes = all_nodes.unionByName(made)
    return all_nodes, levels


def _paths(nodes: DataFrame, tops: DataFrame, levels: int, least: int) -> DataFrame:
    """(tree, number, path) of every node at level `least`, and of the roots of trees that don't reach it. tops: (tree, total, path) of the
    roots. path, upwards: place in the run, and the run's hashes."""
    found = None
    for level in range(levels - 1, least - 1, -1):
        runs = nodes.filter((F.col("level") == level) & (_count_at(level) > 1))
        runs = runs.groupBy("tree", F.expr(f"number div {FANOUT}").alias("parent")).agg(_run().alias("run"))
        above = tops.filter((_count_at(level + 1) == 1) & (_count_at(level) > 1)).select("tree", F.lit(0).cast("long").alias("parent"), "path")
        above = above if found is None else above.unionByName(found.select("tree", F.col("number").alias("parent"), "path"))
        step = runs.join(above, ["tree", "parent"]).select("tree", "parent", "run", "path", F.posexplode("run").alias("at", "own"))
        path = F.concat(F.array(F.struct("at", F.array_join("run", "").alias("run"))), "path")
        found = step.select("tree", (F.col("parent") * FANOUT + F.col("at")).alias("number"), path.alias("path"))
    low = tops.filter(_count_at(least) == 1).select("tree", F.lit(0).cast("long").alias("number"), "path")
    return low if found is None else found.unionByName(low)


@dataclass
class Manifest:
    """leaves: tree, doc_id, hash, tampered, number, total, row. nodes: tree, level, number, hash, total. tops: the same of each source's
    root with its path to the root. levels: of the largest source. root: None without rows. A source's tree is named by source_key."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame
    levels: int
    root: str | None


def source_key(source: Column) -> Column:
    """Names of trees: in their order, the null source comes first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    """text with A-Z, and nothing else, in lower case."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def build_manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", source_col: str = "source", tamper: dict[str, Column] | None = None, tampered: Column | None = None) -> Manifest:
    """The trees over docs. tamper: other values of columns; a second leaf is made with them for rows where `tampered` holds."""
    cols = {c: F.col(c) for c in columns}
    changed = leaf_hash([(tamper or {}).get(c, cols[c]) for c in columns])
    read = docs.select(
        source_key(F.col(source_col)).alias("tree"),
        F.col(id_col).alias("doc_id"),
        leaf_hash(list(cols.values())).alias("hash"),
        (F.when(tampered, changed) if tampered is not None else F.lit(None).cast("string")).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(read, "merkle-leaves")  # texts are hashed once, not again for the bounds of ranges
    leaves = _numbered(rows, [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")])
    drop(rows)
    nodes, levels = _grown(leaves)
    leaf_nodes = leaves.filter("total = 1").select("tree", F.lit(0).alias("level"), "number", "hash", "total")
    roots = nodes.filter(_root_level()).unionByName(leaf_nodes).select("tree", "hash", "total")
    roots = stage(roots, "merkle-roots")
    top = _numbered(roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "hash", F.col("total").alias("size")), [F.col("tree"), F.col("of")])
    top = stage(top, "merkle-tops")
    top_nodes, top_levels = _grown(top)
    last = (top_nodes.filter(F.col("level") == top_levels) if top_levels else top).select("hash").first()
    empty = F.array().cast("array<struct<at:int,run:string>>")
    crown = top.limit(1).select("tree", "total", empty.alias("path"))
    base = top.select("tree", F.lit(0).alias("level"), "number", "hash", "total")
    paths = _paths(base.unionByName(top_nodes), crown, top_levels, 0)
    tops = top.join(paths.select("number", "path"), "number").select(F.col("of").alias("tree"), "hash", F.col("size").alias("total"), "path")
    return Manifest(leaves, nodes, stage(tops, "merkle-top-paths"), levels, last[0] if last else None)


def _root_level() -> Column:
    """Whether a node is its tree's root: one node at its level, several below it."""
    width = F.expr("shiftleft(1L, 4 * level)")
    return (F.col("number") == 0) & (F.col("total") <= width)


def _siblings(run: list[str], at: int) -> str:
    return "".join(run[:at]) + "".join(run[at + 1 :])


def _folded(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    for at, run in steps:
        digest = h([*run[:at], digest, *run[at + 1 :]])
    return digest


def _block_proofs(leaves: list[str], tampered: list[str | None], total: int, path: list[tuple[int, list[str]]]) -> tuple[list[str], list[str]]:
    """Of the leaves of one block: the hash of each one's siblings, and the root that it folds to. total: leaves of its tree."""
    levels = [leaves]
    for count in counts_of(total)[:LOCAL]:
        if count > 1:
            levels.append([h(levels[-1][i : i + FANOUT]) for i in range(0, len(levels[-1]), FANOUT)])
    shared = "".join(_siblings(run, at) for at, run in path)
    above: dict[tuple[int, int], str] = {}

    def proof(level: int, number: int) -> str:
        """Siblings of the nodes from this one up."""
        if level == len(levels) - 1:
            return shared
        if (level, number) not in above:
            first = number - number % FANOUT
            above[level, number] = _siblings(levels[level][first : first + FANOUT], number - first) + proof(level + 1, number // FANOUT)
        return above[level, number]

    proofs, roots = [], []
    for i, leaf in enumerate(leaves):
        steps, number = [], i
        for level in levels[:-1]:
            first = number - number % FANOUT
            steps.append((number - first, level[first : first + FANOUT]))
            number //= FANOUT
        first = i - i % FANOUT
        own = shared if len(levels) == 1 else _siblings(leaves[first : first + FANOUT], i - first) + proof(1, i // FANOUT)
        proofs.append(sha256(own.encode()).hexdigest())
        roots.append(_folded(tampered[i] or leaf, steps + path))
    return proofs, roots


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's blocks one after the other; a block's path comes before its leaves."""

    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    names = ["row", "proof_sha256", "folded_root", "doc_id", "leaf", "subroot"]
    out: list[list] = [[] for _ in names]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    for _, held in groupby(rows(), key=lambda r: (r[0], r[1])):
        head, *leaves = held
        path = [(s["at"], [s["run"][k : k + 64] for k in range(0, len(s["run"]), 64)]) for s in head[8]]
        proofs, roots = _block_proofs([r[4] for r in leaves], [r[5] for r in leaves], head[7], path)
        for o, more in zip(out, ([r[6] for r in leaves], proofs, roots, [r[3] for r in leaves], [r[4] for r in leaves], [head[4]] * len(leaves)), strict=True):
            o.extend(more)
        if len(out[0]) >= BLOCK:
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)], names=names)
            out = [[] for _ in names]
    yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)], names=names)


def prove(manifest: Manifest) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root (from its tampered leaf if it has one), verified, row."""
    block = F.expr(f"number div {BLOCK}").alias("block")
    leaves = manifest.leaves.select("tree", block, "number", F.col("doc_id").cast("long").alias("doc_id"), F.col("hash").alias("leaf"), "tampered", "row")
    paths = _paths(manifest.nodes, manifest.tops, manifest.levels, LOCAL)
    tops = manifest.tops.select("tree", F.col("hash").alias("leaf"), "total")
    heads = paths.withColumnRenamed("number", "block").join(tops, "tree")
    both = leaves.unionByName(heads, allowMissingColumns=True).select("tree", "block", "number", "doc_id", "leaf", "tampered", "row", "total", "path")
    dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("number").asc_nulls_first())
    out = dealt.mapInArrow(_proofs, "row long, proof_sha256 string, folded_root string, doc_id long, leaf string, subroot string")
    root = F.lit(manifest.root).cast("string")
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"), "row")


def tampering(docs: DataFrame, one_in: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What the manifest says of docs of which one in so many, by a hash of the id, had its text's A-Z put into lower case: prove()'s rows."""
    picked = F.coalesce(F.pmod(crc32_of_id(id_col), F.lit(one_in)) == 0, F.lit(False))
    return prove(build_manifest(docs, id_col=id_col, tamper={text_col: lower_ascii(F.col(text_col))}, tampered=picked)).drop("row")
