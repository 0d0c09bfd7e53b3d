"""Prefix trie of conversations, built family by family.

A family is what shares c - c % 100: a base conversation and those derived from it. Each conversation c is rebuilt as the first h turns of
its base, h being crc32 of c's decimal text modulo 6, and then its own turns after its first h. Turns are equal if role and text are.

Family first: conversations and their base's turns are dealt out by family, and one pass over a family in order rebuilds its conversations
and merges them into a small trie, whose nodes are keyed by a hash of the turns that lead to them. Only these combined nodes are shuffled
by key for the trie of all. What sums over a whole subtree needs no walk over its levels: every node of the whole trie is owned by the
family that has its smallest member, so each family sums over its own trie what it owns, and the families' sums add up.

Defined results: turns are ordered by number (null first), then role, then a hash of the text; null role and text count as empty. Rows
without a conv_id belong to no conversation and are left out. Repeated rows are turns of their own. c % 100 has c's sign, so -7 belongs to
family 0. An empty table gives no rows, not even the root. Other columns than those that are named aren't read.

Plan: texts are hashed where they are read; rows of about 60 bytes follow. Families are streamed: a worker holds a family's nodes down to
depth KEPT (deeper ones go out one by one, uncombined, and merge by key all the same), so one endless conversation needs no memory, only
one task's time. A node's ended conversations are hashed in a stream of one row a family.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import stage

FAMILY, HEAD = 100, 6
#: Depth to which a family's nodes are combined before they are shuffled.
KEPT = 1000
ROWS = 20_000
_ROOT = blake2b(b"", digest_size=16).digest()

_FIELDS = {"family": pa.int64(), "no": pa.int64(), "up": pa.int64(), "key": pa.binary(), "parent": pa.binary(), "depth": pa.int64(), "chars": pa.int64(), "n": pa.int64(), "least": pa.int64(), "first_end": pa.int64(), "ends": pa.string()}
_SCHEMA = "family long, no long, up long, key binary, parent binary, depth long, chars long, n long, least long, first_end long, ends string"


class _Node:
    __slots__ = ("no", "up", "key", "parent", "depth", "chars", "n", "least", "ends", "below")

    def __init__(self, no: int, up: int | None, key: bytes, parent: bytes | None, depth: int, chars: int, least: int):
        self.no, self.up, self.key, self.parent, self.depth, self.chars, self.least = no, up, key, parent, depth, chars, least
        self.n, self.ends, self.below = 0, [], {}


class Family:
    """The trie of one family. Conversations come in ascending order, their turns as (digest, chars). out gets a row for each node."""

    def __init__(self, number: int, out: list[tuple], kept: int = KEPT):
        self.number, self.out, self.kept = number, out, kept
        self.head: list[tuple[bytes, int]] = []
        self.nodes: list[_Node] = []
        self.conv: int | None = None
        self.made, self.at, self.skip = 0, None, 0
        self.root: _Node | None = None

    def _emit(self, x: _Node) -> None:
        self.out.append((self.number, x.no, x.up, x.key, x.parent, x.depth, x.chars, x.n, x.least, x.ends[0] if x.ends else None, ",".join(map(str, x.ends)) if x.ends else None))

    def _leave(self) -> None:
        """The node that the conversation stands at won't be met again if it lies below the kept depth."""
        if self.at.depth > self.kept:
            self._emit(self.at)

    def _end(self) -> None:
        if self.conv is not None:
            self.at.ends.append(self.conv)
            self._leave()
            self.conv = None

    def base_turn(self, digest: bytes, chars: int) -> None:
        if len(self.head) < HEAD - 1:
            self.head.append((digest, chars))

    def _step(self, digest: bytes, chars: int) -> None:
        here = self.at
        node = here.below.get(digest)
        if node is None:
            self.made += 1
            node = _Node(self.made, here.no, blake2b(here.key + digest, digest_size=16).digest(), here.key, here.depth + 1, chars, self.conv)
            if node.depth <= self.kept:
                here.below[digest] = node
                self.nodes.append(node)
        self._leave()
        node.n += 1
        self.at = node

    def turn(self, conv: int, digest: bytes, chars: int) -> None:
        if conv != self.conv:
            self._end()
            if self.root is None:
                self.root = _Node(0, None, _ROOT, None, 0, 0, conv)
                self.nodes.append(self.root)
            self.conv, self.at = conv, self.root
            self.root.n += 1
            self.skip = zlib.crc32(str(conv).encode()) % HEAD
            for first in self.head[: self.skip]:
                self._step(*first)
        if self.skip:
            self.skip -= 1
        else:
            self._step(digest, chars)

    def close(self) -> None:
        self._end()
        for x in self.nodes:
            self._emit(x)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _FIELDS.values(), strict=True)], names=list(_FIELDS))


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, []
    for b in batches:
        for family, kind, conv, digest, chars in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now.number != family:
                if now is not None:
                    now.close()
                now = Family(family, out)
            if kind:
                now.turn(conv, digest, chars)
            else:
                now.base_turn(digest, chars)
            if len(out) >= ROWS:
                yield _batch(out)
                out.clear()
    if now is not None:
        now.close()
    yield _batch(out)


def family_nodes(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes of each family's trie: family, no, up (numbers in the family), key and parent (hashes of the turns), depth, chars of the last
    text, n (members), least (smallest member), first_end and ends (members that end there, ascending)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.unhex(F.substring(said, 1, 32)).alias("digest"), F.char_length(text).cast("long").alias("chars"))
    turns = turns.withColumn("family", F.col("conv") - F.col("conv") % FAMILY)
    bases = F.when(F.col("conv") == F.col("family"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    both = turns.withColumn("kind", F.explode(bases))  # a base's turns come twice: first for the family's heads, then as its own
    dealt = both.repartition("family").sortWithinPartitions("family", "kind", "conv", F.col("turn").asc_nulls_first(), "role", "digest")
    return dealt.select("family", "kind", "conv", "digest", "chars").mapInArrow(_families, _SCHEMA)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (family, no, up, key, leaf, spent, own), in a family from the last node to the first, so that children come before parents: key and
    the three numbers summed over the node's subtree in its family. Only sums for parents that are still to come are held."""
    family, waiting = None, {}
    for b in batches:
        keys, sums = [], []
        for f, no, up, key, *numbers in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if f != family:
                family, waiting = f, {}
            total = [a + c for a, c in zip(numbers, waiting.pop(no, (0, 0, 0)), strict=True)]
            if up is not None:
                waiting[up] = [a + c for a, c in zip(total, waiting.get(up, (0, 0, 0)), strict=True)]
            keys.append(key)
            sums.append(total)
        columns = list(zip(*sums, strict=True)) if sums else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(pa.array(c, pa.int64()) for c in columns)], names=["key", "leaves", "spent", "own"])


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ends) in order: the hash of each key's ends joined by commas."""
    now, state = None, None
    for b in batches:
        done = []
        for key, ends in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if key != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = key, sha256(ends.encode())
            else:
                state.update(f",{ends}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())], names=["key", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """Per node of the trie of all rebuilt conversations: conv_id (smallest member), depth, parent_conv_id (of the parent; null for the
    root), n_convs (members), n_children, n_leaves (childless nodes in its subtree, itself included), saved_tokens (over its subtree, each
    node's members but one times the code points of its last text), ends_sha256 (hash of the members that end there, joined by commas)."""
    families = stage(family_nodes(conversations, **columns), "trie-families")
    merged = families.groupBy("key").agg(F.min("least").alias("conv_id"), F.sum("n").alias("n_convs"), F.first("parent").alias("parent"), F.first("depth").alias("depth"))
    merged = stage(merged, "trie-merged")
    children = merged.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    above = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = merged.join(children, "key", "left").join(above, "parent", "left").drop("parent")
    nodes = stage(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    owner = F.col("least") == F.col("conv_id")
    known = families.join(nodes.select("key", "conv_id", "n_children"), "key")
    values = known.select("family", "no", "up", "key", (owner & (F.col("n_children") == 0)).cast("long").alias("leaf"), (F.col("n") * F.col("chars")).alias("spent"), F.when(owner, F.col("chars")).otherwise(F.lit(0)).alias("own"))
    ordered = values.repartition("family").sortWithinPartitions("family", F.col("no").desc())
    sums = ordered.mapInArrow(_subtrees, "key binary, leaves long, spent long, own long")
    sums = sums.groupBy("key").agg(F.sum("leaves").alias("n_leaves"), (F.sum("spent") - F.sum("own")).alias("saved_tokens"))

    ends = families.filter("ends is not null").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    ends = ends.select("key", "ends").mapInArrow(_ended, "key binary, ends_sha256 string")
    out = nodes.join(sums, "key").join(ends, "key", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))
