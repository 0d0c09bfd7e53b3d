"""MinHash near-dedup with b-bit signatures.

Each row's set of word shingles (64-bit hashes) gives ROWS * BANDS minima. ROWS minima at a time make a band's key for candidate
generation; of every minimum the two lowest bits are kept and packed. Within a band's bucket every class of equal sets is compared with
one pivot; classes that are linked to it need no pairs among themselves. Such a pair must pass the sizes' ratio and the similarity that
the packed bits estimate, corrected for chance agreement (SLACK below the threshold, over five standard deviations); then the full sets
are intersected. Linked classes form components. Where buckets hold several components, links across them are sought among the classes
concerned: sets that are similar enough share one of their rarest shingles, and only pairs that do are intersected.

At similarity 0.8 a pair misses all 32 bands of 5 rows with probability 3e-6; no bucket, partner or candidate is capped.

Defined results: words are [^ \\t-\\r]+ after lower-casing A-Z; with fewer words than a shingle has, the whole sequence is one. Null text,
empty text and text without words have an empty set and are linked with nothing: their component is their own id. Rows with equal sets
are one class, so repeated rows cost one comparison; null ids never name a component unless all its ids are null. Of several rows with
the id that stays, all are marked kept. Extra columns are not read.

Plan: texts are read once for signatures (about 400 bytes a row, no texts or sets), twice more for rows that are in a candidate pair. Classes go by
a number of 8 bytes from then on. Links and components stay in Spark; label rounds run on tables written to the shared folder, which are
deleted as soon as the decisions are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import broadcast_within, drop, stage
from terrasieve.llm.byte_runs import scramble, word_hashes
from terrasieve.llm.columns import whole_text
from terrasieve.llm.worker_memory import make_room, slices

ROWS, BANDS, SLACK = 5, 32, 0.25
#: Counters that put shingles in order of rarity (8 MB in the driver and each worker).
PLACE_BITS = 20
PLACES = 1 << PLACE_BITS
_RNG = np.random.default_rng(10)
_A = _RNG.integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RNG.integers(1, 1 << 63, (ROWS, BANDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles."""
    hashes, at = word_hashes(texts)
    sets = []
    for h in np.split(hashes, at[1:-1]):
        n = min(size, len(h))
        total = h[: len(h) - n + 1].copy()
        for i in range(1, n):
            total = scramble(total + _PLACE) + h[i : len(h) - n + 1 + i]
        sets.append(np.unique(scramble(total + np.uint64(n))) if n else h)
    return sets


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set that isn't empty, as two numbers."""
    data = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(data[:8], "little", signed=True), int.from_bytes(data[8:], "little", signed=True)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of ROWS * BANDS hash functions over a set."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 2048):
        x = hashes[i : i + 2048, None] * _A
        np.minimum(least, x.min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; the band's number is in it."""
    total = (scramble(least.reshape(ROWS, BANDS)) * _MIX).sum(axis=0, dtype=np.uint64)
    return scramble(total + np.arange(BANDS, dtype=np.uint64))


def packed(least: np.ndarray) -> np.ndarray:
    """Two low bits of each scrambled minimum, 32 of them in a 64-bit number."""
    low = (scramble(least) & np.uint64(3)).reshape(-1, 32)
    return (low << (np.uint64(2) * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        make_room("minhash")
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text").to_pylist(), size)
                named = [set_key(s) if len(s) else (None, None) for s in sets]
                least = [minima(s) if len(s) else None for s in sets]
                lists = [[None if x is None else f(x).view(np.int64) for x in least] for f in (bands, packed)]
                columns = [pa.array(range(row, row + len(sets)), pa.int64()), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
                columns += [pa.array(x, pa.int64()) for x in zip(*named, strict=True)] + [pa.array(x, pa.list_(pa.int64())) for x in lists]
                row += len(sets)
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n", "k0", "k1", "bands", "bits"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("minhash")
        for batch in batches:
            for part in slices(batch):
                sets = [s for s in shingle_sets(part.column("text").to_pylist(), size) if len(s)]
                if sets:
                    named = zip(*map(set_key, sets), strict=True)
                    yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in named], pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["k0", "k1", "hashes"])

    return run


def estimate(a: str, b: str) -> Column:
    """Similarity by the packed bits of two columns of bits: agreement less what chance gives."""

    def apart(i: int) -> Column:
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    parts = ROWS * BANDS // 32
    differing = sum((apart(i) for i in range(1, parts)), apart(0))
    return (1 - differing / F.lit(ROWS * BANDS) - 0.25) / 0.75


def _plausible(similarity: float, a: str = "", b: str = "p_") -> Column:
    """Whether sizes and packed bits of two sides allow the similarity."""
    sizes = (F.col(f"{a}n") >= similarity * F.col(f"{b}n") - 1e-6) & (F.col(f"{b}n") >= similarity * F.col(f"{a}n") - 1e-6)
    return sizes & (estimate(f"{a}bits", f"{b}bits") >= similarity - SLACK)


def _read_sets(docs: DataFrame, needed: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(c, hashes) of the full sets of the classes in needed (c). classes: (c, id, k0, k1), id of a row of it. Texts are read once more."""
    needed = stage(needed.join(classes, "c"), "minhash-needed")
    ids = stage(needed.select(F.col("id").alias("i")).distinct(), "minhash-ids")
    texts = docs.join(broadcast_within(ids), F.col("doc_id").eqNullSafe(F.col("i")), "left_semi")
    sets = texts.select("text").mapInArrow(_sets(size), "k0 long, k1 long, hashes array<long>")
    found = sets.join(broadcast_within(needed.select("c", "k0", "k1")), ["k0", "k1"]).groupBy("c").agg(F.first("hashes").alias("hashes"))
    found = stage(found, "minhash-sets")
    drop(needed, ids)
    return found


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    left = pairs.join(sets.select(F.col("c").alias("a"), F.col("hashes").alias("x")), "a")
    both = left.join(sets.select(F.col("c").alias("b"), F.col("hashes").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(PLACES, dtype=np.int64)
    for b in batches:
        h = b.column("hashes").values.to_numpy(zero_copy_only=False).view(np.uint64)
        total += np.bincount((h >> np.uint64(64 - PLACE_BITS)).astype(np.int64), minlength=PLACES)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["place", "n"])


def _rarest(frequency, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequency.value
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for c, root, hashes in zip(b.column("c").to_pylist(), b.column("root").to_pylist(), b.column("hashes"), strict=True):
                h = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
                n = len(h)
                first = np.lexsort((h, often[(h >> np.uint64(64 - PLACE_BITS)).astype(np.int64)]))[: n - -(-percent * n // 100) + 1]
                k = len(first)
                for column, value in zip(out, (np.full(k, c), np.full(k, root), np.full(k, n), np.arange(k), h[first].view(np.int64)), strict=True):
                    column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], names=["c", "root", "n", "place", "token"])

    return run


def _across(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different roots that may be similar enough. sets: (c, root, hashes).

    In one order of all shingles, rare ones first, two sets of that similarity share a shingle among the first n - least overlap + 1 of
    each, and behind the first that they share there must be enough left. Nothing similar enough is lost; the order, by counts in
    PLACES hashed places, only decides how many pairs are looked at."""
    spark = sets.sparkSession
    counted = sets.select("hashes").mapInArrow(_frequencies, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(PLACES, dtype=np.int64)
    often[counted["place"].to_numpy()] = counted["n"].to_numpy()
    rarest = sets.mapInArrow(_rarest(spark.sparkContext.broadcast(often), percent), "c long, root long, n long, place long, token long")
    rarest = stage(rarest, "minhash-rarest")
    other = rarest.select(*[F.col(c).alias(f"p_{c}") for c in rarest.columns])
    most = F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place"))  # what the sets can still share from this shingle on
    enough = (100 + percent) * most >= percent * (F.col("n") + F.col("p_n"))
    pairs = rarest.join(other, (F.col("token") == F.col("p_token")) & (F.col("root") < F.col("p_root")) & enough)
    pairs = stage(pairs.select(F.col("c").alias("a"), F.col("p_c").alias("b")).distinct(), "minhash-across")
    drop(rarest)
    return pairs


def components(links: DataFrame) -> DataFrame:
    """(c, root): root is the least class reachable over links (a, b). Every class of links has a row. Links are contracted between
    rounds: each round joins every class to the least neighbour, then follows that pointer once more, so classes at least halve."""
    edges = stage(links.filter("a <> b").select("a", "b"), "links")
    label = stage(edges.select(F.explode(F.array("a", "b")).alias("c")).distinct().withColumn("root", F.col("c")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("k"), F.least("a", "b").alias("next")), "least")
        jump = least.select(F.col("k").alias("k2"), F.col("next").alias("next2"))
        up = stage(least.join(jump, F.col("next") == F.col("k2"), "left").select("k", F.coalesce("next2", "next").alias("next")), "up")
        moved = edges.join(up.select(F.col("k").alias("ka"), F.col("next").alias("na")), F.col("a") == F.col("ka"))
        moved = moved.join(up.select(F.col("k").alias("kb"), F.col("next").alias("nb")), F.col("b") == F.col("kb"))
        after = stage(moved.filter("na <> nb").select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(), "links")
        named = stage(label.join(up, F.col("root") == F.col("k"), "left").select("c", F.coalesce("next", "root").alias("root")), "labels")
        drop(edges, least, up, label)
        edges, label = after, named
    drop(edges)
    return label


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    d = whole_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    held: list[DataFrame] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        held.append(stage(df, name))
        return held[-1]

    rows = keep(d.mapInArrow(_signatures(size), f"row long, doc_id {kind}, n long, k0 long, k1 long, bands array<long>, bits array<long>"), "minhash-rows")
    # a class: rows with equal sets. It goes by the least row number, whose row has its signature
    classes = keep(rows.filter("k0 is not null").groupBy("k0", "k1").agg(F.min("doc_id").alias("id"), F.min("row").alias("c")), "minhash-classes")
    signed = rows.join(broadcast_within(classes.select(F.col("c").alias("s"))), F.col("row") == F.col("s"), "left_semi")
    signed = keep(signed.select(F.col("row").alias("c"), "n", "bands", "bits"), "minhash-signed")
    spread = signed.select("c", F.explode("bands").alias("bucket"))
    buckets = keep(spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("pivot")).filter("size > 1").select("bucket", "pivot"), "minhash-buckets")
    members = keep(spread.join(broadcast_within(buckets), "bucket").select("bucket", "c", "pivot"), "minhash-members")
    stars = members.filter("c <> pivot").select("c", "pivot").distinct().join(signed.select("c", "n", "bits"), "c")
    pivots = signed.select(F.col("c").alias("p_c"), F.col("n").alias("p_n"), F.col("bits").alias("p_bits"))
    stars = stars.join(pivots, F.col("pivot") == F.col("p_c")).filter(_plausible(percent / 100))
    stars = keep(stars.select(F.col("pivot").alias("a"), F.col("c").alias("b")), "minhash-stars")
    sets = _read_sets(d, stars.select(F.explode(F.array("a", "b")).alias("c")).distinct(), classes, size)
    links = keep(_confirmed(stars, sets, percent), "minhash-links")
    drop(sets)
    root = components(links)
    # buckets that hold several components: links across them
    placed = members.select("bucket", "c").join(root.select(F.col("c").alias("k"), "root"), F.col("c") == F.col("k"), "left")
    placed = keep(placed.select("bucket", "c", F.coalesce("root", "c").alias("root")), "minhash-placed")
    mixed = keep(placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket"), "minhash-mixed")
    mixed = keep(placed.join(broadcast_within(mixed), "bucket", "left_semi").select("c", "root").distinct(), "minhash-left")
    sets = _read_sets(d, mixed.select("c"), classes, size)
    across = _across(sets.join(mixed, "c").select("c", "root", "hashes"), percent)
    more = keep(_confirmed(across, sets, percent), "minhash-links")
    drop(sets, across)
    if not more.isEmpty():
        drop(root)
        root = components(links.unionByName(more))
    held.append(root)
    named = root.join(classes.select("c", "id"), "c")
    least = keep(named.groupBy("root").agg(F.min("id").alias("component")), "minhash-least")
    found = classes.join(root.join(least, "root").select("c", "component"), "c", "left").select("k0", "k1", F.coalesce("component", "id").alias("component"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "k0", "k1").join(found, ["k0", "k1"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    out = stage(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "minhash-decided")
    drop(*held)
    return out


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group, with its own columns: the row of the least id. Rows with an empty set all stay. Rows that
    share an id stay together if one of them stays."""
    decided = near_duplicates(docs, size, percent, id_col, text_col).groupBy(F.col("doc_id").alias("i")).agg(F.max("kept").alias("stays"))
    gone = broadcast_within(stage(decided.filter(~F.col("stays")).select("i"), "minhash-gone"))
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return renamed.join(gone, F.col(f"c{docs.columns.index(id_col)}").eqNullSafe(F.col("i")), "left_anti").toDF(*docs.columns)
