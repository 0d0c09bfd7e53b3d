"""Sharding: balanced label propagation.

Rows with one link value (by default, equal texts) are linked with each other. Each round, joins move every linked row towards the shard
that holds most of its neighbours: a link's rows are counted in each shard, so no pairs are made. Quotas hold the moves: between two
shards as many rows are exchanged as want to go either way, beyond that only as many enter as a shard has room. Rows without a link
settle last and fill every shard to its capacity, so counts differ by one at most (law `rows`).

A link that holds more rows than the smallest shard is dealt by a hash into parts of nine tenths of a shard on average, each a link of its
own; any other link is one part.

Rounds go on until no row may move, or until a round doesn't lower the number of rows that lie outside their link's largest shard; then
the state before it stays. That number falls with every other round, so the rounds end.

Defined results: null text has no bytes and size 1, and is linked with nothing; empty texts are equal texts like any others. Null and
repeated ids, and repeated rows, each give a row and a slot. An empty table gives no rows. Extra columns are not read.

Plan: DataFrame operations only. Texts are read once; rows of about 60 bytes are written to the shared folder. Ranks are found by bucket
counts, so no window holds more than a bucket of rows, or a row for each bucket (5 million for 10^11 rows). A matrix of shards x shards
counts goes to the driver each round, nothing else.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import drop, stage
from terrasieve.llm.columns import own_exchange

#: Rows in a bucket of ranks on average, at most.
BUCKET_ROWS = 20_000


def ranked(df: DataFrame, part: list[str], total: int, name: str) -> DataFrame:
    """df, which must have a unique column row, with the gapless rank from 0 of each row within part, as name."""
    n = max(1, math.ceil(total / BUCKET_ROWS))
    df = df.withColumn("__b", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(n)))
    sizes = df.groupBy(*part, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    sizes = sizes.select(*[F.col(c).alias(f"__{c}") for c in part], F.col("__b").alias("__c"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__at"))
    inside = F.row_number().over(Window.partitionBy(*part, "__b").orderBy("row")) - 1
    held = df.withColumn("__r", inside)
    on = (F.col("__b") == F.col("__c")) & F.lit(True)
    for c in part:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return held.join(sizes, on).withColumn(name, (F.col("__at") + F.col("__r")).cast("long")).drop("__b", "__c", "__at", "__r", *[f"__{c}" for c in part])


def quotas(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows may go from one shard to another: exchanges, then what room there is."""
    allowed = {(i, j): min(n, wanted.get((j, i), 0)) for (i, j), n in wanted.items()}
    for (i, j), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - allowed[i, j], room[j])
        allowed[i, j] += more
        room[j] -= more
        room[i] += more
    return allowed


def propagate(linked: DataFrame, capacity: list[int], total: int) -> DataFrame:
    """(row, link, shard) of linked rows, which come as (row, link). total: how many they are."""
    shards, turn = len(capacity), 0
    state = ranked(linked, [], max(1, total), "rank")
    # dealt round the shards: no shard gets more than its capacity, which falls with its number as what it is dealt does
    state = stage(state.select("row", "link", (F.col("rank") % shards).cast("int").alias("shard")), "shard-state")
    before, least = None, total + 1
    while True:
        counts = state.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("link").agg(F.max_by("shard", F.struct("n", F.xxhash64("link", "shard", F.lit(turn)))).alias("to"))
        best = best.select(own_exchange(F.col("link")).alias("h"), "to")
        wishes = state.withColumn("h", own_exchange(F.col("link"))).join(best, "h").select("row", "link", "shard", "to")
        wishes = stage(wishes, "shard-wishes")
        flow = {(r[0], r[1]): r[2] for r in wishes.groupBy("shard", "to").count().collect()}
        held = [sum(n for (i, _), n in flow.items() if i == s) for s in range(shards)]
        wanted = {k: n for k, n in flow.items() if k[0] != k[1]}
        away = sum(wanted.values())
        if away >= least:
            drop(wishes, state)
            return before
        if before is not None:
            drop(before)
        allowed = quotas(wanted, [max(0, c - h) for c, h in zip(capacity, held, strict=True)])
        if not sum(allowed.values()):
            drop(wishes)
            return state
        table = F.array(*[F.lit(allowed.get((i, j), 0)) for i in range(shards) for j in range(shards)])
        movers = ranked(wishes.filter("shard <> to"), ["shard", "to"], max(1, away), "rank")
        moved = movers.select("row", "link", F.when(F.col("rank") < table[F.col("shard") * shards + F.col("to")], F.col("to")).otherwise(F.col("shard")).alias("shard"))
        before, least, turn = state, away, turn + 1
        state = stage(wishes.filter("shard = to").select("row", "link", "shard").unionByName(moved), "shard-state")
        drop(wishes)


def _dealt(rank: Column, edges: list[int]) -> Column:
    """The shard of a rank, where shard s takes ranks from edges[s] to edges[s + 1]."""
    shard = F.lit(len(edges) - 2)
    for s in range(len(edges) - 2, 0, -1):
        shard = F.when(rank < edges[s], F.lit(s - 1)).otherwise(shard)
    return shard.cast("int")


def balanced_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", link: Column | None = None) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law). link: what linked rows share; by default
    the 128-bit hash of the text."""
    data = F.col(text_col).cast("binary")
    link = F.unhex(F.md5(data)) if link is None else link
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(data, F.lit("").cast("binary"))).alias("text_crc32"),
        link.cast("binary").alias("link"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(read, "shard-rows")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    groups = rows.filter(F.col("link").isNotNull()).groupBy("link").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = groups.select(own_exchange(F.col("link")).alias("h"), F.when(F.col("n") > min(capacity), F.ceil(F.col("n") / max(1, int(0.9 * min(capacity))))).otherwise(F.lit(1)).alias("parts"))
    linked = rows.select("row", "link", own_exchange(F.col("link")).alias("h")).join(groups, "h")
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row", F.lit(9)), F.col("parts"))).otherwise(F.lit(0))
    linked = stage(linked.select("row", F.unhex(F.md5(F.concat_ws("/", F.hex("link"), part).cast("binary"))).alias("link")), "shard-linked")
    n_linked = linked.count()
    state = propagate(linked, capacity, n_linked)
    held = {r[0]: r[1] for r in state.groupBy("shard").count().collect()}
    edges = [0]
    for s, c in enumerate(capacity):
        edges.append(edges[-1] + c - held.get(s, 0))
    alone = ranked(rows.select("row").join(linked.select("row"), "row", "left_anti"), [], max(1, total - n_linked), "rank")
    shard = stage(state.select("row", "shard").unionByName(alone.select("row", _dealt(F.col("rank"), edges).alias("shard"))), "shard-of")
    drop(linked, state)
    placed = ranked(rows.drop("link").join(shard, "row"), ["shard"], max(1, total // shards), "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
