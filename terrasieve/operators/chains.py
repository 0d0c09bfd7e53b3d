"""List ranking by pointer doubling, and lines chained from edges that meet two by two.

A successor graph in which every node has one successor at most, and is the successor of one at most, falls into lists and rings. In each
round every node that hasn't reached its list's end takes over the pointer of the node that it points to, so lists of n nodes take log n
joins, and no task ever holds a list. Rings have no end: each is cut before its least node and ranked in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import counted, drop, stage


def _doubled(state: DataFrame) -> DataFrame:
    """state (node, place, to, dist, least, last) with pointers as far on as lists go: last is the place of a list's end, null for rings' nodes,
    whose least is that of the whole ring. Staged; state goes."""
    reach, before, n = 1, None, state.count()
    while True:
        left = state.filter("last is null").count()
        # a list's nodes come to its end in every round until all have; what then is left lies on rings, none longer than that
        if left == 0 or (left == before and reach >= left):
            return state
        before = left
        ahead = state.select(F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("dist").alias("_d"), F.col("least").alias("_l"), F.col("last").alias("_e"))
        moved = state.filter("last is null").join(counted(ahead, n), F.col("to") == F.col("_n"))
        moved = moved.select("node", "place", F.col("_to").alias("to"), (F.col("dist") + F.col("_d")).alias("dist"), F.least("least", "_l").alias("least"), F.col("_e").alias("last"))
        after = stage(state.filter("last is not null").unionByName(moved), "ranks")
        drop(state)
        state, reach = after, 2 * reach


def list_ranks(nodes: DataFrame) -> DataFrame:
    """nodes (node long, next long or null, place: unique and of any type that has an order) as node, place, first, last (places of the list's
    first and last node) and seq (from 0). A ring begins at its least place. A next that isn't a node raises no error: the list ends there."""
    nodes = stage(nodes, "nodes")
    n = nodes.count()
    known = nodes.select(F.col("node").alias("_k"))
    held = nodes.join(counted(known, n), F.col("next") == F.col("_k"), "left")
    ends = F.col("_k").isNull()
    begun = held.select("node", "place", F.coalesce("_k", "node").alias("to"), F.when(ends, 0).otherwise(1).cast("long").alias("dist"), F.col("place").alias("least"), F.when(ends, F.col("place")).alias("last"))
    lists = _doubled(stage(begun, "ranks"))
    rings = lists.filter("last is null").select("node", "place", F.col("least").alias("head"))
    rings = stage(rings.join(counted(nodes.select("node", "next"), n), "node"), "rings")
    drop(nodes)
    after = rings.select(F.col("node").alias("_n"), F.col("place").alias("_p"))
    cut = rings.join(counted(after, n), F.col("next") == F.col("_n"))
    ends = F.col("_p") == F.col("head")
    opened = cut.select("node", "place", F.when(ends, F.col("node")).otherwise(F.col("next")).alias("to"), F.when(ends, 0).otherwise(1).cast("long").alias("dist"), F.col("place").alias("least"), F.when(ends, F.col("place")).alias("last"))
    opened = _doubled(stage(opened, "ranks"))
    drop(rings)
    ranks = lists.filter("last is not null").unionByName(opened).select("node", "place", "dist", "last")
    whole = ranks.groupBy("last").agg(F.max("dist").alias("n"), F.max_by("place", "dist").alias("first"))
    return ranks.join(counted(whole.withColumnRenamed("last", "_last"), n), F.col("last") == F.col("_last")).select("node", "place", "first", "last", (F.col("n") - F.col("dist")).alias("seq"))


def chained(edges: DataFrame, key: str) -> DataFrame:
    """Lines of edges (key, ax, ay, bx, by; whole numbers): edges that share a corner with one other edge of their key, and no third, go on into
    it. Per corner of a line: key, line (its first two corners, `x y x y`), seq from 0, x, y, ring. A line begins at the lesser of its ends;
    a ring at its least corner, towards the lesser neighbour, and that corner comes once more at the end. Directions and repeats of an edge
    don't count, edges of no length go, and so do null corners."""
    a, b = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    e = edges.dropna(subset=["ax", "ay", "bx", "by"]).select(key, F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct()
    e = stage(e.withColumn("e", F.monotonically_increasing_id()), "chain-edges")
    ways = [F.struct((2 * F.col("e") + i).alias("node"), F.col(u).alias("u"), F.col(v).alias("v")) for i, (u, v) in enumerate((("a", "b"), ("b", "a")))]
    arcs = e.select(key, F.explode(F.array(*ways)).alias("w")).select(key, "w.*")
    met = arcs.groupBy(key, "v").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("i"), F.max("node").alias("j")).filter("n = 2")
    turned = lambda c: F.col(c).bitwiseXOR(F.lit(1))
    on = met.select(F.explode(F.array(F.struct(F.col("i").alias("node"), turned("j").alias("next")), F.struct(F.col("j").alias("node"), turned("i").alias("next")))).alias("s")).select("s.*")
    placed = arcs.withColumn("place", F.struct(key, "u", "v")).join(counted(on.withColumnRenamed("node", "_n"), 2 * e.count()), F.col("node") == F.col("_n"), "left")
    ranks = list_ranks(placed.select("node", "next", "place"))
    # each line was ranked both ways: the way whose first edge is the lesser one stays
    other = F.struct(F.col(f"last.{key}").alias(key), F.col("last.v").alias("u"), F.col("last.u").alias("v"))
    lines = ranks.filter(F.col("first") < other)
    spots = F.array(F.struct("seq", F.col("place.u").alias("p")), F.when(F.col("place") == F.col("last"), F.struct((F.col("seq") + 1).alias("seq"), F.col("place.v").alias("p"))))
    rows = lines.select("first", (F.col("first.u") == F.col("last.v")).alias("ring"), F.explode(spots).alias("s")).filter("s is not null")
    name = F.concat_ws(" ", *[F.col(f"first.{w}.{c}").cast("string") for w in "uv" for c in "xy"])
    return rows.select(F.col(f"first.{key}").alias(key), name.alias("line"), "s.seq", F.col("s.p.x").alias("x"), F.col("s.p.y").alias("y"), "ring")
