"""The trie of families against a plain trie over all rebuilt conversations."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

from terrasieve.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, family int, n_convs int, least string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in by.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        n = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100  # the remainder has c's sign
        built = tuple(turns.get(c - base, [])[:n] + turns[c][n:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    out = []
    for node, held in members.items():
        below = [u for u in members if u[: len(node)] == node]
        children = [u for u in below if len(u) == len(node) + 1]
        leaves = [u for u in below if not any(w[: len(u)] == u and len(w) > len(u) for w in below)]
        saved = sum((len(members[u]) - 1) * len(u[-1][1]) for u in below if u)
        joined = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(children), len(leaves), saved, sha256(joined.encode()).hexdigest()))
    return sorted(map(repr, out))


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(5)
    assert sorted(repr(tuple(r[c] for c in COLUMNS)) for r in trie.prefix_trie(df).collect()) == brute(rows)


def test_random_conversations(spark):
    rnd = random.Random(3)
    ids = [*range(-130, 260, 7), 0, 100, 200, -100, 1000, 1003, 4711]
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bb", "\U0001f600cc"])) for c in ids for t in range(rnd.randrange(1, 9))]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (5, None, "user", ""), (5, 1, "user", "x"), (5, 1, "user", "x"), (7, 0, "user", "long " * 20_000), (0, 0, "", ""), (0, 1, None, ""), (901, 0, "user", "only")]
    check(spark, rows)  # 901 has no base
    check(spark, [(c, 0, "user", "same") for c in range(300)])
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_uncombined_depths():
    """Nodes below the kept depth go out one by one; keys, members and ends are the same."""
    turns = [bytes([k % 3]) * 16 for k in range(12)]

    def run(kept):
        out = []
        f = trie.Family(0, out, kept)
        for conv in (1, 2, 3, 9):
            for k, t in enumerate(turns[: 12 - conv % 2]):
                f.turn(conv, t, k)
        f.close()
        merged = defaultdict(lambda: [0, set(), ""])
        for _, no, up, key, parent, depth, chars, n, least, first, ends in out:
            assert up is None or up < no
            m = merged[key]
            m[0] += n
            m[1].add((parent, depth, chars))
            m[2] += ends or ""
        return {k: (n, tuple(s), "".join(sorted(e.replace(",", "")))) for k, (n, s, e) in merged.items()}, len(out)

    whole, small = run(1000)
    same, more = run(2)
    assert whole == same and more > small
