"""Trees, proofs and tampering against a plain tree."""

import zlib
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from terrasieve.llm import merkle
from terrasieve.llm.queries import QUERIES


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree(leaves):
    """Levels from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """Sorted digests of every row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            at, proof, folded = i, [], leaf(r, lowered(r[4])) if cut else own
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    run, place = level[at - at % 16 : at - at % 16 + 16], at % 16
                    proof += run[:place] + run[place + 1 :]
                    folded = h(*run[:place], folded, *run[place + 1 :])
                    at //= 16
            out.append((r[0], own, trees[k][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(map(repr, out))


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, hash string, tree int, total double"


def check(spark, rows, parts):
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA).repartition(parts)
    assert sorted(repr(tuple(r[c] for c in COLUMNS)) for r in merkle.tampering(df).collect()) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "en", 0, ""), (1, None, "en", 3, "ABC"), (2, None, "en", 3, "abc"), (2, None, "en", 3, "Abd"), (3, "z", None, None, "É\U0001f600Z" * 5000)]
    rows += [(7, "hot", "en", 1, "A")] * 40 + [(i, "hot", "de", i, f"Text {i}") for i in range(-20, 300)] + [(i, f"s{i}é", "fr", 1, None) for i in range(30)]
    check(spark, rows, 5)
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.tampering(empty).count() == 0
    check(spark, [(5, "only", "en", 2, "Hi")], 1)


def test_deep_trees(spark):
    rows = [(i, "a" if i % 7 else "b", "en", i, f"T{i}") for i in range(4900)]
    check(spark, rows, 9)


def test_stretches_anywhere():
    """Any cuts of a tree's leaves settle the same nodes, once each, and leave loose only what merging needs."""
    rng = np.random.default_rng(4)
    for total in (1, 2, 15, 16, 17, 255, 256, 257, 700):
        leaves = [f"{i:064x}" for i in range(total)]
        levels = tree(leaves)
        for cuts in (0, 1, 4):
            at = sorted({0, total, *rng.integers(0, total + 1, cuts).tolist()})
            rows = []
            for a, b in zip(at, at[1:], strict=False):
                m = merkle.Mountains("t", total, rows)
                for i in range(a, b):
                    m.push(i, leaves[i])
                m.end()
            assert len({(r[1], r[2]) for r in rows}) == len(rows)
            assert all(levels[r[1]][r[2]] == r[3] for r in rows)
            loose = {(r[1], r[2]) for r in rows if r[4]}
            made = {(r[1], r[2]) for r in rows if r[1]}
            for level in range(len(levels) - 1):  # merging level by level finds the rest
                for k in range(len(levels[level + 1])):
                    if (level + 1, k) not in made:
                        run = {(level, j) for j in range(16 * k, min(16 * k + 16, len(levels[level])))}
                        assert run <= loose
                        made.add((level + 1, k))
                        loose.add((level + 1, k))
            assert len(made) == sum(map(len, levels[1:]))


def test_verified_means_unchanged_text(spark):
    got = QUERIES["op11_merkle"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cut = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    both = docs.select("doc_id", (cut & (merkle.lower_ascii(F.col("text")) != F.col("text"))).alias("changed")).join(got, "doc_id")
    assert both.count() == docs.count() and both.filter("changed = verified").count() == 0 and both.filter("changed").count() > 0
