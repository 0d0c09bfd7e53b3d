import re
from collections import defaultdict

from pyspark.sql import functions as F

from terrasieve.llm.exact_dedup import drop_copies, exact_dedup

ROWS = [(1, "a b", "k"), (2, "ab ", "k"), (3, "a  b", "k"), (4, None, "k"), (5, " \t\n", "k"), (6, "", "k"), (7, "A b", "k"), (8, "x y", "k"), (9, "xy", "k"), (9, "xy", "k"), (None, "zz", "k"), (10, "long " * 20_000, "k")]
SCHEMA = "doc_id long, text string, kept string"


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i))
    return {k: (min(v)[2], len(v)) for k, v in groups.items()}


def test_against_brute_force(spark):
    for shrink in (None, lambda c: F.unhex(F.lit("00"))):  # the second makes all texts collide
        docs = spark.createDataFrame(ROWS, SCHEMA)
        got = exact_dedup(docs, **({"hash_of": shrink} if shrink else {})).collect()
        assert len(got) == len(ROWS)
        found = defaultdict(list)
        for r in got:
            found[r.text_sha256].append(r)
        want = sorted(map(str, brute(ROWS).values()))
        assert sorted(str((v[0].keep_id, len(v))) for v in found.values()) == want
        assert all(sum(r.kept for r in v) == 1 and {r.group_size for r in v} == {len(v)} for v in found.values())


def test_drop_copies_keeps_one_row_each(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in got.collect()) == sorted((k or 0) for k, _ in brute(ROWS).values())
    assert drop_copies(docs.limit(0)).count() == 0


def test_drop_copies_when_all_hashes_collide(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = drop_copies(docs, hash_of=lambda c: F.unhex(F.lit("00")))
    assert sorted((r.doc_id or 0) for r in got.collect()) == sorted((k or 0) for k, _ in brute(ROWS).values())
