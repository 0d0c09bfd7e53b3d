"""Brute force, round trips and edge cases of the operators that SQL can't state."""

import base64
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from terrasieve.llm.byte_bpe import ByteBpe, decode_ids, encode_ids, round_trip
from terrasieve.llm.hamming import Block, binary_codes, hamming_topk
from terrasieve.llm.langid import identify, learn_languages
from terrasieve.llm.minhash import components, drop_near_copies, near_duplicates
from terrasieve.llm.quality import keep_quality, learn_quality, score_quality
from terrasieve.llm.sharding import balanced_shards, quotas
from terrasieve.llm.toxicity import COMMA, EMIT, INSULT, NEGATION, OTHER, REPORT, STEP, STOP, TARGET, Grammar, learn_toxicity, score_toxicity

TIKTOKEN = P.path("byte_bpe_50k.tiktoken")
ODD = [(1, None, "a"), (1, "", "b"), (None, "one", "c"), (3, " \t\n", None), (3, "Two words", "e"), (3, "Two words", "e"), (7, "long " * 30_000, "f")]
SCHEMA = "doc_id long, text string, kept string"


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(TIKTOKEN, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library():
    rnd, mine, theirs = random.Random(3), ByteBpe(TIKTOKEN, P.PATTERN), library()
    alphabet = ["a", "b", "th", "ing", "é", "汉", "😀", " ", "  ", "\n", " \n", "'s", "9", "!", "\xa0", "z" * 40]
    for _ in range(4000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25)))
        ids = mine.encode(text)
        assert ids == theirs.encode_ordinary(text), repr(text)
        assert mine.decode(ids) == text.encode()


def test_bpe_frames(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    theirs = library()
    got = encode_ids(docs, TIKTOKEN, P.PATTERN)
    assert sorted((r.doc_id or -1, len(r.ids)) for r in got.collect()) == sorted((i or -1, len(theirs.encode_ordinary(t or ""))) for i, t, _ in ODD)
    assert sorted(r.data for r in decode_ids(got, TIKTOKEN, P.PATTERN).collect()) == sorted((t or "").encode() for _, t, _ in ODD)
    assert round_trip(docs.limit(0), TIKTOKEN, P.PATTERN).count() == 0


def test_quotas_keep_room():
    allowed = quotas({(0, 1): 5, (1, 0): 3, (0, 2): 4}, [0, 1, 2])
    assert allowed == {(0, 1): 4, (1, 0): 3, (0, 2): 2}


@pytest.mark.parametrize("hot", [0, 500])
def test_shards(spark, hot):
    texts = [f"text {i // 3 if i < 120 else i}" for i in range(400)] + ["hot"] * hot + [None, None, ""]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, shard int").repartition(3)
    rows = balanced_shards(docs, 16).collect()
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 1 and r.grown_shard is None and r.law == "rows"
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    where = defaultdict(set)
    for r in rows:
        if r.doc_id < 120:
            where[texts[r.doc_id]].add(r.shard)
    assert sum(len(v) > 1 for v in where.values()) <= (0 if not hot else 8)  # cut groups
    if hot:
        held = Counter(r.shard for r in rows if texts[r.doc_id] == "hot")
        assert sum(n * n for n in held.values()) >= 1.3 * hot * hot / 16  # far more neighbours together than by chance
    assert balanced_shards(docs.limit(0), 16).count() == 0 and balanced_shards(docs.limit(3), 16).count() == 3


def test_hamming_against_brute_force(spark):
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    codes[50:90] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    block = Block(np.arange(300), codes)
    for q in range(0, 300, 20):
        far = np.bitwise_count(codes ^ codes[q]).astype(int)
        want = sorted((far[i], i) for i in range(300) if i != q)[:10]
        ids, distances = block.search(q, codes[q], 10)
        assert [*zip(distances.tolist(), ids.tolist(), strict=True)] == want
    table = spark.createDataFrame([(i, rng.normal(size=64).tolist(), 1) for i in range(60)] + [(5, rng.normal(size=64).tolist(), 1), (61, None, 1), (62, [1.0], 1)], "vec_id long, embedding array<double>, id int")
    found = binary_codes(table, "vec_id", "embedding")
    rows = hamming_topk(found, found.filter("id % 20 = 0"), 5).collect()
    assert Counter(r.query_id for r in rows) == {0: 5, 20: 5, 40: 5} and all(r.id != r.query_id for r in rows)
    assert hamming_topk(found.limit(0), found.limit(0), 5).count() == 0


def test_hamming_over_several_blocks(spark, monkeypatch):
    """Null ids and codes, ties, several codes of one id, and bounds carried from one round of blocks to the next."""
    from terrasieve.llm import hamming

    monkeypatch.setattr(hamming, "ROW_BLOCK", 40)
    monkeypatch.setattr(hamming, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(9)
    rows = [(i, int(c)) for i, c in enumerate(rng.integers(0, 1 << 12, 400))]  # few bits: many ties
    rows += [(17, 5), (17, 99), (20, 1 << 62), (None, 3), (None, 4), (900, None)]
    df = spark.createDataFrame(rows, "id long, code long").repartition(5)
    got = defaultdict(list)
    for r in hamming_topk(df, df.filter("id % 20 = 0 or id is null"), 7).collect():
        got[r.query_id].append((r.rank, r.distance, r.id))
    held = [r for r in rows if None not in r]
    for q in {i for i, _ in held if i % 20 == 0}:
        far = {}
        for i, c in held:
            if i != q:
                far[i] = min([far.get(i, 99), *((c ^ x).bit_count() for j, x in held if j == q)])
        want = sorted((d, i) for i, d in far.items())[:7]
        assert sorted(got.pop(q)) == [(n + 1, d, i) for n, (d, i) in enumerate(want)]
    assert not got


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def test_near_duplicates_against_brute_force(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "Solo", "solo", "A b", "a  B"]
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        for _ in range(9):  # edits of many sizes: similarities on both sides of the threshold
            copy = list(base)
            for _ in range(rnd.randint(0, 8)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append(" ".join(copy))
    root, n = brute_components(texts, 2, 80)
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, component_id string").repartition(3)
    got = {r.doc_id: r for r in near_duplicates(docs, 2, 80).collect()}
    assert [got[i].component_id for i in range(len(texts))] == root and [got[i].n_shingles for i in range(len(texts))] == n
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    root5, _ = brute_components(texts, 5, 80)
    kept = drop_near_copies(docs, 5, 80)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(root5))
    assert near_duplicates(docs.limit(0)).count() == 0
    odd = near_duplicates(spark.createDataFrame(ODD, SCHEMA)).collect()
    assert len(odd) == len(ODD)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(900, 901)]
    got = {r.c: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[901] == 900


def run_symbols(*symbols):
    state, out = 0, []
    for s in symbols:
        out.append(EMIT[STEP[state][s] if s not in (COMMA, STOP) else state][s])
        state = STEP[state][s]
    return [x for x in out if x >= 0]


def test_grammar_scores_clauses():
    assert run_symbols(TARGET, OTHER, INSULT, STOP) == [4 * 4 + 2]
    assert run_symbols(TARGET, NEGATION, OTHER, INSULT, STOP) == [1 * 4 + 2]
    assert run_symbols(REPORT, COMMA, INSULT, STOP, INSULT, STOP) == [4 * 4 + 1, 4 * 4]
    g = Grammar({"scum": 5.0, "lowe*": 5.0})
    assert len(g.clauses("You are scum. Fine words, scum said. loweil")) == 3
    assert not g.clauses("clean words only.") and g.score(["you are scum"])[0] > 0.7 > g.score(["he is not scum"])[0] and g.score([""])[0] < 0.3


def tables(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_classifiers_held_out(spark):
    docs, labels = tables(spark)
    truth = {r.doc_id: r for r in labels.collect()}
    quality = learn_quality(docs, labels)
    toxic = learn_toxicity(docs, labels)
    for rows, label in ((score_quality(docs, quality).collect(), "quality"), (score_toxicity(docs, toxic).collect(), "toxic")):
        held = [r for r in rows if r.held_out and r.doc_id in truth]
        assert held and all(0 <= r.score <= 1 for r in rows)
        assert sum(r.predicted == truth[r.doc_id][label] for r in held) >= 0.95 * len(held)
    rows = {r.doc_id: r for r in identify(docs, learn_languages(docs)).collect()}
    langs = [(r.lang, rows[r.doc_id].lang_pred) for r in docs.collect() if rows[r.doc_id].held_out]
    assert sum(a == b for a, b in langs) >= 0.95 * len(langs)


def test_classifiers_on_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    assert score_quality(odd, learn_quality(docs, labels)).count() == len(ODD)
    assert score_toxicity(odd, learn_toxicity(docs, labels)).count() == len(ODD)
    none = learn_quality(docs, labels.limit(0))
    assert {r.score for r in score_quality(odd, none).collect()} == {0.5}
    assert keep_quality(odd, none).columns == odd.columns
    assert learn_toxicity(docs, labels.limit(0)).lexicon
    got = identify(odd, learn_languages(docs)).collect()
    assert [r.lang_pred for r in got if r.doc_id == 1] == ["und", "und"]
    assert {r.lang_pred for r in identify(odd, learn_languages(docs.limit(0))).collect()} == {"und"}
