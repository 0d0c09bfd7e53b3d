import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terrasieve.llm import packing as pk

PATH = public_tokenizers.path("word_bpe_49k.json")


def cost(length, size):
    return 0 if length & (length - 1) == 0 else size - length


def brute(at, penalty, size):
    positions, best = [0, *at], [0]
    for j in range(1, len(positions)):
        widths = [(positions[j] - positions[i], i) for i in range(j)]
        allowed = [(w, i) for w, i in widths if w <= size]
        pad = lambda w: 0 if w & (w - 1) == 0 and w >= size // 4 else size - w
        best.append(min(best[i] + pad(w) for w, i in allowed) + penalty[j - 1] + pk.WINDOW_COST)
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_optimal(seed):
    rng = np.random.default_rng(seed)
    size = 64
    ends = np.unique(rng.integers(1, 600, rng.integers(2, 60)))
    length = int(ends[-1])
    docs = np.unique(np.append(rng.choice(ends, 3), length))
    at, penalty = pk.boundaries(length, docs, ends, stride=16)
    cuts = pk.cut(at, penalty, size)
    widths = np.diff([0, *cuts])
    assert widths.max() <= size and cuts[-1] == length
    of = dict(zip(at.tolist(), penalty.tolist(), strict=True))
    pad = lambda w: 0 if w & (w - 1) == 0 and w >= size // 4 else size - w
    assert sum(pad(int(w)) + of[c] + pk.WINDOW_COST for w, c in zip(widths, cuts, strict=True)) == brute(at.tolist(), penalty.tolist(), size)


def test_every_id_in_one_piece(spark):
    text = "One two three. Four five! " * 300
    rows = [(i, text[: 17 * i * i], "x") for i in range(60)] + [(3, "again", "x"), (None, None, "x"), (99, "word " * 9000, "x"), (100, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string").repartition(3)
    got = pk.pack(docs, PATH, size=2048).collect()
    library = Tokenizer.from_file(PATH)
    wanted = defaultdict(list)
    for i, t, _ in rows:
        wanted[i].append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append(r)
    for i, lists in wanted.items():
        for ids in lists:
            at = 0
            for r in sorted(pieces[i, len(ids)], key=lambda r: r.start):
                assert r.start == at and zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()) == r.ids_crc32
                at += r.length
            assert at == len(ids)
    padding = total = 0
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding, total = padding + cost(at, 2048), total + at
    assert padding <= 0.01 * total
    assert pk.pack(docs.limit(0), PATH).count() == 0
