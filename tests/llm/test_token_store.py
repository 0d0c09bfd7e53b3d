import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from terrasieve.llm import token_store as ts
from terrasieve.llm.word_tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_encoder_equals_the_library_on_odd_texts():
    texts = ["", " ", "Hello, World's  end\n\n\tx", "İstanbul ΣΑΣ étude", "a\x1cb \x1d c\x0bd\x0ce\x85f\xa0g h​i﻿", "<|endoftext|> x<|startoftext|>y", "汉字 😀😀 ½ ٣٤", "z" * 5000, "́ ́a"]
    texts += [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    library = Tokenizer.from_file(PATH)
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in WordEncoder(PATH).encode(texts)] == expected


def test_crc32_of_parts():
    rng = np.random.default_rng(1)
    for _ in range(20):
        parts = [rng.bytes(int(n)) for n in rng.integers(0, 300, 4)]
        assert ts.crc32_joined([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_cuts_cover_and_resynchronise():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 49_000, 40_000).astype("<u2")
    b = np.concatenate([rng.integers(0, 49_000, 777).astype("<u2"), a])
    parts = lambda x: [x[i:j].tobytes() for i, j in zip([0, *ts.cuts(x)], ts.cuts(x), strict=False)]
    assert b"".join(parts(a)) == a.tobytes()
    assert len(set(parts(a)) & set(parts(b))) >= 0.8 * len(parts(a))


@pytest.mark.parametrize("rows", [[], [(2, None, "x"), (1, "One two three. " * 900, "y"), (1, "One two three. " * 900, "y"), (None, "", "z"), (5, "last one", "w")]])
def test_round_trip(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunks string")
    path = str(tmp_path / "store")
    ts.write_store(docs, path, PATH)
    got = sorted(ts.read_store(spark, path).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(PATH)
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    restored = {r.start: r.ids for r in ts.restore(spark, path).collect()}
    for row, want in zip(got, order, strict=True):
        ids = [*library.encode(want[1] or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, row.verified) == (want[0], at, len(ids), True)
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert restored[at] == ids
        at += len(ids)
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("chunk").distinct().count()


def test_damage_is_seen(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"Text {i}. " * 400) for i in range(6)], "doc_id long, text string").repartition(2)
    recipes = lambda p: sorted((tmp_path / p / "recipes").glob("*.parquet"), key=lambda f: f.stat().st_size)
    for name in ("lost", "emptied", "chunks"):
        ts.write_store(docs, str(tmp_path / name), PATH)
        assert all(r.verified for r in ts.read_store(spark, str(tmp_path / name)).collect())
    recipes("lost")[-1].unlink()
    part = recipes("emptied")[-1]
    pq.write_table(pq.read_table(part).slice(0, 0), part)
    (part.parent / f".{part.name}.crc").unlink()
    for name in ("lost", "emptied"):
        with pytest.raises(ValueError, match="manifest"):
            ts.read_store(spark, str(tmp_path / name)).collect()
        with pytest.raises(ValueError, match="manifest"):
            ts.restore(spark, str(tmp_path / name)).collect()
    gone = spark.read.parquet(f"{tmp_path}/chunks/recipes").filter("doc_id = 3").first().chunks
    for f in (tmp_path / "chunks" / "chunks").glob("*.parquet"):
        t = pq.read_table(f)
        pq.write_table(t.filter(pa.array([c not in set(map(bytes, gone)) for c in t.column("chunk").to_pylist()], pa.bool_())), f)
        (f.parent / f".{f.name}.crc").unlink()
    got = {r.doc_id: r for r in ts.read_store(spark, f"{tmp_path}/chunks").collect()}
    assert len(got) == 6 and not got[3].verified and got[3].n_tokens == 0
    with pytest.raises(Exception, match="lacks a chunk"):
        ts.restore(spark, f"{tmp_path}/chunks").collect()
