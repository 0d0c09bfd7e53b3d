"""Repeated rows: they don't gather in one block or at the driver, and change no result."""

import numpy as np

from terrasieve.llm import hamming, quality


def test_hamming_blocks_hold_no_repeats(spark, monkeypatch):
    rng = np.random.default_rng(8)
    once = [(i, int(c)) for i, c in enumerate(rng.integers(-(1 << 63), 1 << 63, 60))]
    rows = spark.createDataFrame(once + [once[7]] * 500 + [(7, 5)], "id long, code long")
    plain = spark.createDataFrame([*once, (7, 5)], "id long, code long")
    ask = lambda df: df.filter("id % 7 = 0")
    want = sorted(hamming.hamming_topk(plain, ask(plain), 5).collect())
    counts, stage = {}, hamming.stage

    def counted(df, name):  # the tables are deleted at the end
        df = stage(df, name)
        counts[name] = df.count()
        return df

    monkeypatch.setattr(hamming, "stage", counted)
    assert sorted(hamming.hamming_topk(rows, ask(rows), 5).collect()) == want
    assert counts["hamming-rows"] == 61 and counts["hamming-queries"] == ask(plain).count()


def test_quality_sample_has_one_row_an_id(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen, fit = [], quality.fit_ranking
    monkeypatch.setattr(quality, "fit_ranking", lambda x, y, cut: seen.append((x, y)) or fit(x, y, cut))
    quality.learn_quality(docs, labels)
    repeated = docs
    for _ in range(4):
        repeated = repeated.unionByName(docs)
    quality.learn_quality(repeated, labels)
    (x, y), (x5, y5) = seen
    assert len(x) and np.array_equal(x, x5) and np.array_equal(y, y5)
