"""Every stage against brute force, on its own input."""

import re

import numpy as np
from test_llm_operators import brute_components

import corpus_pipeline as cp
from terrasieve.llm.quality import features, learn_quality
from terrasieve.llm.toxicity import learn_toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    got = {}
    for name, step in cp.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.schema == docs.schema
        docs = out.cache()
        got[name] = {r.doc_id: r.text for r in docs.collect()}
    model = learn_quality(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    want = {i: t for i, t in given.items() if model.score(features(t)[None])[0] >= 0.3}
    assert got["quality"] == want
    grammar = learn_toxicity(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    want = {i: t for i, t in want.items() if grammar.score([t])[0] < 0.7}
    assert got["toxicity"] == want
    best = {}
    for i, t in want.items():
        k = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[k] = min(best.get(k, (0, 1 << 60)), (-len(t), i))
    want = {i: given[i] for _, i in best.values()}
    assert got["exact_dedup"] == want
    ids = sorted(want)
    root, _ = brute_components([want[i] for i in ids], 5, 80)
    assert sorted(got["near_dedup"]) == [ids[i] for i in sorted(set(root))]
    pieces = cp.packing(spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == set(got["near_dedup"])
    assert np.array([r.length for r in pieces]).max() <= 2048
