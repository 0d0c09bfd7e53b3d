"""Columns of any type through the pipeline's stages, exact bounds of samples, links that fit a shard, clauses without a cap."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from terrasieve.llm import langid, learning, sharding
from terrasieve.llm import toxicity as tox

SF = "/root/testdata/sf0.001"


def test_stages_carry_columns_of_any_type(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    twice = docs.unionByName(docs.filter("doc_id % 4 = 0"))  # repeated rows
    more = twice.withColumns({"m": F.create_map("lang", "n_chars"), "a": F.split(F.substring("text", 1, 30), " "), "s": F.struct("lang", F.create_map("source", "doc_id").alias("inner"))})
    more = more.withColumn("odd", F.when(F.col("doc_id") % 3 == 0, F.col("m")))
    plain, wide = twice, more
    for name, step in cp.STAGES[:-1]:
        plain, wide = step(spark, plain, SF), step(spark, wide, SF)
        assert wide.columns == more.columns
        got = wide.select("doc_id", F.map_keys("m")[0].alias("k"), F.col("s.inner")[F.col("source")].alias("i"), "lang").collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in plain.select("doc_id").collect()), name
        assert all(r.k == r.lang and r.i == r.doc_id for r in got)
        plain, wide = (cp.stage(d, "typed") for d in (plain, wide))
    last = cp.STAGES[-1][1]
    assert last(spark, wide, SF).count() == last(spark, plain, SF).count()


def test_samples_are_bounded_exactly(spark):
    rows = spark.range(5000).select((F.col("id") % 2000).alias("doc_id"), (F.col("id") % 3).cast("int").alias("label"), F.lit("t").alias("text")).repartition(7)
    same = spark.range(900).select(F.lit(5).cast("long").alias("doc_id"), F.lit(1).alias("label"), F.lit("t").alias("text"))
    both = rows.unionByName(same)
    counts = learning.label_counts(both, "label")
    picked = learning.stratified(both, "label", counts, 100, "doc_id", "text").groupBy("label").count().collect()
    assert {r[0]: r[1] for r in picked if r[0] != 1} == {0: 100, 2: 100} and all(r[1] <= 100 for r in picked)
    few = learning.stratified(both, "label", counts, 10**6, "doc_id").groupBy("label").count().collect()
    assert {r[0]: r[1] for r in few} == counts
    docs = spark.range(300).select(F.lit(5).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))  # one labelled id, many texts
    labels = spark.createDataFrame([(5, 1)], "doc_id long, toxic int")
    held = learning.labelled_texts(docs, labels, "toxic", 3, 0, 10).collect()
    assert len(held) <= 1


def test_counts_of_languages(spark):
    docs = spark.createDataFrame([(i, "en" if i % 3 else "de", f"word{i} the") for i in range(90)], "doc_id long, lang string, text string").repartition(4)
    model = langid.learn_languages(docs, mod=4, remainder=9)
    assert model.langs == ["de", "en"] and np.allclose(np.exp(model.log_prob).sum(axis=1), 1, atol=1e-3) and np.allclose(np.exp(model.log_prior), [1 / 3, 2 / 3])
    whole = np.full(langid.WIDTH, 0.5)
    for i in range(0, 90, 3):
        np.add.at(whole, langid.grams([f"word{i} the"])[0], 1)
    assert np.allclose(model.log_prob[0], np.log(whole / whole.sum()), atol=1e-5)


def test_links_that_fit_are_not_dealt(spark):
    """Ten pairs and twenty rows alone over 16 shards of two or three rows each: pairs stay together."""
    rows = [(i, f"t{i // 2}") for i in range(20)] + [(i, f"alone {i}") for i in range(20, 40)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    at = {r.doc_id: r.shard for r in got}
    assert sum(at[i] == at[i + 1] for i in range(0, 20, 2)) >= 9


def test_every_clause_counts():
    g = tox.Grammar({"scum": 5.0}, np.r_[tox.DEFAULT_WEIGHTS[:-1], 0.5])
    raw = [g.features("You are scum. " * n + "Fine words. " * (200 - n)) @ g.weights for n in (1, 2, 4, 8, 16, 32, 64, 128)]
    assert all(b > a + 0.1 for a, b in zip(raw, raw[1:], strict=False))


def test_held_out_toxicity(spark):
    """Recall of toxic rows, and clean rows that are flagged, apart: 4 of the 18 held-out toxic texts have no learned or listed word at all."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = tox.score_toxicity(docs, tox.learn_toxicity(docs, labels), cut=0.7).filter("held_out").join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 14 and n.get((0, 1), 0) <= 0.01 * n[0, 0]
