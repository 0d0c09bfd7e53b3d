"""Corpus pipeline: quality, toxicity, exact dedup, near-dedup, packing. Counted as part of the llm subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents, whatever they are called besides doc_id and text. No stage changes a row. An empty
table gives an empty table. The order of rows doesn't count.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrasieve.functions.staging import stage
from terrasieve.llm.exact_dedup import drop_copies
from terrasieve.llm.minhash import drop_near_copies
from terrasieve.llm.packing import pack
from terrasieve.llm.quality import keep_quality, learn_quality
from terrasieve.llm.toxicity import drop_toxic, learn_toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking doesn't reject. A null text is scored as an empty one, which goes or stays by its features' score; a null id
    makes no difference; of repeated rows all stay or none; a score at the cut stays."""
    return keep_quality(docs, learn_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), cut=0.3))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose clauses don't reach the toxic score. Null and empty texts have no clause and stay; a null id makes no difference; of
    repeated rows all stay or none; a score at the cut goes."""
    return drop_toxic(docs, learn_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")), cut=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts. Null, empty and blank texts are one group; null ids come last; of several rows with the
    text and the id that stay, one stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more. Texts without words all stay; rows that share
    the id that stays stay together; null ids stay only in groups without others."""
    return drop_near_copies(docs, size=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. A null or empty text gives its end id alone; repeated and null ids are documents of their own."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048)


STAGES = [("quality", quality), ("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("packing", packing)]

#: Learned scores and packing can't be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = _read(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
