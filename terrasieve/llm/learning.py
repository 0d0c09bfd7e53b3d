"""Bounded samples of labelled rows, and logistic loss on the driver's side of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import stage
from terrasieve.llm.columns import crc32_of_id


def held_out(mod: int, remainder: int, id_col: str = "doc_id"):
    """Whether the hold-out rule takes a row from learning; a null id is never learned from."""
    return F.coalesce(F.pmod(crc32_of_id(id_col), F.lit(mod)) == remainder, F.lit(True))


def label_counts(rows: DataFrame, label: str, most: int = 100) -> dict:
    """Rows of each label. One count for each goes to the driver; ValueError if there are more than `most` labels."""
    counts = rows.groupBy(label).count().limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError(f"more than {most} values of {label}")
    return {r[0]: r[1] for r in counts}


def stratified(rows: DataFrame, label: str, counts: dict, most: int, *by: str) -> DataFrame:
    """`most` rows of each label at most: the first by a hash of the columns `by`. A threshold leaves little more than those, and the first of
    them are taken task by task before labels meet, so no task holds more than `most` rows of a label from each other one."""
    share = F.lit(None).cast("double")
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, (most + 8 * most**0.5 + 8) / n))).otherwise(share)
    mixed = rows.withColumn("_h", F.shiftrightunsigned(F.xxhash64(*by, F.lit(77)), 1)).filter(F.col("_h") <= share * float(1 << 63))
    first = F.row_number().over(Window.partitionBy(label).orderBy("_h", *by))
    return mixed.withColumn("_n", first).filter(F.col("_n") <= most).drop("_h", "_n")


def labelled_ids(labels: DataFrame, label: str, mod: int, remainder: int) -> DataFrame:
    """(doc_id, label 0 or 1) of all rows that aren't held out; an id with both has 1."""
    picked = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col(label).isin(0, 1) & ~held_out(mod, remainder))
    return picked.groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, mod: int, remainder: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, text) of a sample of labelled rows that aren't held out: `most` ids of each label, with one text each, of several the
    least. The sample's ids are broadcast: 2 * most."""
    picked = labelled_ids(labels, label, mod, remainder)
    picked = stratified(picked, "label", label_counts(picked, "label"), most, "doc_id")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stage(texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def logistic_fit(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 300, rate: float = 0.05, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights of least mean logistic loss plus l2 / 2 * |w|^2, by Adam over all rows; deterministic."""
    w = np.zeros(x.shape[1], dtype=x.dtype)
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = (np.ones(len(y)) if weight is None else weight).astype(x.dtype)
    y = y.astype(x.dtype)
    total = weight.sum()
    for step in range(1, steps + 1):
        g = (weight * (sigmoid(x @ w) - y)) @ x / total + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w
