"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams (1 to 3 code points of the lower-cased text, white space runs as one blank) hashed into `width` buckets, with add-one
half smoothing, give a log-probability matrix. It is broadcast; batches of texts are scored as sparse sums of its rows in numpy.

Defined results: a text that is null or has no letter gets `und` and score 1; without any learned language every text gets `und` and
score 0. Equal posteriors: the language that is first in order. Repeated rows each get a row. An empty table gives an empty result.
Extra columns are not read.

Plan: the learning sample has `most` rows of each language at most (a documented bound); counts are summed by Spark and reach the driver
as languages x width numbers at most. More than MOST_LANGUAGES languages raise ValueError, as the matrix would outgrow a task. Scoring is
one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasieve.llm.columns import whole_text
from terrasieve.llm.learning import held_out, label_counts, stratified
from terrasieve.llm.worker_memory import make_room, slices

#: Languages at most: 210 MB while the matrix is made, half of that in each worker.
MOST_LANGUAGES = 400
#: Rows of each language in the learning sample at most; buckets of the hash; longest n-gram.
MOST, WIDTH, LONGEST = 2000, 1 << 16, 3
#: Odd 32-bit multipliers of the hash, one for each place in an n-gram.
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_SPACE = re.compile(r"\s+")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(_SPACE.sub(" ", f" {text.lower()} ").encode("utf-32-le", "surrogatepass"), dtype="<u4")


def grams(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and where each text's begin."""
    parts, starts, at = [], [], 0
    shift = np.uint32(32 - (width.bit_length() - 1))
    for text in texts:
        c = _points(text)
        starts.append(at)
        h = c * _MULTIPLIERS[0]
        for n in range(1, LONGEST + 1):
            if n > 1:
                h = (h[: len(c) - n + 1] ^ (h[: len(c) - n + 1] >> np.uint32(15))) * _MULTIPLIERS[n - 1] + c[n - 1 :] * _MULTIPLIERS[0]
            parts.append((h * _MULTIPLIERS[1]) >> shift)
            at += len(h)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array(starts, dtype=np.int64)


@dataclass(frozen=True)
class NaiveBayes:
    langs: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # languages x width, float32

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        buckets, starts = grams(texts, self.log_prob.shape[1])
        sums = np.stack([np.add.reduceat(row[buckets], starts, dtype=np.float64) for row in self.log_prob]) + self.log_prior[:, None]
        best = sums.argmax(axis=0)
        score = 1 / np.exp(sums - sums.max(axis=0)).sum(axis=0)
        lettered = [any(map(str.isalpha, t)) for t in texts]
        return [self.langs[i] if ok else "und" for i, ok in zip(best, lettered, strict=True)], np.where(lettered, score, 1.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lang in sorted(b.column("lang").unique().to_pylist()):
            total = np.zeros(WIDTH, dtype=np.int64)
            for part in slices(b.filter(pc.equal(b.column("lang"), lang))):
                total += np.bincount(grams(part.column("text").to_pylist())[0], minlength=WIDTH)
            h = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(h)), pa.array(h, pa.int32()), pa.array(total[h], pa.int64())], names=["lang", "h", "n"])


def learn_languages(docs: DataFrame, mod: int = 4, remainder: int = 2, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> NaiveBayes:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(mod, remainder))
    priors = label_counts(rows, "lang", MOST_LANGUAGES)
    langs = sorted(priors)
    sample = stratified(rows, "lang", priors, most, "doc_id", "text").select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, h int, n long").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    table = np.full((len(langs), WIDTH), 0.5)
    at = {x: i for i, x in enumerate(langs)}
    # a row a language, with arrays of WIDTH whole numbers at most
    found = counts.groupBy("lang").agg(F.collect_list(F.struct("h", "n")).alias("c")).toArrow()
    for batch in found.to_batches():
        for lang, cells in zip(batch.column("lang").to_pylist(), batch.column("c"), strict=True):
            table[at[lang], cells.values.field("h").to_numpy()] += cells.values.field("n").to_numpy()
    prior = np.array([priors[x] for x in langs], dtype=float)
    return NaiveBayes(langs, np.log(prior / prior.sum()) if langs else prior, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def identify(docs: DataFrame, model: NaiveBayes, mod: int = 4, remainder: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (the posterior of lang_pred)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = whole_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("langid")
        for b in batches:
            for part in slices(b, size=500_000):
                langs, scores = sent.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return d.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double").select("doc_id", held_out(mod, remainder).alias("held_out"), "lang_pred", "score")
