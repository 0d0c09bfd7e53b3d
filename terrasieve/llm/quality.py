"""Quality: Bradley-Terry pairwise ranking.

All pairs of a document with label 1 and one with label 0 are preferences. Scores are linear in a text's features; logistic loss on the
difference of a pair's features learns them, over all labelled rows and all their pairs (`all_pairs`). The threshold is the one that parts
all labelled rows best. A score is mapped to 0..1 so that the threshold falls on `cut`.

Features come from the whole text alone: shares of bytes, and how words, lines and marks repeat.

Defined results: null text counts as empty; an empty text gets the score of its features (all 0 but the bias of lengths). Without
labels of both kinds every score is 0.5. Repeated rows each get a row. An empty table gives an empty result. Extra columns are not read.

Plan: the features of all labelled rows are a written table, which every round of learning reads; sums of fixed size reach the driver. The
weights from which the rounds start come from `most` rows of each label and some of their pairs: they save rounds and don't change the end.
Scoring is one pass without a shuffle, with about 300 weights sent along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasieve.functions.staging import broadcast_within, drop, stage
from terrasieve.llm import all_pairs
from terrasieve.llm.columns import whole_text
from terrasieve.llm.learning import held_out, label_counts, labelled_ids, logistic_fit, sigmoid, stratified
from terrasieve.llm.worker_memory import make_room, slices

#: Of the start: rows of each label at most, and preference pairs drawn from them.
MOST, PAIRS = 4000, 20_000
#: Weight of the squared weights in the loss; least deviation that a feature is divided by.
L2, LEAST = 1e-3, 1e-3
#: Loss of separation that the threshold accepts to reject fewer good documents.
TOLERANCE = 0.002
SHAPE = 16


def _bytes(*members: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


_LETTERS = _bytes(*range(65, 91), *range(97, 123), *range(128, 256))
_SPACE, _MARKS = _bytes(*b" \t\n\r\v\f"), _bytes(*b"*#%&$!|")


def features(text: str) -> np.ndarray:
    """Of one text: square roots of byte shares, then SHAPE figures of its form."""
    data = text.encode("utf-8", "replace")
    codes = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(codes, minlength=256)
    out = np.zeros(256 + SHAPE, dtype=np.float32)
    n = len(data)
    if not n:
        return out
    out[:256] = np.sqrt(counts / n)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = int(counts[_LETTERS].sum())
    upper = int(counts[65:91].sum())
    m, k = max(len(words), 1), max(len(lines), 1)
    ends = np.flatnonzero(_SPACE[codes[1:]] & ~_SPACE[codes[:-1]])  # last bytes of words but the last one
    out[256:] = (
        np.log1p(n) / 10,
        np.log1p(len(words)) / 8,
        letters / n,
        upper / max(letters, 1),
        float(upper > 0.2 * max(letters, 1)),
        len(set(words)) / m,
        len(set(words)) / m**0.7 / 4,
        sum(map(eq, words, words[1:])) / m,
        sum(map(eq, words, words[2:])) / m,
        len(set(lines)) / k,
        np.log1p(len(lines)) / 6,
        letters / m / 10,
        _MARKS[codes[ends]].sum() / m,
        sum(x.count(b"|") > 2 for x in lines) / k,
        float(counts[[33, 35, 36, 37, 38, 42, 124]].sum() > 0.01 * n),
        counts[48:58].sum() / n,
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """Raw score: (features - mean) / scale * weights. threshold: the raw score that maps to cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x) - self.threshold + np.log(self.cut / (1 - self.cut)))


def scores(model: Ranking, texts: list[str | None]) -> np.ndarray:
    """Scores of texts, some at a time: memory doesn't follow the batch size."""
    parts = [model.score(np.stack([features(t or "") for t in texts[i : i + 500]])) for i in range(0, len(texts), 500)]
    return np.concatenate(parts) if parts else np.zeros(0)


def fit_ranking(x: np.ndarray, y: np.ndarray, cut: float, pairs: int = PAIRS, seed: int = 5) -> Ranking:
    """Of rows in memory, by pairs drawn from them. x: features, y: labels 0 and 1."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    mean = x.mean(axis=0) if len(x) else np.zeros(256 + SHAPE)
    scale = np.maximum(x.std(axis=0), LEAST) if len(x) else np.ones(256 + SHAPE)
    if not len(good) or not len(bad):
        return Ranking(mean, scale, np.zeros(len(mean)), np.log(cut / (1 - cut)), cut)
    rng = np.random.default_rng(seed)
    a, b = rng.choice(good, pairs), rng.choice(bad, pairs)
    difference = ((x[a] - x[b]) / scale).astype(np.float32)
    weights = logistic_fit(difference, np.ones(pairs), l2=L2, steps=200)
    model = Ranking(mean, scale, weights, 0.0, cut)
    raw = model.raw(x)
    at = np.quantile(raw, np.linspace(0, 1, 1001))
    kept = np.searchsorted(np.sort(raw[good]), at) / len(good)  # share of the good under each quantile
    gone = np.searchsorted(np.sort(raw[bad]), at) / len(bad)
    gain = gone - kept
    best = np.flatnonzero(gain >= gain.max() - TOLERANCE)[0]  # of nearly equal quantiles the lowest, which keeps most
    return Ranking(mean, scale, weights, float(at[best]), cut)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make_room("quality")
    for b in chain.from_iterable(map(slices, batches)):
        rows = [features(t).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])


def learning_rows(docs: DataFrame, labels: DataFrame, mod: int, remainder: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, label, x) of all labelled ids that aren't held out, as a written table: one row of an id, of several the least features."""
    ids = stage(labelled_ids(labels, "quality", mod, remainder), "quality-labels")
    rows = whole_text(docs, id_col, text_col).join(broadcast_within(ids), "doc_id").select("doc_id", "label", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(_feature_rows, f"doc_id {kind}, label int, x binary")
    found = stage(rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")), "quality-features")
    drop(ids)
    return found


def _raw_rows(model: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, x in all_pairs.blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(model.raw(x), pa.float64())], names=["label", "raw"])

    return run


def learn_quality(docs: DataFrame, labels: DataFrame, cut: float = 0.3, mod: int = 5, remainder: int = 0, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Learn from labels.quality of all rows that the hold-out rule leaves, and all their pairs. `most` rows of each label give the start."""
    rows = learning_rows(docs, labels, mod, remainder, id_col, text_col)
    counts = label_counts(rows, "label")
    first = stratified(rows, "label", counts, most, "doc_id").select("doc_id", "label", "x").orderBy("doc_id").collect()
    x = np.stack([np.frombuffer(r.x, dtype=np.float32) for r in first]) if first else np.zeros((0, 256 + SHAPE))
    start = fit_ranking(x, np.array([r.label for r in first]), cut)
    if len(counts) < 2:
        drop(rows)
        return start
    mean, scale = all_pairs.moments(rows)
    scale = np.maximum(scale, LEAST)
    weights = all_pairs.least_loss(rows, mean, scale, start.weights * scale / start.scale, L2)
    model = Ranking(mean, scale, weights, 0.0, cut)
    threshold = all_pairs.best_threshold(rows.select("label", "x").mapInArrow(_raw_rows(model), "label int, raw double"), TOLERANCE)
    drop(rows)
    return replace(model, threshold=threshold)


def score_quality(docs: DataFrame, model: Ranking, mod: int = 5, remainder: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    d = whole_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("quality")
        for part in chain.from_iterable(map(slices, batches)):
            found = scores(model, part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = d.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(mod, remainder).alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """docs without the rows that the model rejects, with its own columns and types."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    renamed = docs.toDF(*own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("quality")
        for b in batches:
            for part in slices(b, at):
                yield part.filter(pa.array(scores(model, part.column(at).to_pylist()) >= model.cut))

    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
