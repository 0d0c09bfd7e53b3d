"""Bradley-Terry loss over all pairs of a row with label 1 and one with label 0, without forming the pairs, and the threshold that parts all rows.

The loss of a pair is log(1 + exp(score of the row with 0 - score of the row with 1)). All pairs are counted by the scores alone: rows are
spread over the nodes of a grid of scores (cubic weights), and what a row meets in all rows of the other label is a convolution over that grid.
With nodes 1/32 apart a pair's probability is off by under 1e-8.

Plan: rows (label int, x binary: float32) are a written table. A round of Newton's method reads it twice: once for the sums over the grid, once
for gradient and curvature. Of a task the driver gets its sums only; above FAN tasks Spark sums those of the tasks first.
The curvature's grid is coarse and only guides the steps. The loss is strictly convex, so the start makes no difference to the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasieve.functions.staging import drop, stage
from terrasieve.llm.learning import sigmoid

#: Nodes a unit of score; the difference of scores from which a preference is certain (to 4e-18).
NODES, REACH = 32, 40
#: Of the curvature's grid: nodes a unit, units on each side of the centre.
COARSE, SIDE = 2, 16
#: Newton's method ends when the loss can fall by no more than half of this.
ENOUGH = 1e-10
#: Tasks whose sums go to the driver without being summed by tasks.
FAN = 32
#: Rows of a task worked on at a time; distinct scores in a range of the threshold's search.
ROWS, RANGE = 2000, 50_000


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and features, some rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            x = np.frombuffer(b"".join(part.column("x").to_pylist()), dtype=np.float32).reshape(part.num_rows, -1)
            yield part.column("label").to_numpy(), x.astype(np.float64)


def total(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], fan: int = FAN) -> np.ndarray:
    """The sum of of(labels, features) over all blocks of rows; there must be one."""

    def one(found: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sums = None
        for v in found:
            sums = v if sums is None else sums + v
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["v"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return one(of(y, x) for y, x in blocks(batches))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return one(np.frombuffer(v.as_py()) for b in batches for v in b.column("v"))

    sums, tasks = rows.select("label", "x").mapInArrow(parts, "v binary"), rows.rdd.getNumPartitions()
    if tasks > fan:
        sums = sums.repartition(isqrt(tasks)).mapInArrow(again, "v binary")
    return np.sum([np.frombuffer(r.v) for r in sums.collect()], axis=0)


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the features over all rows."""
    n, first, second = np.split(total(rows, lambda _, x: np.concatenate([np.full(x.shape[1], len(x)), x.sum(axis=0), (x * x).sum(axis=0)])), 3)
    mean = first / n
    return mean, np.sqrt(np.maximum(second / n - mean * mean, 0))


def on_grid(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The node under each score, and the weights of the four nodes from the one before it on."""
    node = np.floor(s * NODES)
    t = s * NODES - node
    a, b, c = t + 1, t - 1, t - 2
    return node.astype(np.int64), np.stack([-t * b * c / 6, a * b * c / 2, -a * t * c / 2, a * t * b / 6], axis=1)


class Met:
    """Sums of rows over nodes first, first + 1, ... by label, and what they say about all pairs."""

    def __init__(self, first: int, bad: np.ndarray, good: np.ndarray):
        n, m = len(bad), REACH * NODES
        self.first, self.bad, self.good = first, bad, good
        t = np.arange(-m, m + 1) / NODES
        rest = sigmoid(t) - np.heaviside(t, 0.5)
        above = np.cumsum(bad[::-1])[::-1] - bad  # rows with label 0 over each node
        under = np.cumsum(good) - good
        #: Of a row at the node: the sum over all rows with the other label of the probability that the wrong one of the pair is preferred.
        self.lost = (under + good / 2 + np.convolve(good, rest)[m : m + n], above + bad / 2 - np.convolve(bad, rest)[m : m + n])
        over = np.cumsum(above[::-1])[::-1] / NODES + np.convolve(bad, np.log1p(np.exp(-np.abs(t))))[m : m + n]
        self.loss = float(good @ over / (good.sum() * bad.sum()))
        #: The node that parts the labels best: there pairs are least certain.
        self.centre = (first + int(np.argmax(np.cumsum(bad) / bad.sum() - np.cumsum(good) / good.sum()))) / NODES

    def coarse(self, amounts: np.ndarray) -> np.ndarray:
        return amounts @ hats((self.first + np.arange(len(amounts))) / NODES, self.centre)


def hats(s: np.ndarray, centre: float) -> np.ndarray:
    """Weights of the coarse nodes, linear between them; scores outside go to the last ones."""
    out = np.zeros((len(s), 2 * SIDE * COARSE + 1))
    at = np.clip((s - centre + SIDE) * COARSE, 0, out.shape[1] - 1.001)
    node, row = at.astype(np.int64), np.arange(len(s))
    out[row, node], out[row, node + 1] = node + 1 - at, at - node
    return out


def meet(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, fan: int = FAN) -> Met:
    """All rows on the grid by their scores."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, amounts = np.zeros(0, dtype=np.int64), np.zeros(0)
        for y, x in blocks(batches):
            node, weight = on_grid(((x - mean) / scale) @ w)
            key = 2 * (node[:, None] + np.arange(-1, 3)).ravel() + np.repeat(y, 4)
            keys, at = np.unique(np.concatenate([keys, key]), return_inverse=True)
            amounts = np.bincount(at, np.concatenate([amounts, weight.ravel()]))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(amounts, pa.float64())], names=["key", "amount"])

    found = rows.select("label", "x").mapInArrow(spread, "key long, amount double")
    if rows.rdd.getNumPartitions() > fan:
        found = found.groupBy("key").agg(F.sum("amount"))
    found = found.collect()
    key, amount = np.array([r[0] for r in found]), np.array([r[1] for r in found])
    first = int(key.min() >> 1)
    sums = np.bincount(key - 2 * first, amount, 2 * (int(key.max() >> 1) - first + 1))
    return Met(first, sums[::2], sums[1::2])


def slopes(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, met: Met) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the mean loss of all pairs."""
    d, k = len(w), 2 * SIDE * COARSE + 1
    n = met.good.sum() * met.bad.sum()
    apart = np.subtract.outer(np.arange(k), np.arange(k)) / COARSE
    near = sigmoid(apart) * sigmoid(-apart) / n
    weigh = (near @ met.coarse(met.good), near @ met.coarse(met.bad))
    lost, first, centre = met.lost, met.first, met.centre

    def of(y: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = (x - mean) / scale
        s = z @ w
        node, weight = on_grid(s)
        nodes, hat = node[:, None] - first + np.arange(-1, 3), hats(s, centre)
        slope = np.where(y == 1, -(lost[1][nodes] * weight).sum(axis=1), (lost[0][nodes] * weight).sum(axis=1)) / n
        bend = np.where(y == 1, hat @ weigh[1], hat @ weigh[0])
        ends = [hat[y == v].T @ z[y == v] for v in (0, 1)]
        return np.concatenate([slope @ z, ((z * bend[:, None]).T @ z).ravel(), ends[0].ravel(), ends[1].ravel()])

    sums = total(rows, of)
    g, own, bad, good = np.split(sums, np.cumsum([d, d * d, k * d]))
    cross = bad.reshape(k, d).T @ near @ good.reshape(k, d)
    return g, own.reshape(d, d) - cross - cross.T


def least_loss(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, start: np.ndarray, l2: float, most: int = 100) -> np.ndarray:
    """Weights of least mean loss of all pairs plus l2 / 2 * |w|^2; rows must have both labels. RuntimeError after `most` rounds."""
    w = start.astype(np.float64)
    met = meet(rows, mean, scale, w)
    for _ in range(most):
        g, h = slopes(rows, mean, scale, w, met)
        g = g + l2 * w
        step = -np.linalg.solve(h + l2 * np.eye(len(w)), g)
        gain, rate, loss = -g @ step, 1.0, met.loss + l2 / 2 * w @ w
        if gain < ENOUGH:
            return w + step
        while True:
            new = w + rate * step
            met = meet(rows, mean, scale, new)
            if met.loss + l2 / 2 * new @ new <= loss - 1e-4 * rate * gain + 1e-8:  # the grid's own error
                break
            rate /= 2
        w = new
    raise RuntimeError(f"no least loss after {most} rounds")


def best_threshold(scored: DataFrame, tolerance: float, size: int = RANGE) -> float:
    """Of scored (label int, raw double), which has both labels: the least threshold whose gain, the share of rows with label 0 under it less
    that of rows with label 1, is within tolerance of the greatest. Every score is tried, over all rows; the threshold lies halfway to the
    score below. Ranges of scores get their running counts apart, and one row each goes to the driver."""
    spark = scored.sparkSession
    each = scored.groupBy("raw").agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    each = stage(each, "quality-scores")
    ranges = stage(each.repartitionByRange(each.count() // size + 1, "raw").withColumn("part", F.spark_partition_id()), "quality-ranges")
    sums = sorted(ranges.groupBy("part").agg(F.sum("good"), F.sum("bad"), F.max("raw")).collect())
    good, bad = np.cumsum([r[1] for r in sums]), np.cumsum([r[2] for r in sums])
    before = [(r[0], int(good[i]) - r[1], int(bad[i]) - r[2], sums[i - 1][3] if i else None) for i, r in enumerate(sums)]
    offsets = spark.createDataFrame(before, "part int, good0 long, bad0 long, raw0 double")
    order = Window.partitionBy("part").orderBy("raw")
    under = order.rowsBetween(Window.unboundedPreceding, -1)
    share = lambda c, n: (F.coalesce(F.sum(c).over(under), F.lit(0)) + F.col(f"{c}0")) / F.lit(int(n))
    gains = ranges.join(F.broadcast(offsets), "part").select("raw", F.coalesce(F.lag("raw").over(order), "raw0", F.col("raw") - 1).alias("below"), (share("bad", bad[-1]) - share("good", good[-1])).alias("gain"))
    most = gains.agg(F.max("gain")).first()[0]
    found = gains.filter(F.col("gain") >= most - tolerance).orderBy("raw").first()
    drop(each, ranges)
    return (found.raw + found.below) / 2
