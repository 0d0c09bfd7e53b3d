"""Learning of quality covers all labelled rows and all their pairs."""

import numpy as np
import pytest

from terrasieve.llm import all_pairs, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(4)
    y = (rng.random(300) < 0.7).astype(int)
    x = (rng.normal(size=(300, 5)) + y[:, None] * [1, 0.5, 0, 0, -1]).astype(np.float32)
    x[7, 2] = 900  # far from all others
    rows = spark.createDataFrame([(int(b), a.tobytes()) for a, b in zip(x, y, strict=True)], "label int, x binary").repartition(6)
    return x.astype(float), y, rows


def plain(x, y, w, l2=0.0):
    """Loss, gradient and curvature of every pair, one by one."""
    d = (x[y == 1][:, None] - x[y == 0][None]).reshape(-1, x.shape[1])
    p = 1 / (1 + np.exp(d @ w))
    return np.logaddexp(0, -d @ w).mean() + l2 / 2 * w @ w, -(d * p[:, None]).mean(axis=0) + l2 * w, (d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(len(w))


@pytest.mark.parametrize("fan", [1, 32])
def test_sums_over_all_pairs(made, monkeypatch, fan):
    x, y, rows = made
    monkeypatch.setattr(all_pairs.meet, "__defaults__", (fan,))
    monkeypatch.setattr(all_pairs.total, "__defaults__", (fan,))
    mean, scale = all_pairs.moments(rows)
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(scale, x.std(axis=0))
    z = (x - mean) / scale
    for w in (np.zeros(5), np.array([1.0, 2, -3, 0.5, 1]), np.array([30.0, 0, 20, 0, 0])):
        met = all_pairs.meet(rows, mean, scale, w)
        g, h = all_pairs.slopes(rows, mean, scale, w, met)
        loss, g0, h0 = plain(z, y, w)
        assert abs(met.loss - loss) < 1e-7 and np.abs(g - g0).max() < 1e-7
        assert np.linalg.eigvalsh(h).min() > -1e-9 and (np.abs(w).max() > 10 or np.abs(h - h0).max() < 0.02)
    w = all_pairs.least_loss(rows, mean, scale, np.full(5, 3.0), 1e-3)
    assert np.abs(plain(z, y, w, 1e-3)[1]).max() < 1e-6


@pytest.mark.parametrize("size", [4, 10**6])
def test_threshold_tries_every_score(spark, size):
    rng = np.random.default_rng(size)
    y = rng.integers(0, 2, 200)
    s = np.round(rng.normal(size=200) + y, 1)  # with ties
    got = all_pairs.best_threshold(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s, strict=True)], "label int, raw double").repartition(3), 0.002, size)
    at = np.unique(s)
    gain = np.array([(s[y == 0] < t).mean() - (s[y == 1] < t).mean() for t in at])
    best = np.flatnonzero(gain >= gain.max() - 0.002)[0]
    assert abs(got - (at[best] + at[best - 1]) / 2) < 1e-12


def test_model_comes_from_all_labelled_rows(spark):
    """The bound on the rows that give the start bounds nothing else: model and threshold are those of every row and pair."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    few = quality.learn_quality(docs, labels, most=3)
    rows = quality.learning_rows(docs, labels, 5, 0)
    found = rows.collect()
    assert len(found) == labels.filter("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0").count()
    x, y = np.stack([np.frombuffer(r.x, dtype=np.float32) for r in found]).astype(float), np.array([r.label for r in found])
    assert np.allclose(few.mean, x.mean(axis=0)) and np.allclose(few.scale, np.maximum(x.std(axis=0), 1e-3))
    assert np.abs(plain((x - few.mean) / few.scale, y, few.weights, 1e-3)[1]).max() < 1e-6
    raw = few.raw(x)
    at = np.unique(raw)
    gain = np.array([(raw[y == 0] < t).mean() - (raw[y == 1] < t).mean() for t in at])
    best = np.flatnonzero(gain >= gain.max() - quality.TOLERANCE)[0]
    assert at[best - 1] < few.threshold < at[best]
