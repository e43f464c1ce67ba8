"""The classifiers' features, weights and scores against plain loops."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline.llm import linear, quality, toxicity

MASK, SIZE = (1 << 64) - 1, 1 << linear.BITS


def grams(text, n=toxicity.GRAM):
    """Hashed 5-byte windows of the folded text between two spaces."""
    data = re.sub(b"[\t\n\x0b\x0c\r]", b" ", re.sub(b"[A-Z]", lambda m: m[0].lower(), text.encode()))
    data = b" " + data + b" "
    codes = [int.from_bytes(data[i : i + n], "big") for i in range(len(data) - n + 1)]
    return {(c * 0x9E3779B97F4A7C15 & MASK) >> (64 - linear.BITS) for c in codes}


def rows_from(texts, features):
    return [np.frombuffer(x, "<u4") for x in linear.distinct_features(pa.array(texts, pa.large_string()), features)]


def some_texts(n=60, seed=1):
    rng = random.Random(seed)
    words = ["bad", "Good", "the", "ünd", "x1", "!!", "mean\tone", "日本"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_byte_grams_and_ratios():
    texts = [*some_texts(), "", "abc"]
    rows = rows_from(texts, toxicity.byte_grams)
    assert [set(r.tolist()) for r in rows] == [grams(t) for t in texts]
    y = np.array([float("bad" in t) for t in texts])
    got = toxicity.ratios(y, rows)
    with_it = {label: Counter(f for t, yes in zip(texts, y) if yes == label for f in grams(t)) for label in (0, 1)}
    for feature in set(with_it[0]) | set(with_it[1]):
        p, q = ((with_it[k][feature] + 0.5) / ((y == k).sum() + 1) for k in (1, 0))
        assert got[feature] == pytest.approx(math.log(p / q))
    assert np.count_nonzero(got) <= len(set(with_it[0]) | set(with_it[1]))


def test_toxicity_fit_is_the_plain_gradient(monkeypatch):
    texts = some_texts(30)
    y, weight = np.array([float("bad" in t) for t in texts]), np.linspace(0.5, 1.5, 30)
    rows = rows_from(texts, toxicity.byte_grams)
    ratio = toxicity.ratios(y, rows)
    w, bias, seen, seen_bias = dict.fromkeys(np.flatnonzero(ratio).tolist(), 0.0), 0.0, {}, 1e-8
    for _ in range(7):
        slope, slope_bias = {f: 1e-4 * v for f, v in w.items()}, 0.0
        for label, share, row in zip(y, weight, rows):
            margin = bias + sum(w[f] * ratio[f] for f in row.tolist() if f in w)
            error = share * (1 / (1 + math.exp(-margin)) - label) / 30
            slope_bias += error
            for f in row.tolist():
                if f in w:
                    slope[f] += error * ratio[f]
        for f in w:
            seen[f] = seen.get(f, 1e-8) + slope[f] ** 2
            w[f] -= 0.1 * slope[f] / math.sqrt(seen[f])
        seen_bias += slope_bias**2
        bias -= 0.1 * slope_bias / math.sqrt(seen_bias)
    for block in (toxicity.BLOCK, 50):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        got = toxicity.fit(y, weight, rows, steps=7)
        assert got.bias == pytest.approx(bias)
        assert dict(zip(got.features.tolist(), got.weights)) == pytest.approx({f: v * ratio[f] for f, v in w.items() if v * ratio[f]})


def test_ftrl_is_the_plain_update():
    texts = some_texts(40, seed=2)
    y, weight = np.array([float("Good" in t) for t in texts]), np.linspace(0.5, 1.5, 40)
    rows = rows_from(texts, quality.word_grams)
    z, n = Counter(), Counter()

    def value(f):
        free = abs(z[f]) if f == "bias" else max(0.0, abs(z[f]) - quality.L1)
        return -math.copysign(free, z[f]) / ((quality.BETA + math.sqrt(n[f])) / quality.ALPHA + quality.L2) if free else 0.0

    for _ in range(quality.PASSES):
        for label, share, row in zip(y, weight, rows):
            names = [*row.tolist(), "bias"]
            w = {f: value(f) for f in names}
            slope = share * (1 / (1 + math.exp(-sum(w.values()))) - label)
            for f in names:
                z[f] += slope - (math.sqrt(n[f] + slope**2) - math.sqrt(n[f])) / quality.ALPHA * w[f]
                n[f] += slope**2
    got = quality.fit(y, weight, rows)
    assert got.bias == pytest.approx(value("bias"))
    assert dict(zip(got.features.tolist(), got.weights)) == pytest.approx({f: value(f) for f in z if f != "bias" and value(f)})
    assert 0 < len(got.features) < len(z)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_are_sums_over_distinct_features(module):
    features = toxicity.byte_grams if module is toxicity else quality.word_grams
    texts = [*some_texts(50, seed=3), "", "bad " * 500]
    rows = rows_from(texts, features)
    rng = np.random.default_rng(4)
    names = rng.permutation(np.unique(np.concatenate(rows)))[:40]
    model = linear.Linear(-0.3, names, rng.normal(size=40))
    weights = dict(zip(names.tolist(), model.weights.astype(np.float32)))
    want = [1 / (1 + math.exp(0.3 - sum(weights.get(f, 0.0) for f in row.tolist()))) for row in rows]
    assert model.scores(pa.array(texts, pa.large_string()), features, model.table()) == pytest.approx(want)


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 7 * 40)) + f" t{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    seen = []

    def fit(y, weight, own):
        seen.append((len(y), sum(r.nbytes for r in own), round(float((weight * (y == 1)).sum() / weight.sum()), 6)))
        raise ValueError(repr(seen))

    monkeypatch.setattr(linear, "SAMPLE_BYTES", 20_000)
    with pytest.raises(Exception) as failed:
        linear.fitted(frame, labels, "quality", quality.word_grams, fit)
    n, size, share = eval(re.search(r"ValueError: \[(\(.*?\))\]", str(failed.value))[1])
    assert 10 < n < 300 and size <= 20_000 and share == pytest.approx(0.5, abs=0.05)
    encoded = spark.createDataFrame([(0, 5, b"x" * 100), (0, 6, b"x"), (1, 1, b"x" * 9)], "label int, place long, features binary")
    assert linear.within_bytes(encoded, 50) == {0: (5, 2.0), 1: (1, 1.0)}
    assert encoded.where(F.col("label") == 0).count() == 2
