"""Toxicity by a character n-gram linear classifier on naive Bayes log-count ratios.

Features are the presence of n consecutive bytes of the text, with A-Z lower-cased and white space
as one space each. Each feature is scaled by the logarithm of how much more often toxic texts have
it than others, and logistic regression finds the weights of the scaled features.

Every feature of the sample is used; the penalty keeps the weights of weak ones small.

Null counts as empty; an empty text is scored by the bias alone. Rows that share a doc_id are
scored each by its text. Very long texts are scored whole, one at a time; ties cannot occur, as
equal texts have equal scores. Scores need doc_id and text only, and `clean` returns the other
columns whatever they are called. An empty table has an empty result. See `linear` for missing
labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.linear import BITS, SAMPLE_ROWS, Linear, filtered, fitted, scored
from shelfline.llm.store import keeps_columns
from shelfline.llm.texts import LOWER, owners, translate

#: Bytes of an n-gram.
GRAM = 5
#: Added to the counts of a feature.
SMOOTHING = 0.5
#: Texts that score so high are predicted to be toxic.
LEAST_SCORE = 0.5
#: Features of the sample that are held beside their weights at once.
BLOCK = 1 << 20
#: White space becomes a plain space.
FOLD = bytes(32 if b in b" \t\n\x0b\x0c\r" else b for b in LOWER)


def byte_grams(texts: pa.Array, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-gram at each byte, in a text framed by spaces, and the text it is of."""
    texts = translate(texts, FOLD)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    sizes = np.diff(offsets) + 2
    ends = np.r_[0, np.cumsum(sizes)]
    framed = np.full(ends[-1], 32, np.uint8)
    inside = np.ones(len(framed), bool)
    inside[ends[:-1]] = inside[ends[1:] - 1] = False
    framed[inside] = data
    code = np.zeros(max(0, len(framed) - n + 1), np.uint64)
    for i in range(n):
        code = code << np.uint64(8) | framed[i : i + len(code)]
    owner = owners(ends)[: len(code)]
    with np.errstate(over="ignore"):
        at = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    whole = np.arange(len(code)) + n <= ends[owner + 1]
    return at[whole].astype(np.int64), owner[whole]


def ratios(y: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """By feature: the naive Bayes log-count ratio; 0 for those in no row."""
    count = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for label, row in zip(y, rows):
        count[int(label)][row] += 1
    with_it = lambda label: (count[label] + SMOOTHING) / ((y == label).sum() + 2 * SMOOTHING)
    return np.where(count[0] + count[1] > 0, np.log(with_it(1)) - np.log(with_it(0)), 0.0)


def blocks(rows: list[np.ndarray]) -> list[tuple[int, int]]:
    """Neighbouring rows with about BLOCK features together, as (first, end)."""
    ends = np.cumsum([len(r) for r in rows])
    cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]) + BLOCK, BLOCK)))
    cuts = np.unique(np.r_[0, cuts, len(rows)])
    return [(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]


def fit(y: np.ndarray, weight: np.ndarray, rows: list[np.ndarray], steps: int = 60, penalty: float = 1e-4, rate: float = 0.1) -> Linear:
    """Logistic regression on all features seen, scaled, by gradient steps of their own size."""
    ratio = ratios(y, rows)
    w, bias, seen, seen_bias = np.zeros(1 << BITS), 0.0, np.full(1 << BITS, 1e-8), 1e-8
    sizes = np.array([len(r) for r in rows])
    every, ends = np.concatenate(rows).astype(np.int32), np.r_[0, np.cumsum(sizes)]
    owners = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    parts = blocks(rows)
    for _ in range(steps):
        scaled, slope, slope_bias = w * ratio, penalty * w, 0.0
        for a, b in parts:
            at, owner = every[ends[a] : ends[b]], owners[ends[a] : ends[b]] - a
            margin = bias + np.bincount(owner, scaled[at], b - a)
            error = weight[a:b] * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y[a:b]) / len(y)
            slope += np.bincount(at, error[owner], 1 << BITS) * ratio
            slope_bias += error.sum()
        seen, seen_bias = seen + slope**2, seen_bias + slope_bias**2
        w, bias = w - rate * slope / np.sqrt(seen), bias - rate * slope_bias / np.sqrt(seen_bias)
    names = np.flatnonzero(w * ratio)
    return Linear(bias, names, (w * ratio)[names])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Linear:
    """Fitted on at most `rows` labelled documents outside the held-out fold."""
    return fitted(docs, labels, "toxic", byte_grams, fit, rows)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return scored(docs, train(docs, labels, rows), byte_grams).withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))


@keeps_columns
def clean(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""
    return filtered(docs, train(docs, labels, rows), byte_grams, lambda score: score < LEAST_SCORE)
