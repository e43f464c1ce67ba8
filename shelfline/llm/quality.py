"""Quality by logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Words are runs of letters and digits, or of other marks; the features of a text are the presence
of its words and pairs of neighbouring words. All pairs of a word and itself share one feature: a
pair's hash tells words apart only where they differ. Training follows the regularised leader: each
coordinate has a step size of its own, and weights stay zero until the evidence passes the L1
penalty, so the model is sparse and a score is a sparse dot product.

Null counts as empty; an empty text is scored by the bias alone. Rows that share a doc_id are
scored each by its text. Very long texts are scored whole, one at a time; ties cannot occur, as
equal texts have equal scores. Only doc_id and text are read, so that no name clashes. An empty
table has an empty result. See `linear` for missing labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.linear import BITS, SAMPLE_ROWS, Linear, fitted, scored
from shelfline.llm.texts import mixed, plain

#: Step size and its offset, L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 1.0, 1.0, 6
#: By byte: 0 white space, 1 letters, digits and non-ASCII, 2 other marks.
KIND = np.array([0 if b in b" \t\n\x0b\x0c\r" else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)
#: Powers for the hash of a word, by position; they repeat in words of over 256 bytes.
POWERS = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def word_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashed words and word pairs in order, and the text each is of."""
    texts = plain(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if not offsets[-1]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]]
    kind = KIND[data]
    first = np.r_[True, kind[1:] != kind[:-1]]
    first[offsets[(offsets > 0) & (offsets < len(data))]] = True
    starts = np.flatnonzero(first)
    inside = np.arange(len(data)) - np.repeat(starts, np.diff(np.r_[starts, len(data)]))
    with np.errstate(over="ignore"):
        words = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * POWERS[inside & 255], starts)
    starts, words = starts[kind[starts] > 0], mixed(words[kind[starts] > 0])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    with np.errstate(over="ignore"):
        pairs = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    pairs[words[1:] == words[:-1]] = 0  # any word twice in a row
    together = owner[1:] == owner[:-1]
    at = np.concatenate([words, pairs[together]]) >> np.uint64(64 - BITS)
    return at.astype(np.int64), np.concatenate([owner, owner[:-1][together]])


def fit(y: np.ndarray, weight: np.ndarray, rows: list[np.ndarray]) -> Linear:
    """FTRL-proximal, one row after the other; the last coordinate is the bias, without L1."""
    bias = 1 << BITS
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        free = np.where(at == bias, np.abs(z[at]), np.maximum(0, np.abs(z[at]) - L1))
        return -np.sign(z[at]) * free / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(PASSES):
        for label, share, row in zip(y, weight, rows):
            at = np.r_[row, bias].astype(np.int64)
            w = weights(at)
            slope = share * (1 / (1 + np.exp(-np.clip(w.sum(), -500, 500))) - label)
            z[at] += slope - (np.sqrt(n[at] + slope**2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += slope**2
    every = weights(np.arange(bias + 1))
    names = np.flatnonzero(every[:-1])
    return Linear(every[-1], names, every[names])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Linear:
    """Fitted on at most `rows` labelled documents outside the held-out fold."""
    return fitted(docs, labels, "quality", word_grams, fit, rows)


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.3) of every document."""
    return scored(docs, train(docs, labels, rows), word_grams).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
