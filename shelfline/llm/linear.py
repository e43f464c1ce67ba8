"""Linear text classifiers on hashed features: the sample they are fitted on, and their scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.store import held_out, stored
from shelfline.llm.texts import let_go, release, slices

#: Features are hashed to this many bits.
BITS = 20
#: Labelled rows that a classifier is fitted on at most, half of each label.
SAMPLE_ROWS = 10_000
#: Bytes of these rows' features at most, half of each label; a feature has 4.
SAMPLE_BYTES = 32 << 20
#: Bytes of text whose features are found at once.
AT_ONCE = 1 << 20

#: A slice of texts -> the features of each place in them, and the text each is of.
Features = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


@dataclass
class Linear:
    """score = sigmoid(bias + sum of the weights of the distinct features of a text)."""

    bias: float
    features: np.ndarray
    weights: np.ndarray

    def scores(self, texts: pa.Array, features: Features, table: np.ndarray) -> np.ndarray:
        at, owner = features(texts)
        once = first_in_text(at, owner, len(texts))
        margin = self.bias + np.bincount(owner[once], table[at[once]], len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.features] = self.weights
        return out


def first_in_text(at: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Places of which each text has one for each of its distinct features.

    A table says where each feature was met last; what a text wrote there last is its own.
    """
    order = None if (owner[1:] >= owner[:-1]).all() else np.argsort(owner, kind="stable")
    at = at if order is None else at[order]
    ends = np.searchsorted(owner if order is None else owner[order], np.arange(n + 1))
    last, place, mine = np.empty(1 << BITS, np.int32), np.arange(len(at), dtype=np.int32), np.empty(len(at), bool)
    for a, b in zip(ends.tolist(), ends[1:].tolist()):
        own = at[a:b]
        last[own] = place[a:b]
        mine[a:b] = last[own] == place[a:b]
    return np.flatnonzero(mine) if order is None else order[mine]


def distinct_features(texts: pa.Array, features: Features) -> list[bytes]:
    """The distinct features of each text, sorted, as 32-bit integers."""
    at, owner = features(texts)
    pairs = np.unique(owner.astype(np.int64) << BITS | at)
    ends = np.searchsorted(pairs, np.arange(len(texts) + 1, dtype=np.int64) << BITS)
    at = (pairs & ((1 << BITS) - 1)).astype("<u4")
    return [at[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int) -> tuple[DataFrame, dict[int, float]]:
    """Labelled texts (label, place, text) outside the held-out fold, and what a row of each label counts.

    Of each label the rows / 2 ids that come first by `place`, a hash, and of each id the text that
    comes first by hash, so the sample has at most `rows` rows. An id with several labels has the
    greatest; ids without a label, or null ids, are left out.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("place", F.xxhash64(F.lit(seed), "doc_id"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    first = lambda y: known.where(F.col("label") == y).orderBy("place", "doc_id").limit(rows // 2)
    ids = F.broadcast(first(0).unionAll(first(1)))  # at most `rows` ids
    texts = docs.select("doc_id", "text").join(ids, "doc_id")
    texts = texts.groupBy("doc_id", "label", "place").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return texts.select("label", "place", "text"), {y: n / min(n, rows // 2) for y, n in totals.items()}


def within_bytes(encoded: DataFrame, most: int) -> dict[int, tuple[int, float]]:
    """By label: the place of the last row, and by how much its rows count more, when only as many
    rows as have `most` bytes of features together are taken, in the order of their places.

    The first row always counts, whatever its size. The driver gets a few numbers of each sampled row.
    """
    sizes = encoded.select("label", "place", F.octet_length("features").alias("bytes")).orderBy("label", "place").collect()
    out = {}
    for label in {row["label"] for row in sizes}:
        own = [row for row in sizes if row["label"] == label]
        used = np.cumsum([row["bytes"] for row in own])
        kept = max(1, int((used <= most).sum()))
        out[label] = (own[kept - 1]["place"], len(own) / kept)
    return out


def fitted(docs: DataFrame, labels: DataFrame, label: str, features: Features, fit: Callable, rows: int = SAMPLE_ROWS, seed: int = 42) -> Linear:
    """`fit(y, row weights, features by row)` run in one task on the sample, bounded in rows and in bytes.

    A row weighs as many rows of its label as it stands for. Without rows of both labels the score
    is the same for all texts: the one label's, or 0.5.
    """
    texts, share = sample(docs, labels, label, rows, seed)
    if len(share) < 2:
        return Linear({0: -20.0, 1: 20.0}[min(share)] if share else 0.0, np.zeros(0, np.uint32), np.zeros(0, np.float32))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in (x for whole in batches for x in slices(whole, target=AT_ONCE)):
            found = pa.array(distinct_features(batch.column("text"), features), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), found], names=["label", "place", "features"])

    encoded = stored(texts.mapInArrow(encode, "label int, place long, features binary"))
    kept = within_bytes(encoded, SAMPLE_BYTES // 2)
    share = {y: share[y] * more for y, (_, more) in kept.items()}

    def run(sampled: pa.Table) -> pa.Table:
        let_go()
        sampled = sampled.sort_by([("label", "ascending"), ("features", "ascending")])  # alike whatever task came first
        y = sampled.column("label").to_numpy().astype(np.float64)
        own = [np.frombuffer(x.as_buffer(), "<u4") for x in sampled.column("features")]
        order = np.random.default_rng(seed).permutation(len(y))
        weight = np.where(y == 1, share[1], share[0])
        got = fit(y[order], weight[order] / weight.mean(), [own[i] for i in order])
        release()
        return pa.table({"bias": [float(got.bias)], "features": [got.features.astype("<u4").tobytes()], "weights": [got.weights.astype("<f4").tobytes()]})

    bounded = [encoded.where((F.col("label") == y) & (F.col("place") <= last)) for y, (last, _) in sorted(kept.items())]
    whole = bounded[0].unionAll(bounded[1]).select("label", "features", F.lit(0).alias("all"))
    row = whole.groupBy("all").applyInArrow(run, "bias double, features binary, weights binary").first()
    return Linear(row["bias"], np.frombuffer(row["features"], "<u4"), np.frombuffer(row["weights"], "<f4"))


def scored(docs: DataFrame, model: Linear, features: Features) -> DataFrame:
    """doc_id, held_out and score of every document; a null text scores as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        table = model.table()
        for batch in (x for whole in batches for x in slices(whole, target=AT_ONCE)):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(model.scores(batch.column("text"), features, table), pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")


def filtered(docs: DataFrame, model: Linear, features: Features, keep: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The documents whose scores `keep` holds for, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        table = model.table()
        for batch in (x for whole in batches for x in slices(whole, target=AT_ONCE)):
            yield batch.filter(pa.array(keep(model.scores(batch.column("text"), features, table))))

    return docs.mapInArrow(run, docs.schema)
