"""Sequences of a fixed number of tokens, packed first-fit decreasing in randomised groups.

A document's ids are cut into whole sequences and a rest. Rests are dealt at random into groups
of bounded size; within a group the largest rest goes first, each into the first sequence with
room for it, which a tournament tree over the sequences' free room finds in logarithmic time.

A null text counts as empty and still has the closing id. Equal rows are packed a row each; rests of
one length go in the order of their rows. Very long documents only have more whole sequences. Only
doc_id and text are read, so that no name clashes. An empty table has an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.store import pieces, stored
from shelfline.llm.texts import slices
from shelfline.llm.tokens import MEMORY, units_of

#: Rests packed together, about.
GROUP_ROWS = 8192
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Tournament:
    """The free room of bins in order, with the most of every subtree."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """(bin, room it had): the first bin that takes `size`, which is taken from it."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < size:
                at += 1
        had = most[at]
        leaf, most[at] = at - self.leaves, had - size
        while at > 1:
            at //= 2
            most[at] = max(most[2 * at], most[2 * at + 1])
        return leaf, had


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, largest first, ties in the given order; none is over `room`."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree = Tournament(len(sizes), room)
    for i in np.argsort(-sizes, kind="stable").tolist():
        bins[i], had = tree.place(int(sizes[i]))
        offsets[i] = room - had
    return bins, offsets


def cut_documents(docs: DataFrame, content: str, room: int, memory: int = MEMORY) -> DataFrame:
    """Every document's pieces, with the checksum of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(content, memory)
        for batch in (x for whole in batches for x in slices(whole)):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), units.encode(batch.column("text"))):
                ids += b"\0\0\0\0"
                n, view = len(ids) // 4, memoryview(ids)
                rows += [(doc_id, a, min(room, n - a), zlib.crc32(view[4 * a : 4 * min(n, a + room)]), n) for a in range(0, n, room)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def pack(docs: DataFrame, path: str, room: int = 1024, group_rows: int = GROUP_ROWS, seed: int = 42, memory: int = MEMORY) -> DataFrame:
    """The pieces with sequence_id and offset: all of each document's ids, then id 0.

    memory: bytes that a worker remembers of the tokenizer's units; it changes no result.
    """
    cut = stored(cut_documents(docs, Path(path).read_text(encoding="utf-8"), room, memory))
    cut = cut.withColumn("_row", F.monotonically_increasing_id())
    groups = pieces(cut.where(F.col("length") < room).count(), group_rows)
    rests = cut.where(F.col("length") < room).withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(groups)))
    span = 1 << 24  # more sequences than a group can have

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_row")
        bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), room)
        ids = bins + rows.column("_group")[0].as_py() * span
        return rows.drop_columns(["_row", "_group"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    packed = rests.groupBy("_group").applyInArrow(fill, PIECE + ", sequence_id long, offset long")
    whole = cut.where(F.col("length") == room).withColumn("sequence_id", F.lit(groups * span) + F.col("_row"))
    return packed.unionByName(whole.drop("_row").withColumn("offset", F.lit(0).cast("long")))
