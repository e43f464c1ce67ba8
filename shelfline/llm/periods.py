"""Repeated stretches of words: maximal runs of a period, found by a dictionary of basic factors.

A basic factor is a stretch of 1, 2, 4, 8 ... words. Level by level all factors of one length are
named, a factor of twice the length by the names of its halves, so that equal names are equal words.
Where a factor occurs again within twice its length, the distance proposes a period; starts side by
side with one distance are an arithmetic progression and extend to the words from the first start to
a period and a factor after the last. A distance over the length may miss part of its run, whose
factors of the next level hold a whole period; so a run is taken from levels whose factors are at
least as long as its period. There the progression is the whole run and its distance the smallest
period: a nearer occurrence would be a shorter period. What several levels find is taken once.

Factors that occur once in their text leave: no longer factor with one of them in it occurs twice.
Work and memory of a level are those of the repeated factors, at most linear in the text, and only
one level is held. Texts share no names, so a slice of texts is handled at once.

Null counts as empty; a text without words has no runs and collapses to the empty text. Very long
texts are handled whole, one at a time. Repeated rows keep a row each, also with null ids. Runs of
one start differ in period and all stay, by start, then period. An empty table has an empty result.
Other columns are left out, so that no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.texts import owners, slices, split_words

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"


def factors(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By factor: its name, the distance to the next of that name (0: none), and if it occurs twice.

    keys: what is equal for equal factors; at: where they start, ascending.
    """
    order = np.argsort(keys, kind="stable")
    ranked, place = keys[order], at[order]
    follows = ranked[1:] == ranked[:-1]
    name, gap, twice = np.empty(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    name[order] = np.cumsum(np.r_[0, ~follows])
    gap[order[:-1][follows]] = (place[1:] - place[:-1])[follows]
    twice[order[:-1][follows]] = twice[order[1:][follows]] = True
    return name, gap, twice


def progressions(at: np.ndarray, gap: np.ndarray, size: int) -> np.ndarray:
    """(start, length, period) of the words under starts side by side with one distance."""
    first = np.r_[True, (at[1:] != at[:-1] + 1) | (gap[1:] != gap[:-1])]
    start, last, period = at[first], at[np.r_[first[1:], True]], gap[first]
    return np.column_stack([start, last - start + size + period, period])


def find_runs(ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs by start and period, in the flat words of all texts.

    ends: offsets by text; words: numbers that are equal for equal words.
    """
    owner, n = owners(ends), len(words)
    at, size, found = np.arange(n), 1, [np.zeros((0, 3), np.int64)]
    keys = owner * (int(words.max()) + 1 if n else 1) + words
    while len(at):
        name, gap, twice = factors(keys, at)
        whole = (gap > 0) & (gap <= size)
        if whole.any():
            got = progressions(at[whole], gap[whole], size)
            found.append(got[got[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * got[:, 2])])
        held = np.full(n, -1, np.int64)
        held[at[twice]] = name[twice]
        left = at[twice]
        left = left[left + size < n]
        left = left[(held[left + size] >= 0) & (owner[left + size] == owner[left])]
        keys, at, size = held[left] * (len(at) + 1) + held[left + size], left, size * 2
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when of each run only the first period does."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(step)[:n] == 0


def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    ends, words = split_words(batch.column("text"))
    coded = words.dictionary_encode()
    runs = find_runs(ends, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
    keep = collapsed(len(words), runs)
    kept = np.r_[0, np.cumsum(keep)][ends]
    lists = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep)))
    cut = np.searchsorted(runs[:, 0], ends)
    cut[-1:] = len(runs)
    start = runs[:, 0] - np.repeat(ends[:-1], np.diff(cut))
    each = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, runs[:, 1], runs[:, 2])], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), each), pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "text"],
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the runs of each text, and the text with only the first period of each.

    Words are runs of anything but ASCII white space, and joined by one space in the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole)):
            if batch.num_rows:
                yield rows_of(batch)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RUNS)
