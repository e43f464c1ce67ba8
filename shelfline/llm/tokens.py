"""Token counts from a cache of digests: only texts that were never counted are encoded.

A text is known by the digest of its normalised content and the version of the tokenizer (the
digest of its file). Counts lie in a Parquet table; a run looks every distinct text up there,
encodes the misses once each, appends them, and joins the counts to all documents.

A worker remembers the tokens of units (a word and the white space before it) up to a bound in
bytes; long units are encoded each time they come.

Null counts as empty; an empty text has no tokens. Equal rows keep a row each; there are no ties.
Very long texts are counted whole, one at a time. Other columns than doc_id and text are left out,
so that no name clashes. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.store import shared_folder, stored
from shelfline.llm.texts import kept, plain, slices

#: Bytes of units and tokens that a worker remembers, about; less where other stages or a sort need memory beside.
MEMORY, LESS_MEMORY = 240 << 20, 96 << 20
#: Longest unit that is remembered, in characters; longer ones (of texts without white space) hardly recur.
LONGEST = 64
#: Bytes that a remembered unit takes beside its characters and tokens: two objects and a place in a table.
ENTRY_BYTES = 200
CACHE = "version string, digest binary, n_tokens long"
#: Marks that are learned apart from the word they follow.
MARKS = (".", ",")
#: Latin letters; after these a mark is never part of the same token.
LETTERS = frozenset(chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and c not in (0xAA, 0xBA))


class Units:
    """Token ids of texts, unit by unit; a unit is white space and what follows up to the next.

    Both kinds of tokenizer that this is used with (word ends, or a space before the word) cut
    every text where white space begins, so a text's ids are its units' ids in a row.
    """

    def __init__(self, content: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.memory, self.used = memory, 0
        # Units of late, and those before; what is met again of these is of late again.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks = self.encoded(list(MARKS))

    def encoded(self, units: list[str]) -> dict[str, bytes]:
        got = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return dict(zip(units, (array("I", x.ids).tobytes() for x in got)))

    def learned(self, units: list[str]) -> dict[str, bytes]:
        """The ids of new units; a full stop or comma after a letter is always a token of its own."""
        stems = [u[:-1] if u.endswith(MARKS) and u[-2:-1] in LETTERS else u for u in units]
        out = self.encoded([u for u in set(stems) if u not in self.young and u not in self.old])
        for unit, stem in zip(units, stems):
            if unit is not stem:
                known = out if stem in out else self.young if stem in self.young else self.old
                out[unit] = known[stem] + self.marks[unit[-1]]
        return out

    def look_up(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units, which are remembered if they are not long."""
        out = list(map(self.young.get, units))
        absent = [u for u, x in zip(units, out) if x is None]
        before = list(map(self.old.get, absent))
        found = self.learned([u for u, x in zip(absent, before) if x is None])
        found.update((u, x) for u, x in zip(absent, before) if x is not None)
        rest = map(found.__getitem__, absent)
        out = [next(rest) if x is None else x for x in out]
        if max(map(len, found), default=0) > LONGEST:
            found = {u: x for u, x in found.items() if len(u) <= LONGEST}
        self.remember(found)
        return out

    def remember(self, found: dict[str, bytes]) -> None:
        """Adds the units; each of the two tables has at most half of the memory."""
        size = weight(found)
        if self.used + size > self.memory // 2:
            self.old, self.young, self.used = self.young, {}, 0
        if size <= self.memory // 2:
            self.young.update(found)
            self.used += size

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        texts = plain(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if len(texts) and offsets[-1] else pa.py_buffer(b"")
        starts = unit_starts(np.frombuffer(data, np.uint8)[: offsets[-1]], offsets)
        cut = pa.py_buffer(np.r_[starts, offsets[-1]])
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, cut, data]).dictionary_encode()
        names = coded.dictionary.to_pylist()
        ids = pa.array(self.look_up(names), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        every = ids.buffers()[2].to_pybytes() if ends[-1] else b""
        at = ends[np.searchsorted(starts, offsets)].tolist()
        for a, b in zip(at, at[1:]):
            yield every[a:b]


def weight(ids: dict[str, bytes]) -> int:
    """About how many bytes the units take in a worker's memory."""
    return len(ids) * ENTRY_BYTES + 2 * sum(map(len, ids)) + sum(map(len, ids.values()))


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units start: at every text, and at ASCII white space that follows anything else.

    After a byte of a character that isn't ASCII this is certain only for those that start with
    0xC3 (Latin letters): others may be white space, and then the unit goes on.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data), bool)
    first[1:] = space[1:] & ~space[:-1] & (data[:-1] < 128)
    first[2:] |= space[2:] & (data[1:-1] >= 128) & (data[:-2] == 0xC3)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(first).astype(np.int64)


def units_of(content: str, memory: int = MEMORY) -> Units:
    """The worker's memory of this tokenizer, kept between tasks."""
    return kept(f"{memory}-{hashlib.sha256(content.encode()).hexdigest()}", lambda: Units(content, memory))


def normalised(collapse: bool) -> Column:
    """What the digest is taken of. collapse: white space only separates words for the tokenizer."""
    text = F.coalesce("text", F.lit(""))
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")) if collapse else text


def encode_misses(misses: DataFrame, content: str, version: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(content, LESS_MEMORY)
        for batch in (x for whole in batches for x in slices(whole)):
            counts = [len(x) // 4 for x in units.encode(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(counts)), batch.column("digest"), pa.array(counts, pa.int64())],
                names=["version", "digest", "n_tokens"],
            )

    return misses.mapInArrow(run, CACHE)


def token_counts(docs: DataFrame, path: str, cache: str | None = None, collapse: bool = False, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document.

    path: a tokenizer file of the tokenizers library. cache: the folder of the stored counts; a
    new one where none is given. collapse: see `normalised`; only for tokenizers that drop white space.
    """
    spark, content = docs.sparkSession, Path(path).read_text(encoding="utf-8")
    version, cache = hashlib.sha256(content.encode()).hexdigest()[:16], cache or shared_folder(docs.sparkSession)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    texts = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), normalised(collapse).alias("text"))
    keyed = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))

    def known() -> DataFrame:
        return spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version).select("digest", "n_tokens")

    distinct = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    encode_misses(distinct.join(known(), "digest", "left_anti"), content, version).write.mode("append").parquet(cache)
    once = stored(known().dropDuplicates(["digest"]))  # a plain table, so that a hot digest can be split
    counted = keyed.select("doc_id", "n_bytes", "digest").join(once, "digest")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
