"""Passages that occur before, removed from whole texts by repeated-phrase automata.

A window is `window` consecutive words of one text. A word goes when a window that covers it also
starts earlier, in a smaller doc_id or earlier in the same document.

1. Texts are staged in shards of bounded size, in a table bucketed by shard, so that the later
   steps read them in place.
2. Anchors: of the short phrases in each window, the one with the least hash. Windows that recur
   share it, so only windows whose anchor occurs twice or more in the corpus go on.
3. Those windows are confirmed to recur (96 bits of hash), with their first place.
4. Passages: the words of neighbouring confirmed windows at their first place, sent to every shard
   in which one of these windows occurs again.
5. Each shard compiles an Aho-Corasick automaton of phrases so spaced that every window of a passage
   holds a whole one, and streams its documents through it. Windows around a located phrase are
   compared with the passages word by word; those with an earlier first place are removed.

Steps 2 and 3 combine within a shard before the exchange, so a line that a third of all documents
share is sent once for each shard. Null texts have no words. A null doc_id comes after all others.
Rows that share a doc_id are one document: of equal rows none comes earlier. An empty table has an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.decontamination import member
from shelfline.llm.store import pieces
from shelfline.llm.texts import covered, plain, rolling, slices, sliding, split_words, windows, word_hashes

#: Words of a window, of an anchor, and of a phrase of the automaton.
WINDOW, ANCHOR, PHRASE = 20, 6, 10
#: Characters that stand for a word in the automaton.
SYMBOLS = 4
#: Staged blocks of text in a shard; bytes of text for each task that gathers anchors or windows.
SHARD_BLOCKS, ANCHOR_BYTES, WINDOW_BYTES = 4, 48 << 20, 16 << 20
#: A null doc_id.
LAST = 2**63 - 1
STAGED = "shard long, ids array<long>, ends array<long>, bytes long, blob binary"
RESULT = "doc_id long, text string, n_words long, n_removed long, spans array<struct<start: long, end: long>>"


def zipped(*columns: np.ndarray) -> list[bytes]:
    pack = zstandard.ZstdCompressor(level=1).compress
    return [pack(np.ascontiguousarray(c).tobytes()) for c in columns]


def unzipped(column: pa.ChunkedArray, dtype) -> np.ndarray:
    open_ = zstandard.ZstdDecompressor().decompress
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(open_(x), dtype) for x in column.to_pylist())])


def sizes_of(column: pa.ChunkedArray, dtype) -> list[int]:
    return [zstandard.frame_content_size(x) // np.dtype(dtype).itemsize for x in column.to_pylist()]


def stage(docs: DataFrame, name: str, buckets: int) -> DataFrame:
    """The texts in compressed blocks, as the table `name`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, task, n = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId(), 0
        for batch in (x for whole in batches for x in slices(whole)):
            text = plain(batch.column("text"))
            ends = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1]
            data = (text.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[: ends[-1]]
            row = [task << 24 | n // SHARD_BLOCKS], [batch.column("doc_id").to_pylist()], [ends.tolist()], [len(data)], [pack(data)]
            n += 1
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["shard", "ids", "ends", "bytes", "blob"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STAGED)
    rows.write.format("parquet").option("compression", "none").bucketBy(buckets, "shard").saveAsTable(name)
    return docs.sparkSession.table(name)


class Words:
    """The words of a staged block, and whose they are."""

    def __init__(self, row: dict):
        data = zstandard.ZstdDecompressor().decompress(row["blob"])
        offsets = pa.py_buffer(np.array(row["ends"], np.int64).tobytes())
        text = pa.Array.from_buffers(pa.large_string(), len(row["ids"]), [None, offsets, pa.py_buffer(data)])
        self.ends, self.words = split_words(text)
        self.ids = np.array([LAST if x is None else x for x in row["ids"]], np.int64)
        self.names = row["ids"]

    def hashes(self) -> None:
        self.high, self.low = word_hashes(self.words, wide=True)

    def starts(self) -> np.ndarray:
        """Which words start a window."""
        return windows(self.ends, WINDOW)

    def window_hashes(self) -> np.ndarray:
        return rolling(self.high, WINDOW)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(the least phrase hash of each window, the phrase hash at each word)."""
        phrase = rolling(self.high, ANCHOR)
        return sliding(phrase, WINDOW - ANCHOR + 1), phrase

    def chosen(self) -> np.ndarray:
        """The hashes of the phrases that are the least of some window, one for each place."""
        least, phrase = self.anchors()
        if not len(least):
            return phrase[:0]
        span = WINDOW - ANCHOR + 1
        edge = np.zeros(span - 1, np.uint64)
        most = sliding(np.r_[edge, np.where(self.starts(), least, 0), edge], span, np.maximum)
        return phrase[most[: len(phrase)] == phrase]


def blocks_of(rows: pa.Table) -> Iterator[Words]:
    for i in range(rows.num_rows):
        yield Words(rows.slice(i, 1).to_pylist()[0])


def dealt(q: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, positions) of the values that go to each of the parts."""
    order = np.argsort(q % parts, kind="stable")
    part = (q % parts)[order]
    for at in np.split(order, np.flatnonzero(part[1:] != part[:-1]) + 1) if len(order) else []:
        yield int(q[at[0]] % parts), at


def anchor_counts(staged: DataFrame, parts: int) -> DataFrame:
    """(part, shard, hashes, counts): the distinct anchors of each shard, counted to two."""

    def counted(shard: int, found: list[np.ndarray]) -> pa.RecordBatch:
        hashes, n = np.unique(np.concatenate(found), return_counts=True)
        rows = [(q, shard, *zipped(hashes[at], np.minimum(n[at], 2).astype(np.uint8))) for q, at in dealt(hashes >> np.uint64(20), parts)]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)], names=["part", "shard", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = None, []
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            if row["shard"] != shard and found:
                yield counted(shard, found)
                found = []
            shard, words = row["shard"], Words(row)
            words.hashes()
            found.append(words.chosen())
        if found:
            yield counted(shard, found)

    return staged.mapInArrow(run, "part long, shard long, hashes binary, counts binary")


def recurring(rows: pa.Table) -> pa.Table:
    """Of one part's anchors, those that occur twice or more, for each shard that has them."""
    hashes, n = unzipped(rows.column("hashes"), np.uint64), unzipped(rows.column("counts"), np.uint8)
    sizes = sizes_of(rows.column("hashes"), np.uint64)
    _, group = np.unique(hashes, return_inverse=True)
    twice = np.bincount(group, n)[group] >= 2
    cuts = np.cumsum([0, *sizes])
    out = [(shard, zipped(hashes[a:b][twice[a:b]])[0]) for shard, a, b in zip(rows.column("shard").to_pylist(), cuts, cuts[1:]) if twice[a:b].any()]
    return pa.table({"shard": pa.array([s for s, _ in out], pa.int64()), "hashes": pa.array([h for _, h in out], pa.binary())})


def candidate_windows(parts: int):
    """For a shard and its recurring anchors: distinct windows with first place and count to two."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        keys, found = np.unique(unzipped(anchors.column("hashes"), np.uint64)), []
        for words in blocks_of(rows) if len(keys) else []:
            words.hashes()
            least, _ = words.anchors()
            at = np.flatnonzero(member(least, keys) & words.starts()) if len(least) else np.zeros(0, np.int64)
            owner = np.searchsorted(words.ends, at, side="right") - 1
            second = (rolling(words.low, WINDOW)[at] >> np.uint64(32)).astype(np.uint32)
            found.append((words.window_hashes()[at], second, words.ids[owner], (at - words.ends[owner]).astype(np.int64)))
        if not found:
            return WINDOWS.empty_table()
        high, low, doc, start = map(np.concatenate, zip(*found))
        first, n = earliest(high, low, doc, start)
        shard = rows.column("shard")[0].as_py()
        out = [
            (q, shard, *zipped(high[first][at], low[first][at], doc[first][at], start[first][at], np.minimum(n[at], 2).astype(np.uint8)))
            for q, at in dealt(high[first] >> np.uint64(20), parts)
        ]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, WINDOWS.types)], schema=WINDOWS)

    return run


WINDOWS = pa.schema([("part", pa.int64()), ("shard", pa.int64()), *((c, pa.binary()) for c in ("high", "low", "doc", "start", "n"))])
WINDOWS_SQL = "part long, shard long, high binary, low binary, doc binary, start binary, n binary"


def earliest(high, low, doc, start) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first place of each distinct window, and how many places it has."""
    order = np.lexsort((start, doc, low, high))
    new = np.r_[True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])] if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return order[at], np.diff(np.r_[at, len(order)])


def confirmed(rows: pa.Table) -> pa.Table:
    """Of one part's windows, those that recur: first places by their shard, with who needs them."""
    high, low = unzipped(rows.column("high"), np.uint64), unzipped(rows.column("low"), np.uint32)
    doc, start, n = unzipped(rows.column("doc"), np.int64), unzipped(rows.column("start"), np.int64), unzipped(rows.column("n"), np.uint8)
    shard = np.repeat(np.array(rows.column("shard").to_pylist(), np.int64), sizes_of(rows.column("n"), np.uint8))
    order = np.lexsort((start, doc, low, high))
    high, low, doc, start, n, shard = (x[order] for x in (high, low, doc, start, n, shard))
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)[group]
    needed = (np.bincount(group, n)[group] >= 2) & ((first != np.arange(len(n))) | (n >= 2))
    home, target, doc, start = shard[first][needed], shard[needed], doc[first][needed], start[first][needed]
    out = []
    order = np.lexsort((start, doc, target, home))
    for at in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(order) else []:
        out.append((int(home[at[0]]), *zipped(target[at], doc[at], start[at])))
    columns = list(zip(*out)) if out else [()] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.binary()] * 3])], names=["shard", "target", "doc", "start"])


def passages(rows: pa.Table, wanted: pa.Table) -> pa.Table:
    """For a shard and its first places: the passages (doc, start, words) for each target shard."""
    names = ["shard", "docs", "starts", "texts"]
    empty = pa.Table.from_arrays([pa.array([], t) for t in [pa.int64(), *[pa.binary()] * 3]], names=names)
    target, doc, start = (unzipped(wanted.column(c), np.int64) for c in ("target", "doc", "start"))
    if not len(target) or not rows.num_rows:
        return empty
    order = np.lexsort((start, doc, target))
    target, doc, start = target[order], doc[order], start[order]
    keep = np.r_[True, (target[1:] != target[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])]
    target, doc, start = target[keep], doc[keep], start[keep]
    cut = np.flatnonzero(np.r_[True, (target[1:] != target[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.r_[cut[1:], len(start)] - 1
    target, doc, end, start = target[cut], doc[cut], start[last] + WINDOW, start[cut]
    out = {int(t): ([], [], []) for t in np.unique(target)}
    by_doc = np.argsort(doc, kind="stable")
    sorted_docs = doc[by_doc]
    for words in blocks_of(rows):
        for d, own in enumerate(words.ids.tolist()):
            a, b = np.searchsorted(sorted_docs, [own, own + 1]) if own < LAST else (np.searchsorted(sorted_docs, own), len(sorted_docs))
            size = int(words.ends[d + 1] - words.ends[d])
            for i in by_doc[a:b]:
                if end[i] <= size:
                    text = " ".join(words.words.slice(int(words.ends[d] + start[i]), int(end[i] - start[i])).to_pylist())
                    for column, value in zip(out[int(target[i])], (own, int(start[i]), text)):
                        column.append(value)
    rows_out = [(t, *zipped(np.array(d, np.int64), np.array(s, np.int64), np.frombuffer("\n".join(x).encode(), np.uint8))) for t, (d, s, x) in out.items() if d]
    columns = list(zip(*rows_out)) if rows_out else [()] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.binary()] * 3])], names=names)


class Passages:
    """The passages that a shard needs, and the automaton of their phrases."""

    def __init__(self, sent: pa.Table):
        self.doc, self.start = unzipped(sent.column("docs"), np.int64), unzipped(sent.column("starts"), np.int64)
        open_ = zstandard.ZstdDecompressor().decompress
        texts = [x for blob in sent.column("texts").to_pylist() for x in open_(blob).decode().split("\n")]
        self.ends, self.words = split_words(pa.array(texts, pa.large_string()))
        (self.hash,) = word_hashes(self.words)
        own = np.flatnonzero(windows(self.ends, WINDOW))
        owner = np.searchsorted(self.ends, own, side="right") - 1
        place = self.start[owner] + own - self.ends[owner]
        window = rolling(self.hash, WINDOW)[own] if len(own) else np.zeros(0, np.uint64)
        order = np.lexsort((place, self.doc[owner], window))
        order = order[np.r_[True, window[order][1:] != window[order][:-1]]] if len(order) else order
        self.window, self.at, self.place, self.of = window[order], own[order], place[order], self.doc[owner][order]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        line = symbols(self.hash)
        for a, b in zip(self.ends.tolist(), self.ends[1:].tolist()):
            for i in range(a, b - PHRASE + 1, WINDOW - PHRASE + 1):
                self.automaton.add_word(line[SYMBOLS * i : SYMBOLS * (i + PHRASE)])
        if len(self.automaton):
            self.automaton.make_automaton()

    def repeats(self, words: Words) -> np.ndarray:
        """The window starts of the block whose words are in a passage with an earlier place."""
        none = np.zeros(0, np.int64)
        if not len(self.automaton) or len(words.words) < WINDOW:
            return none
        (hashes,) = word_hashes(words.words)
        ends = np.fromiter((end for end, _ in self.automaton.iter(symbols(hashes))), np.int64)
        ends = ends[ends % SYMBOLS == SYMBOLS - 1] // SYMBOLS
        if not len(ends):
            return none
        n = len(hashes)
        near = covered(n, np.maximum(ends - WINDOW + 1, 0), WINDOW - PHRASE + 1)[: n - WINDOW + 1] & words.starts()
        at = np.flatnonzero(near)
        window = rolling(hashes, WINDOW)[at]
        found = np.minimum(np.searchsorted(self.window, window), len(self.window) - 1)
        same = self.window[found] == window
        at, found = at[same], found[same]
        at, found = self.verified(words, at, found)
        owner = np.searchsorted(words.ends, at, side="right") - 1
        doc, place = words.ids[owner], at - words.ends[owner]
        earlier = (self.of[found] < doc) | ((self.of[found] == doc) & (self.place[found] < place))
        return at[earlier]

    def verified(self, words: Words, at: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows that equal their passage's word for word.

        Of windows in a row that follow one passage, each needs its first word compared, and the
        last one all its words.
        """
        if not len(at):
            return at, found
        theirs = self.at[found]
        last = np.r_[(at[1:] != at[:-1] + 1) | (theirs[1:] != theirs[:-1] + 1), True]
        more = np.arange(1, WINDOW)
        a = np.concatenate([at, (at[last][:, None] + more).ravel()])
        b = np.concatenate([theirs, (theirs[last][:, None] + more).ravel()])
        equal = pc.equal(words.words.take(pa.array(a)), self.words.take(pa.array(b))).to_numpy(zero_copy_only=False)
        run = np.cumsum(np.r_[False, last[:-1]])
        bad = np.bincount(run, ~equal[: len(at)]) + np.bincount(np.arange(last.sum()).repeat(WINDOW - 1), ~equal[len(at) :])
        good = bad[run] == 0
        return at[good], found[good]


def symbols(hashes: np.ndarray) -> str:
    """A few characters of a small alphabet for each word, so that nodes have few branches.

    Words may share theirs, as what is located is compared afterwards.
    """
    code = np.empty((len(hashes), SYMBOLS), np.uint8)
    for i in range(SYMBOLS):
        code[:, i] = (hashes >> np.uint64(5 * i)) & np.uint64(31)
    return (code + 65).tobytes().decode("latin-1")


def remove(rows: pa.Table, sent: pa.Table) -> pa.Table:
    """A shard's documents without the words of repeated windows."""
    known, parts = Passages(sent), []
    for words in blocks_of(rows):
        gone = covered(len(words.words), known.repeats(words), WINDOW)
        before = np.r_[0, np.cumsum(~gone)]
        left = pa.ListArray.from_arrays(pa.array(before[words.ends], pa.int32()), words.words.filter(pa.array(~gone)).cast(pa.string()))
        text = pc.binary_join(left, " ")
        size, removed = np.diff(words.ends), np.diff(np.r_[0, np.cumsum(gone)][words.ends])
        spans = [spans_of(gone[a:b]) if r else [] for a, b, r in zip(words.ends, words.ends[1:], removed)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        parts.append(pa.table({"doc_id": pa.array(words.names, pa.int64()), "text": text, "n_words": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, kind)}))
    return pa.concat_tables(parts) if parts else pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "spans": pa.array([], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})


def spans_of(gone: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.r_[0, gone.astype(np.int8), 0])
    return [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))]


class SubstringDedup:
    """`result`: doc_id, text (what stays, joined by spaces), n_words, n_removed, spans (of words)."""

    def __init__(self, docs: DataFrame):
        self.spark, self.name = docs.sparkSession, f"llm_{uuid4().hex}"
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        staged = stage(docs, self.name, pieces(total, WINDOW_BYTES))
        anchors = anchor_counts(staged.select("shard", "ids", "ends", "blob"), pieces(total, ANCHOR_BYTES))
        twice = anchors.groupBy("part").applyInArrow(recurring, "shard long, hashes binary")
        texts = staged.select("shard", "ids", "ends", "blob").groupBy("shard")
        found = texts.cogroup(twice.groupBy("shard")).applyInArrow(candidate_windows(pieces(total, WINDOW_BYTES)), WINDOWS_SQL)
        places = found.groupBy("part").applyInArrow(confirmed, "shard long, target binary, doc binary, start binary")
        sent = texts.cogroup(places.groupBy("shard")).applyInArrow(passages, "shard long, docs binary, starts binary, texts binary")
        self.result = texts.cogroup(sent.groupBy("shard")).applyInArrow(remove, RESULT)

    def drop(self) -> None:
        """Deletes the staged texts; what is made of `result` must be written by then."""
        self.spark.sql(f"DROP TABLE {self.name}")
