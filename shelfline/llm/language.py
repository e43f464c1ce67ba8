"""Language by cross-parsing: the language whose labelled text covers a document in fewest phrases.

Of each language a bounded sample of labelled text is taken. Its suffix automaton holds all its
substrings; a document is parsed from left to right, each phrase the longest match with the sample
(one byte where nothing matches). The number of phrases, times the bits that point into the sample,
by the document's bytes, estimates the cross entropy; the language with the least wins, and of
equal ones the first by name.

Text is taken as bytes: A-Z lower-cased, runs of other ASCII than letters as one space. It is parsed
in stretches of a fixed number of bytes, all stretches of a slice side by side, so a very long text
is many stretches and every byte of it counts. The automata are walked as tables in numpy.

Null and texts without a letter are `und` with score 0, and so are all where no language was learned.
The score is how much fewer bits the best language needs than the second, as a share (1 if there is
one language only). Repeated rows keep a row each; null ids are held out. Copies of a text enter the
sample once. An empty table has an empty result. Other columns than doc_id, text and lang are left
out, so that no name clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.store import held_out
from shelfline.llm.texts import fold_table, kept, slices, translate

#: Sampled texts of a language at most, and characters of a stretch taken from each.
SAMPLE_TEXTS, SAMPLE_CHARS = 64, 1500
#: Bytes of all languages' samples together at most; with many languages each has fewer texts.
SAMPLE_BYTES = 4 << 20
#: Bytes that are parsed on their own.
STRETCH = 4096
#: Letters are a-z and non-ASCII; anything else separates.
LETTERS = fold_table(lambda b: b >= 0x80 or 97 <= b <= 122, lower=True)
UNKNOWN = "und"


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by text and the bytes: lower case, with one space for what stands between letters."""
    texts = translate(texts, LETTERS)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    keep[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.r_[0, np.cumsum(keep)][offsets], data[keep]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """The moves of each state; state 0 is the start, and every path from it spells a substring."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


class Parser:
    """The automata of all languages in one table: place of a state + class of a byte -> next place.

    Place 0 is no state: nothing goes on from there, so it ends the phrase.
    """

    def __init__(self, samples: list[bytes]):
        seen = sorted({b for s in samples for b in s})
        self.width = len(seen) + 1  # class 0: bytes in no sample
        self.classes = np.zeros(256, np.int32)
        self.classes[seen] = np.arange(1, self.width)
        rows, self.first = [np.zeros((1, self.width), np.int32)], np.zeros((len(samples), self.width), np.int32)
        before = 1
        for i, sample in enumerate(samples):
            moves = suffix_automaton(sample)
            own = np.zeros((len(moves), self.width), np.int32)
            for state, to in enumerate(moves):
                own[state, self.classes[list(to)]] = list(to.values())
            own = np.where(own > 0, (own + before) * self.width, 0).astype(np.int32)
            self.first[i] = own[0]
            rows.append(own)
            before += len(moves)
        self.next = np.concatenate(rows).reshape(-1)
        self.bits = np.log2([max(2, len(s)) for s in samples])

    def phrases(self, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The phrases of each text in each language."""
        codes, sizes = self.classes[data], np.diff(ends)
        cuts = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(sizes)), cuts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        start = ends[:-1][owner] + inside * STRETCH
        size = np.minimum(STRETCH, ends[1:][owner] - start)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        first = np.ascontiguousarray(self.first.T)  # by class, the languages' places
        place = np.zeros((len(start), len(self.bits)), np.int32)
        count = np.zeros(place.shape, np.int32)
        going = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
        for step, m in enumerate(going.tolist()):
            code = codes[start[:m] + step]
            to = self.next.take(place[:m] + code[:, None])
            ended = to == 0
            count[:m] += ended
            place[:m] = np.where(ended, first[code], to)
        out = np.zeros((len(sizes), len(self.bits)), np.int64)
        np.add.at(out, owner, count)
        return out

    def cost(self, texts: pa.Array) -> np.ndarray:
        """Bits a byte of each text in each language."""
        ends, data = letters(texts)
        return self.phrases(ends, data) * self.bits / np.maximum(1, np.diff(ends))[:, None]


def parser_of(samples: list[bytes]) -> Parser:
    """The worker's parser of these samples, kept between tasks."""
    return kept(hashlib.sha256(b"\0".join(samples)).hexdigest(), lambda: Parser(samples))


def labelled_samples(docs: DataFrame) -> dict[str, bytes]:
    """By language: stretches of at most SAMPLE_TEXTS distinct labelled texts, joined.

    Texts come by hash, from a range of hashes that holds about twice as many as are taken; each
    gives a stretch at a place that its hash picks. The driver gets a row per language and sample.
    """
    has_letter = F.col("text").rlike(r"\p{L}")
    known = docs.where(F.col("lang").isNotNull() & has_letter & ~held_out(folds=3, fold=1)).select("lang", "text", F.xxhash64("text").alias("hash"))
    texts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    if not texts:
        return {}
    each = max(1, min(SAMPLE_TEXTS, SAMPLE_BYTES // (4 * SAMPLE_CHARS * len(texts))))
    share = docs.sparkSession.createDataFrame([(lang, min(1.0, 2 * each / n)) for lang, n in texts.items()], "lang string, share double")
    drawn = known.join(F.broadcast(share), "lang").where(F.pmod("hash", F.lit(1 << 30)) < F.col("share") * (1 << 30))  # a row per language
    spare = F.greatest(F.lit(1), F.char_length("text") - SAMPLE_CHARS)
    stretch = F.substring("text", F.pmod("hash", spare).cast("int") + 1, F.lit(SAMPLE_CHARS))
    drawn = drawn.groupBy("lang", "hash").agg(F.min(stretch).alias("stretch"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))  # about 2 * each rows a language
    rows = drawn.withColumn("place", place).where(F.col("place") <= each).orderBy("lang", "place").collect()
    out: dict[str, bytes] = {}
    for row in rows:
        _, data = letters(pa.array([row["stretch"]], pa.large_string()))
        out[row["lang"]] = out.get(row["lang"], b"") + data.tobytes() + b" "
    return out


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from text and lang outside the held-out fold."""
    samples = labelled_samples(docs)
    names, texts = sorted(samples), [samples[x] for x in sorted(samples)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in slices(whole)):
            lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if names and batch.num_rows:
                cost = parser_of(texts).cost(batch.column("text"))
                best, least = cost.argmin(axis=1), np.sort(cost, axis=1)
                share = 1 - least[:, 0] / np.maximum(least[:, 1], 1e-300) if len(names) > 1 else np.ones(batch.num_rows)
                read = batch.column("read").to_numpy(zero_copy_only=False)
                lang, score = [names[b] if r else UNKNOWN for b, r in zip(best.tolist(), read)], np.where(read, share, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    read = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("read")
    rows = docs.select(F.col("doc_id").cast("long"), held_out(folds=3, fold=1).alias("held_out"), "text", read)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
