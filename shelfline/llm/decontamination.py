"""Benchmark passages in documents, by a prefix-filtered set join on word shingles.

Every item is cut into windows of consecutive words, a shorter item is one window, and a window is
the set of its shingles. The shingles are ordered by how rare they are in all documents. As a
document must contain the whole window, a window's rarest shingle alone is its necessary prefix:
only documents with that shingle are candidates. The shingle's position in the window fixes where
the window would lie in the document (positional bound), which must have room for it (length
bound); what is left is verified word by word over a stretch of the window's size.

Items become distinct windows, and windows their shingles and rarest shingle, in Spark. Windows come
to the tasks in blocks that are bounded in rows and bytes, and all documents meet every block; the
driver holds one block's hashes, then its windows, as Arrow tables. So repeated items count once and
a long item is spread over the blocks. (Only a single window, or the ids of the items that share
one, may be larger than a block: they are one value of the result.)

Null texts have no words; such documents have no hits and such items no windows. Items with the
same window are all reported, so there are no ties. Equal rows keep a row each. Very long documents
are searched whole, one at a time. `clean` returns other columns whatever they are called;
`contained_items` replaces those that are called like a new one. Either table may be empty.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.llm.store import keeps_columns, neutral, stored
from shelfline.llm.texts import LOWER_ALNUM, rolling, slices, split_words, windows, word_hashes

#: Words of a window, and of a shingle.
WINDOW, SHINGLE = 10, 5
#: Windows, and bytes of them and their items' ids, that are sent to the tasks at once.
BLOCK_ROWS, BLOCK_BYTES = 500_000, 48 << 20
#: Windows of an item that are made at once.
CHUNK = 50_000
FOUND = "n_words long, spans array<struct<start: long, length: long>>, items array<string>"


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(window, item_id): the windows of all items, as words joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (x for whole in batches for x in slices(whole, target=1 << 20)):
            ends, words = split_words(rows.column("text"), LOWER_ALNUM)
            sizes = np.diff(ends)
            starts = np.flatnonzero(windows(ends, window)) if len(words) >= window else np.zeros(0, np.int64)
            short = (sizes > 0) & (sizes < window)
            parts = [(starts[a : a + CHUNK], window) for a in range(0, len(starts), CHUNK)]
            parts += [(ends[:-1][short & (sizes == n)], n) for n in range(1, window)]
            for at, n in parts:
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * n, pa.int32()), words.take(pa.array((at[:, None] + np.arange(n)).reshape(-1))))
                owner = pa.array(np.searchsorted(ends, at, side="right") - 1)
                text = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([text, rows.column("item_id").take(owner)], names=["window", "item_id"])

    return items.mapInArrow(run, "window string, item_id string").distinct()


def window_shingles(known: DataFrame, shingle: int) -> DataFrame:
    """(window, size, hash, position) of the shingles of each window; fewer words are one shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (x for whole in batches for x in slices(whole, "window", 1 << 20)):
            ends, words = split_words(rows.column("window"))
            (h,) = word_hashes(words)
            sizes = np.minimum(np.diff(ends), shingle)
            for size in np.unique(sizes).tolist():
                own = rolling(h, size)
                at = np.flatnonzero(windows(ends, size)) if len(own) else np.zeros(0, np.int64)
                owner = np.searchsorted(ends, at, side="right") - 1
                at, owner = at[sizes[owner] == size], owner[sizes[owner] == size]
                columns = [rows.column("window").take(pa.array(owner)), pa.array(np.full(len(at), size, np.int32)), pa.array(own[at].view(np.int64)), pa.array((at - ends[owner]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["window", "size", "hash", "position"])

    return known.select("window").mapInArrow(run, "window string, size int, hash long, position int")


def by_size(table: pa.Table) -> dict[int, np.ndarray]:
    """Sorted distinct hashes by shingle length."""
    size, hashes = table.column("size").to_numpy(), table.column("hash").to_numpy().view(np.uint64)
    return {int(s): np.unique(hashes[size == s]) for s in np.unique(size)}


def hits(batch: pa.RecordBatch, wanted: dict[int, np.ndarray]) -> Iterator[tuple]:
    """For each slice of the batch: the slice, its word offsets and words, and (size, position, hash)s."""
    for rows in slices(batch):
        ends, words = split_words(rows.column("text"), LOWER_ALNUM)
        (h,) = word_hashes(words)
        found = []
        for size, keys in wanted.items():
            own = rolling(h, size)
            at = np.flatnonzero(member(own, keys) & windows(ends, size)) if len(own) else np.zeros(0, np.int64)
            found.append((size, at, own[at]))
        yield rows, ends, words, found


def member(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys; a bitmap of their top 20 bits turns most away."""
    top = np.zeros(1 << 20, bool)
    top[keys >> np.uint64(44)] = True
    maybe = top[values >> np.uint64(44)]
    left = values[maybe]
    maybe[maybe] = keys[np.minimum(np.searchsorted(keys, left), len(keys) - 1)] == left
    return maybe


def rarity(docs: DataFrame, wanted: dict[int, np.ndarray]) -> DataFrame:
    """(size, hash, n): how often each of the shingles occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, found in hits(batch, wanted):
                for size, _, values in found:
                    keys, n = np.unique(values, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), size, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["size", "hash", "n"])

    return docs.select("text").mapInArrow(run, "size int, hash long, n long").groupBy("size", "hash").agg(F.sum("n").alias("n"))


def prefixes(known: DataFrame, docs: DataFrame, shingle: int) -> pa.Table:
    """(window, items, size, hash, position) of a block: each window's rarest shingle, the first of equally rare ones.

    Windows with a shingle that is in no document are in none and left out.
    """
    shingles = stored(window_shingles(known, shingle))
    seen = stored(rarity(docs, by_size(shingles.select("size", "hash").distinct().toArrow())))
    rarest = shingles.join(seen, ["size", "hash"], "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "position", "size", "hash")).alias("least")
    )
    return rarest.where("least.n > 0").join(known, "window").select("window", "items", "least.size", "least.hash", "least.position").toArrow()


class Prefix:
    """The windows of a block by the hash of their rarest shingle."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks().sort_by([("size", "ascending"), ("hash", "ascending")])
        self.wanted = by_size(table)
        self.size, self.hash = table.column("size").to_numpy(), table.column("hash").to_numpy()
        self.position, self.window, self.items = table.column("position").to_numpy(), table.column("window"), table.column("items")
        self.first = {s: int(np.searchsorted(self.size, s)) for s in self.wanted}
        self.last = {s: int(np.searchsorted(self.size, s, side="right")) for s in self.wanted}

    def rows(self, size: int, value: int) -> range:
        """The rows of the windows whose rarest shingle this is."""
        a, b = self.first[size], self.last[size]
        value = value - 2**64 if value >= 2**63 else value  # as Spark holds it
        return range(*(a + int(np.searchsorted(self.hash[a:b], value, side=side)) for side in ("left", "right")))


def locate(table: pa.Table) -> Callable:
    """The task that adds a block's occurrences to the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = Prefix(table)
        for batch in batches:
            for rows, ends, words, found in hits(batch, prefix.wanted):
                yield with_found(rows, ends, occurrences(ends, words, found, prefix), prefix)

    return run


def occurrences(ends, words, found, prefix: Prefix) -> dict[int, dict[int, list[tuple[int, int]]]]:
    """By document and start: (row, words) of the windows that are there word for word."""
    out: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for size, at, values in found:
        owner = np.searchsorted(ends, at, side="right") - 1
        for p, d, h in zip(at.tolist(), owner.tolist(), values.tolist()):
            for row in prefix.rows(size, h):
                window = prefix.window[row].as_py().split(" ")
                start = p - int(prefix.position[row])
                if start < ends[d] or start + len(window) > ends[d + 1]:
                    continue
                if words.slice(start, len(window)).to_pylist() == window:
                    out[d][start - int(ends[d])].append((row, len(window)))
    return out


def with_found(rows, ends, places, prefix: Prefix) -> pa.RecordBatch:
    """The rows with what was found added to what they had."""
    n, spans, names = np.diff(ends).tolist(), rows.column("spans").to_pylist(), rows.column("items").to_pylist()
    for d, here in places.items():
        spans[d] = spans[d] + [{"start": s, "length": size} for s, ws in here.items() for _, size in ws]
        names[d] = sorted({*names[d], *(i for row in {row for ws in here.values() for row, _ in ws} for i in prefix.items[row].as_py())})
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    new = {"n_words": pa.array(n, pa.int64()), "spans": pa.array(spans, span), "items": pa.array(names, pa.list_(pa.string()))}
    kept = [c for c in rows.schema.names if c not in new]
    return pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + list(new.values()), names=kept + list(new))


def blocks(items: DataFrame, window: int, block_rows: int, block_bytes: int) -> list[DataFrame]:
    """(window, items) of all distinct windows, in blocks of about so many rows and bytes; one block at least."""
    sized = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    pairs = stored(item_windows(sized.distinct(), window))
    size = F.sum(F.octet_length("window") + F.octet_length("item_id"))
    rows, total = pairs.agg(F.count(F.lit(1)), size).first()
    n = max(1, -(-rows // block_rows), -(-(total or 0) // block_bytes))
    known = pairs.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    known = stored(known.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n))))
    return [known.where(F.col("block") == i).drop("block") for i in range(n)]


def contained_items(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The documents with n_words, the spans of words where item windows occur, and the items' ids.

    A null item id is the string "null". Columns of the documents called like a new one are replaced.
    """
    new = {"n_words": F.lit(0).cast("long"), "spans": F.expr("cast(array() as array<struct<start: long, length: long>>)"), "items": F.expr("cast(array() as array<string>)")}
    own = docs.drop(*new)
    rest = neutral(own)
    schema = StructType(rest.schema.fields + StructType.fromDDL(FOUND).fields)
    out = rest.withColumns(new)
    for i, known in enumerate(blocks(items, window, block_rows, block_bytes)):
        out = stored(out) if i else out  # one block in the tasks at a time
        out = out.select(*rest.columns, *new).mapInArrow(locate(prefixes(known, docs, shingle)), schema)
    return out.toDF(*own.columns, *new)


def n_hit(found: DataFrame) -> DataFrame:
    """The documents with the count of words that lie in a span."""
    ends = F.array_sort("spans")
    last = F.aggregate(
        ends,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    return found.withColumn("n_hit", last)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = n_hit(contained_items(docs.select("doc_id", "text"), items))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@keeps_columns
def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any item window, with all their columns."""
    return contained_items(docs, items).where(F.size("spans") == 0).select(*docs.columns)
