"""Exact duplicates by a minimal perfect hash over the distinct digests seen before.

The store of earlier documents has a row for each bucket of digests: bit arrays by level, which
give each stored digest a slot of its own without gaps, and in the slots the full digests with
their winner (its doc_id and its length) and group size. A lookup computes the slot and compares
all 32 bytes, so digests that were never stored are told apart and grouped on their own.

A null text counts as empty. A null doc_id loses every tie. Rows that are equal in doc_id and text
are copies like any others: one of them stays. Very long texts only enter digests. A text or row
that is a third of all is combined before it is shuffled. Only doc_id and text are read, and
`keep_one` returns the other columns whatever they are called. An empty table has an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.store import keeps_columns, one_of_each, pieces, stored
from shelfline.llm.texts import mixed

#: Digests in one bucket, about.
BUCKET_ROWS = 50_000
#: Bits for each digest still without a slot, at every level.
SPARE = 2
WHITE_SPACE = " \t\n\x0b\x0c\r"
GROUP = "digest binary, keep_id long, keep_chars int, n long"
STORE = "bucket int, levels array<binary>, digests binary, keep_id array<long>, keep_chars array<int>, n array<long>"


def text_digest():
    """SHA-256, as hex, of the text without ASCII white space."""
    return F.sha2(F.translate(F.coalesce("text", F.lit("")), WHITE_SPACE, ""), 256)


def with_digest(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text without ASCII white space, code points of the whole text."""
    chars = F.length(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.unhex(text_digest()).alias("digest"), chars.alias("chars"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row for each digest: its winner and how many rows it has; combined before the shuffle."""
    best = F.max(F.struct("chars", F.bitwise_not(F.col("doc_id").cast("long")).alias("less")))  # smaller ids are greater
    return rows.groupBy("digest").agg(best.alias("best"), F.sum("copies").alias("n")).select(
        "digest", F.bitwise_not("best.less").alias("keep_id"), F.col("best.chars").alias("keep_chars"), "n"
    )


def level_hash(lanes: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(lanes[:, level % 4] + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))


def build_levels(lanes: np.ndarray) -> list[np.ndarray]:
    """Bit arrays: a digest that is alone at its place in a level stays there, the rest go on."""
    levels = []
    while len(lanes):
        size = SPARE * len(lanes) + 1
        at = (level_hash(lanes, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        lanes = lanes[~alone[at]]
    return levels


def slots_of(levels: list[np.ndarray], lanes: np.ndarray) -> np.ndarray:
    """The slot of each digest; for one that was never stored any slot, or -1."""
    slot, open_, before = np.full(len(lanes), -1, np.int64), np.arange(len(lanes)), 0
    for level, bits in enumerate(levels):
        at = (level_hash(lanes[open_], level) % np.uint64(len(bits))).astype(np.int64)
        rank, here = np.cumsum(bits) - 1 + before, bits[at]
        slot[open_[here]] = rank[at[here]]
        open_, before = open_[~here], before + int(bits.sum())
    return slot


def lanes_of(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, np.uint64).reshape(-1, 4)


def packed(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def build_bucket(rows: pa.Table) -> pa.Table:
    digests = packed(rows.column("digest"))
    lanes = lanes_of(digests)
    levels = build_levels(lanes)
    order = np.argsort(slots_of(levels, lanes))
    rows = rows.take(pa.array(order))
    one = {
        "bucket": [rows.column("bucket")[0].as_py()],
        "levels": [[len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in levels]],
        "digests": [packed(rows.column("digest"))],
    } | {k: [rows.column(k).to_pylist()] for k in ("keep_id", "keep_chars", "n")}
    types = [pa.int32(), pa.list_(pa.binary()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(one.items(), types)})


def build_store(groups: DataFrame, buckets: int) -> DataFrame:
    """The store of these distinct digests, one row for each bucket."""
    return groups.withColumn("bucket", bucket_of(buckets)).groupBy("bucket").applyInArrow(build_bucket, STORE)


def look_up(groups: pa.Table, store: pa.Table) -> pa.Table:
    """All digests of the bucket with their winners: stored ones, those met again, and new ones."""
    out = {"digest": [], "keep_id": [], "keep_chars": [], "n": [], "stored": [], "met": []}
    new = groups.select(["digest", "keep_id", "keep_chars", "n"]).to_pylist()
    if store.num_rows:
        old = store.slice(0, 1).to_pylist()[0]
        digests = old["digests"]
        slots = [dict(digest=digests[32 * i : 32 * i + 32], keep_id=a, keep_chars=b, n=c, stored=True, met=False) for i, (a, b, c) in enumerate(zip(old["keep_id"], old["keep_chars"], old["n"]))]
        levels = [np.unpackbits(np.frombuffer(x[8:], np.uint8), count=int.from_bytes(x[:8], "little")).astype(bool) for x in old["levels"]]
        at = slots_of(levels, lanes_of(b"".join(x["digest"] for x in new))) if new else []
        strangers = []
        for i, x in zip(at, new):
            if i >= 0 and slots[i]["digest"] == x["digest"]:
                y = slots[i]
                y["met"], y["n"] = True, y["n"] + x["n"]
                y["keep_chars"], y["keep_id"] = max((y["keep_chars"], y["keep_id"]), (x["keep_chars"], x["keep_id"]), key=winner)
            else:
                strangers.append(x)
        new = strangers
    else:
        slots = []
    rows = slots + [x | {"stored": False, "met": True} for x in new]
    for k in out:
        out[k] = [x[k] for x in rows]
    types = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})


def winner(x: tuple) -> tuple:
    chars, doc_id = x
    return chars, doc_id is not None, -(doc_id or 0)


def resolve(groups: DataFrame, store: DataFrame, buckets: int) -> DataFrame:
    """The digests of `groups` looked up in the store: one row for each digest of either side."""
    keyed = groups.withColumn("bucket", bucket_of(buckets))
    return keyed.groupBy("bucket").cogroup(store.groupBy("bucket")).applyInArrow(look_up, GROUP + ", stored boolean, met boolean")


def exact_groups(docs: DataFrame, history: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): doc_id, digest, chars and place of every document, and one row for each digest.

    history: earlier documents, whose digests fill the store; without it, the store is filled from
    the half of the documents whose hashed ids are even, and the other half is looked up. A place is
    a number of the row's own.
    """
    rows = stored(with_digest(docs).withColumn("place", F.monotonically_increasing_id()))
    if history is None:
        every = rows.withColumn("early", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    else:
        before = with_digest(history).withColumn("early", F.lit(True))
        every = before.unionAll(rows.drop("place").withColumn("early", F.lit(False)))
    distinct = stored(every.groupBy("doc_id", "digest", "chars", "early").agg(F.count("*").alias("copies")))
    buckets = pieces(distinct.count(), bucket_rows)
    store = stored(build_store(grouped(distinct.where("early")), buckets))
    return rows, stored(resolve(grouped(distinct.where("not early")), store, buckets))


def exact_dedup(docs: DataFrame, history: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256.

    With a history, keep_id may be one of its documents; one that comes again with the same doc_id
    and text counts as itself.
    """
    rows, groups = exact_groups(docs, history, bucket_rows)
    # The first place of the rows that are the winner; a hot row is one row before the shuffle.
    named = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("unnamed"), "chars"]
    first = rows.select("digest", *named, "place").groupBy("digest", "id", "unnamed", "chars").agg(F.min("place").alias("first"))
    winner_of = [F.coalesce("keep_id", F.lit(0)).alias("id"), F.col("keep_id").isNull().alias("unnamed"), F.col("keep_chars").alias("chars")]
    keys = ["digest", "id", "unnamed", "chars"]
    keepers = groups.select("digest", *winner_of, "keep_id", F.col("n").alias("group_size")).join(first, keys, "left")
    keepers = stored(keepers.select("digest", "keep_id", "group_size", "first"))  # a plain table, so that a hot digest can be split
    return rows.join(keepers, "digest").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("place") == F.col("first"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


@keeps_columns
def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of rows that share text and id, the longest."""
    _, groups = exact_groups(docs)
    key = lambda digest, doc_id: F.concat_ws(":", digest, doc_id.cast("string"))
    stays = groups.select(key(F.lower(F.hex("digest")), F.col("keep_id")).alias("_key"))
    longest = F.length(F.coalesce("text", F.lit("")))
    return one_of_each(docs.withColumn("_key", key(text_digest(), F.col("doc_id"))), longest).join(stays, "_key", "left_semi").select(docs.columns)
