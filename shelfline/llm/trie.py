"""The trie of all prefixes of conversations, by van Emde Boas recursion on the depth.

A sequence of turns ends with a closing mark, so where it ends is a place in the trie too. Sequences
are cut in blocks of 1, 2, 4 ... turns, each named by the digest of its halves. From the whole
height down, a segment of the trie is cut at half depth: pieces that start alike share their upper
half, which becomes one piece of the upper trie; the prefix up to the cut gets the smallest id of
its members as its name, and names the root of a lower forest, in which the other halves go on.
All segments of one height are cut by the same few joins, in parallel; after log2(depth) rounds a
piece is a single turn below a named root, hence a node and its parent.

Totals go upward by the same cuts. What lies below a cut in its own segment is summed for all cuts
at once; then, from the highest cuts down, the totals of the nodes on which the next segments stand
are grafted on. A cut at depth d closes the segment of the largest power of two that divides d, so
a node is handled once, in one of log2(depth) rounds, and no ancestor lists are formed.

Nothing is gathered by conversation, prefix or node: a conversation may hold a third of all turns
(its blocks are rows of their own, and turns are numbered by range, see `numbered`), a prefix or a
sequence a third of all conversations (sums are pre-aggregated, joins have a unique side and tables
on both sides, so that Spark can split a hot key). Only a digest over a node's ids in order is a
stream through one task, in constant memory, as SHA-256 takes its input one after another.

A null role or text counts as empty; null turns come first. Turns of one conversation with equal
turn numbers go by role, then text, so repeated rows are turns of their own. Rows without a
conv_id are in no conversation and left out. Very long texts only enter digests and lengths. An
empty table has no nodes, not even a root. Other columns are left out, so that no name clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.store import numbered, stored

#: The closing mark; other names are digests with a length.
CLOSE = "close"
NODE = ["conv_id", "depth"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, item: the turns in order, each named by a digest of role and text and its bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), "turn", role, text)
    rows = numbered(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return rows.select("conv_id", "pos", F.concat_ws(":", F.octet_length("text").cast("string"), said).alias("item"))


def closed(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The turns with the closing mark after the last, also for members without any turn."""
    last = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("pos"))
    marks = last.unionByName(members.select("conv_id", F.lit(0).cast("long").alias("pos"))).groupBy("conv_id").agg(F.max("pos").alias("pos"))
    return turns.unionByName(marks.withColumn("item", F.lit(CLOSE)))


def blocks_of(turns: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """For each level from 1: distinct blocks (name, left, right); and the whole block of each sequence."""
    rows, levels = turns.withColumnRenamed("item", "name"), []
    for _ in range(height):
        odd = F.col("pos") % 2 == 1
        halves = rows.groupBy("conv_id", F.shiftright("pos", 1).alias("half")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right")
        )
        named = stored(halves.select("conv_id", F.col("half").alias("pos"), F.sha2(F.concat_ws(",", "left", "right"), 256).alias("name"), "left", "right"))
        levels.append(stored(named.groupBy("name").agg(F.first("left").alias("left"), F.first("right").alias("right"))))
        rows = named.select("conv_id", "pos", "name")
    return levels, rows.select("conv_id", "name")


def descend(pieces: DataFrame, levels: list[DataFrame], height: int) -> DataFrame:
    """The pieces of one item each: root, segment (the position), name, n, first, and roots.

    roots has the name of the root of the piece's segment of each height, from the highest.
    """
    for level in range(height, 0, -1):
        halves = stored(pieces.join(levels[level - 1], "name").withColumn("segment", F.col("segment") * 2))
        start = ["root", "segment", "left"]
        upper = stored(halves.groupBy(start).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.first("roots").alias("roots")))
        lower = halves.where(F.col("right").isNotNull()).join(upper.select(*start, F.col("first").alias("cut")), start)
        pieces = upper.select("root", "segment", F.col("left").alias("name"), "n", "first", F.concat("roots", F.array("root")).alias("roots")).unionByName(
            lower.select(F.col("cut").alias("root"), F.col("segment") + 1, F.col("right").alias("name"), "n", "first", F.concat("roots", F.array("cut")).alias("roots"))
            .toDF("root", "segment", "name", "n", "first", "roots")
        )  # lower pieces differ in root or name, as a root and its two halves name the whole piece
        pieces = stored(pieces)
    return pieces


def grafted(nodes: DataFrame, height: int) -> DataFrame:
    """conv_id, depth, below_leaves and below_saved of each node: the totals of all nodes under it."""
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    place = F.col("depth") - 1
    # A level counts where its root's depth ends with the level's bit: there the root closes a segment of that height.
    levels = F.filter(F.sequence(F.lit(0), F.lit(height)), lambda j: (F.call_function("shiftright", place, j) % 2 == 1) | (j == height))
    each = nodes.where("depth > 0").select("leaves", "saved", "roots", "depth", F.explode(levels).alias("level"))
    root_depth = F.call_function("shiftleft", F.call_function("shiftright", place, F.col("level")), F.col("level"))
    own = each.select(F.get("roots", F.lit(height) - F.col("level")).alias("conv_id"), root_depth.alias("depth"), "leaves", "saved")
    own = stored(own.groupBy(NODE).agg(*sums))
    done = own.where("depth = 0").select(*NODE, "leaves", "saved", F.array().cast("array<bigint>").alias("roots"))
    for level in range(height - 1, -1, -1):
        bit = 1 << level
        on = done.where(F.col("depth") > 0).select(F.get("roots", F.lit(height - level)).alias("conv_id"), F.col("depth") - bit, "leaves", "saved").toDF(*NODE, "leaves", "saved")
        here = (F.col("depth") % (2 * bit)) == bit
        rows = nodes.where(here).select(*NODE, F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "roots")
        rows = rows.unionByName(own.where(here).unionByName(on.where(here)).withColumn("roots", F.lit(None).cast("array<bigint>")))
        done = done.unionByName(stored(rows.groupBy(NODE).agg(*sums, F.max("roots").alias("roots"))))
    return done.select(*NODE, F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))


def id_digests(ends: DataFrame) -> DataFrame:
    """By node: the SHA-256 of the ids that end there, ascending and joined by commas.

    Sorted rows stream through a running digest; a task holds a batch and one digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            conv, depth = (batch.column(c).to_numpy(zero_copy_only=False) for c in NODE)
            cut = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])]) if len(conv) else np.zeros(0, np.int64)
            ids = batch.column("id").cast(pa.string())
            for a, b in zip(cut, [*cut[1:], len(conv)]):
                if node != (conv[a], depth[a]):
                    out += [(*node, digest.hexdigest())] if node else []
                    node, digest = (conv[a], depth[a]), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(ids.slice(a, b - a).to_pylist()).encode())
            yield table(out)
        yield table([(*node, digest.hexdigest())] if node else [])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 3
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[*NODE, "ends_sha256"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ends.repartition(parts, *NODE).sortWithinPartitions(*NODE, "id").mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for every distinct prefix of the members' sequences, the empty one included.

    turns: conv_id, pos (gapless from 0) and item (`<bytes>:<digest>`, see `turns_of`); members: all
    conv_id once each, also those without turns.
    """
    spark = turns.sparkSession
    items = stored(closed(turns, members))
    longest, first, n = items.agg(F.max("pos"), F.min("conv_id"), F.count_if(F.col("item") == CLOSE)).first()
    if longest is None:
        kinds = "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
        return spark.createDataFrame([], f"conv_id long, depth long, {kinds}, ends_sha256 string")
    height = int(longest).bit_length()
    levels, wholes = blocks_of(items, height)
    wholes = stored(wholes)
    zero = F.lit(0).cast("long")
    whole = wholes.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    whole = stored(whole.select(F.lit(first).cast("long").alias("root"), zero.alias("segment"), "name", "n", "first", F.array(F.lit(first).cast("long")).alias("roots")))
    pieces = descend(whole, levels, height)
    is_end = F.col("name") == CLOSE

    # Nodes, and for each an entry for every child.
    turn = pieces.where(~is_end)
    rows = turn.select(
        F.col("first").alias("conv_id"), (F.col("segment") + 1).alias("depth"), F.col("root").alias("parent_conv_id"), "n", F.split_part("name", F.lit(":"), F.lit(1)).cast("long").alias("bytes"), "roots", zero.alias("children")
    )
    root = spark.createDataFrame([(first, 0, None, n, 0, [], 0)], "conv_id long, depth long, parent_conv_id long, n long, bytes long, roots array<bigint>, children long")
    null = lambda kind: F.lit(None).cast(kind)
    child = turn.select(F.col("root").alias("conv_id"), F.col("segment").alias("depth"), null("long").alias("parent_conv_id"), zero.alias("n"), zero.alias("bytes"), null("array<bigint>").alias("roots"), F.lit(1).cast("long").alias("children"))
    every = reduce(DataFrame.unionByName, [rows, root, child])
    nodes = every.groupBy(NODE).agg(*[F.max(c).alias(c) for c in ("parent_conv_id", "n", "bytes", "roots")], F.sum("children").alias("n_children"))
    nodes = stored(nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n") - 1) * F.col("bytes")}))

    # The closing mark's smallest member is that of its sequence, whose whole block has the members.
    close = pieces.where(is_end).select("first", F.col("root").alias("node"), F.col("segment").alias("depth"))
    ended = stored(whole.select("name", "first").join(close, "first"))
    ends = wholes.join(ended, "name").select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("id"))

    out = nodes.join(grafted(nodes, height), NODE, "left").join(id_digests(ends), NODE, "left")
    below = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        *NODE, "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        (F.col("leaves") + below("below_leaves")).alias("n_leaves"),
        (F.col("saved") + below("below_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
