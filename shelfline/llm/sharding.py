"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of each source partition go to each shard is drawn first, with the distribution that a
uniform permutation of all rows would give it. Rows are then permuted within their source, cut by
the drawn counts, exchanged by range of shard and a random number, and numbered in that order, which
permutes each shard again over as many tasks as it needs. DataFrame functions only; the driver
draws a count for each source and shard, at most SOURCES times the shards, however many rows there are.

Null ids and texts are rows like others (a null text has no bytes). Very long texts do not enter:
rows are shuffled as they are given. Equal rows are interchangeable, which is the only tie. Columns
called like the new ones are replaced, others may have any name. An empty table has an empty result;
a shard may be empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.store import numbered, pieces, stored

#: Rows that one task permutes after the exchange, about.
PART_ROWS = 2_000_000
#: Source partitions are merged to so many at most, which bounds the matrix.
SOURCES = 1000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` rows, taken from good + bad without replacement, are good."""
    low, high = max(0, draws - bad), min(good, draws)
    total = good + bad
    if low == high:
        return low
    mean = draws * good / total
    spread = 12 * (draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1)) ** 0.5 + 12
    low, high = max(low, int(mean - spread)), min(high, int(mean + spread) + 1)
    k = np.arange(low, high, dtype=np.float64)
    step = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.r_[0.0, np.cumsum(step)]
    weight = np.exp(weight - weight.max())
    return low + int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right"))


def communication_matrix(sources: list[int], targets: list[int], seed: int) -> list[list[int]]:
    """Row counts by source and target; rows sum to the sources, columns to the targets."""
    rng, left, out = np.random.default_rng(seed), list(targets), []
    for n in sources:
        row, rest = [], sum(left)
        for have in left:
            row.append(hypergeometric(rng, have, rest - have, n))
            rest, n = rest - have, n - row[-1]
        left = [a - b for a, b in zip(left, row)]
        out.append(row)
    return out


def split_evenly(n: int, parts: int) -> list[int]:
    return [n // parts + (i < n % parts) for i in range(parts)]


def random_order(columns: list[str], seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *columns), *[F.col(c) for c in columns]]


def uniform_shards(rows: DataFrame, shards: int, seed: int = 42, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows with their shard and slot: counts differ by one at most, slots have no gaps.

    Columns of the rows called like these two are replaced.
    """
    own = rows.drop("shard", "slot")
    rows = own.toDF(*[f"_column{i}" for i in range(len(own.columns))])
    spark, columns = rows.sparkSession, rows.columns
    placed = stored(rows.withColumn("_source", F.pmod(F.spark_partition_id(), F.lit(SOURCES))))
    counts = sorted((r["_source"], r["count"]) for r in placed.groupBy("_source").count().collect())
    sizes = split_evenly(sum(n for _, n in counts), shards)
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    drawn = spark.createDataFrame([(source, np.cumsum(row).tolist()) for (source, _), row in zip(counts, matrix)], "_source int, _ends array<long>")
    local = W.partitionBy("_source").orderBy(*random_order(columns, seed))
    cut = placed.withColumn("_rank", (F.row_number().over(local) - 1).cast("long")).join(drawn, "_source")
    cut = cut.withColumn("shard", F.size(F.filter("_ends", lambda end: end <= F.col("_rank")))).select(*columns, "shard")
    again = numbered(cut, "shard", random_order(columns, seed + 1)[:1], pieces(sum(sizes), part_rows))
    return again.select(*columns, "shard", F.col("pos").alias("slot")).toDF(*own.columns, "shard", "slot")
