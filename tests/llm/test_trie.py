"""The conversation trie against a dictionary of all prefixes."""

import random

import brute
import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from shelfline.llm import queries, trie
from shelfline.llm.store import stored

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(conversations):
    return trie.prefix_trie(*queries.rebuilt(stored(trie.turns_of(conversations))))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_prefix_trie(spark, DATA)
    assert got.columns == COLUMNS
    assert rows_of(got) == sorted(brute.trie(rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_awkward_conversations(spark, seed):
    """Nulls, ties, repeated rows, gaps in ids, negative ids, one to forty turns, few distinct turns."""
    rng, rows = random.Random(seed), []
    for c in [*range(-12, 30), 1000, None]:
        for i in range(rng.choice([0, 1, 2, 3, 9, 20, 40])):
            rows += [(c, rng.choice([None, i // 2, i]), rng.choice([None, "u", "a"]), rng.choice([None, "", "x", "é", str(rng.randrange(3))]))] * rng.choice([1, 1, 2])
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", pos int, item string").repartition(5)
    assert rows_of(built(df)) == sorted(brute.trie(rows), key=repr)


def test_hot_conversation_and_hot_copies(spark):
    """One conversation with a third of all turns, one sequence with a third of all conversations."""
    rows = [(5, i, "u", str(i % 7)) for i in range(3000)]
    rows += [(10 * k, i, "u", "same " * (i + 1)) for k in range(1, 500) for i in range(3)]
    assert rows_of(built(spark.createDataFrame(rows, SCHEMA))) == sorted(brute.trie(rows), key=repr)


def test_without_rows_or_turns(spark):
    empty = built(spark.createDataFrame([], SCHEMA))
    assert (empty.columns, empty.count()) == (COLUMNS, 0)
    own = [(c, 0, "u", "x") for c in (1, 2, 3)]  # their first turns go, and conversation 0 is absent
    rows = [r for r in own if brute.zlib.crc32(str(r[0]).encode()) % 9]
    assert rows
    got = rows_of(built(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted(brute.trie(rows), key=repr) and len(got) == 1


def test_numbers_by_range(spark):
    rows = spark.range(5000).select((F.col("id") % 3 * F.col("id")).alias("k"), (F.col("id") * 7919 % 101).alias("v"))
    rows = rows.withColumn("k", F.when(F.col("v") < 60, 1).otherwise(F.col("k") % 5))
    got = trie.numbered(rows, "k", [F.col("v")]).collect()
    for k in {r["k"] for r in got}:
        own = sorted((r["pos"], r["v"]) for r in got if r["k"] == k)
        assert [p for p, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for _, v in own)
