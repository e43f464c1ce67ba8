"""A third of all rows equal, benchmarks with repeated and long items, and counts of very many rows."""

import time

import brute
import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from shelfline.llm import decontamination, exact, sharding, simhash


@pytest.fixture(scope="module")
def hot(spark):
    """4000 equal rows, 4000 rows of one text with ids of their own, 4000 others."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one row").when(F.col("id") % 3 == 1, "one  text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
        F.lit("x").alias("_key"),
    )
    return rows.repartition(6)


def test_exact_copies_of_a_hot_row(hot):
    got = exact.exact_dedup(hot)
    by = {(r["group_size"], r["kept"]): r["n"] for r in got.groupBy("group_size", "kept").agg(F.count("*").alias("n")).collect()}
    assert by == {(4000, True): 2, (4000, False): 7998, (1, True): 4000}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan


@pytest.mark.parametrize("keep,left", [(exact.keep_one, 4002), (simhash.keep_one, None)])
def test_filters_combine_hot_rows_before_they_move(hot, keep, left):
    kept = keep(hot)
    assert kept.columns == hot.columns
    assert left is None or kept.count() == left
    assert kept.groupBy("doc_id", "text").count().where("count > 1").isEmpty()
    assert kept.where("doc_id = 7").count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_blocks_of_windows_give_the_same(spark, awkward, docs):
    text = dict(awkward)
    items = [(str(i), text[5][20 + i : 200 + i]) for i in range(0, 60, 7)] + [("long", text[20][:4000]), ("other", "w1 w2"), (None, None)]
    items += [("same", text[20][300:700])] * 40
    frame = spark.createDataFrame(items, "item_id string, text string")
    want = sorted(brute.contamination(awkward, items), key=repr)
    assert rows_of(decontamination.contamination(docs, frame)) == want
    found = decontamination.contained_items(docs.select("doc_id", "text"), frame, block_rows=300)
    assert sorted((r["doc_id"], r["n_words"], len(r["items"])) for r in found.collect() if r["doc_id"] is not None) == sorted((r[0], r[1], r[3]) for r in want if r[0] is not None)


def test_blocks_are_bounded(spark):
    items = spark.range(50).select(F.col("id").cast("string").alias("item_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(400)), lambda i: i + F.col("id") * 1000)).alias("text"))
    whole = items.unionAll(spark.createDataFrame([("x", " ".join(map(str, range(20_000))))], items.schema))
    parts = decontamination.blocks(whole.unionAll(whole), 10, 4000, 1 << 30)
    sizes = [p.count() for p in parts]
    assert len(parts) == -(-sum(sizes) // 4000) or len(parts) == -(-(50 * 392 + 19_991) // 4000)
    assert max(sizes) < 4600


def test_a_matrix_for_ten_billion_rows_takes_seconds():
    start = time.time()
    matrix = np.array(sharding.communication_matrix([10**8] * 100, sharding.split_evenly(10**10, 40), 1))
    assert time.time() - start < 30
    assert (matrix.sum(axis=1) == 10**8).all() and (matrix.sum(axis=0) == 10**10 // 40).all()
    assert abs(matrix / (10**8 / 40) - 1).max() < 0.01
