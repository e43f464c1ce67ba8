"""Periodic runs against all periods tried one by one."""

import random

import brute
import numpy as np
from conftest import DATA, rows_of
from hypothesis import given as any_of
from hypothesis import settings
from hypothesis import strategies as st

from shelfline.llm import periods, queries


@settings(max_examples=300, deadline=None)
@any_of(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.integers(1, 9), st.integers(0, 50))
def test_runs_of_any_words(texts, period, n):
    rng = random.Random(period * 100 + n)
    repeated = [rng.randrange(3) for _ in range(period)]
    texts = [t[: len(t) // 2] + [repeated[i % period] for i in range(n)] + t[len(t) // 2 :] for t in texts]
    ends = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    got = periods.find_runs(ends, np.array([x for t in texts for x in t], np.int64))
    expected = [(int(a) + s, m, q) for a, t in zip(ends, texts) for s, m, q in brute.runs(t)]
    assert sorted(map(tuple, got.tolist())) == sorted(expected)


def test_operator(docs, awkward, empty):
    expected = []
    for d, t in awkward:
        w = brute.words(t)
        found = brute.runs(w) if len(w) < 5000 else []
        expected.append((d, len(w), [tuple(r) for r in found], brute.collapse(w, found)))
    got = [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in periods.periodic_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert any(r[2] for r in got)
    assert periods.periodic_runs(empty).isEmpty()


def test_a_very_long_text(spark):
    words = [str(i) for i in range(1000)] + ["a", "b", "c"] * 100_000 + ["x"] * 200_000
    row = periods.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1000, 300_000, 3), (301_000, 200_000, 1)]
    assert row["text"] == " ".join([*words[:1003], "x"])


def test_query(spark, given):
    rows, _ = given
    got = queries.op11_periodic_runs(spark, DATA)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = brute.periodic(rows)
    assert rows_of(got) == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > len(rows) / 30


def test_planted_repeats_of_awkward_rows(docs, awkward):
    made = {r[0]: r[1] for r in queries.with_repeats(docs).collect() if r[0] is not None}
    for d, t in awkward:
        if d is None or brute.zlib.crc32(str(d).encode()) % 10:
            assert d is None or made[d] == t or d == 13
        else:
            assert len(brute.words(made[d])) == len(brute.words(t))


def test_planted_repeats_of_texts_without_words(spark, tmp_path):
    ids = [i for i in range(400) if brute.zlib.crc32(str(i).encode()) % 10 == 0]
    texts = ["", None, "  \n ", "one", "a b", " x y z " * 50, "w " * 7]
    rows = [*zip(ids, texts), (None, "a a a a a a a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(queries.op11_periodic_runs(spark, str(tmp_path))) == sorted(brute.periodic(rows), key=repr)
