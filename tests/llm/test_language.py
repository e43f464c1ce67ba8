"""Language by cross-parsing against a plain search for the longest match, and held-out rows."""

from zlib import crc32

import brute
import numpy as np
import pyarrow as pa
from conftest import DATA
from hypothesis import given as any_of
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.llm import language, queries

SAMPLES = [b"abracadabra ", b"bananas and more ", "é ünï".encode()]


@settings(max_examples=200, deadline=None)
@any_of(st.lists(st.text("abcdnr é.Z", max_size=60), max_size=5))
def test_phrases(texts):
    ends, data = language.letters(pa.array(texts, pa.large_string()))
    assert [data[a:b].tobytes() for a, b in zip(ends, ends[1:])] == [brute.folded(t) for t in texts]
    got = language.Parser(SAMPLES).phrases(ends, data)
    assert got.tolist() == [[brute.phrases(brute.folded(t), s, language.STRETCH) for s in SAMPLES] for t in texts]


def test_long_texts_are_parsed_whole():
    text = "abra bananas " * 2000
    ends, data = language.letters(pa.array(["", text, None], pa.large_string()))
    got = language.Parser(SAMPLES).phrases(ends, data)
    assert got[1].tolist() == [brute.phrases(brute.folded(text), s, language.STRETCH) for s in SAMPLES]
    assert not got[[0, 2]].any()


def test_operator_against_plain_parsing(given):
    rows, df = given
    samples = language.labelled_samples(df)
    names = sorted(samples)
    short = [(d, t) for d, t in rows if len(t or "") < 1500][:40]
    got = {r["doc_id"]: r for r in language.languages(df).collect()}
    assert len(got) == len(rows)
    for d, t in short:
        data = brute.folded(t)
        cost = [brute.phrases(data, samples[x], language.STRETCH) * np.log2(len(samples[x])) / max(1, len(data)) for x in names]
        assert got[d]["held_out"] == (crc32(str(d).encode()) % 3 == 1)
        if any(c.isalpha() for c in t or ""):
            assert got[d]["lang_pred"] == names[int(np.argmin(cost))]
            assert abs(got[d]["score"] - (1 - sorted(cost)[0] / sorted(cost)[1])) < 1e-9


def test_held_out_accuracy(spark):
    got = queries.op13_language(spark, DATA)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark, docs, awkward, empty):
    got = language.languages(docs).collect()
    assert sorted(map(repr, (r["doc_id"] for r in got))) == sorted(repr(d) for d, _ in awkward)
    for r in got:
        if r["doc_id"] in (1, 2, 3, 15):  # null, empty, white space, digits
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] == 20:  # one language was learned
            assert (r["lang_pred"], r["score"]) == ("en", 1.0)
    assert language.languages(empty).isEmpty()
    unlabelled = language.languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unlabelled.collect()} == {("und", 0.0)}


def test_only_learned_labels_matter(given):
    _, df = given
    learned = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    other = df.withColumn("lang", F.when(learned, F.col("lang")).otherwise("xx"))
    assert language.labelled_samples(other) == language.labelled_samples(df)


def test_sample_is_bounded(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("wort "), F.repeat(F.col("id").cast("string"), 900), F.lit(" ende")).alias("text"), F.lit("de").alias("lang"))
    (sample,) = language.labelled_samples(rows.union(rows)).values()
    assert 0 < len(sample) <= language.SAMPLE_TEXTS * (language.SAMPLE_CHARS * 4 + 1)
