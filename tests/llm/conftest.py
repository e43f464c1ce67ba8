import random

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text) rows: nulls, empty and very long texts, ties, repeated rows, odd characters."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ßx", "日本", "Ünï"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, other, base = say(60), say(25), say(400)
    rows = [
        (1, None), (2, ""), (3, "  \n\t "), (None, say(50)), (None, passage + " " + say(5)), (4, say(30) + " " + passage),
        (5, passage + " " + say(30)), (6, passage[:80] + " " + say(20)), (7, " ".join(["la"] * 500)), (8, "la " * 60 + other),
        (9, other + "\n" + other + " " + say(3) + " " + other), (10, base), (11, base.replace(" ", "  ")), (12, base + " end"),
        (13, base), (13, base), (14, "x" * 20000), (15, "1" * 6000), (16, "a." * 3000 + "@b.c"), (17, "word"), (18, "word"),
        (19, "\x1cword  <|endoftext|>  x"), (20, say(30000)), (21, " ".join(say(40).split()[::-1])), (-5, passage),
        (22, "mail a@b.co_c@d.ef a.b@c-d.e..f, ip 1.2.3.4.5.6.7.8 300.1.1.1 007.1.2.3 card 4111 1111-1111 1111 4111111111111112 tel +1 (212) 555-0100 +12 +1(((("),
        (23, "10.0.0.1 0.0.0.0 000.255.0.010 256.0.0.1 1.2.3.1000 255.255.255.0."),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, awkward):
    """The same rows with columns whose names clash with the operators' own."""
    extra = "lang string, source string, n_chars long, shard int, _row string, spans string, n long, "
    extra += "_key string, _copy int, _n_words int, n_words int, _email int, base int, slot int, _source int, `a.b` int"
    rows = [(d, t, "en" if i % 2 else None, None, i, i, "x", None, 7, "k", *[i] * 8) for i, (d, t) in enumerate(awkward)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="session")
def given(spark):
    """(doc_id, text) of all documents of the smallest scale, and their frame."""
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    return [tuple(r) for r in df.select("doc_id", "text").collect()], df
