"""Every operator against plain loops, over awkward rows, given rows and an empty table."""

from collections import Counter
from zlib import crc32

import brute
import public_tokenizers
import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import decontamination, exact, packing, pii, quality, queries, sharding, simhash, tokens, toxicity
from shelfline.llm.substring import SubstringDedup


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)


def substring(docs):
    work = SubstringDedup(docs)
    out = work.result.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("h"))
    out = docs.sparkSession.createDataFrame(out.collect(), out.schema)
    work.drop()
    return out


def base_of(docs):
    return pii.report(docs, pii.Trees()).drop("spans")


BY_TEXT = {
    "substring": (substring, brute.substring),
    "pii": (base_of, brute.personal),
    "simhash": (simhash.near_duplicates, brute.simhash),
    "exact": (exact.exact_dedup, brute.exact),
}


@pytest.mark.parametrize("name", BY_TEXT)
def test_awkward_rows(name, docs, awkward):
    operator, plain = BY_TEXT[name]
    if name == "exact":  # which of equal rows stays can't be told from its columns
        got = sorted(map(tuple, operator(docs).collect()), key=repr)
        assert got == sorted(plain(awkward), key=repr)
    else:
        same(operator(docs), plain(awkward))


@pytest.mark.parametrize("name", BY_TEXT)
def test_given_rows(name, given):
    operator, plain = BY_TEXT[name]
    rows, df = given
    same(operator(df), plain(rows))


@pytest.mark.parametrize("name", BY_TEXT)
def test_empty_table(name, empty):
    assert BY_TEXT[name][0](empty).count() == 0


def test_contamination(spark, docs, awkward, given):
    text = dict(awkward)
    items = [(1, text[5][30:140]), (2, None), (3, ""), ("x", "w1 w2"), (4, text[5][30:140]), (None, "É"), (5, text[20][500:900]), (6, "zzz zzz")]
    items = [(None if i is None else str(i), t) for i, t in items]
    frame = spark.createDataFrame(items, "item_id string, text string")
    same(decontamination.contamination(docs, frame), brute.contamination(awkward, items))
    rows, df = given
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    plain = brute.contamination(rows, [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert any(r[-1] for r in plain)
    same(decontamination.contamination(df, bench), plain)
    in_blocks = decontamination.contained_items(df.select("doc_id", "text"), bench, block_bytes=1500)
    assert {r[0] for r in plain if r[-1]} == {r["doc_id"] for r in in_blocks.where(F.size("spans") > 0).collect()}
    assert decontamination.contamination(docs, frame.limit(0)).where("contaminated").isEmpty()
    assert decontamination.contamination(docs.limit(0), frame).isEmpty()
    left = decontamination.clean(docs, frame)
    assert left.columns == docs.columns
    assert left.count() == sum(not r[-1] for r in brute.contamination(awkward, items))


@pytest.mark.parametrize("file,collapse", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_token_counts(spark, docs, awkward, given, file, collapse):
    from shelfline.llm.store import shared_folder

    path, cache = public_tokenizers.path(file), shared_folder(spark)
    tokenizer = Tokenizer.from_file(path)
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    for rows, df in ((awkward, docs), given):
        want = [(d, len((t or "").encode()), n := count(t), n > 2048) for d, t in rows]
        same(tokens.token_counts(df, path, cache, collapse), want)
    stored = spark.read.parquet(cache)
    before = stored.count()
    assert before == stored.select("digest").distinct().count()
    same(tokens.token_counts(given[1], path, cache, collapse), want)  # now all are known
    assert spark.read.parquet(cache).count() == before
    assert tokens.token_counts(docs.limit(0), path, collapse=collapse).isEmpty()


def test_packing(docs, awkward, given):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    brute.packed_whole(packing.pack(docs, path).collect(), awkward, ids)
    assert brute.packed_whole(packing.pack(given[1], path, group_rows=70).collect(), given[0], ids) > 0.93
    assert packing.pack(docs.limit(0), path).isEmpty()


def test_first_fit_is_first_fit():
    import numpy as np

    sizes = np.random.default_rng(1).integers(1, 101, 500)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    free, want = [], {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        b = next((b for b, room in enumerate(free) if room >= sizes[i]), len(free))
        if b == len(free):
            free.append(100)
        want[i] = (b, 100 - free[b])
        free[b] -= int(sizes[i])
    assert [(b, o) for b, o in zip(bins.tolist(), offsets.tolist())] == [want[i] for i in range(500)]


def test_shards(docs, given):
    for rows in (docs, given[1].select("doc_id", "text").repartition(7)):
        n = rows.count()
        out = sharding.uniform_shards(rows, 6, part_rows=11).collect()
        assert sorted((r["doc_id"], r["text"]) for r in out if r["doc_id"] and r["text"]) == sorted((r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect() if r["doc_id"] and r["text"])
        assert set(sharding.uniform_shards(rows, 6).columns) == {*rows.columns, "shard", "slot"}
        by = [sorted(r["slot"] for r in out if r["shard"] == s) for s in range(6)]
        assert [len(x) for x in by] == sharding.split_evenly(n, 6)
        assert all(x == list(range(len(x))) for x in by)
    assert sharding.uniform_shards(docs.limit(0).select("doc_id"), 4).isEmpty()
    few = sharding.uniform_shards(docs.select("doc_id").limit(2), 4)
    assert sorted(r["shard"] for r in few.collect()) == [0, 1]


def test_shards_are_uniform(spark):
    """Each row is as often in each shard, whatever its source; the draws have the right spread."""
    import numpy as np

    rows, seen = spark.range(0, 40, 1, 4).withColumnRenamed("id", "doc_id"), np.zeros((40, 4))
    for seed in range(16):
        for r in sharding.uniform_shards(rows, 4, seed).collect():
            seen[r["doc_id"], r["shard"]] += 1
    assert abs(seen.sum(axis=0) - 160).max() == 0
    assert 60 < ((seen - 4) ** 2 / 4).sum() < 190  # chi-square, 120 degrees of freedom
    rng = np.random.default_rng(3)
    draws = np.array([sharding.hypergeometric(rng, 30, 70, 20) for _ in range(20000)])
    assert abs(draws.mean() - 6) < 0.06
    assert abs(draws.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.15
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0
    huge = sharding.hypergeometric(rng, 10**11, 10**12, 10**10)
    assert abs(huge / 10**10 - 1 / 11) < 1e-4


@pytest.mark.parametrize("operator,label,least,good", [(toxicity.toxicity, "toxic", 0.5, (0.97, 0.55)), (quality.quality, "quality", 0.3, (0.8, 0.95))])
def test_scores(spark, docs, operator, label, least, good):
    """On rows that no label was learned from; two fifths of these toxic labels are on plain texts."""
    sf = "/root/testdata/sf0.1"
    frame, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = operator(frame, labels)
    held = got.where("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    assert all((r["score"] >= least) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in held)
    right = [sum(r["predicted"] == y for r in held if r[label] == y) / sum(r[label] == y for r in held) for y in (0, 1)]
    assert right[0] > good[0] and right[1] > good[1], right
    known = operator(docs, labels.limit(0)).collect()
    assert len(known) == docs.count() and {r["score"] for r in known} == {0.5}
    only = labels.where(F.col(label) == 1)
    assert {r["predicted"] for r in operator(docs, only).collect()} == {1}
    assert operator(docs.limit(0), labels).isEmpty()
    nulls = labels.withColumn(label, F.when(F.col("doc_id") % 3 > 0, F.col(label)))
    assert operator(frame, nulls).count() == frame.count()


def test_repeated_ids_are_sampled_once(spark):
    """An id with a third of all rows, of many texts, is one row of the sample like any other."""
    from shelfline.llm import linear

    rows = [(i, f"text {i}") for i in range(200)] + [(next(i for i in range(200) if crc32(str(i).encode()) % 5), f"again {i % 7}") for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    texts, share = linear.sample(frame, labels, "toxic", 1000, 42)
    known = [i for i in range(200) if crc32(str(i).encode()) % 5]
    assert texts.count() == len(known) and share == {0: 1.0, 1: 1.0}
    assert rows_of(texts) == rows_of(linear.sample(frame.repartition(3), labels, "toxic", 1000, 42)[0])


def test_labels_of_held_out_rows_are_never_learned(spark):
    sf = "/root/testdata/sf0.01"
    frame, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    wrong = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    same(toxicity.toxicity(frame, wrong), [tuple(r) for r in toxicity.toxicity(frame, labels).collect()])


def test_history(spark):
    """Digests of earlier documents are recognised; equal slots of strangers are told apart."""
    old = spark.createDataFrame([(i, f"text {i}") for i in range(3000)] + [(9000, "te xt 7")], "doc_id long, text string")
    new = spark.createDataFrame([(5000 + i, f"text {i}") for i in range(0, 6000, 2)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in exact.exact_dedup(new, old, bucket_rows=500).collect()}
    assert len(got) == 3000
    assert all(got[5000 + i]["keep_id"] == i and not got[5000 + i]["kept"] and got[5000 + i]["group_size"] == 2 for i in range(0, 3000, 2))
    assert all(got[5000 + i]["kept"] and got[5000 + i]["group_size"] == 1 for i in range(3000, 6000, 2))


def test_slots_are_minimal_and_perfect():
    import numpy as np

    lanes = np.random.default_rng(0).integers(0, 2**63, (5000, 4)).astype(np.uint64)
    levels = exact.build_levels(lanes)
    assert sorted(exact.slots_of(levels, lanes)) == list(range(5000))


def test_large_postings_in_chunks(spark):
    """Postings cut into chunks give the same groups."""
    import numpy as np

    rng = np.random.default_rng(2)
    near = [int(2**40 * 77 + x) for x in rng.integers(0, 2**16, 400)] + [int(x) - 2**63 for x in rng.integers(0, 2**14, 100)]
    fps = spark.createDataFrame([(x,) for x in set(near)], "fp long")
    whole, cut = (simhash.components(simhash.links(fps, chunk=c)).collect() for c in (20_000, 60))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut))
    up = {x: x for x in near}
    for a in near:
        for b in near:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                old, new = sorted((up[a], up[b]), reverse=True)
                up.update({x: new for x, y in up.items() if y == old})
    assert {r["node"]: r["root"] for r in whole} == {x: y for x, y in up.items() if sum(z == y for z in up.values()) > 1}


def test_spans_are_added_not_lost(docs, given):
    trees = pii.train(given[1])
    assert pii.train(docs.limit(0)) == pii.Trees()
    for frame in (docs, given[1]):
        for r in pii.personal_data(frame, trees).select("base", "spans").collect():
            assert {tuple(x) for x in r["base"]} <= {tuple(x) for x in r["spans"]}
    lengths = given[1].select("doc_id", F.length("text").alias("a")).join(pii.redacted(given[1], trees).select("doc_id", F.length("text").alias("b")), "doc_id")
    assert lengths.where("a <> b").isEmpty()
    assert rows_of(pii.redacted(docs, trees).drop("text")) == rows_of(docs.drop("text"))


def test_rare_kinds_have_thresholds_beside_a_hot_source(spark):
    """Number lists give nearly all candidates; the few addresses are learned and calibrated all the same."""
    lists = [(i, "x" * (i % 97) + " 1234 5678 90" + " 11 22 33 44 " * (i % 3)) for i in range(3000)]
    mails = [(5000 + i, f"write to person{i}@site.example.com now") for i in range(9)]
    assert 0 in pii.train(spark.createDataFrame(lists + mails, "doc_id long, text string"), rows=80).least


def test_thresholds_hold_for_all_candidates(spark):
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    trees, seen = pii.train(frame, rows=80), pii.counted(frame)
    assert trees.least
    for kind, least in trees.least.items():
        above = seen.where((F.col("kind") == kind) & (trees.bin(F.struct(*pii.FEATURES)) >= least)).agg(F.sum("good"), F.sum("n")).first()
        assert above[0] >= pii.PRECISION * above[1]


def test_forms_that_only_the_wide_patterns_know_are_added(spark, given):
    planted = {
        9001: ("ask bob [at] site [dot] com soon", "bob [at] site [dot] com", 0),
        9002: ("ask ann(at)site.example.org", "ann(at)site.example.org", 0),
        9003: ("host 10-0-0-1 is up", "10-0-0-1", 1),
        9004: ("at 192_168_0_17:8080", "192_168_0_17", 1),
        9005: ("paid by 4111.1111.1111.1111 then", "4111.1111.1111.1111", 2),
        9006: ("ring (212) 555-0100 now", "(212) 555-0100", 3),
        9007: ("tel 212.555.0100", "212.555.0100", 3),
    }
    others = [
        (9101, "look (at) this or [at] that"), (9102, "10-0-0-999 and 12:30:45.123 and 1-2-3-4-5 and 10-0-0-1234"),
        (9103, "4111.1111.1111.1112 and 100 200 300 400"), (9104, "token 454724135 is c7b2767825212555010048d3ed7"),
    ]
    rows = [(d, x[0]) for d, x in planted.items()] + others
    frame = given[1].select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in pii.personal_data(frame).where("doc_id > 9000").select("doc_id", "base", "spans").collect()}
    for d, (text, form, kind) in planted.items():
        at = text.index(form)
        assert not got[d]["base"] and [tuple(x) for x in got[d]["spans"]] == [(kind, at, at + len(form))], text
    assert all(got[d]["spans"] == got[d]["base"] for d, _ in others)


def test_base_spans_do_not_pay_for_wrong_ones(spark):
    rows = [(i, f"paid by 4111 1111 1111 1111 on day {i}") for i in range(90)] + [(100 + i, "key a1b183110802154c") for i in range(3)]
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("base <> spans").isEmpty() and out.where(F.size("base") > 0).count() == 90


def test_whole_texts_stay_with_their_spans(docs):
    work = SubstringDedup(docs)
    for r in work.result.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert len(r["text"].split(" ")) == max(1, r["n_words"] - r["n_removed"])
    work.drop()


def test_queries_have_the_contract_columns():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark, docs):
    """Each stage against its operator's plain loop, on the documents that the one before kept."""
    import corpus_pipeline

    from shelfline.llm.store import stored

    sf, columns = "/root/testdata/sf0.01", ["doc_id", "text", "lang", "source", "n_chars"]
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in toxicity.toxicity(frame, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    near = lambda rows: {d for d, _, c in brute.simhash(rows) if d == c}
    keeps = {
        "toxicity": lambda rows: {d for d, _ in rows} - toxic,
        "exact_dedup": lambda rows: {r[0] for r in brute.exact(rows) if r[3]},
        "near_dedup": near,
        "decontamination": lambda rows: {r[0] for r in brute.contamination(rows, bench) if not r[-1]},
    }
    assert list(stages) == [*keeps, "packing"]
    for name, keep in keeps.items():
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        frame = stored(stages[name](spark, frame, sf))
        assert frame.columns == columns
        left = [r["doc_id"] for r in frame.collect()]
        assert len(left) == len(set(left)) and set(left) == keep(rows) and len(left) < len(rows)
    out = stored(stages["packing"](spark, frame, sf))
    assert {r["doc_id"] for r in out.collect()} == set(left)
    for stage in list(stages.values())[:4]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        assert not Counter(rows_of(kept)) - Counter(rows_of(docs))
        assert stage(spark, docs.limit(0), sf).isEmpty()
    assert corpus_pipeline.run(spark, sf).count() == out.count()
