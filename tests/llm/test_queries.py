"""Every registered query on a whole table: names and types of its columns, and its values."""

from zlib import crc32

import brute
import public_tokenizers
import pytest
from conftest import DATA, rows_of
from tokenizers import Tokenizer

from shelfline.llm import queries

LONG, TEXT, YES, INT, REAL = "bigint", "string", "boolean", "int", "double"
CONTRACT = {
    "op1_substring_dedup": [("doc_id", LONG), ("n_words", LONG), ("n_removed", LONG), ("kept_sha256", TEXT)],
    "op2_decontamination": [("doc_id", LONG), ("n_words", LONG), ("n_hit", LONG), ("n_items", LONG), ("items_sha256", TEXT), ("contaminated", YES)],
    "op3_pii": [("doc_id", LONG), *[(f"n_{k}", LONG) for k in ("email", "ip", "card", "phone")], ("base_sha256", TEXT), ("spans", TEXT)],
    "op4_toxicity": [("doc_id", LONG), ("held_out", YES), ("score", REAL), ("predicted", INT)],
    "op5_token_counts": [("doc_id", LONG), ("n_bytes", LONG), ("n_tokens", LONG), ("over_limit", YES)],
    "op6_packing": [(c, LONG) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")],
    "op7_simhash": [("doc_id", LONG), ("fingerprint", TEXT), ("component_id", LONG)],
    "op8_exact_dedup": [("doc_id", LONG), ("keep_id", LONG), ("group_size", LONG), ("kept", YES), ("text_sha256", TEXT)],
    "op9_sharding": [("doc_id", LONG), ("size", LONG), ("text_crc32", LONG), ("law", TEXT), ("shard", INT), ("slot", LONG), ("grown_shard", INT)],
    "op10_quality": [("doc_id", LONG), ("held_out", YES), ("score", REAL), ("predicted", INT)],
    "op11_periodic_runs": [("doc_id", LONG), *[(c, LONG) for c in ("n_runs", "start", "length", "period", "exponent_milli")], ("runs_sha256", TEXT), ("collapsed_sha256", TEXT)],
    "op12_prefix_trie": [*[(c, LONG) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], ("ends_sha256", TEXT)],
    "op13_language": [("doc_id", LONG), ("held_out", YES), ("lang_pred", TEXT), ("score", REAL)],
}


@pytest.fixture(scope="module")
def table(spark, given):
    rows, _ = given
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    return rows, bench


def shards(got, rows):
    """Counts are at most one apart, slots gapless; size and checksum are those of the text."""
    assert {r["law"] for r in got} == {"rows"} and all(r["grown_shard"] is None for r in got)
    sizes = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(40)]
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1 and all(x == list(range(len(x))) for x in sizes)
    want = sorted((d, len((t or "").encode()) + 16, crc32((t or "").encode())) for d, t in rows)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def scores(got, rows, least, folds=5, fold=0):
    for r in got:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % folds == fold) and 0 <= r["score"] <= 1
        assert least is None or r["predicted"] == int(r["score"] >= least)
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, _ in rows)


def counts(got, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in got:
        n = len(tokenizer.encode(dict(rows)[r["doc_id"]] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 2048, len((dict(rows)[r["doc_id"]] or "").encode()))
    assert len(got) == len(rows)


def packed(got, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    brute.packed_whole(got, rows, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)


def test_all_are_here():
    assert list(queries.QUERIES) == list(CONTRACT)


@pytest.mark.parametrize("name", CONTRACT)
def test_query(spark, table, name):
    rows, bench = table
    got = queries.QUERIES[name](spark, DATA)
    assert got.dtypes[: len(CONTRACT[name])] == CONTRACT[name]
    plain = {
        "op1_substring_dedup": lambda: brute.substring(rows),
        "op2_decontamination": lambda: brute.contamination(rows, bench),
        "op7_simhash": lambda: brute.simhash(rows),
        "op8_exact_dedup": lambda: brute.exact(rows),
        "op11_periodic_runs": lambda: brute.periodic(rows),
    }
    if name in plain:
        assert rows_of(got) == sorted(plain[name](), key=repr)
    elif name == "op3_pii":
        assert rows_of(got.drop("spans")) == sorted(brute.personal(rows), key=repr)
    elif name == "op5_token_counts":
        counts(got.collect(), rows)
    elif name == "op6_packing":
        packed(got.collect(), rows)
    elif name == "op9_sharding":
        shards(got.collect(), rows)
    elif name in ("op4_toxicity", "op10_quality"):
        scores(got.collect(), rows, 0.5 if name == "op4_toxicity" else 0.3)
    elif name == "op13_language":
        scores(got.collect(), rows, None, 3, 1)
    else:
        conversations = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text")
        assert rows_of(got) == sorted(brute.trie([tuple(r) for r in conversations.collect()]), key=repr)
