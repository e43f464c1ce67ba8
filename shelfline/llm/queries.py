"""The queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import decontamination, exact, language, packing, periods, pii, quality, sharding, simhash, substring, tokens, toxicity, trie
from shelfline.llm.store import stored, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = substring.SubstringDedup(table(spark, sf_dir, "documents"))
    out = stored(work.result.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")))
    work.drop()
    return out


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), collapse=True)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.uniform_shards(rows, shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of them (by id) with words that repeat from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    first = (g % n).alias("first")
    period = (1 + F.floor((n - g % n) / (3 + g % 8))).alias("period")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    there = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"))
    there = there.select("doc_id", "text", F.when(n > 0, F.col("words")).alias("words"), F.when(n > 0, first).alias("first"), F.when(n > 0, period).alias("period"))
    at = lambda i: F.when(i < F.col("first"), i).otherwise(F.col("first") + (i - F.col("first")) % F.col("period"))
    said = F.transform("words", lambda w, i: F.get("words", at(i)))
    return there.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(said, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    # Quotients of whole numbers with a product below 2^52 differ as doubles where they differ.
    ranked = F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("q"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("l")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = found.select("doc_id", "text", "runs", F.array_max(ranked).alias("best"), listed.alias("listed"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first turns of conversation c - c % 5 before its later own ones; and all ids."""
    own = F.crc32(F.col("conv_id").cast("string")) % 9
    base = F.col("conv_id") - F.col("conv_id") % 5
    members = stored(turns.select("conv_id").distinct())
    heads = turns.where(F.col("pos") < 8).select(F.col("conv_id").alias("base"), "pos", "item")
    others = members.where(F.col("conv_id") != base).select("conv_id", base.alias("base"), own.alias("own"))
    taken = stored(others.join(heads, "base").where(F.col("pos") < F.col("own")).select("conv_id", "pos", "item"))
    before = stored(taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("before")))
    later = turns.where((F.col("conv_id") != base) & (F.col("pos") >= own)).join(before, "conv_id", "left")
    later = later.select("conv_id", (F.coalesce("before", F.lit(0)) + F.col("pos") - own).alias("pos"), "item")
    return reduce(DataFrame.unionByName, [turns.where(F.col("conv_id") == base), taken, later]), members


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(trie.turns_of(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(*rebuilt(turns))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_substring_dedup, op2_decontamination, op3_pii, op4_toxicity, op5_token_counts, op6_packing, op7_simhash,
    op8_exact_dedup, op9_sharding, op10_quality, op11_periodic_runs, op12_prefix_trie, op13_language,
)
QUERIES = {f.__name__: f for f in OPERATORS}

#: What every equal text is grouped by, and the order in which one of them stays.
ORACLE = {
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
    """,
    # CRC-32 bit by bit over the id's digits; then every prefix as a list of turns.
    "op12_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (
                    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
                ) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base,
                xor(list_reduce(
                    list_prepend(4294967295, [ord(c) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')])::BIGINT[],
                    lambda crc, c: list_reduce(
                        list_prepend(xor(crc, c), range(8))::BIGINT[],
                        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))
                    )
                ), 4294967295) % 9 AS own
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.own
            UNION ALL
            SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.own
        ), sequences AS (
            SELECT c.conv_id, coalesce(s.turns, []) AS turns FROM convs c LEFT JOIN (
                SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, pos) AS turns FROM rebuilt GROUP BY conv_id
            ) s USING (conv_id)
        ), prefixes AS (
            SELECT conv_id, len(turns) AS whole, d, turns[1:d] AS key
            FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM sequences)
        ), nodes AS (
            SELECT key, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                CASE WHEN d = 0 THEN 0 ELSE strlen(key[d].text) END AS bytes,
                coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole = d), '') AS ends
            FROM prefixes GROUP BY key, d
        ), children AS (
            SELECT key[1:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
        ), known AS (
            SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (key, depth)
        ), totals AS (
            SELECT key[1:a] AS key, a AS depth, sum(CAST(n_children = 0 AS INTEGER)) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
            FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM known) GROUP BY 1, 2
        )
        SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
            CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
        FROM known k JOIN totals t USING (key, depth)
        LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.key = k.key[1:k.depth - 1]
    """,
}
