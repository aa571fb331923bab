"""One query for each operator of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.llm import bpe, decontamination, html, language_model, quality, quotes, repair, simhash, spotsigs, token_files, toxicity, urls, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and n-gram regression on the url of every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op2_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return language_model.score(table(spark, sf_dir, "documents"))


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the held-out quarter are not learnt from."""
    docs, part = table(spark, sf_dir, "documents"), toxicity.remainder(F.col("doc_id"), 4)
    model = quality.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").filter(part != 2))
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", (part == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the held-out fifth are not learnt from."""
    docs, part = table(spark, sf_dir, "documents"), toxicity.remainder(F.col("doc_id"), 5)
    model = toxicity.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").filter(part != 0))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", (part == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of every document."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of every document, of its edited text, and their likeness."""
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents"))


def op7_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in reply order, without quotes."""
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words found in every document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_html_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.fingerprint_hex("bits").alias("fingerprint"), F.col("component").alias("component_id"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every usable embedding."""
    return whitening.by_component(table(spark, sf_dir, "embeddings"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, audit and repaired digest of every damaged conversation."""
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from ORC files."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_interpolation": op2_interpolation,
        "op3_rule_ensemble": op3_rule_ensemble,
        "op4_string_kernel": op4_string_kernel,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_spotsigs": op6_spotsigs,
        "op7_quote_links": op7_quote_links,
        "op8_winnowing": op8_winnowing,
        "op9_html_field": op9_html_field,
        "op10_simhash": op10_simhash,
        "op11_whitening": op11_whitening,
        "op12_repair": op12_repair,
        "op13_token_files": op13_token_files,
        "pipeline": pipeline,
    }


#: op8 told by its definition: all windows of all items against all runs of as many words.
WINDOWS_SQL = r"""WITH said AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
 spoken AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM said),
 windows AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS run FROM (SELECT id AS item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM spoken WHERE kind = 'i' AND len(w) > 0)),
 runs AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS run FROM (SELECT id AS doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM spoken, (SELECT DISTINCT k FROM windows) WHERE kind = 'd' AND len(w) >= k)),
 found AS MATERIALIZED (SELECT doc_id, item_id, p, runs.k FROM runs JOIN windows ON runs.k = windows.k AND runs.run = windows.run),
 hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM found) GROUP BY doc_id),
 named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
 SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
 FROM spoken LEFT JOIN hits ON hits.doc_id = id LEFT JOIN named ON named.doc_id = id WHERE kind = 'd'"""


def oracle_sql() -> dict[str, str]:
    return {"op8_winnowing": WINDOWS_SQL}
