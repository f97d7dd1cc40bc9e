"""Registered queries ``opN_<name>``: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import (bond, convrepair, ctw, fingerprint, histpack, langid, linededup, mixing, nndescent, orderminhash, packing,
                         sharding, warc)
from blotter.llm.common import table
from blotter.session import scratch_path


def tokenizer() -> tuple[str, str]:
    """Rank file and pre-tokenizer pattern of the public byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(spark, table(spark, sf_dir, "documents"))


def op2_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.rebuilt(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))
    return rows.withColumnsRenamed({"__removed": "lines_removed", "__left": "has_lines_left"})


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op4_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer())


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"), shards=16)


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op7_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_and_fingerprint(spark, table(spark, sf_dir, "documents"))


def op8_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op9_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_bundles(spark, table(spark, sf_dir, "pages"), path)
    return warc.read_bundles(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents"))


def op11_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return histpack.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.hard_negatives(spark, table(spark, sf_dir, "embeddings"), moved, F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.repair_conversations(spark, convrepair.damaged(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_context_tree_scores, op2_fuzzy_lines, op3_order_minhash, op4_tier_packing, op5_jump_shards,
        op6_nn_descent, op7_weighted_sampling, op8_kneser_ney_language, op9_seekable_warc, op10_fair_mix,
        op11_histogram_packing, op12_bond_negatives, op13_conversation_repair)}
