"""Registered queries of this subpackage: one `opN_<name>` per operator, each
over its whole table with production parameters, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baobab.llm import (
    bpe,
    chat,
    counts,
    exact,
    lines,
    neighbours,
    packing,
    quality,
    repair,
    sharding,
    simhash,
    toxicity,
    trie,
)
from baobab.llm.common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENS = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits (stand-in edit lists)."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", counts.stand_in_edits(F.col("text"), F.col("doc_id")).alias("edits"))
    counted = counts.count_edits(docs, BYTE_RANKS, public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pretokens", "n_again")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base metrics of every document and its divergence from its language."""
    measured = quality.measure(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    rounded = {c: F.round(c, 6) for c in ("class_distance", "word_distance")}
    return measured.select("doc_id", "quality.*").withColumns(rounded)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of `documents` and the bytes they decode to, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN, with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (3 words, 2 bits)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of later occurrences of three-line windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id 20 divides."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of all conversations, rendered (stand-in: the rejected side breaks off)."""
    return chat.format_preferences(chat.preference_turns(table(spark, sf_dir, "conversations")))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of equal row counts, equal texts together where they fit."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every token piece of `documents` in sequences of 2048."""
    packed = packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENS, capacity=2048, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs.select("doc_id", "text"), scorer)
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of the one that stays of its equal texts."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults and its lightest repair."""
    return repair.repair_conversations(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_token_counts,
        op2_quality,
        op3_byte_bpe,
        op4_simhash,
        op5_line_dedup,
        op6_neighbours,
        op7_chat,
        op8_sharding,
        op9_packing,
        op10_toxicity,
        op11_prefix_trie,
        op12_exact_dedup,
        op13_conversation_repair,
    )
    return {f.__name__: f for f in every} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return own | {
        "op2_quality": quality.SQL,
        "op5_line_dedup": lines.SQL,
        "op7_chat": chat.SQL,
        "op11_prefix_trie": trie.SQL,
        "op12_exact_dedup": exact.SQL,
        "op13_conversation_repair": repair.SQL,
    }
