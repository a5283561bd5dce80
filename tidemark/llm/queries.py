"""The dealt operators as queries over whole tables, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, ann, conversations, decontaminate, language, licenses, line_dedup, packing, pii, sharding, simhash, suffix_dedup, token_counts
from tidemark.llm.common import table

TOKENIZERS = "/opt/tokenizers"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    return f"{TOKENIZERS}/{name}"


@query
def op4_benchmark_decontamination(spark, d):
    return decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op8_token_counts(spark, d):
    return token_counts.token_counts(table(spark, d, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op1_suffix_dedup(spark, d):
    return suffix_dedup.repeated_passages(table(spark, d, "documents")).select("doc_id", "start_word", "end_word")


@query
def op2_personal_data(spark, d):
    return pii.find_personal_data(table(spark, d, "documents"))


@query
def op3_line_dedup(spark, d):
    return line_dedup.remove_boilerplate(table(spark, d, "documents")).select("doc_id", "source", "n_lines", "n_removed", "text")


@query
def op5_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op6_nearest_neighbours(spark, d):
    return ann.nearest(table(spark, d, "embeddings"))


@query
def op7_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query
def op9_license_scan(spark, d):
    return licenses.license_scan(table(spark, d, "documents"))


@query
def op10_language(spark, d):
    return language.identify(table(spark, d, "documents"))


@query
def op11_conversation_repair(spark, d):
    return conversations.repair(conversations.damaged(table(spark, d, "conversations")), texts=False)[0]


@query
def op12_kd_shards(spark, d):
    return sharding.shard_documents(table(spark, d, "documents"))


@query
def op13_token_alignment(spark, d):
    return alignment.align(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op1_shortened_texts(spark, d):
    """The removal to :func:`op1_suffix_dedup`, whose columns are those of its SQL: every text without its later repeats."""
    return suffix_dedup.remove_repeats(table(spark, d, "documents")).select("doc_id", "text")


#: Further results of the operators above.
FURTHER: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_shortened_texts": op1_shortened_texts}
