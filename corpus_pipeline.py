"""From raw documents to packed training sequences, in stages of the operators of ``tidemark.llm``.

Every stage takes the session, the documents its predecessor kept and the data
folder. Its result is written as Parquet and read again as the next one's
documents. All but the last return the columns of ``documents``.

Nulls: a null text has no letter, so the first stage rejects it; if no document
outside the held-out fold has a lang, it keeps all documents with a letter; rows without a doc_id pass the near-duplicate stage as they are. An empty table gives an empty
result, extra columns go along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, line_dedup, packing, simhash
from tidemark.llm.common import remove, scratch, stored, table
from tidemark.llm.queries import tokenizer


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents without a determined language go."""
    return language.keep_identified(docs)


def cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: boilerplate of many sites stays in one document only."""
    kept = line_dedup.keep_cleaned(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near duplicates: one document of each group stays."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of 2,048 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language", identified),
    ("line_dedup", cleaned),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: The first stage's network and the packing have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's folders go when the next one's result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            remove(spark, before)
        before = made[-1]
    return docs
