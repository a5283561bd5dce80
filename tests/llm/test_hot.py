"""Hot rows: one token in every row, many copies of one row; and the license scan's SQL on made texts."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import compare
from tidemark.llm import decontaminate, licenses, token_counts
from tidemark.llm.common import repeated
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import tokenizer

PIECES = tokenizer("piece_bpe_32k.model")


def _made_texts():
    rng = random.Random(3)
    notices = list(licenses.NOTICES)
    texts = [f"{notice} " * n for notice in ("All rights reserved", notices[0], notices[8]) for n in (1, 2, 3, 40, 1_000)]
    for _ in range(300):
        words = rng.choice([*notices, *licenses.PHRASES]).split()
        for _ in range(rng.randint(0, 3)):  # a word more, fewer or another one
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choice([[], ["really"], ["all", "rights"]])
        texts.append(" ".join([*words, *rng.choices(["some", "prose"], k=rng.randint(0, 4))] * rng.randint(1, 4)))
    texts += ["MIT Kicense MIT License", "MİT license", "mit lİcense mit license", "", None, "ALL RIGHTS RESERVED"]
    return list(enumerate(texts))


def test_license_sql_on_repeated_and_changed_notices(spark):
    given = _made_texts()
    df = spark.createDataFrame(given, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [n for n, _ in given], "text": pa.array([t for _, t in given], pa.string())}))
    difference, rows = compare(licenses.license_scan(df), con, ORACLE["op9_license_scan"])
    assert difference is None and rows == len(given)


def test_one_long_token_in_every_row(spark):
    """Tokens of any length are bounded: each goes by its hash, and frequent ones are handed out."""
    import sentencepiece

    long, rng = "q" * 40, random.Random(2)
    given = [(n, f"{long} word {n % 7} {long}{rng.randint(0, 3)} {'z' * rng.randint(30, 35)}") for n in range(3_000)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for head in (300_000, 3, 0):
        found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, PIECES, head=head).collect()}
        assert found == {n: len(model.encode(t)) for n, t in given}
    keys = token_counts.distinct_pre_tokens(df.select("text"))
    assert keys.agg(F.max(F.length("pre_token"))).first()[0] <= token_counts.HEAD_CHARS + 1


@pytest.mark.parametrize("copies", [1, 250_001])
def test_copies_are_dealt_over_tasks(spark, copies):
    rows = spark.createDataFrame([(None, 7, copies), (3, 8, 2)], "doc_id long, text_hash long, copies long").withColumn("from", F.lit("x"))
    out = repeated(rows, "copies", block=10_000)
    assert out.columns == ["doc_id", "text_hash", "from"]
    assert {r.text_hash: r["count"] for r in out.groupBy("text_hash").count().collect()} == {7: copies, 8: 2}
    if copies > 1:
        assert out.where("text_hash = 7").select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] < copies / 2


def test_a_million_rows_without_id_and_text(spark):
    """They are one key and come back as a million rows, from many tasks."""
    many = spark.range(1_000_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    some = spark.createDataFrame([(1, "one two"), (2, "mit license")], "doc_id long, text string")
    df = many.unionByName(some)
    counted = token_counts.token_counts(df, PIECES)
    assert counted.where("doc_id IS NULL AND n_tokens = 0").count() == 1_000_000 and counted.count() == 1_000_002
    assert licenses.license_scan(df).count() == 1_000_002


def test_copies_with_items_in_blocks(spark):
    """Rows of one id and text in several blocks of items: each comes back."""
    text = " ".join(f"w{n}" for n in range(40))
    docs = spark.createDataFrame([(None, text)] * 500 + [(1, text), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(n, " ".join(f"w{k}" for k in range(n, n + 12))) for n in range(0, 28, 4)], "item_id long, text string")
    one = Counter(tuple(r) for r in decontaminate.contamination(docs, items).collect())
    assert one == Counter(tuple(r) for r in decontaminate.contamination(docs, items, block_bytes=80).collect())
    assert sum(one.values()) == 502
