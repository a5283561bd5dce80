"""Each stage of the pipeline on what its predecessor kept, against brute force, and the whole of it."""

from __future__ import annotations

import os
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import language
from tidemark.llm.common import stored, table
from tidemark.llm.queries import tokenizer
from tidemark.session import shared_folder


def _rows(df):
    return [(r.doc_id, r.source, r.text) for r in df.collect()]


def _checked(spark, docs, sf_dir, benchmark):
    """The rows after every stage, each held against the plain form of the stage."""
    from tokenizers import Tokenizer

    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    steps = {}

    def step(name, df):
        steps[name] = stored(stages[name](spark, df, sf_dir), "test")
        return steps[name]

    kept = step("language", docs)
    assert kept.columns == columns
    net = language.trained(docs)
    rejected = {r.doc_id for r in language.identify(docs, net).where("lang_pred = 'und' or score < 0.5").collect()}
    assert Counter(_rows(kept)) == Counter(r for r in _rows(docs) if r[0] not in rejected)

    clean = step("line_dedup", kept)
    assert clean.columns == columns
    expected = [(d, t) for d, _, n, t in brute.lines(_rows(kept), 8) if not (n and not t.replace("\n", " ").strip(" "))]
    assert Counter((d, t) for d, _, t in _rows(clean)) == Counter(expected)

    single = step("near_duplicates", clean)
    assert single.columns == columns
    named = [(d, brute.simhash(t)) for d, _, t in _rows(clean) if d is not None]
    first = {d for (d, _), c in zip(named, brute.components(named)) if d == c}
    assert Counter(d for d, _, _ in _rows(single)) == Counter(first) + Counter(d for d, _, _ in _rows(clean) if d is None)

    pure = step("decontamination", single)
    assert pure.columns == columns
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = brute.contamination([(d, t) for d, _, t in _rows(single)], items)
    assert Counter(d for d, _, _ in _rows(pure)) == Counter(d for d, *_, hit in found if not hit)

    packed = step("packing", pure)
    own = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    pieces = Counter((d, *p) for d, _, t in _rows(pure) for p in brute.pieces(t, own))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == pieces
    return steps


def test_stages_on_documents(spark, documents, sf_dir):
    steps = _checked(spark, documents, sf_dir, table(spark, sf_dir, "benchmark"))
    pieces = [(r.doc_id, r.piece, r.ids_crc32) for r in steps["packing"].collect()]
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter(pieces)


def test_stages_on_awkward_rows(spark, docs, sf_dir):
    _checked(spark, docs, sf_dir, table(spark, sf_dir, "benchmark"))


def test_without_labels_documents_with_a_letter_stay(spark, docs, rows, sf_dir):
    held = docs.where(language.held_out() & F.col("lang").isNotNull())
    for df in (docs.withColumn("lang", F.lit(None).cast("string")), held):
        kept = corpus_pipeline.STAGES[0][1](spark, df, sf_dir)
        assert kept.columns == docs.columns
        expected = Counter(r for r in _rows(df) if any(c.isalpha() for c in r[2] or ""))
        assert expected and Counter(_rows(kept)) == expected


def test_no_documents(spark, no_docs, sf_dir):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test")
        assert docs.collect() == []


def test_only_the_result_is_left(spark, sf_dir):
    """The folders of every stage go, but for the last result."""
    root = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    result = corpus_pipeline.run(spark, sf_dir)
    left = set(os.listdir(root)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-packing") and result.count() > 0
