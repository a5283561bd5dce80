"""Cross-tokenizer alignment against encodings of whole texts."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import alignment
from tidemark.llm.queries import tokenizer

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(df, **options):
    return Counter(tuple(r) for r in alignment.align(df, A, B, **options).select(*COLUMNS).collect())


def test_awkward_rows(docs, rows):
    assert found(docs) == Counter(brute.aligned(rows, A, B))


@pytest.mark.parametrize("chunk_bytes", [7, 1_000])
def test_fragments_of_long_documents(docs, rows, chunk_bytes):
    """Ranges that end anywhere, in several levels of the tree."""
    few = [r for r in rows if r[0] not in (13, 14, 15)] if chunk_bytes < 100 else rows
    df = docs.where("doc_id IS NULL OR doc_id NOT IN (13, 14, 15)") if chunk_bytes < 100 else docs
    assert found(df, chunk_bytes=chunk_bytes) == Counter(brute.aligned(few, A, B))


def test_pairs_outside_the_head(documents, listed):
    want = Counter(brute.aligned(listed, A, B))
    assert found(documents) == want
    assert found(documents, head=50) == want
    assert found(documents, head=0, chunk_bytes=500) == want


def test_odd_texts(spark):
    rng = random.Random(5)
    signs = [" ", "  ", "\n", "\t", "▁", "'s", "a", "B7", "ß", "é", " ", " ", "　", "日", "本", "カ", "́", "\x1c", "​", "<s>", "<0x41>", "<|endoftext|>", "😀", ".", "--"]
    given = [(n, "".join(rng.choice(signs) for _ in range(rng.randint(1, 40)))) for n in range(600)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    want = Counter(brute.aligned(given, A, B))
    assert found(df) == want
    assert found(df, chunk_bytes=9) == want
    assert any(r[1] for r in want) and any(not r[1] for r in want)


def test_no_documents(no_docs):
    assert found(no_docs) == Counter()


def test_composition_is_associative():
    rng = np.random.default_rng(2)

    def piece(low, high):
        ends = [np.array(sorted(rng.choice(np.arange(low + 1, high + 1), rng.integers(0, high - low), replace=False))) for _ in "ab"]
        return alignment.fragment(ends[0].astype(np.int32), ends[1].astype(np.int32), *ends)

    same = lambda x, y: x.closed == y.closed and all(np.array_equal(p, q) for p, q in zip(x[1:], y[1:]))
    for _ in range(300):
        x, y, z = piece(0, 4), piece(4, 9), piece(9, 13)
        assert same(alignment.compose(alignment.compose(x, y), z), alignment.compose(x, alignment.compose(y, z)))
        assert same(alignment.compose(x, alignment.EMPTY), x) and same(alignment.compose(alignment.EMPTY, x), x)


def test_a_group_with_many_links(spark):
    """Runs of blanks and letters: large groups go by distinct ids."""
    given = [(1, "x" * 3_000), (2, " " * 2_001), (3, "ab" * 2_500 + " end"), (4, "日" * 4_000)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    assert found(df) == Counter(brute.aligned(given, A, B))
