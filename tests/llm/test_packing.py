"""The index of sums against all combinations, and ids with little memory against whole encodings."""

from __future__ import annotations

import random
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa

from tidemark.llm import packing
from tidemark.llm.common import buffers, shards
from tidemark.llm.queries import tokenizer


def test_index_of_sums_under_falling_counts():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.randint(1, 24)
        count = np.array([0] + [rng.choice([0, 0, 1, 2, 3]) for _ in range(capacity)])
        sums = packing.Sums(count)
        for _ in range(40):
            total = rng.randint(1, capacity)
            lengths = np.flatnonzero(count).tolist()
            fits = [
                c for n in (1, 2, 3) for c in combinations_with_replacement(lengths, n) if sum(c) == total and all(count[x] >= c.count(x) for x in c)
            ]
            found = sums.find(total)
            assert (found is None) == (not fits)
            if found:
                assert tuple(sorted(found)) in fits and len(found) == len(fits[0])
                for x in found:
                    count[x] -= 1


def test_ids_with_little_memory(rows, listed, monkeypatch):
    """What is forgotten is cut again: ids equal whole encodings."""
    monkeypatch.setattr(packing, "KNOWN_BYTES", 2_000)
    texts = [t or "" for _, t in rows + listed[:60]] + ["a.B,c!;d", "x.́ y", "Don't. STOP?!", "é.è"]
    whole = packing._tokenizer(tokenizer("word_bpe_49k.json"))
    ids = packing.Ids(tokenizer("word_bpe_49k.json"))
    raw, offsets = buffers(pa.array(texts))
    for i, j in shards(offsets, 3_000):
        for text, own in zip(texts[i:j], ids.of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])):
            assert own.tolist() == whole.encode(text, add_special_tokens=False).ids
