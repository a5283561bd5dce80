"""Shards of a k-d tree: whole, balanced, cut where a sorted list says."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def checked(df, given, shards=8, slack=None):
    """Every row once, gapless slots; shards apart by less than two of the longest texts."""
    out = sharding.shard_documents(df, shards)
    assert out.columns == COLUMNS
    found = out.collect()
    raw = [(d, (t or "").encode()) for d, t in given]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((d, len(t) + 1, zlib.crc32(t)) for d, t in raw)
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in found)
    for shard in range(shards):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    sizes = [sum(r.size for r in found if r.shard == shard) for shard in range(shards)]
    longest = max((len(t) + 1 for _, t in raw), default=0)
    assert max(sizes) - min(sizes) <= (2 * longest if slack is None else slack)
    return found


def test_awkward_rows(docs, rows):
    checked(docs, rows)


@pytest.mark.parametrize("shards", [1, 3, 8, 21])
def test_documents(documents, listed, shards):
    checked(documents, listed, shards)


def test_no_documents(no_docs):
    assert sharding.shard_documents(no_docs).collect() == []


def test_no_language_column(spark):
    given = [(n, "ab" * n) for n in range(200)]
    checked(spark.createDataFrame(given, "doc_id long, text string"), given)


def test_a_group_of_copies_larger_than_a_shard(spark):
    """Equal texts, and equal rows too, are cut; a small group stays together."""
    given = [(n, "copy " * 20) for n in range(3_000)] + [(7, "again " * 20)] * 2_000 + [(None, None)] * 500
    given += [(10_000 + n, f"text {n} " * 20) for n in range(3_000)] + [(20_000 + n, "a few copies " * 20) for n in range(30)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    found = checked(df, given, slack=2_000)
    assert len({r.shard for r in found if r.doc_id is not None and r.doc_id >= 20_000}) == 1


def test_cuts_are_weighted_medians_along_the_widest_dimension(spark):
    """Against sorting: two dimensions, the second wider in one half."""
    given = [(n, 1 + n % 17, float(n), 0.0 if n < 500 else float(n % 100) * 9) for n in range(1_000)]
    df = spark.createDataFrame(given, "n long, size long, d0 double, d1 double")
    df = df.select("*", *[F.xxhash64("n", F.lit(k)).alias(c) for k, c in enumerate(("by_text", "by_doc", "by_row"))])
    scaled = sharding._on_scale(df, ["d0", "d1"])
    shard = {r.n: r.shard for r in sharding.assign(scaled, 4, ["d0", "d1"], tolerance=0).collect()}
    size = {n: s for n, s, _, _ in given}
    total = sum(size.values())

    def cut(members, key):
        members, have, left = sorted(members, key=key), 0, []
        goal = sum(size[m] for m in members) / 2
        for m in members:
            if abs(have + size[m] - goal) > abs(have - goal):
                break
            have += size[m]
            left.append(m)
        return left

    first = cut(list(size), lambda n: n)
    assert sorted(n for n in shard if shard[n] < 2) == first
    rest = [n for n in size if n not in set(first)]
    right = {n for n in rest if shard[n] == 3}  # the wider dimension is the second there
    low, high = max(given[n][3] for n in rest if n not in right), min(given[n][3] for n in right)
    assert low <= high and abs(sum(size[n] for n in right) - total / 4) <= 17
