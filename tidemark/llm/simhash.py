"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2r`` bits have a common variant within
``r`` bits of each. So every distinct fingerprint emits all its variants within
half the radius, a shuffle brings equal variants together, and only fingerprints
that share one are compared. A variant's ball holds at most ``1 + 64`` different
fingerprints (radius 1), however many documents there are, so no group can grow.
Within a ball each fingerprint is linked to the one before it, which joins the
same fingerprints as all pairs would: any two of a ball are within twice its radius.

Texts are lower-cased in A-Z, words are cut at ASCII white space, shingles are
runs of ``shingle`` words joined by one blank (a shorter text is one shingle),
and a bit is set when more than half of the shingles' XXH64 hashes (seed 42) have
it. Null and wordless texts have fingerprint zero. A row that occurs twice is two
rows of one component; a null doc_id is a row too, and counts as a component's
smallest id only if there is no other. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, keyed_texts, same_row, stored, without

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BLOCK = 200_000  # hashes turned to bits at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text given in UTF-8."""
    words = text.lower().split()  # both of bytes: ASCII alone
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([digest(whole[a:b], SEED) for a, b in spans], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row; the fingerprint's 64 bits as a signed long."""

    def compute(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            own = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([b.column("doc_id"), b.column("text_hash"), pa.array(own)], names=["doc_id", "text_hash", "fp"])

    return keyed_texts(docs).mapInArrow(compute, "doc_id long, text_hash long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: different fingerprints within ``max_bits``, enough of them to connect every such pair."""
    half = (max_bits + 1) // 2
    masks = [_signed(sum(1 << i for i in at)) for r in range(half + 1) for at in combinations(range(64), r)]
    variants = distinct.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in masks])).alias("variant"))
    if 2 * half != max_bits:  # an odd bound: a ball's members may be one bit too far apart, so each meets all others of it
        ball = variants.groupBy("variant").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
        met = ball.select(F.explode("near").alias("a"), "near").select("a", F.explode("near").alias("b")).where("a < b")
    else:
        before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
        met = variants.select(before.alias("a"), F.col("fp").alias("b")).where(F.col("a").isNotNull())
    return met.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node each node of ``edges`` (``a, b``) is connected with.

    Every round each node takes the smallest root among its neighbours and then
    that root's own root, so long chains are halved. A round is written before
    the next begins; the driver sees one count per round.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    roots = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        taken = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = roots.select(F.col("node").alias("via"), F.col("root").alias("further"))
        new = stored(taken.join(jump, "via").select("node", "old", F.least("via", "further").alias("root")), "roots")
        if new.where(F.col("old") != F.col("root")).isEmpty():
            return new.select("node", "root")
        roots = new.select("node", "root")


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """Every row as ``doc_id, text_hash, fp, first``: the component's first row, by doc_id and then text_hash."""
    own = stored(fingerprints(docs, shingle), "fingerprints")
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))
    distinct = stored(own.groupBy("fp").agg(F.min(row).alias("first")), "distinct")
    joined = components(links(distinct.select("fp"), max_bits))
    # Fingerprints without links are their own component.
    rooted = distinct.join(joined.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return own.join(rooted.drop("first").join(smallest, "root").select("fp", "first"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (``doc_id, text``)."""
    return _grouped(docs, shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component stays, the first by doc_id, with all its columns.

    A row repeated as a whole stays once; documents without an id stay as they are.
    """
    grouped = stored(_grouped(docs.where(F.col("doc_id").isNotNull()), shingle, max_bits), "components")
    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    kept = without(docs, grouped.where(~is_first))
    firsts = grouped.where(is_first).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if firsts.isEmpty():
        return kept
    doc, key = fresh(docs, "doc", "key")
    named = firsts.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(key))
    return without(kept, firsts).unionByName(kept.join(named, same_row(doc, key), "left_semi").dropDuplicates(["doc_id", "text"]))
