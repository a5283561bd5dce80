"""Shards of near equal bytes by a k-d tree over the documents' metadata.

The root holds all documents. A node that is to give several shards is cut along
its widest metadata dimension at the weighted median: the place that leaves its
left child as many bytes as its part of the shards takes, half of them for an even
number. It ends with leaves of the target, the total over the number of shards.

No row moves for a cut; each level writes its thin rows with their node once. Its place is found digit by digit: one aggregation sums the
bytes under each of 4,096 values of the next digit, for all nodes of a level at
once, and the driver reads on behind the value that the median falls on, until
what is left there is below the tolerance or one row. The digits are the dimension's
coordinate, then a hash of the text, then hashes of the doc_id and of the row. So
rows with equal metadata and text share a leaf, unless a cut has to go through
them, and a group of copies that outweighs a shard is cut like anything else.

Dimensions are the logarithm of the text's bytes, its bytes per character and
its language; each is put on a scale of 4,096 steps over the whole table, and a
node's width is the span of its steps.

A null text has no bytes, so its size is 1; a null language is a language, a null
doc_id a value; a repeated row is a document of its own; other columns are not read;
an empty table gives an empty result, and more shards than rows leave shards empty.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BITS = 12
STEPS = 1 << BITS
TOLERANCE = 1e-4  # of a shard's target
_HASHED = ("by_text", "by_doc", "by_row")
_DIGITS = 1 + 3 * len(_HASHED)


@dataclass
class Node:
    """A node of one level: the shards it still has to give, and where it is cut."""

    first: int  # its first shard
    shards: int
    dimension: int = 0
    weight: int = 0
    goal: float = 0  # bytes that the left child still takes, behind the digits found so far
    digits: list[int] = field(default_factory=list)
    done: bool = False

    @property
    def left(self) -> int:
        return self.shards // 2


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32``, the dimensions ``d0, d1, ..`` and the hashes that order equal ones."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("bigint")
    lang = F.col("lang") if "lang" in {c.lower() for c in docs.columns} else F.lit(None)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (size + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.log2(size + 1).alias("d0"),
        (size / F.greatest(F.length(text), F.lit(1))).alias("d1"),
        (F.pmod(F.xxhash64(lang.cast("string")), F.lit(STEPS)) / STEPS).alias("d2"),
        F.xxhash64(text).alias("by_text"),
        F.xxhash64("doc_id").alias("by_doc"),
        F.xxhash64(F.monotonically_increasing_id()).alias("by_row"),
    )


def _on_scale(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """The dimensions as steps from 0 to ``STEPS - 1``."""
    span = rows.agg(*[f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("low", F.min), ("high", F.max))]).first()
    out = {}
    for d in dimensions:
        low, high = span[f"low_{d}"], span[f"high_{d}"]
        out[d] = F.lit(0) if low is None or high <= low else F.floor((F.col(d) - low) / (high - low) * (STEPS - 1)).cast("int")
    return rows.withColumns(out)


def _digit(k: int, dimension: Column, dimensions: list[str]) -> Column:
    if k == 0:
        return F.get(F.array(*dimensions), dimension)
    of, part = divmod(k - 1, 3)
    return F.shiftrightunsigned(F.col(_HASHED[of]), 64 - BITS * (part + 1)).bitwiseAND(F.lit(STEPS - 1)).cast("int")


def _per_node(values: list, kind: str) -> Column:
    """A value for the row's node."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("node"))


def _cut(rows: DataFrame, nodes: list[Node], dimensions: list[str], slack: float) -> None:
    """Finds where each node is cut: rows whose digits come before ``digits`` go left."""
    spans = rows.groupBy("node").agg(
        F.sum("size").alias("weight"), *[(F.max(d) - F.min(d)).alias(f"w{n}") for n, d in enumerate(dimensions)]
    )
    for r in spans.collect():  # a row per node
        node = nodes[r.node]
        node.weight = r.weight
        node.dimension = int(np.argmax([r[f"w{n}"] for n in range(len(dimensions))]))
        node.goal = r.weight * node.left / node.shards
    for node in nodes:
        node.done = node.shards == 1 or not node.weight
    for k in range(_DIGITS):
        if all(node.done for node in nodes):
            return
        dimension = _per_node([node.dimension for node in nodes], "int")
        inside = _per_node([not node.done for node in nodes], "boolean")
        for j in range(k):
            inside &= _digit(j, dimension, dimensions) == _per_node([node.digits[j] if j < len(node.digits) else -1 for node in nodes], "int")
        # At most a row for each node and value of a digit.
        sums = rows.where(inside).groupBy("node", _digit(k, dimension, dimensions).alias("digit")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).toArrow()
        at, digit, size, count = (sums.column(c).to_numpy() for c in ("node", "digit", "size", "n"))
        for n, node in enumerate(nodes):
            if node.done:
                continue
            own = np.flatnonzero(at == n)
            own = own[np.argsort(digit[own])]
            until = np.cumsum(size[own])
            hit = min(int(np.searchsorted(until, node.goal)), len(own) - 1)
            weight, before = int(size[own[hit]]), int(until[hit] - size[own[hit]])
            here = int(digit[own[hit]])
            if weight <= slack or count[own[hit]] == 1 or k == _DIGITS - 1:
                node.digits.append(here + (node.goal - before > weight / 2))  # the nearer end
                node.done = True
            else:
                node.digits.append(here)
                node.goal -= before


def _split(rows: DataFrame, nodes: list[Node], dimensions: list[str]) -> tuple[DataFrame, list[Node]]:
    """The next level: every row in the left or right child of its node."""
    below, children = [], []
    for node in nodes:
        below.append(len(children))
        if node.shards == 1:
            children.append(Node(node.first, 1))
        else:
            children += [Node(node.first, node.left), Node(node.first + node.left, node.shards - node.left)]
    dimension = _per_node([node.dimension for node in nodes], "int")
    right = F.lit(True)  # not before the cut: from the last digit to the first
    for k in range(max((len(node.digits) for node in nodes), default=0))[::-1]:
        place = _per_node([node.digits[k] if k < len(node.digits) else None for node in nodes], "int")
        digit = _digit(k, dimension, dimensions)
        right = place.isNull() | (digit > place) | ((digit == place) & right)
    right &= _per_node([node.shards > 1 for node in nodes], "boolean")
    return rows.withColumn("node", _per_node(below, "int") + right.cast("int")), children


def assign(rows: DataFrame, shards: int, dimensions: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` (with ``size``, the dimensions and the hashes) with their ``shard``."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    nodes = [Node(0, shards)]
    rows = rows.withColumn("node", F.lit(0))
    while any(node.shards > 1 for node in nodes):
        _cut(rows, nodes, dimensions, tolerance * total / shards)
        rows, nodes = _split(rows, nodes, dimensions)
        rows = stored(rows, "nodes")  # else each level's expressions would hold all those above, many times
    return rows.withColumnRenamed("node", "shard")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs`` (``doc_id, text, lang``)."""
    if shards < 1:
        raise ValueError("at least one shard")
    dimensions = ["d0", "d1", "d2"]
    rows = assign(_on_scale(stored(metadata(docs), "metadata"), dimensions), shards, dimensions)

    def number(batches):  # places among the task's own rows of a shard
        seen, task = np.zeros(shards, np.int64), TaskContext.get().partitionId()
        for b in batches:
            shard = b.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            count = np.bincount(shard, minlength=shards)
            place = np.empty(len(shard), np.int64)
            place[order] = np.arange(len(shard)) - np.repeat(np.cumsum(count) - count, count)
            kept = [b.column(c) for c in ("doc_id", "size", "text_crc32", "shard")]
            yield pa.record_batch(
                [*kept, pa.array(np.full(len(shard), task, np.int32)), pa.array(place + seen[shard])],
                names=["doc_id", "size", "text_crc32", "shard", "task", "place"],
            )
            seen += count

    kinds = "doc_id long, size long, text_crc32 long, shard int, task int, place long"
    numbered = stored(rows.select("doc_id", "size", "text_crc32", "shard").mapInArrow(number, kinds), "shards")
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    begins = (
        numbered.groupBy("task", "shard").agg(F.count(F.lit(1)).alias("n"))
        .select("task", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    )
    return numbered.join(begins, ["task", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begin") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
