"""Token counts from distinct pre-tokens: every pre-token is cut into pieces once, documents only add numbers.

The vocabulary has no piece that goes on behind a blank, so a text is the run of
its pre-tokens (blanks and what follows them), and its count is the sum of
theirs. Distinct pre-tokens are found and counted by one aggregation, one of more
than ``HEAD_CHARS`` characters under its 128-bit hash. The ``HEAD`` most frequent keys, of
bounded size, are handed to the tasks; the frequencies of all others,
each at most one in ``HEAD`` of all occurrences however long it is, meet their
counts in a join. No ids are ever made for a document.

Null texts are empty, empty texts have no token, a repeated row is counted like
any other, a null doc_id is a value, other columns are not read, and an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_texts, repeated, stored

HEAD = 300_000
HEAD_CHARS = 32
FLUSH = 400_000  # distinct pre-tokens a task holds before it hands them on

_RUNS = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first blank (a text gets one in front)."""
    if not text:
        return []
    text = text.replace("▁", " ")  # the model's own sign for a blank
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [m[1:] for m in _RUNS.findall(" " + text)]
    return text.split(" ")


def keyed(pre_token: str) -> str:
    """What a pre-token goes by: itself, or a hash behind the one sign that no pre-token holds."""
    return pre_token if len(pre_token) <= HEAD_CHARS else "▁" + hashlib.md5(pre_token.encode(), usedforsecurity=False).hexdigest()


def piece_counts(batch: list[str], path: str) -> list[int]:
    """Pieces of each pre-token."""
    return [len(ids) if t else 1 for t, ids in zip(batch, _model(path).encode(batch, num_threads=1))]


def distinct_pre_tokens(texts: DataFrame) -> DataFrame:
    """``pre_token, whole, n``: every pre-token's key with its occurrences in the whole corpus; ``whole`` is a long one itself."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(pre_tokens(text))
                if len(seen) > FLUSH:
                    yield _pairs(seen)
                    seen = Counter()
        yield _pairs(seen)

    found = texts.select("text").mapInArrow(count, "pre_token string, whole string, n long")
    return found.groupBy("pre_token", "whole").agg(F.sum("n").alias("n"))


def _pairs(seen: Counter) -> pa.RecordBatch:
    whole = [t if len(t) > HEAD_CHARS else None for t in seen]
    columns = [pa.array(map(keyed, seen), pa.string()), pa.array(whole, pa.string()), pa.array(seen.values(), pa.int64())]
    return pa.record_batch(columns, names=["pre_token", "whole", "n"])


def with_pieces(distinct: DataFrame, path: str) -> DataFrame:
    def count(batches):
        for b in batches:
            names, wholes = b.column("pre_token").to_pylist(), b.column("whole").to_pylist()
            pieces = piece_counts([n if w is None else w for n, w in zip(names, wholes)], path)
            yield pa.record_batch([b.column("pre_token"), b.column("n"), pa.array(pieces, pa.int64())], names=["pre_token", "n", "pieces"])

    return distinct.mapInArrow(count, "pre_token string, n long, pieces long")


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, head: int = HEAD) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (``doc_id, text``)."""
    texts = keyed_texts(docs)
    counted = stored(with_pieces(distinct_pre_tokens(texts), model_path), "pre-tokens")
    frequent = (
        counted.orderBy(F.desc("n"), "pre_token")
        .limit(head)
        .select("pre_token", "pieces")
        .toArrow()
    )
    known = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent["pre_token"].to_pylist(), frequent["pieces"].to_pylist())))

    def whole(batches):  # what the frequent pre-tokens of a document add up to
        get = known.value.get
        for b in batches:
            sums = [sum([get(t, 0) if len(t) <= HEAD_CHARS else get(keyed(t), 0) for t in pre_tokens(text)]) for text in b.column("text").to_pylist()]
            yield pa.record_batch(
                [b.column("doc_id"), b.column("text_hash"), b.column("n_bytes"), pa.array(sums, pa.int64())],
                names=["doc_id", "text_hash", "n_bytes", "n_tokens"],
            )

    def rest(batches):  # the frequencies of the others
        frequent = known.value
        for b in batches:
            ids, hashes, tokens, numbers = [], [], [], []
            for doc, key, text in zip(b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist(), b.column("text").to_pylist()):
                rare = Counter([k for k in map(keyed, pre_tokens(text)) if k not in frequent])
                tokens.extend(rare.keys())
                numbers.extend(rare.values())
                ids.extend([doc] * len(rare))
                hashes.extend([key] * len(rare))
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(tokens, pa.string()), pa.array(numbers, pa.int64())],
                names=["doc_id", "text_hash", "pre_token", "n"],
            )

    sized = texts.select("doc_id", "text_hash", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    common = sized.mapInArrow(whole, "doc_id long, text_hash long, n_bytes long, n_tokens long").select(
        "doc_id", "text_hash", "n_bytes", "n_tokens", F.lit(1).alias("copies")
    )
    others = (
        texts.mapInArrow(rest, "doc_id long, text_hash long, pre_token string, n long")
        .join(counted.select("pre_token", "pieces"), "pre_token")
        .select("doc_id", "text_hash", F.lit(0).cast("bigint").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n_tokens"), F.lit(0).alias("copies"))
    )
    total = common.unionByName(others).groupBy("doc_id", "text_hash").agg(
        F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("_sum"), F.sum("copies").alias("copies")
    )
    # Repeats of one row were added up together: share out, and give each its row back.
    shared = total.withColumn("n_tokens", F.expr("_sum div copies")).withColumn("over_limit", F.col("n_tokens") > limit)
    return repeated(shared, "copies").select("doc_id", "n_bytes", "n_tokens", "over_limit")
