"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred, scaled to unit length, rotated by a random orthogonal matrix
and kept as the signs of their coordinates, packed to one bit each, with three
correction scalars: the distance from the centre, the inner product with the
centre, and how well the code points at its vector. From these the inner product
with a query is estimated for every candidate, together with a bound of the
estimate's error; only candidates whose upper bound reaches the 20th best lower
bound are scored exactly, on the original vectors, in double precision.

All rows are indexed. The centre, the median of each component, is fitted on a bounded
sample (``FIT_ROWS`` rows by a hash). Queries go against all codes in blocks of at most ``BLOCK_BYTES``; a
task keeps the best of its rows for each query, and one ranked grouping unites
the tasks. The bound holds with a probability set by ``CONFIDENCE``; recall is
measured against brute force in the tests.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows without an id. Rows of one id
count once, with the smallest of their vectors. Any finite component will do: lengths are
taken after scaling, a vector whose estimate is no number is scored exactly, and an inner
product that overflows to both sides counts as the least.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import gathered, stored

FIT_ROWS = 10_000
BLOCK_BYTES = 16_000_000
SINGLE, DOUBLE = 1e-5, 1e-13  # rounding of estimates in single precision, of the rest in double
CONFIDENCE = 2.5  # standard errors of an estimate that its bound allows for
_ROWS, _QUERIES = 4096, 512  # candidates and queries compared at once
_PAIRS = 16_384  # pairs scored at once


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part, one row per id."""
    v = F.col("embedding")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def rotation(size: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one and their lengths; scaled by the largest component, so that no square over- or underflows."""
    largest = np.abs(x).max(axis=1, initial=0)
    scaled = x / np.where(largest > 0, largest, 1)[:, None]
    length = np.linalg.norm(scaled, axis=1)
    return scaled / np.where(length > 0, length, 1)[:, None], largest * length


def products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows ``i`` of ``x`` with rows ``j`` of ``y``, in double precision; one that overflows both ways is the least."""
    out = np.empty(len(i))
    for at in range(0, len(i), _PAIRS):
        part = slice(at, at + _PAIRS)
        out[part] = (x[i[part]] * y[j[part]]).sum(axis=1)
    return np.where(np.isnan(out), -np.inf, out)


class Coder:
    """The fitted index: centre and rotation."""

    def __init__(self, centre: np.ndarray, seed: int = 5):
        self.centre, self.turn = centre, rotation(len(centre), seed)

    def code(self, x: np.ndarray):
        """Packed signs, distance from the centre, inner product with it, and the code's own cosine."""
        unit, norm = _unit(x - self.centre)
        turned = unit @ self.turn
        cosine = np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])
        return np.packbits(turned > 0, axis=1), norm, x @ self.centre, np.maximum(cosine, 1e-9)

    def query(self, q: np.ndarray):
        """Rotated unit queries, their distance from the centre, and the constant part of their inner products."""
        unit, norm = _unit(q - self.centre)
        return (unit @ self.turn).astype(np.float32), norm, q @ self.centre - self.centre @ self.centre


_CODES = "vec_id long, embedding array<double>, bits binary, norm double, on_centre double, cosine double"


def index(vectors: DataFrame, seed: int = 5) -> tuple[DataFrame, Coder | None]:
    """Every usable vector with its code, written once, and what the codes were made with."""
    rows = stored(usable(vectors), "vectors")
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return rows, None
    rows = rows.where(F.size("embedding") == common.d)
    chance = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < int(min(1.0, FIT_ROWS / common["count"]) * 1_000_003) + 1
    fit = _matrix(rows.where(chance).select("embedding").limit(2 * FIT_ROWS).toArrow()["embedding"].combine_chunks())
    coder = Coder(np.median(fit, axis=0) if len(fit) else np.zeros(common.d), seed)
    sent = vectors.sparkSession.sparkContext.broadcast(coder)

    def encode(batches):
        for b in batches:
            bits, norm, on_centre, cosine = sent.value.code(_matrix(b.column("embedding")))
            packed = pa.array([r.tobytes() for r in bits], pa.binary())
            yield pa.record_batch(
                [b.column("vec_id"), b.column("embedding"), packed, pa.array(norm), pa.array(on_centre), pa.array(cosine)],
                names=["vec_id", "embedding", "bits", "norm", "on_centre", "cosine"],
            )

    return stored(rows.mapInArrow(encode, _CODES), "codes"), coder


class Best:
    """The k best candidates of every query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def floor(self, part: slice) -> np.ndarray:
        return self.score[part, -1]

    def take(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched, position = np.unique(query, return_inverse=True)
        q = np.concatenate([np.repeat(np.arange(len(touched)), self.k), position])
        s = np.concatenate([self.score[touched].ravel(), scores])
        i = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((i, -s, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = order[place < self.k]
        self.score[touched], self.id[touched] = s[kept].reshape(-1, self.k), i[kept].reshape(-1, self.k)


def _search(coder: Coder, ids: np.ndarray, queries: np.ndarray, k: int):
    """The task that finds the best of its candidates for one block of queries."""

    def run(batches):
        np.seterr(over="ignore", invalid="ignore", under="ignore")  # such estimates are dealt with
        unit, distance, constant = coder.query(queries)
        best, d = Best(len(ids), k), len(coder.centre)
        for b in batches:
            for at in range(0, b.num_rows, _ROWS):
                own = b.slice(at, _ROWS)
                vectors, names = _matrix(own.column("embedding")), own.column("vec_id").to_numpy()
                bits = np.frombuffer(b"".join(own.column("bits").to_pylist()), np.uint8).reshape(len(names), -1)
                signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
                norm, on_centre, cosine = (own.column(c).to_numpy() for c in ("norm", "on_centre", "cosine"))
                error = CONFIDENCE * np.sqrt(np.maximum(1 - cosine**2, 0) / cosine**2 / max(d - 1, 1)) * norm + SINGLE * norm / cosine
                scale = norm / (cosine * np.sqrt(d))
                for first in range(0, len(ids), _QUERIES):
                    part = slice(first, min(first + _QUERIES, len(ids)))
                    estimate = (unit[part] @ signs.T) * (distance[part, None] * scale) + on_centre + constant[part, None]
                    bound = distance[part, None] * error + DOUBLE * (np.abs(on_centre) + np.abs(constant[part, None]))
                    floor = best.floor(part)
                    if len(names) > k:  # its own row may be among the first k, hence one more
                        low = estimate - bound
                        low[~np.isfinite(low)] = -np.inf
                        floor = np.maximum(floor, np.partition(low, len(names) - k - 1, axis=1)[:, len(names) - k - 1])
                    # An estimate that is no number says nothing, so its vector is scored.
                    q, c = np.nonzero(~(estimate + bound < floor[:, None]))
                    q += first
                    other = ids[q] != names[c]
                    q, c = q[other], c[other]
                    if len(q):
                        exact = products(queries, vectors, q, c)
                        best.take(q, names[c], exact)
        q, place = np.nonzero(best.id < np.iinfo(np.int64).max)
        yield pa.record_batch(
            [pa.array(ids[q]), pa.array(best.id[q, place]), pa.array(best.score[q, place])], names=["query_id", "vec_id", "score"]
        )

    return run


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = 20, every: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product with each query, itself left out.

    Queries are the rows of ``vectors`` whose id is divisible by ``every``, or those of ``queries``.
    """
    codes, coder = index(vectors)
    empty = "query_id long, rank int, vec_id long, score double"
    if coder is None:
        return vectors.sparkSession.createDataFrame([], empty)
    size = len(coder.centre)
    asked = codes.where(F.col("vec_id") % every == 0) if queries is None else usable(queries).where(F.size("embedding") == size)
    blocks = asked.count() * size * 8 // block_bytes + 1

    def searched():
        for n in range(blocks):
            block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n).select("vec_id", "embedding").toArrow()
            if block.num_rows:
                ids, values = block["vec_id"].to_numpy(), _matrix(block["embedding"].combine_chunks())
                yield codes.mapInArrow(_search(coder, ids, values, k), "query_id long, vec_id long, score double")

    # With several blocks the driver holds one at a time, whatever their number.
    found = next(searched(), None) if blocks == 1 else gathered(searched(), "neighbours")
    if found is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
