"""What several operators share: reading tables, storing steps, texts as numpy words."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders made since the innermost :func:`scratch` was entered.
_MADE: list[list[str]] = []


def _new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"
    for made in _MADE:
        made.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so later steps never repeat what is above.

    Each call has a folder of its own below the application's. :func:`scratch` removes
    them; expire those of other callers and of ended applications by age.
    """
    path = _new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(frames: Iterator[DataFrame], name: str) -> DataFrame | None:
    """The rows of all ``frames``, each written before the next one is made; None without a frame."""
    path = schema = None
    for df in frames:
        spark = df.sparkSession
        path = path or _new_folder(spark, name)
        schema = df.schema
        df.write.mode("append").parquet(path)
    return None if path is None else spark.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`stored`."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Folders made within, all but the last of which are removed at its end: that one is the result."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.pop()
    for path in made[:-1]:
        remove(spark, path)
    del made[:-1]


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text, text_hash``: a null text is empty, and the pair names a row.

    Rows that share both are repeats of one row, whatever their order.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` but for the rows named by ``rows`` (``doc_id, text_hash``), all columns kept."""
    doc, key = fresh(docs, "doc", "key")
    named = rows.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(key)).distinct()
    return docs.join(named, same_row(doc, key), "left_anti")


def repeated(rows: DataFrame, copies: str, block: int = 100_000) -> DataFrame:
    """Every row as many times as its column ``copies`` says, which goes; the copies are dealt over tasks in blocks.

    The column only has to be small for most rows: one thin shuffle by the other columns and the
    block keeps the copies of a single row from being made by a single task.
    """
    begin, copy = fresh(rows, "from", "copy")
    kept = [c for c in rows.columns if c != copies]
    n = F.col(copies).cast("bigint")
    dealt = rows.withColumn(begin, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(block).cast("bigint"))))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, lest the small blocks be put together again
    dealt = dealt.repartition(tasks, begin, *[c for c in ("doc_id", "text_hash") if c in kept])
    return dealt.withColumn(copy, F.explode(F.sequence(F.col(begin), F.least(F.col(begin) + block, n) - 1))).select(*kept)


def small(text) -> Column:
    """``text`` with A-Z in small letters; other letters may change too, but none becomes one of a-z.

    The two characters beyond ASCII whose small form has a letter of a-z are put out of the way first.
    """
    return F.lower(F.replace(F.replace(text, F.lit("\u212a"), F.lit("\u0101")), F.lit("\u0130"), F.lit("\u0101")))


def same_row(doc: str, key: str):
    """A row of ``documents`` is the one that columns ``doc`` and ``key`` name."""
    return F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(key))


# --- texts of an Arrow batch as arrays ------------------------------------------------------

_BYTE = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of a word: digits, letters, and all bytes of characters beyond ASCII.
ALNUM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTE >= 128)
#: Bytes of a word cut at ASCII white space alone.
NOT_SPACE = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, for rolling hashes of up to ``n`` places."""
    return _Powers.of(n)


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next beyond 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string column, without a copy."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def shards(offsets: np.ndarray, size: int):
    """Ranges ``[i, j)`` of texts that hold about ``size`` bytes; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(raw: np.ndarray, offsets: np.ndarray, kept: np.ndarray = ALNUM, breaks: np.ndarray | None = None):
    """Start and end byte of every word, its 64-bit hash, and per text the number of the first word.

    ASCII capitals count as small letters. ``raw`` holds the texts of ``offsets`` one after the other.
    A word also ends where ``breaks``, one flag for each byte, says that another begins.
    """
    n = len(raw)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = kept[raw]
    edge = np.empty(n, bool)  # a word begins
    edge[0] = inside[0]
    edge[1:] = inside[1:] & ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    edge[firsts] = inside[firsts]
    if breaks is not None:
        edge |= breaks & inside
    starts = np.flatnonzero(edge)
    last = np.empty(n, bool)
    last[-1] = inside[-1]
    last[:-1] = inside[:-1] & (~inside[1:] | edge[1:])
    ends = np.flatnonzero(last) + 1
    up, down = _Powers.of(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    hashes = mixed(value ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return starts, ends, hashes, np.searchsorted(starts, offsets)
