"""Best-fit packing by exact complements.

Documents become ids, longer ones are cut, and the pieces of one length are
interchangeable. So the plan is made on the histogram of lengths, which has at
most ``capacity`` entries however many documents there are: the longest open
length is put down, and the gap it leaves is looked up in an index of the sums of
single lengths, pairs and triples. As many sequences are made that way as the
available counts allow, which the index follows. What has no exact complement is
filled best-fit. A step uses up at least one length for its pattern, so the plan
stays that small.

Each piece then finds its place by its running number among the pieces of its
length: tasks number their own pieces, and the tasks' counts per length give
where each begins. No sort, no window over a length, no group in one task.

Null texts are empty, an empty text is one piece of one id, a repeated row is
packed again, a null doc_id is kept, other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE, buffers, byte_letters, shards, stored, words

CAPACITY = 2048
KNOWN_BYTES = 24_000_000  # of the ids a worker remembers, checked before every shard
SHARD_BYTES = 1_000_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_LETTERS = byte_letters()
_PLAIN = re.compile("[a-z]+")
_LATIN = re.compile("[a-zß-öø-ÿ]+")
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b".,;:!?")] = True


class Ids:
    """Ids of texts, part by part of the words between ASCII white space.

    The tokenizer drops white space and merges nothing across it, it cuts a sign off
    the letter before it, and it folds case, so a part's ids do not depend on what
    surrounds it nor on its capitals. Parts are told apart by a 64-bit hash; those not
    met before are cut into ids once, all others are looked up for a whole shard at a
    time. What is remembered are flat arrays of at most ``KNOWN_BYTES`` and one shard. Texts
    with the first signs of a special token go through the tokenizer as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._forget()

    def _forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)  # sorted; where the ids of each begin in `ids`, and how many
        self.begin = self.count = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint16)

    def of(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a shard."""
        if self.hash.nbytes + self.begin.nbytes + self.count.nbytes + self.ids.nbytes > KNOWN_BYTES:
            self._forget()
        signs = np.zeros(len(raw), bool)
        signs[1:] = _SIGN[raw[1:]] & _LETTER[raw[:-1]]
        starts, ends, hashes, firsts = words(raw, offsets, NOT_SPACE, signs)
        whole = raw.tobytes()
        at = self._places(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            unique, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            self._learn(unique, [whole[i:j].lower() for i, j in zip(starts[first].tolist(), ends[first].tolist())])
            at = self._places(hashes)
        count = self.count[at].astype(np.int64)
        total = np.cumsum(count)
        step = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)
        ids = self.ids[np.repeat(self.begin[at], count) + step].astype("<u4")
        bounds = np.append(0, total)[firsts]
        out = [ids[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        if b"<|" in whole:
            for k, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if b"<|" in whole[i:j]:
                    out[k] = np.array(self.tokenizer.encode(whole[i:j].decode(), add_special_tokens=False).ids, "<u4")
        return out

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is known, or -1."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at, -1)

    def _learn(self, unique: np.ndarray, parts: list[bytes]) -> None:
        ids = self._cut(parts)
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        begin = (len(self.ids) + np.cumsum(count) - count).astype(np.int32)
        flat = np.fromiter(chain.from_iterable(ids), np.uint16, int(count.sum()))
        hashes = np.concatenate([self.hash, unique])
        order = np.argsort(hashes, kind="stable")
        self.hash = hashes[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, flat])

    def _cut(self, parts: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each part. Plain Latin letters are one piece as they stand, so the vocabulary's model is asked itself."""
        model, out, others = self.tokenizer.model, [], []
        for n, part in enumerate(parts):
            text = part.decode()
            if not _PLAIN.fullmatch(text):
                text = text.lower()
                text = "".join([_LETTERS[byte] for byte in text.encode()]) if _LATIN.fullmatch(text) else None
            if text is None:
                others.append(n)
                out.append(())
            else:
                out.append(tuple([t.id for t in model.tokenize(text)]))
        for at in range(0, len(others), 10_000):
            group = others[at : at + 10_000]
            found = self.tokenizer.encode_batch([parts[n].decode() for n in group], add_special_tokens=False)
            for n, e in zip(group, found):
                out[n] = tuple(e.ids)
        return out


_PIECES = "task int, doc_id long, piece int, start long, length long, ids_crc32 long, number long"


@lru_cache(maxsize=1)
def _remembered(path: str) -> Ids:
    """What a worker knows, over all tasks it is used for; results never depend on it."""
    return Ids(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """All pieces with the task that cut them and their running number among its pieces of that length."""

    def cut(batches):
        ids, task = _remembered(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.zeros(1, "<u4")
        for b in batches:
            names = b.column("doc_id").to_pylist()
            raw, offsets = buffers(b.column("text"))
            for i, j in shards(offsets, SHARD_BYTES):
                rows = []
                for name, own in zip(names[i:j], ids.of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])):
                    own = np.concatenate([own, end])
                    for k, start in enumerate(range(0, len(own), capacity)):
                        part = own[start : start + capacity]
                        rows.append((name, k, start, len(part), zlib.crc32(part), int(seen[len(part)])))
                        seen[len(part)] += 1
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(np.full(len(rows), task, np.int32))] + [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.record_batch(arrays, names=["task", "doc_id", "piece", "start", "length", "ids_crc32", "number"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(cut, _PIECES)


# --- the plan -------------------------------------------------------------------------------


class Sums:
    """Index from a sum to the length, the pair or the three lengths that make it, under the counts left.

    For each sum asked for it keeps how far its pairs and triples were consumed, the
    longest first. Counts only fall, so a combination that failed never comes back and
    no entry is looked at twice.
    """

    def __init__(self, count: np.ndarray):
        self.count = count
        self.pairs: dict[int, int] = {}  # sum to the longest length of a pair that may still be there
        self.triples: dict[int, int] = {}

    def find(self, total: int) -> list[int] | None:
        """At most three available lengths that add up to ``total``."""
        if self.count[total]:
            return [total]
        return self._pair(total) or self._triple(total)

    def _longest(self, total: int, most: int) -> int:
        """The longest length up to ``most`` that makes an available pair; 0 if there is none."""
        a = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
        fits = (self.count[a] > 0) & (self.count[total - a] > (a == total - a))
        at = int(np.argmax(fits)) if len(a) else 0
        return int(a[at]) if len(a) and fits[at] else 0

    def _pair(self, total: int) -> list[int] | None:
        longest = self.pairs[total] = self._longest(total, self.pairs.get(total, total))
        return [longest, total - longest] if longest else None

    def _triple(self, total: int) -> list[int] | None:
        longest = self.triples.get(total, total - 2)
        while 3 * longest >= total > 2:
            if self.count[longest]:
                self.count[longest] -= 1
                second = self._longest(total - longest, longest)
                self.count[longest] += 1
                if second:
                    self.triples[total] = longest
                    return [longest, second, total - longest - second]
            longest -= 1
        self.triples[total] = 0
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (the lengths of one sequence) and how many sequences have each."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    patterns, sums = [], Sums(count)
    for longest in range(capacity, 0, -1):
        while count[longest]:
            pattern, gap = [longest], capacity - longest
            count[longest] -= 1
            while gap:
                exact = sums.find(gap)
                if exact:
                    taken = exact
                else:  # best fit: the longest that goes in, then ask again
                    fits = np.flatnonzero(count[: gap + 1])
                    if not len(fits):
                        break
                    taken = [int(fits[-1])]
                for x in taken:
                    count[x] -= 1
                    gap -= x
                pattern += taken
            # As many more sequences of the same pattern as the counts allow.
            used = np.bincount(pattern, minlength=capacity + 1)
            at = np.flatnonzero(used)
            more = int((count[at] // used[at]).min())
            count[at] -= more * used[at]
            patterns.append((pattern, more + 1))
    return patterns


class Places:
    """The plan as a lookup: from length and running number to sequence and offset."""

    def __init__(self, patterns: list[tuple[list[int], int]], capacity: int):
        begin = np.zeros(capacity + 1, np.int64)  # numbers of a length already given away
        rows, sequence = [], 0
        for pattern, times in patterns:
            offset = 0
            for length in pattern:
                rows.append((length, begin[length], sequence, offset))
                begin[length] += times
                offset += length
            sequence += times
        rows.sort()
        self.length, self.begin, self.sequence, self.offset = (np.array(c, np.int64) for c in (zip(*rows) if rows else [[]] * 4))
        self.group = np.searchsorted(self.length, np.arange(capacity + 2))
        self.capacity = capacity

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        bounds = np.flatnonzero(np.diff(length[order], prepend=-1, append=self.capacity + 1))
        for i, j in zip(bounds[:-1], bounds[1:]):
            one = order[i:j]
            low, high = self.group[length[one[0]]], self.group[length[one[0]] + 1]
            at[one] = low + np.searchsorted(self.begin[low:high], number[one], side="right") - 1
        return self.sequence[at] + number - self.begin[at], self.offset[at]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of ``docs`` (``doc_id, text``)."""
    cut = stored(pieces(docs, tokenizer_path, capacity), "pieces")
    per_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per length comes to the driver.
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places(plan(histogram, capacity), capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    begins = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))

    def place(batches):
        found = places.value
        for b in batches:
            number = b.column("number").to_numpy() + b.column("begin").to_numpy()
            sequence, offset = found.find(b.column("length").to_numpy(), number)
            kept = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return cut.join(begins, ["task", "length"]).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
