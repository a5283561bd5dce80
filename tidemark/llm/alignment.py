"""Cross-tokenizer alignment: which tokens of two vocabularies share bytes, and which pairs go together.

Both token sequences of a text cover the same bytes. Byte offsets where a token of
each ends cut them into groups, all pairs of a group are linked, and a pair
counts once for every document that holds it.

The work is a monoid of fragments. A byte range ``(lo, hi]`` of a text holds the
tokens that end in it, whatever ranges they begin in: an open prefix up to the
first common end, closed groups, and an open suffix behind the last. Two
neighbours compose by closing the left one's suffix with the right one's prefix,
which is associative, so the fragments of a very long document are made in
different tasks and composed in a tree. Texts of at most ``CHUNK_BYTES`` are one
range, and the texts a task reads are worked on together, units of them that it has met not encoded again. To encode a range
alone it is widened to places where both tokenizers begin anew: a blank
before a character that is neither white space nor the mark of a blank, not
behind a blank. A run without such a place is encoded as one.

Pairs are counted by partial sums per task. Those of many documents, ``HEAD`` at
most, go to the tasks as a sorted table; the others, each in fewer documents than the
first, meet their counts in a join. No ids of a document are shuffled but those of long ones.

A null or empty text, and one that either tokenizer does not give back byte by byte,
has no tokens: zeros and an empty ``groups_sha256``. A repeated row is a
document of its own, a null doc_id is kept, other columns are not read, and an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buffers, byte_letters, mixed, powers, shards, stored

CHUNK_BYTES = 65_536
SHARD_BYTES = 1_000_000
KNOWN_BYTES = 24_000_000  # of ids a task remembers
JOINED = 16_384  # bytes encoded in one call
FAN = 8  # fragments composed by one step of the tree
HEAD = 500_000  # pairs handed to every task
DIRECT = 4_096  # links of a group that are written out one by one; larger groups go by distinct ids
B_BITS = 15  # an id pair is one number: A above B

# --- the two tokenizers ---------------------------------------------------------------------

_BLANK = "▁"
#: What may stand behind a blank at a place to cut: ASCII signs, and lead bytes of blocks without white space.
_OPENS = np.zeros(256, bool)
_OPENS[33:127] = True
_OPENS[0xC3:] = True
_OPENS[0xE1:0xE4] = False


class Pair:
    """Both tokenizers, with the bytes of every entry."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {letter: n for n, letter in enumerate(byte_letters())}
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, n in entries.items():
            self.a_bytes[n] = bytes([byte_of[c] for c in entry]) if all(c in byte_of for c in entry) else entry.encode()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace(_BLANK, " ").encode()
            for n, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))
        ]
        if len(self.b_bytes) > 1 << B_BITS or len(self.a_bytes) > 1 << (31 - B_BITS):
            raise ValueError("vocabularies too large for pairs of 31 bits")
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)

    def cut(self, units: list[bytes]) -> list[tuple[np.ndarray, ...]]:
        """For A and for B: all ids of the units (which begin with a blank), where each one's begin, how many, and which come back whole."""
        regular = [len(u) > 1 and bool(_OPENS[u[1]]) and u[-1] not in (32, 0x81) for u in units]
        order = sorted(range(len(units)), key=regular.__getitem__, reverse=True)  # these may stand behind one another
        n, groups, size = sum(regular), [], JOINED
        for k in order[:n]:
            if size >= JOINED:
                groups.append([])
                size = 0
            groups[-1].append(k)
            size += len(units[k])
        groups += [[k] for k in order[n:]]
        return [self._cut(units, groups, *of) for of in ((self._a_ids, self.a_bytes, self.a_length), (self._b_ids, self.b_bytes, self.b_length))]

    def _a_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _b_ids(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode([t[1:] for t in texts], num_threads=1)  # puts the first blank in itself

    @staticmethod
    def _cut(units, groups, encode, entries, length):
        begin, count, whole = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), np.zeros(len(units), bool)
        flat, total = [], 0
        joined = [b"".join([units[k] for k in g]) for g in groups]
        alone: list = []
        of = entries.__getitem__
        for g, text, ids in zip(groups, joined, encode([t.decode() for t in joined])):
            if b"".join(map(of, ids)) != text:
                alone += g if len(g) > 1 else []
                continue
            own = np.array(ids, np.uint16)
            stops = np.searchsorted(np.cumsum(length[own]), np.cumsum([len(units[k]) for k in g]), "right")
            begin[g], whole[g] = total + np.append(0, stops[:-1]), True
            count[g] = np.diff(stops, prepend=0)
            flat.append(own)
            total += len(own)
        for k, ids in zip(alone, encode([units[k].decode() for k in alone])):
            if b"".join(map(of, ids)) == units[k]:
                begin[k], count[k], whole[k] = total, len(ids), True
                flat.append(np.array(ids, np.uint16))
                total += len(ids)
        return np.concatenate(flat) if flat else np.zeros(0, np.uint16), begin, count, whole


@lru_cache(maxsize=1)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def cuts(raw: np.ndarray) -> np.ndarray:
    """Places where both tokenizers begin anew, the first byte left out."""
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(raw[1:-1] == 32) + 1
    before = raw[at - 1]
    return at[(before != 32) & (before != 0x81) & _OPENS[raw[at + 1]]]


# --- fragments ------------------------------------------------------------------------------


class Fragment(NamedTuple):
    """Tokens that end in a byte range: before its first common end, in closed groups, behind its last one.

    ``na`` and ``nb`` are the closed groups' numbers of tokens. Without a common end all tokens are prefix.
    """

    closed: bool
    pa: np.ndarray
    pb: np.ndarray
    ga: np.ndarray
    gb: np.ndarray
    na: np.ndarray
    nb: np.ndarray
    sa: np.ndarray
    sb: np.ndarray


_NONE = np.zeros(0, np.int32)
EMPTY = Fragment(False, *[_NONE] * 8)


def fragment(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> Fragment:
    """The fragment of the tokens of one range, from their ids and the places where they end."""
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    if not len(common):
        return EMPTY._replace(pa=a, pb=b)
    i, j = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
    return Fragment(
        True, a[: i[0]], b[: j[0]], a[i[0] : i[-1]], b[j[0] : j[-1]], np.diff(i).astype(np.int32), np.diff(j).astype(np.int32), a[i[-1] :], b[j[-1] :]
    )


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``EMPTY`` as its neutral element."""
    join = lambda *parts: np.concatenate(parts)
    if not left.closed:
        return right._replace(pa=join(left.pa, right.pa), pb=join(left.pb, right.pb))
    if not right.closed:
        return left._replace(sa=join(left.sa, right.pa), sb=join(left.sb, right.pb))
    count = lambda x, y: np.array([len(x) + len(y)], np.int32)
    return Fragment(
        True, left.pa, left.pb,
        join(left.ga, left.sa, right.pa, right.ga), join(left.gb, left.sb, right.pb, right.gb),
        join(left.na, count(left.sa, right.pa), right.na), join(left.nb, count(left.sb, right.pb), right.nb),
        right.sa, right.sb,
    )


# --- what a document's groups come to -------------------------------------------------------


def _spread(count: np.ndarray) -> np.ndarray:
    """0, 1, .. for each count, one after the other."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)


def _links(doc_of: np.ndarray, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray):
    """Distinct (document, pair) as one number, in order, and the links of each."""
    many = na.astype(np.int64) * nb > DIRECT
    a_from, b_from = np.cumsum(na) - na, np.cumsum(nb) - nb
    few = np.flatnonzero(~many)
    of_a = np.repeat(few, na[few])  # the group of each A token
    at_a = np.repeat(a_from[few], na[few]) + _spread(na[few])
    times = nb[of_a]
    of_link = np.repeat(of_a, times)
    at_b = np.repeat(b_from[of_a], times) + _spread(times)
    keys = [(doc_of[of_link].astype(np.int64) << 31) | (np.repeat(a[at_a], times).astype(np.int64) << B_BITS) | b[at_b]]
    weights = [np.ones(len(of_link), np.int64)]
    for g in np.flatnonzero(many).tolist():
        x, cx = np.unique(a[a_from[g] : a_from[g] + na[g]], return_counts=True)
        y, cy = np.unique(b[b_from[g] : b_from[g] + nb[g]], return_counts=True)
        pairs = (x.astype(np.int64)[:, None] << B_BITS) | y.astype(np.int64)[None, :]
        keys.append((int(doc_of[g]) << 31) | pairs.ravel())
        weights.append((cx[:, None] * cy[None, :]).ravel())
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(weight, first) if len(first) else weight


@lru_cache(maxsize=1)
def _written() -> np.ndarray:
    """Per separator (comma, bar, semicolon) and id: the separator and the decimal id, filled up with zero bytes."""
    ids = [str(n).encode() for n in range(1 << 16)]
    return np.stack([np.array([sign + n for n in ids], "S6").view(np.uint8).reshape(-1, 6) for sign in (b",", b"|", b";")])


def _digests(groups: np.ndarray, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> list[str]:
    """The SHA-256 of each document's groups as text; ``groups`` are the documents' numbers of groups."""
    runs = np.column_stack([na, nb]).ravel().astype(np.int64)  # A and B tokens of the groups in turns
    total = int(runs.sum())
    ids, side = np.empty(total, np.int64), np.repeat(np.tile([0, 1], len(na)), runs)
    ids[side == 0], ids[side == 1] = a, b
    sign = np.zeros(total, np.int64)
    begins = np.cumsum(runs) - runs
    sign[begins[0::2]], sign[begins[1::2]] = 2, 1
    letters = _written()[sign, ids]
    flat = letters[kept := letters != 0].tobytes()
    size = np.append(0, np.cumsum(kept.sum(axis=1)))
    tokens = np.append(0, np.cumsum(runs))[np.append(0, np.cumsum(2 * groups))]  # where each document's begin
    at = size[tokens].tolist()
    return [hashlib.sha256(flat[i + 1 : j]).hexdigest() if j > i else "" for i, j in zip(at[:-1], at[1:])]


_DOCUMENT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, links array<long>"
_NAMES = [c.split()[0] for c in _DOCUMENT.split(", ")]


def _documents(rows: np.ndarray, names: pa.Array, groups: np.ndarray, a, b, na, nb) -> pa.RecordBatch:
    """Result rows of documents from their groups, one after the other."""
    n = len(groups)
    doc_of = np.repeat(np.arange(n), groups)
    total = lambda x: np.bincount(doc_of, weights=x, minlength=n).astype(np.int64)
    key, links = _links(doc_of, a, b, na, nb)
    offsets = pa.array(np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << 31).astype(np.int32))
    pairs = (key & ((1 << 31) - 1)).astype(np.int32)
    columns = [
        pa.array(rows), names, pa.array(total(na)), pa.array(total(nb)), pa.array(groups.astype(np.int64)), pa.array(total(na.astype(np.int64) * nb)),
        pa.array(_digests(groups, a, b, na, nb), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(links)),
    ]
    return pa.record_batch(columns, names=_NAMES)


# --- encoding -------------------------------------------------------------------------------


class Known:
    """Ids of the units a task has met, as sorted hashes and flat arrays of bounded size."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self._forget()

    def _forget(self) -> None:
        self.hash, self.good = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.ids = [np.zeros(0, np.uint16)] * 2  # of A and of B; where each unit's begin, and how many there are
        self.begin, self.count = [np.zeros(0, np.int32)] * 2, [np.zeros(0, np.int32)] * 2

    def _bytes(self) -> int:
        return self.hash.nbytes + self.good.nbytes + sum(x.nbytes for own in (self.ids, self.begin, self.count) for x in own)

    def find(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of all units, after those not met before were encoded, each once."""
        if self._bytes() > KNOWN_BYTES:
            self._forget()
        at = np.searchsorted(self.hash, hashes)
        new = np.flatnonzero(np.append(self.hash, np.uint64(0))[at] != hashes) if len(self.hash) else np.arange(len(hashes))
        if not len(new):
            return at
        fresh, first = np.unique(hashes[new], return_index=True)
        first = new[first]
        cut = self.pair.cut([data[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())])
        hashes_now = np.concatenate([self.hash, fresh])
        order = np.argsort(hashes_now, kind="stable")
        self.hash = hashes_now[order]
        self.good = np.concatenate([self.good, cut[0][3] & cut[1][3]])[order]
        for k, (ids, begin, count, _) in enumerate(cut):
            self.begin[k] = np.concatenate([self.begin[k], (len(self.ids[k]) + begin).astype(np.int32)])[order]
            self.count[k] = np.concatenate([self.count[k], count.astype(np.int32)])[order]
            self.ids[k] = np.concatenate([self.ids[k], ids])
        return np.searchsorted(self.hash, hashes)


def _streams(known: Known, raw: np.ndarray, offsets: np.ndarray):
    """Of texts that each begin with a blank: A and B ids, where they end in ``raw``, and which texts come back whole."""
    starts = np.union1d(cuts(raw), offsets[:-1][offsets[:-1] < offsets[1:]])
    ends = np.append(starts[1:], len(raw))[: len(starts)]
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    hashes = mixed((total[ends] - total[starts]) * down[starts] ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    unit = known.find(hashes, raw.tobytes(), starts, ends)
    text_of = np.searchsorted(offsets, starts, "right") - 1
    good = np.ones(len(offsets) - 1, bool)
    good[text_of[~known.good[unit]]] = False
    used = good[text_of]
    unit, starts, size = unit[used], starts[used], (ends - starts)[used]
    shift = starts - (np.cumsum(size) - size)  # the ids' ends are counted over the used units alone
    out = []
    for k, length in enumerate((known.pair.a_length, known.pair.b_length)):
        count = known.count[k][unit]
        own = known.ids[k][np.repeat(known.begin[k][unit], count) + _spread(count)].astype(np.int32)
        out += [own, np.cumsum(length[own]) + np.repeat(shift, count)]
    return *out, good


def _with_blanks(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text that is not empty with a blank in front."""
    size = np.diff(offsets)
    at = offsets + np.append(0, np.cumsum(size > 0))
    out = np.full(at[-1], 32, np.uint8)
    out[np.repeat((at[:-1] + (size > 0)) - offsets[:-1], size) + np.arange(len(raw))] = raw
    return out, at


class _Numbers:
    """Row numbers no other task gives."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 40

    def take(self, n: int) -> np.ndarray:
        self.next += n
        return np.arange(self.next - n, self.next)


def _short(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents of one range."""

    def align(batches):
        known, numbers = Known(_pair(a_path, b_path)), _Numbers()
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            for i, j in shards(offsets, SHARD_BYTES):
                data, at = _with_blanks(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                a, a_end, b, b_end, _ = _streams(known, data, at)
                one = fragment(a, b, a_end, b_end)
                na, nb = np.append(len(one.pa), one.na)[: len(one.na) + one.closed], np.append(len(one.pb), one.nb)[: len(one.nb) + one.closed]
                group_end = a_end[np.cumsum(na) - 1] if one.closed else a_end[:0]
                groups = np.diff(np.searchsorted(group_end, at, "right"))
                yield _documents(numbers.take(j - i), batch.column("doc_id").slice(i, j - i), groups, a, b, na, nb)

    return texts.mapInArrow(align, _DOCUMENT)


# --- very long documents --------------------------------------------------------------------

_RANGE = "row long, doc_id long, part long, parts long, low long, high long, begin long, text binary"
_FRAGMENT = "row long, doc_id long, part long, parts long, whole boolean, closed boolean, " + ", ".join(f"{c} array<int>" for c in Fragment._fields[1:])


def _ranges(texts: DataFrame, size: int) -> DataFrame:
    """Every long text in ranges of ``size`` bytes, each widened to places to cut."""

    def split(batches):
        numbers = _Numbers()
        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())):
                data = np.frombuffer(b" " + text.as_py(), np.uint8)
                row, at = int(numbers.take(1)[0]), np.concatenate([[0], cuts(data), [len(data)]])
                parts = -(-len(data) // size)
                for k in range(parts):
                    low, high = k * size, min((k + 1) * size, len(data))
                    i, j = at[np.searchsorted(at, low, "right") - 1], at[np.searchsorted(at, high)]
                    yield pa.record_batch(
                        [pa.array([x], t) for x, t in zip((row, name, k, parts, low, high, int(i)), [pa.int64()] * 7)]
                        + [pa.array([data[i:j].tobytes()], pa.binary())],
                        names=["row", "doc_id", "part", "parts", "low", "high", "begin", "text"],
                    )

    return texts.mapInArrow(split, _RANGE)


def _fragment_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (row, doc_id, part, parts, whole, Fragment)."""
    kinds = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.list_(pa.int32())] * 8
    columns = zip(*[(*r[:5], *r[5]) for r in rows])
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["row", "doc_id", "part", "parts", "whole", *Fragment._fields])


def _fragments_of(table) -> list[tuple[int, Fragment]]:
    lists = [table.column(c).to_pylist() for c in Fragment._fields]
    return [Fragment(r[0], *(np.array(x, np.int32) for x in r[1:])) for r in zip(*lists)]


def _reduced(ranges: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One fragment for each long document."""

    def encode(batches):
        known = Known(_pair(a_path, b_path))
        for batch in batches:
            for r in batch.to_pylist():
                a, a_end, b, b_end, good = _streams(known, np.frombuffer(r["text"], np.uint8), np.array([0, len(r["text"])]))
                a_in, b_in = ((e > r["low"] - r["begin"]) & (e <= r["high"] - r["begin"]) for e in (a_end, b_end))
                part = fragment(a[a_in], b[b_in], a_end[a_in], b_end[b_in])
                yield _fragment_batch([(r["row"], r["doc_id"], r["part"], r["parts"], bool(good[0]), part)])

    def composed(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        out = EMPTY
        for one in _fragments_of(table):
            out = compose(out, one)
        row, doc, part, parts = (table.column(c)[0].as_py() for c in ("row", "doc_id", "part", "parts"))
        whole = all(table.column("whole").to_pylist())
        return pa.Table.from_batches([_fragment_batch([(row, doc, part // FAN, -(-parts // FAN), whole, out)])])

    most = ranges.agg(F.max("parts")).first()[0] or 0
    level = ranges.repartition("row", "part").mapInArrow(encode, _FRAGMENT)
    while most > 1:
        level = stored(level.groupBy("row", F.expr(f"part div {FAN}").alias("_group")).applyInArrow(composed, _FRAGMENT), "fragments")
        most = -(-most // FAN)
    return level


def _long(texts: DataFrame, a_path: str, b_path: str, size: int) -> DataFrame:
    """Documents of many ranges."""

    def finish(batches):
        for batch in batches:
            for k, one in enumerate(_fragments_of(batch)):
                a, b = np.concatenate([one.pa, one.ga]), np.concatenate([one.pb, one.gb])
                na, nb = np.append(len(one.pa), one.na), np.append(len(one.pb), one.nb)  # a text begins with a common end
                if not batch.column("whole")[k].as_py():
                    a, b, na, nb = _NONE, _NONE, _NONE, _NONE
                yield _documents(batch.column("row").slice(k, 1).to_numpy(), batch.column("doc_id").slice(k, 1), np.array([len(na)]), a, b, na, nb)

    return _reduced(stored(_ranges(texts, size), "ranges"), a_path, b_path).mapInArrow(finish, _DOCUMENT)


# --- counts over all documents --------------------------------------------------------------


def pair_counts(documents: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold each pair, and whether no pair of its A id is in more."""

    def partial(batches):
        held, size = [], 0
        give = lambda: pa.record_batch([pa.array(x) for x in np.unique(np.concatenate(held), return_counts=True)], names=["pair", "n"])
        for batch in batches:
            held.append(batch.column("pairs").flatten().to_numpy())
            size += len(held[-1])
            if size > 4_000_000:
                yield give()
                held, size = [], 0
        if size:
            yield give()

    counted = documents.select("pairs").mapInArrow(partial, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = stored(counted, "pairs")
    # At most one row for each entry of A's vocabulary.
    highest = counted.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("n").alias("highest"))
    return counted.join(F.broadcast(highest), F.shiftright("pair", B_BITS) == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _head(counted: DataFrame, most: int) -> tuple[int, pa.Table]:
    """The least power of two so that at most ``most`` pairs are in as many documents, and these pairs."""
    sizes = counted.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()  # at most 64 rows
    least = 64
    total = 0
    by_power = {r.power: r["count"] for r in sizes}
    while least and total + by_power.get(least - 1, 0) <= most:
        least -= 1
        total += by_power.get(least, 0)
    return 1 << least, counted.where(F.col("n") >= (1 << least)).toArrow()


def align(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK_BYTES, head: int = HEAD) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs`` (``doc_id, text``)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.octet_length("text") > chunk_bytes
    short = _short(texts.where(~long), a_path, b_path)
    numbered = _long(texts.where(long), a_path, b_path, chunk_bytes).withColumn("row", -F.col("row") - 1)
    documents = stored(short.unionByName(numbered), "aligned")
    counted = stored(pair_counts(documents), "pair-counts")
    least, table = _head(counted, head)
    order = np.argsort(table.column("pair").to_numpy())
    known = docs.sparkSession.sparkContext.broadcast([table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best")])
    rest_names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def looked_up(batch):
        """Links of a batch: their documents' places, pairs, numbers, and the places in the head (-1: not there)."""
        pair, n, _ = known.value
        lists = batch.column("pairs")
        of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        own, links = lists.flatten().to_numpy(), batch.column("links").flatten().to_numpy()
        at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
        return of, own, links, np.where(pair[at] == own, at, -1) if len(pair) else np.full(len(own), -1)

    def common(batches):
        _, n, best = known.value
        for batch in batches:
            of, _, links, at = looked_up(batch)
            ends = np.searchsorted(of, np.arange(batch.num_rows + 1))
            sums = []
            for each in (best, n):
                value = np.where(at >= 0, links * each[at], 0) if len(each) else np.zeros(len(links), np.int64)
                sums.append(np.diff(np.append(0, np.cumsum(value))[ends]))
            yield pa.record_batch([*[batch.column(c) for c in rest_names], pa.array(sums[0]), pa.array(sums[1])], names=[*rest_names, "n_best", "count_sum"])

    def others(batches):
        for batch in batches:
            of, own, links, at = looked_up(batch)
            rare = at < 0
            rows = batch.column("row").to_numpy()[of[rare]]
            yield pa.record_batch([pa.array(rows), pa.array(own[rare]), pa.array(links[rare])], names=["row", "pair", "links"])

    kinds = dict(c.split() for c in _DOCUMENT.split(", "))
    kept = documents.mapInArrow(common, ", ".join([*(f"{c} {kinds[c]}" for c in rest_names), "n_best long", "count_sum long"]))
    if least > 1:
        rare = (
            documents.select("row", "pairs", "links").mapInArrow(others, "row long, pair int, links long")
            .join(counted.where(F.col("n") < least), "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_best"), F.sum(F.col("links") * F.col("n")).alias("_sum"))
        )
        kept = kept.join(rare, "row", "left").withColumns(
            {"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}
        )
    return kept.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
