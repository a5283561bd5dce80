"""Repeated passages by sparse suffix arrays.

Of every text only the suffixes at minimiser positions are kept: places whose
hash of ``GRAM`` words is the smallest within ``SPACING`` neighbouring places. Any
passage of ``MIN_WORDS`` words holds such a place with ``CORE`` words behind it
inside the passage, and two copies of the passage hold it at the same word. So
suffixes are grouped by the hash of their first ``CORE`` words, and those alone
in their group are gone after one aggregation.

What a suffix in a larger group repeats is settled in three steps:

1. Suffixes whose whole context (``SIDE`` words left and right of the core) occurs
   again are repeats throughout. Exact copies, in whatever number, end here.
2. One suffix of every other context is sorted by what follows the core, over
   the whole cluster, and compared with its neighbours: the match goes as far to
   the right as any; a second sort by what precedes the core does the same to the
   left. A match counts if it holds ``MIN_WORDS`` words with its extensions.
3. Where the two neighbours leave room for a third that shares less on either
   side, but enough together, all windows of ``MIN_WORDS`` words around the core
   are counted by hash.

Sorts are by content, then place, so no key is ever one task's; only the two rows
at each border of a sorted part meet on the driver. The union of a text's matches
are its repeated passages. Words are digits, letters and all characters beyond
ASCII, capitals A-Z as small letters, compared by 64-bit hashes (32 bits in the
words beside a core).

Null and empty texts have no passage, nor have texts below ``MIN_WORDS`` words. A
row that occurs twice repeats itself. A null doc_id is a value, and never the
first place. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buffers, fresh, keyed_texts, mixed, same_row, shards, stored, words

MIN_WORDS = 50
CORE = 26
SPACING = MIN_WORDS - CORE + 1
SIDE = MIN_WORDS - CORE
GRAM = 4
SHARD_BYTES = 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place; places too near the end are left out."""
    n = len(word) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done = np.zeros(n, np.uint64), 0
    part, width = word, 1  # hashes of runs of 1, 2, 4 ... words, put together by the bits of `size`
    while True:
        if size & width:
            out = mixed(out * _ODD + part[done : done + n] + np.uint64(width))
            done += width
        if 2 * width > size:
            return out
        part = mixed(part[:-width] * _ODD + part[width:])
        width *= 2


def _slid(values: np.ndarray, size: int, smaller) -> np.ndarray:
    """Smallest (or largest) of the ``size`` values from each place."""
    part, width = values, 1
    while 2 * width <= size:
        part = smaller(part[:-width], part[width:])
        width *= 2
    n = len(values) - size + 1
    return smaller(part[:n], part[size - width : size - width + n])


def anchors(word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimiser places with at least ``CORE`` words of their text from there on.

    ``word`` holds texts one after the other, ``begin`` and ``end`` say for each word where its text lies. Texts
    below ``MIN_WORDS`` words have none.
    """
    if len(word) < MIN_WORDS:
        return np.zeros(0, np.int64)
    order = mixed(run_hashes(word, GRAM))
    low = _slid(order, SPACING, np.minimum)
    low[np.arange(len(low)) + SPACING - 1 + GRAM > end[: len(low)]] = 0  # a window of two texts chooses nothing
    # A place is one if it is the smallest of some window that holds it.
    sides = np.zeros(SPACING - 1, np.uint64)
    places = np.flatnonzero(order == _slid(np.concatenate([sides, low, sides]), SPACING, np.maximum))
    return places[(places + CORE <= end[places]) & (end[places] - begin[places] >= MIN_WORDS)]


def _sides(word: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the ``SIDE`` words before each core (nearest first) and behind it; zero beyond the text."""
    short = (word >> np.uint64(32)).astype(np.uint32)
    short[short == 0] = 1
    step, last = np.arange(SIDE), len(word) - 1
    left, right = at[:, None] - 1 - step, at[:, None] + CORE + step
    return (
        np.where(left >= begin[at, None], short[np.maximum(left, 0)], 0).astype(np.uint32),
        np.where(right < end[at, None], short[np.minimum(right, last)], 0).astype(np.uint32),
    )


def _around(core: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of a core and all that stands beside it."""
    whole = core
    for side in (*left.T, *right.T):
        whole = mixed(whole * _ODD + side)
    return whole


def _each_shard(batch: pa.RecordBatch):
    """First row of each shard, its words, the row (from there), and begin and end of the text of each word."""
    raw, offsets = buffers(batch.column("text"))
    for i, j in shards(offsets, SHARD_BYTES):
        _, _, hashes, firsts = words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        row = np.repeat(np.arange(j - i), np.diff(firsts))
        yield i, j, hashes, firsts, row


def _bytes_column(values: np.ndarray) -> pa.Array:
    """Rows of 32-bit values as binary that sorts like them."""
    data = np.ascontiguousarray(values.astype(">u4"))
    offsets = np.arange(len(data) + 1, dtype=np.int32) * (4 * SIDE)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _matrix(column: pa.Array) -> np.ndarray:
    """The inverse of :func:`_bytes_column`, for a column without nulls."""
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros((0, SIDE), np.uint32)
    start = int(np.frombuffer(offsets, np.int32)[column.offset])
    return np.frombuffer(data, ">u4", len(column) * SIDE, start).reshape(-1, SIDE).astype(np.uint32)


_SUFFIX = "doc_id long, text_hash long, place int, right_words int, core long, around long"


def suffixes(texts: DataFrame) -> DataFrame:
    """Every kept suffix with the hash of its core and of its context, and the words of the text in that behind the core."""

    def cut(batches):
        for b in batches:
            for i, _, word, firsts, row in _each_shard(b):
                begin, end = firsts[row], firsts[row + 1]
                at = anchors(word, begin, end)
                core = run_hashes(word, CORE)[at]
                around = _around(core, *_sides(word, at, begin, end))
                own = pa.array(i + row[at])
                yield pa.record_batch(
                    [
                        b.column("doc_id").take(own),
                        b.column("text_hash").take(own),
                        pa.array((at - begin[at]).astype(np.int32)),
                        pa.array(np.minimum(end[at] - at - CORE, SIDE).astype(np.int32)),
                        pa.array(core.view(np.int64)),
                        pa.array(around.view(np.int64)),
                    ],
                    names=["doc_id", "text_hash", "place", "right_words", "core", "around"],
                )

    return texts.mapInArrow(cut, _SUFFIX)


_CONTEXT = "doc_id long, text_hash long, place int, core long, around long, before binary, behind binary"


def contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words beside the core of the ``wanted`` suffixes (``doc_id, text_hash, place``), as sortable bytes."""
    places = wanted.groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set("place").alias("places")  # places of one text
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    both = texts.join(places, same).select("doc_id", "text_hash", "text", "places")

    def read(batches):
        for b in batches:
            wanted, lists = b.column("places").flatten().to_numpy(), np.diff(b.column("places").offsets.to_numpy())
            reach = np.concatenate([[0], np.cumsum(lists)])
            for i, j, word, firsts, row in _each_shard(b):
                own = np.repeat(np.arange(j - i), lists[i:j])
                at = firsts[own] + wanted[reach[i] : reach[j]]
                begin, end = firsts[row], firsts[row + 1]
                core = run_hashes(word, CORE)[at]
                left, right = _sides(word, at, begin, end)
                rows = pa.array(i + own)
                yield pa.record_batch(
                    [
                        b.column("doc_id").take(rows),
                        b.column("text_hash").take(rows),
                        pa.array((at - begin[at]).astype(np.int32)),
                        pa.array(core.view(np.int64)),
                        pa.array(_around(core, left, right).view(np.int64)),
                        _bytes_column(left),
                        _bytes_column(right),
                    ],
                    names=["doc_id", "text_hash", "place", "core", "around", "before", "behind"],
                )

    return both.mapInArrow(read, _CONTEXT)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal words from the start of each row; a zero is the end of a text and equals nothing."""
    return np.logical_and.accumulate((a == b) & (a != 0), axis=1).sum(axis=1)


def _far(core: np.ndarray, main: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order: the longest match of ``main`` with a neighbour of the same core, and that one's of ``other``.

    Of the two neighbours the one with the longer match counts, at a tie the longer other side.
    """
    same = core[1:] == core[:-1]
    reach = np.where(same, _common(main[1:], main[:-1]), -1)
    beside = np.where(same, _common(other[1:], other[:-1]), -1)
    both = np.maximum(np.append(-1, reach * 100 + beside), np.append(reach * 100 + beside, -1))
    return np.where(both < 0, -1, both // 100), np.where(both < 0, -1, both % 100)


_REACH = "core long, around long, reach int, beside int, part int, edge int, main binary, other binary"


def neighbours(suffix: DataFrame, main: str, other: str) -> DataFrame:
    """``core, around, reach, beside``: each suffix compared with its neighbours in the order of core and ``main`` side."""
    # One row per context, so this order is total and parts can end anywhere within a core.
    ordered = suffix.select("core", "around", main, other).repartitionByRange("core", main, other, "around").sortWithinPartitions("core", main, other, "around")

    def compare(batches):
        part, kept, begun = TaskContext.get().partitionId(), None, False
        for b in batches:
            if b.num_rows:
                whole = b if kept is None else pa.concat_batches([kept, b])
                # The last row waits for its follower; it and its predecessor go on to the next batch.
                yield compared(whole, 0 if kept is None else kept.num_rows - 1, whole.num_rows - 1, part, not begun)
                begun = begun or whole.num_rows > 1
                kept = whole.slice(max(0, whole.num_rows - 2))
        if kept is not None:
            yield compared(kept, kept.num_rows - 1, kept.num_rows, part, not begun, True)

    def compared(rows, start, end, part, first, last=False):
        """Rows ``start`` to ``end`` with their reach; ``first`` and ``last`` say that these are the part's."""
        core, ours, theirs = rows.column(0).to_numpy(), _matrix(rows.column(2)), _matrix(rows.column(3))
        reach, beside = (x[start:end].astype(np.int32) for x in _far(core, ours, theirs))
        out = rows.slice(start, end - start)
        edge = np.zeros(len(reach), np.int32)
        if len(edge):
            edge[0] += first
            edge[-1] += 2 * last
        only_edges = []  # what a border row needs to be compared across it
        for c in (out.column(2), out.column(3)):
            shown = [None] * len(edge)
            for k in np.flatnonzero(edge).tolist():
                shown[k] = c[k].as_py()
            only_edges.append(pa.array(shown, pa.binary()))
        parts = pa.array(np.full(len(edge), part, np.int32))
        return pa.record_batch(
            [out.column(0), out.column(1), pa.array(reach), pa.array(beside), parts, pa.array(edge), *only_edges],
            names=["core", "around", "reach", "beside", "part", "edge", "main", "other"],
        )

    found = stored(ordered.mapInArrow(compare, _REACH), f"sorted-by-{main}")
    # Two rows per sorted part, however many suffixes there are.
    border = sorted(found.where("edge > 0").collect(), key=lambda r: (r.part, r.edge))
    mended: dict = {}
    for a, b in zip(border, border[1:]):
        if a.part != b.part and a.core == b.core:
            core = np.array([a.core, b.core])
            reach, beside = _far(core, _matrix(pa.array([a.main, b.main])), _matrix(pa.array([a.other, b.other])))
            for r in (a, b):
                best = max(mended.get((r.core, r.around), (r.reach, r.beside)), (int(reach[0]), int(beside[0])))
                mended[(r.core, r.around)] = best
    plain = found.select("core", "around", "reach", "beside")
    if not mended:
        return plain
    rows = [(c, a, r, s) for (c, a), (r, s) in mended.items()]
    table = pa.table([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["core", "around", "_r", "_s"])
    better = plain.join(F.broadcast(found.sparkSession.createDataFrame(table)), ["core", "around"], "left")  # two rows per part at most
    return better.select("core", "around", F.coalesce("_r", "reach").alias("reach"), F.coalesce("_s", "beside").alias("beside"))


def _windows(suffix: DataFrame) -> DataFrame:
    """``core, around, least, most``: every window of ``MIN_WORDS`` words around a core that another context has too.

    ``least`` words left of the core and ``SIDE - least`` right of it, counted by hash.
    """

    def cut(batches):
        for b in batches:
            left, right = _matrix(b.column("before")), _matrix(b.column("behind"))
            core = b.column("core").to_numpy()
            lefts, rights = [core.view(np.uint64)], [np.zeros(len(core), np.uint64)]
            for k in range(SIDE):
                lefts.append(mixed(lefts[-1] * _ODD + left[:, k].astype(np.uint64)))
                rights.append(mixed(rights[-1] * _ODD + right[:, k].astype(np.uint64)))
            for n in range(SIDE + 1):
                inside = np.ones(len(core), bool)
                if n:
                    inside &= left[:, n - 1] != 0
                if n < SIDE:
                    inside &= right[:, SIDE - n - 1] != 0
                own = pa.array(inside)
                window = mixed(lefts[n] * _ODD + rights[SIDE - n] + np.uint64(n))
                yield pa.record_batch(
                    [b.column("core").filter(own), b.column("around").filter(own), pa.array(np.full(int(inside.sum()), n, np.int32)), pa.array(window[inside].view(np.int64))],
                    names=["core", "around", "least", "window"],
                )

    all_windows = stored(suffix.mapInArrow(cut, "core long, around long, least int, window long"), "windows")
    again = all_windows.groupBy("core", "window").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return all_windows.join(again, ["core", "window"], "left_semi").select("core", "around", "least")


def _reaches(texts: DataFrame, several: DataFrame) -> DataFrame:
    """``core, around, left_reach, right_reach`` of repeats around the cores that occur in several contexts."""
    one = several.select("core", "around", "doc_id", "text_hash", "place").dropDuplicates(["core", "around"])  # any: they are alike
    rows = stored(contexts(texts, one), "contexts")
    to_right = neighbours(rows, "behind", "before").select("core", "around", F.col("reach").alias("r"), F.col("beside").alias("rl"))
    to_left = neighbours(rows, "before", "behind").select("core", "around", F.col("reach").alias("l"), F.col("beside").alias("lr"))
    seen = stored(to_right.join(to_left, ["core", "around"]), "reaches")
    right_holds, left_holds = F.col("r") + F.col("rl") >= SIDE, F.col("l") + F.col("lr") >= SIDE
    possible = (F.col("r") >= 0) & (F.col("l") >= 0) & (F.col("r") + F.col("l") >= SIDE)
    open_cores = seen.where(possible & ~(right_holds & left_holds)).select("core").distinct()
    matched = [
        seen.where(right_holds).select("core", "around", F.col("rl").alias("left_reach"), F.col("r").alias("right_reach")),
        seen.where(left_holds).select("core", "around", F.col("l").alias("left_reach"), F.col("lr").alias("right_reach")),
    ]
    undecided = rows.join(seen.where(possible), ["core", "around"], "left_semi").join(open_cores, "core", "left_semi")
    matched.append(
        _windows(undecided).select("core", "around", F.col("least").alias("left_reach"), (F.lit(SIDE) - F.col("least")).alias("right_reach"))
    )
    return matched[0].unionByName(matched[1]).unionByName(matched[2])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start_word, end_word``: passages of ``MIN_WORDS`` words or more that occur again.

    In words from 0, ``end_word`` exclusive, overlapping matches of a text united.
    """
    texts = keyed_texts(docs)
    all_suffixes = stored(suffixes(texts), "suffixes")
    groups = all_suffixes.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("_low"), F.max("around").alias("_high"))
    kept = ["core", (F.col("_low") == F.col("_high")).alias("alike")]
    # Small tables that many rows of one core may meet are written on their own, so that the joins deal out both
    # their sides themselves and can split such a core.
    shared = stored(groups.where(F.col("n") > 1).select(*kept), "shared-cores")
    again = stored(all_suffixes.join(shared, "core"), "shared-suffixes")
    several = again.where(~F.col("alike"))
    copies = several.groupBy("core", "around").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    copied = stored(copies.select("core", "around"), "shared-contexts")
    reach = stored(_reaches(texts, several), "matches")
    # A context that occurs again is a repeat from end to end.
    left = F.least(F.col("place"), F.lit(SIDE)).alias("left_reach")
    whole = again.where("alike").unionByName(several.join(copied, ["core", "around"], "left_semi"))
    spans = whole.select("*", left, F.col("right_words").alias("right_reach")).unionByName(several.join(reach, ["core", "around"]))
    return _united(spans)


def _united(spans: DataFrame) -> DataFrame:
    """Overlapping spans of a text as one, from the spans of each text in order."""
    ordered = (
        spans.select(
            "doc_id", "text_hash", (F.col("place") - F.col("left_reach")).cast("bigint").alias("start_word"),
            (F.col("place") + CORE + F.col("right_reach")).cast("bigint").alias("end_word"),
        )
        .repartition("doc_id", "text_hash")
        .sortWithinPartitions("doc_id", "text_hash", "start_word", "end_word")
    )
    names = ordered.columns

    def unite(batches):
        held = None  # the last run, which the next batch may go on with
        for b in batches:
            rows = b if held is None else pa.concat_batches([held, b])
            if not rows.num_rows:
                continue
            runs = _runs(rows)
            yield runs.slice(0, runs.num_rows - 1)
            held = runs.slice(runs.num_rows - 1)
        if held is not None:
            yield held

    def _runs(rows: pa.RecordBatch) -> pa.RecordBatch:
        known = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
        doc = rows.column(0).fill_null(0).to_numpy()
        key, start, end = (rows.column(k).to_numpy() for k in (1, 2, 3))
        other = np.ones(len(doc), bool)
        other[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (known[1:] != known[:-1])
        above = np.cumsum(other) * (int(end.max()) + 1)  # lifts each text over the one before
        reach = np.maximum.accumulate(end + above) - above
        new = other
        new[1:] |= start[1:] >= reach[:-1]
        at = np.flatnonzero(new)
        columns = [rows.column(0).take(pa.array(at)), pa.array(key[at]), pa.array(start[at]), pa.array(np.maximum.reduceat(end, at))]
        return pa.record_batch(columns, names=names)

    return ordered.mapInArrow(unite, ordered.schema)


def _passage_windows(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """``doc_id, text_hash, place, core, window``: each ``MIN_WORDS`` words within a passage, named by two hashes."""
    of_text = passages.groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set(F.struct("start_word", "end_word")).alias("passages")  # of one text
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    both = texts.join(of_text, same).select("doc_id", "text_hash", "text", "passages")

    def cut(batches):
        for b in batches:
            spans, lists = b.column("passages").flatten(), np.diff(b.column("passages").offsets.to_numpy())
            starts, ends = (spans.field(k).to_numpy() for k in (0, 1))
            reach = np.concatenate([[0], np.cumsum(lists)])
            for i, j, word, firsts, _ in _each_shard(b):
                own = np.repeat(np.arange(j - i), lists[i:j])
                first, n = starts[reach[i] : reach[j]], ends[reach[i] : reach[j]] - starts[reach[i] : reach[j]] - MIN_WORDS + 1
                own, place = np.repeat(own, n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                at, rows = firsts[own] + place, pa.array(i + own)
                yield pa.record_batch(
                    [
                        b.column("doc_id").take(rows),
                        b.column("text_hash").take(rows),
                        pa.array(place.astype(np.int32)),
                        pa.array(run_hashes(word, CORE)[at].view(np.int64)),
                        pa.array(run_hashes(word, MIN_WORDS)[at].view(np.int64)),
                    ],
                    names=["doc_id", "text_hash", "place", "core", "window"],
                )

    return both.mapInArrow(cut, "doc_id long, text_hash long, place int, core long, window long")


def later_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start_word, end_word``: the words of all ``MIN_WORDS`` words that an earlier document has too.

    The first document of each window is that with its smallest doc_id, so a word is named only if an earlier
    document holds it within the same window, and of all its copies the earliest is never named.
    """
    windows = stored(_passage_windows(keyed_texts(docs), stored(repeated_passages(docs), "passages")), "passage-windows")
    groups = windows.groupBy("core", "window").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = stored(groups.where((F.col("n") > 1) & F.col("first").isNotNull()).select("core", "window", "first"), "first-windows")
    later = windows.join(firsts, ["core", "window"]).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    return _united(later.select("doc_id", "text_hash", "place", F.lit(0).alias("left_reach"), F.lit(SIDE).alias("right_reach")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the words of repeated passages that stand in an earlier document too.

    Of every ``MIN_WORDS`` words the document with the smallest doc_id is the first; the others lose them, so no
    word is lost to all. Copies within one document stay, as do those of rows without a doc_id alone.
    """
    cut = later_repeats(docs)
    doc, key, spans = fresh(docs, "doc", "key", "spans")
    own = cut.groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(key)).agg(
        F.collect_set(F.struct("start_word", "end_word")).alias(spans)  # of one text
    )
    joined = docs.join(own, same_row(doc, key), "left").drop(doc, key)
    names, at = docs.columns, docs.columns.index("text")

    def shorten(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for k, passages in enumerate(b.column(spans).to_pylist()):
                if passages:
                    raw = texts[k].encode()
                    starts, ends, _, _ = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    for s in sorted(passages, key=lambda x: -x["start_word"]):
                        raw = raw[: starts[s["start_word"]]] + raw[ends[s["end_word"] - 1] :]
                    texts[k] = raw.decode()
            yield b.select(names).set_column(at, "text", pa.array(texts, b.schema.field("text").type))

    return joined.mapInArrow(shorten, docs.schema)
