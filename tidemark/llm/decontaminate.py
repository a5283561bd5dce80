"""Benchmark decontamination with suffix arrays of the training texts.

Every task cuts the texts it reads into shards and builds one suffix array over
the words of each: suffixes are put in order by doubling, as deep as the longest
benchmark item, since no question asked of them is longer. Every suffix of every
item is then searched in every shard by bisection, all suffixes at once and one
word deeper each step. The interval a suffix ends in holds all places of its
longest verbatim match; the interval at the window's length holds all places of
the window. A text lies in one shard as a whole, so its result is complete there.

Words are compared by 64-bit hashes. Items are a stated query set: they go to
the tasks in blocks of at most ``BLOCK_BYTES``, and with more than one block the
blocks' spans are united per document.

Null texts have no words; a document or item without words meets nothing. A row
that occurs twice is two rows with the same result; items of one id are one item;
an item without id marks words but is not named. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buffers, keyed_texts, repeated, shards, stored, without, words

WINDOW = 10
SHARD_BYTES = 4_000_000
BLOCK_BYTES = 32_000_000


class SuffixArray:
    """The suffixes of a shard's words, in order of their first ``depth`` words."""

    def __init__(self, word: np.ndarray, depth: int):
        self.word = word
        n = len(word)
        order = np.argsort(word, kind="stable")
        sorted_words = word[order]
        rank = np.empty(n + 1, np.int64)
        rank[n] = -1  # behind the last word
        known = 1
        new = np.ones(n, bool)
        new[1:] = sorted_words[1:] != sorted_words[:-1]
        heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = heads
        slots = np.arange(n)
        while known < depth and n:
            # Only groups of equal suffixes are sorted on, by the rank of what follows them.
            single = new & np.append(new[1:], True)
            slots, heads = slots[~single], heads[~single]
            if not len(slots):
                break
            members = order[slots]
            after = rank[np.minimum(members + known, n)]
            place = np.lexsort((after, heads))
            members, after = members[place], after[place]
            order[slots] = members
            new = np.ones(len(slots), bool)
            new[1:] = (heads[1:] != heads[:-1]) | (after[1:] != after[:-1])
            heads = np.maximum.accumulate(np.where(new, slots, 0))
            rank[members] = heads
            known *= 2
        self.order = order

    def search(self, word: np.ndarray, first: np.ndarray, length: np.ndarray, need: np.ndarray):
        """For each asked suffix: matched words, the interval of that match, and the interval at ``need`` words.

        ``word`` holds the items' words; suffix i is ``length[i]`` words from ``first[i]``.
        """
        n, asked = len(self.order), len(first)
        low, high = np.zeros(asked, np.int64), np.full(asked, n, np.int64)
        matched = np.zeros(asked, np.int64)
        at_low, at_high = np.zeros(asked, np.int64), np.zeros(asked, np.int64)
        live = np.flatnonzero(length > 0) if n else np.zeros(0, np.int64)
        depth = 0
        while len(live):
            sought = word[first[live] + depth]
            lo = self._bound(low[live], high[live], sought, depth, False)
            hi = self._bound(lo, high[live], sought, depth, True)
            found = lo < hi
            live, lo, hi = live[found], lo[found], hi[found]
            depth += 1
            low[live], high[live], matched[live] = lo, hi, depth
            full = live[need[live] == depth]
            at_low[full], at_high[full] = low[full], high[full]
            live = live[length[live] > depth]
        return matched, low, high, at_low, at_high

    def _bound(self, low, high, sought, depth, above):
        low, high = low.copy(), high.copy()
        last = len(self.word) - 1
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            at = self.order[mid] + depth
            value = self.word[np.minimum(at, last)]
            less = (value <= sought[todo]) if above else (value < sought[todo])
            less |= at > last  # the shard ends: smaller than any word
            low[todo[less]] = mid[less] + 1
            high[todo[~less]] = mid[~less]
            todo = todo[low[todo] < high[todo]]
        return low


def _shard_words(raw: np.ndarray, offsets: np.ndarray):
    """Word hashes with one zero behind each text, the first slot of each text, its number of words."""
    _, _, hashes, firsts = words(raw, offsets)
    counts = np.diff(firsts)
    begins = firsts[:-1] + np.arange(len(counts))
    stream = np.zeros(len(hashes) + len(counts), np.uint64)
    slots = np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)
    stream[slots] = np.where(hashes == 0, np.uint64(1), hashes)
    return stream, begins, counts


class Items:
    """One block of benchmark items as the suffixes asked for."""

    def __init__(self, ids: list, texts: list[str], window: int):
        _, _, hashes, firsts = words(*buffers(pa.array(texts, pa.string())))
        sizes = np.diff(firsts)
        self.names = ids
        self.word = np.where(hashes == 0, np.uint64(1), hashes)
        self.item = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.arange(len(hashes))
        self.length = firsts[1:][self.item] - self.first if len(hashes) else np.zeros(0, np.int64)
        # A window is `window` words, or a shorter item as a whole: only its first suffix is one then.
        short = np.minimum(sizes, window)[self.item] if len(hashes) else np.zeros(0, np.int64)
        self.need = np.where(self.length >= short, short, -1)
        self.depth = int(sizes.max()) if len(sizes) else 0


def item_blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """The items, split by a hash into blocks of about ``block_bytes``, read one by one: how many, and the blocks."""
    kept = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = kept.agg(F.sum(F.octet_length("text").cast("bigint")).alias("b")).first()["b"] or 0
    blocks = total // block_bytes + 1

    def read():
        for k in range(blocks):
            rows = kept.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).toArrow()
            yield Items(rows["item_id"].to_pylist(), rows["text"].to_pylist(), window)

    return blocks, read()


def _each_block(benchmark: DataFrame, window: int, block_bytes: int, search) -> list[DataFrame]:
    """What ``search`` finds for every block; with several, each is written before the next one is read."""
    blocks, items = item_blocks(benchmark, window, block_bytes)
    if blocks == 1:
        return [search(next(items))]
    return [stored(search(block), "block") for block in items]


_SPANS = "doc_id long, text_hash long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _contamination(texts: DataFrame, block: Items, shard_bytes: int) -> DataFrame:
    """Per document the words any window of the block covers, as disjoint spans, and the items they come from."""
    sent = texts.sparkSession.sparkContext.broadcast(block)

    def search(batches):
        asked = sent.value
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            for i, j in shards(offsets, shard_bytes):
                stream, begins, counts = _shard_words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                array = SuffixArray(stream, asked.depth)
                _, _, _, low, high = array.search(asked.word, asked.first, asked.length, asked.need)
                hit = np.flatnonzero(high > low)
                sizes = high[hit] - low[hit]
                step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                places = array.order[np.repeat(low[hit], sizes) + step]
                change = np.zeros(len(stream) + 1, np.int64)
                np.add.at(change, places, 1)
                np.add.at(change, places + np.repeat(asked.need[hit], sizes), -1)
                covered = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
                starts, ends = edges[::2], edges[1::2]  # no span crosses the zero behind a text
                owner = np.searchsorted(begins, starts, side="right") - 1
                named = np.unique(np.stack([np.searchsorted(begins, places, side="right") - 1, np.repeat(asked.item[hit], sizes)]), axis=1)
                spans: list = [[] for _ in range(j - i)]
                items: list = [set() for _ in range(j - i)]
                for d, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist()):
                    spans[d].append({"start": s - int(begins[d]), "end": e - int(begins[d])})
                for d, k in zip(*named.tolist()):
                    if asked.names[k] is not None:
                        items[d].add(asked.names[k])
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        batch.column("text_hash").slice(i, j - i),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "text_hash", "n_words", "spans", "items"],
                )

    return texts.mapInArrow(search, _SPANS)


def _united(parts: list[DataFrame]) -> DataFrame:
    """Spans of several blocks as the disjoint spans of each document, which meet in one task."""
    rows = reduce(DataFrame.unionByName, parts)
    own = rows.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
    )

    def unite(batches):
        for b in batches:
            merged = []
            for spans in b.column("spans").to_pylist():
                merged.append([])
                for s in spans:
                    if merged[-1] and merged[-1][-1]["end"] >= s["start"]:
                        merged[-1][-1]["end"] = max(merged[-1][-1]["end"], s["end"])
                    else:
                        merged[-1].append(s)
            yield b.set_column(3, "spans", pa.array(merged, b.schema.field("spans").type))

    once = own.select("doc_id", "text_hash", "n_words", "spans", "items", "copies")
    return repeated(once, "copies").mapInArrow(unite, _SPANS)


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every row of ``docs`` with its number of words, the word spans found in the benchmark, and the items (as text)."""
    texts = keyed_texts(docs)
    parts = _each_block(benchmark, window, block_bytes, lambda block: _contamination(texts, block, shard_bytes))
    return parts[0] if len(parts) == 1 else _united(parts)


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The longest verbatim match of every item suffix within a shard, at each of its places, if it fills a window.

    ``item_id, item_start, doc_id, doc_start, n_words`` in words. A match that the suffix one word
    earlier has at the same place too is not listed again.
    """
    texts = keyed_texts(docs)

    def found(block: Items) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches):
            asked = sent.value
            for batch in batches:
                raw, offsets = buffers(batch.column("text"))
                ids = batch.column("doc_id").to_pylist()
                for i, j in shards(offsets, shard_bytes):
                    stream, begins, _ = _shard_words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    array = SuffixArray(stream, asked.depth)
                    matched, low, high, _, _ = array.search(asked.word, asked.first, asked.length, asked.need)
                    hit = np.flatnonzero((asked.need > 0) & (matched >= asked.need))
                    sizes = high[hit] - low[hit]
                    suffix = np.repeat(hit, sizes)
                    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    places = array.order[np.repeat(low[hit], sizes) + step]
                    start = asked.first[suffix] - np.searchsorted(asked.item, asked.item[suffix])
                    left = (start > 0) & (places > 0)
                    left &= asked.word[np.maximum(asked.first[suffix] - 1, 0)] == stream[np.maximum(places - 1, 0)]
                    own = np.searchsorted(begins, places, side="right") - 1
                    keep = np.flatnonzero(~left)
                    yield pa.record_batch(
                        [
                            pa.array([asked.names[k] for k in asked.item[suffix[keep]]], pa.string()),
                            pa.array(start[keep], pa.int64()),
                            pa.array([ids[i + d] for d in own[keep]], pa.int64()),
                            pa.array(places[keep] - begins[own[keep]], pa.int64()),
                            pa.array(matched[suffix[keep]], pa.int64()),
                        ],
                        names=["item_id", "item_start", "doc_id", "doc_start", "n_words"],
                    )

        return texts.mapInArrow(search, "item_id string, item_start long, doc_id long, doc_start long, n_words long")

    return reduce(DataFrame.unionByName, _each_block(benchmark, window, block_bytes, found))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of :func:`contaminated_spans`: one row per document with counts and the hash of its items."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return contaminated_spans(docs, benchmark, **options).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents without any window of the benchmark, all columns kept."""
    return without(docs, contaminated_spans(docs, benchmark, **options).where(F.size("spans") > 0))
