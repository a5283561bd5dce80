"""Language identification with a byte convolutional network.

The network sees fixed-length windows of UTF-8 bytes: filters of several widths
over one-hot bytes, the maximum of each filter over the window, and a softmax.
It is trained in numpy on a bounded sample of labelled rows, drawn by a hash of
the row, and applied to all windows of every whole text in the tasks. The sample
holds every label found: about ``SAMPLE`` rows of each, and where that is more than
``ROWS`` in all, an equal share of ``ROWS`` for each label, at least one row. A document's
probabilities are the mean over its windows, weighted by their letters.

A null text and one without any letter is ``und`` with score 0, as is every text
when there is no labelled row. Rows without a doc_id count as held out. Repeated
rows get equal results; columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buffers, fresh

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE = 600  # labelled rows per language at most (about), one excerpt each
ROWS = 38_400  # labelled rows of all languages at most (about), but one of each language at least
EXCERPT = 512  # characters of a row the training sees
FOLDS = 5
UNDETERMINED = "und"
_CHUNK = 512  # windows put through the network at once
_LETTER = np.zeros(256, np.float32)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1


def windows(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte windows from ``begin`` to ``end`` (at most ``WINDOW`` long), filled up with zeros."""
    at = begin[:, None] + np.arange(WINDOW)
    return np.where(at < end[:, None], raw[np.minimum(at, len(raw) - 1)], 0)


class ByteNet:
    """Filters per width, one table of a byte's contribution for each place in a filter."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)
        self.pairs: list | None = None

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.out, self.out_bias]

    def ready(self) -> ByteNet:
        """Adds up the tables of neighbouring places, so that applying takes half the look-ups."""
        self.pairs = []
        for f in self.filters:
            tables = [(f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, len(f) - 1, 2)]
            self.pairs.append((tables, f[-1] if len(f) % 2 else None))
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Softmax of each window."""
        two = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        tops = []
        for width, (tables, last) in zip(WIDTHS, self.pairs):
            n = x.shape[1] - width + 1
            total = np.take(tables[0], two[:, :n], axis=0)
            for k, t in enumerate(tables[1:], 1):
                total += np.take(t, two[:, 2 * k : 2 * k + n], axis=0)
            if last is not None:
                total += np.take(last, x[:, width - 1 : width - 1 + n], axis=0)
            tops.append(total.max(axis=1))
        return _softmax(np.maximum(np.concatenate(tops, axis=1) + self.bias, 0) @ self.out + self.out_bias)

    def train(self, x: np.ndarray, label: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 11) -> ByteNet:
        """Adam on the cross entropy; each epoch also shortens a part of the windows."""
        rng = np.random.default_rng(seed)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                seen = x[rows].copy()
                length = np.where(rng.random(len(rows)) < 0.3, rng.integers(16, WINDOW, len(rows)), WINDOW)
                seen[np.arange(WINDOW) >= length[:, None]] = 0
                step += 1
                for p, g, (m, v) in zip(self.parameters(), self._gradients(seen, label[rows]), moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        best, tops = [], []
        for f in self.filters:
            n = x.shape[1] - len(f) + 1
            total = sum(f[k][x[:, k : k + n]] for k in range(len(f)))
            best.append(total.argmax(axis=1))
            tops.append(total.max(axis=1))
        hidden = np.concatenate(tops, axis=1) + self.bias
        active = np.maximum(hidden, 0)
        error = _softmax(active @ self.out + self.out_bias)
        error[np.arange(len(label)), label] -= 1
        error /= len(label)
        back = (error @ self.out.T) * (hidden > 0)
        row, column = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        grown = []
        for k, f in enumerate(self.filters):
            g = np.zeros_like(f)
            for place in range(len(f)):
                np.add.at(g[place], (x[row, best[k] + place], column), back[:, k * FILTERS : (k + 1) * FILTERS])
            grown.append(g)
        return [*grown, back.sum(axis=0), active.T @ error, error.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(doc_id="doc_id"):
    """True for every fifth document by the checksum of its id: those are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def _has_letter():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def training_sample(docs: DataFrame, per_language: int = SAMPLE, rows: int = ROWS) -> list:
    """About ``per_language`` excerpts of each language, fewer if all exceed ``rows``, never none: ``lang, excerpt``.

    Which rows and which part of a text are chosen depends on a hash of the row
    alone, so the sample is spread over all documents and the same on every run.
    """
    draw = (F.xxhash64("doc_id", "text") / 2.0**64 + 0.5).alias("draw")
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & _has_letter()).select("lang", "doc_id", "text", draw)
    counted = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).toArrow()  # a row per label
    if not counted.num_rows:
        return []
    share = max(1, min(per_language, rows // counted.num_rows))
    upto = np.maximum(share / counted["n"].to_numpy(), counted["least"].to_numpy())  # the first row drawn is always in
    drawn = docs.sparkSession.createDataFrame(pa.table({"lang": counted["lang"], "upto": upto}))
    begin = 1 + F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - EXCERPT, F.lit(1)))
    chosen = usable.join(F.broadcast(drawn), "lang").where(F.col("draw") <= F.col("upto"))
    excerpts = chosen.select("lang", "doc_id", F.substring("text", begin.cast("int"), F.lit(EXCERPT)).alias("excerpt"))
    return sorted((r.lang, r.doc_id, r.excerpt) for r in excerpts.distinct().collect())


def trained(docs: DataFrame, per_language: int = SAMPLE, rows: int = ROWS) -> ByteNet | None:
    """The network, or None without labelled rows."""
    sample = training_sample(docs, per_language, rows)
    if not sample:
        return None
    names = sorted({r[0] for r in sample})
    net = ByteNet(names)
    at = {n: i for i, n in enumerate(names)}
    excerpts = [(at[lang], text.encode()) for lang, _, text in sample]
    parts = [(k, t[i : i + WINDOW]) for k, t in excerpts for i in range(0, len(t), WINDOW) if i == 0 or len(t) - i >= WINDOW // 2]
    x = np.zeros((len(parts), WINDOW), np.uint8)
    for i, (_, t) in enumerate(parts):
        x[i, : len(t)] = np.frombuffer(t, np.uint8)
    return net.train(x, np.array([k for k, _ in parts])).ready()


def text_probabilities(net: ByteNet, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the weighted mean of its windows' probabilities; zeros for a text without a letter."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = offsets[:-1][owner] + number * WINDOW
    end = np.minimum(begin + WINDOW, offsets[1:][owner])
    total = np.zeros((len(size), len(net.languages)))
    weight = np.zeros(len(size))
    for at in range(0, len(owner), _CHUNK):
        part = slice(at, at + _CHUNK)
        x = windows(raw, begin[part], end[part])
        letters = _LETTER[x].sum(axis=1)
        np.add.at(total, owner[part], net.probabilities(x) * letters[:, None])
        np.add.at(weight, owner[part], letters)
    return total / np.maximum(weight, 1)[:, None]


def identify(docs: DataFrame, net: ByteNet | None = None, per_language: int = SAMPLE, rows: int = ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs`` (``doc_id, text, lang``)."""
    net = trained(docs, per_language, rows) if net is None else net
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out().alias("held_out"),
        F.when(_has_letter(), F.col("text")).otherwise("").alias("text"),
    )
    return texts.mapInArrow(_predict(net), "doc_id long, held_out boolean, lang_pred string, score double")


def _predict(net: ByteNet | None):
    def predict(batches):
        for b in batches:
            raw, offsets = buffers(b.column("text"))
            own = np.zeros((b.num_rows, 1)) if net is None else text_probabilities(net, raw, offsets)
            known = own.sum(axis=1) > 0
            best = own.argmax(axis=1)
            names = [net.languages[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), known.tolist())]
            score = np.clip(np.where(known, own.max(axis=1), 0), 0, 1)
            yield pa.record_batch(
                [b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows whose language is determined with at least ``min_score``, all columns kept.

    Without any labelled row nothing can be determined, and all rows with a letter are kept.
    """
    net = trained(docs)
    (seen,) = fresh(docs, "seen")
    own, names = docs.withColumn(seen, F.when(_has_letter(), F.col("text")).otherwise("")), docs.columns

    def keep(batches):
        for b in batches:
            raw, offsets = buffers(b.column(seen))
            kept = np.diff(offsets) > 0 if net is None else text_probabilities(net, raw, offsets).max(axis=1) >= min_score
            yield b.select(names).filter(pa.array(kept))

    return own.mapInArrow(keep, docs.schema)
