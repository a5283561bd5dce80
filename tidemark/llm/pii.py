"""Personal data by weak supervision.

Base patterns mark e-mail addresses, IP addresses, card and phone numbers; these
spans always stay. They and further candidates (near misses of the patterns, and
key-like strings) are judged by labelers: a pattern's own check, a gazetteer of
prefixes, words before the span that speak for or against, and the string's shape.
Each votes for, against, or not at all. Votes are counted over all documents by
pattern of votes; expectation-maximisation on these counts estimates how reliable
each labeler is and how likely each pattern is personal data. A logistic model of
votes, kind and length, trained on those likelihoods, decides about the spans.

The number of vote patterns is bounded by kinds, labelers and length classes,
so only that small table comes to the driver and goes back to the tasks.

Null texts are empty, an empty text has no span, repeated rows get equal
results, a null doc_id is a value, other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
LABELERS = ("check", "gazetteer", "before", "against", "shape")

# Every repetition is possessive where it can be, and starts only where a run starts: no text takes
# more than linear time. A start inside a run would end where the run's own start ends.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{12,}+")
_ANY = re.compile(r"[0-9@]")

# Gazetteers.
_SECRET_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_live", "xoxb", "xoxp", "AIza", "eyJ")
_FOR = {
    "email": ("mail", "e-mail", "contact", "write", "address", "@"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "account", "iban"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "secret": ("password", "passwd", "token", "secret", "key", "api", "credential", "bearer"),
}
_AGAINST = ("version", "isbn", "issn", "sha", "commit", "order", "invoice", "page", "figure", "chapter", "release", "http")
_BEFORE = 24  # characters before a span that labelers read


def luhn(digits: str) -> bool:
    total = sum(ord(c) - 48 for c in digits[-1::-2])
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[ord(c) - 48] for c in digits[-2::-2])) % 10 == 0


def emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_check(kind: str, span: str) -> bool:
    """What a match must satisfy beside its pattern."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in span.split("."))
    if kind == "card":
        digits = _digits(span)
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(_digits(span)) <= 15
    return True


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """``kind, start, end, is_base`` of all base matches and of all further candidates that overlap none."""
    if not _ANY.search(text):
        return []
    matched = [("email", s, e) for s, e in emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        matched += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    spans = [(k, s, e, True) for k, s, e in matched if base_check(k, text[s:e])]
    more = [(k, s, e) for k, s, e in matched if not base_check(k, text[s:e]) and (k != "card" or 12 <= e - s <= 30) and (k != "phone" or e - s >= 7)]
    for m in _SECRET.finditer(text):
        own = m.group()
        if re.search("[0-9]", own) and re.search("[A-Za-z]", own):
            more.append(("secret", m.start(), m.end()))
    taken = sorted((s, e) for _, s, e, _ in spans)
    starts = np.array([s for s, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    end = 0
    for kind, s, e in sorted(more, key=lambda x: (x[1], -x[2], x[0])):
        k = int(np.searchsorted(starts, e, side="left")) - 1  # the last base span that starts before e
        if s >= end and (k < 0 or reach[k] <= s):
            spans.append((kind, s, e, False))
            end = e
    return spans


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """The labelers' votes on one candidate: 1 for, -1 against, 0 none."""
    span = text[start:end]
    before = text[max(0, start - _BEFORE) : start].lower()
    if kind == "email":
        check = 1 if re.search(r"\.[A-Za-z]{2,12}$", span) else -1
        known = 1 if re.search(r"(?:\.com|\.org|\.net|\.edu|\.gov|\.de|\.fr|\.es)$", span) else 0
    elif kind == "ip":
        check = 1 if base_check(kind, span) else -1
        known = -1 if span.startswith(("0.", "127.", "255.")) else 0
    elif kind == "card":
        check = 1 if base_check(kind, span) else -1
        known = 1 if span[0] in "3456" else -1
    elif kind == "phone":
        check = 1 if base_check(kind, span) else -1
        known = 1 if span.startswith(("+1", "+33", "+34", "+44", "+49")) else 0
    else:
        check = 1 if re.fullmatch(r"[0-9a-f]{16,}|[A-Z0-9]{16,}|(?=.*[0-9].*[0-9].*[0-9])(?=.*[a-z])(?=.*[A-Z]).{16,}", span) else -1
        known = 1 if span.startswith(_SECRET_PREFIXES) else 0
    words = re.findall(r"[a-z@-]+", before)
    near = 1 if any(w in _FOR[kind] for w in words) else 0
    against = -1 if any(w in _AGAINST for w in words) else 0
    variety = len(set(span)) / min(len(span), 16)
    return check, known, near, against, 1 if variety >= 0.5 else (-1 if variety < 0.3 else 0)


def pattern(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Kind, length class and votes: all the classifier knows of a span."""
    size = end - start
    return (KINDS.index(kind), 0 if size < 12 else 1 if size < 20 else 2 if size < 40 else 3, *votes(text, kind, start, end))


# --- reliabilities and the classifier -------------------------------------------------------


def expectation_maximisation(seen: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood that each vote pattern is personal data, and each labeler's vote rates ``[truth, labeler, vote]``.

    ``seen`` holds kind, length class and votes per row, ``weight`` how often the row occurs. Labelers are
    taken as independent given the truth; the share of true spans is estimated per kind.
    """
    ballot = seen[:, 2:]
    posterior = np.clip(0.5 + 0.2 * ballot.sum(axis=1), 0.05, 0.95)  # starts from the majority
    rates = np.full((2, ballot.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        for truth, share in ((1, posterior * weight), (0, (1 - posterior) * weight)):
            for k in range(ballot.shape[1]):
                counts = np.bincount(ballot[:, k] + 1, share, 3) + 1.0
                rates[truth, k] = counts / counts.sum()
        logit = np.zeros(len(seen))
        for kind in np.unique(seen[:, 0]):
            own = seen[:, 0] == kind
            prior = (posterior[own] @ weight[own] + 1) / (weight[own].sum() + 2)
            logit[own] = np.log(prior / (1 - prior))
        for k in range(ballot.shape[1]):
            logit += np.log(rates[1, k][ballot[:, k] + 1] / rates[0, k][ballot[:, k] + 1])
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, rates


def features(seen: np.ndarray) -> np.ndarray:
    """One column per kind, length class, and vote of each labeler for and against."""
    ballot = seen[:, 2:]
    return np.concatenate(
        [seen[:, :1] == np.arange(len(KINDS)), seen[:, 1:2] == np.arange(4), ballot == 1, ballot == -1], axis=1
    ).astype(float)


def span_classifier(seen: np.ndarray, weight: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Weights of a logistic model fitted to soft targets by gradient descent with a small penalty."""
    x = features(seen)
    w, share = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ (share * (guess - target)) + 1e-4 * w)
    return w


def vote_patterns(docs: DataFrame) -> DataFrame:
    """``key, n``: every pattern of votes with the number of candidates that have it, over all documents."""

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(",".join(map(str, pattern(text, k, s, e))) for k, s, e, _ in candidates(text))
        yield pa.record_batch([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["key", "n"])

    texts = docs.where(F.col("text").isNotNull()).select("text")
    return texts.mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> dict[tuple[int, ...], float]:
    """Score of every vote pattern that occurs."""
    rows = sorted((r.key, r.n) for r in vote_patterns(docs).collect())  # bounded by the patterns there can be
    if not rows:
        return {}
    seen = np.array([[int(v) for v in key.split(",")] for key, _ in rows])
    weight = np.array([n for _, n in rows], float)
    target, _ = expectation_maximisation(seen, weight)
    score = 1 / (1 + np.exp(-features(seen) @ span_classifier(seen, weight, target)))
    return {tuple(row): float(s) for row, s in zip(seen.tolist(), score)}


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def accepted(text: str, scores: dict[tuple[int, ...], float], threshold: float = 0.5) -> tuple[list, list]:
    """Base spans, and all spans with those the classifier adds."""
    base, extra = [], []
    for kind, s, e, is_base in candidates(text):
        if is_base:
            base.append((kind, s, e))
        elif scores.get(pattern(text, kind, s, e), 0.0) >= threshold:
            extra.append((kind, s, e))
    return base, base + extra


_SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs`` the base spans' numbers and hash, and all spans as ``kind:start:end``."""
    scores = train(docs)

    def find(batches):
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                base, spans = accepted(text, scores, threshold)
                per = Counter(k for k, _, _ in base)
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((doc, *(per[k] for k in BASE), digest, listed(spans), len(spans) - len(base)))
            kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) if rows else [[]] * 8
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _SPANS.split(", ")])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(find, _SPANS)


def mask(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; the last one wins where spans overlap."""
    scores = train(docs)
    at, names = docs.columns.index("text"), docs.columns

    def cover(text: str | None) -> str | None:
        if text is None:
            return None
        parts, end = [], 0
        for kind, s, e in sorted(accepted(text, scores, threshold)[1], key=lambda x: (x[1], -x[2])):
            if e > end:
                parts += [text[end : max(s, end)], f"[{kind}]"]
                end = e
        return "".join(parts) + text[end:]

    def run(batches):
        for b in batches:
            yield b.set_column(at, names[at], pa.array([cover(t) for t in b.column(at).to_pylist()], b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
