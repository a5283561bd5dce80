"""The operators' results worked out one row and one pair at a time."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import combinations

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SMALL = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_SMALL))


def passages(docs: list[tuple], least: int = 50) -> dict:
    """Row number to the spans of all its windows of ``least`` words that occur at another place."""
    places: dict = {}
    for n, (_, text) in enumerate(docs):
        own = words(text)
        for at in range(len(own) - least + 1):
            places.setdefault(tuple(own[at : at + least]), []).append((n, at))
    starts: dict = {}
    for found in places.values():
        if len(found) > 1:
            for n, at in found:
                starts.setdefault(n, []).append(at)
    out = {}
    for n, found in starts.items():
        spans: list = []
        for at in sorted(found):
            if spans and at < spans[-1][1]:
                spans[-1][1] = at + least
            else:
                spans.append([at, at + least])
        out[n] = [tuple(s) for s in spans]
    return out


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text: str | None) -> tuple[dict, str]:
    counts, listed = {}, []
    for kind, pattern in _PATTERNS.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
        counts[kind] = len(found)
        listed += found
    return counts, hashlib.sha256(",".join(listed).encode()).hexdigest()


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    sought: dict = {}
    for name, text in items:
        own = words(text)
        size = min(window, len(own))
        for at in range(len(own) - size + 1) if own else ():
            sought.setdefault(tuple(own[at : at + size]), set()).add(name)
    sizes = {len(w) for w in sought}
    out = []
    for doc, text in docs:
        own, hit, named = words(text), set(), set()
        for size in sizes:
            for at in range(len(own) - size + 1):
                found = sought.get(tuple(own[at : at + size]))
                if found:
                    hit.update(range(at, at + size))
                    named |= found
        ids = sorted(str(n) for n in named if n is not None)
        out.append((doc, len(own), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def simhash(text: str | None, shingle: int = 3) -> int:
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_SMALL))
    if not own:
        return 0
    grams = [" ".join(own[k : k + shingle]) for k in range(max(1, len(own) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[tuple], bits: int = 2) -> list[int | None]:
    """Per row the smallest id of its component."""
    root = list(range(len(prints)))

    def top(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
            root[top(b)] = top(a)
    least: dict = {}
    for k, (name, _) in enumerate(prints):
        if name is not None:
            least[top(k)] = min(least.get(top(k), name), name)
    return [least.get(top(k)) for k in range(len(prints))]


def lines(docs: list[tuple], sites: int) -> list[tuple]:
    """doc, site, text to doc, number of lines, removed lines, clean text."""
    seen: dict = {}
    for doc, site, text in docs:
        for line in (text or "").split("\n"):
            if line.strip(" "):
                own = seen.setdefault(line, (set(), []))
                if site is not None:
                    own[0].add(site)
                if doc is not None:
                    own[1].append(doc)
    out = []
    for doc, _, text in docs:
        if text is None:
            out.append((doc, 0, 0, None))
            continue
        kept = [x for x in text.split("\n") if not x.strip(" ") or len(seen[x][0]) < sites or doc == min(seen[x][1], default=None)]
        n = text.count("\n") + 1
        out.append((doc, n, n - len(kept), "\n".join(kept)))
    return out


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def licenses(text: str | None) -> tuple:
    own = words(text)
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        sought = phrase.split()
        found = [k for k in range(len(own)) if own[k : k + len(sought)] == sought]
        starts += found
        labels |= {label} if found else set()
    return len(own), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def pieces(text: str | None, tokenizer, capacity: int = 2048) -> list[tuple]:
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    cut = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
    return [(k, k * capacity, len(p), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p))) for k, p in enumerate(cut)]


# --- cross-tokenizer alignment --------------------------------------------------------------


@lru_cache
def _tokenizers(a_path, b_path):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def _tokens(text, a_path, b_path):
    """(id, bytes) of both sequences, or nothing where they don't give the text back."""
    a, b = _tokenizers(a_path, b_path)
    if not text:
        return [], []
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(n): n for n in printable} | {chr(256 + k): n for k, n in enumerate(n for n in range(256) if n not in printable)}
    one = [(n, bytes(letters[c] for c in a.id_to_token(n))) for n in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for n in b.encode(text):
        piece = b.id_to_piece(n)
        byte = len(piece) == 6 and piece.startswith("<0x")
        two.append((n, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in own) != whole for own in (one, two)):
        return [], []
    return one, two


def aligned(docs, a_path, b_path):
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    kept, holders = [], Counter()
    for doc, text in docs:
        one, two = _tokens(text, a_path, b_path)
        groups, i, j, x, y, a, b = [], 0, 0, 0, 0, [], []
        while i < len(one) or j < len(two):
            if x <= y and i < len(one):
                a.append(one[i][0])
                x += len(one[i][1])
                i += 1
            else:
                b.append(two[j][0])
                y += len(two[j][1])
                j += 1
            if x == y:
                groups.append((a, b))
                a, b = [], []
        links = Counter()
        for a, b in groups:
            for p, n in Counter(a).items():
                for q, m in Counter(b).items():
                    links[p, q] += n * m
        kept.append((doc, len(one), len(two), groups, links))
        holders.update(links.keys())
    best = Counter()
    for (p, _), n in holders.items():
        best[p] = max(best[p], n)
    out = []
    for doc, n, m, groups, links in kept:
        listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc, n, m, len(groups), sum(links.values()), sum(k for p, k in links.items() if holders[p] == best[p[0]]),
            sum(k * holders[p] for p, k in links.items()), hashlib.sha256(listed.encode()).hexdigest() if groups else "",
        ))
    return out


# --- conversation repair --------------------------------------------------------------------


def damaged(turns):
    """conv_id, turn, role, text after damage, and all conv_ids."""
    out = []
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out, {t[0] for t in turns}


def edits(rows):
    """Cost, audit and turns of the cheapest edits of [(initial, fault, text)], by a queue in order of (cost, audit)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, made = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, made
        put = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[put]
        heapq.heappush(queue, (cost + 2, audit + "I", i, put, (*made, f"{name}:")))
        if i < len(rows):
            role, fault, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, last, made))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if role[:1] and role[:1] in follow[last]:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*made, f"{role}:{text}")))
                heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, put, (*made, f"{name}:{text}")))


def repaired(turns):
    """The rows of conversations after damage, one conversation at a time."""
    rows, convs = damaged(turns)
    out = []
    for conv in convs:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        given, seen = [r[1] for r in own if r[1] is not None], set()
        faulty = []
        for _, _, role, text in own:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, fault, text))
        count = Counter(f for _, f, _ in faulty)
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(own, own[1:]))
        cost, audit, made = edits(faulty)
        gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return out
