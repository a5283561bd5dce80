"""Conversation structure repair: the cheapest edits that make the roles of a conversation take turns.

A conversation is right when it is empty, or an optional system turn and then user
and assistant in turns, ending with the assistant. Keeping a row costs nothing, giving
it another role 2, deleting it 3 (blank rows and repeats have to go), putting in an
empty turn 2, and a truncated row that stays 1 more. Among the cheapest edits the one
whose initials (``K R D I``, the audit) come first in ASCII order is taken.

It is found by a depth-first branch and bound. The node of a prefix is the rows
it has worked off and the role it ends with; an explicit stack holds open branches,
tried in ASCII order. A branch is cut when its cost and the lower bound of the
rest exceed the incumbent, or when the node's dominance table has a prefix that
is no dearer: prefixes come in ASCII order, so that one is also the earlier audit. The
lower bound adds up what every row of the rest costs at least and 2 for each edit that
its wrong neighbourships take, one edit mending at most two. When the stack is
empty the incumbent is optimal.

Rows are sorted by range over all tasks (conversation, turn with nulls first, role, text), so a
conversation of any length is dealt over as many tasks as its rows take. Where it
lies in one piece within a task it is repaired there. One that is cut by a task's
end, or has more than ``SEGMENT_ROWS`` rows or ``SEGMENT_BYTES`` of text, goes on as segments:
repeats across them are found by a hash of 128 bits, each segment is searched once for
every role before and behind it, and the best chain of segments is put together from
these costs. Beyond its segments a conversation's letters alone are in one task, being
one cell of the result; its texts stream past for their digest.

Null roles and texts are one blank, as is a null in the key; a null turn comes first and
has no gap; a null conv_id is a conversation; rows of one turn are in order of role and
text, and equal rows are repeats; a conversation without rows is kept with zeros;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SEGMENT_ROWS = 1_024
SEGMENT_BYTES = 8_000_000

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
_SPACE = " \t\n\x0b\x0c\r"

# --- the search -----------------------------------------------------------------------------

#: A prefix ends with nothing, the system, a user or an assistant; what may follow each, and what an edit puts there.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_FOLLOWS = ({SYSTEM, USER}, {USER}, {ASSISTANT}, {USER})
_PUT = (USER, USER, ASSISTANT, USER)
_REACHED = ({START, SYSTEM, USER, ASSISTANT}, {SYSTEM, USER, ASSISTANT}, {USER, ASSISTANT}, {USER, ASSISTANT})
ROLE = {USER: "user", ASSISTANT: "assistant"}
RIGHT = frozenset((START, ASSISTANT))
_FAR = 1 << 60


def suffix_bounds(states: list, faults: bytes, ends: frozenset) -> list[tuple[int, int, int, int]]:
    """For every row (and the end) and state before it: a lower bound of what the rest costs."""
    last = tuple(int(s not in ends) for s in range(4))
    covers, free, fixed = last, 0, 0  # edits for wrong neighbourships, by state before, and with the first one mended
    out = [None] * (len(states) + 1)

    def bounds():
        return tuple(fixed + 2 * covers[s] if _REACHED[s] & ends else _FAR for s in range(4))

    out[-1] = bounds()
    for i in range(len(states) - 1, -1, -1):
        own, fault = states[i], faults[i]
        if fault in (BLANK, DUPLICATE):
            fixed += DELETE
        else:
            fixed += (fault == TRUNCATED) + (REROLE if own is None else 0)
            if own is None:  # edited in any case, which may mend both sides
                covers = (free,) * 4
            else:
                covers, free = tuple(covers[own] if own in _FOLLOWS[s] else 1 + free for s in range(4)), covers[own]
        out[i] = bounds()
    return out


def _moves(states: list, faults: bytes, i: int, state: int):
    """Letter, next row, next state and cost of every edit, in ASCII order."""
    if i < len(states):
        yield "D", i + 1, state, DELETE
    yield "I", i, _PUT[state], INSERT
    if i < len(states) and faults[i] not in (BLANK, DUPLICATE):
        more = int(faults[i] == TRUNCATED)
        if states[i] in _FOLLOWS[state]:
            yield "K", i + 1, states[i], KEEP + more
        yield "R", i + 1, _PUT[state], REROLE + more


def _dive(states: list, faults: bytes, state: int, ends: frozenset, bounds: list) -> tuple[int, str] | None:
    """A first incumbent: always the edit with the least cost and bound."""
    i, cost, audit, n = 0, 0, [], len(states)
    while i < n or state not in ends:
        idle = audit[-2:] == ["I", "I"]
        found = [(cost + c + bounds[j][s], -j, x, j, s, c) for x, j, s, c in _moves(states, faults, i, state) if not (idle and x == "I")]
        best = min(found, default=(_FAR,))
        if best[0] >= _FAR:
            return None
        _, _, letter, i, state, own = best
        cost += own
        audit.append(letter)
    return cost, "".join(audit)


def cheapest(states: list, faults: bytes, state: int = START, ends: frozenset = RIGHT) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from ``state`` to one of ``ends``; None if there are none.

    ``states`` holds each row's state, or None for a role that fits nowhere.
    """
    bounds, n = suffix_bounds(states, faults, ends), len(states)
    incumbent = _dive(states, faults, state, ends, bounds)
    limit = incumbent[0] if incumbent else (DELETE + 1) * n + 3 * INSERT  # a dearer branch is cut
    dominance = [_FAR] * (4 * (n + 1))  # least cost of the prefixes that came to the node, all of them earlier in ASCII order
    path: list[str] = []
    stack = [(0, "", 0, state, 0)]
    while stack:
        depth, letter, i, state, cost = stack.pop()
        node = 4 * i + state
        if cost + bounds[i][state] > limit or cost >= dominance[node]:
            continue
        dominance[node] = cost
        del path[max(0, depth - 1) :]
        if letter:
            path.append(letter)
        if i == n and state in ends:  # any further edit costs more
            incumbent, limit = (cost, "".join(path)), cost - 1
            continue
        moves = [(depth + 1, x, j, s, cost + c) for x, j, s, c in _moves(states, faults, i, state)]
        stack.extend(m for m in reversed(moves) if m[4] + bounds[m[2]][m[3]] <= limit)
    return incumbent


def edited(audit: str, rows: list[tuple[str, str]], state: int = START):
    """The turns an audit makes of rows of role and text: letter, role and text, a deleted row with no role."""
    i = 0
    for letter in audit:
        if letter == "I":
            state = _PUT[state]
            yield letter, ROLE[state], ""
            continue
        role, text = rows[i]
        i += 1
        if letter == "D":
            yield letter, None, text
            continue
        state = _STATE[role[:1]] if letter == "K" else _PUT[state]
        yield letter, role if letter == "K" else ROLE[state], text


# --- rows of a task -------------------------------------------------------------------------


class Segment:
    """Neighbouring rows of one conversation, as far as one task holds them."""

    def __init__(self, conv):
        self.conv, self.turns, self.rows, self.faults, self.digests, self.size = conv, [], [], bytearray(), [], 0
        self._seen: set[bytes] = set()

    def add(self, turn, role: str, text: str) -> None:
        shown = text.strip(_SPACE)
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if not shown:
            fault = BLANK
        elif digest in self._seen:
            fault = DUPLICATE
        else:
            fault = TRUNCATED if shown[-1] not in ".!?" else FINE
            self._seen.add(digest)
        self.turns.append(turn)
        self.rows.append((role, text))
        self.faults.append(fault)
        self.digests.append(digest)
        self.size += len(text)

    @property
    def full(self) -> bool:
        return len(self.rows) >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES


def _counts(initials: list[str], faults: bytes, turns: list) -> dict:
    """What adds up over the segments of a conversation, and what lies at its ends."""
    given = [t for t in turns if t is not None]
    return {
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
        "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
        "low": given[0] if given else None, "high": given[-1] if given else None, "distinct": len(set(given)),
    }


def _followed(left: dict, right: dict) -> dict:
    """The counts of two neighbouring segments as one."""
    if left["first"] is None or right["first"] is None:
        return right if left["first"] is None else left
    out = {c: left[c] + right[c] for c in ("blank", "duplicate", "truncated", "illegal", "distinct")}
    out["illegal"] += left["last"] + right["first"] not in ("su", "ua", "au")
    out["distinct"] -= left["high"] is not None and left["high"] == right["low"]
    out |= {"first": left["first"], "last": right["last"]}
    out["low"] = right["low"] if left["low"] is None else left["low"]
    out["high"] = left["high"] if right["high"] is None else right["high"]
    return out


def _states(initials: list[str]) -> list:
    return [_STATE.get(x) for x in initials]


_SUMMARY = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
_RESULT = {c: pa.int64() for c in _SUMMARY} | {"audit": pa.string(), "repaired_sha256": pa.string()}
_SEGMENT = {
    "conv_id": pa.int64(), "part": pa.int32(), "seq": pa.int64(), "turns": pa.list_(pa.int64()), "roles": pa.list_(pa.string()),
    "texts": pa.list_(pa.string()), "faults": pa.binary(), "digests": pa.list_(pa.binary()),
}
_TURN = {"place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
_KIND = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>",
         pa.list_(pa.string()): "array<string>", pa.list_(pa.binary()): "array<binary>"}


def _schema(kinds: dict) -> str:
    return ", ".join(f"{c} {_KIND[t]}" for c, t in kinds.items())


def _batch(kinds: dict, rows: list[dict]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()], names=list(kinds))


def _in_batches(kinds: dict, rows, least: int = 512, size: int = 4_000_000):
    """Record batches of row dicts, ended by rows or by characters."""
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += sum(len(x) for x in r.values() if isinstance(x, (str, bytes))) + sum(map(len, r.get("texts") or ()))
        if len(held) >= least or weight >= size:
            yield _batch(kinds, held)
            held, weight = [], 0
    if held:
        yield _batch(kinds, held)


def _summary(conv, counts: dict, cost: int, audit: str, digest: str) -> dict:
    gaps = 0 if counts["low"] is None else counts["high"] - counts["low"] + 1 - counts["distinct"]
    return {"conv_id": conv, "gaps": gaps, "cost": cost, "audit": audit, "repaired_sha256": digest} | {
        c: counts[c] for c in ("blank", "duplicate", "truncated", "illegal")
    }


def _sorted_rows(turns: DataFrame) -> DataFrame:
    """All rows in order over the tasks; rows without ``present`` only stand for their conversation."""
    given = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("present").alias("present") if "present" in turns.columns else F.lit(True).alias("present"),
        F.xxhash64(F.monotonically_increasing_id()).alias("_salt"),
    )
    start = F.left("text", F.lit(32))
    return given.repartitionByRange("conv_id", "turn", "role", start, "_salt").sortWithinPartitions("conv_id", "turn", "role", "text").drop("_salt")


def _whole_or_cut(turns: DataFrame, texts: bool) -> DataFrame:
    """One row for each conversation that lies within a task, one for each segment of the others.

    With ``texts`` also a row for each turn of the former (those with a ``place``).
    """
    kinds = _RESULT | _SEGMENT | _TURN

    def walk(batches):
        task = TaskContext.get().partitionId()

        def segments():
            """Each segment, and whether it begins and ends its conversation for certain."""
            own, first, begins = None, True, False
            for b in batches:
                columns = [b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present")]
                for conv, turn, role, text, present in zip(*columns):
                    if own is None or own.conv != conv:
                        if own is not None:
                            yield own, begins, True
                            first = False
                        own, begins = Segment(conv), not first
                    elif own.full:
                        yield own, begins, False
                        first, own, begins = False, Segment(conv), False
                    if present:
                        own.add(turn, role, text)
            if own is not None:
                yield own, begins, False

        def rows():
            for seq, (own, begins, ends) in enumerate(segments()):
                initials, faults = [role[:1] for role, _ in own.rows], bytes(own.faults)
                if not (begins and ends):
                    roles, words = (list(x) for x in zip(*own.rows)) if own.rows else ([], [])
                    yield {"conv_id": own.conv, "part": task, "seq": seq, "turns": own.turns, "roles": roles, "texts": words,
                           "faults": faults, "digests": own.digests}
                    continue
                cost, audit = cheapest(_states(initials), faults)
                made = list(edited(audit, own.rows))
                digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in made if role is not None).encode()).hexdigest()
                yield _summary(own.conv, _counts(initials, faults, own.turns), cost, audit, digest)
                if texts:
                    for place, (letter, role, text) in enumerate(made):
                        yield {"conv_id": own.conv, "place": place, "edit": letter, "role": role, "text": text}

        yield from _in_batches(kinds, rows())

    return _sorted_rows(turns).mapInArrow(walk, _schema(kinds))


# --- conversations in segments --------------------------------------------------------------


def _repeats(segments: DataFrame) -> DataFrame:
    """``part, seq, repeated``: places of rows whose first occurrence lies in an earlier segment."""
    each = segments.select("conv_id", "part", "seq", "faults", F.posexplode("digests").alias("pos", "digest"))
    fault = F.conv(F.hex(F.expr("substring(faults, pos + 1, 1)")), 16, 10).cast("int")
    each = each.where(~fault.isin(BLANK, DUPLICATE))  # so at most one row for each segment
    first = each.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "seq")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "first")
    return (
        each.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
        .where(F.struct("part", "seq") != F.col("first"))
        .groupBy("part", "seq").agg(F.collect_list("pos").alias("repeated"))
    )


_COUNTS = {c: pa.int64() for c in ("blank", "duplicate", "truncated", "illegal", "low", "high", "distinct")} | {"first": pa.string(), "last": pa.string()}
_TABLE = {"conv_id": pa.int64(), "part": pa.int32(), "seq": pa.int64()} | _COUNTS | {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
_CHOICE = {"part": pa.int32(), "seq": pa.int64(), "entry": pa.int64(), "chosen": pa.string()}


def _searched(segments: DataFrame) -> DataFrame:
    """For each segment its counts, and cost and audit from every state before it to every state behind it."""

    def search(batches):
        def rows():
            for b in batches:
                for r in b.to_pylist():
                    faults = bytearray(r["faults"])
                    for pos in r["repeated"] or ():
                        faults[pos] = DUPLICATE
                    initials = [role[:1] for role in r["roles"]]
                    found = [cheapest(_states(initials), faults, s, frozenset((e,))) or (None, None) for s in range(4) for e in range(4)]
                    yield {c: r[c] for c in ("conv_id", "part", "seq")} | _counts(initials, bytes(faults), r["turns"]) | {
                        "costs": [c for c, _ in found], "audits": [a for _, a in found]
                    }

        yield from _in_batches(_TABLE, rows(), 16)

    facts = segments.drop("texts", "digests").join(_repeats(segments), ["part", "seq"], "left")
    return facts.mapInArrow(search, _schema(_TABLE))


class _Chain:
    """The best edits from a segment on: cost, the segment's part of them, and what follows."""

    def __init__(self, cost: int, key=None, entry: int = START, audit: str = "", rest: _Chain | None = None):
        self.cost, self.key, self.entry, self.audit, self.rest = cost, key, entry, audit, rest

    def links(self):
        own = self
        while own is not None and own.key is not None:
            yield own
            own = own.rest

    def before(self, other: _Chain) -> bool:
        """Cheaper, or as cheap with the earlier audit."""
        if self.cost != other.cost:
            return self.cost < other.cost
        letters = (chain.from_iterable(link.audit for link in own.links()) for own in (self, other))
        return next((x < y for x, y in zip(*letters) if x != y), False)


def _chained(tables: DataFrame) -> DataFrame:
    """The best chain of each conversation's segments: a summary row, and a row for each segment."""
    kinds = _RESULT | _CHOICE

    def walk(batches):
        def rows():
            conv, best, counts = None, None, None

            def finish():
                whole = best[START]
                yield _summary(conv, counts, whole.cost, "".join(link.audit for link in whole.links()), None)
                for link in whole.links():
                    yield {"conv_id": conv, "part": link.key[0], "seq": link.key[1], "entry": link.entry, "chosen": link.audit}

            for b in batches:
                for r in b.to_pylist():  # from a conversation's last segment to its first
                    own = {c: r[c] for c in _COUNTS}
                    if best is None or r["conv_id"] != conv:
                        if best is not None:
                            yield from finish()
                        conv, best, counts = r["conv_id"], {s: _Chain(0) for s in RIGHT}, own
                    else:
                        counts = _followed(own, counts)
                    now = {}
                    for s in range(4):
                        for e, rest in best.items():
                            cost, audit = r["costs"][4 * s + e], r["audits"][4 * s + e]
                            if cost is not None:
                                one = _Chain(cost + rest.cost, (r["part"], r["seq"]), s, audit, rest)
                                if s not in now or one.before(now[s]):
                                    now[s] = one
                    best = now
            if best is not None:
                yield from finish()

        yield from _in_batches(kinds, rows())

    ordered = tables.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    return ordered.mapInArrow(walk, _schema(kinds))


def _written_out(segments: DataFrame, choices: DataFrame, texts: bool) -> DataFrame:
    """The edited turns of conversations in segments as one digest each, and with ``texts`` as rows."""
    kinds = {"conv_id": pa.int64(), "repaired_sha256": pa.string()} | _TURN

    def walk(batches):
        def rows():
            conv, digest, place, any_turn = None, None, 0, False
            for b in batches:
                for r in b.to_pylist():
                    if digest is None or r["conv_id"] != conv:
                        if digest is not None:
                            yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}
                        conv, digest, place, any_turn = r["conv_id"], hashlib.sha256(), 0, False
                    for letter, role, text in edited(r["chosen"], list(zip(r["roles"], r["texts"])), r["entry"]):
                        if role is not None:
                            digest.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                            any_turn = True
                        if texts:
                            yield {"conv_id": conv, "place": place, "edit": letter, "role": role, "text": text}
                        place += 1
            if digest is not None:
                yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}

        yield from _in_batches(kinds, rows())

    chosen = segments.select("conv_id", "part", "seq", "roles", "texts").join(choices.select(*_CHOICE), ["part", "seq"])
    return chosen.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(walk, _schema(kinds))


def repair(turns: DataFrame, texts: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Conversations and repaired turns of ``turns`` (``conv_id, turn, role, text``).

    The first frame has ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every
    conv_id, the second ``conv_id, place, edit, role, text``, a deleted row without a role (None instead of it without ``texts``).
    A boolean column ``present``, if there is one, is false on rows that only name their conversation.
    """
    found = stored(_whole_or_cut(turns, texts), "conversations")
    result, turn = list(_RESULT), ["conv_id", *_TURN]
    segments = found.where("part IS NOT NULL").select(*_SEGMENT)
    chained = stored(_chained(stored(_searched(segments), "segments")), "chains")
    made = stored(_written_out(segments, chained.where("part IS NOT NULL"), texts), "texts")
    digests = made.where("place IS NULL").select(F.col("conv_id").alias("_conv"), F.col("repaired_sha256").alias("_digest"))
    joined = chained.where("part IS NULL").select(*_SUMMARY).join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")))
    summaries = found.where("audit IS NOT NULL").select(*result).unionByName(joined.select(*_SUMMARY, F.col("_digest").alias("repaired_sha256")))
    if not texts:
        return summaries, None
    return summaries, found.where("place IS NOT NULL").select(*turn).unionByName(made.where("place IS NOT NULL").select(*turn))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` harmed by the CRC-32 of ``conv_id:turn``: dropped (kept without ``present``), emptied, stripped, repeated or given to the user."""
    blank = F.lit(" ")
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    harm = F.crc32(F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))) % 20
    text = F.coalesce("text", blank)
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(harm == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(harm.isin(0, 1), "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (harm != 0).alias("present"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")
