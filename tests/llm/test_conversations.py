"""Conversation repair against a queue over all edits, one conversation at a time."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import conversations as C
from tidemark.llm.common import table

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
KINDS = "conv_id long, turn long, role string, text string, part string, seq string, audit string, _salt string, place string"


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def found(df):
    return rows_of(C.repair(C.damaged(df), texts=False)[0])


def frame(spark, turns, parts=3):
    return spark.createDataFrame([(*t, *"xxxxx") for t in turns], KINDS).repartition(parts)


def made_up(n, most, rng, odd=True):
    """Conversations with every fault, nulls, ties, odd roles and repeats."""
    roles = ["user", "assistant", "user", "assistant", "system"] + (["tool", "", "User", None] if odd else [])
    texts = ["Yes.", "No!", "why", "so?  \n", "", " \t", None, "é", "a.b", "日本。", "end.\x0b", "\x85"]
    turns = []
    for conv in range(n):
        turn = rng.randint(-2, 3)
        for _ in range(rng.randint(0, most)):
            turn += rng.choice([0, 1, 1, 1, 1, 2])
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randint(0, 10**6)}{rng.choice(['.', '!', ''])}"
            turns.append((conv, None if odd and rng.random() < 0.05 else turn, rng.choice(roles), text))
    return turns


def test_search_equals_a_queue():
    rng = random.Random(1)
    faults = ["", "", "", "truncated", "blank", "duplicate"]
    for _ in range(3_000):
        rows = [(rng.choice("sssuuuuuaaaaax"), rng.choice(faults), "") for _ in range(rng.randint(0, 9))]
        codes = bytes({"": C.FINE, "blank": C.BLANK, "duplicate": C.DUPLICATE, "truncated": C.TRUNCATED}[f] for _, f, _ in rows)
        assert C.cheapest(C._states([r for r, _, _ in rows]), codes) == brute.edits(rows)[:2]


def test_long_and_alike():
    """Runs of one role, and many ties."""
    for initials in ("u" * 400, "a" * 401, "s" * 200, "x" * 150, "sau" * 130, "uaau" * 100, "uuaa" * 100):
        rows = [(x, "truncated" if n % 5 == 0 else "", "") for n, x in enumerate(initials)]
        codes = bytes(C.TRUNCATED if f else C.FINE for _, f, _ in rows)
        assert C.cheapest(C._states(list(initials)), codes) == brute.edits(rows)[:2]


def test_bounds_never_exceed_the_cost():
    rng = random.Random(3)
    for _ in range(500):
        states = [rng.choice([None, C.SYSTEM, C.USER, C.ASSISTANT]) for _ in range(rng.randint(0, 7))]
        faults = bytes(rng.choice([0, 0, 1, 2, 3]) for _ in states)
        bounds = C.suffix_bounds(states, faults, C.RIGHT)
        for i in range(len(states) + 1):
            for s in range(4):
                assert bounds[i][s] <= C.cheapest(states[i:], faults[i:], s)[0]


def test_awkward_conversations(spark):
    turns = made_up(400, 9, random.Random(4))
    turns += [(None, None, None, None), (None, 3, "user", "hm."), (None, 3, "user", "hm."), (900, None, "assistant", None), (-5, 0, "user", "x" * 50_000)]
    assert found(frame(spark, turns)) == Counter(brute.repaired(turns))


def test_every_row_dropped(spark):
    turns = [t for t in made_up(3_000, 2, random.Random(6)) if brute.damaged([t])[0] == []]
    assert turns
    got = found(frame(spark, turns))
    assert got == Counter(brute.repaired(turns)) and all(r[1:8] == (0, 0, 0, 0, 0, 0, "") for r in got)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_conversations_in_segments(spark, monkeypatch, size):
    """Segments of a few rows: chained over tasks, with repeats in other segments."""
    monkeypatch.setattr(C, "SEGMENT_ROWS", size)
    turns = made_up(60, 30, random.Random(size))
    assert found(frame(spark, turns)) == Counter(brute.repaired(turns))


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    """One conversation has most rows, and one row most of its copies."""
    monkeypatch.setattr(C, "SEGMENT_ROWS", 100)
    turns = made_up(40, 6, random.Random(8)) + [(7, 50, "assistant", "again and again.")] * 700
    turns += [(7, 60 + n, ("user", "assistant")[n % 2 if n % 9 else 0], f"line {n}.") for n in range(700)]
    assert found(frame(spark, turns, 6)) == Counter(brute.repaired(turns))


def test_repaired_turns(spark):
    """The turns themselves are in order, and their roles take turns."""
    turns = made_up(80, 8, random.Random(9))
    summaries, made = C.repair(C.damaged(frame(spark, turns)))
    audits = {r.conv_id: r.audit for r in summaries.collect()}
    rows: dict = {}
    for r in made.orderBy("conv_id", "place").collect():
        rows.setdefault(r.conv_id, []).append(r)
    for conv, audit in audits.items():
        own = rows.get(conv, [])
        assert [r.place for r in own] == list(range(len(audit))) and "".join(r.edit for r in own) == audit
        initials = "".join(r.role[0] for r in own if r.role is not None)
        assert brute.re.fullmatch("(s?(ua)+)?", initials)


def test_whole_table_and_no_rows(spark, sf_dir):
    df = table(spark, sf_dir, "conversations")
    turns = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert found(df) == Counter(brute.repaired(turns))
    assert found(df.where("1 = 0")) == Counter()


def test_undamaged_rows(spark):
    """The operator itself takes any turns, with other columns beside them."""
    df = spark.createDataFrame([(1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "No")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.cost, r.audit) for r in C.repair(df.withColumn("extra", F.lit(1)))[0].collect()}
    assert got == {1: (0, "KK"), 2: (3, "D")}
