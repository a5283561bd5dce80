"""Resolution against a brute-force reading of its rules, under skew and any partitioning."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.seed import typed
from tidemark.operators import identity
from tidemark.operators.skew import SkewPolicy, hot_keys, skewed_lookup
from tidemark.spec import ADVANCES, CARDS, CUSTOMERS

# Everything with more than three rows is hot.
EAGER = SkewPolicy(rows_per_task=3)


def _population(n=400, seed=5):
    """A third of all customers share one id, another third one email and birth date."""
    rnd = random.Random(seed)
    people, advances = [], []
    for i in range(n):
        hot_id, hot_mail = i % 3 == 0, i % 3 == 1
        gov = "n/a" if hot_id else rnd.choice([None, "", " - ", f"id-{rnd.randrange(60)}", f"ID {rnd.randrange(60)}"])
        mail = "desk@example.com" if hot_mail else rnd.choice([None, "bad", f"U{rnd.randrange(40)}@example.com "])
        born = "1900-01-01" if hot_mail else rnd.choice([None, f"1980-01-{rnd.randrange(1, 4):02d}"])
        phone = rnd.choice([None, "", "123", f"+54 11 555{i:05d}"])
        day = f"2025-01-{rnd.randrange(1, 6):02d}"
        people.append((i, gov, "F", "L", born, mail, phone, rnd.random() < 0.05, day, f"2025-02-{rnd.randrange(1, 4):02d}"))
        if not hot_id and rnd.random() < 0.2:
            advances.append((1000 + i, i, rnd.choice(["funded", "paid_off", "requested"]), 1, "2025-01-01", "2025-01-01"))
    return people, advances


def _norm_id(v):
    return "".join(c for c in (v or "").upper() if c.isascii() and c.isalnum()) or None


def _expected(people, advances):
    shielded = {a[1] for a in advances if a[2] in ("funded", "paid_off")}
    rows = [p for p in people if not p[7]]
    groups = defaultdict(list)
    for p in rows:
        groups[_norm_id(p[1])].append(p)
    result, quarantined = {}, set()
    for key, group in groups.items():
        inside = [p for p in group if p[0] in shielded]
        if key is None:
            result |= {p[0]: (p[0], "no_proven_identity") for p in group}
        elif len(inside) > 1:
            result |= {p[0]: (p[0], "protected_conflict") for p in group}
            quarantined |= {(key, p[0]) for p in inside}
        else:
            score = lambda p: sum(x not in (None, "") for x in p[1:7])
            best = inside[0] if inside else sorted(group, key=lambda p: (-score(p), p[8], p[0]))[0]
            rule = "protected_advance" if inside else "deterministic_survivor"
            result |= {p[0]: (best[0], f"government_id+{rule}") for p in group}
    return result, quarantined, shielded


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    people, advances = _population()
    customers = typed(spark, CUSTOMERS, people)
    adv = typed(spark, ADVANCES, advances)
    path = str(tmp_path_factory.mktemp("world") / "resolution")
    identity.resolve(customers, adv, EAGER).write.parquet(path)
    resolved = spark.read.parquet(path)
    return people, advances, customers, adv, resolved


def test_aliases_follow_the_rules(world):
    people, advances, _, _, resolved = world
    expected, _, _ = _expected(people, advances)
    got = {r[0]: (r[1], r[2]) for r in identity.aliases(resolved).collect()}
    assert got == expected


def test_conflicts_hold_the_protected_members(world):
    people, advances, _, _, resolved = world
    _, quarantined, _ = _expected(people, advances)
    assert {(r[0], r[1]) for r in identity.conflicts(resolved).collect()} == quarantined


def test_golden_records_fill_only_what_is_absent(world):
    people, advances, _, _, resolved = world
    expected, _, shielded = _expected(people, advances)
    by_id = {p[0]: p for p in people}
    groups = defaultdict(list)
    for cid, (master, _) in expected.items():
        groups[master].append(by_id[cid])
    got = {r.master_customer_id: r for r in identity.golden_records(resolved).collect()}
    assert sorted(got) == sorted(groups)
    for master, group in groups.items():
        row, own = got[master], by_id[master]
        donors = sorted(group, key=lambda p: (p[9], p[0]))
        for at, name in ((1, "government_id"), (4, "birth_date"), (5, "email"), (6, "phone")):
            value = own[at] if own[at] not in (None, "") else next((d[at] for d in donors if d[at] not in (None, "")), None)
            shown = getattr(row, name)
            assert (str(shown) if shown is not None else None) == value, (master, name)
        assert row.source_record_count == len(group)
        assert row.protected_by_advance == (master in shielded)


def test_result_does_not_depend_on_skew_handling_or_order(spark, world):
    _, _, customers, adv, resolved = world
    plain = identity.resolve(customers.orderBy(F.desc("customer_id")).repartition(7), adv.repartition(3))
    assert plain.exceptAll(resolved).count() == 0 and resolved.exceptAll(plain).count() == 0


def test_cards_follow_their_customer(spark, world):
    people, advances, _, _, resolved = world
    expected, _, _ = _expected(people, advances)
    # A third of all cards belong to one customer.
    owners = [2 if i % 3 == 0 else i for i in range(300)] + [None, -5]
    rows = [(f"card-{i}", o, f"t{i}", "0000", "active", "2025-01-01", "2025-01-01") for i, o in enumerate(owners)]
    loose = typed(spark, CARDS, rows)
    got = {r.card_id: r.master_customer_id for r in identity.remap_cards(loose, identity.aliases(resolved), EAGER).collect()}
    assert got == {f"card-{i}": expected[o][0] for i, o in enumerate(owners) if o in expected}


def _evidence_pairs(people, expected):
    groups = defaultdict(list)
    for p in people:
        mail = (p[5] or "").strip().lower()
        if not p[7] and p[4] and "@" in mail:
            groups[(mail, p[4])].append(p[0])
    pairs = {
        key: {(a, b) for a, b in combinations(sorted(ids), 2) if expected[a][0] != expected[b][0]}
        for key, ids in groups.items()
    }
    return groups, {k: v for k, v in pairs.items() if v}


def test_review_is_whole_at_any_group_size(world):
    people, advances, _, _, resolved = world
    expected, _, _ = _expected(people, advances)
    groups, pairs = _evidence_pairs(people, expected)
    largest = max(pairs, key=lambda k: len(groups[k]))
    assert len(groups[largest]) > 50

    found = identity.review_groups(resolved)
    assert {(r.email, str(r.birth_date)): int(r.pairs) for r in found.collect()} == {k: len(v) for k, v in pairs.items()}

    members = defaultdict(dict)
    for r in identity.review_members(resolved, found, EAGER).collect():
        members[(r.email, str(r.birth_date))][r.customer_id] = r.master_customer_id
    unfolded = {
        key: {(a, b) for a, b in combinations(sorted(ids), 2) if ids[a] != ids[b]} for key, ids in members.items()
    }
    assert unfolded == pairs

    small = next(k for k in pairs if len(groups[k]) == 2)
    asked = {*sorted(groups[largest])[:2], groups[small][0], 10**9}
    spark = resolved.sparkSession
    listed = identity.review_partners(resolved, spark.createDataFrame([(a,) for a in asked], "customer_id long")).collect()
    everything = set().union(*pairs.values())
    assert sorted((r.customer_id_a, r.customer_id_b) for r in listed) == sorted(p for p in everything if set(p) & asked)


def test_skewed_lookup_equals_a_plain_join(spark):
    rows = spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k")
    )
    lookup = spark.range(0, 200).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    assert [tuple(r) for r in hot_keys(sizes.dropna(), ["k"], EAGER).collect()] == [(7, 34)]
    got = skewed_lookup(rows, lookup, ["k"], ["id"], EAGER).select("k", "id", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(lookup, "k").select("k", "id", "v").collect()))
    assert got.where("k = 7").count() == 101


def test_thousands_of_hot_keys_are_all_split(spark):
    rows = spark.sql(
        "SELECT date_add(date'2001-01-01', CAST(id % 5000 AS int)) AS d, CAST(id % 5000 AS string) AS s, id FROM range(25000)"
        " UNION ALL SELECT date'1999-01-01', 'cold', 25000"
    )
    sizes = rows.groupBy("d", "s").agg(F.count(F.lit(1)).alias("n"))
    assert {tuple(r) for r in hot_keys(sizes, ["d", "s"], EAGER, "n").select("_salts").collect()} == {(2,)}
    assert hot_keys(sizes, ["d", "s"], EAGER, "n").count() == 5000
    for size in (None, "n"):
        joined = skewed_lookup(rows, sizes, ["d", "s"], ["id"], EAGER, size)
        assert joined.select("id").distinct().count() == joined.count() == 25001

