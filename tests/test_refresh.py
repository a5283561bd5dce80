"""Derived tables after a change: equal to a full rebuild, from the touched groups alone."""

from __future__ import annotations

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from tests import seed
from tidemark.operators import identity
from tidemark.operators.refresh import affected_customers, changed_keys, refresh
from tidemark.plans.load import Load
from tidemark.sources.warehouse import Warehouse
from tidemark.spec import TABLES

CUSTOMERS = (
    "customer_id long, government_id string, first_name string, last_name string, birth_date string, email string, phone string,"
    " is_test boolean, created_at string, updated_at string, _run_id string"
)
ADVANCES = "advance_id long, customer_id long, status string, _run_id string"
CARDS = "card_id string, customer_id long, token string, last_four string, status string, _run_id string"
KEYS = {"customers_raw": "customer_id", "advances_raw": "advance_id", "cards_raw": "card_id"}


def _customer(rnd, k, run):
    proof = rnd.choice([None, "", f"id {rnd.randrange(60)}", f"ID-{rnd.randrange(60)}"])
    mail = rnd.choice([None, "odd", f"m{rnd.randrange(40)}@x.org", f" M{rnd.randrange(40)}@x.org"])
    day = f"2024-0{rnd.randint(1, 9)}-01"
    return (k, proof, f"f{k}", rnd.choice(["", "l"]), rnd.choice([None, "1990-01-01", "1991-01-01"]), mail, rnd.choice([None, "+351 912 000 011"]),
            rnd.random() < 0.1, day, day, run)


def _advance(rnd, k, run):
    return (k, rnd.randrange(220), rnd.choice(["funded", "requested", "cancelled", "cancelled"]), run)


def _card(rnd, k, run):
    return (f"c{k}", rnd.randrange(220), f"t{k}", "0101", "active", run)


MAKE = {"customers_raw": _customer, "advances_raw": _advance, "cards_raw": _card}


def _frames(spark, rows):
    kinds = {"customers_raw": CUSTOMERS, "advances_raw": ADVANCES, "cards_raw": CARDS}
    out = {t: spark.createDataFrame(list(rows[t].values()), kinds[t]) for t in rows}
    dated = {c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")} | {"birth_date": F.col("birth_date").cast("date")}
    return out | {"customers_raw": out["customers_raw"].withColumns(dated)}


def _rebuilt(raw):
    resolved = identity.resolve(raw["customers_raw"], raw["advances_raw"])
    alias, groups = identity.aliases(resolved), identity.review_groups(resolved)
    return {
        "customer_alias": alias, "customer_master": identity.golden_records(resolved), "identity_conflicts": identity.conflicts(resolved),
        "cards_master": identity.remap_cards(raw["cards_raw"], alias), "identity_review_groups": groups,
        "identity_review_members": identity.review_members(resolved, groups),
    }


def _listed(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("step", range(2))
def test_refreshed_tables_equal_a_rebuild(spark, tmp_path, step):
    rnd = random.Random(step)
    sizes = {"customers_raw": 200, "advances_raw": 40, "cards_raw": 80}
    rows = {t: {k: MAKE[t](rnd, k, "r1") for k in range(n)} for t, n in sizes.items()}
    later = {t: dict(own) for t, own in rows.items()}
    for t, own in later.items():
        for k in rnd.sample(range(sizes[t]), 3):
            if rnd.random() < 0.4:
                del own[k]
            else:
                own[k] = MAKE[t](rnd, k, "r2")
        own[10_000] = MAKE[t](rnd, 10_000, "r2")
    before, after = _frames(spark, rows), _frames(spark, later)

    def keep(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    changed = {t: keep(f"changed_{t}", changed_keys(before[t], after[t], [key], "_run_id", "r2")) for t, key in KEYS.items()}
    old = {t: keep(f"old_{t}", df) for t, df in _rebuilt(before).items()}
    new = _rebuilt(after)
    for table, found in refresh(before, after, old, changed, keep).items():
        assert _listed(found.onto(old[table]), new[table].columns) == _listed(new[table], new[table].columns), table
    read = affected_customers(before, after, changed).count()  # all that is resolved again
    assert read < 60 and read < 0.3 * after["customers_raw"].count()
    assert spark.read.parquet(f"{tmp_path}/members").count() <= read


def test_an_incremental_load_equals_a_fresh_one(spark, tmp_path):
    specs = tuple(dataclasses.replace(s, buckets=2) for s in TABLES)
    tables = seed.source(spark)
    wanted = seed.changed(spark, tables)
    load = Load(Warehouse(spark, str(tmp_path / "wh")), specs, incremental=True)
    load.run(tables, run_id="r1", run_at="2025-04-01T00:00:00+00:00")
    load.run(wanted, run_id="r2", run_at="2025-04-02T00:00:00+00:00", check_quality=True)
    fresh = Load(Warehouse(spark, str(tmp_path / "fresh")), specs)
    fresh.run(wanted)
    assert load.digest() == fresh.digest()
    for table in ("identity_conflicts", "identity_review_groups", "identity_review_members"):
        drop = ("detected_at", "_run_id")
        assert sorted(map(str, load.table(table).drop(*drop).collect())) == sorted(map(str, fresh.table(table).drop(*drop).collect()))
    kept = load.table("customer_alias").where("_run_id = 'r1'").count()
    assert 0 < kept < load.table("customer_alias").count()  # rows no change touched are those of the first run
