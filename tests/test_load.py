"""Whole loads over the seed: exact results, replay, failure and recovery."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from tests import seed
from tidemark.operators import quality
from tidemark.operators.ledger import declared_metadata
from tidemark.operators.quality import QualityGateError
from tidemark.plans.load import Load
from tidemark.sources.warehouse import Warehouse
from tidemark.spec import HISTORY, TABLES, TRANSACTIONS

SPECS = tuple(dataclasses.replace(s, buckets=4) for s in TABLES)
METADATA = declared_metadata(
    1,
    {
        spec.target: {
            "owner": "data", "source": f"db.{spec.source}", "classification": "internal",
            "contains_pii": False, "masking_required": False, "criticality": "high", "refresh": "on-demand",
            "retention_days": 2555, "strategy": spec.strategy, "primary_key": spec.key[0],
            "dq_checks": ["source_key_parity", "null_key"],
        }
        for spec in SPECS
    },
)


class Stop(RuntimeError):
    pass


def stop_after(name):
    def hook(spec):
        if spec.source == name:
            raise Stop(f"stopped after {name}")

    return hook


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The seed and its successor as stored files, as a real source would be."""
    root = tmp_path_factory.mktemp("source")
    first = seed.source(spark)
    states = {}
    for label, state in (("before", first), ("after", seed.changed(spark, first))):
        states[label] = {}
        for name, df in state.items():
            df.coalesce(2).write.parquet(f"{root}/{label}/{name}")
            states[label][name] = spark.read.schema(df.schema).parquet(f"{root}/{label}/{name}")
    return states


@pytest.fixture(scope="module")
def story(spark, tables, tmp_path_factory):
    """Initial load, replay, failed load, recovered load, with what was seen after each."""
    load = Load(Warehouse(spark, str(tmp_path_factory.mktemp("wh"))), SPECS, metadata=METADATA, parallel=4)
    seen = {}

    def note(label, summary=None):
        state = load.wh.state()
        seen[label] = {
            "summary": summary,
            "digest": load.digest(),
            "counts": {r.table_name: r.row_count for r in load.inspect()["counts"].collect()},
            "tables": {n: [r.asDict() for r in load.table(n).collect()] for n in (
                "customer_master", "customer_alias", "identity_review_members", "identity_conflicts",
                "cards_master", "watermarks", "dataset_metadata", "pipeline_metrics", "dq_results")},
            "state": state,
        }

    note("first", load.run(tables["before"], run_id="r1", run_at="2025-04-01T00:00:00+00:00", check_quality=True))
    note("replay", load.run(tables["before"], run_id="r2", run_at="2025-04-02T00:00:00+00:00", check_quality=True))
    with pytest.raises(Stop):
        load.run(tables["after"], run_id="r3", run_at="2025-04-03T00:00:00+00:00", after_table=stop_after("customers"))
    note("failed")
    note("recovered", load.run(tables["after"], run_id="r4", run_at="2025-04-04T00:00:00+00:00", check_quality=True))
    seen["load"] = load
    return seen


def test_initial_load_counts(story):
    first = story["first"]
    extracted = {n: m.extracted for n, m in first["summary"].synced.items()}
    assert extracted == {
        "customers": 10, "advances": 5, "cards": 5, "transactions": 700, "advance_status_history": 5,
    }
    assert first["counts"]["transactions_raw"] == 700
    assert first["summary"].identities == {
        "master_customers": 7, "aliases": 9, "proven_merges": 2, "identity_conflicts": 2,
    }
    assert {n: m.metrics["source_keys_scanned"] for n, m in first["summary"].synced.items()} == {
        "customers": 10, "advances": 5, "cards": 5, "transactions": 700, "advance_status_history": 0,
    }


def test_initial_identity(story):
    t = story["first"]["tables"]
    alias = {r["source_customer_id"]: (r["master_customer_id"], r["resolution_rule"]) for r in t["customer_alias"]}
    assert alias == {
        11: (11, "government_id+deterministic_survivor"), 12: (11, "government_id+deterministic_survivor"),
        13: (13, "protected_conflict"), 14: (14, "protected_conflict"), 15: (15, "protected_conflict"),
        17: (17, "no_proven_identity"), 18: (18, "no_proven_identity"),
        19: (20, "government_id+protected_advance"), 20: (20, "government_id+protected_advance"),
    }
    masters = {r["master_customer_id"]: r for r in t["customer_master"]}
    assert sorted(masters) == [11, 13, 14, 15, 17, 18, 20]
    assert {m: r["source_record_count"] for m, r in masters.items() if r["source_record_count"] > 1} == {11: 2, 20: 2}
    assert masters[11]["government_id"] == "PT 55-01" and masters[18]["government_id"] is None
    assert [m for m in sorted(masters) if masters[m]["protected_by_advance"]] == [13, 14, 20]
    assert (masters[20]["email"], masters[20]["email_valid"], masters[20]["phone_valid"]) == ("jo(at)mail", False, True)
    groups: dict = {}
    for r in t["identity_review_members"]:
        groups.setdefault((r["email"], r["birth_date"]), {})[r["customer_id"]] = r["master_customer_id"]
    pairs = sorted((a, b) for g in groups.values() for a in g for b in g if a < b and g[a] != g[b])
    assert pairs == [(13, 14), (17, 18)] and story["first"]["counts"]["identity_review_candidates"] == 2
    assert sorted((r["conflict_key"], r["customer_id"]) for r in t["identity_conflicts"]) == [("PT77", 13), ("PT77", 14)]
    assert {r["card_id"]: (r["source_customer_id"], r["master_customer_id"]) for r in t["cards_master"]} == {
        "c-a": (12, 11), "c-b": (13, 13), "c-d": (19, 20), "c-e": (18, 18),
    }


def test_initial_quality_and_metadata(story):
    verdicts = story["first"]["summary"].verdicts
    assert len(verdicts) == 32  # the 21 of a load, null keys and constraints of five tables, one sequence
    assert {v.check_name: v.actual for v in verdicts if v.status == "WARN"} == {
        "protected_identity_conflicts": "1", "suggestive_match_candidates": "2",
        "malformed_email_count": "3", "malformed_phone_count": "2",
    }
    assert not [v for v in verdicts if v.status == "FAIL"]
    parity = {v.dataset: v for v in verdicts if v.check_name == "source_key_parity"}["customers_raw"]
    assert parity.expected == "10 source keys; 0 missing; 0 stale"
    assert parity.actual == "10 warehouse keys; 0 missing; 0 stale"
    assert parity.details == "missing_sample=[]; stale_sample=[]"
    assert len(story["first"]["tables"]["dataset_metadata"]) == 5
    assert {r["dq_checks"] for r in story["first"]["tables"]["dataset_metadata"]} == {"source_key_parity,null_key"}


def test_replay_extracts_nothing(story):
    replay = story["replay"]
    assert {m.extracted for m in replay["summary"].synced.values()} == {0}
    assert {m.deleted for m in replay["summary"].synced.values()} == {0}
    assert replay["digest"] == story["first"]["digest"]
    # An unchanged table keeps its folders: nothing was copied.
    for spec in SPECS:
        assert replay["state"].folders(spec.target) == story["first"]["state"].folders(spec.target)


def test_failure_leaves_no_trace_but_the_run(story):
    failed = story["failed"]
    assert failed["digest"] == story["replay"]["digest"]
    assert failed["tables"]["watermarks"] == story["replay"]["tables"]["watermarks"]
    assert len(failed["tables"]["pipeline_metrics"]) == len(story["replay"]["tables"]["pipeline_metrics"])


def test_recovery_applies_the_change_set(story):
    recovered = story["recovered"]
    m = recovered["summary"].synced
    assert {n: x.extracted for n, x in m.items()} == {
        "customers": 2, "advances": 1, "cards": 1, "transactions": 1, "advance_status_history": 0,
    }
    assert {n: x.deleted for n, x in m.items() if x.deleted} == {"cards": 1, "transactions": 1}
    counts = recovered["counts"]
    assert (counts["customers_raw"], counts["customer_master"], counts["customer_alias"]) == (11, 8, 10)
    assert (counts["cards_raw"], counts["cards_master"], counts["transactions_raw"]) == (5, 4, 700)
    marks = {r["source_table"]: r["cursor_value"] for r in recovered["tables"]["watermarks"]}
    assert marks == {
        "customers": "2024-10-01T08:30:00+00:00", "cards": "2024-10-01T09:10:00+00:00",
        "transactions": "2024-10-01T09:20:00+00:00", "advances": "2024-10-01T09:00:00+00:00",
        "advance_status_history": "5",
    }
    assert recovered["digest"] != story["failed"]["digest"]
    phone = [r for r in recovered["tables"]["customer_master"] if r["master_customer_id"] == 17][0]["phone"]
    assert phone == "+351 912 999 017"


def test_change_writes_only_the_buckets_it_hits(story):
    before = set(story["failed"]["state"].parts("transactions_raw"))
    after = set(story["recovered"]["state"].parts("transactions_raw"))
    assert before & after and len({p.bucket for p in after - before}) <= 2  # one new row, one deleted
    untouched = {p.bucket for p in before} - {p.bucket for p in after - before}
    assert {p for p in before if p.bucket in untouched} == {p for p in after if p.bucket in untouched}


def test_nothing_staged_is_left(spark, story):
    load = story["load"]
    for name in ("members", "resolution", "dq_results"):
        assert not load.wh._listed(f"{load.wh.root}/data/_stage_{name}")


def test_run_ledger(story):
    load = story["load"]
    runs = {r.run_id: r for r in load.inspect()["runs"].collect()}
    assert {k: r.status for k, r in runs.items()} == {
        "r1": "SUCCESS", "r2": "SUCCESS", "r3": "FAILED", "r4": "SUCCESS",
    }
    assert runs["r3"].error_message == "stopped after customers"
    assert {r.status: r.n for r in load.inspect()["quality"].collect()} == {"PASS": 28, "WARN": 4}


def test_incremental_state_equals_a_fresh_load(spark, tables, story, tmp_path):
    fresh = Load(Warehouse(spark, str(tmp_path)), SPECS)
    fresh.run(tables["after"])
    assert fresh.digest() == story["recovered"]["digest"]


def test_gate_keeps_evidence_and_blocks_publish(spark, tables, story):
    """A source row with an already passed cursor is never extracted: parity must fail the load."""
    load = story["load"]
    before = load.digest()
    late = tables["after"]["transactions"].where("transaction_id = 900002").withColumn("transaction_id", F.lit(7).cast("bigint"))
    broken = {**tables["after"], "transactions": tables["after"]["transactions"].unionByName(late)}
    with pytest.raises(QualityGateError) as e:
        load.run(broken, run_id="r5", run_at="2025-04-05T00:00:00+00:00", check_quality=True)
    failed = [r for r in e.value.results if r.status == "FAIL"]
    assert [(r.dataset, r.check_name) for r in failed] == [("transactions_raw", "source_key_parity")]
    assert failed[0].details == "missing_sample=['7']; stale_sample=[]"
    assert load.digest() == before
    kept = load.table("dq_results").where("run_id = 'r5'")
    assert kept.count() == 32
    assert load.table("pipeline_metrics").where("run_id = 'r5'").count() == 0


def test_standalone_quality_detects_a_lost_row(spark, tables, story):
    """A warehouse row lost outside a load flips exactly the parity check of its table."""
    load = story["load"]
    extra = {**tables["after"]}
    victim = extra["cards"].agg(F.min("card_id").alias("m")).first().m
    extra["cards"] = extra["cards"].where(F.col("card_id") != victim)
    rows = load.check(extra, run_id="quality-x", persist=False)
    assert [(r.dataset, r.check_name) for r in rows if r.status == "FAIL"] == [("cards_raw", "source_key_parity")]
    assert load.table("dq_results").where("run_id = 'quality-x'").count() == 0


def test_unchanged_inputs_may_keep_the_derived_tables(tables, story):
    load = story["load"]
    before = load.wh.state()
    thrifty = Load(load.wh, SPECS, reuse_unchanged=True)
    summary = thrifty.run(tables["after"], run_id="r6", run_at="2025-04-06T00:00:00+00:00")
    after = load.wh.state()
    assert summary.identities == story["recovered"]["summary"].identities
    for table in ("customer_master", "customer_alias", "cards_master", "identity_conflicts"):
        assert after.folders(table) == before.folders(table)


def test_corruption_of_the_copy_is_detected(spark, tables, story):
    """The smallest transaction is missing from the copy: parity fails and names it."""
    copy = story["load"].table("transactions_raw")
    victim = copy.agg(F.min("transaction_id")).first()[0]
    rows = quality.key_checks(TRANSACTIONS, tables["after"]["transactions"], copy.where(F.col("transaction_id") != victim))
    _, parity, unique = sorted(rows.collect(), key=lambda r: r.check_name)
    assert (parity.status, unique.status) == ("FAIL", "PASS")
    assert parity.actual == "699 warehouse keys; 1 missing; 0 stale"
    assert parity.details == f"missing_sample=['{victim}']; stale_sample=[]"


def test_a_delete_in_an_append_only_source_stays_a_failure(spark, tables, story):
    copy = story["load"].table("advance_status_history_raw")
    shrunk = tables["after"]["advance_status_history"].where("history_id <> 2")
    parity = quality.key_checks(HISTORY, shrunk, copy).where("check_name = 'source_key_parity'").first()
    assert (parity.status, parity.details) == ("FAIL", "missing_sample=[]; stale_sample=['2']")
