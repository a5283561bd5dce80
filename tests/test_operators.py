"""Extraction, merging, comparison, digests and contract checks on small hand-made tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.seed import typed
from tidemark.operators import digest, extract, ledger, merge, parity, quality
from tidemark.session import local_rows, shared_folder
from tidemark.spec import ADVANCES, CONTROL, CUSTOMERS, SchemaDrift

ROW = "k int, part string, v int, at timestamp"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k int, part string, v int, at string").withColumn("at", F.col("at").cast("timestamp"))


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def source(spark):
    return _rows(
        spark,
        [
            (1, "a", 10, "2025-01-01"),
            (1, "b", 11, "2025-01-05"),
            (2, "a", 20, "2025-01-03"),
            (3, "a", 30, "2025-01-04"),
            (4, "a", 40, "2025-01-02"),
        ],
    )


@pytest.fixture(scope="module")
def target(spark):
    return _rows(
        spark,
        [
            (1, "a", 10, "2025-01-01"),
            (2, "a", 19, "2025-01-01"),
            (4, "a", 39, "2025-01-01"),
            (9, "z", 90, "2025-01-01"),
        ],
    )


def test_window_is_open_below_and_closed_above(source):
    got = extract.extract(source, ["k", "v"], "at", "2025-01-03T00:00:00+00:00", "2025-01-05T00:00:00+00:00")
    assert _sorted(got) == [(1, 11), (3, 30)]
    assert got.columns == ["k", "v"]


def test_bound_of_an_empty_source_is_the_floor(spark, source):
    empty = source.where("k > 100")
    bound = extract.upper_bound(empty, "at", ADVANCES.floor)
    text = bound.select(extract.cursor_text(F.col("bound"), empty.schema["at"].dataType)).first()[0]
    assert text == "1970-01-01T00:00:00+00:00"
    assert extract.upper_bound(empty, "k", 0).first()[0] == 0


def test_cursor_text_round_trip(spark):
    df = spark.sql("SELECT timestamp'2025-01-02 03:04:05.006' AS t, timestamp_ntz'2025-01-02 03:04:05' AS n, 7L AS i")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = df.select(*[extract.cursor_text(F.col(c), k).alias(c) for c, k in kinds.items()])
    assert tuple(texts.first()) == ("2025-01-02T03:04:05.006000+00:00", "2025-01-02T03:04:05", "7")
    back = texts.select(*[extract.cursor_value(F.col(c), k).alias(c) for c, k in kinds.items()])
    assert back.first() == df.first()


def test_one_pass_snapshot_equals_upsert_then_reconcile(source, target):
    key = ["k", "part"]
    lower, upper = "2025-01-02T00:00:00+00:00", "2025-01-05T00:00:00+00:00"
    delta = extract.latest_per_key(extract.extract(source, source.columns, "at", lower, upper), key, ["at"])
    stepwise = merge.drop_stale(merge.upsert(target, delta, key), source, key)
    onepass = merge.next_snapshot(target, source, source.columns, key, "at", lower, upper)
    assert _sorted(onepass) == _sorted(stepwise)
    # Key 4 was written at the watermark itself: its new value is missed, its old row stays.
    assert {(r.k, r.part): r.v for r in onepass.collect()} == {(1, "a"): 10, (1, "b"): 11, (2, "a"): 20, (3, "a"): 30, (4, "a"): 39}


def test_latest_per_key_settles_ties_and_totals(spark):
    rows = _rows(spark, [(1, "a", 1, "2025-01-01"), (1, "a", 5, "2025-01-01"), (1, "a", 3, "2024-12-31"), (2, "b", 7, None)])
    got = extract.latest_per_key(rows, ["k"], ["at", "v"], versions=F.count(F.lit(1)))
    assert {r.k: (r.v, r.versions) for r in got.collect()} == {1: (5, 3), 2: (7, 1)}
    assert extract.latest_per_key(rows.select("k"), ["k"], []).count() == 2


def test_change_set_is_exactly_once(spark, target):
    feed = spark.createDataFrame(
        [("U", 1, "a", 100, 1), ("D", 2, "a", None, 1), ("I", 5, "n", 50, 1), ("U", 5, "n", 51, 2), ("D", 9, "z", None, 1)],
        "op string, k int, part string, v int, step int",
    ).withColumn("at", F.lit("2025-02-01").cast("timestamp"))
    once = merge.apply_change_set(target, feed, ["k", "part"], order=["step"])
    assert {r.k: r.v for r in once.collect()} == {1: 100, 4: 39, 5: 51}
    twice = merge.apply_change_set(once, feed, ["k", "part"], order=["step"])
    assert _sorted(once) == _sorted(twice)


def test_append_sequence_replaces_only_above_the_watermark(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, s string")
    delta = spark.createDataFrame([(3, "C"), (4, "d")], "id bigint, s string")
    assert _sorted(merge.append_sequence(stored, delta, "id", 2)) == [(1, "a"), (2, "b"), (3, "C"), (4, "d")]


def test_key_comparison_counts_every_oddity(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (10,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (3,), (None,), (None,)], "k int")
    row = parity.key_audit(parity.key_difference(left, right, ["k"]), ["k"]).first()
    assert row.asDict() == {
        "source_keys": 4, "target_keys": 3, "missing": 2, "stale": 1, "duplicates": 3, "null_keys": 2,
    }
    many = spark.range(100).select(F.col("id").alias("k"))
    sample = parity.difference_sample(parity.key_difference(many, many.where("k < 0"), ["k"]), ["k"])
    assert parity.sample_text(sample).first()[0] == "missing_sample=['0', '1', '10', '11', '12']; stale_sample=[]"


def test_orphans_include_null_references(spark):
    child = spark.createDataFrame([(1,), (1,), (5,), (None,), (2,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk int")
    assert parity.orphan_count(child, "fk", parent, "pk").first().orphans == 2
    assert parity.orphan_count(child.where("fk > 9"), "fk", parent, "pk").first().orphans == 0


def test_digest_ignores_order_but_not_content(spark):
    rows = [(i, None if i % 4 == 0 else f"v{i}", i * 1.5) for i in range(50)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    one = digest.table_digest(df).first()
    assert digest.table_digest(df.repartition(5).orderBy(F.desc("a"))).first() == one
    assert digest.table_digest(df.unionByName(df.limit(1))).first() != one
    shifted = spark.createDataFrame([("ab", "c"), (None, "x")], "p string, q string")
    others = [[("a", "bc"), (None, "x")], [("ab", "c"), ("-", "x")], [("ab", "c"), ("", "x")]]
    for other in others:
        assert digest.table_digest(spark.createDataFrame(other, shifted.schema)).first() != digest.table_digest(shifted).first()
    assert digest.table_digest(df.where("a < 0")).first().asDict() == {"row_count": 0, "checksum": "0"}


def test_payload_counts_written_characters(spark):
    df = spark.sql("SELECT 12 AS a, 'né' AS b, CAST(NULL AS date) AS c, true AS d, timestamp'2025-01-01 00:00:00' AS e")
    assert df.select(digest.payload_bytes(df.schema)).first()[0] == 2 + 3 + 4 + 4 + 25


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_order_breaks_equal_a_plain_scan(spark, partitions):
    """A hot parent, an outlier far away, numbers that occur several times, and missing values."""
    rnd = random.Random(3)
    rows = [(i * 3, 1 if i % 3 == 0 else i % 5, rnd.randrange(20) if rnd.random() < 0.9 else None) for i in range(-50, 150)]
    rows += [(2**62, 1, 3), (2**62 + 1, 1, 2)] + [(i * 3, 1, rnd.randrange(20)) for i in range(0, 90, 4)] * 2
    expected, last = 0, {}
    for seq, parent, value in sorted(rows, key=lambda r: (r[0], r[2] is not None, r[2] or 0)):
        before = last.get(parent)
        expected += value is not None and before is not None and value < before
        last[parent] = value
    df = spark.createDataFrame(rows, "seq bigint, parent int, value int").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert quality.order_breaks(df, "parent", "seq", "value").first().decreases == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_monotonic_sequence_reports_replayed_ids(spark):
    df = spark.createDataFrame([(3, 1, 5), (4, 1, 4), (9, 2, 1)], "history_id bigint, advance_id int, changed_at int")
    assert tuple(quality.monotonic_sequence(df, 3, "advance_id", "history_id", "changed_at").first()) == (1, 1)


def test_constraints_count_nulls_as_violations(spark):
    rows = [(1, 1, "funded", 5), (2, None, "lost", -1), (3, 3, None, None)]
    df = spark.createDataFrame(rows, "advance_id int, customer_id int, status string, amount_cents bigint")
    got = quality.constraint_violations(df, "advances", quality.advance_rules(), unique=("status",))
    assert {r.rule: r.violations for r in got.collect()} == {
        "status_in_enum": 2, "amount_not_negative": 2, "customer_id_not_null": 1, "status_unique": 0,
    }


def test_gate_raises_only_on_fail(spark):
    columns = ", ".join(f"{c} string" for c in quality.VERDICT)
    ok = spark.createDataFrame([("a", "t", "d", "PASS", "", "", ""), ("b", "t", "d", "WARN", "", "", "")], columns)
    assert len(quality.gate(ok)) == 2
    bad = ok.unionByName(spark.createDataFrame([("c", "t", "d", "FAIL", "", "", "")], columns))
    with pytest.raises(quality.QualityGateError) as e:
        quality.gate(bad)
    assert len(e.value.results) == 3 and "t.c" in str(e.value)
    assert tuple(quality.gate_decision(bad).first()) == (1, 1, 1, False)


def test_schema_drift_fails_before_reading(spark):
    good = typed(spark, ADVANCES, [(1, 1, "funded", 1, "2025-01-01", "2025-01-01")]).withColumn("extra", F.lit(1))
    assert ADVANCES.check(good).columns == ADVANCES.columns
    with pytest.raises(SchemaDrift, match="amount_cents: declared bigint, found string"):
        ADVANCES.check(good.withColumn("amount_cents", F.lit("1")))
    with pytest.raises(SchemaDrift, match="status: declared string, found nothing"):
        ADVANCES.check(good.drop("status"))
    assert CUSTOMERS.target_schema.fieldNames()[-2:] == ["_loaded_at", "_run_id"]


def test_run_states_prefer_the_finished_event(spark):
    events = spark.createDataFrame(
        [("r1", "RUNNING", "2025-01-01", None), ("r1", "SUCCESS", "2025-01-01", "2025-01-02"), ("r2", "RUNNING", "2025-01-03", None)],
        "run_id string, status string, started_at string, finished_at string",
    ).withColumn("error_message", F.lit(None).cast("string"))
    runs = ledger.latest_runs(ledger.run_states(events), 5).collect()
    assert [(r.run_id, r.status) for r in runs] == [("r2", "RUNNING"), ("r1", "SUCCESS")]


def test_append_only_metrics_report_no_scan(spark):
    rows = spark.createDataFrame([(1, "x")], "id bigint, s string")
    got = {r.metric_name: r.metric_value for r in ledger.sync_metrics("t", rows, rows.schema, None, None).collect()}
    assert got == {
        "rows_extracted": 1, "rows_upserted": 1, "rows_deleted": 0, "payload_bytes_estimated": 2, "source_keys_scanned": 0,
    }


def test_shared_folder_is_the_checkpoint_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_local_rows_take_text_for_instants(spark):
    row = local_rows(spark, [("s", "c", "1", "2025-01-01T00:00:00+00:00", "r")], CONTROL["watermarks"])
    assert row.schema.fieldNames() == CONTROL["watermarks"].fieldNames()
    assert row.select(F.unix_timestamp("updated_at")).first()[0] == 1735689600
    assert local_rows(spark, [], CONTROL["watermarks"]).count() == 0


def _keys(spark, rows):
    return spark.createDataFrame(rows, "k long, t string").repartition(3)


def test_no_key_is_shuffled_where_nothing_changed(spark):
    """Sides of the same keys only meet as checksums; a changed key brings its range along, and no other."""
    rows = [(n % 900, f"t{n // 900}") for n in range(1_800)] + [(None, "x"), (5, None)]
    source, target = _keys(spark, rows), _keys(spark, rows[::-1])
    kept = parity.in_differing_ranges(source, target, ["k", "t"], ranges=64)
    assert [df.count() for df in kept] == [0, 0]
    changed = _keys(spark, [r for r in rows if r != (7, "t1")] + [(10**6, "new")])
    kept = parity.in_differing_ranges(source, changed, ["k", "t"], ranges=64)
    assert all(0 < df.count() < len(rows) / 8 for df in kept)
    found = parity.changed_difference(source, changed, ["k", "t"], ranges=64)
    assert {(r.k, r.t) for r in found.where("target_rows = 0").collect()} == {(7, "t1")}
    assert {(r.k, r.t) for r in found.where("NOT in_source").collect()} == {(10**6, "new")}


def test_checksums_find_what_a_full_comparison_finds(spark):
    rnd = random.Random(6)
    for _ in range(4):
        pool = [(rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b"])) for _ in range(60)]
        source, target = _keys(spark, rnd.choices(pool, k=50)), _keys(spark, rnd.choices(pool, k=50))
        full = parity.key_difference(source, target, ["k", "t"])
        rows = lambda df: sorted(map(str, df.select("k", "t").collect()))
        assert rows(parity.missing_keys(target, source, ["k", "t"])) == rows(full.where("target_rows = 0"))
        assert rows(parity.stale_keys(target, source, ["k", "t"])) == rows(full.where("NOT in_source"))
        delta, rest = source.distinct().where("k % 3 = 0 OR k IS NULL"), source.where("k % 3 <> 0")
        want = {(r.k, r.t): False for r in delta.intersect(target).collect()} | {(r.k, r.t): True for r in full.where("NOT in_source").collect()}
        assert {(r.k, r.t): r.stale for r in parity.leaving_keys(target, rest, delta, ["k", "t"]).collect()} == want
