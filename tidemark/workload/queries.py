"""Every operator as a query over the benchmark tables.

Each function takes the session and the data folder and returns a DataFrame.
Dates and instants are shown as text so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import (
    completeness_score,
    normalize_email,
    normalize_government_id,
    valid_email,
    valid_phone,
)
from tidemark.operators import digest, extract, identity, ledger, merge, parity, quality, suite
from tidemark.session import shared_folder
from tidemark.workload.fixtures import WATERMARK, base, load
from tidemark.workload.published import publish_orders, replay_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ["o_orderkey"]
CURSOR = "updated_at"
ASKED = 100  # a reviewer asks about every so many'th customer


def _shown(df: DataFrame) -> DataFrame:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name) for f in df.schema.fields]
    )


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: _shown(fn(spark, sf_dir))
    return fn


# --- shared inputs --------------------------------------------------------------------------


def _customers(spark, d):
    return load(spark, d, "fx_customers")


def _advances(spark, d):
    return load(spark, d, "fx_advances")


def _cards(spark, d):
    return load(spark, d, "fx_cards")


def _source(spark, d):
    return load(spark, d, "fx_src_orders")


def _target(spark, d):
    return load(spark, d, "fx_tgt_orders")


def _people(spark, d):
    return identity.members(_customers(spark, d), _advances(spark, d))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, as a load has its members, its resolution and its derived tables."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _resolved(spark, d):
    """The resolution, made once and read by all that follows from it."""
    return _kept(identity.resolve_members(_kept(_people(spark, d), "members")), "resolved")


def _alias(spark, d):
    return identity.aliases(_resolved(spark, d))


def _upper(source: DataFrame):
    """The captured bound of a run: one value."""
    kind = source.schema[CURSOR].dataType
    bound = extract.upper_bound(source, CURSOR, "1970-01-01T00:00:00")
    return bound.select(extract.cursor_text(F.col("bound"), kind).alias("v")).first()["v"]


def _delta(source: DataFrame) -> DataFrame:
    rows = extract.extract(source, source.columns, CURSOR, WATERMARK, _upper(source))
    return extract.latest_per_key(rows, KEY, [CURSOR])


def _new_root(spark):
    return f"{shared_folder(spark)}/published-{uuid4().hex}"


def _reconciled(spark, d):
    source = _source(spark, d)
    return merge.next_snapshot(_target(spark, d), source, source.columns, KEY, CURSOR, WATERMARK, _upper(source))


# --- extraction -----------------------------------------------------------------------------


@query
def incremental_extract(spark, d):
    orders = base(spark, d, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]
    kind = orders.schema["o_orderdate"].dataType
    bound = extract.upper_bound(orders, "o_orderdate", "1970-01-01T00:00:00")
    upper = bound.select(extract.cursor_text(F.col("bound"), kind).alias("v")).first()["v"]
    return extract.extract(orders, columns, "o_orderdate", WATERMARK, upper)


@query
def upper_bound(spark, d):
    return extract.upper_bound(base(spark, d, "orders"), "o_orderdate", "1970-01-01T00:00:00")


@query
def latest_per_key(spark, d):
    # All columns take part in the order, so versions of one instant are settled too.
    return extract.latest_per_key(load(spark, d, "fx_transactions"), ["transaction_id"], ["updated_at", "amount_cents"])


@query
def generated_transactions(spark, d):
    """A generated series per line: its price in as many installments as its line number, a minute apart."""
    series = base(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.explode(F.sequence(F.lit(1), "l_linenumber")).alias("n"),
    )
    return series.select(
        F.col("l_orderkey").alias("advance_id"),
        F.col("n").alias("installment"),
        F.when(F.col("n") == F.col("l_linenumber"), F.lit("repayment")).otherwise(F.lit("disbursement")).alias("transaction_type"),
        F.expr("cents div l_linenumber").alias("amount_cents"),
        (F.col("l_shipdate") + F.expr("make_interval(0, 0, 0, 0, 0, n, 0)")).alias("occurred_at"),
    )


@query
def insert_select_history(spark, d):
    """An append-only table after an insert-select from another table.

    The inserted rows continue the sequence above everything stored.
    """
    history = load(spark, d, "fx_history")
    top = history.agg(F.max("history_id")).first()[0]
    inserted = _advances(spark, d).select(
        (F.col("advance_id") + F.lit(top + 1)).alias("history_id"),
        "advance_id",
        "status",
        F.col("updated_at").alias("changed_at"),
    )
    return merge.append_sequence(history, inserted, "history_id", top)


# --- scalar functions -----------------------------------------------------------------------


@query
def non_test_customers(spark, d):
    return _customers(spark, d).where(~F.col("is_test")).select("customer_id", "first_name", "last_name")


@query
def normalize_government_id_(spark, d):
    return _customers(spark, d).select(
        "customer_id", "government_id", normalize_government_id("government_id").alias("normalized")
    )


@query
def normalize_email_(spark, d):
    return _customers(spark, d).select("customer_id", "email", normalize_email("email").alias("normalized"))


@query
def valid_email_(spark, d):
    return _customers(spark, d).select("customer_id", "email", valid_email("email").alias("is_valid"))


@query
def valid_phone_(spark, d):
    return _customers(spark, d).select("customer_id", "phone", valid_phone("phone").alias("is_valid"))


@query
def completeness_score_(spark, d):
    return _customers(spark, d).select("customer_id", completeness_score().alias("score"))


for _name in ("normalize_government_id", "normalize_email", "valid_email", "valid_phone", "completeness_score"):
    QUERIES[_name] = QUERIES.pop(_name + "_")


@query
def row_to_json(spark, d):
    customer = base(spark, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    )
    payload = F.to_json(F.struct(*customer.columns), {"ignoreNullFields": "false"})
    return customer.select("c_custkey", payload.alias("payload"))


# --- identity -------------------------------------------------------------------------------


@query
def protected_customers(spark, d):
    return identity.protected_customers(_advances(spark, d))


@query
def protected_flag(spark, d):
    return _people(spark, d).select("customer_id", "is_protected")


@query
def identity_groups(spark, d):
    return identity.group_decisions(_people(spark, d)).select("proof_key", "n_members", "n_protected")


@query
def survivors(spark, d):
    return identity.survivors(_people(spark, d))


@query
def customer_alias(spark, d):
    return _alias(spark, d)


@query
def customer_master(spark, d):
    return identity.golden_records(_resolved(spark, d))


@query
def identity_conflicts(spark, d):
    return identity.conflicts(_resolved(spark, d))


@query
def review_groups(spark, d):
    groups = identity.review_groups(_resolved(spark, d))
    return groups.withColumn("pairs", F.col("pairs").cast("string"))


@query
def review_members(spark, d):
    resolved = _resolved(spark, d)
    members = identity.review_members(resolved, identity.review_groups(resolved))
    return members.select("email", "birth_date", "customer_id", "master_customer_id")


@query
def review_partners(spark, d):
    """The candidate pairs of every customer whose id is divisible by ``ASKED``."""
    asked = _customers(spark, d).where(F.col("customer_id") % ASKED == 0)
    return identity.review_partners(_resolved(spark, d), asked)


@query
def cards_master(spark, d):
    return identity.remap_cards(_cards(spark, d), _alias(spark, d))


@query
def identity_metrics(spark, d):
    resolved = _resolved(spark, d)
    return identity.identity_metrics(identity.aliases(resolved), identity.conflicts(resolved))


# --- keys and relationships -----------------------------------------------------------------


@query
def orphan_cards(spark, d):
    return parity.orphan_count(_cards(spark, d), "customer_id", _customers(spark, d), "customer_id")


@query
def orphan_advances(spark, d):
    return parity.orphan_count(_advances(spark, d), "customer_id", _customers(spark, d), "customer_id")


@query
def orphan_transactions(spark, d):
    return parity.orphan_count(load(spark, d, "fx_transactions"), "advance_id", _advances(spark, d), "advance_id")


@query
def orphan_cards_master(spark, d):
    resolved = _resolved(spark, d)
    remapped = identity.remap_cards(_cards(spark, d), identity.aliases(resolved))
    return parity.orphan_count(remapped, "master_customer_id", identity.golden_records(resolved), "master_customer_id")


@query
def orphan_cards_before_remap(spark, d):
    """The same check on cards that were not remapped: those of merged customers have no master."""
    masters = _alias(spark, d).select("master_customer_id")
    return parity.orphan_count(_cards(spark, d), "customer_id", masters, "master_customer_id")


@query
def stale_keys(spark, d):
    return parity.stale_keys(_target(spark, d), _source(spark, d), KEY)


@query
def missing_keys(spark, d):
    return parity.missing_keys(_target(spark, d), _source(spark, d), KEY)


@query
def key_parity(spark, d):
    return parity.key_audit(parity.key_difference(_source(spark, d), _target(spark, d), KEY), KEY)


@query
def key_parity_sample(spark, d):
    return parity.difference_sample(parity.changed_difference(_source(spark, d), _target(spark, d), KEY), KEY)


@query
def duplicate_keys(spark, d):
    return quality.duplicate_rows(load(spark, d, "fx_transactions"), ["transaction_id"])


@query
def null_keys(spark, d):
    return quality.null_keys(_customers(spark, d), ["government_id"])


@query
def constraint_violations(spark, d):
    priced = _advances(spark, d).withColumn(
        "status", F.when(F.col("amount_cents") < 150000, F.lit("unknown")).otherwise(F.col("status"))
    )
    cards = _cards(spark, d).withColumn(
        "token", F.when(F.col("status") == "inactive", F.lit(None)).otherwise(F.col("last_four"))
    )
    return quality.constraint_violations(priced, "advances", quality.advance_rules()).unionByName(
        quality.constraint_violations(cards, "cards", quality.card_rules(), unique=("token",))
    )


@query
def monotonic_sequence(spark, d):
    return quality.monotonic_sequence(load(spark, d, "fx_history"), -1, "advance_id", "history_id", "changed_at")


@query
def order_breaks(spark, d):
    """The same check where it does find something: ship dates in order of the line key."""
    lines = extract.latest_per_key(load(spark, d, "fx_transactions"), ["transaction_id"], ["updated_at", "amount_cents"])
    return quality.order_breaks(lines, "advance_id", "transaction_id", "updated_at")


# --- checks ---------------------------------------------------------------------------------


@query
def check_alias_coverage(spark, d):
    return quality.coverage(_customers(spark, d), _alias(spark, d))


@query
def check_test_data_excluded(spark, d):
    return quality.leaked_test_customers(_customers(spark, d), _alias(spark, d))


@query
def check_protected_survives(spark, d):
    return quality.remapped_protected(_advances(spark, d), _alias(spark, d))


@query
def check_identity_conflicts(spark, d):
    found = identity.conflicts(_resolved(spark, d))
    return found.agg(F.count_distinct("conflict_key").alias("conflicts"))


@query
def check_review_candidates(spark, d):
    pairs = quality.candidate_pairs(identity.review_groups(_resolved(spark, d)))
    return pairs.select(F.col("pairs").cast("string").alias("pairs"))


@query
def malformed_contacts(spark, d):
    return quality.malformed_contacts(_customers(spark, d))


def _suite(spark, d) -> DataFrame:
    """The whole suite on all five tables; every stored copy lacks rows of its source and holds keys the source lacks."""
    resolved = _resolved(spark, d)
    alias = identity.aliases(resolved)
    sources = {
        "customers": _customers(spark, d),
        "advances": _advances(spark, d),
        "cards": _cards(spark, d),
        "transactions": load(spark, d, "fx_transactions"),
        "advance_status_history": load(spark, d, "fx_history"),
    }
    stored = {name: "history" if name.endswith("history") else name for name in sources}
    wh = {f"{name}_raw": load(spark, d, f"fx_stored_{copy}") for name, copy in stored.items()} | {
        "customer_alias": alias,
        "customer_master": _kept(identity.golden_records(resolved), "master"),
        "cards_master": _kept(identity.remap_cards(sources["cards"], alias), "cards"),
        "identity_conflicts": identity.conflicts(resolved),
        "identity_review_groups": identity.review_groups(resolved),
    }
    return suite.quality_suite(sources, wh)


@query
def dq_suite(spark, d):
    return _suite(spark, d)


@query
def dq_gate(spark, d):
    return quality.gate_decision(_suite(spark, d))


@query
def dq_status_summary(spark, d):
    return quality.status_summary(load(spark, d, "fx_dq_results"))


# --- mutation -------------------------------------------------------------------------------


@query
def upsert_snapshot(spark, d):
    return merge.upsert(_target(spark, d), _delta(_source(spark, d)), KEY)


@query
def reconciled_snapshot(spark, d):
    return _reconciled(spark, d)


@query
def apply_change_set(spark, d):
    orders = load(spark, d, "fx_tgt_orders")
    return merge.apply_change_set(orders, load(spark, d, "fx_changes"), KEY, [CURSOR])


@query
def replay_is_noop(spark, d):
    """A third sync through the warehouse, of the source the second one read: nothing moves, the state stays."""
    return replay_orders(spark, _new_root(spark), _target(spark, d), _source(spark, d), WATERMARK)


@query
def payload_bytes(spark, d):
    delta = extract.extract(_source(spark, d), _source(spark, d).columns, CURSOR, WATERMARK, _upper(_source(spark, d)))
    return delta.agg(F.sum(digest.payload_bytes(delta.schema)).alias("payload_bytes"), F.count(F.lit(1)).alias("row_count"))


@query
def sync_metrics(spark, d):
    source = _source(spark, d)
    extracted = extract.extract(source, source.columns, CURSOR, WATERMARK, _upper(source))
    stale = parity.stale_keys(_target(spark, d), source, KEY)
    return ledger.sync_metrics("orders", extracted, source.schema, stale, source)


@query
def table_digest(spark, d):
    named = {"source": _source(spark, d), "reconciled": _reconciled(spark, d)}
    parts = [digest.table_digest(df).withColumn("table_name", F.lit(n)) for n, df in named.items()]
    return parts[0].unionByName(parts[1])


# --- ledger and reports ---------------------------------------------------------------------


@query
def latest_runs(spark, d):
    return ledger.latest_runs(load(spark, d, "fx_runs"))


@query
def run_totals(spark, d):
    return ledger.run_totals(load(spark, d, "fx_metrics"))


@query
def current_watermarks(spark, d):
    floor = "1970-01-01T00:00:00"
    rows = [
        ledger.watermark_row(_source(spark, d), "orders", CURSOR, floor),
        ledger.watermark_row(load(spark, d, "fx_transactions"), "transactions", CURSOR, floor),
        ledger.watermark_row(load(spark, d, "fx_history"), "advance_status_history", "history_id", 0),
        ledger.watermark_row(load(spark, d, "fx_history"), "advance_changes", "changed_at", floor),
    ]
    stacked = rows[0]
    for r in rows[1:]:
        stacked = stacked.unionByName(r)
    return ledger.current_watermarks(stacked)


@query
def warehouse_counts(spark, d):
    resolved = _resolved(spark, d)
    return ledger.table_counts(
        {
            "customers_raw": _customers(spark, d),
            "advances_raw": _advances(spark, d),
            "transactions_raw": load(spark, d, "fx_transactions"),
            "cards_raw": _cards(spark, d),
            "advance_status_history_raw": load(spark, d, "fx_history"),
            "customer_alias": identity.aliases(resolved),
            "customer_master": identity.golden_records(resolved),
            "identity_conflicts": identity.conflicts(resolved),
            "cards_master": identity.remap_cards(_cards(spark, d), identity.aliases(resolved)),
        }
    ).unionByName(ledger.review_pair_count(identity.review_groups(resolved)))


@query
def dataset_metadata(spark, d):
    def declared(name: str) -> DataFrame:
        rows = load(spark, d, name)
        checks = F.array_join(F.array("check_a", "check_b"), ",")
        return rows.withColumn("dq_checks", checks).drop("check_a", "check_b")

    return ledger.upsert_metadata(declared("fx_metadata_stored"), declared("fx_metadata_declared"))


@query
def published_state(spark, d):
    """The reconciled order snapshot after two runs through the warehouse, read back by its version."""
    return publish_orders(spark, _new_root(spark), _target(spark, d), _source(spark, d), WATERMARK)
