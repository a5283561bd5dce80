"""The library's input tables, derived from the benchmark's base tables.

Each fixture is a projection of one whole base table, written once as SQL
expressions that mean the same to Spark and to the checking engine. Amounts
are integer cents so that results compare exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# High-water mark the warehouse side of the incremental fixtures was loaded up to.
WATERMARK = "1999-01-01"

# Placeholder evidence shared by many customers of one nation: a large review group.
_SWITCHBOARD = "c_nationkey = 3"


@dataclass(frozen=True)
class Fixture:
    table: str
    columns: dict[str, str]
    where: str | None = None

    def load(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = base(spark, sf_dir, self.table)
        if self.where:
            df = df.where(self.where)
        return df.selectExpr(*[f"{expr} AS {name}" for name, expr in self.columns.items()])

    def sql(self) -> str:
        picked = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        return f"SELECT {picked} FROM {self.table}" + (f" WHERE {self.where}" if self.where else "")


_SCHEMAS: dict[str, T.StructType] = {}


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A base table; its footer is read for the schema once per process."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


FIXTURES = {
    # Proof ids in three spellings over groups of up to three; one machine-tool
    # placeholder id shared by a large group; NULL, empty and punctuation-only ids.
    "fx_customers": Fixture(
        "customer",
        {
            "customer_id": "c_custkey",
            "government_id": """CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 7500 THEN 'n/a'
                WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 10 = 8 THEN ' - ' WHEN c_custkey % 10 = 9 THEN ''
                WHEN c_custkey % 3 = 0 THEN 'AR-' || CAST(c_custkey AS STRING)
                WHEN c_custkey % 3 = 1 THEN ' ar ' || CAST(c_custkey - 1 AS STRING) || ' '
                ELSE 'Ar.' || CAST(c_custkey - 2 AS STRING) END""",
            "first_name": "c_mktsegment",
            "last_name": "c_name",
            "birth_date": f"""CASE WHEN {_SWITCHBOARD} THEN DATE '1900-01-01' WHEN c_custkey % 11 = 5 THEN NULL
                ELSE CAST(DATE '1960-01-01' + CAST((c_custkey - c_custkey % 4) % 9000 AS INT) AS DATE) END""",
            "email": f"""CASE WHEN {_SWITCHBOARD} THEN 'Switchboard@example.com' WHEN c_custkey % 13 = 3 THEN NULL
                WHEN c_custkey % 13 = 5 THEN 'not-an-email' WHEN c_custkey % 13 = 6 THEN ''
                WHEN c_custkey % 2 = 0 THEN 'user' || CAST(c_custkey - c_custkey % 4 AS STRING) || '@example.com'
                ELSE ' USER' || CAST(c_custkey - c_custkey % 4 AS STRING) || '@Example.COM ' END""",
            "phone": """CASE WHEN c_custkey % 7 = 1 THEN NULL WHEN c_custkey % 7 = 2 THEN '000'
                WHEN c_custkey % 7 = 3 THEN '00000000' WHEN c_custkey % 7 = 4 THEN '123'
                ELSE '+54 11 ' || CAST(55500000 + c_custkey AS STRING) END""",
            "is_test": "c_acctbal < -780",
            "created_at": "DATE '2025-01-01' + CAST(c_custkey % 30 AS INT)",
            "updated_at": "DATE '2025-02-01' + CAST(c_custkey % 17 AS INT)",
        },
    ),
    # Only the largest filled orders were paid out, so groups hold 0, 1, 2 and more protected members.
    "fx_advances": Fixture(
        "orders",
        {
            "advance_id": "o_orderkey",
            "customer_id": "o_custkey",
            "status": """CASE WHEN o_orderstatus = 'F' AND o_totalprice > 490000 THEN 'funded'
                WHEN o_orderstatus = 'F' AND o_totalprice > 478000 THEN 'paid_off'
                WHEN o_orderstatus = 'O' THEN 'requested' ELSE 'cancelled' END""",
            "amount_cents": "CAST(ROUND(o_totalprice * 100) AS BIGINT)",
            "created_at": "o_orderdate",
            "updated_at": "o_orderdate",
        },
    ),
    # Text keys; accounts with a very high balance refer to a customer that does not exist.
    "fx_cards": Fixture(
        "customer",
        {
            "card_id": "'card-' || CAST(c_custkey AS STRING)",
            "customer_id": "CASE WHEN c_acctbal > 9900 THEN -1 - c_custkey ELSE c_custkey END",
            "token": "'tok_' || CAST(c_custkey AS STRING)",
            "last_four": "SUBSTRING(CAST(10000 + c_custkey % 10000 AS STRING), 2, 4)",
            "status": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'inactive' ELSE 'active' END",
        },
    ),
    # Repeated ids; returned lines at the top discount refer to an unknown advance.
    "fx_transactions": Fixture(
        "lineitem",
        {
            "transaction_id": "l_orderkey * 10 + l_linenumber",
            "advance_id": "CASE WHEN l_returnflag = 'R' AND l_discount > 0.095 THEN -1 - l_orderkey ELSE l_orderkey END",
            "transaction_type": "CASE WHEN l_returnflag = 'R' THEN 'repayment' ELSE 'disbursement' END",
            "amount_cents": "CAST(ROUND(l_extendedprice * 100) AS BIGINT)",
            "occurred_at": "l_shipdate",
            "updated_at": "l_shipdate",
        },
    ),
    # The stored copy of the transactions: up to a date, and with the top discount under keys the source lacks.
    "fx_stored_transactions": Fixture(
        "lineitem",
        {
            "transaction_id": """CASE WHEN l_discount > 0.095 THEN -1 - (l_orderkey * 10 + l_linenumber)
                ELSE l_orderkey * 10 + l_linenumber END""",
            "advance_id": "CASE WHEN l_returnflag = 'R' AND l_discount > 0.095 THEN -1 - l_orderkey ELSE l_orderkey END",
            "transaction_type": "CASE WHEN l_returnflag = 'R' THEN 'repayment' ELSE 'disbursement' END",
            "amount_cents": "CAST(ROUND(l_extendedprice * 100) AS BIGINT)",
            "occurred_at": "l_shipdate",
            "updated_at": "l_shipdate",
        },
        where="l_shipdate <= DATE '1998-06-01'",
    ),
    "fx_history": Fixture(
        "events",
        {"history_id": "event_id", "advance_id": "user_id", "status": "event_type", "changed_at": "ts"},
    ),
    # The source now: urgent orders were changed ten years after they were placed.
    "fx_src_orders": Fixture(
        "orders",
        {
            "o_orderkey": "o_orderkey",
            "o_custkey": "o_custkey",
            "o_orderstatus": "o_orderstatus",
            "amount_cents": """CAST(ROUND(o_totalprice * 100) AS BIGINT)
                + CASE WHEN o_orderpriority = '1-URGENT' THEN 100 ELSE 0 END""",
            "updated_at": """CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL '3650' DAY
                ELSE o_orderdate END""",
        },
    ),
    # The warehouse as of the watermark: pending low-priority orders sit under keys the source
    # has since deleted, and the same orders are the late rows it never saw.
    "fx_tgt_orders": Fixture(
        "orders",
        {
            "o_orderkey": """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN -1 - o_orderkey
                ELSE o_orderkey END""",
            "o_custkey": "o_custkey",
            "o_orderstatus": "o_orderstatus",
            "amount_cents": "CAST(ROUND(o_totalprice * 100) AS BIGINT)",
            "updated_at": "o_orderdate",
        },
        where=f"o_orderdate <= DATE '{WATERMARK}'",
    ),
    # One change per order: filled ones updated, open ones deleted, pending ones inserted under a new key.
    "fx_changes": Fixture(
        "orders",
        {
            "op": "CASE WHEN o_orderstatus = 'F' THEN 'U' WHEN o_orderstatus = 'O' THEN 'D' ELSE 'I' END",
            "o_orderkey": "CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END",
            "o_custkey": "o_custkey",
            "o_orderstatus": "o_orderstatus",
            "amount_cents": "CAST(ROUND(o_totalprice * 100) AS BIGINT) + 1",
            "updated_at": "o_orderdate",
        },
    ),
    # Run history: one run per order.
    "fx_runs": Fixture(
        "orders",
        {
            "run_id": "'run-' || CAST(o_orderkey AS STRING)",
            "status": "CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE 'RUNNING' END",
            "started_at": "o_orderdate",
            "error_message": "CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE NULL END",
        },
    ),
    # Metrics: one value per run and line.
    "fx_metrics": Fixture(
        "lineitem",
        {
            "run_id": "'run-' || CAST(l_orderkey AS STRING)",
            "table_name": "'part_' || CAST(l_partkey AS STRING)",
            "metric_name": "CASE WHEN l_linestatus = 'O' THEN 'rows_extracted' ELSE 'rows_deleted' END",
            "metric_value": "CAST(l_quantity AS BIGINT)",
        },
    ),
    # Verdict history: one verdict per line, of the run of its order.
    "fx_dq_results": Fixture(
        "lineitem",
        {
            "run_id": "'run-' || CAST(l_orderkey AS STRING)",
            "status": "CASE WHEN l_returnflag = 'R' THEN 'FAIL' WHEN l_returnflag = 'A' THEN 'WARN' ELSE 'PASS' END",
            "checked_at": "l_shipdate",
        },
    ),
    # Governance declarations: a stored version per part and a newer one that covers the small sizes.
    "fx_metadata_stored": Fixture(
        "part",
        {
            "dataset": "'part_' || CAST(p_partkey AS STRING)",
            "owner": "p_brand",
            "classification": "p_type",
            "contains_pii": "p_retailprice > 1000",
            "retention_days": "p_size * 365",
            "check_a": "p_name",
            "check_b": "p_type",
            "metadata_version": "1",
        },
    ),
    "fx_metadata_declared": Fixture(
        "part",
        {
            "dataset": "CASE WHEN p_size > 40 THEN 'new_' ELSE 'part_' END || CAST(p_partkey AS STRING)",
            "owner": "p_brand",
            "classification": "'restricted'",
            "contains_pii": "p_retailprice > 1000",
            "retention_days": "p_size * 30",
            "check_a": "p_name",
            "check_b": "'source_key_parity'",
            "metadata_version": "2",
        },
    ),
}


def _stored(source: str, key: str, held: str, where: str) -> Fixture:
    """The stored copy of a table: some of its rows never came, others lie under keys the source lacks."""
    of = FIXTURES[source]
    return Fixture(of.table, of.columns | {key: held}, where)


FIXTURES |= {
    "fx_stored_customers": _stored(
        "fx_customers", "customer_id", "CASE WHEN c_acctbal > 9800 THEN -1 - c_custkey ELSE c_custkey END", "c_custkey % 50 <> 49"
    ),
    "fx_stored_advances": _stored(
        "fx_advances", "advance_id", "CASE WHEN o_totalprice > 480000 THEN -1 - o_orderkey ELSE o_orderkey END", "o_orderkey % 100 <> 3"
    ),
    "fx_stored_cards": _stored(
        "fx_cards", "card_id",
        "CASE WHEN c_acctbal < -900 THEN 'old-' ELSE 'card-' END || CAST(c_custkey AS STRING)", "c_custkey % 40 <> 7",
    ),
    "fx_stored_history": _stored(
        "fx_history", "history_id", "CASE WHEN event_id % 500 = 77 THEN -1 - event_id ELSE event_id END", "event_id % 300 <> 5"
    ),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FIXTURES[name].load(spark, sf_dir)


def ctes(*names: str) -> list[str]:
    return [f"{n} AS ({FIXTURES[n].sql()})" for n in names]
