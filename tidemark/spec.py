"""Declared contracts: which tables are copied, how, and with which schema."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Lineage columns stamped on every copied row.
LOADED_AT = "_loaded_at"
RUN_ID = "_run_id"


class SchemaDrift(ValueError):
    """The source no longer matches its declared schema; nothing was read."""


@dataclass(frozen=True)
class TableSpec:
    """Contract of one source table and the warehouse table it is copied to.

    ``key`` may be composite. ``reconcile`` switches hard-delete detection on;
    an append-only table leaves it off and never pays for a key scan.
    ``buckets`` is the number of hash buckets of the stored copy, each put
    together on its own when it has gathered too many changes.
    ``unique_at_source`` says that the source itself enforces the key: an
    extract is then not reduced to one row per key, which saves a shuffle of
    the first load. A broken promise shows up in the uniqueness check.
    """

    source: str
    target: str
    key: tuple[str, ...]
    cursor: str
    schema: T.StructType
    reconcile: bool
    strategy: str
    buckets: int = 64
    unique_at_source: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def cursor_type(self) -> T.DataType:
        return self.schema[self.cursor].dataType

    @property
    def cursor_is_key(self) -> bool:
        return self.key == (self.cursor,)

    @property
    def floor(self):
        """Watermark of a table that was never loaded."""
        if isinstance(self.cursor_type, (T.LongType, T.IntegerType)):
            return 0
        if isinstance(self.cursor_type, T.TimestampNTZType):
            return datetime(1970, 1, 1)
        if isinstance(self.cursor_type, T.TimestampType):
            return datetime(1970, 1, 1, tzinfo=timezone.utc)
        raise SchemaDrift(f"{self.source}.{self.cursor}: unsupported cursor type {self.cursor_type.simpleString()}")

    @property
    def target_schema(self) -> T.StructType:
        return T.StructType(
            list(self.schema.fields)
            + [T.StructField(LOADED_AT, T.TimestampType(), False), T.StructField(RUN_ID, T.StringType(), False)]
        )

    def check(self, df: DataFrame) -> DataFrame:
        """Project to the declared columns, or raise before any job starts.

        Columns the contract does not name are ignored; a missing or retyped
        column is drift and is never widened or coerced.
        """
        actual = {f.name: f.dataType for f in df.schema.fields}
        problems = [
            f"{f.name}: declared {f.dataType.simpleString()}, found "
            f"{actual[f.name].simpleString() if f.name in actual else 'nothing'}"
            for f in self.schema.fields
            if actual.get(f.name) != f.dataType
        ]
        if problems:
            raise SchemaDrift(f"{self.source}: " + "; ".join(problems))
        return df.select(*self.columns)


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal": T.DecimalType(38, 0),
}


def _schema(columns: str, required: str) -> T.StructType:
    """A schema from ``name type`` pairs; usable before any session exists."""
    not_null = set(required.split())
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n not in not_null) for n, t in pairs])


# Strategy labels of the load contract.
UPSERT = "watermark-upsert-plus-key-reconciliation"
APPEND_OPTIMIZED = "append-optimized-watermark-plus-key-reconciliation"
APPEND_ONLY = "append-only-sequence"

CUSTOMERS = TableSpec(
    source="customers",
    target="customers_raw",
    key=("customer_id",),
    cursor="updated_at",
    schema=_schema(
        "customer_id bigint, government_id string, first_name string, last_name string, birth_date date,"
        " email string, phone string, is_test boolean, created_at timestamp, updated_at timestamp",
        "customer_id first_name last_name is_test created_at updated_at",
    ),
    reconcile=True,
    strategy=UPSERT,
    unique_at_source=True,
)
ADVANCES = TableSpec(
    source="advances",
    target="advances_raw",
    key=("advance_id",),
    cursor="updated_at",
    schema=_schema(
        "advance_id bigint, customer_id bigint, status string, amount_cents bigint,"
        " created_at timestamp, updated_at timestamp",
        "advance_id customer_id status amount_cents created_at updated_at",
    ),
    reconcile=True,
    strategy=UPSERT,
    unique_at_source=True,
)
CARDS = TableSpec(
    source="cards",
    target="cards_raw",
    key=("card_id",),
    cursor="updated_at",
    schema=_schema(
        "card_id string, customer_id bigint, token string, last_four string, status string,"
        " created_at timestamp, updated_at timestamp",
        "card_id customer_id token last_four status created_at updated_at",
    ),
    reconcile=True,
    strategy=UPSERT,
    unique_at_source=True,
)
TRANSACTIONS = TableSpec(
    source="transactions",
    target="transactions_raw",
    key=("transaction_id",),
    cursor="updated_at",
    schema=_schema(
        "transaction_id bigint, advance_id bigint, transaction_type string, amount_cents bigint,"
        " occurred_at timestamp, updated_at timestamp",
        "transaction_id advance_id transaction_type amount_cents occurred_at updated_at",
    ),
    reconcile=True,
    strategy=APPEND_OPTIMIZED,
    unique_at_source=True,
)
HISTORY = TableSpec(
    source="advance_status_history",
    target="advance_status_history_raw",
    key=("history_id",),
    cursor="history_id",
    schema=_schema(
        "history_id bigint, advance_id bigint, status string, changed_at timestamp",
        "history_id advance_id status changed_at",
    ),
    reconcile=False,
    strategy=APPEND_ONLY,
    unique_at_source=True,
)

# Load order.
TABLES = (CUSTOMERS, ADVANCES, CARDS, TRANSACTIONS, HISTORY)

# The advance statuses that protect a customer, and all legal ones.
PROTECTING_STATUSES = ("funded", "paid_off")
ADVANCE_STATUSES = ("requested", "funded", "paid_off", "cancelled")

# Names and column lists of the tables computed from the copies, and of the control plane.
DERIVED = {
    "customer_master": _schema(
        "master_customer_id bigint, government_id string, first_name string, last_name string, birth_date date,"
        " email string, phone string, email_valid boolean, phone_valid boolean, protected_by_advance boolean,"
        " source_record_count int, resolved_at timestamp, _run_id string",
        "master_customer_id first_name last_name email_valid phone_valid protected_by_advance"
        " source_record_count resolved_at _run_id",
    ),
    "customer_alias": _schema(
        "source_customer_id bigint, master_customer_id bigint, resolution_rule string,"
        " resolved_at timestamp, _run_id string",
        "source_customer_id master_customer_id resolution_rule resolved_at _run_id",
    ),
    "identity_review_groups": _schema(
        "email string, birth_date date, members bigint, masters bigint, pairs decimal,"
        " detected_at timestamp, _run_id string",
        "email birth_date members masters pairs detected_at _run_id",
    ),
    "identity_review_members": _schema(
        "email string, birth_date date, customer_id bigint, master_customer_id bigint,"
        " detected_at timestamp, _run_id string",
        "email birth_date customer_id master_customer_id detected_at _run_id",
    ),
    "identity_conflicts": _schema(
        "conflict_key string, customer_id bigint, reason string, detected_at timestamp, _run_id string",
        "conflict_key customer_id reason detected_at _run_id",
    ),
    "cards_master": _schema(
        "card_id string, master_customer_id bigint, source_customer_id bigint, token string, last_four string,"
        " status string, resolved_at timestamp, _run_id string",
        "card_id master_customer_id source_customer_id token last_four status resolved_at _run_id",
    ),
}
CONTROL = {
    "pipeline_runs": _schema(
        "run_id string, pipeline_name string, pipeline_version string, git_commit string, environment string,"
        " started_at timestamp, finished_at timestamp, status string, error_message string",
        "run_id pipeline_name pipeline_version environment started_at status",
    ),
    "pipeline_metrics": _schema(
        "run_id string, table_name string, metric_name string, metric_value double, unit string,"
        " recorded_at timestamp",
        "run_id table_name metric_name metric_value unit recorded_at",
    ),
    "dq_results": _schema(
        "result_id string, run_id string, check_name string, dataset string, dimension string, status string,"
        " expected string, actual string, details string, checked_at timestamp",
        "result_id run_id check_name dataset dimension status expected actual checked_at",
    ),
    "watermarks": _schema(
        "source_table string, cursor_column string, cursor_value string, updated_at timestamp, run_id string",
        "source_table cursor_column cursor_value updated_at run_id",
    ),
    "applied_change_sets": _schema(
        "change_set string, applied_at timestamp, run_id string", "change_set applied_at run_id"
    ),
    "dataset_metadata": _schema(
        "dataset string, owner string, source_system string, classification string, contains_pii boolean,"
        " masking_required boolean, criticality string, refresh string, retention_days int, load_strategy string,"
        " primary_key string, dq_checks string, metadata_version int, loaded_at timestamp",
        "dataset owner source_system classification contains_pii masking_required criticality refresh"
        " retention_days load_strategy primary_key dq_checks metadata_version loaded_at",
    ),
}


def warehouse_schema(table: str) -> T.StructType:
    """Declared schema of any warehouse table; a table never written reads as empty with it."""
    for spec in TABLES:
        if spec.target == table:
            return spec.target_schema
    return {**DERIVED, **CONTROL}[table]
