"""Incremental copy of one table into a draft warehouse state."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.digest import payload_bytes
from tidemark.operators.extract import bound_literal, cursor_text, extract, in_window, latest_per_key
from tidemark.operators.ledger import SYNC_METRICS
from tidemark.operators.parity import leaving_keys
from tidemark.sources.warehouse import BUCKET, State, Warehouse, bucket_of
from tidemark.spec import LOADED_AT, RUN_ID, TableSpec

_VERSIONS = "_versions"
_BYTES = "_bytes"
_STALE = "_stale"


@dataclass(frozen=True)
class Synced:
    """What one table's sync did: its watermark, and its metrics by the names of ``ledger.SYNC_METRICS``.

    Inserts and updates are not told apart: both count as upserted.
    """

    watermark: str
    metrics: Mapping[str, int]

    @property
    def extracted(self) -> int:
        return self.metrics["rows_extracted"]

    @property
    def deleted(self) -> int:
        return self.metrics["rows_deleted"]


@dataclass(frozen=True)
class Stamp:
    """The run a row was written by; one instant per run."""

    run_id: str
    at: str  # ISO-8601 with zone

    def time(self) -> Column:
        return F.lit(self.at).cast("timestamp")


def stored_watermarks(wh: Warehouse, state: State) -> dict[str, str]:
    """Watermark text per source table; a few control rows."""
    rows = wh.read(state, "watermarks").select("source_table", "cursor_value").collect()
    return {r.source_table: r.cursor_value for r in rows}


@dataclass(frozen=True)
class _Delta:
    """New row versions of a table, written once and split by bucket."""

    folder: str
    rows: DataFrame
    buckets: set[int]
    versions: int
    size: int


def _write_delta(wh: Warehouse, spec: TableSpec, rows: DataFrame, order: list[str], stamp: Stamp) -> _Delta:
    """Reduce ``rows`` to the last version per key, stamp and store them.

    ``versions`` and ``size`` count all rows given, superseded versions included;
    they are observed while the rows are written.
    """
    sized = rows.withColumn(_BYTES, payload_bytes(spec.schema))
    if spec.unique_at_source:
        last = sized.withColumn(_VERSIONS, F.lit(1).cast("bigint"))
    else:
        totals = {_VERSIONS: F.count(F.lit(1)), "_total": F.sum(_BYTES)}
        last = latest_per_key(sized, list(spec.key), order, **totals).drop(_BYTES).withColumnRenamed("_total", _BYTES)
    delta = (
        last.withColumn(LOADED_AT, stamp.time())
        .withColumn(RUN_ID, F.lit(stamp.run_id))
        .withColumn(BUCKET, bucket_of(spec))
    )
    folder, buckets, seen = wh.write_buckets(spec.target, delta, stamp.run_id, versions=F.sum(_VERSIONS), size=F.sum(_BYTES))
    stored = wh.open(folder, T.StructType([*spec.target_schema.fields, T.StructField(BUCKET, T.IntegerType())]))
    return _Delta(folder, stored, buckets, seen["versions"], seen["size"])


def _removed_keys(wh: Warehouse, state: State, spec: TableSpec, source: DataFrame, delta: _Delta | None, lower, upper) -> DataFrame:
    """Stored keys that must leave their bucket: deleted at the source, or replaced by the delta.

    An append-only table looks only at its own delta, and when its key is the
    sequence only above the watermark. All others compare checksums of key ranges
    with the source, and keys where these differ.
    """
    key = list(spec.key)
    stored = wh.read(state, spec.target).select(*key)
    if not spec.reconcile:
        if spec.cursor_is_key:
            stored = stored.where(F.col(spec.cursor) > F.lit(lower).cast(spec.cursor_type))
        removed = stored.join(delta.rows.select(*key), key, "left_semi").withColumn(_STALE, F.lit(False))
    else:
        new = delta.rows.select(*key) if delta else stored.where(F.lit(False))
        window = F.coalesce(in_window(spec.cursor, lower, upper, spec.cursor_type), F.lit(False))
        removed = leaving_keys(stored, source.where(~window).select(*key), new, key).withColumnRenamed("stale", _STALE)
    return removed.withColumn(BUCKET, bucket_of(spec))


def _merge(
    wh: Warehouse, state: State, spec: TableSpec, delta: _Delta | None, leaving: DataFrame | None, stamp: Stamp
) -> tuple[State, int]:
    """Put a delta into a draft; returns it with the number of stale keys among those leaving.

    Buckets that lose keys are written anew, without them and with their new
    rows; buckets that only gain rows name the delta's folder as well. No other
    bucket is read or written.
    """
    draft, lost, stale, gone = state, set(), 0, None
    if leaving is not None:
        gone, lost, seen = wh.write_buckets(spec.target, leaving, stamp.run_id, stale=F.count_if(_STALE))
        stale = seen["stale"]
    if delta:
        draft = draft.with_parts(spec.target, wh.bucket_parts(spec.target, delta.folder, delta.buckets - lost))
    anew = lost | draft.crowded(spec.target)
    if anew:
        key = [*spec.key, BUCKET]
        rows = wh.read(draft, spec.target, anew).withColumn(BUCKET, bucket_of(spec))
        if lost:
            schema = T.StructType([*[spec.schema[k] for k in spec.key], T.StructField(BUCKET, T.IntegerType())])
            removed = wh.open(gone, schema).alias("g")
            same = [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in key]
            rows = rows.alias("r").join(removed, same, "left_anti")
            if delta and lost & delta.buckets:
                rows = rows.unionByName(delta.rows.where(F.col(BUCKET).isin(*sorted(lost & delta.buckets))))
        folder, buckets, _ = wh.write_buckets(spec.target, rows, stamp.run_id)
        draft = draft.with_parts(spec.target, wh.bucket_parts(spec.target, folder, buckets), anew)
    for folder in (gone, delta.folder if delta and delta.buckets <= anew else None):  # nothing names these
        if folder:
            wh.drop(folder)
    return draft, stale


def sync_table(
    wh: Warehouse, state: State, spec: TableSpec, source: DataFrame, stamp: Stamp, lower: str | None = None
) -> tuple[State, Synced]:
    """Extract, upsert and reconcile one table; returns the draft that names the new folders.

    ``lower`` is the stored watermark, None for a first load. An unchanged
    table writes nothing and keeps its folders.
    """
    source = spec.check(source)
    floor = spec.floor if lower is None else lower
    seen = source.agg(F.max(spec.cursor).alias("_max"), F.count(F.lit(1)).alias("n")).select(
        cursor_text(F.coalesce("_max", bound_literal(spec.floor, spec.cursor_type)), spec.cursor_type).alias("upper"), "n"
    )
    upper, rows = seen.first()

    delta = None
    if upper != lower:
        extracted = extract(source, spec.columns, spec.cursor, floor, upper)
        delta = _write_delta(wh, spec, extracted, [spec.cursor], stamp)
    leaving = None
    if state.parts(spec.target) and (spec.reconcile or (delta and delta.buckets)):
        leaving = _removed_keys(wh, state, spec, source, delta, floor, upper)
    draft, stale = _merge(wh, state, spec, delta, leaving, stamp)

    versions, size = (delta.versions, delta.size) if delta else (0, 0)
    counted = (versions, versions, stale, size, rows if spec.reconcile else 0)
    return draft, Synced(upper, dict(zip(SYNC_METRICS, counted)))


def change_tables(
    wh: Warehouse,
    state: State,
    feeds: Mapping[str, DataFrame],
    specs: tuple[TableSpec, ...],
    stamp: Stamp,
    order: tuple[str, ...],
    op: str = "op",
) -> State:
    """A draft with change feeds applied to several stored tables.

    A feed holds the table's columns and ``op``: insert (I), update (U) or
    delete (D). The last change of a key in ``order`` decides; its remaining
    columns settle ties.
    """
    draft = state
    for spec in specs:
        if spec.source not in feeds:
            continue
        key = list(spec.key)
        changes = latest_per_key(feeds[spec.source], key, list(order))
        written = changes.where(F.col(op).isin("I", "U")).select(*spec.columns)
        delta = _write_delta(wh, spec, written, [spec.cursor], stamp)
        leaving = (
            wh.read(draft, spec.target)
            .select(*key)
            .join(changes.select(*key, (F.col(op) == "D").alias(_STALE)), key)
            .withColumn(BUCKET, bucket_of(spec))
        )
        draft, _ = _merge(wh, draft, spec, delta, leaving, stamp)
    return draft
