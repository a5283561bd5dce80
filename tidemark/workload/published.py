"""The order tables carried through a real warehouse: load, change, publish, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.digest import table_digest
from tidemark.plans.sync import Stamp, sync_table
from tidemark.sources.warehouse import Warehouse
from tidemark.spec import LOADED_AT, RUN_ID, UPSERT, TableSpec


def publish_orders(spark: SparkSession, root: str, before: DataFrame, after: DataFrame, watermark: str) -> DataFrame:
    """Sync ``before``, publish, then sync ``after`` from the given watermark, publish and read."""
    wh, spec, state, _ = _two_syncs(spark, root, before, after, watermark)
    return wh.read(state, spec.target).drop(LOADED_AT, RUN_ID)


def replay_orders(spark: SparkSession, root: str, before: DataFrame, after: DataFrame, watermark: str) -> DataFrame:
    """One row about a third sync, of the same source as the second: what it moved, and whether the state stayed."""
    wh, spec, state, reached = _two_syncs(spark, root, before, after, watermark)
    again, third = sync_table(wh, state, spec, after, Stamp("run-3", "2025-01-03T00:00:00+00:00"), reached)
    wh.publish(again)
    both = [table_digest(wh.read(s, spec.target).drop(LOADED_AT, RUN_ID)) for s in (state, wh.state())]
    same = (F.count_distinct("checksum") == 1) & F.lit(state.folders(spec.target) == wh.state().folders(spec.target))
    moved = [F.lit(n).cast("bigint").alias(c) for c, n in (("extracted", third.extracted), ("stale", third.deleted))]
    return both[0].unionByName(both[1]).agg(*moved, same.alias("same_state"))


def _two_syncs(spark, root, before, after, watermark):
    spec = TableSpec(
        source="orders",
        target="orders_raw",
        key=("o_orderkey",),
        cursor="updated_at",
        schema=after.schema,
        reconcile=True,
        strategy=UPSERT,
        buckets=8,
    )
    wh = Warehouse(spark, root, {spec.target: spec.target_schema})
    state, _ = sync_table(wh, wh.state(), spec, before, Stamp("run-1", "2025-01-01T00:00:00+00:00"))
    state = wh.publish(state)
    later = Stamp("run-2", "2025-01-02T00:00:00+00:00")
    state, done = sync_table(wh, state, spec, after, later, f"{watermark}T00:00:00")
    wh.publish(state)
    return wh, spec, wh.state(), done.watermark
