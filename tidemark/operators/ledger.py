"""Run ledger, watermarks, metrics and governance metadata as small DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.digest import payload_bytes
from tidemark.operators.extract import cursor_text, latest_per_key, upper_bound
from tidemark.operators.merge import upsert
from tidemark.operators.parity import side_by_side

# Metric names and units of one table's sync.
SYNC_METRICS = {
    "rows_extracted": "rows",
    "rows_upserted": "rows",
    "rows_deleted": "rows",
    "payload_bytes_estimated": "bytes",
    "source_keys_scanned": "keys",
}
IDENTITY_TABLE = "identity_resolution"
IDENTITY_METRICS = ("master_customers", "aliases", "proven_merges", "identity_conflicts")


def sync_metrics(
    table: str, extracted: DataFrame, schema: T.StructType, stale: DataFrame | None, source: DataFrame | None
) -> DataFrame:
    """The five metrics of one table's sync as rows; no stale keys and no key scan for append-only tables."""

    def one(df: DataFrame | None, **aggs: Column) -> DataFrame | None:
        return None if df is None else df.agg(*[c.cast("bigint").alias(n) for n, c in aggs.items()])

    rows = F.count(F.lit(1))
    parts = [
        one(
            extracted,
            rows_extracted=rows,
            rows_upserted=rows,
            payload_bytes_estimated=F.coalesce(F.sum(payload_bytes(schema)), F.lit(0)),
        ),
        one(stale, rows_deleted=rows),
        one(source, source_keys_scanned=rows),
    ]
    totals = side_by_side(*[p for p in parts if p is not None])
    for name in SYNC_METRICS:
        if name not in totals.columns:
            totals = totals.withColumn(name, F.lit(0).cast("bigint"))
    return metric_rows(totals, table, SYNC_METRICS)


def metric_rows(totals: DataFrame, table: str, units: dict[str, str]) -> DataFrame:
    """One row of totals as ``table_name, metric_name, metric_value, unit`` rows."""
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(n).alias("metric_name"),
                        F.col(n).alias("metric_value"),
                        F.lit(u).alias("unit"),
                    )
                    for n, u in units.items()
                ]
            )
        )
    )


def watermark_row(source: DataFrame, table: str, cursor: str, floor) -> DataFrame:
    """The watermark a sync of ``source`` leaves behind: its current upper bound as text."""
    kind = source.schema[cursor].dataType
    return upper_bound(source, cursor, floor).select(
        F.lit(table).alias("source_table"),
        F.lit(cursor).alias("cursor_column"),
        cursor_text(F.col("bound"), kind).alias("cursor_value"),
    )


def current_watermarks(watermarks: DataFrame) -> DataFrame:
    return watermarks.select("source_table", "cursor_column", "cursor_value").orderBy("source_table")


def run_states(events: DataFrame) -> DataFrame:
    """One row per run from its start and end events: the finished event wins."""
    return latest_per_key(events, ["run_id"], ["finished_at"])


def latest_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` runs; ties on the start time are broken by run id."""
    return (
        runs.orderBy(F.desc("started_at"), "run_id").limit(n).select("run_id", "status", "started_at", "error_message")
    )


def run_totals(metrics: DataFrame, metric: str = "rows_extracted") -> DataFrame:
    """One metric summed over the tables of each run."""
    return metrics.where(F.col("metric_name") == metric).groupBy("run_id").agg(F.sum("metric_value").alias("total"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, zero for an empty one."""
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def review_pair_count(groups: DataFrame) -> DataFrame:
    """The count row of the review pairs, from the exact pair counts of their groups."""
    total = F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint")
    return groups.agg(F.lit("identity_review_candidates").alias("table_name"), total.alias("row_count"))


def declared_metadata(version: int, datasets: Mapping[str, Mapping[str, Any]]) -> list[dict[str, Any]]:
    """Governance rows from a declaration document: one entry per dataset, under its short field names."""
    renamed = {"source": "source_system", "strategy": "load_strategy"}
    return [
        {"dataset": name, "metadata_version": version, **{renamed.get(k, k): v for k, v in declared.items()}}
        for name, declared in datasets.items()
    ]


def upsert_metadata(stored: DataFrame, declared: DataFrame) -> DataFrame:
    """Governance rows after loading the declared version; datasets no longer declared are kept."""
    return upsert(stored, declared, ["dataset"])
