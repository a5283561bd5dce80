"""Upsert, hard-delete reconciliation and change-set application on keyed tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.extract import extract, in_window, latest_per_key
from tidemark.operators.parity import stale_keys, without_keys


def upsert(target: DataFrame, delta: DataFrame, key: list[str]) -> DataFrame:
    """Target with every delta row written over the row of the same key.

    ``delta`` holds one row per key. Only its keys enter the join, so a small
    change set is broadcast by size and the target is not shuffled.
    """
    return target.join(delta.select(*key), key, "left_anti").unionByName(delta)


def drop_stale(rows: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the source still has."""
    return rows.join(source.select(*key), key, "left_semi")


def next_snapshot(
    target: DataFrame, source: DataFrame, columns: list[str], key: list[str], cursor: str, lower: Any, upper: Any
) -> DataFrame:
    """Upsert and hard-delete reconciliation.

    A target row stays when its key is still in the source and was not
    extracted again. The keys that leave follow the change, so the target meets
    them by their size, and no key is shuffled for ranges in which nothing was deleted.
    """
    window = F.coalesce(in_window(cursor, lower, upper, source.schema[cursor].dataType), F.lit(False))
    delta = latest_per_key(extract(source, columns, cursor, lower, upper), key, [cursor])
    rest = without_keys(target.select(*columns), source.where(window), key)
    return without_keys(rest, stale_keys(rest, source.where(~window), key), key).unionByName(delta)


def append_sequence(target: DataFrame, delta: DataFrame, key: str, lower: Any) -> DataFrame:
    """Upsert for a table whose cursor is its key.

    Every delta key lies above ``lower``, so only target rows above it can be
    replaced and the rest is carried over without a join.
    """
    above = F.col(key) > F.lit(lower)
    replaced = target.where(above).join(delta.select(key), [key], "left_anti")
    return target.where(~above).unionByName(replaced).unionByName(delta)


def apply_change_set(target: DataFrame, changes: DataFrame, key: list[str], order: list[str], op: str = "op") -> DataFrame:
    """Target after a feed of inserts (I), updates (U) and deletes (D).

    The last change of a key in ``order`` decides, its remaining columns settle
    ties, and its earlier ones are superseded: one change per key is left.
    Applying the same feed twice gives the same table.
    """
    changes = latest_per_key(changes, key, order)
    written = changes.where(F.col(op).isin("I", "U")).select(*target.columns)
    return target.join(changes.select(*key), key, "left_anti").unionByName(written)
