"""Bounded incremental extraction by high-water mark."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import TableSpec


_VERSIONS = "_versions_of"


def bound_literal(value: Any, kind: T.DataType) -> Column:
    """A bound as a constant of the cursor's type; datetimes go by their ISO text, zone included."""
    if isinstance(value, datetime):
        value = value.isoformat()
    return F.lit(value).cast(kind)


def upper_bound(source: DataFrame, cursor: str, floor: Any) -> DataFrame:
    """One row ``bound``: the largest cursor value, or the floor of an empty source."""
    kind = source.schema[cursor].dataType
    return source.agg(F.coalesce(F.max(cursor), bound_literal(floor, kind)).alias("bound"))


def in_window(cursor: str, lower: Any, upper: Any, kind: T.DataType) -> Column:
    """``lower < cursor <= upper`` with both bounds cast to the cursor's own type.

    Literal bounds of the column's type reach the parquet or JDBC scan; a cast
    on the column side would not.
    """
    return (F.col(cursor) > bound_literal(lower, kind)) & (F.col(cursor) <= bound_literal(upper, kind))


def extract(source: DataFrame, columns: list[str], cursor: str, lower: Any, upper: Any) -> DataFrame:
    """Rows written after ``lower`` and up to the captured bound, declared columns only."""
    return source.where(in_window(cursor, lower, upper, source.schema[cursor].dataType)).select(*columns)


def extract_table(source: DataFrame, spec: TableSpec, lower: Any, upper: Any) -> DataFrame:
    return extract(spec.check(source), spec.columns, spec.cursor, lower, upper)


def latest_per_key(rows: DataFrame, key: list[str], order: list[str], **totals: Column) -> DataFrame:
    """The last row per key in ``order``: what remains after writing the rows one by one.

    Versions are counted per key by a hash aggregate that carries the key alone. Rows of keys
    with one version, nearly all, are taken as they stand; only the others meet
    in a ranking, cut to one row per key in every task before their shuffle, so a key with
    very many versions is one row per task. ``order`` must be total over the
    versions of a key; the remaining columns follow it as the final tiebreak.
    ``totals`` are further aggregates over all versions. ``rows`` is read for the count and for the rows.
    """
    payload = [c for c in rows.columns if c not in key]
    ranked = list(dict.fromkeys([c for c in order if c not in key] + payload))
    if not ranked:
        return rows.groupBy(*key).agg(*[c.alias(n) for n, c in totals.items()]) if totals else rows.distinct()
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias(_VERSIONS), *[c.alias(n) for n, c in totals.items()])
    # Keys under names of their own: a null key is a key, so the joins are null-safe.
    named = [F.col(k).alias(f"{_VERSIONS}_{k}") for k in key]
    several = counted.where(F.col(_VERSIONS) > 1).select(*named)
    same = [F.col(k).eqNullSafe(F.col(f"{_VERSIONS}_{k}")) for k in key]
    one = rows.join(several, same, "left_anti")
    last = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in ranked])
    more = rows.join(several, same, "left_semi").withColumn(_VERSIONS, F.row_number().over(last)).where(F.col(_VERSIONS) == 1)
    latest = one.unionByName(more.drop(_VERSIONS))
    if not totals:
        return latest
    return latest.join(counted.select(*named, *totals), same).select(*rows.columns, *totals)


def cursor_text(bound: Column, kind: T.DataType) -> Column:
    """Text form of a watermark: ISO-8601 for timestamps, decimal digits for sequences."""
    if isinstance(kind, T.TimestampType):
        bound = F.to_utc_timestamp(bound, F.current_timezone())
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(bound, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(bound, "SSSSSS")
        text = F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
        return F.concat(text, F.lit("+00:00")) if isinstance(kind, T.TimestampType) else text
    return bound.cast("string")


def cursor_value(text: Column, kind: T.DataType) -> Column:
    """Inverse of :func:`cursor_text`."""
    return text.cast(kind)
