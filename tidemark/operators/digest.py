"""Order-free state digests and payload size estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_text(columns: list[str]) -> Column:
    """One text per row, unambiguous: each value carries its length, NULL is a bare dash."""

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*[part(c) for c in columns])


def table_digest(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """One row ``(row_count, checksum)`` that depends on the set of rows, not on their order.

    The checksum adds 60 bits of each row's SHA-256, so it needs no sort and
    partial sums travel instead of rows. Rows are a multiset: a repeated row counts twice.
    """
    columns = [c for c in df.columns if c not in exclude]
    bits = F.conv(F.substring(F.sha2(row_text(columns), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(38,0)").cast("string").alias("checksum"),
    )


def state_digest(tables: dict[str, DataFrame], exclude: tuple[str, ...] = ()) -> DataFrame:
    """One row ``digest``: SHA-256 over the named tables' digests."""
    parts = None
    for name, df in tables.items():
        part = table_digest(df, exclude).select(F.lit(name).alias("table_name"), "row_count", "checksum")
        parts = part if parts is None else parts.unionByName(part)
    return parts.agg(
        F.sha2(
            F.array_join(
                F.array_sort(F.collect_list(F.concat_ws(":", "table_name", F.col("row_count").cast("string"), "checksum"))),
                ",",
            ),
            256,
        ).alias("digest")
    )


def _text_bytes(field: T.StructField) -> Column:
    c = F.col(field.name)
    size = F.octet_length(c.cast("string"))
    if isinstance(field.dataType, T.TimestampType):
        size = size + 6  # the written form carries a +00:00 offset
    return F.coalesce(size, F.lit(4))  # a NULL is written as four characters


def payload_bytes(schema: T.StructType) -> Column:
    """UTF-8 size of one row's values in text form."""
    total = F.lit(0).cast("bigint")
    for field in schema.fields:
        total = total + _text_bytes(field)
    return total
