"""Where the operational tables are read from: any mapping of name to DataFrame will do.

A run should see one state of the source. Parquet folders give that by the file
list fixed at read time; a live database does not, so point the JDBC reader at
a standby or snapshot, or land the tables first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.spec import TABLES, TableSpec


def parquet_tables(spark: SparkSession, root: str, specs: tuple[TableSpec, ...] = TABLES) -> dict[str, DataFrame]:
    """Tables stored as ``<root>/<name>`` parquet folders, read with their declared schema."""
    return {s.source: spark.read.schema(s.schema).parquet(f"{root.rstrip('/')}/{s.source}") for s in specs}


@dataclass(frozen=True)
class ReadRange:
    """How a table is read in parallel: ``partitions`` queries over ranges of a column."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    spec: TableSpec, url: str, read: ReadRange | None, whole: bool = False, fetch: int = 10_000
) -> dict[str, str]:
    """The reader's options for one table.

    Without a range one task would read the whole table, so that must be asked
    for with ``whole``. Filters, the columns read, and aggregates over them
    become part of the SQL the database runs: the upper bound of a run is one
    ``MAX`` per range, an extract carries both of its cursor bounds, and a key
    scan names the key alone.
    """
    options = {
        "url": url,
        "dbtable": spec.source,
        "fetchsize": str(fetch),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "pushDownLimit": "true",
    }
    if read is not None:
        return options | {
            "partitionColumn": read.column,
            "lowerBound": read.lower,
            "upperBound": read.upper,
            "numPartitions": str(read.partitions),
        }
    if not whole:
        raise ValueError(f"{spec.source}: name a range to read it by, or ask for it as a whole")
    return options


def jdbc_upper_bound(spec: TableSpec) -> str:
    """The query that has the database find the largest cursor value itself, from its index, in one row."""
    return f"SELECT MAX({spec.cursor}) AS bound FROM {spec.source}"


def jdbc_keys(spec: TableSpec) -> str:
    """The query of a key scan: the key columns alone."""
    return f"SELECT {', '.join(spec.key)} FROM {spec.source}"


def jdbc_tables(
    spark: SparkSession,
    url: str,
    ranges: Mapping[str, ReadRange],
    specs: tuple[TableSpec, ...] = TABLES,
    whole: Iterable[str] = (),
    **options: str,
) -> dict[str, DataFrame]:
    """Tables of a database by name; those without a range must be listed in ``whole``."""
    asked = set(whole)
    return {
        s.source: spark.read.format("jdbc")
        .options(**jdbc_options(s, url, ranges.get(s.source), s.source in asked), **options)
        .load()
        for s in specs
    }
