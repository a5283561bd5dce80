"""Data-quality checks, their verdicts, and the gate that reads them; ``suite`` puts all of a load together."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import valid_email, valid_phone
from tidemark.operators.identity import protected_customers
from tidemark.operators.parity import (
    difference_sample,
    key_audit,
    key_difference,
    sample_text,
    side_by_side,
)
from tidemark.spec import ADVANCE_STATUSES, TableSpec

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
VERDICT = ["check_name", "dataset", "dimension", "status", "expected", "actual", "details"]

# Names, expectations and notes of the verdicts, here and where they are made.
CONTACT_EXPECTED = "tracked, not silently fixed"
CONFLICT_NOTE = "conflicts are quarantined, never auto-merged"
CANDIDATE_NOTE = "suggestive evidence is deliberately not auto-merged"
CONTACT_NOTE = "raw value preserved; validity flag is exposed in master"


class QualityGateError(RuntimeError):
    """At least one blocking check failed; ``results`` holds every verdict."""

    def __init__(self, results: list[Row]):
        self.results = results
        failed = ", ".join(f"{r.dataset}.{r.check_name}" for r in results if r.status == FAIL)
        super().__init__(f"one or more blocking data-quality checks failed: {failed}")


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def verdict(name, dataset, dimension, bad: Column, worst: str, expected, actual, details="") -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(dataset).alias("dataset"),
        F.lit(dimension).alias("dimension"),
        F.when(bad, F.lit(worst)).otherwise(F.lit(PASS)).alias("status"),
        _text(expected).alias("expected"),
        _text(actual).alias("actual"),
        _text(details).alias("details"),
    )


def verdicts(one_row: DataFrame, *checks: Column) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# --- keys -----------------------------------------------------------------------------------


def key_checks(spec: TableSpec, source: DataFrame, target: DataFrame) -> DataFrame:
    """Key parity against the source, primary-key uniqueness and null keys, from one key comparison."""
    key = list(spec.key)
    difference = key_difference(source.select(*key), target.select(*key), key)
    audit = side_by_side(key_audit(difference, key), sample_text(difference_sample(difference, key)))
    differs = (F.col("missing") > 0) | (F.col("stale") > 0)
    return verdicts(
        audit,
        verdict(
            "source_key_parity", spec.target, "completeness", differs, FAIL,
            F.format_string("%d source keys; 0 missing; 0 stale", "source_keys"),
            F.format_string("%d warehouse keys; %d missing; %d stale", "target_keys", "missing", "stale"),
            F.col("details"),
        ),
        verdict(
            "unique_primary_key", spec.target, "uniqueness", F.col("duplicates") != 0, FAIL,
            "0 duplicates", F.format_string("%d duplicates", "duplicates"),
        ),
        verdict(
            "null_key", spec.target, "completeness", F.col("null_keys") != 0, FAIL,
            "0 null keys", F.format_string("%d null keys", "null_keys"),
        ),
    )


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """One row ``duplicates``: rows beyond the first of each key, rows with a NULL key included."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(*key)).alias("duplicates"))


def null_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """One row ``null_keys``: rows without a complete key."""
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.agg(F.count_if(incomplete).alias("null_keys"))


# --- relationships and identity -------------------------------------------------------------


def coverage(customers: DataFrame, alias: DataFrame) -> DataFrame:
    """One row ``customers, aliases``: non-test customers and rows of the alias map."""
    return side_by_side(_count(customers.where(~F.col("is_test")), "customers"), _count(alias, "aliases"))


def leaked_test_customers(customers: DataFrame, alias: DataFrame) -> DataFrame:
    """One row ``leaked``: test customers that reached the alias map."""
    mapped = alias.select(F.col("source_customer_id").alias("customer_id"))
    return _count(customers.where(F.col("is_test")).select("customer_id").join(mapped, "customer_id"), "leaked")


def remapped_protected(advances: DataFrame, alias: DataFrame) -> DataFrame:
    """One row ``remapped``: protected customers that did not stay their own master."""
    moved = alias.where(F.col("master_customer_id") != F.col("source_customer_id"))
    moved = moved.select(F.col("source_customer_id").alias("customer_id"))
    return _count(protected_customers(advances).join(moved, "customer_id"), "remapped")


def candidate_pairs(groups: DataFrame) -> DataFrame:
    """One row ``pairs``: review pairs of all groups, from the groups' own exact counts."""
    return groups.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("decimal(38,0)").alias("pairs"))


def malformed_contacts(customers: DataFrame) -> DataFrame:
    """One row ``bad_emails, bad_phones`` over non-test customers; a missing value is malformed."""
    return customers.where(~F.col("is_test")).agg(
        F.count_if(~valid_email("email")).alias("bad_emails"), F.count_if(~valid_phone("phone")).alias("bad_phones")
    )


# --- sequences and the gate -----------------------------------------------------------------


def sequence_check(spec: TableSpec, target: DataFrame, parent: str = "advance_id", value: str = "changed_at") -> DataFrame:
    """Whether times run backwards along the sequence of an append-only table; observed, not blocking."""
    return verdicts(
        order_breaks(target, parent, spec.cursor, value),
        verdict(
            "monotonic_sequence", spec.target, "consistency", F.col("decreases") > 0, WARN,
            "0 decreases", F.format_string("%d decreases", "decreases"),
        ),
    )


def gate(results: DataFrame) -> list[Row]:
    """Collect the verdicts (one small row per check) and raise when any check failed."""
    rows = results.select(*VERDICT).collect()
    if any(r.status == FAIL for r in rows):
        raise QualityGateError(rows)
    return rows


def gate_decision(results: DataFrame) -> DataFrame:
    """One row: number of verdicts per status and whether the publish may proceed."""
    return results.agg(
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == WARN).alias("warned"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
        (F.count_if(F.col("status") == FAIL) == 0).alias("may_publish"),
    )


def status_summary(results: DataFrame) -> DataFrame:
    """Verdicts per status of the latest run in a result history."""
    per_run = results.groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"), F.max("checked_at").alias("at"))
    latest = per_run.agg(F.max(F.struct("at", "run_id")).alias("last")).select(F.col("last.run_id").alias("run_id"))
    return per_run.join(F.broadcast(latest), "run_id").select("status", "n")  # latest is one row


# --- source contract ------------------------------------------------------------------------


def order_breaks(rows: DataFrame, parent: str, sequence: str, value: str) -> DataFrame:
    """One row ``decreases``: rows whose value is below that of the row before them in the same parent.

    Rows are in order of sequence and then value, nulls first; a null compares
    with nothing. Rows of one number are one step, reduced in every map task.
    The steps are dealt out in ranges of parent and sequence that Spark balances
    by their rows, so neither a hot parent nor an outlier makes a large range.
    Ranges are worked through on their own and stitched by their first and last value.
    """
    steps = rows.groupBy(parent, sequence).agg(
        F.when(F.count(value) == F.count(F.lit(1)), F.min(value)).alias("_first"), F.max(value).alias("_last")
    )
    ranged = steps.repartitionByRange(parent, sequence).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy(parent, "_range").orderBy(sequence)
    edges = (
        ranged.withColumn("_before", F.lag("_last").over(inside))
        .groupBy(parent, "_range")
        .agg(
            F.count_if(F.col("_first") < F.col("_before")).alias("_inside"),
            F.min(F.struct(sequence, "_first"))["_first"].alias("_first"),
            F.max(F.struct(sequence, "_last"))["_last"].alias("_last"),
        )
    )
    across = Window.partitionBy(parent).orderBy("_range")  # one row per range
    stitched = edges.withColumn("_before", F.lag("_last").over(across))
    broken = F.col("_inside") + F.when(F.col("_first") < F.col("_before"), F.lit(1)).otherwise(F.lit(0))
    return stitched.agg(F.coalesce(F.sum(broken), F.lit(0)).cast("bigint").alias("decreases"))


def monotonic_sequence(incoming: DataFrame, lower: int, parent: str, sequence: str, value: str) -> DataFrame:
    """One row ``replayed, decreases``: ids not above the stored watermark, and times running backwards."""
    replayed = incoming.agg(F.count_if(F.col(sequence) <= F.lit(lower)).alias("replayed"))
    return side_by_side(replayed, order_breaks(incoming, parent, sequence, value))


# Rules the source declares for itself, as predicates that must hold.


def advance_rules() -> dict[str, Column]:
    return {
        "status_in_enum": F.col("status").isin(*ADVANCE_STATUSES),
        "amount_not_negative": F.col("amount_cents") >= 0,
        "customer_id_not_null": F.col("customer_id").isNotNull(),
    }


def card_rules() -> dict[str, Column]:
    return {
        "last_four_length": F.length("last_four") == 4,
        "token_not_null": F.col("token").isNotNull(),
        "customer_id_not_null": F.col("customer_id").isNotNull(),
    }


def source_rules(spec: TableSpec, columns: list[str]) -> tuple[dict[str, Column], tuple[str, ...]]:
    """What the source declares about a table, for the columns there are: rules a row must meet, and unique columns."""
    required = {
        f"{f.name}_not_null": F.col(f.name).isNotNull()
        for f in spec.schema.fields
        if not f.nullable and f.name not in spec.key and f.name in columns
    }
    own = {"advances": advance_rules, "cards": card_rules}.get(spec.source, dict)()
    return required | own, ("token",) if spec.source == "cards" else ()


def constraint_violations(df: DataFrame, dataset: str, rules: dict[str, Column], unique: tuple[str, ...] = ()) -> DataFrame:
    """One row per rule: ``dataset, rule, violations``; a rule that is not true counts, NULL included.

    All rules of a table are evaluated in one pass.
    """
    counts = {name: F.count_if(~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()}
    counts |= {f"{c}_unique": F.count(c) - F.count_distinct(c) for c in unique}
    one = df.agg(*[c.cast("bigint").alias(n) for n, c in counts.items()])
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(dataset).alias("dataset"), F.lit(n).alias("rule"), F.col(n).alias("violations"))
                    for n in counts
                ]
            )
        )
    )
