"""The data-quality suite in one pass over every table.

All that is known of a key meets in one grouped count. Each table is read once and
gives, for each row, a fact about every key it holds: its own key, as source or as
stored row, the keys it refers to, values that have to be unique. Facts carry the
key space they belong to, so one union and one shuffle serve parity, duplicates,
null keys, orphans, coverage and remaps of all tables, reduced in every map task
before. Rules that a row breaks travel as one number of bits, a handful of groups.

The grouped keys are summed up per space, and those on which source and copy
differ go along as rows of their own. A rank limit, taken in every task first,
leaves the sums and the first few differing keys in text order, which the verdicts are made of:
no second comparison for the samples, and never more than a few rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import valid_email, valid_phone
from tidemark.operators.parity import SAMPLE_SIZE
from tidemark.operators.quality import (
    CANDIDATE_NOTE,
    CONFLICT_NOTE,
    CONTACT_EXPECTED,
    CONTACT_NOTE,
    FAIL,
    WARN,
    candidate_pairs,
    sequence_check,
    source_rules,
    verdict,
    verdicts,
)
from tidemark.spec import PROTECTING_STATUSES, TABLES, TableSpec

_SOURCE, _TEST, _PROTECTED, _MOVED = 1, 2, 4, 8
_MARKS = -1  # the space of broken rules: table number above, a bit for each rule below
_PARTS, _NOTHING = "\x1f", "\x00"  # between the values of a composite key, and for a null one
_WIDE = 32

#: Raw tables whose rows refer to another raw table's keys: column, the table, and which of its counts they add to.
_REFERENCES = {
    "cards_raw": ("customer_id", "customers_raw", "a"),
    "advances_raw": ("customer_id", "customers_raw", "b"),
    "transactions_raw": ("advance_id", "advances_raw", "a"),
}


def _key(df: DataFrame, columns: tuple[str, ...]) -> tuple[Column, Column]:
    """A key as a number or a text, the other one null."""
    if len(columns) > 1:
        return F.lit(None).cast("bigint"), F.concat_ws(_PARTS, *[F.coalesce(F.col(c).cast("string"), F.lit(_NOTHING)) for c in columns])
    if isinstance(df.schema[columns[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(columns[0]).cast("bigint"), F.lit(None).cast("string")
    return F.lit(None).cast("bigint"), F.col(columns[0]).cast("string")


@dataclass
class _Facts:
    """What the tables say, one frame for each table."""

    spaces: dict[str, int] = field(default_factory=dict)
    frames: list[DataFrame] = field(default_factory=list)

    def space(self, name: str) -> int:
        return self.spaces.setdefault(name, len(self.spaces))

    def fact(self, name: str, key: tuple[Column, Column], flags: Column | int = 0, **counts: int) -> Column:
        flags = F.lit(flags) if isinstance(flags, int) else flags
        return F.struct(
            F.lit(self.space(name)).alias("space"), key[0].alias("k"), key[1].alias("t"), flags.cast("bigint").alias("flags"),
            *[F.lit(counts.get(c, 0)).cast("bigint").alias(c) for c in ("rows", "a", "b", "c")],
        )

    def marked(self, table: int, rules: list[Column]) -> Column:
        """The rules that hold true of a row as one fact, if there are any."""
        bits = reduce(lambda x, y: x.bitwiseOR(y), [F.when(r, F.lit(1 << n)).otherwise(F.lit(0)).cast("bigint") for n, r in enumerate(rules)])
        fact = F.struct(
            F.lit(_MARKS).alias("space"), (bits + F.lit(table << _WIDE)).cast("bigint").alias("k"), F.lit(None).cast("string").alias("t"),
            F.lit(0).cast("bigint").alias("flags"), F.lit(1).cast("bigint").alias("rows"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "c")],
        )
        return F.when(bits != 0, fact)

    def add(self, df: DataFrame, *facts: Column) -> None:
        self.frames.append(df.select(F.inline(F.array(*facts))).where(F.col("space").isNotNull()))

    def grouped(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.frames).groupBy("space", "k", "t").agg(
            F.bit_or("flags").alias("flags"), *[F.sum(c).alias(c) for c in ("rows", "a", "b", "c")]
        )


def _measures() -> dict[str, Column]:
    """What one key adds to the sums of its space."""
    held, null = F.col("rows") > 0, F.col("k").isNull() & (F.col("t").isNull() | F.contains("t", F.lit(_NOTHING)))
    has = lambda flag: F.col("flags").bitwiseAND(flag) != 0
    one, lost = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("bigint"), ~held | null
    only = lambda c, x: F.when(c, F.col(x)).otherwise(F.lit(0))
    return {
        "source_keys": one(has(_SOURCE)), "target_keys": one(held), "missing": one(has(_SOURCE) & ~held), "stale": one(~has(_SOURCE) & held),
        "rows": F.col("rows"), "keys": one(held & ~null), "null_keys": only(null, "rows"), "value_rows": only(~null, "rows"),
        "lost_a": only(lost, "a"), "lost_b": only(lost, "b"),
        "linked": F.col("c"), "leaked": only(has(_TEST), "c"), "remapped": one(has(_PROTECTED) & has(_MOVED)),
    }


def _summed(grouped: DataFrame, compared: list[int], composite: list[int]) -> DataFrame:
    """Sums per space (and per number of broken rules), and the first differing keys of the compared spaces."""
    measures = _measures()
    missing = (F.col("flags").bitwiseAND(_SOURCE) != 0) & (F.col("rows") == 0)
    stale = (F.col("flags").bitwiseAND(_SOURCE) == 0) & (F.col("rows") > 0)
    listed = F.concat(F.lit("("), F.replace(F.replace("t", F.lit(_NOTHING), F.lit("None")), F.lit(_PARTS), F.lit(", ")), F.lit(")"))
    text = F.coalesce(F.col("k").cast("string"), F.when(F.col("space").isin(composite), listed).otherwise(F.col("t")), F.lit("None"))
    side = F.when(missing, F.lit("missing")).when(stale, F.lit("stale"))
    none = F.lit(None).cast("string")
    sums = F.struct(F.lit(True).alias("kept"), none.alias("side"), none.alias("key_text"), *[c.alias(n) for n, c in measures.items()])
    sample = F.struct(
        F.lit(True).alias("kept"), side.alias("side"), text.alias("key_text"), *[F.lit(0).cast("bigint").alias(n) for n in measures]
    )
    marks = F.when(F.col("space") == _MARKS, F.col("k")).alias("marks")
    rows = grouped.select("space", marks, F.inline(F.array(sums, F.when(F.col("space").isin(compared) & side.isNotNull(), sample)))).where("kept")
    met = rows.groupBy("space", "marks", "side", "key_text").agg(*[F.sum(n).alias(n) for n in measures])
    first = Window.partitionBy("space", "marks", "side").orderBy("key_text")  # a space's sums are one row without a side
    return met.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= SAMPLE_SIZE).drop("_rank")


@dataclass
class _Report:
    """The one row all verdicts are read from: what they ask for is added up under a name."""

    spaces: dict[str, int]
    columns: dict[str, Column] = field(default_factory=dict)

    def total(self, space: str, measure: str) -> Column:
        name = f"{space}.{measure}"
        self.columns[name] = F.coalesce(F.sum(F.when(F.col("space") == self.spaces[space], F.col(measure))), F.lit(0)).cast("bigint")
        return F.col(f"`{name}`")

    def marked(self, table: int, rule: int) -> Column:
        name, marks = f"marks.{table}.{rule}", F.col("marks")
        hit = (F.shiftright(marks, _WIDE) == table) & (marks.bitwiseAND(F.lit(1 << rule)) != 0)
        self.columns[name] = F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0)).cast("bigint")
        return F.col(f"`{name}`")

    def sample(self, space: str) -> Column:
        parts = []
        for side in ("missing", "stale"):
            own = F.when((F.col("space") == self.spaces[space]) & (F.col("side") == side), F.col("key_text"))
            self.columns[f"{space}.{side}_sample"] = F.array_sort(F.collect_list(own))
            quoted = F.transform(F.col(f"`{space}.{side}_sample`"), lambda v: F.concat(F.lit("'"), v, F.lit("'")))
            parts.append(F.concat(F.lit(f"{side}_sample=["), F.array_join(quoted, ", "), F.lit("]")))
        return F.concat(parts[0], F.lit("; "), parts[1])


def _key_verdicts(report: _Report, spec: TableSpec) -> list[Column]:
    of = lambda m: report.total(spec.target, m)
    duplicates = of("rows") - of("keys")
    return [
        verdict(
            "source_key_parity", spec.target, "completeness", (of("missing") > 0) | (of("stale") > 0), FAIL,
            F.format_string("%d source keys; 0 missing; 0 stale", of("source_keys")),
            F.format_string("%d warehouse keys; %d missing; %d stale", of("target_keys"), of("missing"), of("stale")), report.sample(spec.target),
        ),
        verdict(
            "unique_primary_key", spec.target, "uniqueness", duplicates != 0, FAIL, "0 duplicates", F.format_string("%d duplicates", duplicates)
        ),
        verdict(
            "null_key", spec.target, "completeness", of("null_keys") != 0, FAIL, "0 null keys", F.format_string("%d null keys", of("null_keys"))
        ),
    ]


def _constraint_verdict(target: str, broken: dict[str, Column]) -> Column:
    violations = reduce(lambda x, y: x + y, broken.values(), F.lit(0).cast("bigint"))
    listed = F.array_sort(F.array_compact(F.array(*[F.when(n > 0, F.format_string("%s=%d", F.lit(rule), n)) for rule, n in broken.items()])))
    return verdict(
        "source_constraints", target, "validity", violations > 0, FAIL, "0 violations",
        F.format_string("%d violations", violations), F.array_join(listed.cast("array<string>"), "; "),
    )


def _orphan_verdict(name: str, child: str, orphans: Column) -> Column:
    return verdict(name, child, "consistency", orphans != 0, FAIL, "0 orphans", F.format_string("%d orphans", orphans))


def _customer_verdicts(report: _Report, people: Column, emails: Column, phones: Column) -> list[Column]:
    of = lambda m: report.total("customers_raw", m)
    return [
        _orphan_verdict("cards_have_customer", "cards_raw", of("lost_a")),
        _orphan_verdict("advances_have_customer", "advances_raw", of("lost_b")),
        _orphan_verdict("transactions_have_advance", "transactions_raw", report.total("advances_raw", "lost_a")),
        _orphan_verdict("cards_have_master", "cards_master", report.total("customer_master", "lost_a")),
        verdict("alias_coverage", "customer_alias", "completeness", of("linked") != people, FAIL, people, of("linked")),
        verdict("test_data_excluded", "customer_master", "validity", of("leaked") != 0, FAIL, "0", of("leaked")),
        verdict(
            "protected_customer_survives", "customer_master", "business_rule", of("remapped") != 0, FAIL,
            "0 protected customers remapped", F.format_string("%d remapped", of("remapped")),
        ),
        verdict(
            "protected_identity_conflicts", "identity_conflicts", "business_rule", report.total("identity_conflicts", "keys") > 0, WARN,
            "0 preferred", report.total("identity_conflicts", "keys"), CONFLICT_NOTE,
        ),
        *[
            verdict(f"malformed_{kind}_count", "customers_raw", "validity", bad > 0, WARN, CONTACT_EXPECTED, bad, CONTACT_NOTE)
            for kind, bad in (("email", emails), ("phone", phones))
        ],
    ]


def quality_suite(
    sources: Mapping[str, DataFrame], wh: Mapping[str, DataFrame], specs: tuple[TableSpec, ...] = TABLES
) -> DataFrame:
    """All blocking and observing checks as one plan: one row per check, one action for the caller.

    The 21 checks of a load, and for every table its null keys and source
    constraints, for append-only tables the order of their sequence. Every table
    is read once, but for append-only ones, which are read again in order.
    """
    facts, composite, asked = _Facts(), [], {spec.target: spec for spec in specs}
    rules: dict[str, list[str]] = {}  # names of the bits of each table
    for number, spec in enumerate({s.target: s for s in (*TABLES, *specs)}.values()):
        df, target = wh[spec.target], spec.target
        if len(spec.key) > 1:
            composite.append(facts.space(target))
        if target in asked:
            facts.add(sources[spec.source], facts.fact(target, _key(sources[spec.source], spec.key), _SOURCE))
        flags: Column | int = 0
        required, unique = source_rules(spec, df.columns) if target in asked else ({}, ())
        bits = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in required.items()}
        if target == "customers_raw":
            person = ~F.col("is_test")
            flags = F.when(F.col("is_test"), F.lit(_TEST)).otherwise(F.lit(0))
            bits |= {"_person": person, "_email": person & ~valid_email("email"), "_phone": person & ~valid_phone("phone")}
        held = [facts.fact(target, _key(df, spec.key), flags, rows=1)]
        held += [facts.fact(f"{target}.{c}", _key(df, (c,)), rows=1) for c in unique]
        if target in _REFERENCES:
            column, parent, count = _REFERENCES[target]
            paid = F.when(F.col("status").isin(*PROTECTING_STATUSES), F.lit(_PROTECTED)).otherwise(F.lit(0)) if target == "advances_raw" else 0
            held.append(facts.fact(parent, _key(df, (column,)), paid, **{count: 1}))
        if bits:
            held.append(facts.marked(number, list(bits.values())))
        rules[target] = list(bits)
        facts.add(df, *held)
    alias, master, cards = wh["customer_alias"], wh["customer_master"], wh["cards_master"]
    moved = F.when(F.col("master_customer_id") != F.col("source_customer_id"), F.lit(_MOVED)).otherwise(F.lit(0))
    facts.add(alias, facts.fact("customers_raw", _key(alias, ("source_customer_id",)), moved, c=1))
    facts.add(master, facts.fact("customer_master", _key(master, ("master_customer_id",)), rows=1))
    facts.add(cards, facts.fact("customer_master", _key(cards, ("master_customer_id",)), a=1))
    conflicts = wh["identity_conflicts"]
    facts.add(conflicts, facts.fact("identity_conflicts", _key(conflicts, ("conflict_key",)), rows=1))

    report = _Report(facts.spaces)
    tables = {target: number for number, target in enumerate(rules)}
    checks: list[Column] = []
    for spec in specs:
        checks += _key_verdicts(report, spec)
        broken = {r: report.marked(tables[spec.target], n) for n, r in enumerate(rules[spec.target]) if not r.startswith("_")}
        for c in source_rules(spec, wh[spec.target].columns)[1]:
            space = f"{spec.target}.{c}"
            broken[f"{c}_unique"] = report.total(space, "value_rows") - report.total(space, "keys")
        checks.append(_constraint_verdict(spec.target, broken))
    customers = "customers_raw"
    counted = [report.marked(tables[customers], rules[customers].index(r)) for r in ("_person", "_email", "_phone")]
    checks += _customer_verdicts(report, *counted)
    compared = [facts.spaces[spec.target] for spec in specs]
    one = _summed(facts.grouped(), compared, composite).agg(*[c.alias(n) for n, c in report.columns.items()])
    parts = [verdicts(one, *checks)]
    parts += [sequence_check(spec, wh[spec.target]) for spec in specs if spec.cursor_is_key]
    parts.append(
        verdicts(
            candidate_pairs(wh["identity_review_groups"]),
            verdict(
                "suggestive_match_candidates", "identity_review_candidates", "observability", F.col("pairs") > 0, WARN,
                "review only", F.col("pairs"), CANDIDATE_NOTE,
            ),
        )
    )
    return reduce(DataFrame.unionByName, parts)
