"""Derived identity tables after a change, from the groups that the change touches alone.

A changed row can only move what it is proven or suggested to belong to: the
customers of its proof key and its evidence group, by the old values and by the new
ones, and the customers whose protection an advance gives or takes. Their ids are
closed over proof keys once; no further step is needed, as a group is all customers
of one key. Only these customers are resolved again. Every other row of the derived
tables stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import evidence_email, normalize_government_id
from tidemark.operators import identity
from tidemark.operators.parity import stale_keys, without_keys
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy

Keep = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Refreshed:
    """The new rows of one derived table, and the keys of the rows they replace."""

    key: tuple[str, ...]
    gone: DataFrame
    rows: DataFrame

    def onto(self, table: DataFrame) -> DataFrame:
        """The table after the change; other columns of its rows stay, those of new rows are up to the caller."""
        return without_keys(table, self.gone, list(self.key)).unionByName(self.rows, allowMissingColumns=True)


def changed_keys(before: DataFrame, after: DataFrame, key: list[str], run: str, run_id: str) -> DataFrame:
    """Keys of rows that a run wrote (``run_id`` in column ``run``) or that are gone."""
    return after.where(F.col(run) == run_id).select(*key).unionByName(stale_keys(before, after, key)).distinct()


def _among(rows: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    return rows.join(keys.select(*names).distinct(), names, "left_semi")


def _proofs(customers: DataFrame) -> DataFrame:
    proven = customers.where(~F.col("is_test")).select("customer_id", normalize_government_id("government_id").alias("proof_key"))
    return proven.where(F.col("proof_key").isNotNull())


def _evidence(customers: DataFrame) -> DataFrame:
    rows = customers.where(~F.col("is_test")).select("customer_id", evidence_email("email").alias("email"), "birth_date")
    return rows.where(F.col("email").isNotNull() & F.col("birth_date").isNotNull())


def affected_customers(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]) -> DataFrame:
    """Ids of all customers whose resolution a change can move, those no longer there included.

    ``before`` and ``after`` hold the raw tables, ``changed`` the changed keys of each.
    """
    ids = changed["customers_raw"].select("customer_id")
    for raw in (before, after):
        ids = ids.unionByName(_among(raw["advances_raw"], changed["advances_raw"], ["advance_id"]).select("customer_id"))
    ids = ids.distinct()
    keys = _among(_proofs(before["customers_raw"]), ids, ["customer_id"]).unionByName(_among(_proofs(after["customers_raw"]), ids, ["customer_id"]))
    return ids.unionByName(_among(_proofs(after["customers_raw"]), keys, ["proof_key"]).select("customer_id")).distinct()


def refresh(
    before: Mapping[str, DataFrame],
    after: Mapping[str, DataFrame],
    derived: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
    keep: Keep = lambda name, df: df,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> dict[str, Refreshed]:
    """What a change does to each derived table.

    ``keep`` may write a step that several others read and give it back. Null customer ids take no part.
    """
    touched = keep("touched", affected_customers(before, after, changed).where(F.col("customer_id").isNotNull()))
    people = identity.members(_among(after["customers_raw"], touched, ["customer_id"]), _among(after["advances_raw"], touched, ["customer_id"]))
    resolved = keep("resolution", identity.resolve_members(keep("members", people), policy))
    as_source = touched.select(F.col("customer_id").alias("source_customer_id"))
    out = {
        "customer_alias": Refreshed(("source_customer_id",), as_source, identity.aliases(resolved)),
        "customer_master": Refreshed(
            ("master_customer_id",), touched.select(F.col("customer_id").alias("master_customer_id")), identity.golden_records(resolved, policy)
        ),
        "identity_conflicts": Refreshed(("customer_id",), touched, identity.conflicts(resolved)),
    }
    alias = out["customer_alias"].onto(derived["customer_alias"].select(*out["customer_alias"].rows.columns))
    cards = after["cards_raw"]
    moved = (
        _among(cards, touched, ["customer_id"]).select("card_id").unionByName(changed["cards_raw"].select("card_id"))
        .unionByName(_among(derived["cards_master"], as_source, ["source_customer_id"]).select("card_id")).distinct()
    )
    moved = keep("cards", moved)
    again = _among(cards, moved, ["card_id"])
    out["cards_master"] = Refreshed(("card_id",), moved, identity.remap_cards(again, alias, policy))

    group = ["email", "birth_date"]
    named = [_among(_evidence(raw["customers_raw"]), touched, ["customer_id"]).select(*group) for raw in (before, after)]
    groups = keep("evidence", named[0].unionByName(named[1]).distinct())
    members = _among(_evidence(after["customers_raw"]), groups, group)
    masters = alias.select(F.col("source_customer_id").alias("customer_id"), "master_customer_id")
    suggested = members.withColumnRenamed("email", "evidence_email").join(masters, "customer_id")
    reviewed = identity.review_groups(suggested)
    out["identity_review_groups"] = Refreshed(tuple(group), groups, reviewed)
    out["identity_review_members"] = Refreshed(tuple(group), groups, identity.review_members(suggested, reviewed, policy))
    return out
