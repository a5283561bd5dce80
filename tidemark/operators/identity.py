"""Conservative customer resolution: one proof key, protected survivors, quarantine, review.

Only a normalized government id proves two records to be one person. Shared
contact data suggests it, and goes to human review instead.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    completeness_score,
    evidence_email,
    normalize_government_id,
    present,
    valid_email,
    valid_phone,
)
from tidemark.operators.parity import side_by_side
from tidemark.operators.skew import DEFAULT_POLICY, SkewPolicy, skewed_lookup
from tidemark.spec import PROTECTING_STATUSES

# Rule labels and messages of the resolution.
RULE_CONFLICT = "protected_conflict"
RULE_PROTECTED = "government_id+protected_advance"
RULE_SURVIVOR = "government_id+deterministic_survivor"
RULE_UNPROVEN = "no_proven_identity"
CONFLICT_REASON = "multiple protected customers share proven identity"
EVIDENCE = "email+birth_date"
REVIEW_REASON = "suggestive evidence is not proof"

# The fields a survivor may inherit from its group when its own are absent (True: an empty text is absent).
FILLED = {"government_id": True, "birth_date": False, "email": True, "phone": True}


def protected_customers(advances: DataFrame, statuses: tuple[str, ...] = PROTECTING_STATUSES) -> DataFrame:
    """Distinct customers with an advance that was paid out."""
    return advances.where(F.col("status").isin(*statuses)).select("customer_id").distinct()


def members(customers: DataFrame, advances: DataFrame) -> DataFrame:
    """Non-test customers with proof key and evidence email (NULL when absent or invalid) and protection flag."""
    shielded = protected_customers(advances).withColumn("_hit", F.lit(True))
    return (
        customers.where(~F.col("is_test"))
        .withColumn("proof_key", normalize_government_id("government_id"))
        .withColumn("evidence_email", evidence_email("email"))
        .join(shielded, "customer_id", "left")
        .withColumn("is_protected", F.col("_hit").isNotNull())
        .drop("_hit")
    )


# A place in the order of survivors as one number: class, instant and id, each below the next one's unit.
_INSTANTS = 320_000_000_000_000_000  # more than the microseconds from the year 1 to 9999
_YEAR_ONE = 63_000_000_000_000_000  # what makes them positive
_IDS = "18446744073709551617"  # all longs, and none


def _survivor_order() -> Column:
    """A lone protected member comes first; otherwise completeness, age, id decide. Nulls come first.

    The number has a fixed width, so that its minimum is hash-aggregated.
    """
    kind = F.when(F.col("is_protected"), F.lit(0)).otherwise(F.lit(7)) + F.lit(6) - completeness_score()
    instant = F.coalesce(F.unix_micros(F.col("created_at").cast("timestamp")) + F.lit(_YEAR_ONE), F.lit(0))
    place = F.coalesce(F.col("customer_id").cast("decimal(20,0)") + F.lit("9223372036854775809").cast("decimal(19,0)"), F.lit(0).cast("decimal(20,0)"))
    high = (kind.cast("bigint") * F.lit(_INSTANTS) + instant).cast("decimal(19,0)")
    return (high * F.lit(_IDS).cast("decimal(20,0)")).cast("decimal(38,0)") + place.cast("decimal(38,0)")


def _survivor_id(order: Column) -> Column:
    """The customer at a place of :func:`_survivor_order`."""
    place = order % F.lit(_IDS).cast("decimal(38,0)")
    return F.when(place > 0, (place - F.lit("9223372036854775809").cast("decimal(38,0)")).cast("bigint"))


def group_decisions(people: DataFrame) -> DataFrame:
    """Per proof key: size, protected members, and the survivor a merge would keep.

    Only grouped minimums and counts, all partially aggregated: a key shared by
    a third of all customers is one row per task when it reaches the shuffle.
    """
    return (
        people.where(F.col("proof_key").isNotNull())
        .groupBy("proof_key")
        .agg(
            F.count(F.lit(1)).alias("n_members"),
            F.count_if(F.col("is_protected")).alias("n_protected"),
            F.min(_survivor_order()).alias("_first"),
        )
        .select("proof_key", "n_members", "n_protected", _survivor_id(F.col("_first")).alias("survivor_id"))
    )


def survivors(people: DataFrame) -> DataFrame:
    """One row per group that merges: ``proof_key, master_customer_id, resolution_rule``."""
    return (
        group_decisions(people)
        .where(F.col("n_protected") <= 1)
        .select(
            "proof_key",
            F.col("survivor_id").alias("master_customer_id"),
            F.when(F.col("n_protected") == 1, F.lit(RULE_PROTECTED)).otherwise(F.lit(RULE_SURVIVOR)).alias("resolution_rule"),
        )
    )


def resolve(customers: DataFrame, advances: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Every non-test customer with its master and the rule that chose it."""
    return resolve_members(members(customers, advances), policy)


def resolve_members(people: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """:func:`resolve` from prepared members, whose columns come along.

    ``people`` is read for the decisions and again for the rows; pass a stored
    result when its joins are expensive. Members without a proof key, however
    many, never enter the join.
    """
    proven = skewed_lookup(
        people.where(F.col("proof_key").isNotNull()),
        group_decisions(people),
        ["proof_key"],
        ["customer_id"],
        policy,
        "n_members",
    )
    merges = F.col("n_protected") <= 1
    rule = (
        F.when(F.col("n_protected") == 1, F.lit(RULE_PROTECTED))
        .when(merges, F.lit(RULE_SURVIVOR))
        .otherwise(F.lit(RULE_CONFLICT))
    )
    one = F.lit(1).cast("bigint")
    proven = proven.select(
        *people.columns,
        F.when(merges, F.col("survivor_id")).otherwise(F.col("customer_id")).alias("master_customer_id"),
        rule.alias("resolution_rule"),
        F.when(merges, F.col("n_members")).otherwise(one).alias("merged_members"),
    )
    unproven = people.where(F.col("proof_key").isNull()).select(
        *people.columns,
        F.col("customer_id").alias("master_customer_id"),
        F.lit(RULE_UNPROVEN).alias("resolution_rule"),
        one.alias("merged_members"),
    )
    return proven.unionByName(unproven)


def aliases(resolved: DataFrame) -> DataFrame:
    """The reversible source-to-master map."""
    return resolved.select(F.col("customer_id").alias("source_customer_id"), "master_customer_id", "resolution_rule")


# The survivor's own place in the order of donors: before all of them.
_OWN = "-" + "9" * 38


def _donor_order() -> Column:
    """``(updated_at, customer_id)`` as one number of fixed width, so that its minimum is hash-aggregated."""
    instant = F.unix_micros(F.col("updated_at").cast("timestamp")).cast("decimal(18,0)")
    place = F.col("customer_id").cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(19,0)")
    return (instant * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)") + place


def golden_records(resolved: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row per master: the survivor's values, absent contact fields filled from its group.

    Fills come from the member with the smallest ``(updated_at, customer_id)``
    that has the field; names are never filled. Of a merge's members a hash
    aggregate keeps one number per field, and only the rows these numbers name
    (the survivor and at most one donor per field) are put together. All other
    customers, nearly all, are their own record as they stand and are neither
    grouped nor shuffled.
    """
    has = {f: present(f, text) for f, text in FILLED.items()}
    is_merged = F.col("merged_members") > 1
    is_master = F.col("customer_id") == F.col("master_customer_id")
    own = ["first_name", "last_name", "is_protected", "merged_members"]
    alone = resolved.where(~is_merged).select("master_customer_id", *own, *[F.when(ok, F.col(f)).alias(f) for f, ok in has.items()])

    ranked = resolved.where(is_merged).withColumn("_order", F.when(is_master, F.lit(_OWN).cast("decimal(38,0)")).otherwise(_donor_order()))
    first = ranked.groupBy("master_customer_id").agg(
        F.max("merged_members").alias("_size"), *[F.min(F.when(ok, F.col("_order"))).alias(f"_{f}") for f, ok in has.items()]
    )
    chosen = reduce(or_, [F.col("_order") == F.col(f"_{f}") for f in has], is_master)
    # At most one row per field and the survivor's own are left of a group.
    named = skewed_lookup(ranked, first, ["master_customer_id"], ["customer_id"], policy, "_size").where(F.coalesce(chosen, F.lit(False)))
    filled = named.groupBy("master_customer_id").agg(
        *[F.max(F.when(is_master, F.col(c))).alias(c) for c in own],
        *[F.max(F.when(F.col("_order") == F.col(f"_{f}"), F.col(f))).alias(f) for f in has],
    )
    return alone.unionByName(filled).select(
        "master_customer_id",
        "government_id",
        "first_name",
        "last_name",
        "birth_date",
        "email",
        "phone",
        valid_email("email").alias("email_valid"),
        valid_phone("phone").alias("phone_valid"),
        F.col("is_protected").alias("protected_by_advance"),
        F.col("merged_members").cast("int").alias("source_record_count"),
    )


def conflicts(resolved: DataFrame) -> DataFrame:
    """The protected members of every quarantined group."""
    return resolved.where((F.col("resolution_rule") == RULE_CONFLICT) & F.col("is_protected")).select(
        F.col("proof_key").alias("conflict_key"), "customer_id", F.lit(CONFLICT_REASON).alias("reason")
    )


def remap_cards(cards: DataFrame, alias: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Cards under their surviving customer; cards of test or unknown customers drop out."""
    known = alias.select(F.col("source_customer_id").alias("customer_id"), "master_customer_id")
    return skewed_lookup(cards, known, ["customer_id"], ["card_id"], policy=policy).select(
        "card_id", "master_customer_id", F.col("customer_id").alias("source_customer_id"), "token", "last_four", "status"
    )


# --- review: suggestive matches -------------------------------------------------------------


def _evidence(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("evidence_email").isNotNull() & F.col("birth_date").isNotNull()).select(
        "customer_id", "master_customer_id", F.col("evidence_email").alias("email"), "birth_date"
    )


def review_groups(resolved: DataFrame) -> DataFrame:
    """Evidence groups that span several masters, with their exact number of pairs.

    ``pairs`` counts customer pairs of different masters: ``(n^2 - sum n_m^2) / 2``
    from per-master counts, so no pair is ever formed to count it.
    """
    wide = "decimal(38,0)"
    per_master = (
        _evidence(resolved)
        .groupBy("email", "birth_date", "master_customer_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    n = F.col("members").cast("decimal(19,0)")
    return (
        per_master.groupBy("email", "birth_date")
        .agg(
            F.sum("_n").alias("members"),
            F.count(F.lit(1)).alias("masters"),
            F.sum(F.col("_n").cast("decimal(19,0)") * F.col("_n").cast("decimal(19,0)")).alias("_squares"),
        )
        .where(F.col("masters") > 1)
        .select(
            "email",
            "birth_date",
            "members",
            "masters",
            ((n * n - F.col("_squares")) / F.lit(2)).cast(wide).alias("pairs"),
        )
    )


def review_members(resolved: DataFrame, groups: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Each customer of a review group with its master: the whole relation, one row per customer.

    Two members form a candidate pair exactly when their masters differ. The
    pairs themselves, whose number grows with the square of a group, are never
    written out: :func:`review_groups` counts them and :func:`review_partners`
    lists those of the customers a reviewer asks about.
    """
    return skewed_lookup(_evidence(resolved), groups, ["email", "birth_date"], ["customer_id"], policy, "members").drop(
        "members", "masters", "pairs"
    )


def review_partners(resolved: DataFrame, asked: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """All candidate pairs of the asked customers (``customer_id``), whatever the size of their groups.

    One row per pair, also when both are asked for. The members of a large group
    are dealt over several tasks, each of which has all the asked ones of it.
    """
    evidence = _evidence(resolved)
    sought = evidence.join(asked.select("customer_id").distinct(), "customer_id").select(
        "email", "birth_date", F.col("customer_id").alias("_asked"), F.col("master_customer_id").alias("_asked_master")
    )
    pairs = skewed_lookup(evidence, sought, ["email", "birth_date"], ["customer_id"], policy).where(F.col("master_customer_id") != F.col("_asked_master"))
    return pairs.select(
        F.least("_asked", "customer_id").alias("customer_id_a"),
        F.greatest("_asked", "customer_id").alias("customer_id_b"),
        F.lit(EVIDENCE).alias("evidence"),
        F.lit(REVIEW_REASON).alias("reason_not_merged"),
    ).distinct()


def identity_metrics(alias: DataFrame, conflicting: DataFrame) -> DataFrame:
    """One row: masters, aliases, proven merges and quarantined members.

    Every master is its own alias, so masters are counted without a distinct.
    """
    itself = F.col("source_customer_id") == F.col("master_customer_id")
    counted = alias.agg(
        F.count_if(itself).alias("master_customers"),
        F.count(F.lit(1)).alias("aliases"),
        F.count_if(~itself).alias("proven_merges"),
    )
    quarantined = conflicting.agg(F.count(F.lit(1)).alias("identity_conflicts"))
    return side_by_side(counted, quarantined)
