"""Join of many rows to one row per key that survives a key holding a large share of all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"
_SALTS = "_salts"


@dataclass(frozen=True)
class SkewPolicy:
    """A key with more rows than ``rows_per_task`` is dealt over as many tasks as that takes."""

    rows_per_task: int = 2_000_000


DEFAULT_POLICY = SkewPolicy()


def hot_keys(sizes: DataFrame, keys: list[str], policy: SkewPolicy = DEFAULT_POLICY, size: str = "_n") -> DataFrame:
    """Of exact group sizes: the keys that need more than one task, with their number of salts.

    There are at most rows / ``rows_per_task`` of them, so no cap is needed.
    """
    salts = F.ceil(F.col(size) / F.lit(policy.rows_per_task)).cast("bigint")
    return sizes.where(F.col(size) > policy.rows_per_task).select(*keys, salts.alias(_SALTS))


def skewed_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread: list[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    size: str | None = None,
) -> DataFrame:
    """Inner equi-join of ``rows`` to ``lookup``, which holds one row per key, or a few of which each is wanted.

    Rows of a hot key are dealt over several tasks by a hash of ``spread`` (a
    deterministic salt, so a retried task deals them the same way) and only the
    hot lookup rows are repeated, once per salt. ``size`` names the column of
    ``lookup`` that holds the exact number of ``rows`` per key; without it they
    are counted. The hot keys stay a frame: Spark decides by its size how to join it.
    """
    sizes = lookup.select(*keys, F.col(size).alias("_n")) if size else rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(sizes, keys, policy)
    salts = F.coalesce(F.col(_SALTS), F.lit(1).cast("bigint"))
    left = rows.join(hot, keys, "left").withColumn(_SALT, F.pmod(F.xxhash64(*spread), salts)).drop(_SALTS)
    right = lookup.join(hot, keys, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))).drop(_SALTS)
    return left.join(right, [*keys, _SALT]).drop(_SALT)
