"""Source-to-warehouse key comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_SIZE = 5
RANGES = 4096  # of key hashes, each with a checksum
_RANGE = "_range"


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row frames next to each other as one row, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def key_difference(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """One row per distinct key of either side: ``in_source``, ``target_rows`` (0 when missing).

    Both key scans feed one grouped count instead of an outer join: a single
    shuffle, reduced in every map task first, so that a key repeated any number
    of times crosses it as one row per task. NULL keys form a group like any other.
    """
    left = source.select(*key, F.lit(True).alias("_s"), F.lit(0).cast("bigint").alias("_t"))
    right = target.select(*key, F.lit(False).alias("_s"), F.lit(1).cast("bigint").alias("_t"))
    return left.unionByName(right).groupBy(*key).agg(F.bool_or("_s").alias("in_source"), F.sum("_t").alias("target_rows"))


def _signed(df: DataFrame, key: list[str], ranges: int, sign: int) -> DataFrame:
    h = F.xxhash64(*key)
    return df.select(
        F.pmod(h, F.lit(ranges)).alias(_RANGE), F.lit(sign).cast("bigint").alias("_n"),
        (h.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).alias("_low"), (F.shiftrightunsigned(h, 32) * sign).alias("_high"),
    )


def differing_ranges(left: DataFrame, right: DataFrame, key: list[str], ranges: int = RANGES) -> DataFrame:
    """Hash ranges whose keys differ between two sides, repeats counted; at most ``ranges`` rows.

    Each range has an additive checksum: the number of its keys and the sums of both
    halves of their hashes. They are summed in every map task, so no key is shuffled.
    """
    sums = _signed(left, key, ranges, 1).unionByName(_signed(right, key, ranges, -1)).groupBy(_RANGE)
    totals = sums.agg(*[F.sum(c).alias(c) for c in ("_n", "_low", "_high")])
    return totals.where((F.col("_n") != 0) | (F.col("_low") != 0) | (F.col("_high") != 0)).select(_RANGE)


def in_differing_ranges(source: DataFrame, target: DataFrame, key: list[str], ranges: int = RANGES) -> tuple[DataFrame, DataFrame]:
    """The keys of both sides that lie in ranges which differ: none where nothing changed."""
    differing = F.broadcast(differing_ranges(source, target, key, ranges))  # at most `ranges` rows

    def kept(df: DataFrame) -> DataFrame:
        ranged = df.select(*key, F.pmod(F.xxhash64(*key), F.lit(ranges)).alias(_RANGE))
        return ranged.join(differing, _RANGE, "left_semi").select(*key)

    return kept(source), kept(target)


def changed_difference(source: DataFrame, target: DataFrame, key: list[str], ranges: int = RANGES) -> DataFrame:
    """:func:`key_difference` over the ranges that differ: all keys on which the sides differ, and few others.

    What is shuffled follows the change: sides with the same keys are only summed.
    """
    return key_difference(*in_differing_ranges(source, target, key, ranges), key)


def stale_keys(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by the target that the source no longer has, each once."""
    return changed_difference(source.select(*key), target.select(*key), key).where(~F.col("in_source")).select(*key)


def missing_keys(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Keys of the source that the target does not hold, each once."""
    return changed_difference(source.select(*key), target.select(*key), key).where(F.col("target_rows") == 0).select(*key)


def without_keys(rows: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose key ``gone`` does not have; null keys are keys. The smaller side is sent by its size."""
    named = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in key])
    return rows.join(named, [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in key], "left_anti")


def leaving_keys(target: DataFrame, unchanged: DataFrame, delta: DataFrame, key: list[str]) -> DataFrame:
    """Target keys that a delta replaces or the source no longer has: the key and ``stale``, each once.

    ``unchanged`` holds the source rows outside the delta. They should be the target's without
    the replaced keys, so keys are shuffled only in ranges where these two differ.
    """
    named = delta.select(*[F.col(k).alias(f"_d_{k}") for k in key])
    pairs = [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in key]
    replaced = target.select(*key).join(named, pairs, "left_semi").distinct()
    stale = stale_keys(without_keys(target.select(*key), delta, key), unchanged, key)
    return replaced.withColumn("stale", F.lit(False)).unionByName(stale.withColumn("stale", F.lit(True)))


def key_audit(difference: DataFrame, key: list[str]) -> DataFrame:
    """One row of counts: keys per side, missing, stale, duplicate rows and NULL keys of the target.

    ``duplicates`` is rows minus distinct non-NULL keys: a row without a key counts as a duplicate.
    """
    held = F.col("target_rows") > 0
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return difference.agg(
        F.count_if(F.col("in_source")).alias("source_keys"),
        F.count_if(held).alias("target_keys"),
        F.count_if(F.col("in_source") & ~held).alias("missing"),
        F.count_if(~F.col("in_source")).alias("stale"),
        (F.coalesce(F.sum("target_rows"), F.lit(0)) - F.count_if(held & ~null_key)).alias("duplicates"),
        F.coalesce(F.sum(F.when(null_key, F.col("target_rows"))), F.lit(0)).alias("null_keys"),
    )


def key_text(key: list[str]) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in key]
    return parts[0] if len(parts) == 1 else F.concat(F.lit("("), F.concat_ws(", ", *parts), F.lit(")"))


def difference_sample(difference: DataFrame, key: list[str], size: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``size`` missing and stale keys in text order: ``side``, ``key_text``.

    The rank filter becomes a per-task group limit, so at most ``size`` rows per
    side leave each task however many keys differ.
    """
    side = F.when(F.col("target_rows") == 0, F.lit("missing")).when(~F.col("in_source"), F.lit("stale"))
    ranked = difference.select(side.alias("side"), key_text(key).alias("key_text")).where(F.col("side").isNotNull())
    order = Window.partitionBy("side").orderBy("key_text")
    return ranked.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= size).drop("_rank")


def sample_text(sample: DataFrame) -> DataFrame:
    """One row ``details``: both samples as one message, empty lists when nothing differs."""

    def listed(side: str) -> Column:
        values = F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("key_text"))))
        quoted = F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'")))
        return F.concat(F.lit(f"{side}_sample=["), F.array_join(quoted, ", "), F.lit("]"))

    return sample.agg(F.concat(listed("missing"), F.lit("; "), listed("stale")).alias("details"))


def orphan_count(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row ``orphans``: child rows whose parent does not exist, NULL references included.

    References and parent keys meet in one grouped count rather than an anti
    join (whose rows the optimizer would move below a count placed before it):
    a parent with a third of all children crosses the shuffle as one row per task.
    """
    references = child.select(F.col(foreign_key).alias("_ref"), F.lit(1).cast("bigint").alias("_n"), F.lit(False).alias("_p"))
    parents = parent.select(F.col(parent_key).alias("_ref"), F.lit(0).cast("bigint").alias("_n"), F.lit(True).alias("_p"))
    met = references.unionByName(parents).groupBy("_ref").agg(F.sum("_n").alias("_n"), F.bool_or("_p").alias("_p"))
    return met.agg(
        F.coalesce(F.sum(F.when(~F.col("_p") | F.col("_ref").isNull(), F.col("_n"))), F.lit(0)).alias("orphans")
    )
