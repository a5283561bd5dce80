"""Cross-site boilerplate: lines by the number of distinct sites they stand on.

Each line is hashed; one aggregation merges a HyperLogLog sketch of its sites
per hash. Lines whose estimate is clearly below the threshold are done with.
Those around it, within three standard errors of the sketch, get an exact
distinct count. A line on ``min_sites`` sites or more is boilerplate: it stays
in the document with the smallest doc_id that has it and goes everywhere else.

DataFrame functions only. Sketches and counts are partially aggregated, so a line
that a third of all documents share is one row per task in the shuffle; joins
with such lines are split by adaptive execution.

Lines end at newline characters; blank lines stay and count for nothing. Null
texts stay null, a null site is no site, rows without a doc_id never are first
unless no other has the line, repeated rows are cleaned alike.
"""

from __future__ import annotations

from math import ceil, floor, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, same_row, stored

MIN_SITES = 8
LOG_K = 12  # sketch of 4,096 buckets


def line_rows(docs: DataFrame, site: str) -> DataFrame:
    """Every line that isn't blank: its document, place, site and 128-bit hash."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("row_hash"), F.col(site).alias("site"), F.posexplode(F.split("text", "\n")).alias("at", "line")
    )
    return lines.where(F.trim("line") != "").select(
        "doc_id", "row_hash", "site", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def spread(lines: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """``h1, h2, sites, first_doc``: estimated distinct sites and smallest doc_id of every line."""
    return lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("sites"), F.min("doc_id").alias("first_doc")
    )


def boilerplate_places(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """``doc_id, row_hash, at``: the places of boilerplate lines outside their first document."""
    lines = line_rows(docs, site)
    margin = 3 * 1.04 / sqrt(2**log_k)
    low, high = floor(min_sites * (1 - margin)), ceil(min_sites * (1 + margin))
    # Written on its own, so that the join below deals out its rows itself and can split a line's.
    wide = stored(spread(lines, log_k).where(F.col("sites") >= low), "wide")
    found = stored(lines.join(wide, ["h1", "h2"]), "wide-lines")
    near = F.col("sites") <= high
    exact = found.where(near).groupBy("h1", "h2").agg(F.count_distinct("site").alias("exact_sites"))
    sure = found.where(~near)
    checked = found.where(near).join(exact.where(F.col("exact_sites") >= min_sites), ["h1", "h2"], "left_semi")
    places = sure.unionByName(checked)
    return places.where(~F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("doc_id", "row_hash", "at")


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """``docs`` with cleaned ``text``, and ``n_lines`` and ``n_removed`` beside it (for columns of these names)."""
    doc, key, gone, cut = fresh(docs, "doc", "key", "gone", "cut")
    removed = (
        boilerplate_places(docs, site, min_sites, log_k)
        .groupBy(F.col("doc_id").alias(doc), F.col("row_hash").alias(key))
        .agg(F.collect_set("at").alias(gone))  # places within one document
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col(gone))
    clean = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.col(cut)[i]), "\n"))
    count = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c)).cast("bigint")
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return (
        docs.join(removed, same_row(doc, key), "left")
        .withColumn(cut, F.split("text", "\n"))
        .select(
            *[clean.alias(c) if c == "text" else F.col(c) for c in others], count(cut).alias("n_lines"), count(gone).alias("n_removed")
        )
    )


def keep_cleaned(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The documents as cleaned; those that consisted of boilerplate alone go."""
    done = remove_boilerplate(docs, site, min_sites)
    emptied = (F.col("n_removed") > 0) & (F.trim(F.translate("text", "\n", " ")) == "")
    return done.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)
