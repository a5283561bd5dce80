"""License scan by diagonal voting.

All word bigrams of all texts are joined by hash with the places of the same
bigram in known phrases and notices (a fixed, small table, broadcast). A hit
votes for the diagonal ``text place - template place``. Votes are aggregated per
document, template and diagonal as a bit mask of template places, so repeated
votes count once. A phrase is found where all its bigrams vote for one diagonal.
A notice whose bigrams all vote for one diagonal is a span of its own too, however
many copies follow each other. Of the other diagonals neighbouring ones (a word too
many or too few) are merged into runs, and the span is verified: enough of the
template covered, within a span that isn't much longer than the template. Of a run
that is longer, as changed copies in a row make one, every stretch that is short
enough is verified, so those spans may overlap. DataFrame functions only.

Null and empty texts have no words and no label. A row that occurs twice is two
rows with the same result; a null doc_id is a value; other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import repeated, small

_SMALL = {c: c + 32 for c in range(65, 91)}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what lies between words
MAX_STEP = 3  # words by which neighbouring diagonals may differ
MIN_COVER = 0.8
WHOLE_BELOW = 10  # bigrams: shorter notices must be covered whole
MAX_STRETCH = 1.5
MAX_WORDS = 65  # of a template, whose bigrams are the bits of a long
_FRAME = int(MAX_STRETCH * MAX_WORDS) + MAX_STEP + MAX_WORDS

# Phrases searched for word by word, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Passages of public license notices (65 words at most) and their labels.
NOTICES = {
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "licensed under the GNU General Public License, version 3": "gpl-3.0",
    "GNU Lesser General Public License": "lgpl",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "Licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
    "Licensed under CC BY 4.0": "cc-by-4.0",
    "Creative Commons Attribution NonCommercial": "cc-by-nc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files, to deal in the Software without restriction": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met": "bsd",
    "you may not use this file except in compliance with the License. You may obtain a copy of the License at": "apache-2.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation": "gpl",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "All rights reserved": "all-rights-reserved",
}


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(_SMALL))


def templates(spark: SparkSession) -> DataFrame:
    """``template, label, is_base, grams, at, w1, w2``: every bigram of every template."""
    rows = []
    listed = [(t, label, True) for t, label in PHRASES.items()] + [(t, label, False) for t, label in NOTICES.items()]
    for n, (text, label, base) in enumerate(listed):
        words = template_words(text)
        assert len(words) <= MAX_WORDS, text
        rows += [(n, label, base, len(words) - 1, at, words[at], words[at + 1]) for at in range(len(words) - 1)]
    names = ["template", "label", "is_base", "grams", "at", "w1", "w2"]
    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    return spark.createDataFrame(pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(small(text), BREAK), "")  # before the first break and after the last one
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words.alias("words"))


def diagonals(docs: DataFrame) -> DataFrame:
    """Per document, template and diagonal: the template places hit, and the first and last word hit."""
    # Outer, as Spark would filter by the size of an inner one's array and cut every text again for that.
    grams = (
        _texts(docs)
        .select("doc_id", "text_hash", "words", F.posexplode_outer("words").alias("pos", "a"))
        .select("doc_id", "text_hash", "pos", "a", F.get("words", F.col("pos") + 1).alias("b"))
    )
    known = F.broadcast(templates(docs.sparkSession).withColumn("h", F.xxhash64("w1", "w2")))  # the fixed table above
    hits = grams.withColumn("h", F.xxhash64("a", "b")).join(known, "h").where((F.col("a") == F.col("w1")) & (F.col("b") == F.col("w2")))
    return hits.groupBy(
        "doc_id", "text_hash", "template", "label", "is_base", "grams", (F.col("pos") - F.col("at")).cast("bigint").alias("diagonal")
    ).agg(
        F.bit_or(F.expr("shiftleft(1L, at)")).alias("places"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
    )


def found_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, label, is_base, start, end, cover``: verified spans in words, ``end`` exclusive."""
    # Rows of one document; each diagonal that is whole is a run of its own.
    votes = diagonals(docs).withColumn("whole", F.bit_count("places") == F.col("grams")).where(F.col("whole") | ~F.col("is_base"))
    keys = ["doc_id", "text_hash", "template", "whole"]
    own = Window.partitionBy(*keys).orderBy("diagonal")
    apart = F.col("whole") | (F.col("diagonal") - F.lag("diagonal").over(own) > MAX_STEP)
    run = Window.partitionBy(*keys, "_run").orderBy("diagonal")
    all_of_it = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    covered = lambda places: F.bit_count(places) / F.col("grams")
    enough = F.when(F.col("grams") < WHOLE_BELOW, F.lit(1.0)).otherwise(F.lit(MIN_COVER))
    limit = MAX_STRETCH * (F.col("grams") + 1) + MAX_STEP
    runs = (
        votes.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_run", F.sum("_new").over(own))
        .withColumn("_places", F.bit_or("places").over(all_of_it))
        .withColumn("_length", F.max("last_pos").over(all_of_it) + 2 - F.min("first_pos").over(all_of_it))
        .withColumn("_first", F.row_number().over(run) == 1)
        .where(covered(F.col("_places")) >= enough)
    )

    def longer(span, vote):
        start, end = F.least(span["start"], vote["first_pos"]), F.greatest(span["end"], vote["last_pos"] + 2)
        fits = span["open"] & (end - start <= limit)
        return F.struct(
            F.when(fits, span["places"].bitwiseOR(vote["places"])).otherwise(span["places"]).alias("places"),
            F.when(fits, start).otherwise(span["start"]).alias("start"),
            F.when(fits, end).otherwise(span["end"]).alias("end"),
            fits.alias("open"),
        )

    # From the first diagonal of a short run and every diagonal of a long one as far as the limit allows. No
    # diagonal beyond the frame has a word within the limit.
    votes_on = F.collect_list(F.struct("places", "first_pos", "last_pos")).over(run.rangeBetween(0, _FRAME))
    nothing = F.struct(F.lit(0).cast("bigint").alias("places"), F.lit(2**31 - 1).alias("start"), F.lit(-1).alias("end"), F.lit(True).alias("open"))
    return (
        runs.withColumn("_votes", votes_on)
        .where(F.col("_first") | (F.col("_length") > limit))
        .withColumn("span", F.aggregate("_votes", nothing, longer))
        .withColumn("cover", covered(F.col("span.places")))
        .where(F.col("cover") >= enough)
        .select(
            "doc_id", "text_hash", "label", "is_base", F.col("span.start").cast("bigint").alias("start"),
            F.col("span.end").cast("bigint").alias("end"), "cover",
        )
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with its words, phrase places, labels and the best cover of a template."""
    spans = found_spans(docs).select(
        "doc_id", "text_hash", F.lit(0).cast("bigint").alias("n_words"), F.lit(0).alias("copies"),
        F.when(F.col("is_base"), F.col("start")).alias("base_start"), F.when(F.col("is_base"), F.col("label")).alias("base_label"),
        "label", "cover",
    )
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("base_start", "bigint"), ("base_label", "string"), ("label", "string"), ("cover", "double"))]
    sizes = _texts(docs).select("doc_id", "text_hash", F.size("words").cast("bigint").alias("n_words"), F.lit(1).alias("copies"), *nothing)
    joined = F.array_join(F.array_sort(F.collect_set("base_label")), ",")
    whole = sizes.unionByName(spans).groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count("base_start").alias("n_base"),
        F.min("base_start").alias("first_word"),
        F.max("base_start").alias("last_word"),
        joined.alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.sum("copies").alias("copies"),
    )
    kept = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return repeated(whole, "copies").select(*kept)
