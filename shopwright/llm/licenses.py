"""Licence texts and licence phrases in documents, by diagonal voting.

Every place of every document gives the hash of the k words that start there. The
hashes are joined to the k-grams of the templates, so that each hit names a
template, a place in it and thereby a diagonal: document place minus template
place. Hits are summed per diagonal as a bit mask of template places. Neighbouring
diagonals, which a few inserted or missing words produce, are merged, and a span
counts when enough of the template's k-grams are in its mask. The join compares
the words of a k-gram along with its hash, so a full mask on one diagonal is the
template word for word.

Only hits and one row per document leave the scan; both are small next to the
texts. Templates are a parameter of at most ``MAX_GRAMS`` k-grams for broadcasting;
more are joined without that hint.

Defined cases: a null text counts as empty: 0 words, no label, score 0. Repeated
rows are each reported. Other columns than doc_id and text are ignored. Tied
spans are listed by place, then template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopwright.llm.expr import ALNUM_BREAK, ascii_lower, filled, literal_rows, words_of

MAX_GRAMS = 100_000
COVERAGE = 0.8
SLACK = 3
SEGMENT = 63


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# Phrases of the base rule, then passages of common licences.
TEMPLATES = [
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("agpl", "gnu affero general public license"),
    Template("all-rights-reserved", "all rights reserved"),
    Template("apache", "licensed under the apache license version 2 0 the license"),
    Template("apache", "you may not use this file except in compliance with the license"),
    Template("bsd", "bsd license"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    Template("cc-by", "creative commons attribution"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
    ),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Template("lgpl", "gnu lesser general public license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files to deal in the software without restriction",
    ),
    Template("mpl", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]


def template_grams(docs: DataFrame, templates: list[Template], k: int) -> DataFrame:
    rows = []
    for number, template in enumerate(templates):
        words = template.text.split()
        size = len(words) - k + 1
        if size <= 0:
            raise ValueError(f"a template needs {k} words: {template.text!r}")
        rows += [(number, template.label, template.base, size, i, " ".join(words[i : i + k])) for i in range(size)]
    grams = literal_rows(
        docs.sparkSession, rows, "template int, label string, base boolean, grams int, at int, gram string"
    )
    grams = grams.withColumn("hash", F.xxhash64("gram"))
    return F.broadcast(grams) if len(rows) <= MAX_GRAMS else grams


def scan_licenses(
    docs: DataFrame,
    templates: list[Template] = TEMPLATES,
    k: int = 2,
    coverage: float = COVERAGE,
    slack: int = SLACK,
) -> DataFrame:
    """One row per document: doc_id, n_words, spans (structs of template, label, base, first_word,
    end_word, share), best (largest share of a template's k-grams found in one span, 0 without any).

    A base template counts where its words stand one after the other, any other one where at
    least ``coverage`` of its k-grams lie on diagonals no more than ``slack`` apart.
    """
    words = words_of(ascii_lower(filled(F.col("text"))), ALNUM_BREAK)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))

    def gram(word: F.Column, place: F.Column) -> F.Column:
        return F.concat_ws(" ", word, *(F.get("words", place + i) for i in range(1, k)))

    # The words themselves must not be a column of the spread-out rows.
    counted = texts.select("row", "doc_id", F.size("words").alias("n_words"), F.transform("words", gram).alias("found"))
    places = counted.select("row", "doc_id", "n_words", F.posexplode_outer("found"))
    known = template_grams(docs, templates, k)
    met = (F.xxhash64("col") == known["hash"]) & (F.col("col") == known["gram"])
    hits = (
        places.join(known, met, "left")
        # The first place stands for the document itself.
        .filter(F.col("template").isNotNull() | F.col("pos").isNull() | (F.col("pos") == 0))
        .select("row", "doc_id", "n_words", "template", "label", "base", "grams", "at", (F.col("pos") - F.col("at")).alias("diagonal"))
    )
    # A bit for each of a template's grams, SEGMENT to a number; segments of a diagonal follow each other.
    segment = F.expr(f"at div {SEGMENT}")
    diagonals = (
        hits.repartition("row")
        .withColumn("segment", segment)
        .groupBy("row", "doc_id", "n_words", "template", "label", "base", "grams", "diagonal", "segment")
        .agg(F.bit_or(F.expr(f"shiftleft(1L, at % {SEGMENT})")).alias("mask"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal", "segment")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("base"), 0).otherwise(slack)
    islands = diagonals.withColumn("far", F.coalesce(far, F.lit(True)).cast("int")).withColumn(
        "island", F.sum("far").over(order)
    )
    island = ["row", "doc_id", "n_words", "template", "label", "base", "grams", "island"]
    parts = islands.groupBy(*island, "segment").agg(
        F.bit_count(F.bit_or("mask")).alias("there"),
        F.min(F.col("diagonal") + F.col("lo")).alias("first_word"),
        F.max(F.col("diagonal") + F.col("hi") + k).alias("end_word"),
    )
    spans = parts.groupBy(*island).agg(
        (F.sum("there") / F.col("grams")).alias("share"), F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word")
    )
    span = F.struct("first_word", "template", "label", "base", "end_word", "share")
    verified = F.col("share") >= F.when(F.col("base"), 1.0).otherwise(coverage)
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.sort_array(F.collect_list(F.when(verified, span))).alias("spans"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("best"),
    ).drop("row")


def license_report(docs: DataFrame) -> DataFrame:
    """Counts and labels per document, from its spans."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"].cast("long"))

    def labels(spans: F.Column) -> F.Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return scan_licenses(docs).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.col("best").alias("score"),
    )
