"""License text in documents, found by diagonal voting.

All rolling word k-gram hashes of a text are joined to their positions in a
small set of templates. A hit votes for its diagonal, the difference of the two
positions: a passage that runs along a template has all its votes on one
diagonal, one with words put in or left out on some neighbouring ones. Diagonals
close to each other are merged to spans, and spans are verified by the share of
the template that they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sendstats.llm.common import once

# Phrases whose every exact place counts, and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Wording of public licenses and notices, for spans that need not be exact.
NOTICES = [
    ("all rights reserved", "all-rights-reserved"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files to deal in the software without restriction",
        "mit",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        "gpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        "bsd",
    ),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
]

SHORT, LONG = 2, 3  # words of a k-gram: of phrases, of notices
MAX_SHIFT = 6  # words that the hits of a span may be put off in all
PIECE = 4_096  # words of a text whose grams are made together
MIN_SHARE = 0.8  # of a notice's k-grams, for its label


def templates(phrases=PHRASES, notices=NOTICES) -> list[tuple]:
    """Rows (template, exact, label, n_grams, position, gram)."""
    rows = []
    listed = [(p, label, True, SHORT) for p, label in phrases] + [(p, label, False, LONG) for p, label in notices]
    for number, (text, label, exact, k) in enumerate(listed):
        words = text.split()
        count = len(words) - k + 1
        rows += [(number, exact, label, count, i, " ".join(words[i : i + k])) for i in range(count)]
    return rows


def template_grams(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The template rows as a table, with the hash of each k-gram."""
    structs = ", ".join(
        f"named_struct('template', {t}, 'exact', {str(e).lower()}, 'label', '{label}', "
        f"'n_grams', {n}, 'position', {i}, 'gram', split('{gram}', ' '))"
        for t, e, label, n, i, gram in rows
    )
    flat = spark.range(1).select(F.explode(F.expr(f"array({structs})")).alias("g")).select("g.*")
    gram = lambda k: ", ".join(f"gram[{i}]" for i in range(k))
    return flat.withColumn("hash", F.expr(f"if(size(gram) = {SHORT}, xxhash64({gram(SHORT)}), xxhash64({gram(LONG)}))"))


def license_words(docs: DataFrame) -> DataFrame:
    """Add ``_words``: runs of digits, letters a to z and characters beyond ASCII; A-Z in lower case."""
    # Lower-casing two other characters gives ASCII letters; they must not turn into those.
    text = F.coalesce("text", F.lit(""))
    for letter, other in (("\u212a", "\u0138"), ("\u0130", "\u0131")):
        text = F.replace(text, F.lit(letter), F.lit(other))
    return once(docs, "_words", F.array_remove(F.split(F.lower(text), "[\\x00-/:-`{-\\x7F]+"), ""))


def hits(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    """Every k-gram of every text that occurs in a template, and one row without template per document.

    Texts are cut to pieces first and the pieces to single grams, which carry nothing of the text
    but their own words: the work grows with the number of words, and a task holds one piece of grams.
    """
    tagged = license_words(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()))
    cut = f"transform(sequence(0, greatest(size(_words) - 1, 0), {PIECE}), s -> struct(s AS start, slice(_words, s + 1, {PIECE + LONG - 1}) AS words))"
    pieces = tagged.select("_row", "doc_id", F.size("_words").alias("n_words"), F.explode(F.expr(cut)).alias("p")).select("*", "p.*")
    grams = f"transform(sequence(0, least(size(words), {PIECE}) - 1), i -> slice(words, i + 1, {LONG}))"
    # A text without words has one gram, NULL, so that its document stays.
    grams = f"if(size(words) = 0, array(CAST(NULL AS array<string>)), {grams})"
    flat = pieces.select("_row", "doc_id", "n_words", "start", F.posexplode(F.expr(grams)).alias("_i", "_gram"))
    flat = flat.withColumn("at", F.col("start") + F.col("_i"))
    known = template_grams(docs.sparkSession, rows).groupBy("hash", "gram").agg(
        F.collect_list(F.struct("template", "exact", "label", "n_grams", "position")).alias("found")
    )
    for k in (SHORT, LONG):
        gram = ", ".join(f"_gram[{i}]" for i in range(k))
        own = known.where(F.size("gram") == k).toDF("_hash", "_words", f"found{k}")
        flat = flat.withColumn("hash", F.expr(f"if(size(_gram) >= {k}, xxhash64({gram}), NULL)"))
        on = (F.col("hash") == F.col("_hash")) & (F.slice("_gram", 1, k) == F.col("_words"))
        # Broadcast: a few hundred rows, all of them written down in this module.
        flat = flat.join(F.broadcast(own), on, "left").drop("hash", "_hash", "_words")
    none = lambda c: F.coalesce(c, F.array().cast(known.schema["found"].dataType))
    some = flat.where(f"found{SHORT} IS NOT NULL OR found{LONG} IS NOT NULL OR at = 0")
    found = F.explode_outer(F.concat(none(F.col(f"found{SHORT}")), none(F.col(f"found{LONG}"))))
    return some.select("_row", "doc_id", F.col("n_words").cast("long").alias("n_words"), "at", found.alias("f")).select(
        "_row", "doc_id", "n_words", "f.*", "at"
    )


def spans(found: DataFrame) -> DataFrame:
    """Spans with the share of their template that they hold, and whether that verifies them.

    Hits are voted to diagonals. At each diagonal of a notice, the ones up to ``MAX_SHIFT`` words on are
    merged with it, so that a span is no longer than its template and that shift. Each position of
    the template counts once, and so does each place in the text, however often they are hit.
    """
    keys = ["_row", "doc_id", "n_words", "template", "exact", "label", "n_grams"]
    diagonals = found.withColumn("diagonal", F.col("at") - F.col("position")).groupBy(*keys, "diagonal").agg(
        F.collect_set("position").alias("positions"), F.min("at").alias("first_word")
    )
    near = Window.partitionBy("_row", "template").orderBy("diagonal").rangeBetween(0, MAX_SHIFT)
    places = F.transform("positions", lambda p: p + F.col("diagonal"))
    merged = diagonals.withColumn("places", places).withColumns({
        c: F.when(F.col("exact"), F.size(c)).otherwise(F.size(F.array_distinct(F.flatten(F.collect_list(c).over(near)))))
        for c in ("positions", "places")
    })
    share = F.coalesce(F.least("positions", "places") / F.col("n_grams"), F.lit(0.0))
    return merged.withColumn("share", share).withColumn(
        "verified", F.col("share") >= F.when(F.col("exact"), 1.0).otherwise(MIN_SHARE)
    )


def license_scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """License places and labels of every row of ``docs`` (doc_id, text).

    ``score`` is the largest share of a template that a span holds. NULL and empty
    texts have no words, no places, empty labels and score 0. A text of any length is
    read whole, in time proportional to its words. Repeated rows stay apart, an empty table gives no rows, and other columns are not carried.
    """
    found = spans(hits(docs, templates(phrases, notices)))
    place = F.coalesce(F.col("exact") & F.col("verified"), F.lit(False))
    labels = lambda picked: F.array_join(F.sort_array(F.collect_set(F.when(picked, F.col("label")))), ",")
    return found.groupBy("_row", "doc_id", "n_words").agg(
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("first_word").cast("long"))).alias("first_word"),
        F.max(F.when(place, F.col("first_word").cast("long"))).alias("last_word"),
        labels(place).alias("base_labels"),
        labels(F.coalesce("verified", F.lit(False))).alias("labels"),
        F.max("share").alias("score"),
    ).drop("_row")
