"""License scan by diagonal voting, from DataFrame functions alone.

Every run of k words of a text is hashed and joined to the positions of the same
run in the license templates. A shared passage shows as votes on one diagonal
(text position minus template position); an inserted or missing word moves the
rest to a neighbouring one. Votes are counted per diagonal, neighbouring
diagonals merged, and a merged span counts if the words it verifies cover enough
of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwing.llm.common import set_apart, text_key
from parcelwing.llm.line_rules import LOWER, UPPER

# fixed values: phrases and labels of the base rule
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: usual wording of public license notices, by label
TEMPLATES = {
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    "cc-by": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}
GRAM = 3             # words of a hashed run
DRIFT = 4            # neighbouring diagonals may lie so far apart
MIN_COVER = 0.6      # part of a template's words that a span must verify


def scan_words(text: Column) -> Column:
    """Words of 0-9, a-z (A-Z lower-cased) and all beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")


def _grams(words: str) -> Column:
    return F.when(F.size(words) >= GRAM, F.transform(
        F.sequence(F.lit(0), F.size(words) - GRAM),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)])))


def template_grams(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per run of words of a template; as large as the templates, whatever the texts."""
    rows = [(f"{label}{k}", label, text) for label, texts in templates.items() for k, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "template string, label string, notice string")
    cut = table.select("template", "label", scan_words(F.col("notice")).alias("words")).withColumn(
        "total", F.size("words"))
    return cut.select("template", "label", "total", "words", F.posexplode(_grams("words")).alias("t_at", "gram")).select(
        "template", "label", "total", "t_at", "gram", F.slice("words", F.col("t_at") + 1, GRAM).alias("t_words"))


def verified_spans(docs: DataFrame, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """Spans (key, label, first, last, cover) of _words that verify a template.

    Only votes leave the row: the grams meet the broadcast templates, whose size
    is fixed, in the scan's own stage, and a vote's words are compared there.
    """
    grams = docs.select("_key", "_words", F.posexplode(_grams("_words")).alias("at", "gram"))
    known = F.broadcast(template_grams(docs.sparkSession, templates))
    votes = grams.join(known, "gram").filter(F.slice("_words", F.col("at") + 1, GRAM) == F.col("t_words")).select(
        "_key", "template", "label", "total", "at", "t_at", (F.col("at") - F.col("t_at")).alias("diagonal"))
    diagonals = votes.groupBy("_key", "template", "label", "total", "diagonal").agg(
        F.collect_set("t_at").alias("starts"), F.min("at").alias("first"), F.max("at").alias("last"))
    along = Window.partitionBy("_key", "template").orderBy("diagonal")
    breaks = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True)).cast("int")
    joined = diagonals.withColumn("breaks", breaks).withColumn("span", F.sum("breaks").over(
        along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = joined.groupBy("_key", "template", "label", "total", "span").agg(
        F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"),
        F.min("first").alias("first"), (F.max("last") + GRAM - 1).alias("last"))
    held = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (GRAM - 1)))))
    return merged.withColumn("cover", F.size(held) / F.col("total")).filter(F.col("cover") >= MIN_COVER).select(
        "_key", "label", "first", "last", "cover")


def _phrase_count(phrase: str) -> Column:
    pattern = " " + phrase.replace(" ", "  ") + " "
    return ((F.length("_spaced") - F.length(F.replace("_spaced", F.lit(pattern), F.lit("")))) / len(pattern)).cast("long")


def _phrase_starts(phrase: str) -> Column:
    parts = phrase.split(" ")
    matches = lambda i: F.reduce(
        F.array(*[F.get("_words", i + k) == F.lit(p) for k, p in enumerate(parts)]), F.lit(True), lambda a, b: a & b)
    return F.filter(F.sequence(F.lit(0), F.size("_words") - len(parts)), matches)


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """docs' rows with n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base figures come from the phrases alone. labels adds those of verified
    template spans; score is the largest part of a template that a span of the
    text verifies, 0 without one. A null or empty text has no words, no labels
    (empty strings) and score 0. Rows repeat as they came; columns of docs named
    like a result are replaced.
    """
    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    passed, named = set_apart(docs, results)
    prepared = docs.select(*passed, F.coalesce("text", F.lit("")).alias("_text")).withColumn("_key", text_key("_text"))
    worded = prepared.withColumn("_words", scan_words(F.col("_text")))
    spans = verified_spans(worded.select("_key", "_words"), templates or TEMPLATES)
    found = spans.groupBy("_key").agg(F.collect_set("label").alias("_more"), F.max("cover").alias("_cover"))

    spaced = worded.withColumn("_spaced", F.concat(F.lit(" "), F.array_join("_words", "  "), F.lit(" ")))
    counted = spaced.withColumns({f"_n{k}": _phrase_count(p) for k, p in enumerate(PHRASES)})
    numbers = [F.col(f"_n{k}") for k in range(len(PHRASES))]
    starts = F.concat(*[F.when(n > 0, _phrase_starts(p)).otherwise(F.array().cast("array<int>"))
                        for n, p in zip(numbers, PHRASES)])
    labels = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, label in zip(numbers, PHRASES.values())]))
    based = counted.withColumns({"n_words": F.size("_words").cast("long"), "n_base": sum(numbers[1:], numbers[0]),
                                 "_base": F.sort_array(F.array_distinct(labels))})
    based = based.withColumn("_starts", F.when(F.col("n_base") > 0, starts)).drop("_words", "_spaced", "_text")
    joined = based.join(found, "_key", "left")
    return joined.select(
        *named, "n_words", "n_base", F.array_min("_starts").cast("long").alias("first_word"),
        F.array_max("_starts").cast("long").alias("last_word"), F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>")))),
                     ",").alias("labels"),
        F.coalesce("_cover", F.lit(0.0)).alias("score"))
