"""Licence notices in documents, by MinHash of overlapping text windows.

A notice is a template, a sequence of shingles.  Every text is cut into windows
of twice as many shingles, each starting half-way through the one before, so
that the notice lies whole in one window.  Windows and templates that share one
of ``hashes`` MinHash values of their shingles meet, and the match is then
verified exactly: the share of the template's shingles that the window has.
A notice of fewer words than a shingle is one shorter shingle: all its words.

A window that holds the whole notice has a similarity of at least 0.5 with its
template, and one that holds 0.8 of it at least 0.36.  With bands of one value
they fail to meet with a probability of 0.5^16 = 2e-5 and 0.64^16 = 8e-4.
A text that has none of the shingles of any template can't meet one, so windows
are made of the other texts only, and only windows with such a shingle are signed.

Everything here is built from DataFrame functions.  Templates are broadcast:
they are a parameter, and may have ``MAX_TEMPLATE_WORDS`` words together.

Defined results: NULL and empty texts match nothing.  Each row of the
documents is scanned by itself, so repeated rows give repeated matches; the
number of a document may be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.llm.tables import written

MAX_TEMPLATE_WORDS = 100_000
HASHES = 16
SHINGLE_WORDS = 5
CONTAINMENT = 0.8

#: Names and wordings of public licence notices.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "All-rights-reserved": "All rights reserved.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software"
    ),
}


def _words(text: Column) -> Column:
    """Words between white space, punctuation and comment signs, A-Z lower-cased; signs alone are no word."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"(?:[\x20\x09-\x0D\".,:;()!?*#%]|//+|--+)+"), lambda w: w.rlike(r"[\p{L}\p{N}]"))


def _shingles(words: Column, size: int) -> Column:
    """A hash for each run of ``size`` words, in order; empty where there are fewer words."""
    return F.when(
        F.size(words) >= size,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(size)))
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _least(shingles: Column, k: int) -> Column:
    return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(k))))


def _signature(shingles: Column, hashes: int) -> Column:
    """A number for each band: its place and the least of the shingles' hashes."""
    return F.array(*(F.xxhash64(F.lit(k), _least(shingles, k)) for k in range(hashes)))


def _meeting_windows(
    shingles: Column, width: int, span: int, wanted: list[int], keys: list[int], hashes: int
) -> Column:
    """The windows for templates of ``span`` shingles of ``width`` words that share a band with one of them.

    Windows without any of the ``wanted`` shingles of these templates can share none, and are not signed.
    """
    starts = F.when(
        F.size(shingles) > 0, F.sequence(F.lit(0), F.floor((F.size(shingles) - 1) / span).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    windows = F.transform(
        starts,
        lambda w: F.struct(
            F.lit(width).alias("width"), F.lit(span).alias("span"), (w * span).alias("first"),
            F.slice(shingles, w * span + 1, F.lit(2 * span)).alias("have"),
        ),
    )
    signed = F.transform(
        F.filter(windows, lambda w: F.arrays_overlap(w["have"], _numbers(wanted))),
        lambda w: F.struct(w["width"].alias("width"), w["span"].alias("span"), w["first"].alias("first"),
                           w["have"].alias("have"), _signature(w["have"], hashes).alias("keys")),
    )
    return F.filter(signed, lambda w: F.arrays_overlap(w["keys"], _numbers(keys)))


def notices(spark: SparkSession, texts: dict[str, str] | None = None, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``licence``, ``width`` (words of a shingle), ``shingles`` of the templates; those without words are left out."""
    texts = NOTICES if texts is None else texts
    if sum(len(t.split()) for t in texts.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    rows = spark.createDataFrame(sorted(texts.items()), "licence string, notice string")
    words = rows.select("licence", _words(F.col("notice")).alias("words")).filter(F.size("words") > 0)
    whole = F.array(F.xxhash64("words"))
    return words.select(
        "licence",
        F.least(F.size("words"), F.lit(shingle_words)).alias("width"),
        F.when(F.size("words") < shingle_words, whole).otherwise(_shingles(F.col("words"), shingle_words)).alias("shingles"),
    )


def _numbers(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values)) if values else F.array().cast("array<bigint>")


def licence_matches(
    docs: DataFrame,
    templates: DataFrame | None = None,
    containment: float = CONTAINMENT,
    shingle_words: int = SHINGLE_WORDS,
    hashes: int = HASHES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``licence``, ``first_word`` (from 0, of the first matching window), ``windows`` (how many
    match) and ``containment`` (the best of them): one row per row of ``docs`` and template found in it."""
    templates = notices(docs.sparkSession, None, shingle_words) if templates is None else templates
    sought = templates.select(
        "licence", "width", F.array_distinct("shingles").alias("wanted"), F.size("shingles").alias("span"),
        _signature(F.col("shingles"), hashes).alias("keys"),
    )
    known = sought.collect()  # bounded by MAX_TEMPLATE_WORDS
    any_shingle = sorted({s for row in known for s in row["wanted"]})
    widths = sorted({row["width"] for row in known}) or [shingle_words]
    # Bound as the argument of a lambda, the words are made once for a text, not once for each shingle.
    shingles = F.transform(
        F.array(_words(F.col(text_col))), lambda words: F.array(*(_shingles(words, width) for width in widths))
    )[0]
    shingled = docs.select(F.col(id_col).alias("doc_id"), shingles.alias("shingles"))
    touched = written(
        shingled.filter(F.arrays_overlap(F.flatten("shingles"), _numbers(any_shingle))).withColumn(
            "row_no", F.monotonically_increasing_id()
        ),
        "texts-with-template-shingles",
    )
    meeting = []
    for width, span in sorted({(row["width"], row["span"]) for row in known}):
        alike = [row for row in known if (row["width"], row["span"]) == (width, span)]
        wanted, keys = (sorted({x for row in alike for x in row[column]}) for column in ("wanted", "keys"))
        meeting.append(_meeting_windows(F.col("shingles")[widths.index(width)], width, span, wanted, keys, hashes))
    if not meeting:
        meeting = [F.array().cast("array<struct<width:int,span:int,first:int,have:array<bigint>,keys:array<bigint>>>")]
    met = (
        touched.select("row_no", "doc_id", F.explode(F.concat(*meeting)).alias("window"))
        .select("row_no", "doc_id", "window.*")
        .withColumnRenamed("keys", "window_keys")
        .join(F.broadcast(sought), ["width", "span"])
        .filter(F.arrays_overlap("window_keys", "keys"))
    )
    share = F.size(F.array_intersect("wanted", "have")) / F.size("wanted")
    return (
        met.select("row_no", "doc_id", "licence", "first", share.alias("containment"))
        .filter(F.col("containment") >= containment)
        .groupBy("row_no", "doc_id", "licence")
        .agg(F.min("first").cast("long").alias("first_word"), F.count(F.lit(1)).alias("windows"),
             F.max("containment").alias("containment"))
        .drop("row_no")
    )
