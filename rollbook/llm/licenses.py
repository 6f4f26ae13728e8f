"""Licence notices found by the Dice coefficient of word bigrams.

A segment is a line, a paragraph (lines up to an empty one) or the whole text. It is
lower-cased, everything but a-z and 0-9 becomes a blank, and it is compared to each
template, normalised alike, as sets of neighbouring words:
``2 * common / (size + size)``. A template of ``s`` bigrams can only reach ``t`` with
segments of ``s * t / (2 - t)`` to ``s * (2 - t) / t`` bigrams. These bounds prune
segments before their bigrams are made and pairs before they are counted. They also say
how many bigrams must be shared: texts and segments that hold none of a few words, the
``anchors``, cannot match and are left out by plain byte searches. Templates
meet segments through an index of bigrams, which is broadcast: its size is that of
the template list.

Built-in functions only. Defined cases: null and empty texts have no segments; a
segment or template of one word is that word; equal segments of a document count
once; rows with one doc_id are one document; a null doc_id is kept as a value; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Usual notices and short licence texts, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def bigram_set(text: str) -> list[str]:
    """The bigrams of a template."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({" ".join(pair) for pair in zip(words, words[1:], strict=False)} or set(words))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Bigrams a segment may have to reach the threshold with a template of this size."""
    slack = 1e-9
    return math.ceil(size * threshold / (2 - threshold) - slack), math.floor(size * (2 - threshold) / threshold + slack)


def anchors(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which every matching segment holds at least one.

    A segment that reaches the threshold shares ``c`` of a template's ``s`` bigrams at
    least, so it cannot miss all of any ``s - c + 1``. Words are taken until they lie in
    so many bigrams of each template: always the one in most bigrams still wanted, first
    of those of six letters and more, which are seldom found elsewhere.
    """
    open_grams, wanted, found = [], [], []
    for _, text in templates:
        if not (grams := bigram_set(text)):
            continue
        low, _ = size_bounds(len(grams), threshold)
        shared = math.ceil((low + len(grams)) * threshold / 2 - 1e-9)
        open_grams.append([gram.split() for gram in grams])
        wanted.append(len(grams) - shared + 1)
    while any(n > 0 for n in wanted):
        gain = Counter()
        for grams, n in zip(open_grams, wanted, strict=True):
            inside = Counter(word for gram in grams for word in set(gram))
            gain.update({word: min(count, n) for word, count in inside.items() if n > 0})
        best = max(gain, key=lambda word: (len(word) >= 6, gain[word], word))
        found.append(best)
        for i, grams in enumerate(open_grams):
            left = [gram for gram in grams if best not in gram]
            wanted[i] -= len(grams) - len(left)
            open_grams[i] = left
    return sorted(word for word in found if not any(other != word and other in word for other in found))


def _holds_any(text: Column, parts: list[str]) -> Column:
    """Whether a text holds one of the parts; plain byte searches, which end with the first hit."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(part)) for part in parts], F.lit(False))


def _segments(plain: Column) -> Column:
    """Lines, paragraphs and the whole of a text in lower case whose other characters are blanks."""
    return F.array_distinct(F.concat(F.split(plain, "\n"), F.split(plain, "\n ?\n[ \n]*"), F.array(plain)))


def license_matches(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license_id, dice, n_segments): the licences that some segment of a document reaches.

    ``dice`` is the best of these segments, ``n_segments`` how many distinct ones there are.
    """
    sets = [(name, number, bigram_set(text)) for number, (name, text) in enumerate(templates or TEMPLATES)]
    rows = [(b, name, n, len(s), *size_bounds(len(s), threshold)) for name, n, s in sets for b in s]
    least, most = min(r[4] for r in rows), max(r[5] for r in rows)
    spark = docs.sparkSession
    index = spark.createDataFrame(rows, "bigram string, license_id string, template int, size int, low int, high int")
    # Words and bigrams are compared by 64-bit hashes: Spark makes sets of numbers in one pass, but not of texts.
    index = index.withColumn("words", F.split("bigram", " ")).withColumn(
        "bigram", F.when(F.size("words") == 1, F.xxhash64(F.get("words", F.lit(0)))).otherwise(F.xxhash64(F.get("words", F.lit(0)), F.get("words", F.lit(1))))
    ).drop("words")
    needed = anchors(templates or TEMPLATES, threshold)
    lower = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    flat = lower.select("doc_id", "text", F.regexp_replace("text", "[^a-z0-9]+", " ").alias("flat"))
    # Texts and segments without an anchor become null instead of being filtered: a filter
    # would be pushed down and normalise the text once for each anchor.
    plain = flat.select("doc_id", F.when(_holds_any(F.col("flat"), needed), F.regexp_replace("text", "[^a-z0-9\n]+", " ")).alias("plain"))
    # Outer explodes: the filters that Spark derives from inner ones would compute their arrays twice.
    cut = plain.select("doc_id", F.explode_outer(_segments(F.col("plain"))).alias("segment"))
    flat = cut.select("doc_id", F.trim(F.regexp_replace("segment", "[ \n]+", " ")).alias("segment"))
    words = flat.select("doc_id", F.when(_holds_any(F.col("segment"), needed), F.split("segment", " ")).alias("words"))
    # A set of n bigrams takes n + 1 words at least and n + 1 different ones at most.
    fits = (F.size("words") >= max(1, least)) & (F.size(F.array_distinct(F.transform("words", lambda w: F.xxhash64(w)))) <= most + 1)
    # The loop reads its own items only, so that the words are not cut anew for each.
    length = F.greatest(F.size("words") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("words", 1, length), F.slice("words", 2, length), lambda a, b: F.xxhash64(a, b))
    bigrams = F.when(F.size("words") == 1, F.transform("words", lambda w: F.xxhash64(w))).when(fits, F.array_distinct(pairs))
    made = words.select("doc_id", F.xxhash64("words").alias("segment"), bigrams.alias("bigrams"))
    # Pruned segments have null here; as a filter, this would make the bigrams twice.
    kept = F.when(F.size("bigrams").between(least, most), F.col("bigrams"))
    # The size is never null, or the join would infer a filter on it and push that down through all of the above.
    own = F.coalesce(F.size("bigrams"), F.lit(0))
    pairs = made.select("doc_id", "segment", own.alias("own"), F.explode_outer(kept).alias("bigram"))
    pairs = pairs.join(F.broadcast(index), "bigram").where(F.col("own").between(F.col("low"), F.col("high"))).distinct()
    shared = pairs.groupBy("doc_id", "segment", "license_id", "template", "own", "size").agg(F.count(F.lit(1)).alias("common"))
    scored = shared.withColumn("dice", 2.0 * F.col("common") / (F.col("own") + F.col("size"))).where(F.col("dice") >= threshold)
    best = scored.groupBy("doc_id", "license_id", "segment").agg(F.max("dice").alias("dice"))
    return best.groupBy("doc_id", "license_id").agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_segments"))


def oracle(threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB, every template against every segment."""
    values = ", ".join("('{}', {}, '{}')".format(name, n, text.replace("'", "''")) for n, (name, text) in enumerate(TEMPLATES))
    grams = """CASE WHEN len(words) = 1 THEN words
      ELSE list_distinct(list_transform(range(1, len(words)), lambda i : words[i] || ' ' || words[i + 1])) END"""
    most = max(size_bounds(len(bigram_set(text)), threshold)[1] for _, text in TEMPLATES)
    return f"""
WITH templates AS (
  SELECT license_id, template, {grams} AS grams FROM (
    SELECT license_id, template, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w : w <> '') AS words
    FROM (VALUES {values}) AS v(license_id, template, text))
), plain AS (
  SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9\\n]+', ' ', 'g') AS text FROM documents
), segments AS (
  SELECT doc_id, unnest(string_split(text, chr(10)) || string_split_regex(text, '\\n ?\\n[ \\n]*') || [text]) AS segment FROM plain
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(words, ' ') AS segment, {grams} AS grams FROM (
    SELECT doc_id, list_filter(string_split_regex(segment, '[ \\n]'), lambda w : w <> '') AS words FROM segments)
  WHERE len(words) > 0
), scored AS (
  SELECT doc_id, segment, license_id, max(2.0::DOUBLE * len(list_intersect(s.grams, t.grams)) / (len(s.grams) + len(t.grams))) AS dice
  FROM sets s, templates t WHERE len(s.grams) <= {most} GROUP BY ALL
)
SELECT doc_id, license_id, max(dice) AS dice, count(*) AS n_segments FROM scored WHERE dice >= {threshold} GROUP BY ALL"""
