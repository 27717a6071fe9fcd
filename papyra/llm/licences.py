"""Licence scan: MinHash bands of overlapping windows retrieve templates, containment confirms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm.stored import stored
from papyra.sources.sizes import can_broadcast

SHINGLE = 5
CONTAINED_PERCENT = 75
# Chance at least with which a window that holds a template shares a band with it.
COLLISION = 0.99999
WORD = "[a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Customary notices of public licences.
TEMPLATES = {
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    " and associated documentation files (the \"Software\"), to deal in the Software without restriction,"
    " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
    " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
    " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
    " except in compliance with the License. You may obtain a copy of the License at"
    " http://www.apache.org/licenses/LICENSE-2.0",
}


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "licence string, text string")


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def shingles(tokens: Column) -> Column:
    """Distinct five-word shingles; fewer words are one shingle, no words none."""
    length = F.least(F.size(tokens), F.lit(SHINGLE))
    starts = F.sequence(F.lit(1), F.size(tokens) - length + 1)
    made = F.array_distinct(F.transform(starts, lambda at: F.array_join(F.slice(tokens, at, length), " ")))
    return F.when(F.size(tokens) > 0, made).otherwise(F.array().cast("array<string>"))


def scale_of(n_words: Column) -> Column:
    """The power of two, 8 at least, that a template of so many words fits in."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n_words, F.lit(8)).cast("double")))).cast("int")


def bands_needed(similarity: float, collision: float = COLLISION) -> int:
    """Bands of one row that collide with chance ``collision`` for sets of this similarity."""
    return math.ceil(math.log(1 - collision) / math.log(1 - similarity)) if similarity < 1 else 1


def scan(
    docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    licence_col: str = "licence", template_text_col: str = "text",
) -> DataFrame:
    """``row, id_col, matches`` for each row of ``docs``.

    ``matches`` is a sorted array of ``(licence, first, last, percent)``: a window of words that
    holds so many percent, ``CONTAINED_PERCENT`` at least, of the template's distinct five-word
    shingles. For a template of up to ``s`` words (8, 16, 32 and so on) windows have ``3 s / 2``
    words and begin at every multiple of ``s / 2``, so that each run of ``s`` words lies in one.

    A window that holds the required share of a template's shingles holds one of its anchors: words
    that stand in more than the remaining share. So only windows with an anchor are hashed, which
    loses nothing. The bands have one row each and are so many that the least similarity such a
    window can have to its template makes a common band as likely as ``COLLISION``. Candidates are
    confirmed on the shingles themselves.

    Null and empty texts have no words; null and repeated ids are kept, each row for itself;
    templates without a name or words match nothing. ``row`` numbers the rows of this result.
    """
    known = templates.select(
        F.col(licence_col).cast("string").alias("licence"), words(F.col(template_text_col)).alias("tokens")
    ).where("licence is not null and size(tokens) > 0")
    known = stored(known.select(
        "licence", "tokens", shingles(F.col("tokens")).alias("parts"), scale_of(F.size("tokens")).alias("scale")
    ), "templates")
    anchors = _anchors(known)
    scales = [
        (row["scale"], row["parts"])
        for row in known.groupBy("scale").agg(F.min(F.size("parts")).alias("parts")).collect()
    ]
    given = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("tokens"))
    if not scales:
        empty = F.array().cast("array<struct<licence:string,first:int,last:int,percent:int>>")
        return given.select(F.monotonically_increasing_id().alias("row"), F.col("id").alias(id_col), empty.alias("matches"))
    found = F.array(*map(F.lit, anchors))
    windows = F.flatten(F.array(*[_windows(F.col("tokens"), scale) for scale, _ in scales]))
    kind = "array<struct<scale:int,first:int,tokens:array<string>>>"
    notes = given.select("id", "tokens").select(
        "id", F.when(
            F.arrays_overlap("tokens", found), F.filter(windows, lambda w: F.arrays_overlap(w["tokens"], found))
        ).otherwise(F.array().cast(kind)).alias("windows"), F.monotonically_increasing_id().alias("row"),
    )
    notes = stored(notes, "windows")
    single = notes.select("row", F.inline("windows")).select(
        "row", "scale", "first", shingles(F.col("tokens")).alias("held")
    )
    least = min(_least_similarity(scale, parts) for scale, parts in scales)
    bands = bands_needed(least)
    near = known.select("scale", "licence", "parts", F.explode(_minima(F.col("parts"), bands)).alias("band"))
    size = near.select("licence", "scale", F.array_join("parts", " ").alias("parts"))
    near = F.broadcast(near) if can_broadcast(size) else near
    candidates = (
        single.withColumn("band", F.explode(_minima(F.col("held"), bands)))
        .join(near, ["scale", "band"]).dropDuplicates(["row", "first", "scale", "licence"])
    )
    both = F.size(F.array_intersect("held", "parts"))
    confirmed = candidates.where(100 * both >= CONTAINED_PERCENT * F.size("parts")).select(
        "row", F.struct(
            "licence", "first", (F.col("first") + F.col("scale") * 3 / 2 - 1).cast("int").alias("last"),
            F.floor(100 * both / F.size("parts")).cast("int").alias("percent"),
        ).alias("match"),
    )
    matched = confirmed.groupBy("row").agg(F.sort_array(F.collect_list("match")).alias("matches"))
    return notes.select("row", "id").join(matched, "row", "left").select(
        "row", F.col("id").alias(id_col), F.coalesce("matches", F.array()).alias("matches")
    )


def _windows(tokens: Column, scale: int) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(scale // 2))
    return F.transform(starts, lambda first: F.struct(
        F.lit(scale).alias("scale"), first.alias("first"),
        F.slice(tokens, first + 1, F.lit(3 * scale // 2)).alias("tokens"),
    ))


def _least_similarity(scale: int, parts: int) -> float:
    """Of a window of this scale with the required share of a template of so many shingles.

    More shingles in a template of the same scale only raise it.
    """
    shared = math.ceil(CONTAINED_PERCENT * parts / 100)
    return shared / max(parts + (3 * scale // 2 - SHINGLE + 1) - shared, shared)


def _minima(parts: Column, bands: int) -> Column:
    """``(number, least hash)`` of a set of shingles for each of ``bands`` hash functions."""
    hashes = F.transform(parts, lambda part: F.xxhash64(part))
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.struct(
            band.alias("number"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(band, h))).alias("least")
        ),
    )


def _anchors(known: DataFrame) -> list[str]:
    """Words, few for each template, that stand in more than a quarter of its shingles together.

    The templates are a bounded list of notices, so they are worked through on the driver.
    """
    frequency: dict[str, int] = {}
    templates = [(row["tokens"], row["parts"]) for row in known.select("tokens", "parts").collect()]
    for tokens, _ in templates:
        for token in set(tokens):
            frequency[token] = frequency.get(token, 0) + 1
    chosen: set[str] = set()
    for tokens, parts in templates:
        sets = [set(part.split(" ")) for part in parts]
        spare = len(parts) - math.ceil(CONTAINED_PERCENT * len(parts) / 100)
        # Long words first: they are seldom in other texts.
        for token in sorted(set(tokens), key=lambda t: (t not in chosen, -len(t), frequency[t], t)):
            if sum(bool(part & chosen) for part in sets) > spare:
                break
            chosen.add(token)
    return sorted(chosen)
