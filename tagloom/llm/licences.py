"""Licence scans: Dice coefficient over word bigrams against templates."""

from __future__ import annotations

import re
from collections.abc import Mapping
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short forms of public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.translate(str.maketrans(ascii_uppercase, ascii_lowercase))).split()


def _pairs(words: list[str]) -> list[str]:
    return sorted(set(map(" ".join, zip(words, words[1:])))) if len(words) > 1 else words


def anchors(templates: Mapping[str, str], percent: int) -> list[str]:
    """Bigrams of which every text that reaches ``percent`` % for some template holds at least one.

    Such a text shares at least percent / (200 - percent) of the template's m bigrams, s of them; so it
    holds one of any m - s + 1.  The longest are taken, as they are the rarest.
    """
    chosen = set()
    for text in templates.values():
        pairs = _pairs(_words(text))
        shared = -(-percent * len(pairs) // (200 - percent))
        chosen.update(sorted(pairs, key=lambda pair: (-len(pair), pair))[: len(pairs) - shared + 1])
    return sorted(chosen)


def _pattern(pairs: list[str]) -> str:
    """One pattern for all bigrams in a text as it stands, branching by first letter."""
    rests: dict[str, list[str]] = {}
    for pair in pairs:
        rests.setdefault(pair[0], []).append(pair[1:].replace(" ", "[^a-zA-Z0-9]+"))
    return "(?:" + "|".join(f"[{first}{first.upper()}](?i:{'|'.join(rest)})" for first, rest in sorted(rests.items())) + ")"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, ascii_uppercase, ascii_lowercase), "[^a-z0-9]+", " "))


def _bigrams(normal: Column) -> Column:
    words = F.split(normal, " ")
    pairs = F.array_compact(F.zip_with(words, F.slice(words, 2, F.size(words)), lambda one, two: F.concat(one, F.lit(" "), two)))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def licences(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, licence, dice, n_units``: the licences found in each document, by template.

    Units are the lines, the paragraphs (parts between empty lines) and the whole of a text, each
    different one once.  A unit is normalised to words of letters A-Z, lowered, and digits; its Dice
    coefficient with a template is twice the shared word bigrams over the sum of both numbers.  Only
    templates whose size allows ``percent`` % are compared.  ``dice`` is the best unit's value.

    Null and empty texts, and units without words, match nothing; a single word stands for its own
    bigram.  Rows that repeat an id count as one document, rows without an id as one with a null id.
    """
    pattern = F.lit(_pattern(anchors(templates, percent)))
    text = F.col(text_column).cast("string")
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n\n"), F.array(text)))
    found = docs.where(F.regexp_like(text, pattern)).select(F.col(id_column).alias("doc_id"), F.explode(units).alias("unit"))
    found = found.where(F.regexp_like("unit", pattern)).select("doc_id", _normal(F.col("unit")).alias("normal"))
    sized = found.select("doc_id", _bigrams(F.col("normal")).alias("bigrams")).withColumn("n", F.size("bigrams"))
    known = F.array(*[
        F.struct(F.lit(name).alias("licence"), F.array(*[F.lit(p) for p in _pairs(_words(body))]).alias("pairs"), F.lit(len(_pairs(_words(body)))).alias("m"))
        for name, body in templates.items()
    ])
    # 2 min(n, m) / (n + m) is the most that sizes n and m allow
    able = F.filter(known, lambda t: 200 * F.least(F.col("n"), t["m"]) >= percent * (F.col("n") + t["m"]))
    pairs = sized.select("doc_id", "bigrams", "n", F.explode(able).alias("t"))
    shared = F.size(F.array_intersect("bigrams", "t.pairs"))
    scored = pairs.select("doc_id", F.col("t.licence").alias("licence"), shared.alias("shared"), (F.col("n") + F.col("t.m")).alias("both"))
    matching = scored.where(200 * F.col("shared") >= percent * F.col("both"))
    return matching.groupBy("doc_id", "licence").agg(F.max(2.0 * F.col("shared") / F.col("both")).alias("dice"), F.count(F.lit(1)).alias("n_units"))
