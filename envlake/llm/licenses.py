"""Licence notices by the Dice coefficient over word bigrams, in DataFrame operations only.

Texts are looked at line by line and, as notices may be wrapped, paragraph by paragraph
(lines between empty ones; a paragraph of one line is not looked at twice). A unit and a
template are lower-cased, every run of characters other than a to z, 0 to 9 and the full
stop inside a number becomes a space, and their sets of word bigrams A and B are compared:
2 |A and B| / (|A| + |B|). A coefficient of t needs |A| between |B| t/(2-t) and
|B| (2-t)/t, so most units meet no template at all. It also needs one of a few telling
words, so that most texts are not taken apart.

The result has a row per unit that reaches ``min_dice`` for a template: the best one, ties
to the template first in binary order. Null texts count as empty; units of fewer than two
words have no bigrams and match nothing. Repeated rows give the same unit, which is
returned once. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from envlake.llm.tables import read_table

MIN_DICE = 0.8

# Common notices of licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright to this work to the public domain.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _words(text: Column) -> Column:
    """Words of the normalised text."""
    plain = F.regexp_replace(F.lower(text), r"[^a-z0-9.]+|\.(?![0-9])", " ")
    return F.split(F.trim(F.regexp_replace(plain, " +", " ")), " ")


def _bigrams(words: Column) -> Column:
    """Set of the word bigrams."""
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def telling_words(templates: dict[str, str], min_dice: float) -> list[str]:
    """Words of which a text that matches any template holds one at least.

    A match shares t/(2-t) of a template's bigrams, so it lacks no more than the rest.
    Words that together touch more bigrams than that cannot all be missing; the longest
    are taken, as they are rarest elsewhere.
    """
    chosen = set()
    for notice in templates.values():
        words = re.sub(r"[^a-z0-9.]+|\.(?![0-9])", " ", notice.lower()).split()
        bigrams = set(zip(words, words[1:], strict=False))
        may_lack = len(bigrams) * (2 - 2 * min_dice) / (2 - min_dice) + 1e-6
        own: set[str] = set()
        for word in sorted(set(words), key=lambda w: (w not in chosen, -len(w), w)):
            if sum(not own.isdisjoint(pair) for pair in bigrams) > may_lack:
                break
            own.add(word)
        chosen |= own
    return sorted(chosen)


def units(documents: DataFrame) -> DataFrame:
    """(doc_id, kind, unit, unit_text): lines, and paragraphs of several lines."""
    text = F.coalesce("text", F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(F.lit("line").alias("kind"), i.cast("int").alias("unit"), x.alias("unit_text")))
    paragraphs = F.transform(
        F.split(text, r"\n[\x20\t\r]*\n"),
        lambda x, i: F.struct(F.lit("paragraph").alias("kind"), i.cast("int").alias("unit"), x.alias("unit_text")),
    )
    several = F.filter(paragraphs, lambda x: F.instr(x["unit_text"], "\n") > 0)
    return documents.select("doc_id", F.explode(F.concat(lines, several)).alias("u")).select("doc_id", "u.kind", "u.unit", "u.unit_text")


def template_bigrams(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, template_size, bigram): a row per bigram of a template."""
    rows = spark.createDataFrame(list(templates.items()), "license string, notice string")
    sets = rows.select("license", _bigrams(_words(F.col("notice"))).alias("set"))
    return sets.select("license", F.size("set").alias("template_size"), F.explode("set").alias("bigram"))


def scan(documents: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """Units of documents that match a template: doc_id, kind, unit, license, dice."""
    templates = TEMPLATES if templates is None else templates
    low, high = min_dice / (2 - min_dice), (2 - min_dice) / min_dice
    # The templates are a fixed list of the caller, of some hundred bigrams.
    table = F.broadcast(template_bigrams(documents.sparkSession, templates))
    longest = max((len(re.findall("[a-z0-9]+", notice.lower())) for notice in templates.values()), default=0)
    text = F.lower(F.coalesce("text", F.lit("")))
    telling = functools.reduce(lambda a, b: a | b, (F.contains(text, F.lit(word)) for word in telling_words(templates, min_dice)), F.lit(False))
    found = units(documents.filter(telling)).withColumn("words", _words(F.col("unit_text")))
    # No template has more bigrams than words.
    sets = found.select("doc_id", "kind", "unit", F.xxhash64("unit_text").alias("unit_hash"), _bigrams(F.col("words")).alias("set"))
    sized = sets.withColumn("size", F.size("set")).filter(F.col("size").between(1, int(longest * high) + 1))
    shared = (
        sized.select("doc_id", "kind", "unit", "unit_hash", "size", F.explode("set").alias("bigram"))
        .join(table, "bigram")
        .filter((F.col("size") >= F.col("template_size") * low - 1e-9) & (F.col("size") <= F.col("template_size") * high + 1e-9))
    )
    # Copies of a row share each bigram again; a bigram counts once per unit.
    counted = shared.groupBy("doc_id", "kind", "unit", "unit_hash", "size", "license", "template_size").agg(
        F.size(F.collect_set("bigram")).alias("common")
    )
    dice = F.round(2 * F.col("common") / (F.col("size") + F.col("template_size")), 9)
    reached = counted.withColumn("dice", dice).filter(F.col("dice") >= min_dice)
    best = F.min(F.struct((-F.col("dice")).alias("against"), F.col("license").alias("license")))
    return reached.groupBy("doc_id", "kind", "unit", "unit_hash").agg(best.alias("best")).select(
        "doc_id", "kind", "unit", "best.license", (-F.col("best.against")).alias("dice")
    )


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in all documents."""
    return scan(read_table(spark, folder, "documents"))


def _sql() -> str:
    words = r"string_split(trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9.]+|\.([^0-9]|$)', ' ', 'g'), ' +', ' ', 'g')), ' ')"
    pairs = "list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))"
    values = ", ".join(f"('{name}', '{notice}')" for name, notice in TEMPLATES.items())
    return rf"""
WITH lines AS (
  SELECT doc_id, 'line' AS kind, unnest(range(0, len(l)))::INT AS unit, unnest(l) AS unit_text
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
paragraphs AS (
  SELECT doc_id, 'paragraph' AS kind, unnest(range(0, len(l)))::INT AS unit, unnest(l) AS unit_text
  FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '\n[\x20\t\r]*\n') AS l FROM documents)),
units AS (
  SELECT DISTINCT * FROM (SELECT * FROM lines UNION ALL SELECT * FROM paragraphs WHERE contains(unit_text, chr(10)))),
sets AS (SELECT doc_id, kind, unit, {pairs} AS s FROM (SELECT *, {words.format('unit_text')} AS words FROM units)),
templates AS (
  SELECT license, {pairs} AS s FROM (SELECT license, {words.format('notice')} AS words FROM (VALUES {values}) t(license, notice))),
scored AS (
  SELECT doc_id, kind, unit, license, round(2.0 * len(list_intersect(u.s, t.s)) / (len(u.s) + len(t.s)), 9) AS dice
  FROM sets u JOIN templates t ON len(u.s) BETWEEN 1 AND 3 * len(t.s))
SELECT doc_id, kind, unit, arg_min(license, (-dice, license)) AS license, max(dice) AS dice
FROM scored WHERE dice >= {MIN_DICE} GROUP BY doc_id, kind, unit
"""


OP5_SQL = _sql()
