"""8. License scans: Dice coefficient over word bigrams against templates.

A text is cut into segments (lines, and sentences within them), a segment and
a template are normalised alike (``A-Z`` lower-cased, anything but letters a to
z and digits a space), and compared as sets of word bigrams: a segment of
``threshold`` or more is that licence's. For segment size ``a`` and template
size ``b`` the coefficient is at most ``2 min(a, b) / (a + b)``, so a segment
meets only the templates with ``t / (2 - t) <= a / b <= (2 - t) / t``.

Before that, texts and segments that can't match are passed over by words: of
each template enough words are taken that its bigrams without any of them are
too few for a match, so a segment without all of these words has none. The
templates are a short fixed list, written into the plan; only DataFrame
functions run, without a shuffle.

``license_places`` looks for the same notices, for the ``HEADERS`` of files and
for whole licences (``license_texts/``) in the words of a whole text, across
line breaks and comment marks. A match shares at least ``t / (2 - t)`` of a
template's bigrams, so a text without so many meets no template, and a window
starts only where so many of them follow within a window's length; windows are
of a template's words, a fifth less and a quarter more, and the whole text is
compared too. Of overlapping places the best stays, whole licences and headers
before notices.

Cases: null and empty texts have no segment; a template or segment of one word
is its own bigram; among templates of equal coefficient the first by name is
reported; a licence repeated in a text is a row for each place; repeated rows
and null ids give their own rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from math import ceil
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.operators.common import computed_once

THRESHOLD = 0.8
#: Notices by which public licences are applied, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("BSD-2-Clause", "This software is released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "This software is released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Headers of files, which are wrapped there.
_FREE = "is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version. This {4} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} General Public License for more details."
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "This program " + _FREE.format(";", "", ";", "2", "program")),
    ("GPL-3.0", "This program " + _FREE.format(":", "", ",", "3", "program")),
    ("LGPL-2.1", "This library " + _FREE.format(";", "Lesser", ";", "2.1", "library")),
    ("LGPL-3.0", "This library " + _FREE.format(":", "Lesser", ",", "3", "library")),
    ("AGPL-3.0", "This program " + _FREE.format(":", "Affero", ",", "3", "program")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
#: Words of a template over which windows start where a run of shared bigrams does, not at each of them.
LONG = 400
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER))) if w]


def bigrams_of(words: list[str]) -> list[str]:
    return list(dict.fromkeys(" ".join(p) for p in zip(words, words[1:], strict=False))) or words[:1]


def gate_words(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which every segment that matches has one: a match shares at
    least ``t / (2 - t)`` of a template's bigrams, and the bigrams of the
    template without these words are fewer."""
    chosen: list[str] = []
    for _, text in templates:
        words = words_of(text)
        left = [b for b in bigrams_of(words) if not set(b.split()) & set(chosen)]
        need = threshold / (2 - threshold) * len(bigrams_of(words))
        order = sorted(dict.fromkeys(words), key=lambda w: (-len(w), w))
        for w in order:
            if len(left) < need:
                break
            if any(w in b.split() for b in left):
                chosen.append(w)
                left = [b for b in left if w not in b.split()]
    return sorted(set(chosen))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each segment that matches: ``id_col, segment`` (number of the
    segment in its text, from 0), ``license, dice``."""
    templates = TEMPLATES if templates is None else templates
    gate = rf"(^|[^a-z0-9])({'|'.join(gate_words(templates, threshold))})([^a-z0-9]|$)"
    low = F.translate(F.col(text_col), UPPER, LOWER)
    some = docs.where(low.rlike(gate)).select(F.col(id_col), F.split(F.regexp_replace(text_col, r"([.!?;])[\x20\x09-\x0D]+", "$1\n"), "\n").alias("parts"))
    each = some.select(id_col, F.posexplode("parts").alias("segment", "part")).select(id_col, "segment", _normal(F.col("part")).alias("part")).where(F.col("part").rlike(gate))
    words = each.withColumn("w", F.split("part", " "))
    pairs = F.when(F.size("w") > 1, F.array_distinct(F.transform(F.slice("w", 1, F.size("w") - 1), lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1))))).otherwise(F.col("w"))
    # Each step's arrays are computed once, not again in every use of the next one.
    sets = computed_once(computed_once(words).select(id_col, "segment", pairs.alias("b"))).withColumn("a", F.size("b"))
    # Templates by size; a segment sees those that its own size leaves.
    table = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(len(bigrams_of(words_of(t)))).alias("n"), F.array(*[F.lit(b) for b in bigrams_of(words_of(t))]).alias("b")) for name, t in templates])
    low_ratio = threshold / (2 - threshold)
    near = F.filter(table, lambda t: (F.col("a") >= t["n"] * low_ratio - 1e-9) & (F.col("a") <= t["n"] / low_ratio + 1e-9))
    scored = F.transform(near, lambda t: F.struct((F.lit(2.0) * F.size(F.array_intersect(F.col("b"), t["b"])) / (F.col("a") + t["n"])).alias("dice"), t["license"].alias("license")))
    # The highest coefficient, then the first name.
    best = computed_once(sets.select(id_col, "segment", scored.alias("s"))).withColumn("dice", F.array_max(F.transform("s", lambda x: x["dice"]))).where(F.col("dice") >= threshold)
    name = F.array_min(F.transform(F.filter("s", lambda x: x["dice"] == F.col("dice")), lambda x: x["license"]))
    return best.select(id_col, "segment", name.alias("license"), F.round("dice", 6).alias("dice"))


@lru_cache(1)
def bodies() -> list[tuple[str, str]]:
    """Whole licences, by SPDX identifier."""
    return [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.split(F.lit("|".join(values)), r"\|")


def _bigrams(words: Column) -> Column:
    """The bigram at each word but the last."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(words, i + 1)))


def _dice(bigrams: Column, t: Column) -> Column:
    return _let(F.array_distinct(bigrams), lambda b: F.lit(2.0) * F.size(F.array_intersect(b, t["b"])) / (F.size(b) + t["n"]))


def _windows(g: Column, t: Column, threshold: float) -> Column:
    """``(dice, start, stop)``, in words, of the places of template ``t`` in the
    bigrams ``g`` of a text: of windows that start within half its length, the best."""

    def scored(at: Column) -> Column:
        # Of equal coefficients the shorter window.
        each = F.transform(t["lengths"], lambda k: F.struct(_dice(F.slice(g, at + 1, k - 1), t).alias("dice"), (-k).alias("short")))
        return _let(F.array_max(each), lambda x: F.struct(x["dice"].alias("dice"), at.alias("start"), F.least(at - x["short"], F.size(g) + 1).alias("stop")))

    def best(c: Column) -> Column:
        beside = lambda x, k: F.slice(c, F.greatest(k - t["words"] + 1, F.lit(1)), t["words"] * 2)
        over = lambda x, y: (F.abs(x["start"] - y["start"]) * 2 < t["words"]) & ((y["dice"] > x["dice"]) | ((y["dice"] == x["dice"]) & (y["start"] < x["start"])))
        return F.filter(c, lambda x, k: ~F.exists(beside(x, k), lambda y: over(x, y)))

    hits = F.filter(F.transform(g, lambda x, i: F.when(F.array_contains(t["b"], x), i)), lambda i: i.isNotNull())
    dense = lambda h: F.filter(h, lambda i, k: (F.get(h, k + t["need"] - 1) - i <= F.array_max(t["lengths"]) - 2) & ((t["words"] <= LONG) | (k == 0) | (F.get(h, F.greatest(k - 1, F.lit(0))) < i - 1)))
    found = _let(hits, lambda h: _let(dense(h), lambda s: _let(F.filter(F.transform(s, scored), lambda x: x["dice"] >= threshold), best)))
    whole = F.array(F.struct(_dice(g, t).alias("dice"), F.lit(0).alias("start"), (F.size(g) + 1).alias("stop")))
    # A whole text of up to twice the template's words may hold more than any window.
    return _let(found, lambda f: F.when((F.size(f) == 0) & (F.size(g) <= t["words"] * 2), F.filter(whole, lambda x: x["dice"] >= threshold)).otherwise(f))


def license_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each place of a notice, header or whole licence in a text's
    words that no segment with that licence of its own lies in: ``id_col,
    segment`` (the one it starts in), ``license, dice``."""
    low = threshold / (2 - threshold)
    kinds = [(name, text, False) for name, text in TEMPLATES] + [(name, text, True) for name, text in [*HEADERS, *bodies()]]
    sets = [(name, words_of(text), bigrams_of(words_of(text)), whole) for name, text, whole in kinds]
    table = F.array(*[
        F.struct(
            F.lit(name).alias("license"), F.lit(whole).alias("whole"), F.lit(len(w)).alias("words"), F.lit(len(b)).alias("n"), F.lit(ceil(low * len(b) - 1e-9)).alias("need"),
            F.array(*[F.lit(k) for k in (len(w), len(w) * 4 // 5, len(w) * 5 // 4)]).alias("lengths"), _strings(b).alias("b"),
        )
        for name, w, b, whole in sets
    ])
    short, long = ([x for x in sets if (len(x[1]) > LONG) == y] for y in (False, True))
    every = [list(dict.fromkeys(b for x in part for b in x[2])) for part in (short, long)]
    least = ceil(low * min(len(x[2]) for x in long) - 1e-9)
    gate = _strings(gate_words([(name, text) for name, text, _ in kinds], threshold))

    cut = F.split(F.regexp_replace(text_col, r"([.!?;])[\x20\x09-\x0D]+", "$1\n"), "\n")
    # Comment marks are no letters, but for two.
    parts = F.transform(cut, lambda p: F.filter(F.split(_normal(F.regexp_replace(p, r"^[\x20\x09-\x0D]*(?i:rem|dnl)[\x20\x09]", "")), " "), lambda w: w != ""))
    some = computed_once(docs.select(F.col(id_col).alias("id"), cut.alias("cut"), parts.alias("parts")))
    some = computed_once(some.withColumn("w", F.flatten("parts")).where(F.arrays_overlap("w", gate)))
    some = computed_once(some.select("id", "cut", "parts", _bigrams(F.col("w")).alias("g")))
    shared = F.concat(F.array_intersect(_strings(every[0]), F.col("g")), F.when(F.size("g") >= least, F.array_intersect(_strings(every[1]), F.col("g"))).otherwise(F.array().cast("array<string>")))
    some = computed_once(some.withColumn("u", shared))
    near = F.filter(table, lambda t: F.when(F.size("u") >= t["need"], F.size(F.array_intersect(t["b"], F.col("u"))) >= t["need"]).otherwise(False))
    some = computed_once(some.select("id", "cut", "parts", "g", near.alias("near"))).where(F.size("near") > 0)
    g = F.col("g")
    each = F.transform("near", lambda t: F.transform(_windows(g, t, threshold), lambda x: F.struct(t["whole"].alias("whole"), x["dice"].alias("dice"), (x["stop"] - x["start"]).alias("size"), t["license"].alias("license"), x["start"].alias("start"), x["stop"].alias("stop"))))
    some = computed_once(some.select("id", "cut", "parts", F.array_distinct(F.flatten(each)).alias("found")))

    # One total order: what overlaps a better place by over half of the smaller one goes.
    def better(y: Column, x: Column) -> Column:
        common = F.least(x["stop"], y["stop"]) - F.greatest(x["start"], y["start"])
        return (common * 2 > F.least(x["size"], y["size"])) & (y > x)

    kept = F.filter("found", lambda x: ~F.exists("found", lambda y: better(y, x)))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("segment"))
    segment = lambda word: F.aggregate("parts", zero, lambda s, p: F.struct((s["at"] + F.size(p)).alias("at"), F.when(s["at"] + F.size(p) <= word, s["segment"] + 1).otherwise(s["segment"]).alias("segment")))["segment"]
    rows = computed_once(some.select("id", "cut", "parts", F.explode(kept).alias("x")))
    rows = computed_once(rows.select("id", "cut", "parts", "x", segment(F.col("x.start")).alias("segment"), segment(F.col("x.stop") - 1).alias("last")))
    notices = F.filter(table, lambda t: ~t["whole"] & (t["license"] == F.col("x.license")))
    alone = F.exists(F.slice("cut", F.col("segment") + 1, F.col("last") - F.col("segment") + 1), lambda p: _let(_let(F.split(_normal(p), " "), lambda w: F.when(F.size(w) > 1, _bigrams(w)).otherwise(w)), lambda b: F.exists(notices, lambda t: _dice(b, t) >= threshold)))
    rows = rows.where(~alone).select("id", "segment", F.col("x.license").alias("license"), F.round("x.dice", 6).alias("dice"))
    return rows.withColumnRenamed("id", id_col)


def scan_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``license_scan`` and of ``license_places``."""
    return license_scan(docs, id_col, text_col, threshold=threshold).unionByName(license_places(docs, id_col, text_col, threshold))


def oracle_sql(templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The scan of ``documents`` in SQL, without the gate and the size bounds."""
    templates = TEMPLATES if templates is None else templates
    sets = [(name, bigrams_of(words_of(t))) for name, t in templates]
    rows = ", ".join(f"('{name}', {len(b)}, [{', '.join(chr(39) + x + chr(39) for x in b)}])" for name, b in sets)
    return f"""
WITH t(license, n, b) AS (VALUES {rows}),
parts AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?;])[\\x20\\x09-\\x0D]+', '\\1' || chr(10), 'g'), chr(10)) AS p FROM documents WHERE text IS NOT NULL
),
seg AS (SELECT doc_id, unnest(p) AS part, unnest(range(len(p))) AS segment FROM parts),
norm AS (
  SELECT doc_id, segment, string_split(trim(regexp_replace(translate(part, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM seg
),
sets AS (
  SELECT doc_id, segment, CASE WHEN len(w) > 1 THEN list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) ELSE w END AS b FROM norm WHERE w <> ['']
),
scored AS (
  SELECT doc_id, segment, license, 2.0 * len(list_intersect(sets.b, t.b)) / (len(sets.b) + t.n) AS dice
  FROM sets JOIN t ON len(sets.b) <= 2 * t.n AND t.n <= 2 * len(sets.b)
),
best AS (
  SELECT doc_id, segment, license, dice, row_number() OVER (PARTITION BY doc_id, segment ORDER BY dice DESC, license) AS k FROM scored WHERE dice >= {threshold}
)
SELECT doc_id, CAST(segment AS INT) AS segment, license, round(CAST(dice AS DOUBLE), 6) AS dice FROM best WHERE k = 1
"""
