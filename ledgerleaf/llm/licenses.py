"""License scans: lines, paragraphs and whole texts compared with license templates by Dice over word bigrams.

Text and templates are lower-cased and everything but letters and digits becomes one space. The Dice coefficient counts
bigrams with repeats, so a unit of n bigrams reaches the threshold t with a template of m only if
``m * t / (2 - t) <= n <= m * (2 - t) / t``. n is the number of words less one, which costs no look at the bigrams:
a join on the size finds the templates that remain, and bigrams are formed for those units only. All of it is column
expressions over the rows where they lie; the templates are a constant table that is broadcast, nothing else moves.

Units are the lines of a text, its paragraphs (between blank lines) of several lines, and the whole text if it has
several paragraphs. Each unit that reaches the threshold gives a row with its best template, the first name in a tie.

A notice that does not fill its unit is found by windows over the words of the whole text, whatever lines it runs
through: kind ``window``, with the number of the window's first word as ``unit_no``. Windows start and end with bigrams of
their template and have the sizes that can reach the threshold; those that do are taken best first, and no two that are
taken overlap. What units have found is not told twice: windows inside a unit found, or of its license and overlapping
it, are left out.

A template needs two thirds of its bigrams (at 0.8), so some bigrams of it cannot all be missing. Texts without any such
bigram hold no unit and no window that matches and are left after one look, by one pattern of all those bigrams. Of the
others, units are compared as above; for windows words are paired and joined with the templates' bigrams, and all that
follows works on those hits, not on texts.

Defined cases. A null text counts as empty and matches nothing; units without a bigram match nothing. Texts of any
length are scanned whole. Repeated rows give repeated results; null ids are carried along. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of
from ledgerleaf.session import materialise

THRESHOLD = 0.8

#: Notices and openings of public licenses.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def compiled(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> list[dict]:
    """Templates with their bigrams and the sizes that can reach the threshold, by name."""
    out = []
    for name, text in sorted(templates.items()):
        words = words_of(text)
        grams = [" ".join(p) for p in zip(words, words[1:])]
        low, high = math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9), math.floor(len(grams) * (2 - threshold) / threshold + 1e-9)
        out.append({"name": name, "grams": grams, "size": len(grams), "low": low, "high": high})
    return out


def _units(text: Column) -> Column:
    """(kind, unit_no, text) of a normalised text that still has its line ends."""
    lines, paragraphs = F.split(text, "\n"), F.split(text, "\n *\n")
    unit = lambda kind: lambda x, i: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("unit_no"), x.alias("text"))
    several = F.filter(F.transform(paragraphs, unit("paragraph")), lambda u: F.contains(F.trim(u.text, F.lit(" \n")), F.lit("\n")))
    whole = F.when(F.size(paragraphs) > 1, F.array(unit("text")(text, F.lit(0)))).otherwise(F.array())
    return F.concat(F.transform(lines, unit("line")), several, whole)


def _by_size(spark: SparkSession, templates: dict[str, str], threshold: float) -> DataFrame:
    """The templates that a unit of each size may match: a row for each size up to the bound of the longest template."""
    quote = lambda s: "'" + s.replace("'", "\\'") + "'"
    rows = [
        f"({size}, {quote(t['name'])}, array({', '.join(map(quote, t['grams']))}), {t['size']})"
        for t in compiled(templates, threshold)
        for size in range(t["low"], t["high"] + 1)
    ]
    flat = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(size, name, grams, own)")
    return flat.groupBy("size").agg(F.collect_list(F.struct("name", "grams", "own")).alias("near"))


def _scan_units(normal: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """The units of (doc_id, text) that a template matches."""
    known = materialise(_by_size(normal.sparkSession, templates, threshold), "templates")
    units = normal.select("doc_id", F.explode(_units(F.col("text"))).alias("u")).select("doc_id", "u.kind", "u.unit_no", "u.text")
    words = F.split(F.trim(F.regexp_replace("text", "[ \n]+", " ")), " ")
    sized = units.select("doc_id", "kind", "unit_no", words.alias("words")).withColumn("size", F.size("words") - 1)
    near = sized.join(F.broadcast(known), "size")  # a constant
    pair = F.zip_with(F.slice("words", 1, F.col("size")), F.slice("words", 2, F.col("size")), lambda a, b: F.concat_ws(" ", a, b))
    grams = near.select("doc_id", "kind", "unit_no", "size", "near", pair.alias("grams"))
    times = lambda gram, held: F.size(F.filter(held, lambda g: g == gram))
    shared = lambda t: F.aggregate(
        F.array_intersect("grams", t.grams), F.lit(0), lambda n, g: n + F.least(times(g, F.col("grams")), times(g, t.grams))
    )
    dice = lambda t: shared(t) * F.lit(2.0) / (F.col("size") + t.own)
    found = grams.select("doc_id", "kind", "unit_no", F.transform("near", lambda t: F.struct((-dice(t)).alias("minus"), t["name"].alias("license"))).alias("found"))
    best = found.select("doc_id", "kind", "unit_no", F.array_min("found").alias("best"))
    return best.select("doc_id", "kind", "unit_no", "best.license", (-F.col("best.minus")).alias("dice")).filter(F.col("dice") >= threshold)


def needed(words: list[str], threshold: float) -> tuple[int, list[str]]:
    """How many bigrams a window must share with a template, and words of which it cannot lack all, long ones first."""
    size = len(words) - 1
    low = math.ceil(size * threshold / (2 - threshold) - 1e-9)
    least = max(1, math.ceil(threshold * (low + size) / 2 - 1e-9))
    lost, anchors = set(), []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if size - len(lost) < least:
            break
        anchors.append(word)
        lost |= {k for at, w in enumerate(words) if w == word for k in (at - 1, at) if 0 <= k < size}
    return least, anchors


def telling(grams: list[str], least: int) -> list[str]:
    """Bigrams of which a window that shares ``least`` with the template cannot lack all: as many as it may lack and one, long ones first."""
    ordered = sorted(grams, key=lambda g: (-len(g), g))
    return sorted(set(ordered[: len(grams) - least + 1]))


def _by_gram(spark: SparkSession, templates: dict[str, str], threshold: float) -> tuple[DataFrame, list[str]] | None:
    """(gram, license, times, own, low, high, least): which templates hold a bigram, and how often; and the bigrams to look for."""
    quote = lambda s: "'" + s.replace("'", "\\'") + "'"
    rows, anchors = [], set()
    for t in compiled(templates, threshold):
        if t["grams"]:
            least, _ = needed(words_of(templates[t["name"]]), threshold)
            anchors |= set(telling(t["grams"], least))
            for gram, times in Counter(t["grams"]).items():
                rows.append(f"({quote(gram)}, {quote(t['name'])}, {times}, {t['size']}, {max(t['low'], 1)}, {t['high']}, {least})")
    if not rows:
        return None
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(gram, license, times, own, low, high, least)"), sorted(anchors)


def _hits(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(row_no, license, own, low, high, least, hits): where a text has bigrams of a template, in order.

    A hit has its place, the lines and paragraphs of its two words, and ``before``: the place of the same bigram as many
    occurrences earlier as the template has it, -1 if there is none. Within a window it counts if that lies before the window.
    """
    split = lambda text: F.filter(F.split(text, "[ \n]+"), lambda w: w != "")
    numbers = lambda units: F.flatten(F.transform(units, lambda u, i: F.transform(split(u), lambda w: i)))
    words = asked.select("row_no", split(F.col("text")).alias("words"), numbers(F.split("text", "\n")).alias("line"), numbers(F.split("text", "\n *\n")).alias("paragraph"))
    zipped = F.zip_with("words", F.zip_with("line", "paragraph", lambda a, b: F.struct(a.alias("line"), b.alias("paragraph"))), lambda w, at: F.struct(w.alias("word"), at.line.alias("line"), at.paragraph.alias("paragraph")))
    size = F.size("zipped") - 1
    pairs = F.zip_with(F.slice("zipped", F.lit(1), size), F.slice("zipped", F.lit(2), size), lambda a, b: F.struct(
        F.concat_ws(" ", a.word, b.word).alias("gram"), a.line.alias("line_a"), b.line.alias("line_z"), a.paragraph.alias("paragraph_a"), b.paragraph.alias("paragraph_z")
    ))
    each = words.select("row_no", zipped.alias("zipped")).filter(F.size("zipped") > 1).select("row_no", F.posexplode(pairs).alias("place", "pair"))
    found = each.select("row_no", "place", "pair.*").join(F.broadcast(known), "gram")  # a constant
    at = F.struct("place", "line_a", "line_z", "paragraph_a", "paragraph_z")
    own = ["own", "low", "high", "least"]
    same = found.groupBy("row_no", "license", "gram", "times", *own).agg(F.sort_array(F.collect_list(at)).alias("same"))  # places in one text
    earlier = lambda i: F.coalesce(F.get(F.col("same"), i - F.col("times"))["place"], F.lit(-1))
    marked = F.transform("same", lambda h, i: F.struct(
        h.place.alias("place"), earlier(i).alias("before"),
        h.line_a.alias("line_a"), h.line_z.alias("line_z"), h.paragraph_a.alias("paragraph_a"), h.paragraph_z.alias("paragraph_z"),
    ))
    listed = same.select("row_no", "license", *own, marked.alias("marked")).groupBy("row_no", "license", *own)
    return listed.agg(F.sort_array(F.flatten(F.collect_list("marked"))).alias("hits")).filter(F.size("hits") >= F.col("least"))


def _candidates(hits: DataFrame, threshold: float) -> DataFrame:
    """The best window from each hit on that reaches the threshold, the shorter one in a tie: its hits alone decide."""
    # a window that begins with a hit has the least number of hits in reach, or no chance
    reach = lambda h, i: F.coalesce(F.get(F.col("hits"), i + F.col("least") - 1)["place"] - h.place < F.col("high"), F.lit(False))
    from_each = F.filter(F.transform("hits", lambda h, i: F.when(reach(h, i), i)), lambda i: i.isNotNull())
    starts = hits.withColumn("i", F.explode(from_each)).withColumn("first", F.get("hits", F.col("i")))
    part = starts.withColumn("part", F.slice("hits", F.col("i") + 1, F.col("high"))).withColumn("start", F.col("first.place"))
    number = F.lit(0)
    none = F.struct(number.alias("shared"), F.lit(0.0).alias("minus"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("int").alias("line_z"), F.lit(None).cast("int").alias("paragraph_z"))

    def longer(best: Column, h: Column) -> Column:
        size = h.place - F.col("start") + 1
        shared = best.shared + F.when(h.before < F.col("start"), 1).otherwise(0)
        minus = -(shared * F.lit(2.0) / (size + F.col("own")))
        better = (size >= F.col("low")) & (minus < best.minus)
        grown = F.struct(
            shared.alias("shared"), F.when(better, minus).otherwise(best.minus).alias("minus"), F.when(better, h.place).otherwise(best.end).alias("end"),
            F.when(better, h.line_z).otherwise(best.line_z).alias("line_z"), F.when(better, h.paragraph_z).otherwise(best.paragraph_z).alias("paragraph_z"),
        )
        return F.when(size <= F.col("high"), grown).otherwise(best)

    best = part.withColumn("best", F.aggregate("part", none, longer)).filter(F.col("best.end").isNotNull() & (-F.col("best.minus") >= threshold))
    return best.select(
        "row_no", "license", "start", (F.col("best.end") + 1).alias("last"), "best.minus", "first.line_a", "best.line_z", "first.paragraph_a", "best.paragraph_z"
    )


def _windows(asked: DataFrame, known: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The windows of (row_no, text) that a template matches and no unit has told of."""
    found = materialise(_candidates(_hits(asked, known), threshold), "windows")
    # units of one text
    told = units.groupBy("row_no").agg(F.collect_list(F.struct("kind", F.col("unit_no").cast("int").alias("unit_no"), "license")).alias("told"))
    inside = lambda u, c: (u.kind == c) & (u.unit_no >= F.col(f"{c}_a")) & (u.unit_no <= F.col(f"{c}_z"))
    alone = lambda c: F.col(f"{c}_a") == F.col(f"{c}_z")
    covers = lambda u, c: inside(u, c) & (alone(c) | (u.license == F.col("license")))
    known_by = F.exists("told", lambda u: (u.kind == "text") | covers(u, "line") | covers(u, "paragraph"))
    new = found.join(told, "row_no", "left").filter(~F.coalesce(known_by, F.lit(False)))
    ordered = F.sort_array(F.collect_list(F.struct("minus", "start", "license", "last")))
    apart = lambda kept, w: ~F.exists(kept, lambda k: (k.start <= w.last) & (w.start <= k.last))
    listed_all = new.groupBy("row_no").agg(ordered.alias("all"))  # windows of one text
    nothing = F.filter("all", lambda w: F.lit(False))
    taken = F.aggregate("all", nothing, lambda kept, w: F.when(apart(kept, w), F.concat(kept, F.array(w))).otherwise(kept))
    return listed_all.select("row_no", F.explode(taken).alias("w")).select(
        "row_no", F.lit("window").alias("kind"), F.col("w.start").cast("long").alias("unit_no"), "w.license", (-F.col("w.minus")).alias("dice")
    )


def _normal(text: Column) -> Column:
    """Lower case, with line ends, and one space for everything else that is no letter and no digit."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def _possible(anchors: list[str]) -> str:
    """A pattern for lower-case texts that hold one of the bigrams, branched by first letter."""
    other = r"[^\p{L}\p{N}]"
    branches = [f"{letter}(?:{'|'.join(g[1:].replace(' ', f'{other}+') for g in grams)})" for letter, grams in groupby(sorted(anchors), key=lambda g: g[0])]
    return f"(?:^|{other})(?:{'|'.join(branches)})(?![\\p{{L}}\\p{{N}}])"


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, kind, unit_no, license and dice of every unit, and of every window elsewhere, that a template matches."""
    rows = documents.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    table = _by_gram(documents.sparkSession, templates, threshold)
    if table is None:
        return rows.select("doc_id", F.lit("").alias("kind"), F.lit(0).cast("long").alias("unit_no"), F.lit("").alias("license"), F.lit(0.0).alias("dice")).filter("false")
    known, anchors = materialise(table[0], "template-grams"), table[1]
    # a unit or window that matches has one of these bigrams: other texts are left after this one look
    possible = rows.filter(F.rlike(F.lower("text"), F.lit(_possible(anchors))))
    asked = materialise(possible.select("doc_id", _normal(F.col("text")).alias("text")).withColumn("row_no", F.monotonically_increasing_id()), "license-texts")
    units = _scan_units(asked.select(F.col("row_no").alias("doc_id"), "text"), templates, threshold).withColumnRenamed("doc_id", "row_no")
    units = materialise(units, "license-units")
    found = units.unionByName(_windows(asked, known, units, threshold))
    return asked.select("row_no", "doc_id").join(found, "row_no").drop("row_no")


def duckdb_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The scan of units in SQL; windows are beyond it."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(t['name'])}, [{', '.join(map(quote, t['grams']))}], {t['size']}, {t['low']}, {t['high']})" for t in compiled(templates, threshold))
    return rf"""
WITH k(license, tgrams, tsize, low, high) AS (VALUES {rows}),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM documents),
s AS (SELECT *, string_split(t, chr(10)) AS lines, string_split_regex(t, '\n *\n') AS paragraphs FROM d),
u AS (
  SELECT doc_id, r, 'line' AS kind, unnest(range(len(lines))) AS unit_no, unnest(lines) AS t FROM s
  UNION ALL SELECT * FROM (SELECT doc_id, r, 'paragraph' AS kind, unnest(range(len(paragraphs))) AS unit_no, unnest(paragraphs) AS t FROM s)
    WHERE contains(trim(t, ' ' || chr(10)), chr(10))
  UNION ALL SELECT doc_id, r, 'text', 0, t FROM s WHERE len(paragraphs) > 1
),
n AS (SELECT doc_id, r, kind, unit_no, string_split(trim(regexp_replace(t, '[ \n]+', ' ', 'g')), ' ') AS w FROM u),
c AS (SELECT n.*, len(w) - 1 AS size, k.* FROM n JOIN k ON len(w) - 1 BETWEEN k.low AND k.high WHERE len(w) > 1),
g AS (SELECT *, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS grams FROM c),
x AS (
  SELECT doc_id, r, kind, unit_no, license, coalesce(list_sum(list_transform(list_intersect(grams, tgrams), lambda b:
    least(len(list_filter(grams, lambda y: y = b)), len(list_filter(tgrams, lambda y: y = b))))), 0) * 2.0 / (size + tsize) AS dice FROM g
),
b AS (SELECT *, row_number() OVER (PARTITION BY r, kind, unit_no ORDER BY dice DESC, license) AS place FROM x)
SELECT doc_id, kind, CAST(unit_no AS BIGINT) AS unit_no, license, CAST(dice AS DOUBLE) AS dice FROM b WHERE place = 1 AND dice >= {threshold}
"""
