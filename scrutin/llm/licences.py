"""Operator 9: licence scan by Dice coefficient over word bigrams.

A text is normalised to its lower-case words, so line breaks, comment marks and
punctuation do not matter.  Templates are held against windows anywhere in the
text.  With n and m bigrams the coefficient is at most 2 min(n, m) / (n + m),
which bounds the size of a window from both sides for each template; a window
must start and end on a bigram of the template, since others only lower it.

Size bounds prune first: a window starts only where as many bigrams of the
template as the least size lie within the largest size.  Each such start gets
the end of the highest coefficient (the first on ties); bigrams count as bags.
Windows below THRESHOLD go, then of overlapping windows of one template all
but the best (the earlier on ties), then windows that overlap a better one of
another template.

All of it is array functions on the document's own row: no shuffle, no join and
no copy of the text.  Work after the bigrams is linear in the bigrams that a
template shares.

DataFrame functions only.  Defined cases: a null text has no passages; passages
that are equal but apart each count; on ties between templates all are named
(one passage if the words are the same); repeated rows are kept and get equal
values; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# FIXED VALUES: licence templates (identifier, text)
TEMPLATES = (
    ("All-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def sized(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[tuple]:
    """(licence, bigrams, distinct bigrams with their counts, least shared bigrams, most bigrams of a window) of every template."""
    out = []
    for name, text in templates:
        w = [x for x in re.split(_SPLIT, text.lower()) if x]
        pairs = [f"{a} {b}" for a, b in zip(w, w[1:])]
        m = len(pairs)
        # the margins keep whole numbers whole; the coefficient itself decides
        least, most = math.ceil(m * threshold / (2 - threshold) - 1e-9), math.floor(m * (2 - threshold) / threshold + 1e-9)
        if m:
            out.append((name, m, Counter(pairs), least, most))
    return out


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _apart(windows: Column, reach: Column | int, beats) -> Column:
    """Windows, ascending by start, that none of the overlapping ones within
    ``reach`` places beats."""
    return F.filter(windows, lambda w, i: ~F.exists(
        F.slice(windows, F.greatest(i - reach, F.lit(0)) + 1, 2 * F.lit(reach) + 1),
        lambda v: (v.start <= w.end) & (v.end >= w.start) & beats(v, w)))


def _windows(hits: Column, t: Column, threshold: float) -> Column:
    """The template's windows in a text, from its (at, bigram) in order."""
    def starts(h: Column) -> Column:
        return F.when(F.size(h) >= t.least, F.filter(
            F.sequence(F.lit(1), F.size(h) - t.least + 1),
            lambda k: F.element_at(h, k + t.least - 1).at - F.element_at(h, k).at < t.most)).otherwise(F.array().cast("array<int>"))

    def with_previous(h: Column) -> Column:
        # a hit counts in windows that start after its bigram's place so many occurrences back
        def previous(x: Column, i: Column) -> Column:
            back = F.filter(F.slice(h, F.greatest(i - t.most, F.lit(0)) + 1, F.least(i, t.most)), lambda y: y.bigram == x.bigram)
            times = F.element_at(t.times, F.array_position(t.bigrams, x.bigram).cast("int"))
            return F.struct(x.at.alias("at"), _let(back, lambda b: F.when(F.size(b) >= times, F.get(b, F.size(b) - times).at).otherwise(F.lit(-1))).alias("previous"))
        return F.transform(h, previous)

    def best(p: Column, k: Column) -> Column:
        first = F.element_at(p, k).at

        def step(s: Column, h: Column) -> Column:
            shared = s.shared + F.when(h.previous < first, 1).otherwise(0)
            dice = 2 * shared / (h.at - first + 1 + t.m)
            better = (h.at - first < t.most) & (dice > s.dice)
            return F.struct(shared.alias("shared"), F.when(better, dice).otherwise(s.dice).alias("dice"), F.when(better, h.at).otherwise(s.end).alias("end"))

        zero = F.struct(F.lit(0).alias("shared"), F.lit(0.0).alias("dice"), F.lit(0).alias("end"))
        return _let(F.aggregate(F.slice(p, k, t.most), zero, step),
                    lambda s: F.struct(first.alias("start"), s.end.alias("end"), s.dice.alias("dice"), t.licence.alias("licence")))

    none = F.array().cast("array<struct<start:int,end:int,dice:double,licence:string>>")
    better = lambda v, w: (v.dice > w.dice) | ((v.dice == w.dice) & (v.start < w.start))
    found = lambda p, ks: F.filter(F.transform(ks, lambda k: best(p, k)), lambda w: w.dice >= threshold)
    own = F.filter(hits, lambda h: F.array_contains(t.bigrams, h.bigram))
    return _let(own, lambda h: _let(starts(h), lambda ks: F.when(F.size(ks) > 0, _let(with_previous(h), lambda p: _let(
        found(p, ks), lambda ws: _apart(ws, t.most, better)))).otherwise(none)))


def found(text: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """array<struct<start, end, dice, licence>> of a text: the windows that no
    overlapping one beats; start and end count its bigrams from 0."""
    known = sized(templates, threshold)
    if not known:
        return F.array().cast("array<struct<start:int,end:int,dice:double,licence:string>>")
    each = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(m).alias("m"), F.lit(least).alias("least"), F.lit(most).alias("most"),
                              F.array(*map(F.lit, bag)).alias("bigrams"), F.array(*map(F.lit, bag.values())).alias("times"))
                     for name, m, bag, least, most in known])
    bigrams = sorted({b for k in known for b in k[2]})
    # windows of one template do not overlap, so no more than these start within reach of another
    reach = len(known) * (2 * max(k[4] for k in known) + 1)
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT), "")
    pairs = _let(words, lambda w: F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)))
    hits = F.filter(F.transform(pairs, lambda b, i: F.when(b.isin(bigrams), F.struct(i.alias("at"), b.alias("bigram")))), lambda h: h.isNotNull())
    every = lambda h: F.array_sort(F.flatten(F.transform(each, lambda t: _windows(h, t, threshold))))
    return _let(hits, lambda h: _let(every(h), lambda ws: _apart(ws, reach, lambda v, w: v.dice > w.dice)))


def scan(documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, first_word, last_word, licence, dice): every passage's best
    templates; words count from 0."""
    w = F.explode(found(F.col("text").cast("string"), templates, threshold))
    return (documents.select("doc_id", w.alias("w"))
            .select("doc_id", F.col("w.start").alias("first_word"), (F.col("w.end") + 1).alias("last_word"), "w.licence", "w.dice"))


def licences(documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licences (comma-joined, sorted; empty for none), n_passages and
    best (the highest coefficient; null for none) of every document."""
    digest = _let(found(F.col("text").cast("string"), templates, threshold), lambda ws: F.struct(
        F.array_join(F.sort_array(F.array_distinct(F.transform(ws, lambda w: w.licence))), ",").alias("licences"),
        F.size(F.array_distinct(F.transform(ws, lambda w: F.struct(w.start, w.end)))).cast("long").alias("n_passages"),
        F.round(F.array_max(F.transform(ws, lambda w: w.dice)), 6).alias("best")))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("found")).select("doc_id", "found.*")


def _sql_rows() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({t}, {quote(name)}, {quote(text)})" for t, (name, text) in enumerate(TEMPLATES))


ORACLE = rf"""
WITH t0 AS (SELECT t, name, list_filter(regexp_split_to_array(lower(x), '{_SPLIT}'), lambda w: w <> '') AS w FROM (VALUES {_sql_rows()}) v(t, name, x)),
t1 AS (SELECT t, name, len(w) - 1 AS m, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM t0),
tb AS (SELECT t, name, m, b, count(*) AS times FROM t1 GROUP BY ALL),
d0 AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{_SPLIT}'), lambda w: w <> '') AS w FROM documents),
d1 AS (SELECT doc_id, unnest(range(1, len(w))) AS pos, unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) AS b FROM d0),
h AS (SELECT doc_id, t, name, m, pos, b, times FROM d1 JOIN tb USING (b)),
-- a window of n bigrams that shares c has 2c >= {THRESHOLD} (n + m) and c <= n
k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, t ORDER BY pos RANGE BETWEEN CURRENT ROW AND 2 * m FOLLOWING) AS near FROM h),
p AS (SELECT s.doc_id, s.t, s.name, s.m, s.pos AS a, e.pos AS z, e.times,
             row_number() OVER (PARTITION BY s.doc_id, s.t, s.pos, e.b ORDER BY e.pos) AS nth
      FROM k s JOIN h e ON e.doc_id = s.doc_id AND e.t = s.t AND e.pos BETWEEN s.pos AND s.pos + 2 * s.m WHERE 2 * s.near >= s.m),
c AS (SELECT doc_id, t, name, m, a, z, sum(CASE WHEN nth <= times THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, t, a ORDER BY z) AS common FROM p),
e AS (SELECT doc_id, t, name, a, z, 2 * common / (z - a + 1 + m) AS dice FROM c
      QUALIFY row_number() OVER (PARTITION BY doc_id, t, a ORDER BY 2 * common / (z - a + 1 + m) DESC, z) = 1),
w AS (SELECT * FROM e WHERE dice >= {THRESHOLD}),
o AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM w v WHERE v.doc_id = w.doc_id AND v.t = w.t AND v.a <= w.z AND v.z >= w.a
                                        AND (v.dice > w.dice OR v.dice = w.dice AND v.a < w.a))),
x AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM o v WHERE v.doc_id = o.doc_id AND v.a <= o.z AND v.z >= o.a AND v.dice > o.dice)),
f AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licences, count(DISTINCT (a, z)) AS n_passages, max(dice) AS best FROM x GROUP BY 1)
SELECT d.doc_id, coalesce(licences, '') AS licences, CAST(coalesce(n_passages, 0) AS BIGINT) AS n_passages, round(best, 6) AS best
FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id
"""
