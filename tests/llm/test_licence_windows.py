"""Licence windows against a plain search over all windows, and texts whose
notices stand inside lines, paragraphs and comments."""

import random
import re
from collections import Counter

import pytest

from scrutin.llm import licences

SMALL = (("A", "one two three four five six"), ("A", "one two one two one"), ("B", "two three four five six seven eight"), ("C", "six one"))


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def brute(text, templates, threshold):
    """Every start's best end over all windows, then the same two removals."""
    w = words(text)
    b = list(zip(w, w[1:]))
    kept = []
    for t, (name, source) in enumerate(templates):
        u = words(source)
        bag, m = Counter(zip(u, u[1:])), len(u) - 1
        own = []
        for i in range(len(b)):
            if b[i] not in bag:
                continue
            tries = [(-2 * sum((Counter(b[i:j + 1]) & bag).values()) / (j - i + 1 + m), j) for j in range(i, min(len(b), i + 3 * m + 3))]
            dice, j = min(tries)
            if -dice >= threshold:
                own.append((i, j, -dice, name))
        kept += [x for x in own if not any(v[0] <= x[1] and v[1] >= x[0] and (v[2] > x[2] or v[2] == x[2] and v[0] < x[0]) for v in own)]
    return sorted(x for x in kept if not any(v[0] <= x[1] and v[1] >= x[0] and v[2] > x[2] for v in kept))


@pytest.mark.parametrize("threshold", [0.8, 0.6])
def test_windows_match_a_search_over_all(spark, threshold):
    rng = random.Random(5)
    vocabulary = "one two three four five six seven eight nine".split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(150)]
    texts += [" ".join(rng.choice(["nine nine", *[s for _, s in SMALL]]) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    texts += [" ".join(w for w in t.split() if rng.random() < 0.93) for t in texts[-60:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {}
    for r in licences.scan(df, SMALL, threshold).collect():
        got.setdefault(r.doc_id, []).append((r.first_word, r.last_word - 1, r.dice, r.licence))
    assert sum(map(len, got.values())) > 100
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == brute(t, SMALL, threshold), t


def test_notices_inside_other_text(spark):
    texts = [
        "Released under the MIT License, see the LICENSE file for details.",
        "Copyright 2020 Jane Doe. All rights reserved.",
        "words before it, Released under the MIT License and then a great many words after it on one line",
        "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
        " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */",
        "Released under the MIT License. Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.",
    ]
    got = [r for r in licences.licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [r.licences for r in got] == ["MIT", "All-rights-reserved", "MIT", "GPL-3.0", "CC-BY-NC-4.0,MIT", "GPL-3.0"]
    assert [r.n_passages for r in got] == [1, 1, 1, 1, 3, 1] and all(r.best == 1.0 for r in got)


def test_edges(spark):
    schema = "doc_id long, text string, licence string, `end` int, found string, start int"
    one = "Released under the MIT License."
    rows = [(1, one, "x", 1, "y", 2), (1, one, "x", 1, "y", 2), (None, one, None, None, None, None), (2, None, None, None, None, None), (3, "", None, None, None, None),
            (4, "prose " * 300_000 + one + " prose" * 300_000, None, None, None, None), (5, f"{one}\n" * 3000, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = licences.licences(df).collect()
    assert sorted((r.doc_id or 0, r.licences, r.n_passages) for r in got) == [
        (0, "MIT", 1), (1, "MIT", 1), (1, "MIT", 1), (2, "", 0), (3, "", 0), (4, "MIT", 1), (5, "MIT", 3000)]
    assert licences.licences(df.limit(0)).count() == 0 and licences.scan(df.limit(0)).count() == 0
    assert {r.licences for r in licences.licences(df, ()).collect()} == {""} == {r.licences for r in licences.licences(df, (("X", "word"), ("Y", ""))).collect()}


def test_one_scan_and_no_shuffle(spark):
    df = spark.range(3).selectExpr("id as doc_id", "cast(id as string) as text")
    plan = licences.licences(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
