"""Operator 2: benchmark decontamination by a prefix-filtered set join.

A window is WINDOW consecutive words of a benchmark item (the whole item if it
is shorter).  A window's shingles (SHINGLE words each, fewer for a shorter
window) are ordered by rarity in the documents; as containment must be exact,
the necessary prefix is its rarest shingle.  Document shingles meet the prefix
shingles in a broadcast join; the shingle's place in the window gives the place
the window would have (positional bound), which must lie inside the document
(length bound), and there the words are compared one by one.

Prefix shingles are joined in blocks of BLOCK rows at most, so no broadcast
grows with the benchmark.  DataFrame functions only.

Words are runs of ASCII letters and digits and of any other than ASCII, A-Z
lower-cased.  Defined cases: a null text has no words; an item without words
has no windows; a null item id is written ``null``; repeated rows are kept and
get equal values; an empty benchmark leaves every document clean; columns
beside doc_id, item_id and text are not read (``clean_documents`` keeps them).
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm.common import stored, unused

WINDOW = 10
SHINGLE = 5
BLOCK = 200_000


def words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def word_count(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0)).cast("long")


def windows(benchmark: DataFrame) -> DataFrame:
    """(win, item) for every distinct window of every item."""
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                              words(F.col("text").cast("string")).alias("words")).where("size(words) > 0"))
    return (items.select("item", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("k"))
            .select("item", "words", "k", F.explode(F.expr("sequence(1, size(words) - k + 1)")).alias("at"))
            .select(F.slice("words", F.col("at"), F.col("k")).alias("win"), "item").distinct())


def _blocks(df: DataFrame, key: str) -> list[DataFrame]:
    n = max(1, -(-df.count() // BLOCK))
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key, F.lit("block")), F.lit(n)) == i) for i in range(n)]


def _positions(documents: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, version, words, at, gram): each shingle of each document."""
    docs = (documents.select("doc_id", F.xxhash64("text").alias("version"), words(F.coalesce("text", F.lit(""))).alias("words"))
            .select("doc_id", "version", "words", F.explode(F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)))).alias("at")))
    if len(lengths) == 1:
        return docs.withColumn("gram", F.xxhash64(F.slice("words", F.col("at"), lengths[0])))
    return docs.withColumn("gram", F.explode(F.array(*[F.xxhash64(F.slice("words", F.col("at"), k)) for k in lengths])))


def hits(documents: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, version, start, length, id): the places of windows in documents."""
    grams = (wins.select("win").distinct().select("win", F.xxhash64("win").alias("id"), F.size("win").alias("length"))
             .select("win", "id", "length", F.explode(F.expr(f"sequence(1, greatest(length - {SHINGLE} + 1, 1))")).alias("offset"))
             .select("win", "id", "length", "offset", F.slice("win", F.col("offset"), F.least("length", F.lit(SHINGLE))).alias("g"))
             .select("win", "id", "length", "offset", F.size("g").alias("k"), F.xxhash64("g").alias("gram")))
    grams = stored(grams, "grams")
    lengths = sorted(r.k for r in grams.select("k").distinct().collect()) or [SHINGLE]  # 1 to SHINGLE
    places = _positions(documents, lengths)
    # rarity of the benchmark's shingles in the documents
    known = [places.join(F.broadcast(b), "gram").groupBy("gram").agg(F.count("*").alias("n"))
             for b in _blocks(grams.select("gram").distinct(), "gram")]
    rarity = stored(reduce(DataFrame.union, known), "rarity")
    # a window with a shingle that no document has occurs nowhere
    rarest = (grams.join(rarity, "gram", "left")
              .groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("offset"), F.col("gram"),
                                                 F.col("id"), F.col("length"))).alias("r"))
              .where("r.n > 0").select("win", "r.gram", "r.offset", "r.length", "r.id"))
    rarest = stored(rarest, "prefix")
    start = F.col("at") - F.col("offset") + 1
    found = [places.join(F.broadcast(b), "gram")
             .where((start >= 1) & (start + F.col("length") - 1 <= F.size("words")))
             .where(F.when(start >= 1, F.slice("words", F.greatest(start, F.lit(1)), F.col("length")) == F.col("win")))
             .select("doc_id", "version", start.alias("start"), "length", "id")
             for b in _blocks(rarest, "gram")]
    return reduce(DataFrame.union, found)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wins = stored(windows(benchmark), "windows")
    found = stored(hits(docs, wins).distinct(), "hits")
    cover = (found.groupBy("doc_id", "version")
             .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
             .select("doc_id", "version", F.expr(
                 "aggregate(spans, named_struct('n', 0, 'upto', 0), (a, x) -> named_struct("
                 "'n', a.n + greatest(0, x.end - greatest(a.upto, x.start)), 'upto', greatest(a.upto, x.end))).n").alias("n_hit")))
    items = (found.select("doc_id", "version", "id").distinct()
             .join(wins.select(F.xxhash64("win").alias("id"), "item"), "id").select("doc_id", "version", "item").distinct()
             .groupBy("doc_id", "version").agg(F.sort_array(F.collect_list("item")).alias("items")))
    base = docs.select("doc_id", F.xxhash64("text").alias("version"), word_count(F.col("text")).alias("n_words"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["version"] == b["version"])
    marks = cover.join(items, same(cover, items)).select(cover["doc_id"].alias("h_id"), cover["version"].alias("h_version"), "n_hit", "items")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (base.join(marks, base["doc_id"].eqNullSafe(marks["h_id"]) & (base["version"] == marks["h_version"]), "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated")))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, whole rows, in which no window occurs."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    h_id, h_version = unused(documents, "h_id", "h_version")
    found = hits(docs, stored(windows(benchmark), "windows")).select(F.col("doc_id").alias(h_id), F.col("version").alias(h_version)).distinct()
    found = stored(found, "hits")
    return documents.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(h_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(h_version)), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hit AS (SELECT p.doc_id, p.i, k.k, win.item FROM pos p JOIN ks k ON p.i + k.k - 1 <= len(p.w)
        JOIN win ON win.k = k.k AND win.g = array_to_string(p.w[p.i:p.i + k.k - 1], ' ')),
nh AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN nh ON nh.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
