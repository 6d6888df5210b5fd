"""Operator 10: mixing sources to target weights by subset-sum fitting.

A source's target is its weight's share of the budget, at most twice the
source's size; what a stopped source cannot take is shared again by weight.
Every document is taken target // source size times; for the rest of the
target the documents of each exact length are counted, a like share of every
length is taken, and bounded-knapsack dynamic programming over the lengths that
are left fits what remains.  Within a source and length the documents are
chosen by a seeded hash of their id, so reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; documents of size 0 are taken 0 times; an empty table gives no
rows; equal rows are told apart by a second hash only if their texts differ,
else by any order (they are equal).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutin.llm.common import stored, unused

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MOST = 2.0
SEED = 17
#: Words that the dynamic programme fits at most; larger documents fill the rest before it.
CAPACITY = 1 << 16
#: Documents of one source and length that are ranked in one group.
RANKED = 5000


def sizes(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")), F.lit(0)).cast("long").alias("size"),
        draw().alias("draw"))


def draw() -> Column:
    """The seeded hash that documents are chosen by."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.lit(SEED))


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """Adds the target to (source, source_size); one row per source.

    Weights repeat over the sources in code point order.  Sources are stopped
    round by round until none is above its bound; each round is one aggregate.
    """
    ranked = sources.select("source", "source_size").repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()).select("source", "source_size", F.spark_partition_id().alias("part"),
                                                 F.monotonically_increasing_id().alias("seq"))
    ranked = stored(ranked, "sources")
    # consecutive numbers: a number within the range partition and the rows of those before it
    parts = ranked.groupBy("part").agg(F.count("*").alias("n"), F.min("seq").alias("low")).orderBy("part").collect()
    starts, at = [], 0
    for p in parts:
        starts.append((p.part, at - p.low))
        at += p.n
    spark = sources.sparkSession
    shift = spark.createDataFrame(starts, "part int, shift long")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("index", F.lit(len(weights))) + 1).cast("int"))
    rows = (ranked.join(F.broadcast(shift), "part").select("source", "source_size", (F.col("seq") + F.col("shift")).alias("index"))
            .withColumn("weight", w).select("source", "source_size", "weight", (F.col("source_size") * most).alias("bound")))
    rows = stored(rows, "weighted")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = 0.0, -1
    while True:  # share: words per weight for the sources that are not stopped
        s = rows.agg(F.sum(F.when(F.col("bound") <= F.col("weight") * share, F.col("bound"))).alias("full"),
                     F.sum(F.when(F.col("bound") <= F.col("weight") * share, 1).otherwise(0)).alias("n"),
                     F.sum(F.when(F.col("bound") > F.col("weight") * share, F.col("weight"))).alias("open")).first()
        if s.n == stopped or not s.open:
            break
        share, stopped = (budget * total - (s.full or 0.0)) / s.open, s.n
    return rows.select("source", "source_size", F.least("bound", F.col("weight") * share).alias("target"))


def subset(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length (count at most) to take for a sum as near below
    the budget as can be, by dynamic programming over reachable sums.  Counts
    are split in powers of two; sums are the bits of one integer."""
    taken = np.zeros(len(lengths), np.int64)
    some = lengths[counts > 0]
    if budget <= 0 or not len(some):
        return taken
    unit = int(np.gcd.reduce(some))
    lengths, budget = lengths // unit, budget // unit
    full = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in np.argsort(-lengths, kind="stable"):
        length, left, k = int(lengths[i]), int(min(counts[i], budget // max(int(lengths[i]), 1))), 1
        while left > 0:
            m = min(k, left)
            steps.append((int(i), m, reach))
            reach = (reach | (reach << (length * m))) & full
            left, k = left - m, k * 2
            if reach >> budget & 1:
                break
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    for i, m, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += m
            at -= int(lengths[i]) * m
    return taken


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each length to take for a total near the budget:
    never above it, and below it by less than the shortest document that is
    left.  Up to CAPACITY words the total is the best that there is."""
    total = int((lengths * counts).sum())
    budget = int(round(min(budget, total)))
    # in Python's integers: the product passes 64 bits at about a million documents of one length
    taken = np.array([int(c) * budget // total for c in counts], np.int64) if total else counts * 0
    left = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):  # fill with long documents down to what the programme can hold
        if left <= CAPACITY:
            break
        more = min(int(counts[i] - taken[i]), (left - CAPACITY // 2) // int(lengths[i]))
        if more > 0:
            taken[i] += more
            left -= more * int(lengths[i])
    out = taken + subset(lengths, counts - taken, min(left, CAPACITY))
    left = budget - int((lengths * out).sum())
    for i in np.argsort(-lengths, kind="stable"):  # longer documents than the programme holds
        more = min(int(counts[i] - out[i]), left // int(lengths[i]))
        out[i] += more
        left -= more * int(lengths[i])
    if budget <= CAPACITY and left > 0:  # few documents: the programme alone
        return subset(lengths, counts, budget)
    return out


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    pdf["extra"] = fitted(lengths, counts, float(pdf["rest"].iloc[0]))
    return pdf[["source", "size", "n", "extra"]]


def mixed(documents: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words) and copies of every document."""
    docs = stored(sizes(documents), "sizes")
    hist = stored(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    sources = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = stored(targets(sources, weights, budget, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.select("source", "source_size", "target", whole.alias("whole"),
                       (F.col("target") - whole * F.col("source_size")).alias("rest"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    open_ = hist.where("size > 0").join(goal, same(hist, goal)).select(hist["source"], "size", "n", "rest").where("rest > 0")
    plan = stored(open_.groupBy("source").applyInPandas(_fit, "source string, size long, n long, extra long"), "plan")
    # documents of a source and length in hashed groups of about RANKED: whole
    # groups are taken while the count lasts, one group is ranked
    plan = plan.where("extra > 0").select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "extra",
                                          F.ceil(F.col("n") / RANKED).alias("groups"))
    keyed = (docs.join(plan, docs["source"].eqNullSafe(plan["p_source"]) & (docs["size"] == plan["p_size"]), "left")
             .select("doc_id", "source", "size", "draw", F.coalesce("extra", F.lit(0)).alias("extra"),
                     F.pmod(F.xxhash64("draw"), F.coalesce("groups", F.lit(1))).alias("group")))
    keyed = stored(keyed, "keyed")
    groups = keyed.where("extra > 0").groupBy("source", "size", "group").agg(F.count("*").alias("m"), F.max("extra").alias("extra"))
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy("group")) - F.col("m")
    groups = groups.withColumn("open", F.greatest(F.col("extra") - before, F.lit(0))).select(
        F.col("source").alias("g_source"), F.col("size").alias("g_size"), F.col("group").alias("g_group"), "m", "open")
    dealt = keyed.where("extra > 0").join(
        groups, keyed["source"].eqNullSafe(groups["g_source"]) & (F.col("size") == F.col("g_size")) & (F.col("group") == F.col("g_group")))
    cut = dealt.where("open > 0 and open < m")
    rank = F.row_number().over(Window.partitionBy("source", "size", "group").orderBy("draw", "doc_id"))
    cut = cut.withColumn("r", rank).select("doc_id", "source", "size", "draw", (F.col("r") <= F.col("open")).cast("long").alias("add"))
    sure = dealt.where("open = 0 or open >= m").select("doc_id", "source", "size", "draw", (F.col("open") > 0).cast("long").alias("add"))
    rest = keyed.where("extra = 0").select("doc_id", "source", "size", "draw", F.lit(0).cast("long").alias("add"))
    rows = cut.union(sure).union(rest)
    copies = (F.col("whole") + F.col("add")).cast("long")
    return (rows.join(goal, same(rows, goal))
            .select("doc_id", rows["source"], "size", "source_size", "target",
                    (F.col("size") * copies).alias("taken"), copies.alias("copies"), "draw"))


def mixture(documents: DataFrame, **parameters) -> DataFrame:
    """The documents that the mix takes, with mix_size, mix_source_size,
    mix_target, mix_taken and mix_copies (underscores are added to a name that
    the documents have); a row stands for its copies, repeated rows are one."""
    names = unused(documents, "mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_copies", "mix_id", "mix_draw", "mix_key")
    (id_, draw_, key), names = names[5:], names[:5]
    totals = (F.max("size"), F.max("source_size"), F.max("target"), F.sum("taken"), F.sum("copies"))
    taken = mixed(documents, **parameters).where("taken > 0").groupBy(F.col("doc_id").alias(id_), F.col("draw").alias(draw_)).agg(
        *[v.alias(c) for v, c in zip(totals, names)])
    docs = documents.withColumn(key, draw())
    return (docs.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(draw_)))
            .dropDuplicates([id_, draw_]).drop(id_, draw_, key))
