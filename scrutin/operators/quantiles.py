"""Exact quantiles of many columns, by brackets from mergeable rank sketches.

A rank sketch of each column gives two values between which a wanted rank lies
almost surely.  The next pass counts the rows below and between them, which
proves or disproves that, and sketches the rows between; so every round makes
the brackets about a hundredth as wide.  Once a bracket holds few rows, its
distinct values are counted and the ranks are looked up.  A wrong bracket costs
another round, never a wrong result.

Every round is one aggregate over the table without unpivoting or sorting it:
tasks send counts and sketches, which are merged in GROUPS groups and then in
one, and only the few rows inside the last brackets are shuffled.  The driver
holds some numbers for each column and quantile.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrutin.session import settled

SKETCH_K = 1000       #: size of a rank sketch: 22 kB
MARGIN = 0.005        #: of the ranks on either side of the estimate; a sketch errs by 0.3 % at most 99 times in 100
FEW = 200_000         #: rows that a bracket may hold when its values are counted
GROUPS = 64           #: sketches are merged in so many groups first
ROUNDS = 40


@dataclass
class _Wanted:
    """One quantile of one column: the ranks next to it and values that enclose both."""

    column: int
    position: float                      # may lie between two ranks
    inside: int                          # rows in the bracket
    tried: tuple[float, float] = (-math.inf, math.inf)  # the next bracket
    lo: float = -math.inf                # the proven one
    hi: float = math.inf
    below: int = 0                       # rows under it
    open: bool = True

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    def counted(self, below: int, inside: int, narrower: Sequence[float] | None) -> None:
        """Take in the rows under and inside the tried bracket, and the sketch's one inside it."""
        (r0, r1), (lo, hi) = self.ranks, self.tried
        if below <= r0 and r1 < below + inside:
            same = (lo, hi) == (self.lo, self.hi)
            self.lo, self.hi, self.below, self.inside = lo, hi, below, inside
            self.tried = (max(lo, narrower[0]), min(hi, narrower[1]))
            # few rows, one value, or too few values for a narrower bracket
            self.open = not (inside <= FEW or lo == hi or same or self.tried == (lo, hi))
        else:                            # the sketch was off: a rank lies beside the bracket
            self.tried = (self.lo if r0 < below else hi if r0 >= below + inside else lo,
                          self.hi if r1 >= below + inside else lo if r1 < below else hi)


def _between(x: Column, bracket: tuple[float, float]) -> Column:
    """Whether a value lies in the bracket; NaN lies in none."""
    return (x >= F.lit(bracket[0])) & (x <= F.lit(bracket[1])) & ~F.isnan(x)


def _merged(values: DataFrame, counts: dict[str, Column], sketches: dict[str, Column]) -> DataFrame:
    """One row of counts and of sketches of the given values, merged in two steps."""
    grouped = values.withColumn("__group", F.spark_partition_id() % GROUPS).groupBy("__group").agg(
        *[c.alias(n) for n, c in counts.items()], *[F.kll_sketch_agg_double(c, SKETCH_K).alias(n) for n, c in sketches.items()])
    return grouped.agg(*[F.sum(n).alias(n) for n in counts], *[F.kll_merge_agg_double(n, SKETCH_K).alias(n) for n in sketches])


def _brackets(spark: SparkSession, asked: list[tuple[bytes, int, int, int]]) -> list[tuple[float, float] | None]:
    """For each (sketch, first rank, last rank, its rows) the sketch's values on
    either side of the ranks; None for an empty one.  Evaluated on the driver."""
    out: list[tuple[float, float] | None] = [None] * len(asked)
    full = [i for i, (_, _, _, rows) in enumerate(asked) if rows]
    if full:
        held = spark.createDataFrame([tuple(bytearray(asked[i][0]) for i in full)], ", ".join(f"s{i} binary" for i in full))
        at = {i: [min(1.0, max(0.0, asked[i][1] / asked[i][3] - MARGIN)), min(1.0, max(0.0, (asked[i][2] + 1) / asked[i][3] + MARGIN))] for i in full}
        row = held.select(*[F.kll_sketch_get_quantile_double(f"s{i}", F.array(*[F.lit(f) for f in at[i]])).alias(f"q{i}") for i in full]).first()
        for i in full:
            out[i] = tuple(row[f"q{i}"])
    return out


def _shrink(values: DataFrame, wanted: list[_Wanted]) -> None:
    """One round: count the tried brackets, and find narrower ones inside them."""
    counts, sketches = {}, {}
    for i, w in enumerate(wanted):
        x = F.col(f"c{w.column}")
        inside = _between(x, w.tried)
        counts |= {f"b{i}": F.count_if(x < F.lit(w.tried[0])), f"i{i}": F.count_if(inside)}
        sketches[f"s{i}"] = F.when(inside, x)
    row = _merged(values, counts, sketches).first()
    narrower = _brackets(values.sparkSession, [(row[f"s{i}"], w.ranks[0] - row[f"b{i}"], w.ranks[1] - row[f"b{i}"], row[f"i{i}"]) for i, w in enumerate(wanted)])
    for i, w in enumerate(wanted):
        w.counted(row[f"b{i}"], row[f"i{i}"], narrower[i])


def _look_up(values: DataFrame, wanted: list[_Wanted]) -> list[tuple[float, float]]:
    """The values at both ranks of every quantile, from the rows inside its bracket."""
    inside = [_between(F.col(f"c{w.column}"), (w.lo, w.hi)) for w in wanted]
    entries = [F.when(c, F.struct(F.lit(i).alias("i"), F.col(f"c{w.column}").alias("v"))) for i, (w, c) in enumerate(zip(wanted, inside))]
    any_inside = reduce(or_, [F.coalesce(c, F.lit(False)) for c in inside])
    found = (values.where(any_inside).select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
             .groupBy(F.col("e.i").alias("i"), F.col("e.v").alias("v")).agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    ranks = F.array(*[F.array(*[F.lit(r - w.below) for r in w.ranks]) for w in wanted])
    hits = (found.withColumn("upto", upto).withColumn("rank", F.explode(F.element_at(ranks, F.col("i") + 1)))
            .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))).select("i", "rank", "v").collect())
    at = {(h["i"], h["rank"]): h["v"] for h in hits}  # at most two for each quantile
    return [tuple(at[i, r - w.below] for r in w.ranks) for i, w in enumerate(wanted)]


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, int], float | None]:
    """The ``probs[k]`` quantile of each column with linear interpolation, as
    pandas and ``percentile`` have it, by (column, k).  Nulls are left out, NaN
    is the largest value; a column without values has None.  Runs three jobs over
    the columns, which are kept first if joins or aggregates made them, and one more for each hundredfold of the rows beyond 20 million."""
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    values = settled(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    counts, sketches = {}, {}
    for i in range(len(columns)):
        counts |= {f"n{i}": F.count(f"c{i}"), f"m{i}": F.count_if(F.col(f"c{i}").isNotNull() & ~F.isnan(f"c{i}"))}
        sketches[f"s{i}"] = F.col(f"c{i}")
    row = _merged(values, counts, sketches).first()

    out: dict[tuple[str, int], float | None] = {}
    wanted: dict[tuple[str, int], _Wanted] = {}
    asked = []
    for i, c in enumerate(columns):
        n, m = row[f"n{i}"] or 0, row[f"m{i}"] or 0
        for k, p in enumerate(probs):
            if not n:
                out[c, k] = None
            elif math.ceil(p * (n - 1)) >= m:     # at or next to a NaN
                out[c, k] = math.nan
            else:
                w = wanted[c, k] = _Wanted(i, p * (n - 1), m)
                asked.append((row[f"s{i}"], *w.ranks, m))
    for w, bracket in zip(wanted.values(), _brackets(df.sparkSession, asked)):
        w.tried = bracket
    for _ in range(ROUNDS):
        left = [w for w in wanted.values() if w.open]
        if not left:
            break
        _shrink(values, left)
    else:
        raise RuntimeError("the quantiles' brackets did not settle")
    if wanted:
        for key, (a, b) in zip(wanted, _look_up(values, list(wanted.values()))):
            position = wanted[key].position
            out[key] = a if a == b else a + (b - a) * (position - math.floor(position))
    return out


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: Sequence[float], approx: bool = False) -> dict[tuple[str, int], Column]:
    """The quantiles as literals, by (column, k); ``approx`` takes a sketch's values in one job."""
    columns = list(dict.fromkeys(columns))
    if approx:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), float(p)).alias(f"q{i}_{k}")
                       for i, c in enumerate(columns) for k, p in enumerate(probs)]).first()
        got = {(c, k): row[f"q{i}_{k}"] for i, c in enumerate(columns) for k in range(len(probs))}
    else:
        got = quantiles(df, columns, probs)
    return {key: F.lit(v).cast("double") for key, v in got.items()}
