"""Windows, ranking, sorts and limits.

Windows here always run on rows that are already aggregated to a bounded
key space (scenario x label, contest x label), never on raw ballots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.operators.keyed import join_per_key


def share_of_total(df: DataFrame, value: str, by: Sequence[str], out: str = "pct") -> DataFrame:
    """Value / sum(value) over the group x 100 (0 when the sum is 0).

    The group totals come from a partial aggregate joined back on the group
    keys (no window, see ``keyed``).
    """
    totals = df.groupBy(*by).agg(F.sum(value).alias("__total"))
    return join_per_key(df, totals, by).withColumn(
        out, F.when(F.col("__total") != 0, F.col(value) / F.col("__total") * 100).otherwise(F.lit(0.0))).drop("__total")


def rank_predictions(df: DataFrame, by: Sequence[str] = ("scenario_id",), value: str = "pct",
                     label: str = S.LABEL, out: str = "rang") -> DataFrame:
    """Rank 1..n by value descending, ties by label ascending."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc(), F.col(label).asc())
    return df.withColumn(out, F.row_number().over(w))


def winner(df: DataFrame, by: Sequence[str] = ("scenario_id",), value: str = "pct",
           label: str = S.LABEL) -> DataFrame:
    """The label with the largest value per group; the smallest label on
    ties.  A grouped ``max_by`` (partial aggregation, no window)."""
    # (value desc, label asc) is the minimum of struct(-value, label).
    best = F.min_by(F.struct(F.col(label).alias("l"), F.col(value).alias("v")),
                    F.struct((-F.col(value)).alias("nv"), F.col(label).alias("l")))
    return (df.groupBy(*by).agg(best.alias("__w"))
              .select(*by, F.col("__w.l").alias("gagnant"), F.col("__w.v").alias("pct_gagnant")))


def best_and_worst(df: DataFrame, by: Sequence[str], error: str = "ecart",
                   label: str = S.LABEL, order: Sequence[Column] | None = None) -> DataFrame:
    """Labels with the smallest and largest error per group, ties broken
    by the given order (default: label ascending)."""
    order = list(order) if order is not None else [F.col(label)]
    tie = F.struct(*[o.alias(f"t{i}") for i, o in enumerate(order)])
    lo = F.min_by(F.col(label), F.struct(F.col(error).alias("e"), tie.alias("t")))
    hi = F.min_by(F.col(label), F.struct((-F.col(error)).alias("e"), tie.alias("t")))
    return df.groupBy(*by).agg(lo.alias("meilleure"), F.min(error).alias("ecart_min"),
                               hi.alias("pire"), F.max(error).alias("ecart_max"))


def final_order(df: DataFrame) -> DataFrame:
    """Year, round, department ascending, votes descending (the columns
    present; a range-partitioned sort, used only on bounded results)."""
    keys = []
    for c, desc in ((S.YEAR, False), (S.ROUND, False), (S.DEPT, False), (S.VOTES, True)):
        if c in df.columns:
            keys.append(F.col(c).desc() if desc else F.col(c).asc())
    return df.orderBy(*keys) if keys else df


def scan_order_limit(df: DataFrame, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Year descending, round, department (then ``tiebreak``); first n.
    Planned as TakeOrderedAndProject: each task keeps its own top n."""
    keys = [F.col(S.YEAR).desc(), F.col(S.ROUND).asc(), F.col(S.DEPT).asc()]
    return df.orderBy(*keys, *[F.col(c).asc() for c in tiebreak]).limit(n)


def preview(df: DataFrame, n: int = 20, order: Sequence[str] | None = None) -> DataFrame:
    """The first n rows under an explicit order (deterministic)."""
    order = list(order) if order is not None else list(df.columns)
    return df.orderBy(*order).limit(n)
