"""Pairwise moments of many columns as one matrix aggregate.

Every task keeps, for all pairs of columns at once, the count and the sums of
the rows in which both have a value: with V the values (0 where missing,
shifted by the column's mean) and M the mask, these are the products M'M, V'M,
(V*V)'M and V'V of its batches.  One row for each pair and task goes to the
shuffle, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.session import settled

SUMS = "i INT, j INT, n DOUBLE, sx DOUBLE, sy DOUBLE, sxx DOUBLE, syy DOUBLE, sxy DOUBLE"
_NAMES = ("n", "sx", "sy", "sxx", "syy", "sxy")
#: A variance this small beside the sum of squares is rounding: the column is constant.
_ROUNDING = 1e-14


def _products(batches: Iterator[pa.RecordBatch], shift: list[float]) -> Iterator[pa.RecordBatch]:
    k = len(shift)
    both, first, squares, cross = (np.zeros((k, k)) for _ in range(4))
    for batch in batches:
        mask = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
        values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
        values = np.where(mask, values - np.array(shift), 0.0)
        m = mask.astype(np.float64)
        both += m.T @ m
        cross += values.T @ values
        # column by column: a column with NaN must not touch the others' sums
        first += values.T @ m
        squares += (values * values).T @ m
    i, j = np.triu_indices(k)
    out = [both[i, j], first[i, j], first[j, i], squares[i, j], squares[j, i], cross[i, j]]
    yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(x) for x in out]], names=["i", "j", *_NAMES])


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for every pair i <= j of the columns over
    the rows in which both have a value, the values less their column's mean.
    One job finds the means."""
    values = settled(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    means = values.agg(*[F.avg(c).alias(c) for c in values.columns]).first()
    shift = [float(m) if m is not None else 0.0 for m in means]
    parts = values.mapInArrow(lambda batches: _products(batches, shift), SUMS)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _NAMES])


def correlations(sums: DataFrame) -> DataFrame:
    """(i, j, r): Pearson's r of each pair; null for a constant column or fewer than two rows."""
    def moment(cross: str, a: str, b: str):
        return F.col(cross) - F.try_divide(F.col(a) * F.col(b), F.col("n"))

    vx, vy = moment("sxx", "sx", "sx"), moment("syy", "sy", "sy")
    broken = F.isnan(vx) | F.isnan(vy)
    constant = ~broken & ((vx <= _ROUNDING * F.col("sxx")) | (vy <= _ROUNDING * F.col("syy")))
    # a column with itself is 1 to the last digit; rounding must not pass 1
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(moment("sxy", "sx", "sy"), F.sqrt(vx * vy))))
    r = F.when(broken, F.lit(float("nan"))).otherwise(r)
    return sums.select("i", "j", F.when((F.col("n") >= 2) & ~constant, r).alias("r"))
