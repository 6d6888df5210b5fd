"""Stored partial states by year, from which the analyses are merged.

A summary has one row for each (year, department, label) and its attributes,
with the row count, the sums of counts, and the sum and number of the values of
every averaged rate.  States of different years never meet before the final
aggregate, so a new or rewritten year's partition is all that an update writes,
and the analyses read a table whose size is set by the key space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.functions import exprs as X
from scrutin.sources import stages

KEYS = (S.YEAR, S.DEPT, S.LABEL, "famille_politique", "typologie", "ancien_midi_pyrenees")
SUMS = (S.VOTES, "inscrits", "abstentions")
MEANS = ("taux_participation", "pct_exprimes")


def summarise(rows: DataFrame) -> DataFrame:
    """The partial states of processed rows (the key and measure columns that they have)."""
    keys = [c for c in KEYS if c in rows.columns]
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [F.sum(c).alias(c) for c in SUMS if c in rows.columns]
    for c in MEANS:
        if c in rows.columns:
            aggs += [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    return rows.groupBy(*keys).agg(*aggs)


def mean(column: str) -> Column:
    """Aggregate: the mean of a rate from its states; null without values."""
    return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_n"))


def by_department(summary: DataFrame) -> DataFrame:
    """A8 from a summary."""
    out = summary.groupBy(S.DEPT).agg(mean("taux_participation").alias("taux_participation"), mean("pct_exprimes").alias("part_voix"),
                                      F.sum(S.VOTES).alias("voix"), F.sum("inscrits").alias("inscrits"))
    return out.withColumn("nom_departement", X.department_name(S.DEPT))


def by_year(summary: DataFrame) -> DataFrame:
    """A9 from a summary."""
    return summary.groupBy(S.YEAR).agg(mean("taux_participation").alias("taux_participation"), *[F.sum(c).alias(c) for c in SUMS])


def write(rows: DataFrame, path: str, made_from: str = stages.GIVEN, years: list[int] | None = None) -> stages.Manifest:
    """Write the summary of the processed ``rows``; with ``years`` only those
    years' partitions of a stored summary, from rows of these years."""
    if years is not None:
        rows = rows.where(F.col(S.YEAR).isin(years))
    return stages.write_stage(summarise(rows), path, partition_by=[S.YEAR], made_from=made_from, update=years is not None, emptied=years or ())


def read(spark: SparkSession, path: str, made_from: str | None = None) -> DataFrame:
    return stages.read_stage(spark, path, made_from)
