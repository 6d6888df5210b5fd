"""Spark-side inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrutin import session
from scrutin.plans import preprocess as L
from scrutin.sources import testdata as TD


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return TD.ballots_raw(spark, sf)


def typed(spark: SparkSession, sf: str) -> DataFrame:
    """Typed ballots with cleaned labels (no validation)."""
    return L.clean_columns(TD.ballots(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Every valid ballot row, enriched, before deduplication."""
    return L.validated(raw(spark, sf))


def results(spark: SparkSession, sf: str, sort: bool = False) -> DataFrame:
    """The preprocessed results table (L1), first row per key by the
    ballot-row identity."""
    return L.preprocess(raw(spark, sf), tiebreak=TD.TIEBREAK, sort=sort)


def kept_results(spark: SparkSession, sf: str) -> DataFrame:
    """The results table, bounded by its keys, in the checkpoint folder: for
    queries that read it more than once."""
    return session.materialise(results(spark, sf))
