"""L1: the five-step preprocessing as one lazy plan.

clean columns (P1-P4) -> validate (F7) -> enrich (E1-E4) -> rates (E5)
-> first row per (year, round, department, label) (W1) -> column order (P5)
-> final order (W6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation

from scrutin import schema as S
from scrutin.operators import clean, enrich
from scrutin.operators import ordering as W


def clean_columns(df: DataFrame) -> DataFrame:
    return clean.coerce_types(clean.rename_synonyms(df))


def enrich_rows(df: DataFrame, urban: Sequence[int] = S.URBAN_DEPARTMENTS) -> DataFrame:
    df = enrich.with_department_name(df) if S.DEPT in df.columns else df
    df = enrich.with_family(df) if S.LABEL in df.columns else df
    if S.DEPT in df.columns:
        df = enrich.with_typology(enrich.with_former_region(df), urban)
    return df


def validated(df: DataFrame, regions: Sequence[int] = S.REGION_DEPARTMENTS,
              urban: Sequence[int] = S.URBAN_DEPARTMENTS,
              observation: Observation | None = None,
              years: tuple[int, int] = (S.MIN_YEAR, S.MAX_YEAR)) -> DataFrame:
    """Steps 1-4: every valid row, enriched and with its rates (no dedup)."""
    df = clean.validate(clean_columns(df), regions, observation, years)
    return enrich.with_rates(enrich_rows(df, urban))


final_order = W.final_order


def preprocess(df: DataFrame, tiebreak: Sequence[str] | None = None,
               regions: Sequence[int] = S.REGION_DEPARTMENTS,
               urban: Sequence[int] = S.URBAN_DEPARTMENTS,
               sort: bool = True, observation: Observation | None = None,
               years: tuple[int, int] = (S.MIN_YEAR, S.MAX_YEAR)) -> DataFrame:
    """The full preprocessing.  ``tiebreak`` orders rows inside a duplicate
    group (first one kept); by default every non-key column, ascending."""
    df = clean.validate(clean_columns(df), regions, observation, years)
    if all(c in df.columns for c in S.DEDUP_KEYS):
        df = clean.first_per_key(df, S.DEDUP_KEYS, tiebreak)
    # family, region and rates depend on their own row only: added to the kept rows
    df = clean.order_columns(enrich.with_rates(enrich_rows(df, urban)))
    return final_order(df) if sort else df
