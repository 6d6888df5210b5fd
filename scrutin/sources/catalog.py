"""Election listing and table profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin import schema as S

SAMPLE_DEPARTMENTS = [31, 34, 30]


def list_elections(df: DataFrame) -> DataFrame:
    """Distinct (year, round), year descending, round ascending."""
    return (df.select(S.YEAR, S.ROUND).distinct()
              .orderBy(F.col(S.YEAR).desc(), F.col(S.ROUND).asc()))


def column_list(df: DataFrame) -> str:
    """Column names and types, from the schema (no job)."""
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)


def table_profile(df: DataFrame, table_name: str = "ballots",
                  sample: Sequence[int] = SAMPLE_DEPARTMENTS) -> DataFrame:
    """Row count, rows in the sample departments, column count and list."""
    dept = F.col(S.DEPT).cast("string").try_cast("int") if S.DEPT in df.columns else F.lit(None)
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_if(dept.isin(list(sample))).alias("sample_records")).select(
        F.lit(table_name).alias("table_name"), "total_records", "sample_records",
        F.lit(len(df.columns)).alias("total_columns"), F.lit(column_list(df)).alias("columns"))
