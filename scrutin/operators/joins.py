"""Joins (J1-J3, J5, J7) and set operations.

Fact-to-aggregate joins pre-aggregate the right side to one row per
department first (bounded by the number of departments), so the join never
multiplies rows; that table is counted and broadcast, or else the hot
departments' rows are split from the others (``keyed``).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.operators import aggregates as A
from scrutin.operators import enrich
from scrutin.operators.keyed import join_per_key


def socio_by_department(socio: DataFrame, suffix: str = "") -> DataFrame:
    """Rename keys (DEP -> departement, ...) and average the 7 indicators."""
    renamed = socio.withColumnsRenamed({k: v for k, v in S.SOCIO_RENAMES.items() if k in socio.columns})
    if S.DEPT not in renamed.columns:
        raise ValueError("socio table has no department column (DEP or departement)")
    present = [c for c in S.SOCIO_INDICATORS if c in renamed.columns]
    return renamed.groupBy(S.DEPT).agg(*[F.avg(c).alias(c + suffix) for c in present])


def join_socio(base: DataFrame, socio: DataFrame, suffix: str = "") -> DataFrame:
    """Department means of the socio indicators, left-joined."""
    return join_per_key(base, socio_by_department(socio, suffix), [S.DEPT], how="left")


def legislative_by_department(leg: DataFrame, suffix: str = "_leg") -> DataFrame:
    return leg.groupBy(S.DEPT).agg(*[F.avg(c).alias(c + suffix) for c in S.LEGISLATIVE_MEANS
                                     if c in leg.columns])


def join_legislative(base: DataFrame, leg: DataFrame, suffix: str = "_leg") -> DataFrame:
    """Department means of registered/voters/abstentions, ``_leg`` suffix."""
    return join_per_key(base, legislative_by_department(leg, suffix), [S.DEPT], how="left")


def _year_of(key: str) -> str:
    digits = "".join(ch if ch.isdigit() else " " for ch in key).split()
    return digits[-1] if digits else key


def merge_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The main table is the 2022 presidential one (else the first); socio
    and legislative tables are folded in by J1/J2.  When several tables of one
    kind are joined their columns carry the year (decision Q14)."""
    keys = list(datasets)
    if not keys:
        raise ValueError("no datasets")
    main = next((k for k in keys if "presidentielle" in k and "2022" in k), keys[0])
    kinds = {"socio": [k for k in keys if k != main and "socio" in k],
             "legislative": [k for k in keys if k != main and "legislative" in k]}
    base = datasets[main]
    for k in kinds["socio"]:
        suffix = f"_{_year_of(k)}" if len(kinds["socio"]) > 1 else ""
        base = join_socio(base, datasets[k], suffix)
    for k in kinds["legislative"]:
        suffix = f"_leg_{_year_of(k)}" if len(kinds["legislative"]) > 1 else "_leg"
        base = join_legislative(base, datasets[k], suffix)
    return base


def top_labels_only(df: DataFrame, k: int = 8, column: str = S.LABEL) -> DataFrame:
    """Rows whose label is among the k most frequent."""
    return A.in_top_values(df, column, k)


def with_dimension(df: DataFrame, how: str = "left") -> DataFrame:
    """Name, former region and coordinates in one broadcast join with the
    13-row department dimension."""
    dim = F.broadcast(enrich.department_dim(df.sparkSession))
    return df.join(dim, on=S.DEPT, how=how)


# -- T1-T3 -----------------------------------------------------------------------
def key_union(a: DataFrame, b: DataFrame, column: str = S.LABEL) -> DataFrame:
    """Keys present on either side."""
    return a.select(column).union(b.select(column)).distinct()


def stack_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One table from ``type_year`` keyed tables; the key parts become
    ``election_type`` and ``annee_source`` columns."""
    frames = []
    for key, df in datasets.items():
        kind, _, year = key.rpartition("_")
        frames.append(df.withColumns({"election_type": F.lit(kind or key),
                                      "annee_source": F.lit(year).try_cast("int")}))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
