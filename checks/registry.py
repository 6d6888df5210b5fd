"""Registered queries: the Spark job and, where SQL can express it, the DuckDB
oracle that recomputes it independently.

Every query reads the benchmark tables (through the derived ballots/socio
views) in full; no row caps, id subsets or samples.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqlbase as Q


@dataclass
class Query:
    name: str
    spark: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    floats: list[str] = field(default_factory=list)
    digits: int = 9

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_floats(self.spark(spark, sf_dir), self.floats, self.digits)

    def oracle(self) -> str | None:
        return None if self.sql is None else Q.rounded(self.sql, self.floats, self.digits)


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, floats: list[str] | tuple = (), digits: int = 9):
    """``digits``: decimals at which both engines round the ``floats``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, list(floats), digits)
        return fn
    return deco


def round_floats(df: DataFrame, floats: list[str], digits: int = 9) -> DataFrame:
    """Half-even rounding of the named double columns on the binary value,
    identical to the oracle's ``round_even(x * 10^digits, 0) / 10^digits``."""
    if not floats:
        return df
    scale = float(10 ** digits)
    return df.withColumns({c: F.rint(F.col(c) * scale) / scale for c in floats})


def on(*ctes: str, body: str) -> str:
    return Q.with_ctes(*ctes, body=body)


def on_results(body: str) -> str:
    return on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, body=body)


def on_enriched(body: str) -> str:
    return on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, body=body)


def on_history(body: str, *extra: str) -> str:
    return on(Q.BALLOTS, Q.TYPED_CLEAN, Q.HISTORY, *extra, body=body)


# Importing the query modules fills REGISTRY.
from checks import q_analyses, q_clean, q_core, q_ml, q_predict  # noqa: E402,F401
