"""Preprocessing and descriptive analyses."""

from __future__ import annotations

from checks import inputs as I
from checks import sqlbase as Q
from checks.registry import on_results, query
from scrutin.operators import aggregates as A


@query("preprocess", sql=on_results("SELECT * FROM results"))
def preprocess(spark, sf):
    return I.results(spark, sf, sort=True)


@query("by_department", floats=["taux_participation", "part_voix"], sql=on_results(f"""
SELECT departement, {Q.mean2('taux_participation')} AS taux_participation, {Q.mean2('pct_exprimes')} AS part_voix,
  CAST(sum(voix) AS BIGINT) AS voix, CAST(sum(inscrits) AS BIGINT) AS inscrits,
  {Q.DEPT_NAME} AS nom_departement
FROM results GROUP BY departement"""))
def by_department(spark, sf):
    return A.by_department(I.results(spark, sf))
