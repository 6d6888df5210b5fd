"""Descriptive analyses (A1-A21, W7, W8, E8, J5, J7) over the preprocessed
results, and volume variants over every valid row."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqlbase as Q
from checks.registry import on_enriched, on_results, query
from scrutin import schema as S
from scrutin.operators import aggregates as A
from scrutin.operators import enrich as E
from scrutin.operators import joins as J
from scrutin.operators import ordering as W
from scrutin.sources import testdata as TD

M2 = Q.mean2


# -- A1 value counts (top 5 is the report; the full list for labels) ------------------
def _vc_sql(column: str, n: int | None) -> str:
    lim = f" LIMIT {n}" if n else ""
    return on_results(f"""SELECT {column}, count(*) AS n FROM results WHERE {column} IS NOT NULL
GROUP BY {column} ORDER BY n DESC, {column}{lim}""")


for _col, _n in (("departement", 5), ("nuance", 5), ("famille_politique", 5), ("typologie", None),
                 ("nuance", None)):
    _name = f"value_counts_{_col}" + (f"_top{_n}" if _n else "")

    def _fn(spark, sf, c=_col, n=_n):
        return A.value_counts(I.results(spark, sf), c, n)

    query(_name, sql=_vc_sql(_col, _n))(_fn)


@query("counts_by_year", sql=on_results("SELECT annee, count(*) AS n FROM results GROUP BY annee"))
def counts_by_year(spark, sf):
    return A.counts_by_year(I.results(spark, sf))


@query("mean_participation", floats=["mean_participation"],
       sql=on_results(f"SELECT {M2('taux_participation')} AS mean_participation FROM results"))
def mean_participation(spark, sf):
    return A.mean_participation(I.results(spark, sf))


@query("former_region_split", sql=on_results("""SELECT CAST(count_if(ancien_midi_pyrenees) AS BIGINT) AS ancien_midi_pyrenees,
  CAST(count(*) - count_if(ancien_midi_pyrenees) AS BIGINT) AS ancien_languedoc_roussillon FROM results"""))
def former_region_split(spark, sf):
    return A.former_region_split(I.results(spark, sf))


@query("dashboard_metrics", sql=on_results("""SELECT count(*) AS total_records,
  count(DISTINCT annee) AS n_years, count(DISTINCT departement) AS n_departements,
  count(DISTINCT nuance) AS n_nuances, count(DISTINCT famille_politique) AS n_familles,
  min(annee) AS first_year, max(annee) AS last_year FROM results"""))
def dashboard_metrics(spark, sf):
    return A.dashboard_metrics(I.results(spark, sf))


@query("summary_stats", floats=["avg_participation"], sql=on_results(f"""SELECT count(*) AS total_records,
  array_to_string(list_sort(list(DISTINCT annee)), ',') AS years,
  array_to_string(list_sort(list(DISTINCT tour)), ',') AS tours,
  array_to_string(list_sort(list(DISTINCT departement)), ',') AS departments,
  count(DISTINCT nuance) AS nuances, CAST(sum(voix) AS BIGINT) AS total_voix,
  {M2('taux_participation')} AS avg_participation FROM results"""))
def summary_stats(spark, sf):
    return A.summary_stats(I.results(spark, sf))


DESCRIBE_COLS = ["taux_participation", "pct_exprimes", "voix", "inscrits"]


def _describe_sql(columns: list[str], src: str = "results") -> str:
    aggs, parts = [], []
    for i, c in enumerate(columns):
        x = f"CAST({c} AS DOUBLE)"
        exprs = [f"CAST(count({x}) AS DOUBLE)", f"avg({x})", f"stddev_samp({x})", f"min({x})",
                 f"quantile_cont({x}, 0.25)", f"quantile_cont({x}, 0.5)", f"quantile_cont({x}, 0.75)",
                 f"max({x})"]
        for j, (e, stat) in enumerate(zip(exprs, A.DESCRIBE_STATS)):
            aggs.append(f"{e} AS s{i}_{j}")
            parts.append(f"SELECT '{c}' AS \"column\", '{stat}' AS stat, s{i}_{j} AS value FROM w")
    return f"w AS (SELECT {', '.join(aggs)} FROM {src})\n" + "\nUNION ALL ".join(parts)


@query("describe", floats=["value"], sql=on_results(
    "SELECT * FROM (WITH " + _describe_sql(DESCRIBE_COLS) + ")"))
def describe(spark, sf):
    return A.describe(I.results(spark, sf), DESCRIBE_COLS)


@query("by_year", floats=["taux_participation"], sql=on_results(f"""SELECT annee,
  {M2('taux_participation')} AS taux_participation, CAST(sum(voix) AS BIGINT) AS voix,
  CAST(sum(inscrits) AS BIGINT) AS inscrits, CAST(sum(abstentions) AS BIGINT) AS abstentions
FROM results GROUP BY annee"""))
def by_year(spark, sf):
    return A.by_year(I.results(spark, sf))


@query("by_department_all_rows", floats=["taux_participation", "part_voix"], sql=on_enriched(f"""
SELECT departement, {M2('taux_participation')} AS taux_participation, {M2('pct_exprimes')} AS part_voix,
  CAST(sum(voix) AS BIGINT) AS voix, CAST(sum(inscrits) AS BIGINT) AS inscrits,
  {Q.DEPT_NAME} AS nom_departement
FROM enriched GROUP BY departement"""))
def by_department_all_rows(spark, sf):
    return A.by_department(I.enriched(spark, sf))


@query("by_year_all_rows", floats=["taux_participation"], sql=on_enriched(f"""SELECT annee,
  {M2('taux_participation')} AS taux_participation, CAST(sum(voix) AS BIGINT) AS voix,
  CAST(sum(inscrits) AS BIGINT) AS inscrits, CAST(sum(abstentions) AS BIGINT) AS abstentions
FROM enriched GROUP BY annee"""))
def by_year_all_rows(spark, sf):
    return A.by_year(I.enriched(spark, sf))


TOP8 = """top AS (SELECT nuance FROM results WHERE nuance IS NOT NULL GROUP BY nuance
  ORDER BY count(*) DESC, nuance LIMIT 8)"""


@query("label_evolution", floats=["part_voix"], sql=on_results(f"""SELECT * FROM (WITH {TOP8}
SELECT annee, nuance, CAST(sum(voix) AS BIGINT) AS voix, {M2('pct_exprimes')} AS part_voix
FROM results WHERE nuance IN (SELECT nuance FROM top) GROUP BY annee, nuance)"""))
def label_evolution(spark, sf):
    return A.label_evolution(I.results(spark, sf), 8)


@query("top_labels_only", sql=on_results(f"""SELECT * FROM (WITH {TOP8}
SELECT * FROM results WHERE nuance IN (SELECT nuance FROM top))"""))
def top_labels_only(spark, sf):
    return J.top_labels_only(I.results(spark, sf), 8)


@query("records_per_department", sql=on_results(
    "SELECT departement, count(*) AS n FROM results GROUP BY departement"))
def records_per_department(spark, sf):
    return A.records_per_department(I.results(spark, sf))


CORR_COLS = ["taux_participation", "taux_abstention", "pct_exprimes", "pct_inscrits", "voix",
             "inscrits", "votants"]


def _corr_long_sql(columns: list[str], src: str) -> str:
    aggs, parts = [], []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if j >= i:
                aggs.append(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c{i}_{j}")
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, c{min(i, j)}_{max(i, j)} AS r, "
                         f"{i} AS i, {j} AS j FROM w")
    return f"w AS (SELECT {', '.join(aggs)} FROM {src}), lng AS (" + " UNION ALL ".join(parts) + ")"


@query("correlation_matrix", floats=["r"], sql=on_results(
    "SELECT var1, var2, r FROM (WITH " + _corr_long_sql(CORR_COLS, "results") + " SELECT * FROM lng)"))
def correlation_matrix(spark, sf):
    return A.correlation_matrix(I.results(spark, sf), CORR_COLS)


@query("correlation_matrix_all_rows", floats=["r"], sql=on_enriched(
    "SELECT var1, var2, r FROM (WITH " + _corr_long_sql(CORR_COLS, "enriched") + " SELECT * FROM lng)"))
def correlation_matrix_all_rows(spark, sf):
    return A.correlation_matrix(I.enriched(spark, sf), CORR_COLS)


@query("top_correlations", floats=["correlation"], sql=on_results(
    "SELECT var1, var2, correlation FROM (WITH " + _corr_long_sql(CORR_COLS, "results")
    + " SELECT var1, var2, r AS correlation FROM lng WHERE j > i"
      " ORDER BY round_even(abs(r) * 1e10, 0) DESC NULLS LAST, i, j LIMIT 10)"))
def top_correlations(spark, sf):
    return A.top_correlations(I.results(spark, sf), CORR_COLS, 10)


HIST_SQL = """SELECT * FROM (WITH rng AS (SELECT min(CAST(taux_participation AS DOUBLE)) AS lo,
  max(CAST(taux_participation AS DOUBLE)) AS hi FROM results),
b AS (SELECT CAST(least(CASE WHEN (hi - lo) / 20 > 0
        THEN floor((CAST(taux_participation AS DOUBLE) - lo) / ((hi - lo) / 20)) ELSE 0 END, 19) AS INTEGER) AS bin,
      lo, hi FROM results, rng WHERE taux_participation IS NOT NULL)
SELECT bin, lo + bin * ((hi - lo) / 20) AS bin_start, lo + (bin + 1) * ((hi - lo) / 20) AS bin_end,
  count(*) AS n FROM b GROUP BY bin, lo, hi)"""


@query("histogram", floats=["bin_start", "bin_end"], sql=on_results(HIST_SQL))
def histogram(spark, sf):
    return A.histogram(I.results(spark, sf), "taux_participation", 20)


HIST_AUTO_SQL = """SELECT * FROM (WITH rng AS (SELECT min(CAST(pct_exprimes AS DOUBLE)) AS lo,
  max(CAST(pct_exprimes AS DOUBLE)) AS hi,
  greatest(ceil(log2(count(pct_exprimes))) + 1, 1) AS k FROM results),
b AS (SELECT CAST(least(CASE WHEN (hi - lo) / k > 0
        THEN floor((CAST(pct_exprimes AS DOUBLE) - lo) / ((hi - lo) / k)) ELSE 0 END, k - 1) AS INTEGER) AS bin,
      lo, hi, k FROM results, rng WHERE pct_exprimes IS NOT NULL)
SELECT bin, lo + bin * ((hi - lo) / k) AS bin_start, lo + (bin + 1) * ((hi - lo) / k) AS bin_end,
  count(*) AS n FROM b GROUP BY bin, lo, hi, k)"""


@query("histogram_auto_bins", floats=["bin_start", "bin_end"], sql=on_results(HIST_AUTO_SQL))
def histogram_auto_bins(spark, sf):
    return A.histogram(I.results(spark, sf), "pct_exprimes", None)


@query("actual_shares", floats=["pct_reel"], sql=on_results("""SELECT annee, departement, tour, nuance,
  CASE WHEN t > 0 THEN CAST(v AS DOUBLE) / t * 100 ELSE 0.0 END AS pct_reel
FROM (SELECT annee, departement, tour, nuance, sum(voix) AS v,
        sum(sum(voix)) OVER (PARTITION BY annee, departement, tour) AS t
      FROM results GROUP BY annee, departement, tour, nuance)"""))
def actual_shares(spark, sf):
    return A.actual_shares(I.results(spark, sf))


@query("distinct_labels", sql=on_results(
    "SELECT DISTINCT nuance FROM results WHERE nuance IS NOT NULL "
    "AND regexp_replace(regexp_replace(nuance, '^\\s+', ''), '\\s+$', '') <> ''"))
def distinct_labels(spark, sf):
    return A.distinct_labels(I.results(spark, sf))


@query("compare_tables", floats=["left", "right"], sql=on_results(
    "SELECT l.\"column\", l.stat, l.value AS \"left\", r.value AS \"right\" FROM "
    "(SELECT * FROM (WITH " + _describe_sql(["inscrits", "pct_exprimes", "taux_participation", "voix"],
                                            "(SELECT * FROM results WHERE tour = 1)") + ")) l "
    "FULL OUTER JOIN (SELECT * FROM (WITH " + _describe_sql(
        ["inscrits", "pct_exprimes", "taux_participation", "voix"], "(SELECT * FROM results WHERE tour = 2)")
    + ")) r ON l.\"column\" = r.\"column\" AND l.stat = r.stat"))
def compare_tables(spark, sf):
    r = I.results(spark, sf).select("inscrits", "pct_exprimes", "taux_participation", "voix", "tour")
    left = r.where(F.col("tour") == 1).drop("tour")
    right = r.where(F.col("tour") == 2).drop("tour")
    return A.compare_tables(left, right)


def _hist_side(side: str, where: str) -> str:
    return f"""SELECT '{side}' AS side, 'inscrits' AS "column", * FROM (
WITH src AS (SELECT * FROM results WHERE {where}),
rng AS (SELECT min(CAST(inscrits AS DOUBLE)) AS lo, max(CAST(inscrits AS DOUBLE)) AS hi FROM src),
b AS (SELECT CAST(least(CASE WHEN (hi - lo) / 20 > 0
        THEN floor((CAST(inscrits AS DOUBLE) - lo) / ((hi - lo) / 20)) ELSE 0 END, 19) AS INTEGER) AS bin,
      lo, hi FROM src, rng WHERE inscrits IS NOT NULL)
SELECT bin, lo + bin * ((hi - lo) / 20) AS bin_start, lo + (bin + 1) * ((hi - lo) / 20) AS bin_end,
  count(*) AS n FROM b GROUP BY bin, lo, hi)"""


@query("compare_histograms", floats=["bin_start", "bin_end"], sql=on_results(
    _hist_side("left", "tour = 1") + " UNION ALL " + _hist_side("right", "tour = 2")))
def compare_histograms(spark, sf):
    r = I.results(spark, sf).select("inscrits", "pct_exprimes", "taux_participation", "voix", "tour")
    return A.compare_histograms(r.where(F.col("tour") == 1).drop("tour"),
                                r.where(F.col("tour") == 2).drop("tour"))


@query("scatter_points", sql=on_results(
    "SELECT taux_participation, pct_exprimes AS part_voix, departement, voix, nuance FROM results"))
def scatter_points(spark, sf):
    return A.scatter_points(I.results(spark, sf))


@query("map_points", floats=["radius"], sql=on_results(f"""SELECT * FROM (WITH d AS (
  SELECT departement, {M2('taux_participation')} AS p, CAST(sum(voix) AS BIGINT) AS v
  FROM results GROUP BY departement),
dim(departement, nom, lat, lon) AS (VALUES {', '.join(
    f"({d}, '{S.DEPARTMENT_NAMES[d]}', {S.DEPARTMENT_COORDS[d][0]}, {S.DEPARTMENT_COORDS[d][1]})"
    for d in S.REGION_DEPARTMENTS)})
SELECT d.departement, dim.lat, dim.lon, d.p / 100.0 * 50 AS radius,
  printf('%02d - %s<br>Participation: %s%%<br>Voix: %s', d.departement, dim.nom,
         format('{{:,.1f}}', d.p / 100.0 * 100), format('{{:,d}}', d.v)) AS popup
FROM d JOIN dim USING (departement))"""))
def map_points(spark, sf):
    return E.with_map_point(A.by_department(I.results(spark, sf)))


@query("with_dimension", floats=["taux_participation", "part_voix"], sql=on_results(f"""SELECT * FROM (
WITH d AS (SELECT departement, {M2('taux_participation')} AS taux_participation,
  {M2('pct_exprimes')} AS part_voix, CAST(sum(voix) AS BIGINT) AS voix,
  CAST(sum(inscrits) AS BIGINT) AS inscrits, {Q.DEPT_NAME} AS nom_departement
  FROM results GROUP BY departement)
SELECT d.*, {Q.DEPT_NAME.replace('departement', 'd.departement')} AS departement_nom,
  d.departement IN ({Q.sql_list(S.MIDI_PYRENEES)}) AS ancien_midi_pyrenees,
  d.departement IN ({Q.sql_list(S.LANGUEDOC_ROUSSILLON)}) AS ancien_languedoc_roussillon,
  {Q.case_lookup('d.departement', {k: v[0] for k, v in S.DEPARTMENT_COORDS.items()}, None)} AS lat,
  {Q.case_lookup('d.departement', {k: v[1] for k, v in S.DEPARTMENT_COORDS.items()}, None)} AS lon
FROM d)"""))
def with_dimension(spark, sf):
    return J.with_dimension(A.by_department(I.results(spark, sf)))


@query("scan_order_limit", sql=on_enriched(f"""SELECT * FROM enriched
ORDER BY annee DESC, tour, departement, {Q.TIEBREAK} LIMIT 10000"""))
def scan_order_limit(spark, sf):
    return W.scan_order_limit(I.enriched(spark, sf), 10000, TD.TIEBREAK)


@query("preview", sql=on_results(f"""SELECT * FROM results
ORDER BY annee, tour, departement, voix DESC, {Q.TIEBREAK} LIMIT 20"""))
def preview(spark, sf):
    return W.preview(I.results(spark, sf), 20,
                     order=[F.col("annee"), F.col("tour"), F.col("departement"), F.col("voix").desc(),
                            *TD.TIEBREAK])
