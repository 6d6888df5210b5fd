"""Sources, cleaning, filters, enrichment joins and pipelines
(S3, S4, S8, S9, P1-P4, P6-P11, P13, F2, F7, F9, E6, E7, J1-J3, T3, L3, L4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqlbase as Q
from checks.registry import on, on_results, query
from scrutin import schema as S
from scrutin.operators import clean as C
from scrutin.operators import enrich as E
from scrutin.operators import joins as J
from scrutin.operators import ordering as W
from scrutin.plans import analyze as L4
from scrutin.plans import preprocess as L
from scrutin.plans import summaries as SM
from scrutin.sources import catalog as K
from scrutin.sources import columns as R
from scrutin.sources import testdata as TD

TB = Q.TIEBREAK
SOCIO_FLOATS = list(S.SOCIO_INDICATORS)


def socio(spark, sf):
    return TD.socio(spark, sf)


# -- S3 / S4 / S8 / S9 ----------------------------------------------------------------
ENGLISH = {"annee": "election_year", "tour": "round", "departement": "code_dept", "nuance": "party",
           "voix": "nb_voix", "inscrits": "registered", "votants": "voters"}


@query("resolve_columns", sql=on(Q.BALLOTS, body="""SELECT annee, tour, departement, nuance, voix,
  inscrits, votants, CAST(0 AS BIGINT) AS abstentions, CAST(0 AS BIGINT) AS exprimes FROM ballots"""))
def resolve_columns(spark, sf):
    b = TD.ballots(spark, sf).select(*[F.col(k).alias(v) for k, v in ENGLISH.items()])
    return R.resolve_columns(b)


@query("list_elections", sql=on(Q.BALLOTS, body="SELECT DISTINCT annee, tour FROM ballots"))
def list_elections(spark, sf):
    return K.list_elections(TD.ballots(spark, sf))


RAW_COLUMNS = ("l_orderkey:bigint,l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,"
               "l_extendedprice:double,Année:string,TOUR:string,Departement:string,Nuance:string,"
               "INSCRITS:string,Votants:string,abstentions:string,EXPRIMES:string,Voix:string")


@query("table_profile", sql=on(Q.BALLOTS, Q.RAW, body=f"""SELECT 'ballots_raw' AS table_name,
  count(*) AS total_records, CAST(count_if(TRY_CAST("Departement" AS INTEGER) IN (31, 34, 30)) AS BIGINT)
  AS sample_records, 14 AS total_columns, '{RAW_COLUMNS}' AS columns FROM raw"""))
def table_profile(spark, sf):
    raw = I.raw(spark, sf)
    return K.table_profile(raw.withColumnRenamed("Departement", "departement"), "ballots_raw") \
            .withColumn("columns", F.lit(K.column_list(raw)))


# -- P1-P4 / P13 ---------------------------------------------------------------------
@query("clean_columns", sql=on(Q.BALLOTS, Q.TYPED, body="SELECT * FROM typed"))
def clean_columns(spark, sf):
    return L.clean_columns(I.raw(spark, sf))


@query("department_code_text", sql=on(Q.BALLOTS, Q.RAW, body=f"""SELECT {TB},
  CASE WHEN TRY_CAST("Departement" AS DOUBLE) IS NULL THEN NULL
       ELSE lpad(CAST(CAST(TRY_CAST("Departement" AS DOUBLE) AS INTEGER) AS VARCHAR), 2, '0') END
  AS departement FROM raw"""))
def department_code_text(spark, sf):
    r = C.rename_synonyms(I.raw(spark, sf))
    return C.department_code(r, as_text=True).select(*TD.TIEBREAK, "departement")


@query("minimal_clean", sql=on(Q.BALLOTS, Q.RAW, body=f"""SELECT l_orderkey, l_linenumber, l_partkey,
  l_suppkey, l_extendedprice,
  CAST(coalesce(TRY_CAST("Année" AS DOUBLE), 0) AS BIGINT) AS annee,
  CAST(coalesce(TRY_CAST("TOUR" AS DOUBLE), 0) AS BIGINT) AS tour,
  CAST(TRY_CAST("Departement" AS DOUBLE) AS INTEGER) AS departement, "Nuance" AS nuance,
  CAST(coalesce(TRY_CAST("INSCRITS" AS DOUBLE), 0) AS BIGINT) AS inscrits,
  CAST(coalesce(TRY_CAST("Votants" AS DOUBLE), 0) AS BIGINT) AS votants,
  CAST(coalesce(TRY_CAST(abstentions AS DOUBLE), 0) AS BIGINT) AS abstentions,
  CAST(coalesce(TRY_CAST("EXPRIMES" AS DOUBLE), 0) AS BIGINT) AS exprimes,
  CAST(coalesce(TRY_CAST("Voix" AS DOUBLE), 0) AS BIGINT) AS voix
FROM raw WHERE CAST(TRY_CAST("Departement" AS DOUBLE) AS INTEGER) IN ({Q.REGION})"""))
def minimal_clean(spark, sf):
    return C.minimal_clean(C.rename_synonyms(I.raw(spark, sf)))


# -- E6 + P6 / P7 / P8 / P9-P11 -----------------------------------------------------------
@query("raw_rates_clipped", floats=["participation_rate", "abstention_rate", "vote_share"],
       sql=on(Q.BALLOTS, Q.TYPED_CLEAN, body="""SELECT *,
  least(greatest(CAST(votants AS DOUBLE) / NULLIF(CAST(inscrits AS DOUBLE), 0), 0.0), 1.0) AS participation_rate,
  least(greatest(1.0 - CAST(votants AS DOUBLE) / NULLIF(CAST(inscrits AS DOUBLE), 0), 0.0), 1.0) AS abstention_rate,
  CAST(voix AS DOUBLE) / NULLIF(CAST(exprimes AS DOUBLE), 0) AS vote_share
FROM typed_clean"""))
def raw_rates_clipped(spark, sf):
    df = E.with_raw_rates(I.typed(spark, sf))
    return C.clip(df, C.default_rate_bounds(df))


DIM_COORDS = ", ".join(f"({d}, {S.DEPARTMENT_COORDS[d][0]}, {S.DEPARTMENT_COORDS[d][1]})"
                       for d in S.REGION_DEPARTMENTS)


@query("impute_coordinates", sql=on(Q.BALLOTS, body=f"""SELECT * FROM (
WITH dim(departement, lat, lon) AS (VALUES {DIM_COORDS}),
j AS (SELECT b.l_orderkey, b.l_linenumber, b.l_partkey, b.l_suppkey, b.l_extendedprice, b.departement,
        CAST(dim.lat AS DOUBLE) AS lat, CAST(dim.lon AS DOUBLE) AS lon
      FROM ballots b LEFT JOIN dim ON b.departement = dim.departement),
m AS (SELECT quantile_cont(lat, 0.5) AS mlat, quantile_cont(lon, 0.5) AS mlon FROM j)
SELECT j.* REPLACE (coalesce(lat, mlat) AS lat, coalesce(lon, mlon) AS lon) FROM j, m)"""))
def impute_coordinates(spark, sf):
    b = TD.ballots(spark, sf).select(*TD.TIEBREAK, "departement")
    dim = F.broadcast(E.department_dim(spark).select("departement", "lat", "lon"))
    return C.impute_median(b.join(dim, on="departement", how="left"), ["lat", "lon"])


@query("winsorize_counts", floats=["voix", "inscrits"], sql=on(Q.BALLOTS, body=f"""SELECT * FROM (
WITH q AS (SELECT quantile_cont(CAST(voix AS DOUBLE), 0.01) AS vlo, quantile_cont(CAST(voix AS DOUBLE), 0.99) AS vhi,
  quantile_cont(CAST(inscrits AS DOUBLE), 0.01) AS ilo, quantile_cont(CAST(inscrits AS DOUBLE), 0.99) AS ihi
  FROM ballots)
SELECT {TB}, departement,
  CASE WHEN voix < vlo THEN vlo WHEN voix > vhi THEN vhi ELSE CAST(voix AS DOUBLE) END AS voix,
  CASE WHEN inscrits < ilo THEN ilo WHEN inscrits > ihi THEN ihi ELSE CAST(inscrits AS DOUBLE) END AS inscrits
FROM ballots, q)"""))
def winsorize_counts(spark, sf):
    b = TD.ballots(spark, sf).select(*TD.TIEBREAK, "departement", "voix", "inscrits")
    return C.winsorize(b, ["voix", "inscrits"])


def _clean_socio_sql() -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}"
                   for c in S.SOCIO_INDICATORS)
    rep = ", ".join(f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END AS {c}"
                    for c in S.SOCIO_INDICATORS)
    return f"""SELECT * FROM (WITH d AS (SELECT DISTINCT * FROM socio),
q AS (SELECT {qs} FROM d)
SELECT d.* REPLACE ({rep}) FROM d, q)"""


@query("clean_table_socio", floats=SOCIO_FLOATS, sql=on(Q.SOCIO, body=_clean_socio_sql()))
def clean_table_socio(spark, sf):
    return C.clean_table(socio(spark, sf), exclude=("annee", "tour", "id", "departement", "DEP"))


# The socio rows with every seventh unemployment missing, a fractional rate
# beyond [0, 1], each tenth row twice and an empty row for each fiftieth.
DIRTY_COLS = ["DEP", "COM", "LIBCOM", *S.SOCIO_INDICATORS, "annee"]
DIRTY = f"""keyed AS (SELECT *, CAST(COM AS BIGINT) AS k FROM socio),
dirty0 AS (SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 7 = 0 THEN NULL ELSE taux_chomage END AS taux_chomage),
  CAST(k % 150 - 10 AS DOUBLE) / 100 AS growth_rate, k FROM keyed),
dirty AS (SELECT * EXCLUDE (k) FROM dirty0 UNION ALL SELECT * EXCLUDE (k) FROM dirty0 WHERE k % 10 = 0
  UNION ALL SELECT {', '.join('NULL' for _ in [*DIRTY_COLS, 'growth_rate'])} FROM dirty0 WHERE k % 50 = 0)"""
DIRTY_RATES = [*S.SOCIO_INDICATORS, "growth_rate"]


def _clean_dirty_sql() -> str:
    clipped = "least(greatest(growth_rate, 0.0), 1.0) AS growth_rate"
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in DIRTY_RATES)
    fill = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in DIRTY_RATES)
    qs = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in DIRTY_RATES)
    rep = ", ".join(f"least(greatest({c}, lo_{c}), hi_{c}) AS {c}" for c in DIRTY_RATES)
    return f"""SELECT * FROM (WITH {DIRTY},
d AS (SELECT DISTINCT * REPLACE ({clipped}) FROM dirty WHERE COM IS NOT NULL),
f AS (SELECT d.* REPLACE ({fill}) FROM d, (SELECT {med} FROM d) AS m),
q AS (SELECT {qs} FROM f)
SELECT f.* REPLACE (CAST(DEP AS DOUBLE) AS DEP, CAST(annee AS DOUBLE) AS annee, {rep}) FROM f, q)"""


@query("clean_table_dirty", floats=DIRTY_RATES, sql=on(Q.SOCIO, body=_clean_dirty_sql()))
def clean_table_dirty(spark, sf):
    k = F.col("COM").cast("long")
    base = socio(spark, sf).withColumns({"taux_chomage": F.when(k % 7 != 0, F.col("taux_chomage")),
                                         "growth_rate": (k % 150 - 10).cast("double") / 100})
    empty = base.where(k % 50 == 0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema])
    return C.clean_table(base.unionByName(base.where(k % 10 == 0)).unionByName(empty),
                         exclude=("annee", "tour", "id", "departement", "DEP"))


# W2
@query("share_of_total", floats=["pct"], sql=on(Q.BALLOTS, Q.TYPED_CLEAN, body="""SELECT *,
  CASE WHEN sum(voix) OVER w <> 0 THEN CAST(voix AS DOUBLE) / sum(voix) OVER w * 100 ELSE 0.0 END AS pct
FROM typed_clean WINDOW w AS (PARTITION BY annee, tour, departement)"""))
def share_of_total(spark, sf):
    return W.share_of_total(I.typed(spark, sf), "voix", S.CONTEST_KEYS)


@query("distinct_contest_labels", sql=on(Q.BALLOTS, Q.TYPED_CLEAN, body="""SELECT DISTINCT annee, tour,
  departement, nuance FROM typed_clean"""))
def distinct_contest_labels(spark, sf):
    return C.drop_duplicates(C.drop_empty_rows(I.typed(spark, sf).select("annee", "tour", "departement",
                                                                          "nuance")))


# -- F2 / F7 / F9 ---------------------------------------------------------------------
@query("for_elections", sql=on(Q.BALLOTS, Q.TYPED_CLEAN, body="""SELECT * FROM typed_clean
WHERE annee IN (2017, 2018) AND tour IN (1)"""))
def for_elections(spark, sf):
    return C.for_elections(I.typed(spark, sf), years=[2017, 2018], rounds=[1])


VALID = (f"annee IS NOT NULL AND departement IS NOT NULL AND tour IS NOT NULL AND departement IN ({Q.REGION}) "
         f"AND annee BETWEEN {S.MIN_YEAR} AND {S.MAX_YEAR} AND tour IN (1, 2) AND voix >= 0 "
         "AND inscrits >= 0 AND votants >= 0 AND abstentions >= 0 AND exprimes >= 0")


@query("validation_counts", sql=on(Q.BALLOTS, Q.TYPED, body=f"""SELECT count(*) AS rows_in,
  CAST(count_if(coalesce({VALID}, false)) AS BIGINT) AS rows_valid FROM typed"""))
def validation_counts(spark, sf):
    t = L.clean_columns(I.raw(spark, sf))
    return t.agg(F.count(F.lit(1)).alias("rows_in"),
                 F.count_if(F.coalesce(C.validation_predicate(t), F.lit(False))).alias("rows_valid"))


@query("select_contest", sql=on_results("SELECT * FROM results WHERE annee = 2017 AND departement = 31 AND tour = 1"))
def select_contest(spark, sf):
    return C.select_contest(I.results(spark, sf), 2017, 31, 1)


@query("rounds_for_year", sql=on_results("SELECT DISTINCT tour FROM results WHERE annee = 2017"))
def rounds_for_year(spark, sf):
    return C.rounds_for_year(I.results(spark, sf), 2017)


@query("contests_present", sql=on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, Q.TYPED_CLEAN, body="""
SELECT * FROM typed_clean e WHERE EXISTS (SELECT 1 FROM results r WHERE r.annee = e.annee
  AND r.departement = e.departement AND r.tour = e.tour)"""))
def contests_present(spark, sf):
    return C.contests_present(I.typed(spark, sf), I.results(spark, sf))


# -- E7 / J1 / J2 / J3 / T3 ---------------------------------------------------------------
def _bins_sql(column: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {column} > {lo} AND {column} <= {hi} THEN '{n}'"
                     for lo, hi, n in zip(edges[:-1], edges[1:], labels))
    return f"CASE {parts} END"


@query("socio_bins", sql=on(Q.SOCIO, body=f"""SELECT *,
  {_bins_sql('taux_pauvrete', *S.POVERTY_BINS)} AS niveau_precarite,
  {_bins_sql('revenu_median', *S.INCOME_BINS)} AS niveau_revenu,
  {_bins_sql('densite_population', *S.DENSITY_BINS)} AS type_territoire FROM socio"""))
def socio_bins(spark, sf):
    return E.with_socio_bins(socio(spark, sf))


def _socio_means(suffix: str = "", where: str = "") -> str:
    cols = ", ".join(f"avg({c}) AS {c}{suffix}" for c in S.SOCIO_INDICATORS)
    return f"SELECT DEP AS departement, {cols} FROM socio {where} GROUP BY DEP"


@query("join_socio", floats=SOCIO_FLOATS, sql=on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, Q.SOCIO,
       body=f"SELECT r.*, s.* EXCLUDE (departement) FROM results r LEFT JOIN ({_socio_means()}) s "
            "ON r.departement = s.departement"))
def join_socio(spark, sf):
    return J.join_socio(I.results(spark, sf), socio(spark, sf))


LEG = ("SELECT departement, avg(inscrits) AS inscrits_leg, avg(votants) AS votants_leg, "
       "avg(abstentions) AS abstentions_leg FROM results WHERE tour = 2 GROUP BY departement")


@query("join_legislative", floats=["inscrits_leg", "votants_leg", "abstentions_leg"],
       sql=on_results(f"SELECT r.*, l.* EXCLUDE (departement) FROM results r "
                      f"LEFT JOIN ({LEG}) l ON r.departement = l.departement"))
def join_legislative(spark, sf):
    r = I.results(spark, sf)
    return J.join_legislative(r, r.where(F.col("tour") == 2))


MERGE_FLOATS = ([f"{c}_2012" for c in S.SOCIO_INDICATORS] + [f"{c}_2017" for c in S.SOCIO_INDICATORS]
                + ["inscrits_leg", "votants_leg", "abstentions_leg"])


@query("merge_datasets", floats=MERGE_FLOATS, sql=on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, Q.SOCIO, body=f"""
SELECT r.*, a.* EXCLUDE (departement), b.* EXCLUDE (departement), l.* EXCLUDE (departement) FROM results r
LEFT JOIN ({_socio_means('_2012', 'WHERE annee = 2012')}) a ON r.departement = a.departement
LEFT JOIN ({_socio_means('_2017', 'WHERE annee = 2017')}) b ON r.departement = b.departement
LEFT JOIN ({LEG}) l ON r.departement = l.departement"""))
def merge_datasets(spark, sf):
    r = I.kept_results(spark, sf)
    so = socio(spark, sf)
    return J.merge_datasets({
        "presidentielle_2022": r,
        "socio_2012": so.where(F.col("annee") == 2012),
        "socio_2017": so.where(F.col("annee") == 2017),
        "legislative_2018": r.where(F.col("tour") == 2),
    })


@query("stack_datasets", sql=on_results("""
SELECT *, 'legislative' AS election_type, 2017 AS annee_source FROM results WHERE tour = 1
UNION ALL
SELECT *, 'presidentielle' AS election_type, 2022 AS annee_source FROM results WHERE tour = 2"""))
def stack_datasets(spark, sf):
    r = I.results(spark, sf)
    return J.stack_datasets({"legislative_2017": r.where(F.col("tour") == 1),
                             "presidentielle_2022": r.where(F.col("tour") == 2)})


# -- L4 / L3 ------------------------------------------------------------------------
def _analyze_sql() -> str:
    parts = []
    for col, n in (("departement", 5), ("nuance", 5), ("famille_politique", 5), ("typologie", None)):
        lim = f" LIMIT {n}" if n else ""
        parts.append(f"SELECT * FROM (SELECT '{col}' AS analyse, CAST({col} AS VARCHAR) AS cle, "
                     f"CAST(count(*) AS DOUBLE) AS valeur FROM results WHERE {col} IS NOT NULL GROUP BY {col} "
                     f"ORDER BY count(*) DESC, {col}{lim})")
    parts.append("SELECT 'annee' AS analyse, CAST(annee AS VARCHAR) AS cle, CAST(count(*) AS DOUBLE) AS valeur "
                 "FROM results GROUP BY annee")
    parts.append("SELECT 'ancienne_region' AS analyse, 'ancien_midi_pyrenees' AS cle, "
                 "CAST(count_if(ancien_midi_pyrenees) AS DOUBLE) AS valeur FROM results")
    parts.append("SELECT 'ancienne_region' AS analyse, 'ancien_languedoc_roussillon' AS cle, "
                 "CAST(count(*) - count_if(ancien_midi_pyrenees) AS DOUBLE) AS valeur FROM results")
    parts.append(f"SELECT 'participation' AS analyse, 'moyenne' AS cle, {Q.mean2('taux_participation')} "
                 "AS valeur FROM results")
    return " UNION ALL ".join(parts)


@query("analyze", floats=["valeur"], sql=on_results(_analyze_sql()))
def analyze(spark, sf):
    return L4.analyze(I.results(spark, sf))


@query("analyze_from_summary", floats=["valeur"], sql=on_results(_analyze_sql()))
def analyze_from_summary(spark, sf):
    return L4.analyze(SM.summarise(I.results(spark, sf)))


@query("by_department_from_summary", floats=["taux_participation", "part_voix"], sql=on_results(f"""
SELECT departement, {Q.mean2('taux_participation')} AS taux_participation, {Q.mean2('pct_exprimes')} AS part_voix,
  CAST(sum(voix) AS BIGINT) AS voix, CAST(sum(inscrits) AS BIGINT) AS inscrits, {Q.DEPT_NAME} AS nom_departement
FROM results GROUP BY departement"""))
def by_department_from_summary(spark, sf):
    return SM.by_department(SM.summarise(I.results(spark, sf)))


@query("analysis_report", sql=on_results(
    f'SELECT "analyse", count(*) AS n_lignes FROM ({_analyze_sql()}) AS a GROUP BY "analyse"'))
def analysis_report(spark, sf):
    return L4.analysis_report(L4.analyze(I.results(spark, sf)))
