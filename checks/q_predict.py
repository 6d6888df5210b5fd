"""Share prediction and backtest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqlbase as Q
from checks.registry import on, query
from scrutin import schema as S
from scrutin.operators import aggregates as A
from scrutin.operators import backtest as B
from scrutin.operators import clean as C
from scrutin.operators import joins as J
from scrutin.operators import predict as P
from scrutin.sources import testdata as TD

GRID_YEARS = [2022, 2027]
GRID_PARTICIPATION = [50.0, 68.5, 80.0]


# -- Spark inputs ------------------------------------------------------------------
def history(spark, sf):
    return P.load_history(TD.ballots(spark, sf))


def summary(spark, sf):
    return P.summarise_history(history(spark, sf), materialise=True)


def grid(spark, sf):
    return P.scenario_grid(history(spark, sf), GRID_YEARS, GRID_PARTICIPATION)


def predictions(spark, sf, reference_year="latest"):
    h = summary(spark, sf)
    return P.predict_shares(P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION), h,
                            reference_year=reference_year)


def backtest_rows(spark, sf):
    return B.backtest(I.results(spark, sf), history(spark, sf), tiebreak=TD.TIEBREAK, materialise=True)


# -- SQL pieces ------------------------------------------------------------------------
REGION = Q.REGION
BLANK = "regexp_replace(regexp_replace(nuance, '^\\s+', ''), '\\s+$', '')"

HIST_E9 = """history_e9 AS (SELECT *, coalesce(CAST(votants AS DOUBLE) / NULLIF(CAST(inscrits AS DOUBLE), 0) * 100, 0.0)
  AS taux_participation FROM history)"""

SHARES = """hshares AS (
  SELECT departement, annee, nuance, CAST(v AS DOUBLE) / t * 100 AS pct FROM (
    SELECT departement, annee, nuance, sum(voix) AS v,
      sum(sum(voix)) OVER (PARTITION BY departement, annee) AS t
    FROM history GROUP BY departement, annee, nuance) WHERE t > 0)"""


def trends_cte(reference_year: str) -> str:
    pick = "arg_max" if reference_year == "latest" else "arg_min"
    return f"""recent_rows AS (
  SELECT * EXCLUDE (r) FROM (SELECT *, max(CASE WHEN annee >= {S.RECENT_YEAR} THEN 1 ELSE 0 END)
    OVER (PARTITION BY departement) AS r FROM history) WHERE r = 0 OR annee >= {S.RECENT_YEAR}),
recent AS (
  SELECT departement, annee, nuance, CAST(v AS DOUBLE) / t * 100 AS pct FROM (
    SELECT departement, annee, nuance, sum(voix) AS v,
      sum(sum(voix)) OVER (PARTITION BY departement, annee) AS t
    FROM recent_rows GROUP BY departement, annee, nuance) WHERE t > 0),
trends AS (SELECT departement, nuance, avg(pct) AS avg_pct, {pick}(pct, annee) AS ref_pct,
  count(*) AS n_elections FROM recent GROUP BY departement, nuance)"""


REGIONAL = f"""rshares AS (
  SELECT annee, nuance, CAST(v AS DOUBLE) / t * 100 AS pct FROM (
    SELECT annee, nuance, sum(voix) AS v, sum(sum(voix)) OVER (PARTITION BY annee) AS t
    FROM history WHERE departement IN ({REGION}) GROUP BY annee, nuance) WHERE t > 0),
regional AS (SELECT nuance, avg(pct) AS avg_pct, count(*) AS n_elections FROM rshares GROUP BY nuance)"""

LABELS = f"labs AS (SELECT DISTINCT nuance FROM history WHERE nuance IS NOT NULL AND {BLANK} <> '')"


def _default_case(index: int, other) -> str:
    whens = " ".join(f"WHEN departement IN ({Q.sql_list(d)}) THEN {float(v[index])}"
                     for d, *v in S.SCENARIO_DEFAULTS)
    return f"CASE {whens} ELSE {float(other)} END"


def prepared(src: str) -> str:
    """R1 on a scenario CTE ``src`` -> ``scen``."""
    reg = _default_case(0, S.SCENARIO_DEFAULT_REGISTERED)
    part = _default_case(1, S.SCENARIO_DEFAULT_PARTICIPATION)
    return f"""scen_d AS (SELECT scenario_id, annee, departement, tour,
    coalesce(inscrits, CAST({reg} AS BIGINT)) AS inscrits,
    coalesce(taux_participation, {part}) AS taux_participation, is_urbain FROM {src}),
scen AS (SELECT *, CAST(floor(inscrits * taux_participation / 100) AS BIGINT) AS votants,
    inscrits - CAST(floor(inscrits * taux_participation / 100) AS BIGINT) AS abstentions,
    100.0 - taux_participation AS taux_abstention FROM scen_d)"""


def _grid_values() -> str:
    rows = [f"({y}, CAST({float(p)} AS DOUBLE), {str(u).lower()})" for y in GRID_YEARS for p in GRID_PARTICIPATION
            for u in (True, False)]
    return ", ".join(rows)


GRID = f"""gdepts AS (SELECT DISTINCT departement FROM history),
g(y, p, u) AS (VALUES {_grid_values()}),
scen0 AS (SELECT ((CAST(g.y AS BIGINT) * 1000 + d.departement) * 1000
      + CAST(round_even(g.p * 10, 0) AS BIGINT)) * 10 + CAST(g.u AS BIGINT) AS scenario_id,
    CAST(g.y AS INTEGER) AS annee, d.departement, 1 AS tour, CAST(NULL AS BIGINT) AS inscrits,
    g.p AS taux_participation, g.u AS is_urbain FROM gdepts d, g),
{prepared('scen0')}"""


def _rules_values() -> str:
    rows = []
    for rid, (label, depts, min_year, above, below, urban, mult) in enumerate(S.MULTIPLIER_RULES):
        for d in (depts or [None]):
            def typed(v, t):
                return f"CAST({'NULL' if v is None else (str(v).lower() if isinstance(v, bool) else v)} AS {t})"
            rows.append(f"({rid}, '{label}', {typed(d, 'INTEGER')}, {typed(min_year, 'INTEGER')}, "
                        f"{typed(above, 'DOUBLE')}, {typed(below, 'DOUBLE')}, {typed(urban, 'BOOLEAN')}, "
                        f"CAST({float(mult)} AS DOUBLE))")
    return ", ".join(rows)


FALLBACK_VALUES = ", ".join(f"('{l}', CAST({float(v)} AS DOUBLE))" for l, v in S.FALLBACK_SHARES)

CHAIN = f"""base_dept AS (SELECT s.scenario_id, t.nuance,
    greatest({S.BASE_SHARE_FLOOR}, t.avg_pct * {S.WEIGHT_MEAN} + t.ref_pct * {S.WEIGHT_REFERENCE}) AS base
  FROM scen s JOIN trends t ON s.departement = t.departement),
uncovered AS (SELECT scenario_id FROM scen WHERE scenario_id NOT IN (SELECT scenario_id FROM base_dept)),
nh AS (SELECT count(*) AS n FROM history),
nl AS (SELECT count(*) AS n FROM labs),
base_all AS (SELECT * FROM base_dept
  UNION ALL SELECT u.scenario_id, r.nuance, r.avg_pct FROM uncovered u, regional r, nh WHERE nh.n > 0
  UNION ALL SELECT u.scenario_id, l.nuance, CAST(100.0 AS DOUBLE) / nl.n FROM uncovered u, labs l, nh, nl
    WHERE nh.n = 0 AND nl.n > 0
  UNION ALL SELECT u.scenario_id, '{S.ERROR_LABEL}', CAST(100.0 AS DOUBLE) FROM uncovered u, nh, nl WHERE nh.n = 0 AND nl.n = 0),
rules(rule_id, nuance, rule_dept, min_year, part_above, part_below, urban, mult) AS (VALUES {_rules_values()}),
adj AS (SELECT b.scenario_id, b.nuance, b.base * coalesce(product(r.mult), 1.0) AS adj
  FROM base_all b JOIN scen s ON b.scenario_id = s.scenario_id
  LEFT JOIN rules r ON r.nuance = b.nuance
    AND (r.rule_dept IS NULL OR r.rule_dept = s.departement)
    AND (r.min_year IS NULL OR s.annee >= r.min_year)
    AND (r.part_above IS NULL OR s.taux_participation > r.part_above)
    AND (r.part_below IS NULL OR s.taux_participation < r.part_below)
    AND (r.urban IS NULL OR r.urban = s.is_urbain)
  GROUP BY b.scenario_id, b.nuance, b.base),
tot AS (SELECT scenario_id, sum(adj) AS t FROM adj GROUP BY scenario_id),
norm AS (SELECT a.scenario_id, a.nuance, greatest({S.FINAL_SHARE_FLOOR}, a.adj / tot.t * 100) AS pct
    FROM adj a JOIN tot ON a.scenario_id = tot.scenario_id WHERE tot.t > 0
  UNION ALL SELECT s.scenario_id, f.nuance, f.pct FROM scen s, (VALUES {FALLBACK_VALUES}) f(nuance, pct)
    WHERE s.scenario_id NOT IN (SELECT scenario_id FROM tot WHERE t > 0)),
kept AS (SELECT n.* FROM norm n, nl WHERE nl.n = 0 OR n.nuance IN (SELECT nuance FROM labs)),
pred AS (SELECT *, CAST(row_number() OVER (PARTITION BY scenario_id ORDER BY pct DESC, nuance) AS INTEGER)
  AS rang FROM kept)"""


def on_hist(*ctes: str, body: str) -> str:
    return on(Q.BALLOTS, Q.TYPED_CLEAN, Q.HISTORY, *ctes, body=body)


def on_pred(body: str, reference_year: str = "latest") -> str:
    return on_hist(SHARES, trends_cte(reference_year), REGIONAL, LABELS, GRID, CHAIN, body=body)


# -- A16 / A17 / A18 / F8 / E9 -------------------------------------------------------------
@query("label_shares_by_year", floats=["pct"], sql=on_hist(SHARES, body="SELECT * FROM hshares"))
def label_shares_by_year(spark, sf):
    return A.label_shares_by_year(history(spark, sf))


@query("historical_trends", floats=["avg_pct", "ref_pct"],
       sql=on_hist(SHARES, trends_cte("latest"), body="SELECT * FROM trends"))
def historical_trends(spark, sf):
    return A.historical_trends(history(spark, sf), "latest")


@query("historical_trends_earliest", floats=["avg_pct", "ref_pct"],
       sql=on_hist(SHARES, trends_cte("earliest"), body="SELECT * FROM trends"))
def historical_trends_earliest(spark, sf):
    return A.historical_trends(history(spark, sf), "earliest")


@query("regional_trends", floats=["avg_pct"], sql=on_hist(REGIONAL, body="SELECT * FROM regional"))
def regional_trends(spark, sf):
    return A.regional_trends(history(spark, sf))


@query("recent_or_all", floats=["taux_participation"], sql=on_hist(HIST_E9, body=f"""
SELECT * EXCLUDE (r) FROM (SELECT *, max(CASE WHEN annee >= {S.RECENT_YEAR} THEN 1 ELSE 0 END)
  OVER (PARTITION BY departement) AS r FROM history_e9) WHERE r = 0 OR annee >= {S.RECENT_YEAR}"""))
def recent_or_all(spark, sf):
    return C.recent_or_all(history(spark, sf), codes=S.REGION_DEPARTMENTS)


@query("history_participation", floats=["taux_participation"], sql=on_hist(HIST_E9, body="""
SELECT departement, annee, avg(taux_participation) AS taux_participation, count(*) AS n
FROM history_e9 GROUP BY departement, annee"""))
def history_participation(spark, sf):
    return history(spark, sf).groupBy("departement", "annee").agg(
        F.avg("taux_participation").alias("taux_participation"), F.count(F.lit(1)).alias("n"))


@query("known_labels", sql=on_hist(LABELS, body="SELECT * FROM labs"))
def known_labels(spark, sf):
    return P.known_labels(history(spark, sf))


# -- R1-R9 -------------------------------------------------------------------
@query("scenario_grid", floats=["taux_participation", "taux_abstention"],
       sql=on_hist(GRID, body="SELECT * FROM scen"))
def scenario_grid(spark, sf):
    return grid(spark, sf)


@query("base_shares", floats=["base"], sql=on_pred("SELECT * FROM base_dept"))
def base_shares(spark, sf):
    h = summary(spark, sf)
    return P.base_shares(P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION), A.historical_trends(h))


@query("base_with_fallback", floats=["base"], sql=on_pred("SELECT * FROM base_all"))
def base_with_fallback(spark, sf):
    h = summary(spark, sf)
    g = P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION)
    return P.base_with_fallback(g, h, P.known_labels(h), A.historical_trends(h))


@query("context_adjust", floats=["adj"], sql=on_pred("SELECT * FROM adj"))
def context_adjust(spark, sf):
    h = summary(spark, sf)
    g = P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION)
    base = P.base_with_fallback(g, h, P.known_labels(h), A.historical_trends(h))
    return P.context_adjust(base, g)


@query("normalised_shares", floats=["pct"], sql=on_pred("SELECT * FROM norm"))
def normalised_shares(spark, sf):
    h = summary(spark, sf)
    g = P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION)
    base = P.base_with_fallback(g, h, P.known_labels(h), A.historical_trends(h))
    return P.normalise_shares(P.context_adjust(base, g), g)


@query("predict_shares", floats=["pct"], sql=on_pred("SELECT * FROM pred"))
def predict_shares(spark, sf):
    return predictions(spark, sf)


@query("predict_shares_earliest", floats=["pct"], sql=on_pred("SELECT * FROM pred", "earliest"))
def predict_shares_earliest(spark, sf):
    return predictions(spark, sf, "earliest")


# Branches that the region's own history never reaches.
ALL_DEPTS = GRID.replace("SELECT DISTINCT departement FROM history", "SELECT DISTINCT departement FROM typed_clean")
NO_VOTES = Q.HISTORY.replace("SELECT * FROM typed_clean", "SELECT * REPLACE (voix * 0 AS voix) FROM typed_clean")
TOP_LABELS = """labs AS (SELECT nuance FROM history WHERE nuance IS NOT NULL GROUP BY nuance
  ORDER BY count(*) DESC, nuance LIMIT 8)"""


@query("predict_shares_all_departments", floats=["pct"], sql=on_hist(
    SHARES, trends_cte("latest"), REGIONAL, LABELS, ALL_DEPTS, CHAIN, body="SELECT * FROM pred"))
def predict_shares_all_departments(spark, sf):
    """Departments outside the region have no history: the regional means."""
    return P.predict_shares(P.scenario_grid(I.typed(spark, sf), GRID_YEARS, GRID_PARTICIPATION), summary(spark, sf))


@query("predict_shares_top_labels", floats=["pct"], sql=on_hist(
    SHARES, trends_cte("latest"), REGIONAL, TOP_LABELS, GRID, CHAIN, body="SELECT * FROM pred"))
def predict_shares_top_labels(spark, sf):
    """A label list smaller than the history."""
    h = summary(spark, sf)
    return P.predict_shares(P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION), h,
                            labels=A.top_values(history(spark, sf), "nuance", 8))


@query("predict_shares_no_votes", floats=["pct"], sql=on(
    Q.BALLOTS, Q.TYPED_CLEAN, NO_VOTES, SHARES, trends_cte("latest"), REGIONAL, LABELS, GRID, CHAIN,
    body="SELECT * FROM pred"))
def predict_shares_no_votes(spark, sf):
    """A history without any vote has no shares: the fixed table."""
    h = P.summarise_history(history(spark, sf).withColumn("voix", F.col("voix") * 0), materialise=True)
    return P.predict_shares(P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION), h)


@query("estimated_votes", floats=["pct"], sql=on_pred(f"""SELECT p.*,
  CAST(floor(floor(s.votants * {S.EXPRESSED_SHARE_OF_VOTERS}) * p.pct / 100) AS BIGINT) AS voix_estimees
FROM pred p JOIN scen s ON p.scenario_id = s.scenario_id"""))
def estimated_votes(spark, sf):
    h = summary(spark, sf)
    g = P.scenario_grid(h, GRID_YEARS, GRID_PARTICIPATION)
    return P.estimated_votes(P.predict_shares(g, h), g)


@query("confidence_band", floats=["pct_gagnant"], sql=on_pred(f"""SELECT scenario_id,
  nuance AS gagnant, pct AS pct_gagnant,
  CASE WHEN pct > {S.CONFIDENCE_HIGH} THEN 'elevee' WHEN pct > {S.CONFIDENCE_MEDIUM} THEN 'moderee'
       ELSE 'serree' END AS confiance
FROM pred WHERE rang = 1"""))
def confidence_band(spark, sf):
    return P.confidence_band(predictions(spark, sf))


def _notes_sql() -> str:
    dept = " ".join(f"WHEN departement IN ({Q.sql_list(d)}) THEN '{c}'" for c, d in S.NOTE_DEPARTMENTS)
    return f"""SELECT scenario_id, array_to_string(list_filter([
  CASE {dept} END,
  CASE WHEN annee >= {S.NOTE_FUTURE_YEAR} THEN 'projection' END,
  CASE WHEN taux_participation > {S.NOTE_HIGH_PARTICIPATION} THEN 'forte_participation'
       WHEN taux_participation < {S.NOTE_LOW_PARTICIPATION} THEN 'faible_participation' END],
  lambda x: x IS NOT NULL), ',') AS notes FROM scen"""


@query("context_notes", sql=on_hist(GRID, body=_notes_sql()))
def context_notes(spark, sf):
    return P.context_notes(grid(spark, sf))


@query("history_info", sql=on_hist(body=f"""SELECT '{S.DEFAULT_MODEL_NAME}' AS model_name, CAST(0.0 AS DOUBLE) AS accuracy,
  count(*) AS data_points, '{S.DEFAULT_YEARS_COVERED}' AS years_covered,
  {len(S.REGION_DEPARTMENTS)} AS departments FROM history"""))
def history_info(spark, sf):
    return P.history_info(history(spark, sf))


# -- R10-R12, J4, T1 ------------------------------------------------------------------
CONTESTS = f"""cs AS (SELECT (CAST(annee AS BIGINT) * 1000 + departement) * 10 + tour AS scenario_id,
    annee, departement, tour, coalesce(inscrits, {S.SCENARIO_DEFAULT_REGISTERED}) AS inscrits,
    coalesce(taux_participation, {S.SCENARIO_DEFAULT_PARTICIPATION}) AS taux_participation,
    departement IN ({Q.sql_list(S.BACKTEST_URBAN_DEPARTMENTS)}) AS is_urbain
  FROM (SELECT *, row_number() OVER (PARTITION BY annee, departement, tour
          ORDER BY voix DESC, {Q.TIEBREAK}) AS rn FROM results) WHERE rn = 1),
{prepared('cs')}"""

BT = f"""actual AS (SELECT (CAST(annee AS BIGINT) * 1000 + departement) * 10 + tour AS scenario_id, nuance,
    CASE WHEN t > 0 THEN CAST(v AS DOUBLE) / t * 100 ELSE 0.0 END AS pct_reel
  FROM (SELECT annee, departement, tour, nuance, sum(voix) AS v,
          sum(sum(voix)) OVER (PARTITION BY annee, departement, tour) AS t
        FROM results GROUP BY annee, departement, tour, nuance)),
cmp AS (SELECT coalesce(p.scenario_id, a.scenario_id) AS scenario_id, coalesce(p.nuance, a.nuance) AS nuance,
    coalesce(p.pct, 0.0) AS prediction, coalesce(a.pct_reel, 0.0) AS reel,
    p.scenario_id IS NOT NULL AS has_pred, a.scenario_id IS NOT NULL AS has_reel
  FROM pred p FULL OUTER JOIN actual a ON p.scenario_id = a.scenario_id AND p.nuance = a.nuance),
bt AS (SELECT s.annee, s.departement, s.tour, c.nuance,
    {Q.r2('c.prediction')} AS prediction, {Q.r2('c.reel')} AS reel,
    {Q.r2('abs(c.prediction - c.reel)')} AS ecart,
    CASE WHEN c.reel > 0 THEN abs(c.prediction - c.reel) / greatest(c.reel, 0.1) * 100 END AS ecart_relatif,
    CASE WHEN {Q.r2('abs(c.prediction - c.reel)')} < {S.ERROR_GOOD} THEN 'bon'
         WHEN {Q.r2('abs(c.prediction - c.reel)')} < {S.ERROR_FAIR} THEN 'moyen' ELSE 'fort' END AS niveau_ecart,
    c.prediction AS prediction_brute, c.reel AS reel_brut, c.has_pred, c.has_reel
  FROM cmp c JOIN scen s ON c.scenario_id = s.scenario_id)"""

KEYS = "annee, departement, tour"
SCORES = f"""stats AS (SELECT {KEYS}, {Q.mean2('ecart')} AS ecart_moyen, max(ecart) AS ecart_max,
    count(*) AS n_nuances FROM bt GROUP BY {KEYS}),
wp AS (SELECT {KEYS}, nuance AS gagnant_predit FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}
    ORDER BY prediction_brute DESC, nuance) AS rn FROM bt WHERE has_pred) WHERE rn = 1),
wa AS (SELECT {KEYS}, nuance AS gagnant_reel FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}
    ORDER BY reel_brut DESC, nuance) AS rn FROM bt WHERE has_reel) WHERE rn = 1),
scores AS (SELECT st.*, wp.gagnant_predit, wa.gagnant_reel,
    coalesce(wp.gagnant_predit = wa.gagnant_reel, false) AS gagnant_correct,
    100.0 - least(st.ecart_moyen * 2, 100.0) AS score_precision
  FROM stats st LEFT JOIN wp USING ({KEYS}) LEFT JOIN wa USING ({KEYS}))"""

VERDICT = f"""bw AS (SELECT {KEYS},
    arg_min(nuance, struct_pack(e := ecart, t0 := -reel, t1 := nuance)) AS meilleure,
    arg_min(nuance, struct_pack(e := -ecart, t0 := -reel, t1 := nuance)) AS pire
  FROM bt GROUP BY {KEYS})
SELECT sc.annee, sc.departement, sc.tour,
  CASE WHEN sc.ecart_moyen < {S.VERDICT_EXCELLENT} THEN 'excellente'
       WHEN sc.ecart_moyen < {S.VERDICT_FAIR} THEN 'correcte' ELSE 'a_ameliorer' END AS precision,
  bw.meilleure, bw.pire, sc.ecart_moyen > {S.VERDICT_FAIR} AS reco_ajuster,
  sc.ecart_max > {S.ERROR_LARGE} AS reco_gros_ecarts, NOT sc.gagnant_correct AS reco_gagnant
FROM scores sc LEFT JOIN bw USING ({KEYS})"""


def on_backtest(body: str) -> str:
    return on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, Q.TYPED_CLEAN, Q.HISTORY, SHARES,
              trends_cte("latest"), REGIONAL, LABELS, CONTESTS, CHAIN, BT, body=body)


BT_FLOATS = ["prediction", "reel", "ecart", "ecart_relatif", "prediction_brute", "reel_brut"]


@query("backtest", floats=BT_FLOATS, sql=on_backtest("SELECT * FROM bt"))
def backtest(spark, sf):
    return backtest_rows(spark, sf)


@query("backtest_scores", floats=["ecart_moyen", "score_precision"],
       sql=on_backtest(f"SELECT * FROM (WITH {SCORES} SELECT * FROM scores)"))
def backtest_scores(spark, sf):
    return B.backtest_scores(backtest_rows(spark, sf))


@query("backtest_verdict", sql=on_backtest(f"SELECT * FROM (WITH {SCORES}, {VERDICT})"))
def backtest_verdict(spark, sf):
    return B.backtest_verdict(backtest_rows(spark, sf))


@query("backtest_scenarios", floats=["taux_participation", "taux_abstention"],
       sql=on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, CONTESTS, body="SELECT * FROM scen"))
def backtest_scenarios(spark, sf):
    return P.prepare_scenarios(B.contest_scenarios(I.results(spark, sf), TD.TIEBREAK))


@query("key_union", sql=on_backtest("""SELECT DISTINCT nuance FROM (SELECT nuance FROM pred
  UNION ALL SELECT nuance FROM actual)"""))
def key_union(spark, sf):
    r = I.kept_results(spark, sf)
    h = summary(spark, sf)
    pred = P.predict_shares(P.prepare_scenarios(B.contest_scenarios(r, TD.TIEBREAK)), h)
    return J.key_union(pred, A.actual_shares(r))


# -- R10 with the tested year left out of the history (decision Q22) -------------------------
CHAIN_REST = CHAIN[CHAIN.index("rules(rule_id"):]

FOLDED = f"""folds AS (SELECT DISTINCT annee AS test_year FROM scen),
fhist AS (SELECT h.departement, h.annee, h.nuance, h.voix, f.test_year
  FROM history h JOIN folds f ON h.annee <> f.test_year),
frecent_rows AS (
  SELECT * EXCLUDE (r) FROM (SELECT *, max(CASE WHEN annee >= {S.RECENT_YEAR} THEN 1 ELSE 0 END)
    OVER (PARTITION BY test_year, departement) AS r FROM fhist) WHERE r = 0 OR annee >= {S.RECENT_YEAR}),
frecent AS (
  SELECT test_year, departement, annee, nuance, CAST(v AS DOUBLE) / t * 100 AS pct FROM (
    SELECT test_year, departement, annee, nuance, sum(voix) AS v,
      sum(sum(voix)) OVER (PARTITION BY test_year, departement, annee) AS t
    FROM frecent_rows GROUP BY test_year, departement, annee, nuance) WHERE t > 0),
ftrends AS (SELECT test_year, departement, nuance, avg(pct) AS avg_pct, arg_max(pct, annee) AS ref_pct
  FROM frecent GROUP BY test_year, departement, nuance),
frshares AS (
  SELECT test_year, annee, nuance, CAST(v AS DOUBLE) / t * 100 AS pct FROM (
    SELECT test_year, annee, nuance, sum(voix) AS v, sum(sum(voix)) OVER (PARTITION BY test_year, annee) AS t
    FROM fhist WHERE departement IN ({REGION}) GROUP BY test_year, annee, nuance) WHERE t > 0),
fregional AS (SELECT test_year, nuance, avg(pct) AS avg_pct FROM frshares GROUP BY test_year, nuance),
base_dept AS (SELECT s.scenario_id, t.nuance,
    greatest({S.BASE_SHARE_FLOOR}, t.avg_pct * {S.WEIGHT_MEAN} + t.ref_pct * {S.WEIGHT_REFERENCE}) AS base
  FROM scen s JOIN ftrends t ON s.departement = t.departement AND s.annee = t.test_year),
uncovered AS (SELECT scenario_id, annee AS test_year FROM scen
  WHERE scenario_id NOT IN (SELECT scenario_id FROM base_dept)),
fnh AS (SELECT test_year, count(*) AS n FROM fhist GROUP BY test_year),
nl AS (SELECT count(*) AS n FROM labs),
base_all AS (SELECT * FROM base_dept
  UNION ALL SELECT u.scenario_id, r.nuance, r.avg_pct FROM uncovered u
    JOIN fnh ON fnh.test_year = u.test_year JOIN fregional r ON r.test_year = u.test_year WHERE fnh.n > 0
  UNION ALL SELECT u.scenario_id, l.nuance, CAST(100.0 AS DOUBLE) / nl.n FROM uncovered u
    LEFT JOIN fnh ON fnh.test_year = u.test_year, labs l, nl WHERE coalesce(fnh.n, 0) = 0 AND nl.n > 0
  UNION ALL SELECT u.scenario_id, '{S.ERROR_LABEL}', CAST(100.0 AS DOUBLE) FROM uncovered u
    LEFT JOIN fnh ON fnh.test_year = u.test_year, nl WHERE coalesce(fnh.n, 0) = 0 AND nl.n = 0),
{CHAIN_REST}"""


@query("backtest_excluding_test_year", floats=BT_FLOATS, sql=on(
    Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, Q.TYPED_CLEAN, Q.HISTORY, LABELS, CONTESTS, FOLDED, BT,
    body="SELECT * FROM bt"))
def backtest_excluding_test_year(spark, sf):
    return B.backtest(I.results(spark, sf), history(spark, sf), tiebreak=TD.TIEBREAK, materialise=True,
                      exclude_test_year=True)
