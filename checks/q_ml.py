"""Classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqlbase as Q
from checks.registry import on, on_results, query
from scrutin import schema as S
from scrutin.operators import enrich as E
from scrutin.operators import joins as J
from scrutin.operators import ml as M
from scrutin.sources import testdata as TD

FEATS = list(S.MODEL_FEATURES)


def _features_sql() -> str:
    return f"""SELECT CAST(annee AS DOUBLE) AS annee, floor(CAST(annee AS DOUBLE) / 10) * 10 AS decennie,
  greatest(CAST(annee AS DOUBLE) - 2000, 0.0) AS depuis_2000,
  CAST(dense_rank() OVER (ORDER BY CAST(departement AS VARCHAR)) - 1 AS DOUBLE) AS departement_encoded,
  CAST(typologie = '{S.URBAN}' AS DOUBLE) AS is_urbain, CAST(ancien_midi_pyrenees AS DOUBLE) AS ancien_midi_pyrenees,
  coalesce(CAST(taux_participation AS DOUBLE), 0.0) AS taux_participation,
  coalesce(CAST(taux_abstention AS DOUBLE), 0.0) AS taux_abstention,
  coalesce(CAST(voix AS DOUBLE), 0.0) AS voix, coalesce(CAST(inscrits AS DOUBLE), 0.0) AS inscrits,
  coalesce(CAST(votants AS DOUBLE), 0.0) AS votants,
  coalesce(CAST(voix AS DOUBLE), 0.0) / (coalesce(CAST(inscrits AS DOUBLE), 0.0) + 1) AS influence,
  CAST(coalesce(CAST(taux_participation AS DOUBLE), 0.0) > {S.HIGH_PARTICIPATION} AS DOUBLE) AS participation_haute,
  CAST(coalesce(CAST(taux_participation AS DOUBLE), 0.0) < {S.LOW_PARTICIPATION} AS DOUBLE) AS participation_faible,
  CAST(tour AS DOUBLE) AS tour, coalesce(famille_politique, 'Inconnu') AS famille_politique,
  CAST(dense_rank() OVER (ORDER BY coalesce(famille_politique, 'Inconnu')) - 1 AS DOUBLE) AS label
FROM results"""


@query("model_features", floats=["influence"], sql=on_results(_features_sql()))
def model_features(spark, sf):
    return M.prepare_features(I.results(spark, sf))[0]


#: A standardised value is a quotient of sums over all rows, whose order differs between
#: the engines: its error of 1e-14 meets a rounding edge at 9 decimals every few tables.
STANDARDISED = 6


def _standardised_sql() -> str:
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in FEATS)
    rep = ", ".join(f"({c} - mu_{c}) / CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN 1.0 ELSE sd_{c} END AS {c}"
                    for c in FEATS)
    return f"""SELECT * FROM (WITH f AS ({_features_sql()}), st AS (SELECT {stats} FROM f)
SELECT f.* REPLACE ({rep}) FROM f, st)"""


@query("standardised_features", floats=FEATS, digits=STANDARDISED, sql=on_results(_standardised_sql()))
def standardised_features(spark, sf):
    f, names, _ = M.prepare_features(I.results(spark, sf))
    return M.standardise(f, names)


def _unit(keys) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', {parts}, '{S.SPLIT_SEED}')), 1, 8)) AS BIGINT)"
            " / 4294967296.0)")


SHARE = "least(0.3, greatest(0.1, 50.0 / (SELECT count(*) FROM results)))"
SPLIT = f"""SELECT {Q.TIEBREAK}, famille_politique,
  c > 1 AND u <= max(u) FILTER (WHERE i <= greatest(ceil({SHARE} * c), 1)) OVER (PARTITION BY famille_politique) AS is_test
FROM (SELECT *, count(*) OVER (PARTITION BY famille_politique) AS c,
        row_number() OVER (PARTITION BY famille_politique ORDER BY u) AS i
      FROM (SELECT *, {_unit(TD.TIEBREAK)} AS u FROM results))"""


@query("stratified_split", sql=on_results(SPLIT))
def stratified_split(spark, sf):
    f, _, _ = M.prepare_features(I.results(spark, sf), keep=TD.TIEBREAK)
    return M.stratified_split(f, "label", TD.TIEBREAK).select(*TD.TIEBREAK, "famille_politique", "is_test")


@query("random_split", sql=on_results(f"SELECT *, {_unit(TD.TIEBREAK)} < 0.2 AS is_test FROM results"))
def random_split(spark, sf):
    return M.random_split(I.results(spark, sf), TD.TIEBREAK, 0.2)


def fitted(spark, sf):
    """A fit of the tables as they are now; every query makes its own."""
    return M.train_and_select(I.results(spark, sf), TD.TIEBREAK)


@query("train_and_select")
def train_and_select(spark, sf):
    return fitted(spark, sf)[0]


@query("feature_importance")
def feature_importance(spark, sf):
    art = fitted(spark, sf)[1]
    return M.feature_importance(art["models"]["RandomForest"], art["features"])


def scores(spark, sf):
    art = fitted(spark, sf)[1]
    f, _, _ = M.prepare_features(I.results(spark, sf), keep=TD.TIEBREAK, departments=art["departments"],
                                 classes=art["classes"])
    return M.score(f, art["models"][art["best"] or "LogisticRegression"], art["classes"])


@query("model_scores")
def model_scores(spark, sf):
    return scores(spark, sf)


# What SQL can state of the fits: sizes, names, and what must hold of every value.
@query("train_and_select_facts", sql=on_results(f"""SELECT * FROM (WITH sp AS ({SPLIT}),
n AS (SELECT count_if(NOT is_test) AS n_train, count_if(is_test) AS n_test,
  CAST(count(DISTINCT famille_politique) AS INTEGER) AS n_classes FROM sp)
SELECT m.model, CAST(n_train AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test,
  {len(FEATS)} AS n_features, n_classes, TRUE AS accuracy_in_range, TRUE AS best_is_highest
FROM n, (VALUES ('RandomForest'), ('LogisticRegression')) m(model))"""))
def train_and_select_facts(spark, sf):
    t = fitted(spark, sf)[0]
    top = t.agg(F.max("accuracy")).scalar()
    return t.select("model", "n_train", "n_test", "n_features", "n_classes",
                    F.col("accuracy").between(0, 1).alias("accuracy_in_range"),
                    (~F.col("is_best") | (F.col("accuracy") == top)).alias("best_is_highest"))


@query("feature_importance_facts", floats=["total"], sql=on_results(
    "SELECT f.feature, TRUE AS in_range, 1.0::DOUBLE AS total FROM (VALUES "
    + ", ".join(f"('{c}')" for c in FEATS) + ") f(feature) WHERE EXISTS (SELECT 1 FROM results)"))
def feature_importance_facts(spark, sf):
    imp = feature_importance(spark, sf)
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                      imp.agg(F.sum("importance")).scalar().alias("total"))


@query("model_scores_facts", floats=["total"], sql=on_results(f"""SELECT {Q.TIEBREAK}, famille_politique,
  (SELECT count(DISTINCT famille_politique) FROM results) AS n_classes, 1.0::DOUBLE AS total,
  TRUE AS predicted_is_likeliest FROM results"""))
def model_scores_facts(spark, sf):
    p = F.map_values("probabilites")
    return scores(spark, sf).select(
        *TD.TIEBREAK, "famille_politique", F.size("probabilites").cast("long").alias("n_classes"),
        F.aggregate(p, F.lit(0.0), lambda a, x: a + x).alias("total"),
        ((F.element_at("probabilites", F.col("classe_predite")) == F.array_max(p))
         & (F.col("confiance") == F.array_max(p))).alias("predicted_is_likeliest"))


# Two-class scores for M12/M13: document quality against a length score.
DOCS = """docs AS (SELECT l.quality AS actual, d.n_chars / (d.n_chars + 5000.0) AS score,
  CAST(d.n_chars / (d.n_chars + 5000.0) >= 0.5 AS INTEGER) AS predicted
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def docs(spark, sf):
    lab = TD.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("actual"))
    doc = TD.table(spark, sf, "documents").select("doc_id", "n_chars")
    s = F.col("n_chars") / (F.col("n_chars") + F.lit(5000.0))
    return lab.join(doc, on="doc_id").select("actual", s.alias("score"),
                                             (s >= 0.5).cast("int").alias("predicted"))


@query("confusion_matrix", sql=on(DOCS, body="""SELECT * FROM (WITH c AS (
  SELECT actual AS x FROM docs UNION SELECT predicted FROM docs),
k AS (SELECT actual, predicted, count(*) AS n FROM docs GROUP BY actual, predicted)
SELECT a.x AS actual, p.x AS predicted, coalesce(k.n, 0) AS n FROM c a CROSS JOIN c p
LEFT JOIN k ON k.actual = a.x AND k.predicted = p.x WHERE a.x IS NOT NULL AND p.x IS NOT NULL)"""))
def confusion_matrix(spark, sf):
    return M.confusion_matrix(docs(spark, sf), "actual", "predicted")


ROC = """per AS (SELECT score, sum(actual) AS p, sum(1 - actual) AS n FROM docs GROUP BY score),
tot AS (SELECT sum(p) AS tp, sum(n) AS tn FROM per),
cum AS (SELECT score, sum(p) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
  sum(n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn FROM per),
curve AS (SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
  UNION ALL SELECT CAST(score AS DOUBLE), CAST(cn AS DOUBLE) / tn, CAST(cp AS DOUBLE) / tp FROM cum, tot)"""


@query("roc_curve", floats=["threshold", "fpr", "tpr"],
       sql=on(DOCS, body=f"SELECT * FROM (WITH {ROC} SELECT * FROM curve)"))
def roc_curve(spark, sf):
    return M.roc_curve(docs(spark, sf), "actual", "score")


@query("roc_auc", floats=["auc"], sql=on(DOCS, body=f"""SELECT * FROM (WITH {ROC}
SELECT sum(dx * h) AS auc FROM (SELECT fpr - coalesce(lag(fpr) OVER w, 0.0) AS dx,
  (tpr + coalesce(lag(tpr) OVER w, 0.0)) / 2 AS h FROM curve WINDOW w AS (ORDER BY threshold DESC)))"""))
def roc_auc(spark, sf):
    return M.roc_auc(docs(spark, sf), "actual", "score")


SOCIO_FEATS = list(S.SOCIO_FEATURES)


def _socio_feature_sql() -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in S.SOCIO_INDICATORS)
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in SOCIO_FEATS)
    rep = ", ".join(f"({c} - mu_{c}) / CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN 1.0 ELSE sd_{c} END AS {c}"
                    for c in SOCIO_FEATS)
    return f"""SELECT * FROM (WITH m AS (SELECT DEP AS departement, {means} FROM socio GROUP BY DEP),
x AS (SELECT r.{', r.'.join(TD.TIEBREAK)},
  CAST(r.votants AS DOUBLE) / NULLIF(CAST(r.inscrits AS DOUBLE), 0) AS participation_rate,
  {', '.join('m.' + c for c in S.SOCIO_INDICATORS)}, r.famille_politique
  FROM results r LEFT JOIN m ON r.departement = m.departement),
st AS (SELECT {stats} FROM x)
SELECT x.* REPLACE ({rep}),
  CAST(dense_rank() OVER (ORDER BY coalesce(x.famille_politique, 'Inconnu')) - 1 AS DOUBLE) AS label
FROM x, st)"""


@query("socio_features", floats=SOCIO_FEATS, digits=STANDARDISED,
       sql=on(Q.BALLOTS, Q.TYPED, Q.ENRICHED, Q.RESULTS, Q.SOCIO, body=_socio_feature_sql()))
def socio_features(spark, sf):
    base = J.join_socio(E.with_raw_rates(I.results(spark, sf)), TD.socio(spark, sf))
    return M.prepare_socio_features(base, "famille_politique", keep=TD.TIEBREAK)[0]
