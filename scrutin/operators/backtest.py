"""Backtest of the share predictor over every contest at once.

A contest is (year, department, round).  Its scenario comes from its first
row in the results order (votes descending, then the caller's tie-break);
the prediction is R6, the truth is A15, and the two meet in a full outer
join on (contest, label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin import session
from scrutin.functions import exprs as X
from scrutin.operators import aggregates as A
from scrutin.operators import ordering as W
from scrutin.operators import predict as P


def contest_id() -> F.Column:
    """A long id per contest; valid for validated rows (department < 1000, round < 10)."""
    return ((F.col(S.YEAR).cast("long") * 1000 + F.col(S.DEPT)) * 10 + F.col(S.ROUND)).alias("scenario_id")


def contest_scenarios(results: DataFrame, tiebreak: Sequence[str] = (),
                      urban: Sequence[int] = S.BACKTEST_URBAN_DEPARTMENTS) -> DataFrame:
    """One scenario per contest from its first row: registered voters and the
    participation rate (defaults 25,000 and 65 when missing)."""
    order = F.struct((-F.col(S.VOTES)).alias("nv"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)])
    first = F.min_by(F.struct(F.col("inscrits").alias("i"), F.col("taux_participation").alias("p")), order)
    c = results.groupBy(*S.CONTEST_KEYS).agg(first.alias("__f"))
    return c.select(
        contest_id(), *S.CONTEST_KEYS,
        F.coalesce(F.col("__f.i"), F.lit(S.SCENARIO_DEFAULT_REGISTERED).cast("long")).alias("inscrits"),
        F.coalesce(F.col("__f.p"), F.lit(S.SCENARIO_DEFAULT_PARTICIPATION)).alias("taux_participation"),
        F.col(S.DEPT).isin(list(urban)).alias("is_urbain"))


def backtest(results: DataFrame, history: DataFrame, labels: DataFrame | None = None,
             reference_year: str = "latest", tiebreak: Sequence[str] = (),
             urban: Sequence[int] = S.BACKTEST_URBAN_DEPARTMENTS, materialise: bool = False,
             exclude_test_year: bool = False) -> DataFrame:
    """Per contest and label, predicted and actual share, absolute error
    (each rounded to 2 decimals), relative error (null when the actual share
    is 0) and the error level.

    ``results`` is read by the scenario and the truth branches; when it is
    the deduplicated table (bounded by the contest x label key space) pass
    ``materialise=True`` to checkpoint it once.

    ``exclude_test_year`` (decision Q22): each contest is predicted from the
    history without its own year (``predict.base_shares_without``); the known
    labels still come from the whole history."""
    results = results.select(*dict.fromkeys([*S.CONTEST_KEYS, S.LABEL, S.VOTES, "inscrits", "taux_participation", *tiebreak]))
    if materialise:
        results = session.materialise(results)
    scen = P.prepare_scenarios(contest_scenarios(results, tiebreak, urban))
    summary = P.summarise_history(history, materialise=True)
    pred = P.predict_shares(scen, summary, labels, reference_year, without=S.YEAR if exclude_test_year else None)
    actual = A.actual_shares(results).select(contest_id(), S.LABEL, "pct_reel")
    cmp = P.compare_shares(pred, actual, keys=["scenario_id"])
    err = F.abs(F.col("prediction") - F.col("reel"))
    ecart = X.round2(err)
    level = (F.when(ecart < S.ERROR_GOOD, F.lit("bon")).when(ecart < S.ERROR_FAIR, F.lit("moyen"))
              .otherwise(F.lit("fort")))
    keys = scen.select("scenario_id", *S.CONTEST_KEYS)
    return (cmp.join(keys, on="scenario_id", how="inner")
               .select(*S.CONTEST_KEYS, S.LABEL,
                       X.round2("prediction").alias("prediction"),
                       X.round2("reel").alias("reel"),
                       ecart.alias("ecart"),
                       F.when(F.col("reel") > 0, err / F.greatest(F.col("reel"), F.lit(0.1)) * 100)
                        .alias("ecart_relatif"),
                       level.alias("niveau_ecart"),
                       F.col("prediction").alias("prediction_brute"), F.col("reel").alias("reel_brut"),
                       "has_pred", "has_reel"))


def backtest_scores(bt: DataFrame) -> DataFrame:
    """Per contest mean and max error, predicted and actual winners,
    whether they agree, and score = 100 - min(2 x mean error, 100)."""
    keys = list(S.CONTEST_KEYS)

    def best(value: str, present: str) -> F.Column:
        """The label of the largest value, the least on ties, among the rows that have one."""
        rank = F.when(F.col(present), F.struct((-F.col(value)).alias("v"), F.col(S.LABEL).alias("l")))
        return F.min_by(F.col(S.LABEL), rank)

    out = bt.groupBy(*keys).agg(F.avg("ecart").alias("ecart_moyen"), F.max("ecart").alias("ecart_max"), F.count(F.lit(1)).alias("n_nuances"),
                                best("prediction_brute", "has_pred").alias("gagnant_predit"), best("reel_brut", "has_reel").alias("gagnant_reel"))
    return out.withColumns({
        "gagnant_correct": F.coalesce(F.col("gagnant_predit") == F.col("gagnant_reel"), F.lit(False)),
        "score_precision": F.lit(100.0) - F.least(F.col("ecart_moyen") * 2, F.lit(100.0)),
    })


def backtest_verdict(bt: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Precision verdict, best and worst label (ties: larger actual share
    first, then label), and the recommendation flags."""
    keys = list(S.CONTEST_KEYS)
    scores = scores if scores is not None else backtest_scores(bt)
    bw = W.best_and_worst(bt, by=keys, error="ecart",
                          order=[-F.col("reel"), F.col(S.LABEL)])
    m = F.col("ecart_moyen")
    verdict = (F.when(m < S.VERDICT_EXCELLENT, F.lit("excellente"))
                .when(m < S.VERDICT_FAIR, F.lit("correcte")).otherwise(F.lit("a_ameliorer")))
    return (scores.join(bw.select(*keys, "meilleure", "pire"), on=keys, how="left")
                  .select(*keys, verdict.alias("precision"), "meilleure", "pire",
                          (m > S.VERDICT_FAIR).alias("reco_ajuster"),
                          (F.col("ecart_max") > S.ERROR_LARGE).alias("reco_gros_ecarts"),
                          (~F.col("gagnant_correct")).alias("reco_gagnant")))
