"""Enrichment, joins and the saved map golden values."""

import pytest

from scrutin.operators import enrich as E
from scrutin.operators import joins as J


def test_map_point_golden(spark):
    # saved map: participation 0.78106 -> radius 39.053, popup 78.1 %, 446,479 votes
    df = spark.createDataFrame([(9, 0.78106, 446479), (75, 0.5, 1)], "departement INT, taux_participation DOUBLE, voix LONG")
    rows = E.with_map_point(df, scale=1.0).collect()
    assert len(rows) == 1  # unknown code dropped
    r = rows[0]
    assert (r.lat, r.lon) == (42.96, 1.60) and r.radius == pytest.approx(39.053)
    assert r.popup == "09 - Ariège<br>Participation: 78.1%<br>Voix: 446,479"


def test_bins_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (20.0,), (100.0,), (101.0,)], "taux_pauvrete DOUBLE")
    got = [r.niveau_precarite for r in E.with_socio_bins(df).collect()]
    assert got == [None, "Faible", "Moyen", "Moyen", "Élevé", None]


def test_merge_datasets_suffixes_years(spark):
    base = spark.createDataFrame([(31, 1)], "departement INT, x INT")
    so = spark.createDataFrame([(31, 10.0), (31, 20.0)], "DEP INT, taux_pauvrete DOUBLE")
    leg = spark.createDataFrame([(31, 100, 60, 40)], "departement INT, inscrits INT, votants INT, abstentions INT")
    out = J.merge_datasets({"presidentielle_2022": base, "socio_2017": so, "socio_2022": so,
                            "legislative_2022": leg}).first().asDict()
    assert out["taux_pauvrete_2017"] == 15.0 and out["taux_pauvrete_2022"] == 15.0  # Q14
    assert out["inscrits_leg"] == 100.0
    with pytest.raises(ValueError):
        J.join_socio(base, spark.createDataFrame([(1.0,)], "taux_pauvrete DOUBLE"))  # Q27


def test_raw_rates(spark):
    df = spark.createDataFrame([(80, 100, 10, 0)], "votants LONG, inscrits LONG, voix LONG, exprimes LONG")
    r = E.with_raw_rates(df).first()
    assert r.participation_rate == 0.8 and r.abstention_rate == pytest.approx(0.2) and r.vote_share is None


def test_share_of_total_and_winner(spark):
    from scrutin.operators import ordering as W
    df = spark.createDataFrame([(1, "a", 30), (1, "b", 10), (2, "a", 0), (None, "c", 5)],
                               "g INT, nuance STRING, v LONG")
    got = {(r.g, r.nuance): r.pct for r in W.share_of_total(df, "v", ["g"]).collect()}
    assert got == {(1, "a"): 75.0, (1, "b"): 25.0, (2, "a"): 0.0, (None, "c"): 100.0}
    ties = spark.createDataFrame([(1, "b", 5.0), (1, "a", 5.0), (1, "c", 1.0)], "g INT, nuance STRING, pct DOUBLE")
    assert W.winner(ties, by=["g"]).first().gagnant == "a"  # ties -> smallest label
    ranks = {r.nuance: r.rang for r in W.rank_predictions(ties, by=["g"]).collect()}
    assert ranks == {"a": 1, "b": 2, "c": 3}
