"""Decisions of SURVEY section 1.5 not covered elsewhere, one test each."""

import pytest
from pyspark.sql import functions as F

from scrutin.operators import backtest as B
from scrutin.operators import clean as C
from scrutin.operators import joins as J
from scrutin.operators import predict as P


def test_q6_floor_can_push_total_above_100(spark):
    adj = spark.createDataFrame([(0, "A", 1000.0), (0, "B", 0.01), (0, "C", 0.01)],
                                "scenario_id LONG, nuance STRING, adj DOUBLE")
    sc = spark.createDataFrame([(0,)], "scenario_id LONG")
    got = {r.nuance: r.pct for r in P.normalise_shares(adj, sc).collect()}
    assert got["B"] == 0.1 and got["C"] == 0.1 and sum(got.values()) > 100.0


def test_q13_winsorize_leaves_key_columns(spark):
    rows = [(2017, 1, 31, float(i)) for i in range(100)] + [(2022, 2, 9, 1000.0)]
    df = spark.createDataFrame(rows, "annee INT, tour INT, departement INT, x DOUBLE")
    out = C.clean_table(df)
    assert {r.departement for r in out.collect()} == {31, 9}   # keys untouched
    assert out.agg(F.max("x")).first()[0] < 1000.0             # values clipped


def test_q15_secondary_presidential_tables_ignored(spark):
    base = spark.createDataFrame([(31, 1)], "departement INT, x INT")
    other = spark.createDataFrame([(31, 2)], "departement INT, y INT")
    out = J.merge_datasets({"presidentielle_2022": base, "presidentielle_2017": other})
    assert out.columns == ["departement", "x"]


def test_q2_backtest_urban_set(spark):
    res = spark.createDataFrame([(2022, 1, 30, "RN", 1, 10, 60.0), (2022, 1, 31, "RN", 1, 10, 60.0)],
                                "annee INT, tour INT, departement INT, nuance STRING, voix LONG, "
                                "inscrits LONG, taux_participation DOUBLE")
    got = {r.departement: r.is_urbain for r in B.contest_scenarios(res).collect()}
    assert got == {30: False, 31: True}  # {31, 34} in the backtest, {30, 31, 34} in preprocessing


def test_q8_dedup_never_arbitrary(spark):
    rows = [(2017, 1, 31, "RN", i, 100 - i) for i in range(50)]
    df = spark.createDataFrame(rows, "annee INT, tour INT, departement INT, nuance STRING, id INT, voix INT")
    picks = {C.first_per_key(df.repartition(n), order=["id"]).first().id for n in (1, 3, 7)}
    assert picks == {0}


@pytest.mark.parametrize("code,expected", [("09", 9), ("9", 9), ("n/a", None), ("12.0", 12), (" 31", 31)])
def test_q10_department_codes(spark, code, expected):
    df = spark.createDataFrame([(code,)], "departement STRING")
    assert C.department_code(df).first().departement == expected
