"""Preprocessing (L1) and its steps: FIXTURES.md section 1 and edge rows."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SMOKE_SCHEMA
from scrutin.operators import clean as C
from scrutin.plans import preprocess as L

RAW_SCHEMA = ("id LONG, annee STRING, tour STRING, departement STRING, nuance STRING, voix STRING, "
              "inscrits STRING, votants STRING, abstentions STRING, exprimes STRING")


def test_smoke_fixture(spark, smoke_rows):
    df = spark.createDataFrame(smoke_rows, SMOKE_SCHEMA)
    rows = L.preprocess(df).collect()
    assert [(r.annee, r.tour) for r in rows] == [(2017, 1), (2017, 2), (2022, 1), (2022, 2)]
    got = [(r.taux_participation, r.taux_abstention, r.pct_exprimes, r.pct_inscrits,
            r.famille_politique, r.departement_nom) for r in rows]
    assert got == [
        (75.0, 25.0, 14.55, 10.0, "Extrême gauche", "Hérault"),
        (81.25, 18.75, 20.0, 15.0, "Gauche", "Hérault"),
        (75.0, 25.0, 14.29, 10.0, "Extrême droite", "Haute-Garonne"),
        (85.0, 15.0, 18.75, 15.0, "Centre", "Haute-Garonne"),
    ]
    assert all(r.typologie == "Urbain" for r in rows)  # decision Q1
    assert [r.ancien_midi_pyrenees for r in rows] == [False, False, True, True]
    assert [r.ancien_languedoc_roussillon for r in rows] == [True, True, False, False]


def test_column_order(spark, smoke_rows):
    df = spark.createDataFrame(smoke_rows, SMOKE_SCHEMA).withColumn("extra", F.lit(1))
    cols = L.preprocess(df).columns
    assert cols[:5] == ["annee", "tour", "departement", "departement_nom", "nuance"]
    assert cols[-1] == "extra"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_edge_rows(spark):
    rows = [
        (1, "2017", "1", "09", "  rn ", "10", "100", "80", "20", "80"),      # padded code and label
        (2, "2017", "1", "9", None, "10", "100", "80", "20", "80"),          # null label -> AUTRE
        (3, "2017", "1", "n/a", "LR", "10", "100", "80", "20", "80"),        # bad code: dropped
        (4, "2017", "0", "31", "LR", "10", "100", "80", "20", "80"),         # round 0
        (5, "2017", "3", "31", "LR", "10", "100", "80", "20", "80"),         # round 3
        (6, "1989", "1", "31", "LR", "10", "100", "80", "20", "80"),         # too old
        (7, "1990", "1", "31", "NaN", "10", "100", "80", "20", "80"),        # NaN label, 1990 kept
        (8, "2025", "1", "31", "NULL", "10", "100", "80", "20", "80"),       # 2025 kept
        (9, "2026", "1", "31", "LR", "10", "100", "80", "20", "80"),         # too recent
        (10, "2017", "2", "31", "LR", "1", "0", "0", "0", "0"),              # zero denominators
        (11, "2017", "2", "34", "LR", "-5", "100", "80", "20", "80"),        # negative votes
        (12, "2017", "2", "12", "PS", "1", "800", "800", "0", "800"),        # 1/800 -> 0.125 -> 0.12
        (13, "2017", "2", "75", "PS", "1", "800", "800", "0", "800"),        # outside the region
        (14, "NaN", "1", "31", "PS", "1", "800", "800", "0", "800"),         # NaN year: dropped
        (15, "2017", "1", "11", "", "x", "100", "80", "20", "80"),           # blank label, bad count -> 0
    ]
    out = {r.id: r for r in L.preprocess(_raw(spark, rows), tiebreak=["id"]).collect()}
    assert set(out) == {1, 2, 7, 8, 10, 12, 15}
    assert out[1].departement == 9 and out[1].nuance == "RN"
    assert out[2].nuance == "AUTRE" and out[2].famille_politique == "Autres"
    assert out[7].nuance == "AUTRE" and out[8].nuance == "AUTRE" and out[15].nuance == "AUTRE"
    assert out[15].voix == 0
    assert (out[10].taux_participation, out[10].pct_exprimes, out[10].pct_inscrits) == (0.0, 0.0, 0.0)
    assert out[12].pct_exprimes == 0.12  # half to even, like numpy


def test_dedup_keeps_first_by_tiebreak(spark):
    rows = [(3, "2017", "1", "31", "RN", "30", "100", "80", "20", "80"),
            (1, "2017", "1", "31", "RN", "10", "100", "80", "20", "80"),
            (2, "2017", "1", "31", "RN", "20", "100", "80", "20", "80")]
    out = L.preprocess(_raw(spark, rows), tiebreak=["id"]).collect()
    assert [(r.id, r.voix) for r in out] == [(1, 10)]


def test_idempotent_and_partition_independent(spark):
    from scrutin.sources import testdata as TD
    raw = TD.ballots_raw(spark, "/root/testdata/sf0.001")
    once = L.preprocess(raw, tiebreak=TD.TIEBREAK, sort=False)
    twice = L.preprocess(once, tiebreak=TD.TIEBREAK, sort=False)
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.select(*once.columns).collect()))
    b = sorted(map(tuple, L.preprocess(raw.repartition(1), tiebreak=TD.TIEBREAK, sort=False).collect()))
    c = sorted(map(tuple, L.preprocess(raw.repartition(7), tiebreak=TD.TIEBREAK, sort=False).collect()))
    assert a == b == c


def test_validation_counts_through_observe(spark):
    rows = [(1, "2017", "1", "31", "RN", "1", "2", "1", "1", "1"),
            (2, "2017", "0", "31", "RN", "1", "2", "1", "1", "1"),
            (3, "2017", "1", "n/a", "RN", "1", "2", "1", "1", "1")]
    obs = Observation("validation")
    df = C.validate(L.clean_columns(_raw(spark, rows)), observation=obs)
    assert df.count() == 1
    assert obs.get == {"rows_in": 3, "rows_valid": 1}


def test_minimal_clean_compares_ints(spark):
    rows = [(1, "2017", "1", "09", "RN", "x", "2", "1", "1", "1"),
            (2, "2017", "1", "75", "RN", "1", "2", "1", "1", "1")]
    out = C.minimal_clean(_raw(spark, rows)).collect()
    assert [(r.id, r.departement, r.voix) for r in out] == [(1, 9, 0)]  # decision Q11


@pytest.mark.parametrize("label,family", [
    ("LREM", "Droite"), ("UDI", "Droite"), ("REM", "Centre"), ("REN", "Centre"), ("SOC", "Autres"),
    ("ECO", "Autres"), ("ENS", "Autres"), ("NUP", "Autres"), ("EELV", "Écologie"), ("LFI", "Extrême gauche"),
    ("RN", "Extrême droite"), ("FN", "Extrême droite"), ("PS", "Gauche"), ("DVG", "Gauche"),
    ("AUTRE", "Autres"), ("XYZ", "Autres"),
])
def test_family_rules_first_match(spark, label, family):
    from scrutin.operators import enrich as E
    got = E.with_family(spark.createDataFrame([(label,)], "nuance STRING")).first().famille_politique
    assert got == family  # decision Q7


def test_winsorize_and_median(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,)], "x DOUBLE")
    med = C.impute_median(df, ["x"]).where(F.col("x").isNull()).count()
    assert med == 0
    w = C.winsorize(df.na.drop(), ["x"]).agg(F.min("x"), F.max("x")).first()
    assert w[0] == pytest.approx(1.99) and w[1] == pytest.approx(99.01)  # linear, like pandas


def test_rate_clip_only_fraction_columns(spark):
    df = spark.createDataFrame([(1.5, 25.0)], "participation_rate DOUBLE, taux_pauvrete DOUBLE")
    out = C.clip(df, C.default_rate_bounds(df)).first()
    assert out.participation_rate == 1.0 and out.taux_pauvrete == 25.0  # decision Q12
