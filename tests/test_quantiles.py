"""Quantiles by brackets: against numpy, whatever the sketches say."""

import math

import numpy as np
import pytest

from scrutin.operators import quantiles as Q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def columns():
    rng = np.random.default_rng(5)
    n = 5000
    return {
        "plain": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float), "one": np.full(n, 7.0),
        "skew": np.where(rng.random(n) < 0.9, 1.0, rng.exponential(size=n) * 1e9), "few": np.where(np.arange(n) < 4, np.arange(n), np.nan)}


@pytest.fixture(scope="module")
def table(spark):
    data = columns()
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in zip(*data.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(7)


def expected():
    return {(c, k): np.quantile(v[~np.isnan(v)], p) for c, v in columns().items() for k, p in enumerate(PROBS)}


@pytest.mark.parametrize("k, few", [(1000, 200_000), (8, 10), (8, 0)])
def test_against_numpy(table, monkeypatch, k, few):
    """Also with sketches far too small for their margin, whose brackets fail, and with many rounds."""
    monkeypatch.setattr(Q, "SKETCH_K", k)
    monkeypatch.setattr(Q, "FEW", few)
    got = Q.quantiles(table, table.columns, PROBS)
    want = expected()
    assert got.keys() == want.keys() and all(np.isclose(got[x], want[x], rtol=1e-12, atol=0) for x in want)


def test_nan_null_and_empty(spark):
    df = spark.createDataFrame([(1.0, None, math.nan), (2.0, None, math.nan), (math.nan, None, math.inf), (None, None, -math.inf)], "a double, b double, c double")
    got = Q.quantiles(df, ["a", "b", "c"], [0.0, 0.5, 1.0])
    assert [got["a", k] for k in range(2)] == [1.0, 2.0] and math.isnan(got["a", 2])
    assert [got["b", k] for k in range(3)] == [None] * 3
    assert got["c", 0] == -math.inf and math.isnan(got["c", 2])
    assert Q.quantiles(df.limit(0), ["a"], [0.5]) == {("a", 0): None} and Q.quantiles(df, [], [0.5]) == {}


def test_brackets_follow_a_wrong_sketch():
    w = Q._Wanted(0, 50.5, 100, (10.0, 20.0))
    w.counted(60, 10, (10.0, 20.0))            # both ranks below
    assert w.open and w.tried == (-math.inf, 10.0)
    w.tried = (10.0, 20.0)
    w.counted(30, 10, None)                    # both above
    assert w.tried == (20.0, math.inf)
    w.tried = (10.0, 20.0)
    w.counted(51, 10, None)                    # one below, one inside
    assert w.tried == (-math.inf, 20.0)
    w.counted(0, 61, (5.0, 9.0))               # proven, and few
    assert not w.open and (w.lo, w.hi, w.below, w.inside) == (-math.inf, 20.0, 0, 61)


def test_only_the_rows_inside_the_brackets_are_looked_up(table, monkeypatch):
    seen = []
    look_up = Q._look_up
    monkeypatch.setattr(Q, "_look_up", lambda values, wanted: seen.extend(wanted) or look_up(values, wanted))
    Q.quantiles(table, ["plain"], [0.25, 0.5, 0.75])
    assert len(seen) == 3 and all(w.inside <= 0.03 * 5000 for w in seen)
    seen.clear()
    monkeypatch.setattr(Q, "FEW", 40)
    Q.quantiles(table, ["plain"], [0.25, 0.5, 0.75])
    assert all(w.inside <= 40 for w in seen)
