"""Correlations by one matrix aggregate, against pandas."""

import numpy as np
import pandas as pd

from scrutin.operators import aggregates as A


def test_pairwise_complete_correlations(spark):
    rng = np.random.default_rng(0)
    n = 4000
    x = rng.normal(size=n)
    frame = pd.DataFrame({"x": x + 1e9, "y": 2 * x + rng.normal(size=n), "z": rng.integers(0, 5, n).astype(float), "constant": 3.3, "gone": None})
    frame.loc[rng.random(n) < 0.3, "y"] = None
    frame.loc[rng.random(n) < 0.5, "z"] = None
    frame.loc[5:, "few"] = None
    frame.loc[:4, "few"] = [1.0, 5.0, 2.0, 2.0, 9.0]
    frame["gone"] = frame["gone"].astype(float)
    rows = [tuple(None if v is None or v != v else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame)).repartition(6)
    got = {(r.var1, r.var2): r.r for r in A.correlation_matrix(df).collect()}
    want = frame.corr()
    assert len(got) == 36
    for (a, b), r in got.items():
        w = want.loc[a, b]
        if "constant" in (a, b) or w != w:
            assert r is None, (a, b, r)
        else:
            assert abs(r - w) < 1e-7 if "x" in (a, b) else abs(r - w) < 1e-12, (a, b)   # x: 1e9 leaves 7 digits
            assert r == got[b, a]


def test_nan_stays_in_its_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, float("nan"), 3.0), (4.0, 1.0, 1.0)], "a double, b double, c double")
    got = {(r.var1, r.var2): r.r for r in A.correlation_matrix(df).collect()}
    assert np.isnan(got["a", "b"]) and np.isnan(got["b", "b"])
    assert np.isclose(got["a", "c"], np.corrcoef([1, 2, 4], [5, 3, 1])[0, 1]) and got["a", "a"] == 1.0


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert [r.r for r in A.correlation_matrix(df).collect()] in ([None] * 4, [])
