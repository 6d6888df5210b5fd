"""Every query that needs a fit scans its tables and fits again."""

from types import SimpleNamespace

from checks import q_ml


def test_each_query_fits_anew(monkeypatch):
    seen = []
    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app"))
    monkeypatch.setattr(q_ml.I, "results", lambda s, sf: sf)
    monkeypatch.setattr(q_ml.M, "train_and_select", lambda df, key: seen.append(df) or (len(seen), {}))
    assert [q_ml.train_and_select(spark, "folder") for _ in range(2)] == [1, 2]
    assert seen == ["folder", "folder"]
