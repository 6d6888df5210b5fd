"""Values of the fitted models (M6-M10) against numpy: the logistic optimum
solved apart, the forest's vote, the reported accuracy and importances."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.operators import ml as M

SCHEMA = "id LONG, annee INT, departement INT, famille_politique STRING, voix LONG, inscrits LONG, taux_participation DOUBLE"
CLASSES = ["Centre", "Droite", "Gauche"]


@pytest.fixture(scope="module")
def fitted(spark):
    """Votes tell the class but for one row in ten; the other columns are noise."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        c = int(rng.integers(3))
        seen = c if rng.random() > 0.1 else int(rng.integers(3))
        rows.append((i, int(rng.choice([2012, 2017, 2022])), int(rng.choice([9, 31, 34])), CLASSES[c], int(1000 * (seen + 1) + rng.integers(-300, 300)),
                     int(rng.integers(5000, 9000)), float(np.round(rng.uniform(40, 90), 2))))
    df = spark.createDataFrame(rows, SCHEMA)
    results, artifacts = M.train_and_select(df, ["id"])
    feats, names, classes = M.prepare_features(df, keep=["id"], departments=artifacts["departments"])
    split = M.stratified_split(feats, "label", ["id"], share=M.test_share(600))
    return {r.model: r for r in results.collect()}, artifacts, split, names, classes


def arrays(rows, names):
    got = rows.orderBy("id").select(*names, "label").collect()
    return np.array([[float(r[n]) for n in names] for r in got]), np.array([int(r.label) for r in got])


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def solved(x, y, k, reg):
    """The multinomial optimum by Newton steps; intercepts are not penalised."""
    n, d = x.shape
    xb = np.hstack([x, np.ones((n, 1))])
    w, eye = np.zeros((k, d + 1)), np.eye(k)[y]
    penalty = np.tile(np.append(np.full(d, reg), 1e-9), k)   # a trace of it keeps the intercepts unique
    for _ in range(60):
        p = softmax(xb @ w.T)
        grad = ((p - eye).T @ xb / n).ravel() + penalty * w.ravel()
        h = np.zeros((k * (d + 1),) * 2)
        for a in range(k):
            for b in range(k):
                weight = p[:, a] * ((a == b) - p[:, b])
                h[a * (d + 1):(a + 1) * (d + 1), b * (d + 1):(b + 1) * (d + 1)] = (xb * weight[:, None]).T @ xb / n
        step = np.linalg.lstsq(h + np.diag(penalty), grad, rcond=None)[0]
        w -= step.reshape(w.shape)
        if np.abs(step).max() < 1e-10:
            break
    return w


def test_logistic_probabilities_are_the_optimum(fitted):
    _, art, split, names, classes = fitted
    x, y = arrays(split.where("not is_test"), names)
    xt, _ = arrays(split.where("is_test"), names)
    mean, sd = x.mean(axis=0), x.std(axis=0, ddof=1)
    scale = np.where(sd > 0, 1 / np.where(sd > 0, sd, 1), 0.0)
    w = solved((x - mean) * scale, y, 3, 1.0 / (S.LOGISTIC_C * len(x)))
    want = softmax(np.hstack([(xt - mean) * scale, np.ones((len(xt), 1))]) @ w.T)
    scored = M.score(split.where("is_test"), art["models"]["LogisticRegression"], classes).orderBy("id").collect()
    got = np.array([[r.probabilites[c] for c in CLASSES] for r in scored])
    assert classes == CLASSES and np.abs(got - want).max() < 2e-3
    assert all(r.classe_predite == CLASSES[int(np.argmax(p))] and np.isclose(r.confiance, p.max()) for r, p in zip(scored, got))


def test_forest_probabilities_are_its_trees_mean(fitted):
    _, art, split, names, classes = fitted
    model = art["models"]["RandomForest"]
    rows = split.where("is_test").orderBy("id").limit(25)
    got = np.array([list(r.p) for r in model.transform(rows).orderBy("id").select(vector_to_array("probability").alias("p")).collect()])
    x, _ = arrays(rows, names)
    from pyspark.ml.linalg import Vectors
    forest = model.stages[-1]
    assert forest.getNumTrees == S.FOREST_TREES and max(t.depth for t in forest.trees) <= S.FOREST_DEPTH
    want = [np.mean([t.predictProbability(Vectors.dense(v)).toArray() for t in forest.trees], axis=0) for v in x]
    assert np.allclose(got, want)


def test_reported_accuracies_and_best_model(fitted):
    rows, art, split, names, classes = fitted
    test = split.where("is_test")
    for name, row in rows.items():
        scored = M.score(test, art["models"][name], classes)
        right, n = scored.agg(F.sum((F.col("classe_predite") == F.col("famille_politique")).cast("int")), F.count("*")).first()
        assert row.n_test == n and row.n_train == 600 - n and np.isclose(row.accuracy, right / n)
        assert row.accuracy > 0.8      # guessing gives a third; one row in ten cannot be known
    best = max(rows.values(), key=lambda r: r.accuracy)
    assert rows[art["best"]].accuracy == best.accuracy and [r.is_best for r in rows.values()].count(True) == 1


def test_importances_find_the_column_that_tells_the_class(fitted):
    _, art, _, names, _ = fitted
    got = {r.feature: r.importance for r in M.feature_importance(art["models"]["RandomForest"], names).collect()}
    assert set(got) == set(names) and np.isclose(sum(got.values()), 1.0)
    told = got["voix"] + got.get("influence", 0.0)
    assert told > 0.6 and max(got, key=got.get) in ("voix", "influence")
