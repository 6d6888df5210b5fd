"""Classification (M1-M15): FIXTURES.md section 2 and metric checks."""

import tempfile

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from scrutin.operators import ml as M

TRAIN_SCHEMA = ("id LONG, annee INT, departement INT, famille_politique STRING, voix LONG, inscrits LONG, "
                "taux_participation DOUBLE, typologie STRING, ancien_midi_pyrenees INT")
BASE = [(2017, 30, "Droite", 1000, 2000, 65.5, "Urbain", 0),
        (2017, 31, "Gauche", 1500, 2000, 70.2, "Rural", 1),
        (2022, 30, "Centre", 800, 2000, 60.1, "Urbain", 0),
        (2022, 31, "Droite", 1200, 2000, 75.3, "Rural", 1)]


@pytest.fixture(scope="module")
def train_df(spark):
    rows = [(i * 4 + j, *BASE[j]) for i in range(10) for j in range(4)]
    return spark.createDataFrame(rows, TRAIN_SCHEMA)


def test_features(train_df):
    f, names, classes = M.prepare_features(train_df, keep=["id"])
    assert classes == ["Centre", "Droite", "Gauche"]
    assert names == ["annee", "decennie", "depuis_2000", "departement_encoded", "is_urbain",
                     "ancien_midi_pyrenees", "taux_participation", "voix", "inscrits", "influence",
                     "participation_haute", "participation_faible"]
    r = f.where("id = 1").first()
    assert (r.decennie, r.depuis_2000, r.departement_encoded, r.is_urbain) == (2010.0, 17.0, 1.0, 0.0)
    assert r.influence == pytest.approx(1500 / 2001) and r.participation_haute == 1.0
    assert r.label == 2.0  # Gauche


def test_standardise(train_df):
    f, names, _ = M.prepare_features(train_df)
    z = M.standardise(f, names)
    st = z.agg(F.avg("voix").alias("m"), F.stddev_pop("voix").alias("s"), F.avg("tour").alias("t")
               if "tour" in z.columns else F.lit(0.0).alias("t")).first()
    assert st.m == pytest.approx(0.0, abs=1e-9) and st.s == pytest.approx(1.0)


def test_split_sizes(train_df):
    f, _, _ = M.prepare_features(train_df, keep=["id"])
    s = M.stratified_split(f, "label", ["id"])  # share = min(0.3, max(0.1, 50/40)) = 0.3
    per = {(r.famille_politique, r.is_test): r.n for r in
           s.groupBy("famille_politique", "is_test").agg(F.count("*").alias("n")).collect()}
    assert per[("Droite", True)] == 6 and per[("Centre", True)] == 3 and per[("Gauche", True)] == 3
    one = f.limit(1).withColumn("label", F.lit(9.0)).unionByName(f)
    s1 = M.stratified_split(one, "label", ["id"]).where("label = 9.0").first()
    assert s1.is_test is False  # one-member class stays in train (Q23)
    r = M.random_split(f, ["id"], 0.2)
    assert r.where("is_test").count() == M.random_split(f.repartition(3), ["id"], 0.2).where("is_test").count()


def test_train_and_select(train_df):
    res, art = M.train_and_select(train_df, ["id"])
    rows = {r.model: r for r in res.collect()}
    assert set(rows) == {"RandomForest", "LogisticRegression"}
    for r in rows.values():
        assert 0.0 <= r.accuracy <= 1.0 and r.n_train + r.n_test == 40 and r.n_test == 12
        assert r.n_classes == 3 and r.n_features == 12
    assert sum(r.is_best for r in rows.values()) <= 1
    imp = M.feature_importance(art["models"]["RandomForest"], art["features"]).collect()
    assert len(imp) == 12 and sum(r.importance for r in imp) == pytest.approx(1.0)
    f, _, _ = M.prepare_features(train_df, keep=["id"])
    sc = M.score(f, art["models"]["LogisticRegression"], art["classes"])
    for r in sc.limit(5).collect():
        assert sum(r.probabilites.values()) == pytest.approx(1.0)
        assert r.confiance == pytest.approx(max(r.probabilites.values()))
        assert r.classe_predite in art["classes"]
    path = tempfile.mkdtemp(prefix="scrutin-models-")
    M.save_models(art, res, path)
    back = M.load_models(train_df.sparkSession, path)
    assert set(back["models"]) == {"RandomForest", "LogisticRegression"}
    assert back["classes"] == art["classes"] and back["features"] == art["features"]


def test_guards(train_df):
    small = train_df.limit(19)
    res, art = M.train_and_select(small, ["id"])
    assert res.first().error.startswith("not enough rows") and not art["models"]
    one = train_df.withColumn("famille_politique", F.lit("Droite"))
    res, _ = M.train_and_select(one, ["id"])
    assert "classes" in res.first().error


def test_confusion_and_roc(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.6), (0, 0.2), (1, 0.1), (0, 0.05)]
    df = spark.createDataFrame(rows, "y INT, s DOUBLE").withColumn("p", (F.col("s") >= 0.5).cast("int"))
    cm = {(r.y, r.p): r.n for r in M.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 2}
    allpos = df.withColumn("p", F.lit(1))
    cm2 = {(r.y, r.p): r.n for r in M.confusion_matrix(allpos, "y", "p").collect()}
    assert cm2[(0, 0)] == 0 and cm2[(1, 0)] == 0  # zero-filled
    auc = M.roc_auc(df, "y", "s").first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="yd", metricName="areaUnderROC")
    assert auc == pytest.approx(ev.evaluate(df.withColumn("yd", F.col("y").cast("double"))))
    curve = M.roc_curve(df, "y", "s").collect()
    assert (curve[0].fpr, curve[0].tpr) == (0.0, 0.0) and max(r.tpr for r in curve) == 1.0


def test_loaded_model_scores_one_department_as_in_training(spark, tmp_path):
    """The encoding of departments and classes is that of training, whatever is scored."""
    from pyspark.sql import functions as F
    rows = [(2012 + 5 * (i % 3), 9 + (i % 3) * 22, ["Gauche", "Droite", "Centre"][i % 3], 1000 + i, 5000, 60.0 + i % 7, i) for i in range(90)]
    df = spark.createDataFrame(rows, "annee INT, departement INT, famille_politique STRING, voix LONG, inscrits LONG, taux_participation DOUBLE, id LONG")
    results, art = M.train_and_select(df, ["id"])
    M.save_models(art, results, str(tmp_path / "m"))
    back = M.load_models(spark, str(tmp_path / "m"))
    assert back["classes"] == ["Centre", "Droite", "Gauche"] and back["departments"] == ["31", "53", "9"]

    def scored(part):
        f, _, _ = M.prepare_features(part, ["id"], back["departments"], back["classes"])
        out = M.score(f, back["models"]["RandomForest"], back["classes"])
        return {r.id: (r.classe_predite, round(r.confiance, 9), round(sum(r.probabilites.values()), 9)) for r in out.collect()}

    whole, one = scored(df), scored(df.where("departement = 9").drop("famille_politique"))
    assert one and all(whole[k] == v and v[2] == 1.0 for k, v in one.items())


def test_one_class_roc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label INT, score DOUBLE")
    assert all(r.fpr is None for r in M.roc_curve(df, "label", "score").where("threshold < 10").collect())


def test_roc_over_many_ranges(spark):
    """Running sums go on from range to range; ties, one class, nulls."""
    import numpy as np
    rng = np.random.default_rng(4)
    score, actual = np.round(rng.random(3000), 2), rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(int(a), float(s)) for a, s in zip(actual, score)], "actual INT, score DOUBLE").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cum, _, _ = M._cumulative(df, "actual", "score")
        rows = cum.orderBy(F.desc("s")).collect()
        assert len(rows) == len(set(score))
        for r in rows:
            assert (r.cp, r.cn) == (int(actual[score >= r.s].sum()), int((1 - actual)[score >= r.s].sum()))
        points = sorted((r.fpr, r.tpr) for r in M.roc_curve(df, "actual", "score").collect())
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        assert abs(M.roc_auc(df, "actual", "score").first()[0] - area) < 1e-12
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
