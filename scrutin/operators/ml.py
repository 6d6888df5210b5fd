"""Classification (M1-M15) with MLlib.

Feature preparation, encoding, scaling, splits and evaluation are column
expressions and grouped aggregates; fitting uses MLlib estimators, which
distribute over partitions.  Nothing here collects rows to the driver
except fitted-model vectors (feature importances, class labels), whose size
is bounded by the number of features and classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException, SparkRuntimeException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrutin import schema as S
from scrutin.operators.keyed import join_per_key
from scrutin.session import materialise, settled
from scrutin.sources import files

UNKNOWN_CLASS = "Inconnu"

#: Columns that M1 reads.
MODEL_INPUTS = (S.YEAR, S.DEPT, S.ROUND, S.LABEL, "famille_politique", "typologie", "ancien_midi_pyrenees",
                "taux_participation", "taux_abstention", "voix", "inscrits", "votants")


# -- M1 / M2 -------------------------------------------------------------------
def target_column(df: DataFrame) -> str:
    if "famille_politique" in df.columns:
        return "famille_politique"
    if S.LABEL in df.columns:
        return S.LABEL
    raise ValueError("no target column (famille_politique or nuance)")


def encode_labels(df: DataFrame, column: str, out: str, labels: Sequence[str] | None = None,
                  invalid: str = "keep") -> tuple[DataFrame, list[str]]:
    """M2: alphabetical index of a text column (``StringIndexer`` alphabetAsc);
    returns the encoded frame and the class list (bounded by distinct values).
    With ``labels`` (those of a fitted model) nothing is fitted anew; a value
    outside them gets the index after the last."""
    if labels is not None:
        model = StringIndexerModel.from_labels(list(labels), inputCol=column, outputCol=out, handleInvalid="keep")
    else:
        model = StringIndexer(inputCol=column, outputCol=out, stringOrderType="alphabetAsc",
                              handleInvalid=invalid).fit(df)
    return model.transform(df), list(model.labels)


def department_labels(df: DataFrame) -> list[str]:
    """The department codes in index order, kept with a fitted model."""
    if S.DEPT not in df.columns:
        return []
    work = df.select(F.col(S.DEPT).cast("string").alias("__dept_txt"))
    return encode_labels(work, "__dept_txt", "__dept_idx")[1]


def prepare_features(df: DataFrame, keep: Sequence[str] = (), departments: Sequence[str] | None = None,
                     classes: Sequence[str] | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """M1: up to 15 features in the fixed order (absent inputs are skipped),
    nulls -> 0; target text (family, else label; null -> 'Inconnu') and its
    alphabetical index in ``label``; ``keep`` columns are carried along.
    Returns (frame, feature names, classes).  To score with a fitted model pass
    its ``departments`` and ``classes``: the encoding is then that of training,
    and the target column may be missing."""
    cols = set(df.columns)
    feats: dict[str, F.Column] = {}
    if S.YEAR in cols:
        y = F.col(S.YEAR).cast("double")
        feats["annee"] = y
        feats["decennie"] = F.floor(y / 10) * 10
        feats["depuis_2000"] = F.greatest(y - 2000, F.lit(0.0))
    work = df
    if S.DEPT in cols:
        work = work.withColumn("__dept_txt", F.col(S.DEPT).cast("string"))
        work, _ = encode_labels(work, "__dept_txt", "__dept_idx", departments)
        feats["departement_encoded"] = F.col("__dept_idx")
    if "typologie" in cols:
        feats["is_urbain"] = (F.col("typologie") == S.URBAN).cast("double")
    if "ancien_midi_pyrenees" in cols:
        feats["ancien_midi_pyrenees"] = F.col("ancien_midi_pyrenees").cast("double")
    for c in ("taux_participation", "taux_abstention", "voix", "inscrits", "votants"):
        if c in cols:
            feats[c] = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    if "voix" in feats and "inscrits" in feats:
        feats["influence"] = feats["voix"] / (feats["inscrits"] + 1)
    if "taux_participation" in feats:
        feats["participation_haute"] = (feats["taux_participation"] > S.HIGH_PARTICIPATION).cast("double")
        feats["participation_faible"] = (feats["taux_participation"] < S.LOW_PARTICIPATION).cast("double")
    if S.ROUND in cols:
        feats["tour"] = F.col(S.ROUND).cast("double")
    names = [n for n in S.MODEL_FEATURES if n in feats]
    if classes is not None and not cols & {"famille_politique", S.LABEL}:
        out = work.select(*[F.col(k) for k in keep], *[F.coalesce(feats[n], F.lit(0.0)).alias(n) for n in names])
        return out, names, list(classes)
    tgt = target_column(df)
    work = work.withColumn("__target", F.coalesce(F.col(tgt).cast("string"), F.lit(UNKNOWN_CLASS)))
    # no slot for unknown classes when fitting: k classes are k, not k + 1
    work, classes = encode_labels(work, "__target", "label", classes, invalid="error")
    out = work.select(*[F.col(k) for k in keep],
                      *[F.coalesce(feats[n], F.lit(0.0)).alias(n) for n in names],
                      F.col("__target").alias(tgt), "label")
    return out, names, classes


# -- M3 ----------------------------------------------------------------------
def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation of each column (one row)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"__mu_{c}"), F.stddev_pop(c).alias(f"__sd_{c}")]
    return df.agg(*aggs)


def standardise(df: DataFrame, columns: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """M3: (x - mean) / population std (a zero std leaves the scale at 1), with
    statistics fitted on ``stats`` (e.g. the training rows) or on ``df``: one
    scalar subquery that holds the whole statistics row."""
    stats = stats if stats is not None else scaler_stats(df, columns)
    df = df.withColumn("__stats", stats.select(F.struct("*")).scalar())
    out = {}
    for c in columns:
        mu, sd = F.col("__stats").getField(f"__mu_{c}"), F.col("__stats").getField(f"__sd_{c}")
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out[c] = (F.col(c) - mu) / scale
    return df.withColumns(out).drop("__stats")


# -- M4 / M5 -------------------------------------------------------------------
def _unit_hash(keys: Sequence[str], seed: int) -> F.Column:
    """A stable pseudo-random number in [0, 1) from the row's key columns."""
    return _key_hash(keys, seed).cast("double") / float(1 << 32)


def _key_hash(keys: Sequence[str], seed: int) -> F.Column:
    """A stable number of 32 bits from the row's key columns as text: the first
    of an MD5 digest, which other engines have too."""
    if not keys:
        raise ValueError("a split needs key columns; without a row key pass all columns")
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def test_share(n: int) -> float:
    return min(0.3, max(0.1, 50 / n)) if n else 0.0


#: The hash of a row's key is a number of 32 bits; classes are searched by its first 16, then by all.
_BITS, _HIGH = 32, 16


def _at_rank(counts: DataFrame, by: Sequence[str], value: str, rank: str) -> DataFrame:
    """Per group the least value whose running count passes ``rank`` (from 0), and the rows under it."""
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(value))
    return (counts.withColumn("__upto", upto).where((F.col(rank) < F.col("__upto")) & (F.col(rank) >= F.col("__upto") - F.col("n")))
            .select(*by, F.col(value).alias("__found"), (F.col("__upto") - F.col("n")).alias("__under")))


def _thresholds(rows: DataFrame, label: str, share: float) -> DataFrame:
    """Per class its rows and the hash at rank ceil(share * rows), exactly.  The
    hash's high half is counted per class (at most 65,536 numbers), then the low half
    among the rows of the one high half that holds the rank: no class is sorted,
    and no task holds more than 65,536 counts of a class."""
    high = F.shiftright("__h", _BITS - _HIGH)
    counts = rows.groupBy(label, high.alias("high")).agg(F.count(F.lit(1)).alias("n"))
    size = F.sum("n").over(Window.partitionBy(label))
    counts = counts.withColumn("__nc", size).withColumn("rank", F.greatest(F.ceil(F.col("__nc") * share), F.lit(1)) - 1)
    bins = _at_rank(counts, [label, "__nc", "rank"], "high", "rank")
    wanted = bins.select(label, F.col("__found").alias("high"), "__nc", (F.col("rank") - F.col("__under")).alias("rank"))
    inside = join_per_key(rows.withColumn("high", high), wanted, [label, "high"])
    low = inside.groupBy(label, "__h", "__nc", "rank").agg(F.count(F.lit(1)).alias("n"))
    return _at_rank(low, [label, "__nc"], "__h", "rank").select(label, "__nc", F.col("__found").alias("__thr"))


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], share: float | None = None,
                     seed: int = S.SPLIT_SEED) -> DataFrame:
    """M4: adds ``is_test``.  Within each class, rows whose key hash is among
    the first ceil(share x n) go to test, with all that share the last of these
    hashes (share defaults to min(0.3, max(0.1, 50 / n))); one-row classes stay
    in train (decision Q23).  Exact at every size.
    """
    hashed = df.withColumn("__h", _key_hash(keys, seed))
    if share is None:
        share = test_share(df.count())  # one number back to the driver
    j = join_per_key(hashed, _thresholds(settled(hashed.select(label, "__h")), label, float(share)), [label])
    return (j.withColumn("is_test", (F.col("__nc") > 1) & (F.col("__h") <= F.col("__thr")))
             .drop("__h", "__nc", "__thr"))


def random_split(df: DataFrame, keys: Sequence[str], fraction: float = 0.2,
                 seed: int = S.SPLIT_SEED) -> DataFrame:
    """M5: unstratified; stable across partitionings (hash of the keys)."""
    return df.withColumn("is_test", _unit_hash(keys, seed) < fraction)


# -- M6 / M7 / M8 / M14 -----------------------------------------------------------
#: A training task has at least so many rows on average: every round of the forest sends
#: each task's statistics of all nodes, so tasks of a few rows cost more than they save.
MIN_TASK_ROWS = 500


def random_forest(features: str = "features", label: str = "label",
                  checkpoint: bool = True) -> RandomForestClassifier:
    """M6: 100 trees, depth 10, seed 42.  Node ids are cached and
    checkpointed (into the session's checkpoint folder) every 10 rounds."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=S.FOREST_TREES,
                                  maxDepth=S.FOREST_DEPTH, seed=S.SPLIT_SEED,
                                  cacheNodeIds=checkpoint, checkpointInterval=10 if checkpoint else -1)


def logistic(n_train: int, features: str = "scaled", label: str = "label") -> LogisticRegression:
    """M7: L2 with C = 1, i.e. regParam = 1 / (C x n_train) on standardised
    features, up to 1000 iterations."""
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=S.LOGISTIC_MAX_ITER,
                              regParam=1.0 / (S.LOGISTIC_C * max(n_train, 1)), elasticNetParam=0.0,
                              standardization=False, family="multinomial")


def accuracy(predictions: DataFrame, label: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="accuracy").evaluate(predictions)


def train_and_select(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict]:
    """M8: guards (>= 20 rows, >= 2 classes), stratified split, both models,
    test accuracy; the best is the first model with a strictly higher
    accuracy.  Returns (results table M14, {"models": {...}, "features": [...],
    "classes": [...], "best": name}).  An unusable input gives a one-row
    table with an ``error`` and no models; a model that fails to fit gives a
    row with its ``error`` and the other one is still trained.  The columns
    that are used are kept in memory (or on disk) while the models are fitted, in
    no more partitions than their rows fill (MIN_TASK_ROWS), whatever number the
    session gives a shuffle."""
    used = [c for c in df.columns if c in {*keys, *MODEL_INPUTS}]
    df = df.select(*used).persist()
    try:
        return _train_and_select(df.coalesce(max(1, df.count() // MIN_TASK_ROWS)), keys)
    finally:
        df.unpersist()


def _train_and_select(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, dict]:
    spark = df.sparkSession
    departments = department_labels(df) if S.DEPT in df.columns else None
    feats, names, classes = prepare_features(df, keep=list(keys), departments=departments)
    counts = feats.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("k")).first()
    n, k = int(counts["n"]), int(counts["k"])
    if n < S.MIN_TRAIN_ROWS or k < 2:
        msg = "not enough rows (minimum 20)" if n < S.MIN_TRAIN_ROWS else f"not enough classes ({k})"
        return model_table(spark, [], error=msg), {"models": {}, "features": names,
                                                   "classes": classes, "departments": departments, "best": None}
    split = stratified_split(feats, "label", keys, share=test_share(n)).persist()
    try:
        train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
        n_train = train.count()
        n_test = n - n_train
        assembler = VectorAssembler(inputCols=names, outputCol="features")
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
        pipelines = {
            "RandomForest": Pipeline(stages=[assembler, random_forest()]),
            "LogisticRegression": Pipeline(stages=[assembler, scaler, logistic(n_train)]),
        }
        models, rows, best, best_score = {}, [], None, 0.0
        for name, pipe in pipelines.items():
            try:
                model = pipe.fit(train)
                acc = accuracy(model.transform(test)) if n_test else 0.0
            except (IllegalArgumentException, SparkRuntimeException, Py4JJavaError) as e:  # a failed fit is a result of its own
                rows.append((name, None, n_train, n_test, len(names), k, f"{type(e).__name__}: {e}"[:500]))
                continue
            models[name] = model
            rows.append((name, float(acc), n_train, n_test, len(names), k, None))
            if acc > best_score:
                best, best_score = name, acc
    finally:
        split.unpersist()
    return (model_table(spark, rows, best=best),
            {"models": models, "features": names, "classes": classes, "departments": departments, "best": best})


def model_table(spark: SparkSession, rows: list[tuple], best: str | None = None,
                error: str | None = None) -> DataFrame:
    """Model, accuracy, train/test sizes, feature and class counts."""
    schema = ("model STRING, accuracy DOUBLE, n_train BIGINT, n_test BIGINT, n_features INT, "
              "n_classes INT, is_best BOOLEAN, error STRING")
    data = [(m, a, tr, te, nf, nc, m == best, err) for m, a, tr, te, nf, nc, err in rows]
    if error is not None:
        data = [(None, None, None, None, None, None, False, error)]
    return spark.createDataFrame(data, schema)


# -- M9 / M10 / M11 -----------------------------------------------------------------
def feature_importance(model: PipelineModel, features: Sequence[str], top: int | None = None) -> DataFrame:
    """M9: (feature, importance) descending, from the fitted forest (a vector
    of one value per feature); ``top`` keeps the first ones (the dashboard
    shows 10)."""
    forest = model.stages[-1]
    imp = forest.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    out = spark.createDataFrame(rows, "feature STRING, importance DOUBLE") \
               .orderBy(F.col("importance").desc(), F.col("feature"))
    return out.limit(top) if top else out


def score(df: DataFrame, model: PipelineModel, classes: Sequence[str]) -> DataFrame:
    """Batch scoring: predicted class, confidence (highest probability)
    and the probability of every class as a map."""
    out = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    names = F.array(*[F.lit(c) for c in classes])
    labeller = IndexToString(inputCol="prediction", outputCol="classe_predite", labels=list(classes))
    out = labeller.transform(out)
    return out.withColumns({
        "confiance": F.array_max(F.slice(probs, 1, len(classes))),
        "probabilites": F.map_from_arrays(names, F.slice(probs, 1, len(classes))),
    }).drop("features", "scaled", "rawPrediction", "probability")


def save_models(artifacts: dict, results: DataFrame, path: str) -> None:
    """Every fitted pipeline plus a one-row metadata table."""
    for name, model in artifacts["models"].items():
        model.write().overwrite().save(f"{path}/{name.lower()}_model")
    spark = results.sparkSession
    best_acc = results.where(F.col("is_best")).select("accuracy")
    meta = spark.createDataFrame(
        [(artifacts["best"], list(artifacts["features"]), list(artifacts["classes"]), artifacts.get("departments"))],
        "best_model_name STRING, features ARRAY<STRING>, classes ARRAY<STRING>, departments ARRAY<STRING>")
    meta = meta.withColumn("best_score", best_acc.agg(F.max("accuracy")).scalar())
    meta.write.mode("overwrite").parquet(f"{path}/metadata")
    results.write.mode("overwrite").parquet(f"{path}/results")


def load_models(spark: SparkSession, path: str) -> dict:
    meta = spark.read.parquet(f"{path}/metadata").first()  # one row
    models = {}
    for name in ("RandomForest", "LogisticRegression"):
        where = f"{path}/{name.lower()}_model"
        if files.exists(spark, where):  # a model may be absent; a broken one is an error
            models[name] = PipelineModel.load(where)
    return {"models": models, "best": meta["best_model_name"], "best_score": meta["best_score"],
            "features": list(meta["features"]), "classes": list(meta["classes"]),
            "departments": None if meta["departments"] is None else list(meta["departments"])}


# -- M12 / M13 -------------------------------------------------------------------
def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n) for every pair of classes seen on either
    side, zero-filled.  The class list is bounded by the classes, so the
    pair grid is classes x classes."""
    counts = df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    classes = (df.select(F.col(actual).alias("c")).union(df.select(F.col(predicted).alias("c")))
                 .where(F.col("c").isNotNull()).agg(F.array_sort(F.collect_set("c"))).scalar())
    seen = counts.select(actual, predicted)
    pairs = (seen.limit(1).select(F.explode(classes).alias(actual))
             .select(actual, F.explode(classes).alias(predicted)))   # the classes x classes grid
    return (pairs.join(counts, on=[actual, predicted], how="left")
                 .withColumn("n", F.coalesce("n", F.lit(0)).cast("long")))


def _cumulative(df: DataFrame, label: str, score_col: str) -> tuple[DataFrame, F.Column, F.Column]:
    """Per distinct score its positives and negatives and their running sums
    from the highest score on, and both totals.  The scores are dealt by range
    over as many tasks as a shuffle has and kept, so that the ranges stay the
    same; a range's running sums start at those of the ranges above it, which
    are summed up over one row for each range."""
    per = df.groupBy(F.col(score_col).alias("s")).agg(F.sum(F.col(label).cast("long")).alias("p"),
                                                      F.sum((1 - F.col(label)).cast("long")).alias("n"))
    placed = materialise(per.repartitionByRange(F.col("s").desc()).withColumn("r", F.spark_partition_id()))
    sums = placed.groupBy("r").agg(F.sum("p").alias("rp"), F.sum("n").alias("rn"))
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    above = sums.select("r", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("rp", "rn")])
    inside = Window.partitionBy("r").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = (placed.join(F.broadcast(above), "r")   # as many rows as tasks
           .select("s", "p", "n", (F.sum("p").over(inside) + F.col("rp")).alias("cp"), (F.sum("n").over(inside) + F.col("rn")).alias("cn")))
    return cum, placed.agg(F.sum("p")).scalar(), placed.agg(F.sum("n")).scalar()


def roc_curve(df: DataFrame, label: str, score_col: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest first, plus
    the (inf, 0, 0) start.  With one class only, the rate of the other is null."""
    cum, tp, tn = _cumulative(df, label, score_col)
    pts = cum.select(F.col("s").cast("double").alias("threshold"),
                     F.try_divide(F.col("cn"), tn).alias("fpr"), F.try_divide(F.col("cp"), tp).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold DOUBLE, fpr DOUBLE, tpr DOUBLE")
    return start.unionByName(pts)


def roc_auc(df: DataFrame, label: str, score_col: str) -> DataFrame:
    """Trapezoid area under the ROC curve (one row; null with one class only):
    each score adds its negatives times the mean of the positives before and
    with it."""
    cum, tp, tn = _cumulative(df, label, score_col)
    area = cum.agg(F.sum(F.col("n") * (F.col("cp") * 2 - F.col("p"))).alias("a"))
    return area.select(F.try_divide(F.col("a").cast("double") / 2, tp.cast("double") * tn).alias("auc"))


# -- M15 ---------------------------------------------------------------------
def prepare_socio_features(df: DataFrame, target: str, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str], list[str]]:
    """The 8 socio-economic features (participation rate and the seven
    indicators) standardised, and the target encoded alphabetically."""
    names = [c for c in S.SOCIO_FEATURES if c in df.columns]
    if not names:
        raise ValueError("no socio-economic feature available")
    x = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in names], F.col(target))
    x = standardise(x, names)
    x, classes = encode_labels(x.withColumn("__t", F.coalesce(F.col(target).cast("string"),
                                                               F.lit(UNKNOWN_CLASS))), "__t", "label")
    return x.drop("__t"), names, classes

