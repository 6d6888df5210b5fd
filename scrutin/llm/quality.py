"""Operator 3: quality scores from random Fourier features.

Each text gives a vector of document statistics.  Random Fourier features of
the standardised vector approximate a Gaussian kernel; partitions sum their
normal equations, the driver solves the ridge system of fixed size and an
isotonic regression on a part of the labelled rows that the ridge fit has not
seen turns raw fits into probabilities.

Labels are learnt from rows whose crc32(doc_id as text) mod 5 is not 0: folds
1 to 3 fit the ridge, fold 4 the calibration.  MAX_LABELLED bounds the labelled
ids and the rows of either fit; beyond it they are taken by a hash of the id.
Every document is scored over its whole text; labels, lang, source and doc_id
are no inputs.

Defined cases: null and empty texts have the statistics of the empty text and
a score; labels that are null are left out, several of one id are averaged
(0.5 and over count as 1); without any label, or with labels of one kind, the
score is their mean (0.5 without); repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import textbytes as B
from scrutin.llm.common import fold_of, stored

MAX_LABELLED = 100_000
FEATURES = 256
GAMMA = 0.05
RIDGE = 1e-2
KEEP_AT = 0.3
#: Raw fits are gathered in bins of this width for the isotonic fit.
BIN = 0.002
FIT_PARTITIONS = 16

_CLASSES = {
    "letters": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "upper": [*range(65, 91)],
    "digits": [*range(48, 58)],
    "stops": [*b".!?"],
    "commas": [*b",;:"],
    "symbols": [*b"#$%&*@^~=+<>\\_`"],
    "bars": [*b"|/"],
    "brackets": [*b"()[]{}\"'"],
    "lines": [10],
}


def statistics(col: pa.Array) -> np.ndarray:
    """One row of statistics per text of a ``text_column``."""
    data, off = B.buffers(col)
    size = np.diff(off).astype(np.float64)
    w = B.words(col, B.SPACE)
    n = np.diff(w.offsets).astype(np.float64)
    some = np.maximum(n, 1.0)
    out = [np.log1p(size), np.log1p(n)]
    for members in _CLASSES.values():
        member = np.zeros(256, dtype=bool)
        member[members] = True
        total = np.concatenate([[0], np.cumsum(member[data])])
        out.append(np.log1p((total[off[1:]] - total[off[:-1]]) / some))
    length = (w.ends - w.starts).astype(np.float64)
    doc = np.repeat(np.arange(len(col)), np.diff(w.offsets))
    by_doc = lambda x: np.bincount(doc, x, minlength=len(col)) / some
    mean = by_doc(length)
    out += [mean, np.sqrt(np.maximum(by_doc(length ** 2) - mean ** 2, 0.0)), by_doc(length >= 20)]
    same = np.zeros(len(doc))
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (doc[1:] == doc[:-1])
    out.append(by_doc(same))
    # runs of equal words after sorting: distinct words and the commonest word's share
    by = np.lexsort((w.hashes, doc))
    h, d = w.hashes[by], doc[by]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(h))).astype(np.float64)
    distinct = np.bincount(d[first], minlength=len(col)) if len(h) else np.zeros(len(col))
    most = np.zeros(len(col))
    np.maximum.at(most, d[first], count)
    out += [distinct / some, np.log(np.maximum(distinct, 1)) / np.log(np.maximum(some, 2)), most / some]
    sh, so = B.shingles(w, 3)
    ds = np.repeat(np.arange(len(col)), np.diff(so))
    by = np.lexsort((sh, ds))
    new = np.concatenate([[True], (sh[by][1:] != sh[by][:-1]) | (ds[by][1:] != ds[by][:-1])]) if len(sh) else np.zeros(0, bool)
    out.append(np.bincount(ds[by][new], minlength=len(col)) / np.maximum(np.diff(so), 1))
    return np.column_stack(out)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, col in B.chunks(batch):
            x = statistics(col)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.record_batch([*part.drop_columns(["text"]).columns, lists], names=[*part.drop_columns(["text"]).schema.names, "stats"])


def matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.knots), 0.0, 1.0)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of the Gaussian kernel exp(-GAMMA |x-y|^2), and
    the statistics themselves and a constant."""
    rng = np.random.default_rng(7)
    z = np.clip((x - mean) / scale, -8.0, 8.0)
    freq = rng.normal(0.0, np.sqrt(2.0 * GAMMA), (x.shape[1], FEATURES))
    phase = rng.uniform(0.0, 2.0 * np.pi, FEATURES)
    return np.column_stack([np.sqrt(2.0 / FEATURES) * np.cos(z @ freq + phase), 0.05 * z, np.ones(len(z))])


def isotonic(x: np.ndarray, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, mean) of the increasing fit to sums over ascending bins, by
    pooling neighbours that are out of order."""
    blocks: list[list[float]] = []
    for a, t, c in zip(x, total, n):
        blocks.append([a * c, t, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def _bounded(rows: DataFrame) -> DataFrame:
    n = rows.count()
    if n <= MAX_LABELLED:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * MAX_LABELLED / n))


def _sums(mean: np.ndarray, scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = rhs = None
        for batch in batches:
            z = fourier(matrix(batch.column(0)), mean, scale)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            gram = z.T @ z + (0.0 if gram is None else gram)
            rhs = z.T @ y + (0.0 if rhs is None else rhs)
        if gram is not None:
            yield pa.record_batch([pa.array([gram.tobytes()], pa.binary()), pa.array([rhs.tobytes()], pa.binary())], names=["gram", "rhs"])
    return run


def _raw(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(model.raw(matrix(batch.column(0)))), batch.column(1)], names=["raw", "y"])
    return run


def fit(rows: DataFrame, stats: int) -> Model:
    """A model from rows (doc_id, y, fold, stats); fold 4 calibrates, the others fit."""
    train = stored(_bounded(rows.where("fold <> 4")).select("stats", "y").repartition(FIT_PARTITIONS), "train")
    moments = train.select([F.avg(F.col("stats")[i]) for i in range(stats)] + [F.stddev_pop(F.col("stats")[i]) for i in range(stats)]
                           + [F.avg("y"), F.max("y"), F.min("y")]).first()
    mean_y, top, low = moments[-3:]
    if mean_y is None or top == low:
        flat = 0.5 if mean_y is None else float(mean_y)
        return Model(np.zeros(stats), np.ones(stats), np.zeros(FEATURES + stats + 1), (np.array([0.0]), np.array([flat])))
    mean, scale = np.array(moments[:stats]), np.maximum(np.array(moments[stats: 2 * stats]), 1e-6)
    size = FEATURES + stats + 1
    sums = train.mapInArrow(_sums(mean, scale), "gram binary, rhs binary").collect()  # FIT_PARTITIONS rows at most
    gram = sum(np.frombuffer(s.gram).reshape(size, size) for s in sums)
    rhs = sum(np.frombuffer(s.rhs) for s in sums)
    weights = np.linalg.solve(gram + RIDGE * np.eye(size), rhs)
    model = Model(mean, scale, weights, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    held = _bounded(rows.where("fold = 4")).select("stats", "y").mapInArrow(_raw(model), "raw double, y double")
    bins = (held.select(F.round(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) / BIN).alias("bin"), "raw", "y")
            .groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("y").alias("total"), F.count("*").alias("n")).orderBy("bin").collect())
    if bins:
        # a thousandth of every bin at the mean label keeps scores off 0 and 1
        x = np.array([b.raw for b in bins])
        total, n = np.array([b.total for b in bins]), np.array([float(b.n) for b in bins])
        model.knots = isotonic(x, total + 0.001 * n * mean_y, n * 1.001)
    return model


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, col in B.chunks(batch):
                s = model.score(statistics(col))
                yield pa.record_batch([part.column(0), part.column(1), pa.array(s), pa.array((s >= KEEP_AT).astype(np.int32))],
                                      names=["doc_id", "held_out", "score", "predicted"])
    return run


def learnt(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents outside fold 0.  Only the rows of
    either fit have their statistics computed: their ids, MAX_LABELLED for each
    fit at most, meet the texts by a broadcast join."""
    marks = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg("quality") >= 0.5).cast("double").alias("y")).withColumn("fold", fold_of()).where("fold <> 0"))
    marks = stored(marks, "marks")
    few = _bounded(marks.where("fold <> 4")).unionAll(_bounded(marks.where("fold = 4")))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stats = len(statistics(pa.array([""], pa.large_string()))[0])
    rows = (texts.join(F.broadcast(few), "doc_id").select("doc_id", "y", "fold", "text")
            .mapInArrow(_stats, "doc_id long, y double, fold long, stats array<double>"))
    return fit(stored(rows, "labelled"), stats)


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = learnt(documents, labels)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scored(model), "doc_id long, held_out boolean, score double, predicted int")


def _kept(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, col in B.chunks(batch):
                yield part.filter(pa.array(model.score(statistics(col)) >= KEEP_AT))
    return run


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, whole rows, that the classifier does not reject."""
    return documents.mapInArrow(_kept(learnt(documents, labels)), documents.schema)
