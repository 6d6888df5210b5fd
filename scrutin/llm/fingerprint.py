"""Operator 8: document fingerprints as bottom-k sketches.

A sketch keeps the k least distinct 64-bit shingle hashes of a text.  Two
sketches merge into that of the texts' union by keeping the k least of both,
so parts of a text or of a corpus can be sketched apart.  ``resemblance``,
``containment`` and ``distinct_count`` estimate from sketches alone.

Defined cases: a null text is the empty text; a text without words has the
empty sketch, written as the empty string; two empty sketches are alike (1.0),
an empty and another are not (0.0).  Repeated rows are kept.  Equal ids are
ordered by a hash of their text, a null id comes first; a table of one row is
followed by itself.  Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm import textbytes as B
from scrutin.llm.common import shuffle_partitions

SKETCH = 128

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, n_shingles double, containment_next double")


def sketches(texts: list[str], k: int = SKETCH) -> list[np.ndarray]:
    """The bottom-k sketch of each text, ascending."""
    out = []
    batch = pa.record_batch({"text": pa.array(texts, pa.large_string())})
    for _, col in B.chunks(batch):
        h, off = B.shingles(B.words(col))
        for a, b in zip(off[:-1], off[1:]):
            x = np.unique(h[a:b])
            out.append(x[:k])
    return out


def merged(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twin = both[1:] == both[:-1]
    least = min(len(both) - int(twin.sum()), k)
    # the i-th distinct value ends the union's sketch
    distinct = np.concatenate([[True], ~twin])
    bound = both[distinct][least - 1]
    return float((both[1:][twin] <= bound).sum() / least)


def distinct_count(a: np.ndarray, k: int = SKETCH) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0 ** 64 / (float(a[-1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Estimated share of the first's shingles that the second holds."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    return min(1.0, j * distinct_count(merged(a, b, k), k) / distinct_count(a, k))


def written(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def read(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def _followed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(row, next row) for the own rows of each run of one bucket."""
    last = None
    for row in rows:
        if last is not None and last[0] == row[0] and last[2]:
            yield last, row
        last = row


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One output row for each own row and the row after it in its bucket."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for part, col in B.chunks(batch):
                texts = col.to_pylist()
                got = {n: part.column(part.schema.get_field_index(n)).to_pylist() for n in ("bucket", "doc_id", "own")}
                yield from zip(got["bucket"], got["doc_id"], got["own"], texts, sketches(texts))

    held: list[tuple] = []
    size = 0
    for pair in _followed(rows()):
        held.append(pair)
        size += len(pair[0][3])
        if size >= B.CHUNK_BYTES:
            yield _output(held)
            held, size = [], 0
    if held:
        yield _output(held)


def _output(pairs: list[tuple]) -> pa.RecordBatch:
    edited = []
    for (_, _, _, text, _), (_, _, _, after, _) in pairs:
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + after[:cut])
    new = sketches(edited)
    out = {
        "doc_id": [a[1] for a, _ in pairs],
        "n_chars": [len(a[3]) for a, _ in pairs],
        "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edited],
        "fingerprint": [written(a[4]) for a, _ in pairs],
        "edited_fingerprint": [written(x) for x in new],
        "near_edited": [resemblance(a[4], x) for (a, _), x in zip(pairs, new)],
        "near_next": [resemblance(a[4], b[4]) for a, b in pairs],
        "n_shingles": [distinct_count(a[4]) for a, _ in pairs],
        "containment_next": [containment(a[4], b[4]) for a, b in pairs],
    }
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    return pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def _bucket(key: Column, cuts: list[int]) -> Column:
    """The number of cuts below the key, by a coarse and a fine count; null goes to 0."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    below = lambda a: F.size(F.filter(a, lambda c: c < key))
    blocks = below(F.array(*[F.lit(c).cast("long") for c in cuts[::step]]))
    first = F.greatest(blocks - 1, F.lit(0)) * step
    fine = F.slice(F.array(*[F.lit(c).cast("long") for c in cuts]), first + 1, F.lit(step))
    return F.when(key.isNull(), 0).otherwise(first + below(fine)).cast("int")


def fingerprints(documents: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the last
    quarter replaced by the start of the next document), and how near they are.

    Each text is shuffled once, to a bucket of ids between two quantiles; the
    first row of a bucket goes also, as a look-ahead, to the bucket before it.
    The driver holds one id per bucket, four buckets per shuffle partition.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = min(4 * shuffle_partitions(spark), 10_000)
    cuts = sorted({int(c) for c in docs.approxQuantile(["doc_id"], [i / n for i in range(1, n)], 1.0 / (4 * n))[0]})
    whole = docs.select(_bucket(F.col("doc_id"), cuts).alias("bucket"), "doc_id",
                        F.xxhash64("text").alias("order"), "text", F.lit(True).alias("own"))
    firsts = [(r.bucket, r.first.doc_id, r.first.order) for r in
              whole.groupBy("bucket").agg(F.min(F.struct("doc_id", "order")).alias("first")).orderBy("bucket").collect()]
    if not firsts:
        return spark.createDataFrame([], SCHEMA)
    # each bucket's first row is the look-ahead of the one before; the very first follows the last
    ahead = spark.createDataFrame(
        [(firsts[i - 1][0], f[1], f[2]) for i, f in enumerate(firsts)], "to_bucket int, f_id long, f_order long")
    looks = (whole.join(F.broadcast(ahead), F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("order") == F.col("f_order")))
             .dropDuplicates(["to_bucket"])
             .select(F.col("to_bucket").alias("bucket"), "doc_id", "order", "text", F.lit(False).alias("own")))
    dealt = (whole.unionByName(looks).repartition(n, "bucket")
             .sortWithinPartitions("bucket", F.col("own").desc(), F.col("doc_id").asc_nulls_first(), "order"))
    return dealt.select("bucket", "doc_id", "own", "text").mapInArrow(_pairs, SCHEMA)
