"""Operator 5: secret scan with a random forest against false positives.

Candidates are runs of at least MIN_LENGTH credential characters that hold a
digit (or 20 capitals), and the values that follow a credential word.  Each has features of its
own (length, character classes and transitions, entropy, share covered by
common words, path marks) and of its neighbours (credential, hash and
identifier words around it).  Findings are labelled by rules that are right by
form alone: published key formats and values behind a credential word are
secrets; Luhn numbers, dates, addresses, digests and identifiers named as such,
path parts and placeholders are not.  The forest learns from the labelled
findings without seeing which rule labelled them, and every finding, labelled
or not, gets its probability; a value of a published format stays a secret
whatever its probability.

At most MAX_LABELLED findings of each label train the forest, taken by a hash
of the finding (so copies of one value count once); the words that count as
common are those of at least COMMON documents in a thousand, WORDS at most.

Defined cases: a null text is empty and has no findings; without findings of
both labels the probability is 1 for labelled secrets, else 0; repeated rows
repeat their findings; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm.common import shuffle_partitions, stored
from scrutin.llm.textbytes import text_column

MIN_LENGTH = 12
MAX_LABELLED = 20_000
COMMON, WORDS = 1, 50_000
PART_WORDS = 1 << 17
SECRET_AT = 0.5
CONTEXT = 40

# FIXED VALUES: words that come before credentials, digests and identifiers
CREDENTIAL_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "credential", "bearer", "private_key")
DIGEST_WORDS = ("sha1", "sha256", "sha512", "md5", "checksum", "digest", "commit", "etag", "hash", "integrity")
IDENTIFIER_WORDS = ("uuid", "guid", "isbn", "doi", "version", "revision", "order", "invoice", "page", "row")
PLACEHOLDERS = ("example", "changeme", "placeholder", "your", "xxxx", "dummy", "sample", "test", "redacted")

# FIXED VALUES: published key formats
FORMATS = (
    r"AKIA[0-9A-Z]{16}", r"ASIA[0-9A-Z]{16}", r"AIza[0-9A-Za-z_-]{35}", r"gh[pousr]_[0-9A-Za-z]{36}", r"glpat-[0-9A-Za-z_-]{20}",
    r"xox[abprs]-[0-9A-Za-z-]{10,}", r"sk_live_[0-9A-Za-z]{16,}", r"eyJ[0-9A-Za-z_-]+\.eyJ[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+",
)
_FORMAT = re.compile("|".join(f"(?:{f})" for f in FORMATS))
_CANDIDATE = re.compile(
    r"(?i:(?<![A-Za-z])(?:" + "|".join(re.escape(w) for w in CREDENTIAL_WORDS) + r")s?[\"']?\s{0,2}[:=]\s{0,2}[\"']?)(?P<value>[^\s\"'<>,;]{6,})"
    rf"|(?<![A-Za-z0-9+/_.=-])(?P<run>(?=[A-Za-z+/_.=-]*[0-9]|[A-Z]{{20}})[A-Za-z0-9+/_.=-]{{{MIN_LENGTH},}})")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_NUMBER = re.compile(r"[0-9][0-9.:/+_-]*")
_WORD = re.compile(r"[a-z]{3,}")

FEATURES = ("length", "upper", "lower", "digit", "other", "changes", "entropy", "longest_run", "hex", "covered", "longest_word",
            "slashes", "dots", "extension", "assigned", "quoted", "credential_near", "digest_near", "identifier_near", "distinct")


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(value: str, before: str, after: str, common: frozenset[str]) -> list[float]:
    n = len(value)
    kinds = [_kind(c) for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1)
    count = Counter(value)
    run = longest = 1
    for a, b in zip(kinds, kinds[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    words = [w for w in _WORD.findall(value.lower()) if w in common]
    low, near = before.lower(), (before + " " + after).lower()
    return [
        math.log(n), kinds.count(2) / n, kinds.count(1) / n, kinds.count(0) / n, kinds.count(3) / n, changes,
        -sum(c / n * math.log2(c / n) for c in count.values()), longest / n, float(all(c in "0123456789abcdefABCDEF" for c in value)),
        sum(map(len, words)) / n, max(map(len, words), default=0) / n, value.count("/") / n, value.count(".") / n,
        float(bool(re.search(r"\.[a-z]{2,4}$", value))), float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:] in "\"'" and before != ""),
        float(any(w in low for w in CREDENTIAL_WORDS)), float(any(w in near for w in DIGEST_WORDS)),
        float(any(w in near for w in IDENTIFIER_WORDS)), len(count) / n,
    ]


def label(value: str, before: str) -> int | None:
    """1: a secret by form, 0: none by form, else None."""
    low = before.lower()
    if any(p in value.lower() for p in PLACEHOLDERS) or len(set(value)) <= 3:
        return 0
    if _FORMAT.fullmatch(value):
        return 1
    if _UUID.fullmatch(value) or _NUMBER.fullmatch(value) or any(re.search(w + r"\W*$", low) for w in DIGEST_WORDS) or value.count("/") >= 2:
        return 0
    if re.search(r"(?:" + "|".join(re.escape(w) for w in CREDENTIAL_WORDS) + r")s?[\"']?\s{0,2}[:=]\s{0,2}[\"']?$", low):
        return 1 if any(c.isdigit() for c in value) else None
    if not any(c.isdigit() for c in value):
        return 0
    return None


def candidates(text: str) -> Iterator[tuple[int, int]]:
    for m in _CANDIDATE.finditer(text):
        a, b = m.span("value") if m["value"] else m.span("run")
        while b > a and text[b - 1] in ".=-/" and not text[b - 1].isalnum():
            b -= 1
        if b - a >= 6:
            yield a, b


def _found(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: frozenset[str] = common.value
        for batch in batches:
            ids, starts, ends, values, labels, rows = [], [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), text_column(batch.column(1)).to_pylist()):
                for a, b in candidates(text):
                    value, before = text[a:b], text[max(0, a - CONTEXT): a]
                    ids.append(i)
                    starts.append(a)
                    ends.append(b)
                    values.append(value)
                    labels.append(label(value, before))
                    rows.append(features(value, before, text[b: b + CONTEXT], words))
            x = np.array(rows, np.float64).reshape(-1, len(FEATURES))
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(values, pa.string()), pa.array(labels, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))],
                names=["doc_id", "start", "end", "value", "label", "features"])
    return run


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word of the partition's texts and the documents that hold it, in
    parts of bounded size."""
    n: Counter[str] = Counter()

    def part() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in text_column(batch.column(0)).to_pylist():
            n.update(set(_WORD.findall(text.lower())))
            if len(n) > PART_WORDS:
                yield part()
                n.clear()
    if n:
        yield part()


def common_words(documents: DataFrame) -> frozenset[str]:
    total = documents.count()
    rows = (documents.select("text").mapInArrow(_word_rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= max(2, total * COMMON / 1000)).orderBy(F.desc("n"), "word").limit(WORDS).collect())  # WORDS rows at most
    return frozenset(r.word for r in rows)


def findings(documents: DataFrame) -> DataFrame:
    """doc_id, start, end (code points), value, label (by form; null for none),
    probability and is_secret of every candidate of every document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = documents.sparkSession.sparkContext.broadcast(common_words(docs))
    rows = stored(docs.mapInArrow(_found(common), "doc_id long, start long, end long, value string, label int, features array<double>"), "findings")
    known = rows.where("label is not null").groupBy(F.xxhash64("value").alias("key"), "label").agg(F.min("features").alias("features"))
    n = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        score = F.when(F.col("label") == 1, 1.0).otherwise(0.0)
        return rows.select("doc_id", "start", "end", "value", "label", score.alias("probability"), (score >= SECRET_AT).alias("is_secret"))
    share = F.when(F.col("label") == 1, min(1.0, MAX_LABELLED / n[1])).otherwise(min(1.0, MAX_LABELLED / n[0]))
    train = stored(known.where(F.pmod("key", F.lit(1_000_000)) < share * 1_000_000)
                   .select(array_to_vector("features").alias("x"), F.col("label").cast("double").alias("label"),
                           F.when(F.col("label") == 1, 1.0 / n[1]).otherwise(1.0 / n[0]).alias("weight"), "key")
                   # the forest's samples go by partition and row, so both follow the key alone
                   .repartition(shuffle_partitions(documents.sparkSession), "key").sortWithinPartitions("key", "label"), "train")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=40, maxDepth=8, seed=5,
                                    minInstancesPerNode=2, probabilityCol="p", predictionCol="predicted", rawPredictionCol="raw").fit(train)
    scored = forest.transform(rows.withColumn("x", array_to_vector("features")))
    p = vector_to_array("p")[1]
    return scored.select("doc_id", "start", "end", "value", "label", F.round(p, 6).alias("probability"),
                         ((p >= SECRET_AT) | F.col("value").rlike("^(?:" + "|".join(FORMATS) + ")$")).alias("is_secret"))
