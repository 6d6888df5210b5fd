"""Quality scores against plain Python: statistics word by word, ridge by one
solve over all labelled rows, isotonic means by the max-min formula."""

import re
import zlib

import numpy as np
import pytest

from scrutin.llm import quality

CLASSES = [lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128, lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57, lambda c: c in b".!?",
           lambda c: c in b",;:", lambda c: c in b"#$%&*@^~=+<>\\_`", lambda c: c in b"|/", lambda c: c in b"()[]{}\"'", lambda c: c == 10]


def statistics(text):
    raw = (text or "").encode()
    words = [w.lower() if w.isascii() else re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
    n, some = len(words), max(len(words), 1)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / some
    grams = [tuple(words[i:i + 3]) for i in range(max(n - 2, 1))] if n else []
    return [np.log1p(len(raw)), np.log1p(n), *[np.log1p(sum(map(f, raw)) / some) for f in CLASSES],
            mean, np.sqrt(max(sum(x * x for x in lengths) / some - mean ** 2, 0.0)), sum(x >= 20 for x in lengths) / some,
            sum(a == b for a, b in zip(words, words[1:])) / some, len(set(words)) / some, np.log(max(len(set(words)), 1)) / np.log(max(some, 2)),
            max(map(words.count, set(words)), default=0) / some, len(set(grams)) / max(len(grams), 1)]


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def texts():
    rng = np.random.default_rng(11)
    good = [" ".join(f"Word{rng.integers(90)}" for _ in range(rng.integers(3, 50))) + ".\n(Fin), " + "é" * (i % 3) for i in range(220)]
    bad = [" | ".join(["x", "12", "buy-now"][k] for k in rng.integers(0, 3, rng.integers(1, 40))) + " #" * (i % 4) for i in range(120)]
    return [*good, *bad, None, "", "one", "a a a a", "y" * 70_000]


def test_statistics_match_a_plain_count():
    import pyarrow as pa
    data = [t or "" for t in texts()]
    assert np.allclose(quality.statistics(pa.array(data, pa.large_string())), [statistics(t) for t in data], rtol=1e-9, atol=1e-9)


def plain_scores(data, labels):
    x = np.array([statistics(t) for _, t in data])
    y = {i: q for i, q in labels.items() if fold(i) != 0}
    at = {i: k for k, (i, _) in enumerate(data)}
    train, held = [i for i in y if fold(i) != 4], [i for i in y if fold(i) == 4]
    xt, yt = x[[at[i] for i in train]], np.array([float(y[i]) for i in train])
    z = lambda v: quality.fourier(v, xt.mean(0), np.maximum(xt.std(0), 1e-6))
    a = np.vstack([z(xt), np.sqrt(quality.RIDGE) * np.eye(quality.FEATURES + x.shape[1] + 1)])
    w = np.linalg.lstsq(a, np.concatenate([yt, np.zeros(a.shape[0] - len(yt))]), rcond=None)[0]
    raw = z(x) @ w
    bins = {}
    for i in held:
        bins.setdefault(np.round(np.clip(raw[at[i]], -1, 2) / quality.BIN), []).append((raw[at[i]], float(y[i])))
    order = [bins[b] for b in sorted(bins)]
    n = np.array([len(b) * 1.001 for b in order])
    total = np.array([sum(q for _, q in b) + 0.001 * len(b) * yt.mean() for b in order])
    middle = np.array([np.mean([r for r, _ in b]) for b in order])
    k = len(order)
    level = [max(min(total[i:j + 1].sum() / n[i:j + 1].sum() for j in range(m, k)) for i in range(m + 1)) for m in range(k)]
    knots = sorted({round(v, 12) for v in level})
    xs = [np.average([middle[m] for m in range(k) if round(level[m], 12) == v], weights=[n[m] for m in range(k) if round(level[m], 12) == v]) for v in knots]
    return np.clip(np.interp(raw, xs, knots), 0, 1)


@pytest.mark.parametrize("parts", [1, 5])
def test_scores_match_one_solve_over_all_rows(spark, parts):
    data = list(enumerate(texts()))
    labels = {i: int(i < 220) ^ (i % 11 == 0) for i in range(0, 340) if i % 6}
    got = {r.doc_id: r.score for r in quality.quality_scores(
        spark.createDataFrame(data, "doc_id long, text string").repartition(parts),
        spark.createDataFrame([(i, q) for i, q in labels.items()], "doc_id long, quality int")).collect()}
    want = plain_scores(data, labels)
    assert len(got) == len(data) and np.allclose([got[i] for i, _ in data], want, atol=1e-6)


def test_bound_on_labelled_ids(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_LABELLED", 60)
    data = list(enumerate(texts()[:340]))
    df, labels = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([(i, int(i < 220)) for i in range(340)], "doc_id long, quality int")
    one = {r.doc_id: r.score for r in quality.quality_scores(df.coalesce(1), labels).collect()}
    many = {r.doc_id: r.score for r in quality.quality_scores(df.repartition(6), labels.repartition(3)).collect()}
    assert one.keys() == many.keys() and np.allclose([one[i] for i in one], [many[i] for i in one], atol=1e-6)
    assert np.mean([(one[i] >= 0.3) == (i < 220) for i in one]) > 0.95
