"""Clashing columns in every stage, sums past 64 bits, kept rows, long lines."""

import time

import numpy as np
import pytest

from scrutin.llm import decontamination, mixing, neardup, pii
from scrutin.llm.common import unused

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
CLASHES = ["h_id", "H_VERSION", "_id", "_key", "_text_key", "kept_id", "text_key", "mix_size", "mix_id", "draw", "node", "rid", "group", "size", "version"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"{WORDS} {i}" if i % 3 else f"{WORDS} copy", "s", *["x"] * len(CLASHES)) for i in range(12)] + [(None, None, None, *["y"] * len(CLASHES))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES))


def test_unused(spark):
    df = spark.createDataFrame([(1, 2)], "A int, a_ int")
    assert unused(df, "a", "b", "b") == ["a__", "b", "b_"]


def test_stages_keep_columns_whose_names_they_use(spark, clashing):
    bench = spark.createDataFrame([(1, " ".join(f"other{i}" for i in range(10)))], "item_id long, text string")
    clean = decontamination.clean_documents(clashing, bench)
    assert clean.columns == clashing.columns and clean.count() == 13
    one = neardup.deduplicate(clashing)
    # shingles of 16 words, one of which differs: 11 of 13 are shared by any two
    assert one.columns == clashing.columns and sorted((r.doc_id is None, r._id) for r in one.collect()) == [(False, "x"), (True, "y")]
    mix = mixing.mixture(clashing)
    assert mix.columns[:len(clashing.columns)] == clashing.columns and "mix_size_" in mix.columns and "mix_taken" in mix.columns
    assert {r.mix_size for r in mix.collect()} == {"x"}


@pytest.mark.parametrize("counts, lengths, share", [([2_000_000_000, 3_000_000_000], [400, 500], 0.5), ([10 ** 9] * 3, [7, 11, 20_000], 0.99), ([5], [10 ** 6], 0.7), ([3, 2], [70_000, 200_000], 0.8)])
def test_fits_of_many_and_of_long_documents(counts, lengths, share):
    counts, lengths = np.array(counts, np.int64), np.array(lengths, np.int64)
    budget = float(int((counts * lengths).sum()) * share)
    got = mixing.fitted(lengths, counts, budget)
    short = round(budget) - int((got * lengths).sum())
    left = lengths[got < counts]
    assert (got >= 0).all() and (got <= counts).all() and 0 <= short and (not len(left) or short < left.min())


@pytest.mark.parametrize("parts", [1, 8])
def test_the_kept_row_does_not_depend_on_the_layout(spark, parts):
    rows = [(i, f"{WORDS} word{i % 2}") for i in range(40, 0, -1)] + [(7, "a text of its own"), (None, f"{WORDS} word0")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.coalesce(1) if parts == 1 else df.repartition(parts)
    got = neardup.near_duplicates(df).collect()
    assert sorted(r.doc_id for r in got if r.keep) == [1, 7] and {r.group_doc_id for r in got} == {1, 7}
    assert sorted((r.doc_id, r.group_size) for r in got if r.keep) == [(1, 41), (7, 1)]


def test_one_long_line_takes_linear_time():
    cue = "x" * 30 + " 12 Long Street "
    took = []
    for n in (20_000, 200_000):
        text = "y" * 400_000 + cue * 3 + "abcstreet" * n   # cues at the end of one endless word
        t = time.process_time()
        found = pii.find(text)
        took.append(time.process_time() - t)
        assert len(found.get("address", ())) >= 1
    assert took[1] < 40 * max(took[0], 0.05)


def test_beta_probabilities(spark):
    """Against Simpson's rule over the log odds, and closed forms."""
    from pyspark.sql import functions as F

    from scrutin.llm import urls
    rng = np.random.default_rng(0)
    ab = [(float(a), float(b)) for a, b in zip(10 ** rng.uniform(-0.5, 4, 40), 10 ** rng.uniform(-0.5, 4, 40))] + [(1.0, 1.0), (1.0, 3.0), (3.0, 1.0), (50_000.0, 50_100.0)]
    df = spark.createDataFrame(ab, "a double, b double")
    for at in (0.5, 0.2):
        got = {(r.a, r.b): r.p for r in df.select("a", "b", urls.beta_below(F.col("a"), F.col("b"), at).alias("p")).collect()}
        for a, b in ab:
            cut = np.log(at / (1 - at))
            mass = []
            for lo, hi in ((-120.0, cut), (cut, 120.0)):
                y = np.linspace(lo, hi, 200_001)
                w = np.exp(a * y - (a + b) * np.log1p(np.exp(y)) - a * np.log(a / (a + b)) - b * np.log(b / (a + b)))
                mass.append((w[0] + w[-1] + 4 * w[1::2].sum() + 2 * w[2:-1:2].sum()) * (hi - lo))
            assert abs(got[a, b] - mass[0] / sum(mass)) < 1e-6, (a, b)
        assert abs(got[1.0, 3.0] - (1 - (1 - at) ** 3)) < 1e-11 and abs(got[3.0, 1.0] - at ** 3) < 1e-11


def test_a_port_is_no_part_of_the_domain(spark):
    from scrutin.llm import urls
    rows = [(f"h{i}.example.com:8080", 1) for i in range(40)] + [("clean.example.com", None)]
    got = {r.host: r for r in urls.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    # the host without outcomes has the reputation of the domain that it shares with the others
    assert got["clean.example.com"].mean > 0.9 and got["h1.example.com:8080"].n == 1
