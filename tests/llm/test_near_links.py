"""Links are found by set similarity, whatever the counts of a passage."""

import numpy as np

from scrutin.llm import neardup

VOCABULARY = [f"w{i:03d}" for i in range(400)]


def test_texts_written_twice_and_three_times_are_linked(spark):
    rng = np.random.default_rng(8)
    bases = [" ".join(rng.choice(VOCABULARY, 204)) for _ in range(12)]
    df = spark.createDataFrame([(10 * i + n, " ".join([t] * n)) for i, t in enumerate(bases) for n in (1, 2, 3)], "doc_id long, text string")
    got = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    for i in range(len(bases)):
        assert len({got[10 * i + n].group for n in (1, 2, 3)}) == 1
    assert {r.group_size for r in got.values()} == {3}
