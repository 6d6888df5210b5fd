"""The common words, and with them the findings, do not depend on the layout."""

import collections
import re

import numpy as np

from scrutin.llm import secrets


def test_one_and_many_partitions_give_equal_findings(spark):
    rng = np.random.default_rng(6)
    hexes = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    names = ["harbour", "meadow", "lantern", "copper", "orchard", "a" * 35]
    texts = [f"{names[i % 6]} password={hexes(18)} {names[(i + 1) % 6]}{i}{names[(i + 2) % 6]} only{hexes(3)} commit {hexes(40)}" for i in range(48)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = df.coalesce(1), df.repartition(48, "doc_id")
    held = collections.Counter(w for t in texts for w in set(re.findall("[a-z]{3,}", t.lower())))
    common = {w for w, n in held.items() if n > 1}
    assert set(names) < common
    assert secrets.common_words(one) == common == secrets.common_words(many)
    rows = [sorted(secrets.findings(x).collect(), key=lambda r: (r.doc_id, r.start)) for x in (one, many)]
    assert rows[0] == rows[1]
