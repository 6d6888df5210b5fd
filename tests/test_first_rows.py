"""W1 in two steps, the kept results table, and the label clean-up."""

import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import REGISTRY
from scrutin.functions import exprs as X
from scrutin.operators import clean as C
from scrutin.operators import ml as M

KEYS = ["annee", "nuance"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows():
    """Keys with nulls, order columns with nulls and ties, rows that come twice, null payload."""
    rows = []
    for i in range(1200):
        annee, nuance = (2012 + i % 3, None if i % 4 == 0 else "RN" if i % 4 == 1 else "PS")
        first = None if annee == 2013 and i % 50 < 3 else i % 7 + annee % 3
        rows.append((annee, nuance, first, None if i % 11 == 0 else i // 2 % 90, None if i % 5 == 0 else f"p{i // 2}"))
    return rows + rows[:40]


def _first(rows):
    """Plain Python: the least (a, b) per key, null before any value."""
    best = {}
    for r in rows:
        rank = tuple((v is not None, v or 0) for v in (*r[2:4], r[4]))
        if r[:2] not in best or rank < best[r[:2]][0]:
            best[r[:2]] = (rank, r)
    return sorted((str(r) for _, r in best.values()))


@pytest.mark.parametrize("kind", ["long", "double", "string"])
@pytest.mark.parametrize("most", [C.MAX_LEAST_VALUES, 3])
def test_first_rows_against_plain_python(spark, monkeypatch, kind, most):
    monkeypatch.setattr(C, "MAX_LEAST_VALUES", most)
    rows = _rows()
    df = spark.createDataFrame(rows, "annee INT, nuance STRING, a LONG, b INT, p STRING").repartition(5)
    got = C.first_per_key(df.withColumn("a", F.col("a").cast(kind)), KEYS, ["a", "b", "p"]).withColumn("a", F.col("a").cast("long"))
    assert sorted(str(tuple(r)) for r in got.collect()) == _first(rows)


def test_first_rows_of_no_rows(spark):
    df = spark.createDataFrame([], "annee INT, nuance STRING, a LONG, p STRING")
    assert C.first_per_key(df, KEYS, ["a", "p"]).count() == 0


def test_only_rows_that_may_be_first_are_sorted(spark):
    n = 3000
    left = spark.range(n).select((F.col("id") % 2).alias("annee"), F.col("id").alias("k"))
    right = spark.range(n).select(F.col("id").alias("k2"), F.lit("RN").alias("nuance"), F.lit("x").alias("p"))
    out = C.first_per_key(left.join(right, F.col("k") == F.col("k2")).drop("k2"), KEYS, ["k", "p"])
    plan = _plan(out)
    assert "LeftSemi" in plan and plan.index("SortAggregate") < plan.index("LeftSemi")  # below the aggregate
    assert " IN (0,1)" in plan  # the two least values reach the inputs of the join
    assert sorted(map(tuple, out.collect())) == [(0, 0, "RN", "x"), (1, 1, "RN", "x")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few hundred orders of our own."""
    d = str(tmp_path_factory.mktemp("tables"))
    i = F.col("id")
    spark.range(40).select(i.alias("c_custkey"), F.format_string("c%d", i).alias("c_name"), (i % 25).cast("int").alias("c_nationkey")
                           ).write.parquet(f"{d}/customer.parquet")
    spark.range(300).select(i.alias("o_orderkey"), (i % 40).alias("o_custkey"), (i * 37.5 + 9000).alias("o_totalprice"),
                            F.expr("timestamp_ntz'1995-03-01' + make_interval(id % 7)").alias("o_orderdate")
                            ).write.parquet(f"{d}/orders.parquet")
    spark.range(1500).select((i % 300).alias("l_orderkey"), (i % 7 + 1).cast("int").alias("l_linenumber"), (i * 7 % 200).alias("l_partkey"),
                             (i % 10).alias("l_suppkey"), (i * 11.0 + 900).alias("l_extendedprice")).write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("name", ["merge_datasets", "key_union"])
def test_ballots_are_not_read_again_by_every_branch(spark, tables, name):
    out = REGISTRY[name].spark(spark, tables)
    assert "lineitem.parquet" not in _plan(out)  # the branches read the kept results table
    assert out.count() > 0


def test_kept_results_are_the_results(spark, tables):
    a, b = I.kept_results(spark, tables), I.results(spark, tables)
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []


def test_strip_removes_what_unicode_calls_white_space(spark):
    ws = r"[\s\x1C-\x1F\x85\p{Z}]"
    c = F.col("chr_")
    chars = spark.createDataFrame([(chr(i),) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000], "chr_ STRING")
    text = F.concat(c, F.lit(" "), c, F.lit("a b"), c, F.lit("\n"))
    got = chars.select("chr_", X.strip(text).alias("now"),
                       F.regexp_replace(F.regexp_replace(text, f"^{ws}+", ""), f"{ws}+$", "").alias("was"))
    assert got.where(~F.col("now").eqNullSafe(F.col("was"))).count() == 0


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "_train_and_select", lambda df, keys: seen.append((df.rdd.getNumPartitions(), df.count())))
    rows = spark.range(1100).select("id", F.lit(2017).alias("annee"), F.lit("RN").alias("nuance"))
    M.train_and_select(rows.repartition(64), ["id"])
    M.train_and_select(rows.where("id < 5").repartition(64), ["id"])
    M.train_and_select(rows.repartition(2), ["id"])
    assert seen == [(2, 1100), (1, 5), (2, 1100)]
