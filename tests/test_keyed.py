"""Joins with per-key tables: no shuffle of the rows beside a small table, no
hot task beside a large one; exact grouped selection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrutin.operators import keyed as K
from scrutin.operators import ml as M


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_table_leaves_the_rows_where_they_are(spark):
    rows = spark.range(1000).selectExpr("cast(id % 13 as int) k", "id", "'same' t")
    out = K.join_per_key(rows, rows.groupBy("k").agg(F.avg("id").alias("m")), ["k"])
    assert "Exchange hashpartitioning" not in plan(out) and "BroadcastExchange" in plan(out)
    assert out.count() == 1000


def partition_rows(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("equal", [False, True])
def test_hot_key_beside_a_large_table(spark, equal):
    """A key with 90 % of the rows, all different or all equal, stays in the tasks that read it."""
    n = 20_000
    hot = F.expr("if(id < 18000, 7, id % 3000)").alias("k")
    rows = spark.range(0, n, 1, 8).select(hot, F.lit(1).alias("v") if equal else F.col("id").alias("v")).repartition(8)
    per_key = spark.range(3000).selectExpr("id k", "id * 2 w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = K.join_per_key(rows, per_key, ["k"], broadcast_rows=100)
        assert max(partition_rows(out)) < 0.2 * n
        assert out.count() == n and out.where("w <> k * 2").count() == 0
        assert out.where("k = 7").count() >= 18000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast_rows", [100, 1])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_null_keys_and_missing_keys(spark, broadcast_rows, how):
    rows = spark.createDataFrame([(1, "a", 10)] * 5 + [(None, "a", 11), (2, None, 12), (3, "c", 13)], "x INT, y STRING, v INT")
    per_key = spark.createDataFrame([(1, "a", 1.0), (None, "a", 2.0), (2, None, 3.0), (9, "z", 4.0)], "x INT, y STRING, w DOUBLE")
    got = sorted((r.v, r.w) for r in K.join_per_key(rows, per_key, ["x", "y"], how, broadcast_rows).collect())
    assert got == [(10, 1.0)] * 5 + [(11, 2.0), (12, 3.0)] + ([(13, None)] if how == "left" else [])


def test_hot_hashes(spark):
    rows = spark.range(10_000).selectExpr("if(id < 5000, 1, id) k")
    want = spark.range(1).select(F.xxhash64(F.lit(1).cast("long"))).first()[0]
    assert K.hot_hashes(rows, ["k"]) == [want]
    assert K.hot_hashes(rows.limit(0), ["k"]) == []


@pytest.mark.parametrize("share", [0.1, 0.25, 0.3])
def test_stratified_split_is_exact(spark, share):
    """Each class gives ceil(share * n) rows, at any size; a class of one row gives none."""
    sizes = {"a": 300_000, "b": 1000, "c": 37, "d": 2, "e": 1, None: 50}
    df = None
    for label, n in sizes.items():
        part = spark.range(n).select(F.lit(label).cast("string").alias("label"), F.concat(F.lit(str(label)), "id").alias("key"))
        df = part if df is None else df.unionByName(part)
    out = M.stratified_split(df, "label", ["key"], share)
    got = {r.label: (r.n, r.t) for r in out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    for label, n in sizes.items():
        taken = got[label][1]
        # rows that share the last hash go together: 300,000 hashes of 32 bits have about 10 pairs
        assert got[label][0] == n and (taken == 0 if n == 1 else 0 <= taken - int(np.ceil(n * share)) <= 1)
