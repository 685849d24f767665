from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripgrain.operators import joins, keys


def test_dense_key_paths_agree(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").cast("string").alias("v"))
    one = keys.add_dense_key(df, ["k"], "n").orderBy("k").collect()
    many = keys.add_dense_key(df, ["k"], "n", one_task_bytes=0).orderBy("k").collect()
    assert one == many
    assert [r.n for r in one] == list(range(1, 5001))


def test_running_total_paths_agree(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("w"))
    one = keys.running_total(df, ["k"], "w", "t", one_task_bytes=1 << 40).orderBy("k").collect()
    many = keys.running_total(df, ["k"], "w", "t", one_task_bytes=0).orderBy("k").collect()
    assert one == many
    assert one[7].t == sum(i % 5 for i in range(7))


def test_require_unique(rows):
    df = rows([(1, 1), (1, 2), (1, 1)], "a int, b int")
    with pytest.raises(keys.DuplicateKeyError):
        keys.require_unique(df, ["a", "b"])
    assert keys.require_unique(df.distinct(), ["a", "b"]).count() == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(spark, rows, how):
    rng = random.Random(3)
    big = rows([(i, 0 if i % 3 == 0 else rng.randrange(40)) for i in range(900)] + [(900, None)], "id int, k int")
    small = rows([(k, f"v{k}") for k in range(0, 40, 2)], "k int, v string")
    plain = big.join(small, "k", how)
    split = joins.lookup_join(big, small, ["k"], ["id"], how, size=1 << 50, hot_rows=20)
    assert sorted(map(str, split.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_hot_key_is_spread(rows):
    big = rows([(i, 1) for i in range(1000)] + [(i, 2) for i in range(1000, 1010)], "id int, k int")
    small = rows([(1, "a"), (2, "b")], "k int, v string")
    left, right, on = joins.split_hot_keys(big, small, ["k"], ["id"], hot_rows=100)
    pieces = left.filter("k = 1").groupBy("_piece").count().collect()
    assert len(pieces) == 10 and max(p["count"] for p in pieces) < 200
    assert right.groupBy("k").count().orderBy("k").collect()[1]["count"] == 1
    assert left.join(right, on).count() == 1010


def test_copies_of_one_row_are_counted_before_the_split(rows):
    """Identical keys and identical spread columns still give every row exactly once."""
    big = rows([(7, 1)] * 500, "id int, k int")
    small = rows([(1, "a")], "k int, v string")
    assert joins.lookup_join(big, small, ["k"], ["id"], size=1 << 50, hot_rows=10).count() == 500


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_broadcast_and_large_side_is_not(spark):
    big = spark.range(10_000_000).withColumn("k", F.col("id") % 3)
    small = spark.range(3).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert "BroadcastHashJoin [k" in executed(joins.lookup_join(big, small, ["k"], ["id"]))
    split = executed(joins.lookup_join(big, small, ["k"], ["id"], size=1 << 50))
    assert "SortMergeJoin [k" in split and "_piece" in split


def test_nothing_is_broadcast_when_broadcasting_is_off(spark, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100).withColumn("k", F.col("id") % 3)
        small = spark.range(3).select(F.col("id").alias("k"), F.lit("a").alias("v"))
        assert joins.lookup_join(big, small, ["k"], ["id"], hot_rows=5).count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
