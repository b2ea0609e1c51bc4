"""Row numbers, batches and tokens against brute force, with hot keys and copies."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.batches import batch_token, cut_batches, token_error
from quayside.operators.index import range_sorted, with_group_index, with_row_index
from quayside.operators.route import route


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, k int, v string").repartition(7, "v")


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    rows = [("hot", 5, "same")] * 700 + [("hot", 5, f"v{i}") for i in range(300)]
    rows += [(rng.choice("abcdef"), rng.randrange(40), f"w{i}") for i in range(1000)] + [(None, 1, "n")] * 50
    rng.shuffle(rows)
    return rows


def test_global_index_is_the_sorted_position(spark, skewed):
    got = with_row_index(frame(spark, skewed), ["k", "g", "v"]).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(len(skewed)))
    key = lambda r: (r[1], r[0] is not None, r[0] or "", r[2])
    assert [tuple(r)[:3] for r in got] == sorted(skewed, key=key)


def test_descending_and_reading_order(spark, skewed):
    got = with_row_index(frame(spark, skewed), [F.desc("k"), "v"]).orderBy("row_index").collect()
    assert [(-r["k"], r["v"]) for r in got] == sorted((-k, v) for _, k, v in skewed)
    ordered = frame(spark, skewed).orderBy("v", "k")
    got = with_row_index(ordered).orderBy("row_index").collect()
    assert [(r["v"], r["k"]) for r in got] == sorted((v, k) for _, k, v in skewed)


def test_hot_key_and_copies_are_spread(spark, skewed):
    sizes = [r["count"] for r in range_sorted(frame(spark, skewed), ["k"], partitions=8).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < len(skewed) / 3
    only_copies = frame(spark, [("hot", 5, "same")] * 4000)
    sizes = [r["count"] for r in range_sorted(only_copies, ["k"], partitions=8).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500 and sum(sizes) == 4000


def test_group_index(spark, skewed):
    got = with_group_index(frame(spark, skewed), ["g"], ["k", "v"]).collect()
    assert len(got) == len(skewed)
    for g in {r[0] for r in skewed}:
        mine = sorted(((r["row_index"], r["k"], r["v"]) for r in got if r["g"] == g))
        assert [i for i, _, _ in mine] == list(range(len(mine)))
        assert [(k, v) for _, k, v in mine] == sorted((k, v) for x, k, v in skewed if x == g)


@pytest.mark.parametrize("n,size,expected", [(0, 5, []), (5, 2, [2, 2, 1]), (4, 2, [2, 2]), (1, 100, [1])])
def test_batches_are_full_but_the_last(spark, n, size, expected):
    rows = spark.range(n).withColumn("t", F.lit("load-42"))
    for order in (["id"], None):
        cut = cut_batches(rows, order, size).withColumn("token", batch_token(F.col("t"), F.col("batch_index")))
        got = cut.groupBy("batch_index", "token").count().orderBy("batch_index").collect()
        assert [r["count"] for r in got] == expected
        assert [r["token"] for r in got] == ["load-42" if i == 0 else f"load-42-{i}" for i in range(len(expected))]


def test_the_same_batches_whatever_the_layout(spark, skewed):
    def cut(df, n):
        df = df.where("g is not null").repartition(n)
        return sorted(tuple(r) for r in cut_batches(df, ["k"], 100, "g", "g").collect())

    assert cut(frame(spark, skewed), 3) == cut(frame(spark, skewed), 11)


def test_missing_tokens(spark):
    rows = spark.createDataFrame([("a",), (None,), ("",), (" \t",)], "tag string").select("tag", token_error("tag").alias("why"))
    assert [r["why"] is None for r in rows.collect()] == [True, False, False, False]
    assert rows.select(token_error("none").alias("w")).where("w is not null").isEmpty()


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        cut_batches(spark.range(1), None, 0)
    with pytest.raises(ValueError):
        cut_batches(spark.range(1), None, 5, load_id="id")
    with pytest.raises(ValueError):
        route(spark.range(1), "table")
