from collections import Counter

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import sampling


@pytest.fixture
def interactions(spark):
    data = [(1, 10)] + [(2, i) for i in (10, 11)] + [(3, i) for i in range(10, 13)] + [(4, i) for i in range(10, 40)]
    return spark.createDataFrame(data, "user_id int, item_id int")


def _labels(df):
    counted = Counter((r["user_id"], r["model_data_partition"]) for r in df.collect())
    return {u: {p: n for (v, p), n in counted.items() if v == u} for u, _ in counted}


def test_three_way_split(interactions):
    got = _labels(sampling.split_train_validate_test(interactions, "user_id", ["item_id"], 5))
    assert got[1] in ({"test": 1}, {"validate": 1})
    assert got[2] == {"test": 1, "validate": 1}
    assert got[3] == {"test": 1, "validate": 1, "train": 1}
    assert got[4] == {"test": 1, "validate": 1, "train": 28}


def test_leave_one_out(interactions):
    got = _labels(sampling.split_leave_one_out(interactions, "user_id", ["item_id"], 5))
    assert got == {1: {"train": 1}, 2: {"validate": 1, "train": 1}, 3: {"validate": 1, "train": 2}, 4: {"validate": 1, "train": 29}}


def test_samples_do_not_depend_on_partitioning(spark, interactions, rows):
    for make in (
        lambda d: sampling.split_leave_one_out(d, "user_id", ["item_id"], 1),
        lambda d: sampling.group_sample_k(d, "user_id", ["item_id"], 1, 3, 1),
        lambda d: sampling.shuffle_rows(d, ["user_id", "item_id"], 1),
    ):
        assert rows(make(interactions.repartition(1))) == rows(make(interactions.repartition(9)))


def test_group_sample_sizes(interactions):
    got = Counter(r["user_id"] for r in sampling.group_sample_k(interactions, "user_id", ["item_id"], 2, 4, 3).collect())
    assert got[1] == 1 and got[2] == 2 and 2 <= got[3] <= 3 and 2 <= got[4] <= 4


def test_bernoulli_edges(spark):
    df = spark.range(300).withColumn("p", F.when(F.col("id") < 100, 0.0).when(F.col("id") < 200, 1.0).otherwise(0.5))
    got = sampling.bernoulli_sample(df, "p", ["id"], 1)
    sums = {r[0]: r[1] for r in got.groupBy("p").agg(F.sum("bought")).collect()}
    assert sums[0.0] == 0 and sums[1.0] == 100 and 30 < sums[0.5] < 70


def test_negatives_are_unbought_and_whole(spark):
    items = spark.createDataFrame([(i,) for i in range(6)], "item_id int")
    data = [(1, i, "c") for i in range(6)] + [(2, 0, "d")] + [(3, i, "e") for i in (1, 2, 4, 5)] * 3
    positives = spark.createDataFrame([(u, i, c, n) for n, (u, i, c) in enumerate(data)], "user_id int, item_id int, ctx string, n int")
    got = sampling.negative_sample(positives, items, "user_id", "item_id", ["n"], 4).collect()
    assert sorted(r["n"] for r in got) == [n for n, row in enumerate(data) if row[0] != 1]
    for r in got:
        assert r["item_id"] in ({1, 2, 3, 4, 5} if r["user_id"] == 2 else {0, 3})
        assert r["ctx"] == data[r["n"]][2]


def test_negatives_are_near_uniform(spark):
    items = spark.createDataFrame([(i,) for i in range(5)], "item_id int")
    positives = spark.range(4000).select(F.lit(1).alias("user_id"), F.lit(2).alias("item_id"), F.col("id").alias("n"))
    got = Counter(r["item_id"] for r in sampling.negative_sample(positives, items, "user_id", "item_id", ["n"], 8).collect())
    assert set(got) == {0, 1, 3, 4} and all(850 < c < 1150 for c in got.values())


def test_training_examples_balance_and_ids(spark):
    items = spark.createDataFrame([(i,) for i in range(10)], "item_id int")
    positives = spark.createDataFrame([(u, i, "x") for u in range(5) for i in range(u + 1)], "user_id int, item_id int, ctx string")
    got = sampling.training_examples(positives, items, "user_id", "item_id", ["ctx"], ["user_id", "item_id"], 2).collect()
    assert sorted(r["example_id"] for r in got) == list(range(30))
    assert sum(r["bought"] for r in got) == 15


def test_random_rows(spark):
    df = spark.range(50)
    got = [r[0] for r in sampling.random_rows(df, ["id"], 5, 1).collect()]
    assert len(got) == 5 and got == [r[0] for r in sampling.random_rows(df.repartition(7), ["id"], 5, 1).collect()]
