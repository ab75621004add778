import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tastegraph.functions import columns, ordering, skew, unseen


def test_uniform_is_portable_and_in_range(spark):
    df = spark.range(200).withColumn("u", columns.seeded_uniform(7, "id"))
    for r in df.collect():
        digits = hashlib.md5(f"7|{r['id']}".encode()).hexdigest()[:13]
        assert r["u"] == int(digits, 16) / 16**13
        assert 0 <= r["u"] < 1


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = df.select(columns.dot("a", "b"), columns.cosine("a", "b"), columns.sigmoid(F.lit(0.0))).collect()
    assert got[0][0] == 11.0 and got[0][1] == pytest.approx(11 / (5**0.5 * 5)) and got[0][2] == 0.5
    assert got[1][1] is None


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_totals_cross_blocks(spark, partitions):
    random.seed(1)
    data = [(g, x, random.randint(0, 5)) for g in ("a", "b") for x in random.sample(range(1000), 60)]
    df = spark.createDataFrame(data, "g string, x int, m int").repartition(partitions)
    got = ordering.running_totals(df, ["g"], F.floor(F.col("x") / 50), [F.col("x")], {"before": F.col("m")})
    for r in got.collect():
        assert r["before"] == sum(m for g, x, m in data if g == r["g"] and x < r["x"])


def test_dense_position_numbers_all_rows(spark):
    df = ordering.dense_position(spark.range(5000).withColumnRenamed("id", "k"), ["k"], "n")
    got = sorted((r["n"], r["k"]) for r in df.collect())
    assert [n for n, _ in got] == list(range(5000))
    assert [k for _, k in got] == sorted(range(5000), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())


def test_carry_forward_is_an_as_of_lookup(spark):
    random.seed(2)
    marks = [(g, at, at * 10 + g) for g in (1, 2) for at in random.sample(range(100), 12)]
    points = [(g, at) for g in (1, 2, 3) for at in range(0, 100, 3)]
    got = ordering.carry_forward(
        spark.createDataFrame(points, "g int, at int"), spark.createDataFrame(marks, "g int, m int, v int"),
        ["g"], "at", "m", ["v"], block_size=8,
    )
    found = {(r["g"], r["at"]): r["v"] for r in got.collect()}
    for g, at in points:
        before = [(m, v) for mg, m, v in marks if mg == g and m <= at]
        assert found[(g, at)] == (max(before)[1] if before else None)


def _seen(spark, history):
    return spark.createDataFrame([(u, i) for u, items in history.items() for i in items], "u int, i bigint")


@pytest.mark.parametrize("block", [3, 4096])
def test_unseen_items_match_set_difference(spark, monkeypatch, block):
    monkeypatch.setattr(unseen, "BLOCK", block)
    random.seed(3)
    n = 23
    history = {u: random.sample(range(n), k) for u, k in enumerate([0, 1, 5, 22, 23, 12])}
    users = spark.createDataFrame([(u,) for u in history], "u int")
    ranges = unseen.unseen_ranges(users, _seen(spark, history), "u", "i", F.lit(n))
    expanded = unseen.expand_ranges(ranges, "i")
    got = {}
    for r in expanded.collect():
        got.setdefault(r["u"], set()).add(r["i"])
    expected = {u: set(range(n)) - set(items) for u, items in history.items()}
    assert got == {u: s for u, s in expected.items() if s}
    draws = spark.createDataFrame([(u, k) for u, s in expected.items() for k in range(len(s))], "u int, k bigint")
    for r in unseen.pick_unseen(draws, ranges, "u", "k", "i").collect():
        assert r["i"] == sorted(expected[r["u"]])[r["k"]]


def test_first_k_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    best = ordering.first_k(df, ["g"], [F.col("id").desc()], 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r["g"], r["id"], r["rank"]) for r in best.collect()) == [
        (0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1)]


def test_attach_stats_keeps_every_row_of_hot_and_cold_keys(spark):
    data = [(0, i) for i in range(3000)] + [(k, k) for k in range(1, 3001)]
    df = spark.createDataFrame(data, "k int, v int")
    stats = df.groupBy("k").agg(F.count("*").alias("n"))
    got = skew.attach_stats(df, stats, "k", "n")
    assert got.count() == 6000
    assert got.filter("k = 0 AND n = 3000").count() == 3000 and got.filter("k > 0 AND n = 1").count() == 3000
