import random
from types import SimpleNamespace

import pytest

from tastegraph.operators import affinity
from tastegraph.plans import affinity_queries

PREFS = "user_id int, attr string, val string, score int"
MODS = "user_id int, ctx_cat string, ctx_val string, mod_seq int, attr string, val string, delta int"
CONTEXT = "user_id int, ctx_seq int, ctx_cat string, ctx_val string"


def fold(score, deltas, lo, hi):
    for d in deltas:
        if lo <= score + d <= hi:
            score += d
    return score


def test_modifiers_apply_in_order_and_are_skipped_not_clamped(spark):
    prefs = spark.createDataFrame([(1, "colour", "red", 8), (1, "colour", "blue", 3), (1, "size", "s", 5)], PREFS)
    mods = spark.createDataFrame(
        [(1, "time", "am", 1, "colour", "red", 5), (1, "time", "am", 2, "colour", "red", -3),
         (1, "day", "mon", 1, "colour", "red", 5), (1, "time", "pm", 1, "colour", "blue", 5),
         (1, "time", "am", 3, "size", "none", 1)], MODS)
    context = spark.createDataFrame([(1, 1, "time", "am"), (1, 2, "day", "mon")], CONTEXT)
    got = {r["val"]: r["adj_score"] for r in affinity.apply_context_mods(prefs, mods, context, 1, 10).collect()}
    assert got == {"red": 10, "blue": 3, "s": 5}


def test_a_narrow_rating_range_lets_only_zero_through(spark):
    prefs = spark.createDataFrame([(1, "a", "x", 5), (1, "a", "y", 4)], PREFS)
    mods = spark.createDataFrame([(1, "c", "v", 1, "a", "x", -5), (1, "c", "v", 2, "a", "y", -5)], MODS)
    context = spark.createDataFrame([(1, 1, "c", "v")], CONTEXT)
    got = {r["val"]: r["adj_score"] for r in affinity.apply_context_mods(prefs, mods, context, 0, 0.25).collect()}
    assert got == {"x": 0, "y": 4}


@pytest.mark.parametrize("chunk", [2, 256])
def test_chunked_fold_equals_the_plain_one(spark, monkeypatch, chunk):
    monkeypatch.setattr(affinity, "FOLD_CHUNK", chunk)
    random.seed(chunk)
    deltas = {(u, v): [random.randint(-6, 6) for _ in range(random.randint(0, 20))] for u in (1, 2) for v in "xyz"}
    scores = {k: random.randint(0, 9) for k in deltas}
    prefs = spark.createDataFrame([(u, "a", v, s) for (u, v), s in scores.items()], PREFS)
    mods = spark.createDataFrame([(u, "c", "v", n, "a", v, d) for (u, v), ds in deltas.items() for n, d in enumerate(ds)], MODS)
    context = spark.createDataFrame([(u, 1, "c", "v") for u in (1, 2)], CONTEXT)
    for r in affinity.apply_context_mods(prefs, mods, context, 1, 10).collect():
        key = (r["user_id"], r["val"])
        assert r["adj_score"] == fold(scores[key], deltas[key], 1, 10)


def test_scaled_affinity_and_breakdown(spark):
    prefs = spark.createDataFrame([(1, "colour", "red", 9), (1, "size", "s", 4)], PREFS)
    attrs = spark.createDataFrame([(7, "colour", "red"), (7, "size", "s"), (8, "colour", "blue"), (8, "size", "s")],
                                  "item_id int, attr string, val string")
    pairs = spark.createDataFrame([(1, 7), (1, 8)], "user_id int, item_id int")
    got = {r["item_id"]: (r["raw"], r["affinity"]) for r in affinity.affinity_score(pairs, prefs, attrs, 1, 10).collect()}
    assert got == {7: (13, 1 + 13 * 9 / 20), 8: (4, 1 + 4 * 9 / 20)}
    mods = spark.createDataFrame([(1, "t", "am", 1, "colour", "red", -2)], MODS)
    context = spark.createDataFrame([(1, 1, "t", "am")], CONTEXT)
    both = affinity.context_affinity(pairs, prefs, mods, context, attrs, 1, 10)
    rated = {r["item_id"]: (r["rating_ignore_context"], r["rating_in_this_context"]) for r in both.collect()}
    assert rated[7] == pytest.approx((6.85, 5.95)) and rated[8] == pytest.approx((2.8, 2.8))
    parts = affinity.affinity_breakdown(pairs, prefs, mods, context, attrs, 1, 10).filter("item_id = 7").collect()
    assert {r["attr"]: (r["score"], r["adj_score"]) for r in parts} == {"colour": (9, 7), "size": (4, 4)}
    assert 1 + sum(r["adj_share"] for r in parts) == pytest.approx(5.95)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (5.5,), (3.49,)], "a double")
    got = [r["rounded_observed_rating"] for r in affinity.observed_rating(df, "a").collect()]
    assert got == [round(x) for x in (0.5, 1.5, 2.5, 5.5, 3.49)]


def test_a_modifier_run_longer_than_a_block_is_chained_in_order(spark):
    deltas = [random.Random(5).randint(-6, 6) for _ in range(40)]
    seqs = [1 + 700 * n for n in range(len(deltas))]
    prefs = spark.createDataFrame([(1, "a", "x", 4)], PREFS)
    mods = spark.createDataFrame([(1, c, "v", s, "a", "x", d) for c in "de" for s, d in zip(seqs, deltas)], MODS)
    context = spark.createDataFrame([(1, 1, "e", "v"), (1, 2, "d", "v")], CONTEXT)
    got = affinity.apply_context_mods(prefs, mods, context, 1, 10).collect()
    assert [r["adj_score"] for r in got] == [fold(4, deltas * 2, 1, 10)]


@pytest.mark.parametrize("run", ["affinity_score", "context_affinity", "affinity_breakdown", "apply_context_mods"])
def test_no_table_that_grows_is_broadcast(spark, run):
    prefs = spark.createDataFrame([(1, "colour", "red", 9)], PREFS)
    attrs = spark.createDataFrame([(7, "colour", "red")], "item_id int, attr string, val string")
    pairs = spark.createDataFrame([(1, 7)], "user_id int, item_id int")
    mods = spark.createDataFrame([(1, "t", "am", 1, "colour", "red", -2)], MODS)
    context = spark.createDataFrame([(1, 1, "t", "am")], CONTEXT)
    frames = {"affinity_score": (pairs, prefs, attrs), "apply_context_mods": (prefs, mods, context)}
    got = getattr(affinity, run)(*frames.get(run, (pairs, prefs, mods, context, attrs)), 1, 10)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_rounds_of_users_give_the_same_rows(spark, rows, monkeypatch):
    draw = random.Random(7)
    lines = [(o, draw.randrange(12), float(draw.randint(1, 50)), draw.choice("NAR")) for o in range(60) for _ in range(3)]
    orders = [(o, draw.choice([None, *range(9)]), draw.choice(["1-URGENT", "5-LOW"])) for o in range(60)]
    parts = [(i, f"{draw.choice(['red', 'blue'])} {draw.choice(['bolt', 'nut'])}", f"B{i % 3}", f"T{i % 2}") for i in range(12)]
    tables = SimpleNamespace(
        lineitem=spark.createDataFrame(lines, "l_orderkey int, l_partkey int, l_quantity double, l_returnflag string"),
        orders=spark.createDataFrame(orders, "o_orderkey int, o_custkey int, o_orderpriority string"),
        part=spark.createDataFrame(parts, "p_partkey int, p_name string, p_brand string, p_type string"),
    )
    scored = lambda *frames: affinity.affinity_breakdown(*frames, 1, 10)
    whole = rows(affinity_queries.in_rounds(tables, scored))
    monkeypatch.setattr(affinity_queries, "ROUND_ROWS", 30)
    assert rows(affinity_queries.in_rounds(tables, scored)) == whole and len(whole) > 4 * 30
