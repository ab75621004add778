import itertools
import math
import random

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tastegraph.operators import rules


def brute_itemsets(baskets, min_support):
    counts = {}
    for b in baskets:
        for n in range(1, len(b) + 1):
            for s in itertools.combinations(sorted(b), n):
                counts[s] = counts.get(s, 0) + 1
    return {s: c for s, c in counts.items() if c / len(baskets) >= min_support}


def brute_rules(sets, n):
    found = {}
    for s, both in sets.items():
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                c = tuple(sorted(set(s) - set(a)))
                lift = (both / n) / ((sets[a] / n) * (sets[c] / n))
                if lift >= 1.0:
                    found[(a, c)] = (both, both / sets[a], lift)
    return found


def brute_recommend(basket, found, k):
    fits = [(-lift, a, c) for (a, c), (_, _, lift) in found.items() if set(a) <= set(basket) and not set(c) <= set(basket)]
    return [(r, a, c, i) for r, (_, a, c) in enumerate(sorted(fits)[:k], 1) for i in c if i not in basket]


def make(seed, n=60, catalogue="abcdefg"):
    random.seed(seed)
    return [sorted(random.sample(catalogue, random.choice([0, 1, 2, 3, 3, 4, 5]))) for _ in range(n)]


@pytest.fixture(scope="module", params=[1, 2])
def mined(request, spark):
    baskets = make(request.param)
    frame = spark.createDataFrame(list(enumerate(baskets)), "basket_id int, items array<string>")
    itemsets = rules.frequent_itemsets(frame, 0.05).cache()
    return baskets, frame, itemsets, rules.association_rules(itemsets).cache()


def test_itemsets_count_empty_baskets(mined):
    baskets, _, itemsets, _ = mined
    got = {tuple(r["items"]): r["freq"] for r in itemsets.collect()}
    assert got == brute_itemsets(baskets, 0.05)
    assert all(r["support"] == r["freq"] / len(baskets) for r in itemsets.collect())


def test_rules_have_all_splits_and_measures(mined):
    baskets, _, itemsets, found = mined
    expected = brute_rules(brute_itemsets(baskets, 0.05), len(baskets))
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in found.collect()}
    assert got.keys() == expected.keys()
    assert any(len(c) > 1 for _, c in got)
    for key, (both, confidence, lift) in expected.items():
        r = got[key]
        assert r["both_count"] == both and r["confidence"] == confidence and r["lift"] == pytest.approx(lift)
        assert r["leverage"] == pytest.approx(r["support"] - r["antecedent_support"] * r["consequent_support"])


def test_one_item_consequents_agree_with_the_miner(mined):
    _, frame, itemsets, _ = mined
    theirs = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.0).fit(frame).associationRules.collect()
    ours = {(tuple(r["antecedents"]), tuple(r["consequents"])): r
            for r in rules.association_rules(itemsets, "support", 0.0).collect() if len(r["consequents"]) == 1}
    assert len(ours) == len(theirs)
    for r in theirs:
        mine = ours[(tuple(sorted(r["antecedent"])), tuple(r["consequent"]))]
        assert mine["confidence"] == pytest.approx(r["confidence"]) and mine["lift"] == pytest.approx(r["lift"])


def test_applicable_rules_match_brute_force(mined):
    baskets, frame, _, found = mined
    got = {}
    for r in rules.applicable_rules(found, frame).collect():
        got.setdefault(tuple(r["items"]), set()).add((tuple(r["antecedents"]), tuple(r["consequents"]), tuple(r["new_items"])))
    expected_rules = brute_rules(brute_itemsets(baskets, 0.05), len(baskets))
    for b in {tuple(b) for b in baskets}:
        expected = {(a, c, tuple(i for i in c if i not in b)) for a, c in expected_rules if set(a) <= set(b) and not set(c) <= set(b)}
        assert got.get(b, set()) == expected


@pytest.mark.parametrize("k", [1, 3])
def test_recommendations_match_brute_force_despite_pruning(mined, k):
    baskets, frame, _, found = mined
    got = {}
    for r in rules.rule_recommend(found, frame, "basket_id", k).collect():
        got.setdefault(r["basket_id"], set()).add((r["rule_rank"], tuple(r["antecedents"]), tuple(r["consequents"]), r["new_item"]))
    measured = {(tuple(r["antecedents"]), tuple(r["consequents"])): (0, 0, r["lift"]) for r in found.collect()}
    for i, b in enumerate(baskets):
        assert got.get(i, set()) == set(brute_recommend(b, measured, k))


def test_certain_rules_have_infinite_conviction(spark):
    frame = spark.createDataFrame([(["a", "b"],), (["a", "b"],), (["b"],), ([],)], "items array<string>")
    found = rules.association_rules(rules.frequent_itemsets(frame, 0.25))
    sure = found.filter(F.col("confidence") == 1).collect()
    assert [tuple(r["antecedents"]) for r in sure] == [("a",)] and math.isinf(sure[0]["conviction"])
    ranked = rules.rank_rules(found, "confidence").collect()
    assert [r["confidence"] for r in ranked] == sorted((r["confidence"] for r in ranked), reverse=True)


def test_max_len_and_no_rules(spark):
    frame = spark.createDataFrame([(0, ["a"]), (1, ["b"]), (2, [])], "basket_id int, items array<string>")
    itemsets = rules.frequent_itemsets(frame, 0.1, max_len=1)
    assert sorted(tuple(r["items"]) for r in itemsets.collect()) == [("a",), ("b",)]
    none = rules.association_rules(itemsets)
    assert rules.rule_recommend(none, frame, "basket_id").count() == 0


def test_tree_finds_the_antecedents_without_broadcasts(mined, spark):
    baskets, frame, _, found = mined
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = rules.contained_antecedents(frame, found, "basket_id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sides = {a for a, _ in brute_rules(brute_itemsets(baskets, 0.05), len(baskets))}
    expected = sorted((i, a) for i, b in enumerate(baskets) for a in sides if set(a) <= set(b))
    assert sorted((r["basket_id"], tuple(r["antecedents"])) for r in rows) == expected


def test_tree_with_unsorted_repeated_empty_and_null_items(mined, spark):
    found = mined[3]
    odd = spark.createDataFrame([(1, ["c", "a", "a", "b"]), (2, ["a", "b", "c"]), (3, []), (4, None)], "k int, items array<string>")
    rows = rules.contained_antecedents(odd, found, "k").collect()
    of = lambda k: sorted(tuple(r["antecedents"]) for r in rows if r["k"] == k)
    assert of(1) == of(2) and of(1) and not of(3) and not of(4)
    assert rules.contained_antecedents(odd, found.filter("false"), "k").count() == 0


def test_rules_of_rows_by_counting(mined, spark):
    baskets, _, _, found = mined
    brute = brute_rules(brute_itemsets(baskets, 0.05), len(baskets))
    rows = [(i, x) for i, b in enumerate(baskets) for x in b] + [(None, x) for x in "abc"]
    rows = rows * 2 + [(0, None), (1, "never in a rule")]
    frame = spark.createDataFrame(rows, "basket int, thing string")
    got = rules.applicable_rules_of_rows(found, frame, "basket", "thing").collect()
    whole = list(enumerate(baskets)) + [(None, list("abc"))]
    expected = {(i, a, c): len(set(c) - set(b)) for i, b in whole for a, c in brute if set(a) <= set(b) and not set(c) <= set(b)}
    assert {(r["basket"], tuple(r["antecedents"]), tuple(r["consequents"])): r["n_new"] for r in got} == expected
    assert len(got) == len(expected)


@pytest.mark.parametrize("word", [2, 64])
def test_rules_of_rows_with_items_in_several_words(mined, spark, monkeypatch, word):
    monkeypatch.setattr(rules, "WORD", word)
    baskets, _, _, found = mined
    brute = brute_rules(brute_itemsets(baskets, 0.05), len(baskets))
    frame = spark.createDataFrame([(i, x) for i, b in enumerate(baskets) for x in b], "basket int, thing string")
    got = rules.applicable_rules_of_rows(found, frame, "basket", "thing").collect()
    expected = {(i, a, c): len(set(c) - set(b)) for i, b in enumerate(baskets) for a, c in brute if set(a) <= set(b) and not set(c) <= set(b)}
    assert {(r["basket"], tuple(r["antecedents"]), tuple(r["consequents"])): r["n_new"] for r in got} == expected


def test_rules_of_rows_are_not_shuffled(mined, spark):
    baskets, _, _, found = mined
    frame = spark.createDataFrame([(i, x) for i, b in enumerate(baskets) for x in b], "basket int, thing string")
    applied = rules.applicable_rules_of_rows(found, frame, "basket", "thing").groupBy("basket").count()
    plan = applied._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("NestedLoopJoin")]
