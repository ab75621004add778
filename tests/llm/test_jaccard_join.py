import random

import pytest

from tastegraph.llm import jaccard_join
from tests.llm.frames import awkward, frame


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    found = [(d, sets(t)) for d, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(found):
        for b, t in found[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted([(d, len(s), None if d is None else find(d)) for d, s in found], key=str)


def check(spark, rows, **options):
    got = jaccard_join.similar_documents(frame(spark, rows), owners=3, **options)
    assert sorted([(r.id, r.n_shingles, r.component_id) for r in got.collect()], key=str) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    """Near copies of several lengths and edit rates, a passage that many share, short texts."""
    rng = random.Random(seed)
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([4, 5, 7, 12, 30, 120]))]
        for _ in range(rng.choice([1, 3, 9])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
            text = " ".join(words)
            if rng.random() < 0.3:
                text += " " + passage
            rows.append((len(rows) * 7 % 211, text))
    for i in range(30):
        rows.append((300 + i, f"{passage} end{i}"))
    check(spark, rows)


def test_large_near_copy_group(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(150)] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_large_group_below_the_threshold_forms_few_pairs(spark, monkeypatch):
    """Twins share the edits of an original; apart from them nearly all pairs are at 0.5 to 0.8."""
    rng = random.Random(8)
    rows = []
    for i in range(0, 160, 2):
        words = [f"w{k}" for k in range(200)]
        for k in rng.sample(range(200), 6):
            words[k] = f"y{rng.randrange(10**6)}"
        rows += [(i, " ".join(words)), (i + 1, " ".join([*words, f"z{i}"]))]
    formed, links = [], jaccard_join._links

    def counted(pairs, *rest):
        formed.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "_links", counted)
    check(spark, rows)
    assert sum(formed) < 5 * len(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]


def test_empty(spark):
    assert jaccard_join.similar_documents(frame(spark, [])).count() == 0
    assert jaccard_join.one_of_each(frame(spark, [])).count() == 0


def test_different_texts_under_one_id_are_judged_each(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(2, "x y z"), (2, "entirely other words here now then"), (1, base), (2, base + " end"), (5, base), (2, "x y z"), (7, "x y z")]
    docs = frame(spark, rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(2, "x y z"), (2, "entirely other words here now then"), (1, base)])


def test_distinct_ids_are_not_told_apart(spark, monkeypatch):
    """Without an ID on several rows no row is numbered, and no plan reads the documents twice for it."""
    monkeypatch.setattr(jaccard_join, "_nodes", None)
    base = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [(2, base + " end"), (1, base), (5, "x y z"), (None, base), (None, base), (7, "X y  z"), (8, None)])
    assert sorted(r.doc_id or 0 for r in jaccard_join.one_of_each(docs, owners=3).collect()) == [0, 0, 1, 5, 8]
