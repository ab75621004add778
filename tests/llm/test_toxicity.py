import random

import numpy as np
from pyspark.sql import functions as F

from tastegraph.llm import toxicity
from tastegraph.llm.common import crc32_mod
from tests.llm.frames import awkward, frame

LABELS = "doc_id long, toxic int, quality int, key long, label int"


def corpus(spark, n=400):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(30)]
        toxic = i % 8 == 0
        if toxic:
            words[3:3] = ["foulword", "nastybit" + rng.choice("xyz"), "nastybite"]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic), 1, 0, 0))
    return frame(spark, rows), spark.createDataFrame(labels, LABELS)


def test_separates_held_out_rows(spark):
    docs, labels = corpus(spark)
    held_out = crc32_mod("doc_id", 5) == 0
    model = toxicity.train(docs, labels, ~held_out)
    got = toxicity.score(docs, model).filter(held_out).collect()
    assert len(got) > 40 and all((r.score >= 0.5) == (r.doc_id % 8 == 0) for r in got)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = corpus(spark)
    held_out = crc32_mod("doc_id", 5) == 0
    turned = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels, ~held_out) == toxicity.train(docs, turned, ~held_out)


def test_awkward_rows(spark):
    docs, labels = corpus(spark)
    more = labels.unionByName(spark.createDataFrame([(None, 1, 1, 0, 0), (3, None, 1, 0, 0), (0, 0, 1, 0, 0)], LABELS))
    model = toxicity.train(docs.unionByName(awkward(spark)), more, F.lit(True))
    got = toxicity.score(awkward(spark), model).collect()
    assert len(got) == 10 and all(0 <= r.score < 0.5 for r in got)
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_without_positives(spark):
    docs, labels = corpus(spark, 40)
    none = toxicity.train(docs, labels.filter("toxic = 0"), F.lit(True))
    assert none.weights == {} and toxicity.score(docs, none).filter("score >= 0.5").count() == 0
    assert toxicity.train(frame(spark, []), labels.limit(0), F.lit(True)).weights == {}


def test_risk_does_not_go_below_zero():
    """With the corrected risk a positive that is also unlabelled does not drag its feature down."""
    positive = [np.array([0])] * 20
    unlabelled = [np.array([0])] * 20 + [np.array([1])] * 180
    weights, intercept = toxicity.nnpu_fit(positive, unlabelled, 2, 0.1)
    assert weights[0] + intercept > 0 > weights[1] + intercept


def test_rare_toxic_words_are_not_pushed_out(spark):
    """Over 20,000 neutral features that every text holds, and a toxic word that 4 of 10 positives hold."""
    rng = random.Random(4)
    neutral = " ".join({"".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(6000)})
    rows = [(i, neutral + (" zzfoul" if i < 4 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 10), 1, 0, 0) for i in range(60)], LABELS)
    model = toxicity.train(frame(spark, rows), labels, F.lit(True))
    assert model.weights["=zzfoul"] > 0 and {"zzfo#1", "zzfou#1", "zzfoul#1"} <= set(model.weights)
    assert max(len(w) for w in model.weights) <= len("=zzfoul") + 1


def test_counts_cover_every_text(spark):
    texts = [None, "", "Abcdefgh abcdefgh abcdxyz", "abcdq", "abcdefgh"]
    got = {r.feature: r.n for r in toxicity._feature_counts(frame(spark, list(enumerate(texts))).select("text")).collect()}
    want = {}
    for text in texts:
        for f in toxicity.Finder()(text):
            want[f] = want.get(f, 0) + 1
    assert got == want and got["abcd#1"] == 3 and got["abcd#2"] == 1
    held = toxicity._feature_counts(frame(spark, [(0, "Abcdefgh zz \u00fcml\u00e4ut")]).select("text"))
    some = {r.feature: r.n for r in toxicity._feature_counts(frame(spark, list(enumerate(texts))).select("text"), toxicity.stem_bits(held)).collect()}
    assert {"=abcdefgh": 2, "abcd#1": 3, "abcd#2": 1, "abcdefgh#1": 2}.items() <= some.items() and all(want[f] == n for f, n in some.items())
    finder = toxicity.Finder(among=toxicity.stem_bits(held))
    assert all(finder._may_be(s) for s in ("=abcdefgh", "abcd", "abcdefgh", "=zz", "=\u00fcml\u00e4ut", "\u00fcml\u00e4u")) and not finder._may_be("=other")


def test_slices_and_forgetting_change_nothing(monkeypatch):
    rng = random.Random(5)
    texts = [None, ""] + [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(rng.randrange(60))) for _ in range(50)]
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 30)
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 40)
    finder, places = toxicity.Finder(), {}
    counter = toxicity.StemCounts(lambda stem: places.setdefault(stem, len(places)), lambda: len(places))
    got, at = {}, 0
    for n, rows, stems, counts in counter(texts):
        names = list(places)
        got |= {(at + r, names[s]): c for r, s, c in zip(rows.tolist(), stems.tolist(), counts.tolist())}
        at += n
    assert at == len(texts) and got == {(i, s): c for i, text in enumerate(texts) for s, c in finder.stems_of(text).items()}


def test_scores_add_the_weights_of_a_text():
    weights = {"=foul": 1.5, "foul#1": 0.25, "foul#2": 0.5, "foul#3": -2.0, "fouls#1": 3.0}
    texts = [None, "", "foul", "Foul fouls", "foul fouls foulest", "fine words", "foul foul"]
    finder, got = toxicity.Finder(weights), toxicity.Model(0.1, weights, -1.0).scorer()(texts)
    want = [1 / (1 + np.exp(1.0 - sum(weights[f] for f in finder(text)))) for text in texts]
    assert np.allclose(got, want) and len(got) == len(texts)
    assert len(toxicity.Model(0.1, {}, 0.0).scorer()([])) == 0 and toxicity.Model(0.1, {}, 0.0).scorer()(["a"]) == [0.5]


def test_gradient_is_that_of_the_corrected_risk(monkeypatch):
    """The first step of the fit goes against the finite differences of the risk (where its negative part is positive)."""
    monkeypatch.setattr(toxicity, "STEPS", 1)
    rng = np.random.default_rng(3)
    for prior, hits in ((0.1, 0.3), (0.45, 0.95)):
        rows = [np.flatnonzero(rng.random(6) < hits) for _ in range(40)]
        positive, unlabelled = rows[:10], rows[10:]
        base = np.log(prior / (1 - prior))

        def risk(theta):
            z = np.array([theta[6] + theta[r].sum() for r in rows])
            soft = np.logaddexp(0, z)
            negative = soft[10:].mean() - prior * soft[:10].mean()
            assert negative > 0
            return prior * np.logaddexp(0, -z[:10]).mean() + negative

        start = np.append(np.zeros(6), base)
        slopes = [(risk(start + h) - risk(start - h)) / 2e-5 for h in np.eye(7) * 1e-5]
        weights, intercept = toxicity.nnpu_fit(positive, unlabelled, 6, prior)
        moved = np.append(weights, intercept - base)
        assert all(np.sign(m) == -np.sign(s) for m, s in zip(moved, slopes) if abs(s) > 1e-6)
