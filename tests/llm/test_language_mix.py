import random

import numpy as np

from tastegraph.llm import language_mix
from tests.llm.frames import awkward, frame

SYLLABLES = {"aa": ["ka", "lo", "mi", "ran"], "bb": ["sch", "ung", "eit", "der"], "cc": ["ción", "que", "osa", "ñe"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(spark, n=60):
    rng = random.Random(1)
    return frame(spark, [(i, text(rng, lang, 80), lang) for i in range(n) for lang in [list(SYLLABLES)[i % 3]]])


def test_predicts_and_mixes(spark):
    model = language_mix.learn(corpus(spark))
    assert model[0] == ["aa", "bb", "cc"] and np.allclose(model[1].sum(axis=0), 1)
    rng = random.Random(9)
    rows = [(i, text(rng, lang, 40), lang) for i in range(30) for lang in [list(SYLLABLES)[i % 3]]]
    rows.append((100, text(rng, "aa", 300) + " " + text(rng, "cc", 100)))
    got = {r.doc_id: r for r in language_mix.predict(frame(spark, rows), model).collect()}
    assert all(got[r[0]].lang_pred == r[2] and len(got[r[0]].langs) == 1 for r in rows[:30])
    assert got[100].lang_pred == "aa" and got[100].langs == ["aa", "cc"] and 0.5 < got[100].score < 0.9
    assert abs(sum(got[100].shares) - 1) < 1e-9


def test_awkward_rows(spark):
    model = language_mix.learn(corpus(spark))
    docs = awkward(spark)
    got = language_mix.predict(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[1] == by[2] == by[3] == by[7] == "und" and by[4] != "und"


def test_empty_and_untrained(spark):
    model = language_mix.learn(frame(spark, []))
    assert {r.lang_pred for r in language_mix.predict(awkward(spark), model).collect()} == {"und"}
    assert language_mix.predict(frame(spark, []), model).count() == 0


def test_em_finds_the_proportions():
    rng = np.random.default_rng(3)
    likelihood = rng.dirichlet(np.ones(50), size=2).T
    counts = rng.multinomial(20_000, likelihood @ [0.3, 0.7]).astype(float)
    share, _ = language_mix.em(likelihood, counts)
    for _ in range(5):
        share, _ = language_mix.em(likelihood, counts)
    assert abs(share[0] - 0.3) < 0.05


def test_word_characters_that_are_no_letters(spark):
    docs = frame(spark, [(1, "the house is old", "en"), (2, "das haus ist alt", "de"), (3, "\u00bd \u00b2 \u2460", None), (4, "\u2167", None), (5, "12 \U0001f600", None), (6, "\u4e2d", None)])
    found = {r.doc_id: r for r in language_mix.predict(docs, language_mix.learn(docs)).collect()}
    assert [found[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and [found[i].score for i in (3, 4, 5)] == [0.0] * 3
    assert found[6].lang_pred in ("en", "de") and 0 < found[6].score <= 1


def test_selection_equals_all_subsets():
    """The chosen set has the best penalised likelihood of those that grow by proportion, and no single one beats it."""
    rng = np.random.default_rng(4)
    for weights in ([1, 0, 0], [0.6, 0.4, 0], [0.4, 0.3, 0.3], [0.97, 0.03, 0]):
        model = rng.dirichlet(np.ones(40) * 0.2, size=3).T + 1e-6
        model /= model.sum(axis=0)
        counts = rng.multinomial(600, model @ np.array(weights) / (model @ np.array(weights)).sum()).astype(float)
        held = counts > 0
        price = 0.5 * np.log(600) + language_mix.GAIN * 600
        best = {}
        for some in ([0], [1], [2], [0, 1], [0, 2], [1, 2], [0, 1, 2]):
            own, reached = language_mix.em(model[held][:, some], counts[held])
            best[tuple(some)] = reached - (len(some) - 1) * price
        chosen, share = language_mix.select(model[held], counts[held])
        assert abs(share.sum() - 1) < 1e-9
        assert best[tuple(sorted(chosen))] >= max(best.values()) - 0.02 * 600
