import random

from pyspark.sql import functions as F

from tastegraph.llm import mixing
from tests.llm.frames import awkward, frame

POWERS = {"source": 0.5, "lang": 0.0}


def margins():
    return {"source": F.col("source"), "lang": F.col("lang")}


def corpus(spark, n=400):
    rng = random.Random(1)
    return frame(spark, [(i, "w " * rng.randint(1, 40), rng.choice(["en"] * 5 + ["de", None]), rng.choice(["a"] * 6 + ["b", "c", None])) for i in range(n)])


def test_margins_reach_their_targets(spark):
    docs = corpus(spark)
    cells = mixing.probabilities(docs, margins(), POWERS, rounds=25)
    rows = [(r.source, r.lang, len(r.text.split())) for r in docs.collect()]
    weight = {r._cell: r.probability for r in cells.collect()}
    key = lambda s, l: "\x01".join("" if v is None else f"={v}" for v in (s, l))
    for level, power in ((0, 0.5), (1, 0.0)):
        have, want = {}, {}
        for row in rows:
            have[row[level]] = have.get(row[level], 0) + row[2] * weight[key(row[0], row[1])]
            want[row[level]] = want.get(row[level], 0) + row[2]
        want = {k: v**power for k, v in want.items()}
        for k in have:
            assert abs(have[k] / sum(have.values()) - want[k] / sum(want.values())) < 1e-3
    assert max(weight.values()) == 1.0


def test_given_targets(spark):
    docs = corpus(spark)
    goal = spark.createDataFrame([("=a", 1.0), ("=b", 3.0)], "value string, target double")
    cells = {r._cell: r.probability for r in mixing.probabilities(docs, {"source": F.col("source")}, {}, {"source": goal}).collect()}
    tokens = {}
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len(r.text.split())
    assert cells["=c"] == cells[""] == 0 and cells["=b"] == 1.0
    assert abs(cells["=a"] * tokens["a"] * 3 - tokens["b"]) < 1e-6


def test_sample_is_the_report(spark):
    docs = corpus(spark)
    report = mixing.mix_report(docs, margins(), POWERS)
    rows = mixing.mix(docs, margins(), POWERS)
    assert rows.columns == docs.columns
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in report.filter("kept").collect())
    expected = report.agg(F.sum("probability")).head()[0]
    assert abs(rows.count() - expected) < 4 * expected**0.5


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = mixing.mix_report(docs, margins(), POWERS).collect()
    assert len(got) == 10 and all(0 <= r.probability <= 1 for r in got)
    assert {r.kept for r in got if r.tokens == 0 and r.probability == 1.0} <= {True}
    assert mixing.mix_report(frame(spark, []), margins(), POWERS).count() == 0
    assert mixing.mix(frame(spark, []), margins(), POWERS).count() == 0


def test_one_rare_row_leaves_the_other_rates(spark):
    """With a budget a single document of a new source and no language takes little from the rest."""
    docs = corpus(spark)
    more = docs.unionByName(frame(spark, [(1000, "w " * 10, None, "rare")]))
    before, after = ({r._cell: r for r in mixing.probabilities(d, margins(), POWERS, budget=0.5).collect()} for d in (docs, more))
    assert len(after) == len(before) + 1
    for found in (before, after):
        total = sum(r.tokens for r in found.values())
        assert abs(sum(r.tokens * r.probability for r in found.values()) - total / 2) < 1e-6 * total
        assert max(r.probability for r in found.values()) == 1.0
    old = {r._cell: r.probability for r in mixing.probabilities(more, margins(), POWERS).collect()}
    common = max(before, key=lambda c: before[c].tokens)
    assert old[common] < 0.5 * after[common].probability
    moved = sum(r.tokens * abs(after[c].probability - r.probability) for c, r in before.items())
    assert moved < 0.1 * sum(r.tokens for r in before.values())


def test_shortfall_names_the_saturated_cells(spark):
    docs = corpus(spark)
    cells = mixing.written(mixing.probabilities(docs, margins(), POWERS, budget=0.9))
    short = {r.cell: r for r in mixing.shortfall(cells).collect()}
    held = {r._cell: r for r in cells.collect()}
    assert short and set(short) == {c for c, r in held.items() if r.wanted > 1}
    assert all(r.short > 0 and held[c].probability == 1.0 and abs(r.wanted - r.short - r.tokens) < 1e-6 for c, r in short.items())
    assert {r.probability for r in mixing.probabilities(docs, margins(), POWERS, budget=1.0).collect()} == {1.0}
    assert mixing.mix(frame(spark, []), margins(), POWERS, budget=0.5).count() == 0
    assert mixing.mix(docs, margins(), POWERS, budget=1.0).count() == docs.count()


def test_columns_with_dots_in_their_names(spark):
    docs = frame(spark, [(i, "a b c") for i in range(20)]).withColumn("a.b", F.lit(1)).withColumn("_row", F.lit(2))
    kept = mixing.mix(docs, {"source": F.col("source")}, {"source": 0.5}, budget=0.5)
    assert kept.columns == docs.columns and kept.count() <= 20
