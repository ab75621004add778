import math
import random

import numpy as np
from pyspark.sql import functions as F

from tastegraph.llm import quality
from tests.llm.frames import awkward, frame

LABELS = "doc_id long, quality int, toxic int, id long, label int"


def corpus(spark, n=240):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = ["".join(rng.choice("etaoinsrhl") for _ in range(rng.randint(2, 8))) for _ in range(60)]
        text = " ".join(words) + "." if good else " ".join(w.upper() + "###" for w in words[:9] * 6)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["big", "big", "big", "small", None])))
        if i % 3:
            labels.append((i, int(good), 0, 0, 0))
    return frame(spark, rows), spark.createDataFrame(labels, LABELS)


def test_keeps_the_good(spark):
    docs, labels = corpus(spark)
    got = quality.score(docs, labels).collect()
    assert len(got) == 240 and all(r.kept == (r.id % 4 != 0) for r in got)
    rows = quality.filter_quality(docs, labels)
    assert rows.columns == docs.columns and sorted(r.doc_id for r in rows.collect()) == [i for i in range(240) if i % 4]


def test_posteriors_by_hand(spark, monkeypatch):
    """Rates and posteriors recomputed in plain Python from the evidence."""
    docs, labels = corpus(spark)
    monkeypatch.setattr(quality, "_strength", lambda groups, key, mean: {"host": 7.0, "path": 3.0}[key])
    got = {r.id: r for r in quality.score(docs, labels).collect()}
    known = [r.quality for r in labels.collect()]
    start = math.log(np.mean(known) / (1 - np.mean(known)))
    p = {i: 1 / (1 + math.exp(-(r.evidence + start))) for i, r in got.items()}
    site = {r.doc_id: (r.source, (r.source, r.lang)) for r in docs.collect()}
    mean = np.mean(list(p.values()))
    for i, r in got.items():
        rates = []
        for level, strength in ((0, 7.0), (1, 3.0)):
            same = [p[j] for j in p if site[j][level] == site[i][level] and j != i]
            parent = mean if level == 0 else rates[0]
            rates.append((sum(same) + strength * parent) / (len(same) + strength))
        assert math.isclose(r.host_rate, rates[0], rel_tol=1e-9) and math.isclose(r.path_rate, rates[1], rel_tol=1e-9)
        rate = min(max(rates[1], 1e-4), 1 - 1e-4)
        assert math.isclose(r.posterior, 1 / (1 + math.exp(-(r.evidence + math.log(rate / (1 - rate))))), rel_tol=1e-6)


def test_shrinking(spark):
    """Groups that differ by chance only get a strong prior; groups that do differ a weak one."""
    alike = spark.createDataFrame([(str(i), 50, 25.0) for i in range(20)], "host string, host_n long, host_sum double")
    apart = spark.createDataFrame([(str(i), 50, 2.0 if i % 2 else 48.0) for i in range(20)], "host string, host_n long, host_sum double")
    assert quality._strength(alike, "host", 0.5) == quality.MOST_STRENGTH
    assert quality._strength(apart, "host", 0.5) == quality.LEAST_STRENGTH


def test_awkward_rows(spark):
    docs, labels = corpus(spark)
    both = docs.unionByName(awkward(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    got = quality.score(both, labels.unionByName(spark.createDataFrame([(None, 1, 0, 0, 0), (1001, None, 0, 0, 0)], LABELS)))
    assert got.count() == 250 and got.filter("posterior IS NULL OR isnan(posterior)").count() == 0
    assert quality.filter_quality(both, labels).columns == both.columns


def test_without_labels_or_rows(spark):
    docs, labels = corpus(spark, 20)
    assert quality.score(docs, labels.limit(0)).filter("kept").count() == 20
    assert quality.score(docs, labels.filter("quality = 1")).filter("kept").count() == 20
    assert quality.score(docs.limit(0), labels).count() == 0
    assert quality.filter_quality(docs.limit(0), labels).count() == 0
