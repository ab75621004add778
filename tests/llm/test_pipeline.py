import os

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from check import compare, connect
from tastegraph.llm import queries
from tests.llm.test_exact_dedup import fold
from tests.llm.test_jaccard_join import brute

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER).toPandas(), connect(FOLDER).execute(queries.ORACLES[name]).fetchdf()) == "ok"


def test_registered():
    names = {n.split("_")[0] for n in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 11)} and driver.queries()["pipeline"] is corpus_pipeline.run


def test_stages(spark):
    """Each stage against plain Python on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.written(stage(spark, seen[-1], FOLDER)))
    assert all(s.columns == docs.columns for s in seen[:5])
    rows = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in seen[:5]]
    assert all(a.keys() >= b.keys() for a, b in zip(rows, rows[1:]))
    judged = [d for d in rows[0] if d in labels]
    right = sum((d in rows[1]) == (labels[d] == 1) for d in judged)
    assert right >= 0.9 * len(judged)
    last = {}
    for doc, text in rows[1].items():
        last[fold(text)] = max(doc, last.get(fold(text), doc))
    assert sorted(rows[2]) == sorted(last.values())
    assert sorted(rows[3]) == sorted({c for _, _, c in brute(list(rows[2].items()))})
    assert 0 < len(rows[4]) < len(rows[3])
    assert sorted(r.doc_id for r in seen[5].collect()) == sorted(rows[4])
