import math

import numpy as np
import pytest

from tastegraph.llm import topk_blocks

SCHEMA = "vec_id long, embedding array<float>, id long, v int, score double, shard int"


def make(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, 3.0, 4) for i, e in rows], SCHEMA)


def brute(rows, queries, k):
    usable = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    asked = {}
    for i, e in usable:
        if i in queries:
            asked[i] = min(asked.get(i, e), e)
    out = []
    for q, qe in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(qe, e)), i) for i, e in usable if i != q and len(e) == len(qe))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(topk_blocks, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=6).round(1)]) for i in range(300)]
    rows += [(None, [0.5] * 6), (300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0, 2.0]), (305, [0.5, 1.0]), (306, [])]
    rows += rows[:20]  # repeated rows
    df = make(spark, rows)
    queries = {i for i in range(0, 310, 25)} | {304, 306}
    got = topk_blocks.search(df, df.filter(df.vec_id.isin(list(queries))), k=4)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 4)


def test_pruning_skips_blocks():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(16, 8)) * 200
    rows = np.floor(np.concatenate([c + rng.normal(size=(256, 8)) for c in centres])).astype(np.int64)
    index = topk_blocks.BlockIndex(np.arange(len(rows)), rows)
    query = rows[5]
    ids, scores = index.search(5, query, index.bounds(query[None])[0], 5)
    want = sorted((-int(s), i) for i, s in enumerate(rows @ query) if i != 5)[:5]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want
    assert index.scored < len(index.high) / 2


def test_fewer_than_k_and_empty(spark):
    df = make(spark, [(0, [1.0]), (1, [2.0])])
    assert [tuple(r) for r in topk_blocks.search(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk_blocks.search(df.limit(0), df.limit(0)).count() == 0
    assert topk_blocks.search(df, df.limit(0)).count() == 0


def test_large_finite_components_take_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0**46, 1.0]), (2, [0.5, 0.5])]
    df = make(spark, rows)
    got = sorted(map(tuple, topk_blocks.search(df, df.filter("vec_id = 0")).collect()))
    assert got == brute(rows, {0}, 5) and [r[2] for r in got] == [1, 2]
    far = make(spark, [(0, [2.0**40]), (1, [2.0**40])])
    with pytest.raises(Exception, match="bigint"):
        topk_blocks.search(far, far).collect()
