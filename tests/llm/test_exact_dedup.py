import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import exact_dedup
from tests.llm.frames import awkward, frame


@given(st.sets(st.integers(0, (1 << 56) - 1), max_size=200))
@settings(max_examples=60, deadline=None)
def test_golomb_round_trip(values):
    given_values = np.array(sorted(values), np.int64)
    k, unary, rest = exact_dedup.golomb_encode(given_values)
    assert exact_dedup.golomb_decode(len(given_values), k, unary, rest).tolist() == given_values.tolist()


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(fold(text), []).append(doc)
    best = {t: max(d, key=lambda x: (x is not None, x)) for t, d in groups.items()}
    return sorted([(d, best[fold(t)], len(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest()) for d, t in rows], key=str)


def test_report(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = exact_dedup.duplicate_report(docs, owners=3).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({fold(t) for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    docs = awkward(spark)
    got = exact_dedup.deduplicate(docs, owners=2)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 3, 4, 6, 7, 8]


def test_hot_group(spark):
    docs = frame(spark, [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)])
    got = exact_dedup.duplicate_report(docs, owners=4).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3} == {(2999, 2000)}
    assert all(r.kept and r.group_size == 1 for r in got if r.doc_id % 3 == 0)


@pytest.mark.parametrize("run", [exact_dedup.duplicate_report, exact_dedup.deduplicate])
def test_empty(spark, run):
    assert run(frame(spark, [])).count() == 0
