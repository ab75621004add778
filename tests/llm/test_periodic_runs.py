import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import periodic_runs
from tastegraph.llm.queries import op13_periodic_runs, looped_text
from tests.llm.frames import awkward, frame


def brute(words):
    """All runs, by looking at every lag and every smallest period."""
    out = []
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)


@pytest.mark.parametrize("seed", range(40))
def test_equals_brute_force(seed):
    draw = random.Random(seed)
    words = []
    while len(words) < draw.randint(5, 500):
        kind = draw.random()
        if kind < 0.4:
            words += [draw.choice("ab") for _ in range(draw.randint(1, 12))]
        else:
            period = [draw.choice("abcdef"[: draw.randint(1, 6)]) for _ in range(draw.choice([1, 2, 3, 5, 8, 9, 12, 16, 17, 31, 33, 40]))]
            words += (period * 9)[: int(len(period) * draw.uniform(2, 8))]
    assert periodic_runs.find(numbers(words)) == brute(words)


def test_nested_and_long_periods():
    inner = list("aaaaaab") * 5 + list("cd")
    words = inner * 5 + list("xyz") + [f"w{i}" for i in range(300)] * 4
    found = periodic_runs.find(numbers(words))
    assert found == brute(words)
    assert (len(inner) * 5 + 3, 1200, 300) in found and (0, len(inner) * 5, len(inner)) in found


def test_fibonacci_and_powers_of_letters():
    a, b = "a", "ab"
    while len(b) < 900:
        a, b = b, b + a
    for words in (b, "a" * 700, "ab" * 300 + "a", "abaab" * 100, ""):
        assert periodic_runs.find(numbers(words)) == brute(words)


def test_many_words_take_few_seeds():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 2000, 200_000)
    words[50_000:120_000] = words[50_000 + np.arange(70_000) % 9_000]
    assert (50_000, 70_000, 9_000) in [(s, n, p) for s, n, p in periodic_runs.find(words) if p == 9_000]
    assert sum(len(p) for p, _ in periodic_runs._seeds(words)) < 200


def expected(doc_id, text):
    words = periodic_runs.WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def looped_ids(n):
    return [i for i in range(100_000) if zlib.crc32(str(i).encode()) % 10 == 0][:n]


def test_digests_equal_brute_force(spark, tmp_path):
    draw = random.Random(1)
    prose = lambda n: " ".join(draw.choice(["the", "of", "a", "moon", "is", "x1", "É"]) + str(draw.randint(0, 9)) for _ in range(n))
    texts = [None, "", " \t\n", "one", "a a a a a a", "a b a b a b a b a", "a b\x1cc " * 8, prose(300), prose(40) + " go go" * 30 + " " + prose(50)]
    rows = [(i, t) for i, t in zip(looped_ids(20), texts + [prose(n) for n in (1, 5, 90, 400, 700)])]
    rows += [(i, t) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10] + [(None, "b b b b b b c"), (rows[-1])]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r)[:8] for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([expected(*r) for r in rows], key=str)


def test_awkward_rows_and_small_slices(spark, monkeypatch):
    docs = awkward(spark)
    found = periodic_runs.digests(docs)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.count() == docs.count()
    assert periodic_runs.digests(docs.limit(0)).count() == 0
    loop = frame(spark, [(1, "x " + "again and again " * 400), (2, "again and again"), (1, "x " + "again and again " * 400)])
    assert [[tuple(x) for x in r.runs] for r in periodic_runs.runs(loop).orderBy("doc_id").collect()] == [[(1, 1200, 3)]] * 2 + [[]]
    assert [r.text for r in periodic_runs.collapsed(loop).orderBy("doc_id").collect()] == ["x again and again"] * 2 + ["again and again"]


def test_slices_do_not_change_the_result():
    draw = random.Random(2)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 60))) for _ in range(200)]

    def results(size):
        periodic_runs.SLICE_WORDS = size
        return [r[0::2] for s in periodic_runs._slices(iter(enumerate(texts))) for r in periodic_runs._runs_of_slice(s)]

    before = periodic_runs.SLICE_WORDS
    try:
        assert results(1) == results(before) == results(500)
    finally:
        periodic_runs.SLICE_WORDS = before


def test_loops_in_sql_functions(spark):
    docs = frame(spark, [(i, " ".join(f"w{j}" for j in range(50))) for i in looped_ids(3)])
    shown = {r.doc_id: r.text for r in docs.select("doc_id", looped_text(F.col("doc_id"), F.col("text")).alias("text")).collect()}
    assert all(len(t.split()) == 50 and len(set(t.split())) < 50 for t in shown.values())
