import itertools
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tastegraph.llm import bpe_automaton
from tastegraph.llm.queries import tokenizer_definition
from tests.llm.frames import awkward, frame


def merged(word, merges, end):
    """BPE as defined: each merge in turn, from left to right."""
    parts = list(word[:-1]) + [word[-1] + end] if word else []
    for u, v in merges:
        out = []
        for p in parts:
            if out and out[-1] == u and p == v and not isinstance(out[-1], Done):
                out[-1] = Done(u + v)
            else:
                out.append(p)
        parts = [str(p) for p in out]
    return parts


class Done(str):
    """A token made by the merge under way: it takes no part in that merge again."""


@pytest.mark.parametrize("end", ["", "#"])
def test_automaton_equals_merging(end):
    rng = random.Random(5)
    for _ in range(30):
        letters = "abc"
        tokens = list(letters) + ([c + end for c in letters] if end else [])
        merges = []
        while len(merges) < 9:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if (end and u.endswith(end)) or u + v in tokens:
                continue
            merges.append((u, v))
            tokens.append(u + v)
        vocab = {t: i for i, t in enumerate(tokens)}
        automaton = bpe_automaton.Automaton(vocab, merges, end)
        for n in range(1, 7):
            for word in itertools.product(letters, repeat=n):
                word = "".join(word)
                assert [tokens[i] for i in automaton.path(word)] == merged(word, merges, end), (word, merges)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


LETTERS = [*"aabcthe'sn 1,.!<|>éßΣςİ中\u0301 \x1c\x85\n\t", "<|endoftext|>", "<|ENDOFTEXT|>", "\U000105c0", "\U0001fae9"]


@given(st.lists(st.sampled_from(LETTERS), max_size=60).map("".join))
@settings(max_examples=200, deadline=None)
def test_codec_equals_library(text):
    library = bpe_automaton.codec(tokenizer_definition()).library
    ids, decoded = bpe_automaton.codec(tokenizer_definition()).encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert list(memoryview(ids).cast("I")) == want
    assert decoded == library.decode(want, skip_special_tokens=False) == bpe_automaton.codec(tokenizer_definition()).decode(want)


def test_frames(spark, library):
    docs = awkward(spark)
    definition = tokenizer_definition()
    coded = bpe_automaton.encode(docs, definition)
    got = coded.collect()
    want = sorted([(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()], key=str)
    assert sorted([(r.doc_id, r.ids) for r in got], key=str) == want
    assert sorted([(r.doc_id, r.decoded) for r in got], key=str) == sorted([tuple(r) for r in bpe_automaton.decode(coded, definition).collect()], key=str)
    assert bpe_automaton.digests(docs, definition).count() == len(got)
    assert bpe_automaton.digests(frame(spark, []), definition).count() == 0


def test_bounded_tables(monkeypatch, library):
    monkeypatch.setattr(bpe_automaton, "KEPT_PIECES", 3)
    coder = bpe_automaton.Codec(tokenizer_definition())
    text = "one two three four five six seven eight nine ten " * 3 + "x" * 3000
    assert list(memoryview(coder.encode(text)[0]).cast("I")) == library.encode(text, add_special_tokens=False).ids
