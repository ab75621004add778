import json
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from tastegraph.llm import token_files
from tastegraph.llm.queries import tokenizer_definition
from tests.llm.frames import awkward, frame


def expected(docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0]))
    return rows


def test_round_trip(spark, tmp_path):
    docs = awkward(spark)
    token_files.write_ids(docs, tokenizer_definition(), str(tmp_path / "a"), end_id=1)
    want, start = [], 0
    for doc, ids in expected(docs):
        want.append((doc, start, len(ids), ids))
        start += len(ids)
    got = token_files.read_ids(spark, str(tmp_path / "a")).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)
    sums = token_files.read_ids(spark, str(tmp_path / "a"), digests_only=True).collect()
    assert sorted(r.ids_crc32 for r in sums) == sorted(zlib.crc32(np.array(w[3], "<u4").tobytes()) for w in want)


def test_single_documents_and_blocks(spark, tmp_path, monkeypatch):
    docs = frame(spark, [(i, f"the text number {i} " * (i % 7)) for i in range(200)])
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 16)
    token_files.write_ids(docs, tokenizer_definition(), str(tmp_path / "b"))
    every = {r.id: tuple(r) for r in token_files.read_ids(spark, str(tmp_path / "b")).collect()}
    some = token_files.read_ids(spark, str(tmp_path / "b"), wanted=[3, 150, 999]).collect()
    assert {r.id: tuple(r) for r in some} == {i: every[i] for i in (3, 150)}
    assert sorted(every) == list(range(200))


def test_dictionary_is_checked(spark, tmp_path):
    path = str(tmp_path / "c")
    token_files.write_ids(frame(spark, [(i, f"a b c {i}") for i in range(30)]), tokenizer_definition(), path)
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("dictionary", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    blocks.write.parquet(f"{path}2/blocks")
    spark.read.parquet(f"{path}/dictionary").write.parquet(f"{path}2/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_ids(spark, f"{path}2").collect()


def test_empty(spark, tmp_path):
    token_files.write_ids(frame(spark, []), tokenizer_definition(), str(tmp_path / "d"), end_id=1)
    assert token_files.read_ids(spark, str(tmp_path / "d")).count() == 0


def test_frame_sizes_are_in_the_header():
    raw = b"ab" * 1000
    assert zstandard.frame_content_size(zstandard.ZstdCompressor().compress(raw)[:18]) == 2000


def test_words_asked_for_together_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_A_TEXT", 7)
    texts = ["One two, two! THREE four's fünf sechs sieben acht neun zehn", "ŁÓDŹ łódź Łódź; ǅ ẞ İ ŉ ¼ x²", "", "</w> a</w>b <|endoftext|> don't"]
    definition = tokenizer_definition()
    library = Tokenizer.from_str(definition)
    found = token_files.PieceEncoder(definition, 4).encode(texts * 2)
    assert found == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts * 2]


def test_without_word_ends_words_are_asked_for_one_by_one():
    spec = json.loads(tokenizer_definition())
    spec["model"]["end_of_word_suffix"] = None
    definition = json.dumps(spec)
    library = Tokenizer.from_str(definition)
    [found] = token_files.PieceEncoder(definition, 4).encode(["some words, and some more"])
    assert found == np.array(library.encode("some words, and some more", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("change", [{"normalizer": None}, {"pre_tokenizer": None}, {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "a"}, "behavior": "Isolated", "invert": False}]}}])
def test_other_kinds_of_tokenizers_are_refused(change):
    with pytest.raises(ValueError):
        token_files.PieceEncoder(json.dumps(json.loads(tokenizer_definition()) | change), 4)


def test_dictionary_learns_from_whole_short_texts_only(spark, monkeypatch):
    monkeypatch.setattr(token_files, "TRAIN_CHARS", 60)
    rows = [(i, f"short text number {i} of the sample") for i in range(300)] + [(1000 + i, "long unseen words " * 50) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    definition = tokenizer_definition()
    content = token_files.train_dictionary(docs, definition, 2)
    unseen = np.array(Tokenizer.from_str(definition).encode("long unseen words long", add_special_tokens=False).ids, "<u2").tobytes()
    assert content and unseen not in content
    assert token_files.train_dictionary(docs.filter("doc_id >= 1000"), definition, 2) == b""
