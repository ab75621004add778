"""Token-ID files: short documents compressed one by one with a shared zstandard dictionary.

A file set is a folder with two Parquet tables:

* ``dictionary``: one row with the dictionary's SHA-256, its bytes, and the width of an ID;
* ``blocks``: rows of up to BLOCK_DOCS documents in ascending ID order: the dictionary's hash,
  the documents' IDs, the offsets of their zstandard frames in ``payload`` (the offset index),
  the payload, and where the block stands: ``part`` (files in order), ``seq`` in its part,
  ``before`` (token IDs of the part before it), ``tokens``.

A frame holds one document's token IDs as little-endian integers, so one document is read by
slicing its frame and decompressing a few hundred bytes. Spark's writer commits the files, so a
lost executor's tasks are repeated without trace.

A null text counts as empty (only the end ID is written). Rows without an ID come first; rows
that repeat an ID all stay, in no particular order among themselves. An empty table gives a file
set without blocks.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tastegraph.session import written

# The dictionary serves short documents. It is trained on the whole ID arrays of those of TRAIN_DOCS
# documents (with the smallest hashes of their IDs) that have at most TRAIN_CHARS characters: a sample
# bounded in rows and bytes, whatever the size of the corpus.
TRAIN_DOCS, TRAIN_CHARS, DICTIONARY_BYTES = 1000, 8000, 32768
BLOCK_DOCS, BLOCK_BYTES = 2048, 1 << 20
# Distinct pieces between white space whose IDs a task keeps; then it starts anew.
KEPT_PIECES = 800_000
# Pieces, and words in one text, that the library is asked for at once.
ASKED, WORDS_A_TEXT = 20_000, 1000
SALTS = 64
# Fixed value: the splitting pattern of the tokenizer files that the encoder is valid for.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE = re.compile("[^\\S\x1c-\x1f]+")


class PieceEncoder:
    """IDs of texts by the tokenizers library, which is asked once for each distinct piece.

    Valid for tokenizers that fold case, drop white space and split letters from other marks, so that no token
    spans two pieces, nor a word and its closing mark; other definitions are refused.

    Words of letters go to the library many at a time with blanks between. Their IDs are told apart by
    the labels that end with the vocabulary's word-end mark: a word has one such label at most, so
    if there are as many as words, each has its own. Otherwise, and without such a mark, words go one by one.
    """

    def __init__(self, definition: str, width: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        spec = json.loads(definition)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [p for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        first = splits[0] if splits else {"pattern": {}, "behavior": "", "invert": False}
        if kinds != ["NFC", "Replace", "Lowercase"] or first["pattern"].get("Regex") != WORDS or first["behavior"] != "Removed" or not first["invert"]:
            raise ValueError("this kind of tokenizer file is not supported")
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = f"<u{width}"
        self.kept: dict[str, bytes] = {}
        labels = self.tokenizer.get_vocab(with_added_tokens=True)
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(labels.values()) + 1, bool)
        if suffix:
            self.ends[[i for label, i in labels.items() if label.endswith(suffix)]] = True

    def _ask(self, pieces: list[str]) -> None:
        for a in range(0, len(pieces), ASKED):
            part = pieces[a : a + ASKED]
            for piece, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.kept[piece] = np.array(found.ids, self.kind).tobytes()

    def _ask_words(self, words: list[str]) -> None:
        width = np.dtype(self.kind).itemsize
        for a in range(0, len(words), WORDS_A_TEXT):
            part = words[a : a + WORDS_A_TEXT]
            [found] = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                self._ask(part)
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(part, (ends * width).tolist()):
                self.kept[word] = raw[start:end]
                start = end

    def encode(self, texts: list[str]) -> list[bytes]:
        kept = self.kept
        if len(kept) > KEPT_PIECES:
            kept.clear()
        split = [text.split() if not _ODD.search(text) else [p for p in _SPACE.split(text) if p] for text in texts]
        every: set[str] = set()
        for pieces in split:
            every.update(pieces)
        new = every.difference(kept)
        # A word and its closing mark are apart for the tokenizer, and case is folded: most new
        # pieces are known words in another form.
        formed = [(p, m[1].lower(), m[2]) for p in new if (m := _FORMED.fullmatch(p))]
        words = {word for _, word, _ in formed}
        others = new.difference([p for p, _, _ in formed])
        others.update([mark for _, _, mark in formed if mark])
        self._ask_words(list(words.difference(kept)))
        self._ask(list(others.difference(kept)))
        for piece, word, mark in formed:
            kept[piece] = kept[word] + kept[mark] if mark else kept[word]
        out = [b"".join(map(kept.__getitem__, pieces)) for pieces in split]
        for piece in [p for p in new | words | others if len(p) > 64]:
            kept.pop(piece, None)
        return out


# Latin letters and then marks, which no splitting rule joins (an apostrophe might).
_FORMED = re.compile(r"([A-Za-zÀ-ÖØ-öø-\u012fĲ-\u024f]+)([!\"#$%&()*+,\-./:;=?@\[\]^`{}~]{0,4})")
_ODD = re.compile("[\x1c-\x1f]")
_encoders: dict[tuple, PieceEncoder] = {}


def _encoder(definition: str, width: int) -> PieceEncoder:
    key = hashlib.sha256(definition.encode()).hexdigest(), width
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PieceEncoder(definition, width)
    return _encoders[key]


def id_width(definition: str) -> int:
    """Bytes for an ID of this vocabulary: 2 or 4."""
    return 2 if Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, definition: str, width: int, text_col: str = "text", id_col: str = "doc_id") -> bytes:
    """A dictionary from whole serialized ID arrays of the bounded sample; empty if it has no short text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = F.xxhash64(F.col(id_col))
    last = docs.select(order.alias("o")).distinct().orderBy("o").limit(TRAIN_DOCS).agg(F.max("o")).head()[0]
    if last is None:
        return b""
    rows = docs.filter((order <= last) & (F.length(text) <= TRAIN_CHARS)).groupBy(order.alias("o")).agg(F.min(text).alias("t")).orderBy("o").collect()
    samples = [s for s in _encoder(definition, width).encode([r.t for r in rows]) if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own bytes serve
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(content: bytes):
    return zstandard.ZstdCompressionDict(content) if content else None


def write_ids(docs: DataFrame, definition: str, path: str, end_id: int | None = None, text_col: str = "text", id_col: str = "doc_id") -> None:
    """Encode every text and write the file set to ``path``; ``end_id`` ends each document."""
    spark = docs.sparkSession
    width = id_width(definition)
    content = train_dictionary(docs, definition, width, text_col, id_col)
    digest = hashlib.sha256(content).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()
    sent = spark.sparkContext.broadcast((definition, content))
    end = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()

    def frames(batches):
        definition, content = sent.value
        coder, squeeze = _encoder(definition, width), zstandard.ZstdCompressor(level=3, dict_data=_dictionary(content), write_content_size=True)
        for batch in batches:
            ids, salts = batch.column(0), batch.column(2)
            texts = batch.column(1)
            for a in range(0, batch.num_rows, 500):
                raw = [x + end for x in coder.encode([t or "" for t in texts.slice(a, 500).to_pylist()])]
                n = pa.array([len(x) // width for x in raw], pa.int64())
                packed = pa.array([squeeze.compress(x) for x in raw], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(a, 500), salts.slice(a, 500), n, packed], ["id", "salt", "n", "frame"])

    def blocks(batches):
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def block():
            ids, counts, packed = zip(*held)
            arrays = [
                pa.array([part], pa.int64()),
                pa.array([seq], pa.int64()),
                pa.array([before], pa.int64()),
                pa.array([sum(counts)], pa.int64()),
                pa.array([digest], pa.string()),
                pa.array([list(ids)], pa.list_(id_type)),
                pa.array([np.cumsum([0, *map(len, packed)])], pa.list_(pa.int64())),
                pa.array([b"".join(packed)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["part", "seq", "before", "tokens", "dictionary", "ids", "offsets", "payload"])

        for batch in batches:
            id_type = batch.column(0).type
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held.append(row)
                size += len(row[2])
                if len(held) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield block()
                    seq, before, held, size = seq + 1, before + sum(h[1] for h in held), [], 0
        if held:
            yield block()

    # The salt lets rows that repeat one ID (or have none) be dealt to several partitions.
    salted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.monotonically_increasing_id() % SALTS).alias("salt"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written before the ranges are drawn, which reads it twice.
    framed = written(salted.mapInArrow(frames, f"id {kind}, salt long, n long, frame binary"))
    ordered = (
        framed.repartitionByRange(parts, F.asc_nulls_first("id"), "salt")
        .sortWithinPartitions(F.asc_nulls_first("id"), "salt")
        .select("id", "n", "frame")
    )
    schema = f"part long, seq long, before long, tokens long, dictionary string, ids array<{kind}>, offsets array<long>, payload binary"
    ordered.mapInArrow(blocks, schema).withColumn("first_id", F.array_min("ids")).withColumn("last_id", F.array_max("ids")).write.option(
        "compression", "none"
    ).parquet(f"{path}/blocks")
    spark.createDataFrame([(digest, bytearray(content), width)], "hash string, content binary, width int").write.parquet(f"{path}/dictionary")


def read_ids(spark: SparkSession, path: str, wanted: list | None = None, digests_only: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids) of every document of a file set, or of the ``wanted`` ones.

    ``start`` counts the token IDs of all documents before. For ``wanted`` IDs only the blocks
    whose range holds one are read, and only their frames are decompressed.
    ``digests_only``: ``ids_crc32`` (over 32-bit integers) in place of ``ids``.
    """
    digest, content, width = spark.read.parquet(f"{path}/dictionary").head()
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    # One row for each file of the set.
    ahead = totals.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("ahead"))
    if wanted is not None:
        meant = F.lit(False)
        for x in wanted:
            meant = meant | (F.lit(x) >= F.col("first_id")) & (F.lit(x) <= F.col("last_id"))
        blocks = blocks.filter(meant)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    only = None if wanted is None else set(wanted)
    sent = spark.sparkContext.broadcast(bytes(content))
    placed = blocks.join(ahead, "part").select((F.col("ahead") + F.col("before")).alias("start"), "dictionary", "ids", "offsets", "payload")

    def documents(batches):
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(sent.value))
        for batch in batches:
            for row in range(batch.num_rows):
                start, hashed, ids, offsets, payload = (batch.column(i)[row].as_py() for i in range(5))
                if hashed != digest:
                    raise ValueError("a block was written with another dictionary")
                out_ids, starts, counts, found = [], [], [], []
                for i, a, b in zip(ids, offsets, offsets[1:]):
                    if only is not None and i not in only and len(ids) > 0:
                        # Its length is in the frame's header: nothing is decompressed.
                        start += zstandard.frame_content_size(payload[a : a + 18]) // width
                        continue
                    raw = np.frombuffer(unpack.decompress(payload[a:b]), f"<u{width}").astype("<u4")
                    out_ids.append(i)
                    starts.append(start)
                    counts.append(len(raw))
                    found.append(zlib.crc32(raw.tobytes()) if digests_only else raw.astype("i4"))
                    start += len(raw)
                last = pa.array(found, pa.int64() if digests_only else pa.list_(pa.int32()))
                arrays = [pa.array(out_ids, batch.column(2).type.value_type), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), last]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "start", "n_tokens", "last"])

    last = "long" if digests_only else "array<int>"
    found = placed.mapInArrow(documents, f"id {kind}, start long, n_tokens long, last {last}")
    return found.withColumnRenamed("last", "ids_crc32" if digests_only else "ids")
