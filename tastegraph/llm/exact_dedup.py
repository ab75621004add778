"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every task cuts its rows into blocks and keeps a SHA-256 of each normalised text.
2. A block sends the sorted 56-bit fingerprints of its texts, Golomb-coded, to the owners of
   the fingerprint ranges, each fingerprint once, with a bit if the block holds it twice.
3. An owner answers each message with a bitmap: which of its fingerprints occur elsewhere too.
4. Only suspects (rows whose bit is set) have their texts shuffled. Equal bytes are grouped
   there, copies within a task before the shuffle.

Texts are equal if they are identical after lower-casing A-Z; null counts as empty. Of equal
texts the row with the largest ID stays (a null ID is smaller than any other; of rows that
repeat ID and text one stays). An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import attach_left, filter_bits, fold_ascii, in_filter, key_filter, packed
from tastegraph.session import written

BLOCK_ROWS = 1 << 16
FINGERPRINT_BITS = 56


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct integers as (parameter k, unary part, remainders) of their differences.

    A Golomb code with divisor 2**k, k chosen by the mean difference.
    """
    if not len(values):
        return 0, b"", b""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    k = int(max(0, np.floor(np.log2(max(1.0, 0.69 * float(steps.mean()))))))
    unary = np.zeros(int((steps >> k).sum()) + len(steps), np.uint8)
    unary[np.cumsum((steps >> k) + 1) - 1] = 1
    rest = ((steps[:, None] >> np.arange(k)) & 1).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n].astype(np.int64)
    steps = (np.diff(ends, prepend=np.int64(-1)) - 1) << k
    if k:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k).astype(np.int64)
        steps += bits @ (np.int64(1) << np.arange(k, dtype=np.int64))
    return np.cumsum(steps)


def fingerprints(shas: bytes) -> np.ndarray:
    first = np.frombuffer(shas, ">u8").reshape(-1, 4)[:, 0]
    return (first >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)


def _owners(prints: np.ndarray, owners: int) -> np.ndarray:
    return ((prints >> 24) * owners) >> (FINGERPRINT_BITS - 24)


def _blocks(batches):
    """Rows of a task -> rows (block, ids, shas); block * BLOCK_ROWS + place numbers a row."""
    part, number, ids, shas, held = TaskContext.get().partitionId(), 0, [], [], 0

    def block():
        row = (part << 24) + number
        whole = pa.concat_arrays(ids)
        offsets = pa.array([0, len(whole)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([row], pa.int64()), pa.ListArray.from_arrays(offsets, whole), pa.array([b"".join(shas)], pa.binary())],
            ["block", "ids", "shas"],
        )

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, BLOCK_ROWS - held)
            ids.append(piece.column(0))
            shas += piece.column(1).to_pylist()
            held, at = held + piece.num_rows, at + piece.num_rows
            if held == BLOCK_ROWS:
                yield block()
                number, ids, shas, held = number + 1, [], [], 0
    if held:
        yield block()


def _messages(owners: int):
    def run(batches):
        for batch in batches:
            for number, shas in zip(batch.column("block").to_pylist(), batch.column("shas").to_pylist()):
                prints, counts = np.unique(fingerprints(shas), return_counts=True)
                whose = _owners(prints, owners)
                cuts = np.flatnonzero(np.diff(whose, prepend=-1))
                out = []
                for a, b in zip(cuts, [*cuts[1:], len(prints)]):
                    k, unary, rest = golomb_encode(prints[a:b])
                    twice = np.packbits(counts[a:b] > 1).tobytes()
                    out.append((int(whose[a]), number, int(b - a), k, unary, rest, twice))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["owner", "block", "n", "k", "unary", "rest", "twice"]), preserve_index=False)

    return run


def _answers(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's answers: for each message, a bit for each fingerprint that is not unique."""
    lists = [golomb_decode(m.n, m.k, m.unary, m.rest) for m in messages.itertuples()]
    twice = [np.unpackbits(np.frombuffer(m.twice, np.uint8))[: m.n].astype(bool) for m in messages.itertuples()]
    every = np.concatenate(lists)
    prints, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    again = counts > 1
    again[place[np.concatenate(twice)]] = True
    bits = np.split(again[place], np.cumsum([len(x) for x in lists])[:-1])
    return pd.DataFrame({"block": messages["block"], "owner": messages["owner"], "bits": [np.packbits(b).tobytes() for b in bits]})


def _suspects(owners: int):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        bits = dict(zip(answers["owner"], answers["bits"]))
        for number, ids, shas in zip(blocks["block"], blocks["ids"], blocks["shas"]):
            prints, place = np.unique(fingerprints(shas), return_inverse=True)
            whose = _owners(prints, owners)
            flags = np.zeros(len(prints), bool)
            for owner in np.unique(whose):
                mine = np.flatnonzero(whose == owner)
                flags[mine] = np.unpackbits(np.frombuffer(bits[owner], np.uint8))[: len(mine)]
            out.append(
                pd.DataFrame(
                    {
                        "id": pd.Series(list(ids), dtype="object"),
                        "sha": [shas[32 * i : 32 * i + 32] for i in range(len(place))],
                        "row": number * BLOCK_ROWS + np.arange(len(place)),
                        "suspect": flags[place],
                    }
                )
            )
        return pd.concat(out, ignore_index=True)

    return run


def _sha(text: str) -> Column:
    return F.unhex(F.sha2(fold_ascii(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256))


def _short(sha: str) -> Column:
    """60 bits of a SHA-256 as a bigint."""
    return F.conv(F.hex(F.substring(sha, 1, 8)).substr(1, 15), 16, 10).cast("bigint")


def marked_rows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", owners: int | None = None) -> DataFrame:
    """(id, sha, row, suspect) for every row: the exchange of fingerprints. ``row`` is unique."""
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("id"), _sha(text_col).alias("sha"))
    blocks = written(named.mapInArrow(_blocks, f"block long, ids array<{kind}>, shas binary"))
    schema = "owner long, block long, n long, k long, unary binary, rest binary, twice binary"
    answers = (
        blocks.select("block", "shas")
        .mapInArrow(_messages(owners), schema)
        .groupBy("owner")
        .applyInPandas(_answers, "block long, owner long, bits binary")
    )
    return written(
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(_suspects(owners), f"id {kind}, sha binary, row long, suspect boolean")
    )


def _classes(docs: DataFrame, marked: DataFrame, text_col: str) -> DataFrame:
    """(sha, n, best) of every text that occurs more than once; best: (id, row) that stays."""
    suspects = marked.filter("suspect")
    texts = docs.select(fold_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("normal"), _sha(text_col).alias("sha"))
    size = filter_bits(suspects.count())
    bits = key_filter(suspects.select(_short("sha").alias("key")), "key", size)
    shuffled = in_filter(texts, _short("sha"), bits, bits=size)
    # Equal bytes only: a sha that two different texts had would show here as two groups.
    verified = (
        shuffled.groupBy("sha", "normal").agg(F.count(F.lit(1)).alias("copies")).groupBy("sha").agg(F.count(F.lit(1)).alias("texts"))
    )
    found = suspects.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "row")).alias("best")).filter("n > 1")
    same = F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")).cast("bigint"))
    return written(found.join(verified, "sha").select("sha", same.alias("n"), "best"))


def duplicate_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", owners: int | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    ``owners``: fingerprint ranges, default the number of shuffle partitions.
    """
    marked = marked_rows(docs, text_col, id_col, owners)
    classes = _classes(docs, marked, text_col)
    single = marked.filter(~F.col("suspect")).select("*", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast(classes.schema["best"].dataType).alias("best"))
    rows = single.unionByName(attach_left(marked.filter("suspect"), classes, "sha", "n"))
    alone = F.col("n").isNull()
    return rows.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", owners: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows of unique texts are passed on where they are; only rows with copies are shuffled.
    """
    marked = marked_rows(docs, text_col, id_col, owners)
    classes = _classes(docs, marked, text_col).select("sha", F.col("best.id").alias("_best"))
    rows = packed(docs, _sha(text_col).alias("_sha"), F.col(id_col).alias("_id"))
    size = filter_bits(classes.count())
    bits = key_filter(classes.select(_short("sha").alias("key")), "key", size)
    unique = in_filter(rows, _short("_sha"), bits, passing=False, bits=size)
    maybe = in_filter(rows, _short("_sha"), bits, bits=size)
    stays = maybe.join(classes, F.col("_sha") == F.col("sha"), "left").filter(F.col("sha").isNull() | F.col("_best").eqNullSafe(F.col("_id")))
    alone = stays.filter(F.col("sha").isNull())
    best = stays.filter(F.col("sha").isNotNull()).dropDuplicates(["_sha"])
    return unique.select("row.*").unionByName(alone.select("row.*")).unionByName(best.select("row.*"))
