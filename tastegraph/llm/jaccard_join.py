"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set holds the 64-bit hashes of its distinct shingles. All sets are sorted by one
order: estimated frequency (a sketch of SKETCH counters over the whole corpus), then hash; any
order gives the same result. If two sets are similar, their prefixes of

    size - ceil(threshold * size) + l

shingles share at least l shingles. Each document picks its own l (1 to LEVELS) by
estimated cost: a longer prefix meets more postings, but more shared shingles are asked for
before a pair is verified. The larger document of a pair probes with its l.

Where two documents meet, both sizes are known: a similar pair has at least
ceil(threshold * (size + other size) / (1 + threshold)) shingles in common, so of the prefixes
only the first size - that + l shingles of each have to share l. This is about half of what the
size alone asks for, and shingles that a document holds alone, which stand first, use it up.

1. Equal sets form a class; only its document with the smallest ID goes on.
2. Prefixes are exchanged as in ``exact_dedup`` (Golomb-coded, bitmaps back), so that only
   shingles that occur in two prefixes become rows.
3. Star rounds: in the postings of a shingle each document is paired with a leader of another
   component, once with the one it shares most with; verified links join components. A group
   of near copies collapses here at a cost linear in its size. The rounds end when
   fewer than half of the pairs are links.
4. All remaining candidates: pairs of different components with l shared shingles in what both
   sizes leave of their prefixes. Every link joins documents of one component or is such a
   candidate, so the components are exact.

Rows without an ID are linked with nothing and have no component. Rows that share an ID count as
one node. Null and empty texts have no shingles; they are linked with nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.ordering import dense_position
from tastegraph.llm.common import filter_bits, handing_back, in_filter, key_filter, packed, text_key, without
from tastegraph.llm.components import components
from tastegraph.llm.exact_dedup import _answers, _owners, golomb_encode
from tastegraph.session import discard, written

WORDS, PERCENT = 5, 80
SKETCH, CHUNK = 1 << 20, 1 << 12
LEVELS, BLOCK_DOCS = 4, 2048
# Cost of verifying a candidate, in postings read.
VERIFY_COST = 20.0
STAR_ROUNDS = 3
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes (uint64) of the runs of ``words`` words; a shorter text is one run."""
    split = (text or "").encode("utf-8", "replace").lower().split()
    n = len(split)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, n)
    length = min(words, n)
    total = np.full(n - length + 1, length, np.uint64)
    for i in range(length):
        weight = _WEIGHTS[i % len(_WEIGHTS)] + np.uint64(2 * (i // len(_WEIGHTS)))
        total += _mixed(hashes[i : n - length + 1 + i]) * weight
    return np.unique(_mixed(total))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def prefix_base(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(words: int):
    """Rows (id, hash, len, n, d1, d2) of every text, then the task's sketch in rows (chunk, counts)."""

    def run(batches):
        sketch = np.zeros(SKETCH, np.int64)
        id_type = pa.int64()
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                sets = [shingles(t, words) for t in part.column(3).to_pylist()]
                digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                every = np.concatenate(sets)
                sketch += np.bincount((every >> np.uint64(44)).astype(np.int64), minlength=SKETCH)
                low = (1 << 63) - 1
                arrays = [*[part.column(i) for i in range(3)], pa.array([len(s) for s in sets], pa.int64())]
                arrays += [pa.array([d & low for d in digests], pa.int64()), pa.array([(d >> 64) & low for d in digests], pa.int64())]
                arrays += [pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "hash", "len", "n", "d1", "d2", "chunk", "counts"])
        used = [c for c in range(SKETCH // CHUNK) if sketch[c * CHUNK : (c + 1) * CHUNK].any()]
        none = lambda kind: pa.nulls(len(used), kind)
        counts = pa.array([sketch[c * CHUNK : (c + 1) * CHUNK].astype("<i4").tobytes() for c in used], pa.binary())
        arrays = [none(id_type), none(pa.int64()), none(pa.int32()), none(pa.int64()), none(pa.int64()), none(pa.int64())]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(used, pa.int64()), counts], ["id", "hash", "len", "n", "d1", "d2", "chunk", "counts"])

    return run


def _sum_chunk(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CHUNK, np.int64)
    for counts in rows["counts"]:
        total += np.frombuffer(counts, "<i4")
    return pd.DataFrame({"chunk": rows["chunk"][:1], "counts": [total.tobytes()]})


def choose_level(frequencies: np.ndarray, base: int, most: int) -> int:
    """The l of least estimated cost, from the estimated frequencies of the longest prefix.

    ``base``: how many of them are read with l = 1.
    """
    reads = np.cumsum(frequencies)
    best, least = 1, np.inf
    for level in range(1, most + 1):
        read = float(reads[min(len(reads), base + level - 1) - 1])
        cost = read + VERIFY_COST * read / level
        if cost < least:
            best, least = level, cost
    return best


def _prefixes(sketch_sent, words: int, percent: int):
    """Blocks of documents with their prefixes: (block, payload) of entries sorted by shingle."""

    def run(batches):
        sketch = sketch_sent.value
        noise = sketch.sum() / SKETCH
        part, number = TaskContext.get().partitionId() << 24, 0
        held: list[tuple] = []

        def block():
            nonlocal number
            number += 1
            tokens = np.concatenate([h[1] for h in held])
            order = np.argsort(tokens, kind="stable")
            spread = lambda k: np.repeat(np.array([h[k] for h in held], np.int64), [len(h[1]) for h in held])
            levels = np.concatenate([h[4] for h in held])
            columns = [tokens.astype(np.uint64).view(np.int64), spread(0), spread(2), levels * 8 + spread(3)]
            data = [c[order].astype(np.int64).tobytes() for c in columns[:2]] + [c[order].astype(np.int32).tobytes() for c in columns[2:]]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([part + number], pa.int64()), *[pa.array([d], pa.binary()) for d in data]], ["block", "tokens", "docs", "sizes", "info"]
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = shingles(text.as_py(), words)
                n = len(found)
                if n == 0:
                    continue
                counts = sketch[(found >> np.uint64(44)).astype(np.int64)]
                base = prefix_base(n, percent)
                most = min(LEVELS, n - base + 1)
                take = np.lexsort((found, counts))[: base + most - 1]
                # What another set of this size is met with.
                met = n - -(-2 * percent * n // (100 + percent)) + 1
                level = choose_level(np.maximum(1.0, counts[take] - noise), met, most)
                held.append((doc, found[take], n, level, np.arange(1, len(take) + 1)))
                if len(held) >= BLOCK_DOCS:
                    yield block()
        if held:
            yield block()

    return run


def _flags(tokens: np.ndarray, bits: dict, owners: int) -> np.ndarray:
    """Which of a block's tokens the owners have found elsewhere too."""
    prints, place = np.unique(tokens >> np.uint64(8), return_inverse=True)
    whose = _owners(prints.astype(np.int64), owners)
    flags = np.zeros(len(prints), bool)
    for owner in np.unique(whose):
        mine = np.flatnonzero(whose == owner)
        flags[mine] = np.unpackbits(np.frombuffer(bits[owner], np.uint8))[: len(mine)]
    return flags[place]


def _messages(owners: int):
    def run(batches):
        for batch in batches:
            for number, tokens in zip(batch.column("block").to_pylist(), batch.column("tokens").to_pylist()):
                prints, counts = np.unique(np.frombuffer(tokens, np.uint64) >> np.uint64(8), return_counts=True)
                prints = prints.astype(np.int64)
                whose = _owners(prints, owners)
                cuts = np.flatnonzero(np.diff(whose, prepend=-1))
                out = []
                for a, b in zip(cuts, [*cuts[1:], len(prints)]):
                    k, unary, rest = golomb_encode(prints[a:b])
                    out.append((int(whose[a]), number, int(b - a), k, unary, rest, np.packbits(counts[a:b] > 1).tobytes()))
                frame = pd.DataFrame(out, columns=["owner", "block", "n", "k", "unary", "rest", "twice"])
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return run


def _shared(owners: int):
    """The entries of a block whose shingle occurs in another prefix too."""

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        bits = dict(zip(answers["owner"], answers["bits"]))
        out = []
        for b in blocks.itertuples():
            tokens = np.frombuffer(b.tokens, np.int64)
            keep = _flags(tokens.view(np.uint64), bits, owners)
            info = np.frombuffer(b.info, np.int32)[keep]
            docs = np.frombuffer(b.docs, np.int64)[keep]
            _, own, counts = np.unique(docs, return_inverse=True, return_counts=True)
            out.append(
                pd.DataFrame(
                    {
                        "token": tokens[keep],
                        "doc": docs,
                        "held": counts[own],
                        "n": np.frombuffer(b.sizes, np.int32)[keep].astype(np.int64),
                        "place": info >> 3,
                        "level": info & 7,
                    }
                )
            )
        return pd.concat(out, ignore_index=True)

    return run


def _verified(words: int, percent: int):
    def run(batches):
        for batch in batches:
            kept: dict[int, np.ndarray] = {}
            left, right = [], []
            x, y, a, b = (batch.column(i) for i in range(4))
            for i, (p, q) in enumerate(zip(x.to_pylist(), y.to_pylist())):
                one = shingles(a[i].as_py(), words)
                other = kept.get((q, len(b[i].as_py())))
                if other is None:
                    if len(kept) > 32:
                        kept.clear()
                    other = shingles(b[i].as_py(), words)
                    kept[(q, len(b[i].as_py()))] = other
                if similar(one, other, percent):
                    left.append(p)
                    right.append(q)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _of_docs(texts: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """The rows (doc, text) of these ``n`` documents, and a few others; nothing is shuffled."""
    size = filter_bits(n)
    return in_filter(texts, F.xxhash64("doc"), key_filter(docs.select(F.xxhash64("doc").alias("key")), "key", size), bits=size)


def _links(pairs: DataFrame, n: int, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the ``n`` pairs (x, y) whose texts are similar, as (a, b)."""
    one = _of_docs(texts, pairs.select(F.col("x").alias("doc")), n).select(F.col("doc").alias("x"), F.col("text").alias("text_x"))
    other = _of_docs(texts, pairs.select(F.col("y").alias("doc")), n).select(F.col("doc").alias("y"), F.col("text").alias("text_y"))
    rows = pairs.select("x", "y").join(one, "x").join(other, "y").select("x", "y", "text_x", "text_y")
    return written(rows.mapInArrow(handing_back(_verified(words, percent)), "a long, b long").distinct())


class _Components:
    """Which component each document of the postings is in."""

    def __init__(self, docs: DataFrame):
        self.of = written(docs.select("doc", F.col("doc").alias("comp")))

    def join(self, links: DataFrame) -> None:
        if links.isEmpty():
            return
        comp = self.of
        ends = (
            links.join(comp.select(F.col("doc").alias("a"), F.col("comp").alias("ca")), "a")
            .join(comp.select(F.col("doc").alias("b"), F.col("comp").alias("cb")), "b")
            .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        )
        roots = components(ends).withColumnRenamed("node", "comp")
        self.of = written(comp.join(roots, "comp", "left").select("doc", F.coalesce("root", "comp").alias("comp")))
        discard(comp, links)


def _common(n, m, percent: int):
    """Shingles that similar sets of ``n`` and ``m`` shingles have in common at least."""
    return -F.floor(-percent * (F.col(n) + F.col(m)) / (100 + percent))


def _star_pairs(entries: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each document with the leader of another component that it shares most shingles with."""
    chance = F.xxhash64("doc", F.lit(turn))
    rank = F.struct(F.col("held") if turn == 0 else chance, "doc", "comp", "n", "place")
    leaders = (
        entries.groupBy("token")
        .agg(F.max(rank).alias("leader"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low < high")
        .select("token", F.col("leader.doc").alias("y"), F.col("leader.comp").alias("other"), F.col("leader.n").alias("m"), F.col("leader.place").alias("at"))
    )
    common = _common("n", "m", percent)
    met = entries.join(
        leaders,
        (entries["token"] == leaders["token"])
        & (F.col("comp") != F.col("other"))
        & (F.col("place") <= F.col("n") - common + LEVELS)
        & (F.col("at") <= F.col("m") - common + LEVELS),
    ).select(F.col("doc").alias("x"), "y")
    shared = met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"))
    return shared.groupBy("x").agg(F.max(F.struct("shared", "y")).alias("best")).select("x", F.col("best.y").alias("y"))


def _unsettled(entries: DataFrame) -> DataFrame:
    """The entries of shingles that documents of several components share."""
    spans = entries.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return entries.join(spans.filter("low < high").select("token"), "token")


def _exchanged(blocks: DataFrame, owners: int) -> DataFrame:
    """Send the blocks' shingles to their owners; what two prefixes hold becomes rows. Written."""
    blocks = written(blocks)
    message = "owner long, block long, n long, k long, unary binary, rest binary, twice binary"
    answers = blocks.select("block", "tokens").mapInArrow(_messages(owners), message).groupBy("owner").applyInPandas(_answers, "block long, owner long, bits binary")
    schema = "token long, doc long, held long, n long, place long, level long"
    found = written(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_shared(owners), schema))
    discard(blocks)
    return found


def _all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Candidates of different components: the larger document probes with its l."""
    probe = entries.select("token", F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("place").alias("px"), "level", F.col("comp").alias("cx"))
    probe = probe.filter(F.col("px") <= F.col("nx") + F.floor(-percent * F.col("nx") / 100) + F.col("level"))
    index = entries.filter(F.col("place") <= F.col("n") - _common("n", "n", percent) + LEVELS).select("token", F.col("doc").alias("y"), F.col("n").alias("ny"), F.col("place").alias("py"), F.col("comp").alias("cy"))
    larger = (F.col("nx") > F.col("ny")) | (F.col("nx") == F.col("ny")) & (F.col("x") > F.col("y"))
    common = _common("nx", "ny", percent)
    near = (F.col("px") <= F.col("nx") - common + F.col("level")) & (F.col("py") <= F.col("ny") - common + F.col("level"))
    met = probe.join(index, (probe["token"] == index["token"]) & (F.col("cx") != F.col("cy")) & larger & near & (100 * F.col("ny") >= percent * F.col("nx")))
    counted = met.groupBy("x", "y", "nx", "ny").agg(F.countDistinct(probe["token"]).alias("shared"), F.min("level").alias("level"))
    return counted.filter("shared >= level").select("x", "y").distinct()


def similar_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = WORDS, percent: int = PERCENT, owners: int | None = None) -> DataFrame:
    """(id, hash, len, n_shingles, component_id) of every row of ``docs``.

    component_id: the smallest ID that links lead to, the row's own included.
    """
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = text_key(id_col, text_col)
    source = docs.select(key[0].cast("bigint").alias("id"), key[1], key[2], F.col(text_col).alias("text"))
    schema = "id long, hash long, len int, n long, d1 long, d2 long, chunk long, counts binary"
    first = written(source.mapInArrow(handing_back(_sets(words)), schema))
    sets = first.filter("chunk IS NULL").drop("chunk", "counts")
    chunks = first.filter("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk").applyInPandas(_sum_chunk, "chunk long, counts binary")
    sketch = np.zeros(SKETCH, np.int64)
    for row in chunks.collect():  # SKETCH counters, whatever the size of the corpus
        sketch[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.int64)
    sent = spark.sparkContext.broadcast(np.minimum(sketch, (1 << 31) - 1).astype(np.int32))

    known = sets.filter("n > 0 AND id IS NOT NULL")
    classes = written(known.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    member = written(known.join(classes, ["n", "d1", "d2"]).select("id", "hash", "len", "rep"))
    alone = source.filter(F.col("id").isNotNull())
    reps = without(alone, member.filter("id <> rep").select("id", "hash", "len"), "text", "id")

    blocks = reps.select("id", "text").mapInArrow(handing_back(_prefixes(sent, words, percent)), "block long, tokens binary, docs binary, sizes binary, info binary")
    kept = _exchanged(blocks, owners)
    sent.destroy()  # the prefixes are written
    entries, held = kept.withColumn("comp", F.col("doc")), kept
    alive = written(entries.select("doc").distinct())
    comps = _Components(alive)
    texts = written(_of_docs(reps.select(F.col("id").alias("doc"), "text"), alive, alive.count()))
    tested = None
    for turn in range(STAR_ROUNDS):
        pairs = _star_pairs(entries, percent, turn)
        pairs = written(pairs if tested is None else _untested(pairs, tested))
        if (n := pairs.count()) == 0:
            break
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = _links(pairs, n, texts, words, percent)
        few = 2 * links.count() < n
        comps.join(links)
        entries = entries.drop("comp").join(comps.of, "doc")
        if few:
            # Mostly pairs that are no links: what is left is cheaper to meet directly.
            break
        # Shingles whose documents are all of one component have no more to say.
        entries = written(_unsettled(entries))
        discard(held)
        held = entries
    rest = _all_pairs(entries, percent)
    rest = written(rest if tested is None else _untested(rest, tested))
    comps.join(_links(rest, rest.count(), texts, words, percent))

    # Documents that share an ID, or are equal, follow their representative; IDs are nodes.
    ties = comps.of.select(F.col("doc").alias("a"), F.col("comp").alias("b")).unionByName(member.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    roots = written(components(ties).withColumnRenamed("node", "id"))
    return sets.join(roots, "id", "left").select("id", "hash", "len", F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    both = tested.unionByName(tested.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    return pairs.join(both, ["x", "y"], "left_anti")


def _repeated(keys: DataFrame) -> DataFrame:
    """(id, low, high) of the IDs that several rows have, with the smallest and the largest of their texts. Written."""
    text = F.struct("hash", "len")
    texts = keys.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(text).alias("low"), F.max(text).alias("high"))
    return written(texts.filter("n > 1").drop("n"))


def _nodes(keys: DataFrame, repeated: DataFrame) -> DataFrame:
    """(id, hash, len, node) of the IDs that stand for several texts: a number below all IDs for each."""
    several = keys.join(repeated.filter("low < high").select("id"), "id").distinct()
    lowest = keys.agg(F.min("id")).scalar()
    return written(dense_position(written(several), ["id", "hash", "len"], "place").withColumn("node", lowest - 1 - F.col("place")).drop("place"))


def _others(told: DataFrame) -> DataFrame:
    """Of rows (own, component_id) the own (id, hash, len) that are not their component's smallest. Written."""
    stays = told.groupBy("component_id").agg(F.min("own").alias("stays"))
    return written(told.join(stays, "component_id").filter("own <> stays").select("own.*"))


def one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest ID.

    A node is an ID with its text (its hash and length): different texts under one ID are judged
    each by its own links; of those with the same smallest ID in a component the smaller (hash, length) stays.
    Rows without an ID stay. Of rows that repeat ID and text, one stays.
    """
    held = packed(docs, F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    key = text_key("_id", "_text")
    keys = held.select(*key).filter("id IS NOT NULL")
    repeated = _repeated(keys)
    if repeated.isEmpty():  # every ID is a node: no row has to be told apart
        found = written(similar_documents(held.select("_id", "_text"), "_text", "_id", **options))
        gone = _others(found.filter("id IS NOT NULL").select(F.struct("id", "hash", "len").alias("own"), "component_id"))
        return without(held, gone, "_text", "_id").select("row.*")
    nodes = _nodes(keys, repeated)
    bits = key_filter(nodes.select(F.xxhash64("id").alias("key")), "key")
    narrow = held.select("_id", "_text", key[1], key[2])
    certain = in_filter(narrow, F.xxhash64("_id"), bits, passing=False).select(F.col("_id").alias("_node"), "_text")
    maybe = in_filter(narrow, F.xxhash64("_id"), bits).withColumnRenamed("_id", "id").join(nodes, ["id", "hash", "len"], "left")
    numbered = certain.unionByName(maybe.select(F.coalesce("node", "id").alias("_node"), "_text"))
    found = written(similar_documents(numbered, "_text", "_node", **options))

    named = found.withColumnRenamed("id", "node").join(nodes.select("node", "id"), "node", "left")
    told = named.select(F.struct(F.coalesce("id", "node").alias("id"), "hash", "len").alias("own"), "component_id").filter("own.id IS NOT NULL")
    rows = without(held, _others(told), "_text", "_id")
    again = keys.groupBy("id", "hash", "len").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bits = key_filter(again.select(F.xxhash64("id").alias("key")), "key")
    single = in_filter(rows, F.xxhash64("_id"), bits, passing=False)
    maybe = in_filter(rows, F.xxhash64("_id"), bits).select("row", *text_key("_id", "_text"))
    one = maybe.filter("id IS NOT NULL").dropDuplicates(["id", "hash", "len"])
    return single.select("row").unionByName(maybe.filter("id IS NULL").select("row")).unionByName(one.select("row")).select("row.*")
