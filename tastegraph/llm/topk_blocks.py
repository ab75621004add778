"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are kept in shards of up to SHARD_ROWS rows: a forward index (the rows in order) cut into
blocks, and for every block the largest and smallest value of each component (the term maxima;
a negative query weight takes the smallest). For a query the blocks of a shard are ordered by
their summed maxima, an upper bound of any score in them, and scored until the bound falls
below the k-th best score so far. Ties go to the smaller ID, so a block whose bound equals that
score is still scored. Rows are dealt to blocks by their nearest pivot, then by ID, which makes
the bounds tighter; the result does not depend on it.

Components are turned into integers, floor(scale * x) in double precision, and scores are integer
inner products. Components and scores that do not fit a bigint raise an error. Vectors that are null
or hold a null or non-finite component take no part, nor do rows without ID. A query
is compared with vectors of its own length; all rows with its own ID are left out. If
query rows repeat an ID, the smallest vector asks; repeated candidates all count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.session import written

SHARD_ROWS, BLOCK_ROWS, PIVOTS = 16384, 128, 32
# Queries in a bundle that meets a shard in one task.
BUNDLE_ROWS = 4096


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(id, v array<bigint>) of the rows that take part."""
    product = lambda x: F.lit(scale) * x.cast("double")
    too_large = F.raise_error(F.lit("a scaled component does not fit a bigint")).cast("bigint")
    scaled = F.transform(vector_col, lambda x: F.when(F.abs(product(x)) < float(1 << 63), F.floor(product(x))).otherwise(too_large))
    usable = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return (
        vectors.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull())
        .filter(usable)
        .select(F.col(id_col).cast("bigint").alias("id"), scaled.alias("v"))
    )


def _packed(most: int):
    """Rows (id, v) of a task -> rows (shard, dim, ids, data) of up to ``most`` vectors of one length."""

    def run(batches):
        part, number = TaskContext.get().partitionId() << 24, 0
        held: dict[int, list] = {}

        def shard(dim):
            nonlocal number
            ids, rows = held.pop(dim)
            number += 1
            data = np.concatenate(rows).astype("<i8").tobytes()
            row = pd.DataFrame({"shard": [part + number], "dim": [dim], "ids": [np.concatenate(ids).astype("<i8").tobytes()], "data": [data]})
            return pa.RecordBatch.from_pandas(row.astype({"shard": "int64", "dim": "int64"}), preserve_index=False)

        for batch in batches:
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            ids = batch.column(0).to_numpy()
            for dim in np.unique(lengths):
                mine = np.flatnonzero(lengths == dim)
                for a in range(0, len(mine), most):
                    some = mine[a : a + most]
                    rows = flat[(ends[some] - dim)[:, None] + np.arange(dim)]
                    own = held.setdefault(int(dim), [[], []])
                    own[0].append(ids[some])
                    own[1].append(rows)
                    if sum(map(len, own[0])) >= most:
                        yield shard(int(dim))
        for dim in list(held):
            yield shard(dim)

    return run


PACKED = "shard long, dim long, ids binary, data binary"


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: through doubles where they are exact, Python's where 64 bits are short."""
    most = np.abs(a.astype(float)).max() * np.abs(b.astype(float)).max() * a.shape[1] if a.size and b.size else 0.0
    if most < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if most < 2.0**62 else a.astype(object) @ b.T.astype(object)


class BlockIndex:
    """Forward index of a shard in blocks, with the bounds of each block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        near = _product(rows, rows[:PIVOTS]).argmax(axis=1) if rows.shape[1] else np.zeros(len(ids))
        order = np.lexsort((ids, near))
        self.ids, self.rows = ids[order], rows[order]
        starts = np.arange(0, len(ids), BLOCK_ROWS)
        self.high = np.maximum.reduceat(self.rows, starts, axis=0)
        self.low = np.minimum.reduceat(self.rows, starts, axis=0)
        self.scored = 0  # blocks looked into, for tests

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return _product(np.maximum(queries, 0), self.high) + _product(np.minimum(queries, 0), self.low)

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) without rows of the query's own ID."""
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for block in np.argsort(-bounds, kind="stable"):
            if len(scores) == k and bounds[block] < scores[-1]:
                break
            self.scored += 1
            part = slice(block * BLOCK_ROWS, (block + 1) * BLOCK_ROWS)
            more = _product(self.rows[part], query[None, :])[:, 0]
            if more.dtype == object:
                if max(map(abs, more)) >= 1 << 63:
                    raise OverflowError("an inner product does not fit a bigint")
                more = more.astype(np.int64)
            keep = self.ids[part] != query_id
            if len(scores) == k:
                keep &= more >= scores[-1]
            ids, scores = np.concatenate([ids, self.ids[part][keep]]), np.concatenate([scores, more[keep]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores


def _search(k: int):
    def run(pairs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pair in pairs.itertuples():
            ids, asked = np.frombuffer(pair.ids, "<i8"), np.frombuffer(pair.asked, "<i8")
            index = BlockIndex(ids, np.frombuffer(pair.data, "<i8").reshape(len(ids), pair.dim))
            queries = np.frombuffer(pair.queries, "<i8").reshape(len(asked), pair.dim)
            bounds = index.bounds(queries)
            for query_id, query, bound in zip(asked, queries, bounds):
                found, scores = index.search(query_id, query, bound, k)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": found, "score": scores}))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(out, ignore_index=True)

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row of ``queries``.

    Every shard meets every bundle of queries, in a task of its own; the k best of each shard
    and query are then merged, cut to k in every task first.
    """
    shards = written(integer_vectors(vectors, id_col, vector_col).mapInArrow(_packed(SHARD_ROWS), PACKED))
    asking = integer_vectors(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    bundles = written(asking.mapInArrow(_packed(BUNDLE_ROWS), PACKED)).select(
        F.col("shard").alias("bundle"), F.col("dim").alias("asked_dim"), F.col("ids").alias("asked"), F.col("data").alias("queries")
    )
    # Numbers of the bundles: one for BUNDLE_ROWS queries and task.
    numbers = [r.bundle for r in bundles.select("bundle").collect()]
    if not numbers:
        numbers = [-1]
    each = shards.withColumn("bundle", F.explode(F.array(*[F.lit(n).cast("bigint") for n in numbers])))
    pairs = each.join(bundles, (each["bundle"] == bundles["bundle"]) & (each["dim"] == bundles["asked_dim"])).drop(bundles["bundle"])
    best = pairs.groupBy("shard", "bundle").applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
