"""Positions, running totals and carried values without one task per group.

A plain ``Window.partitionBy(user)`` sorts a whole user in one task, and a window
without keys sorts the whole table in one. Both are replaced by two levels: rows are
cut into *blocks* that follow the wanted order, the window runs inside (group, block),
and the totals of the blocks before are added from a table with one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions.columns import as_col, key_digest

BLOCK = 4096


def _group_window(group: Sequence[str]):
    return Window.partitionBy(*group) if group else Window.partitionBy()


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    block: Column,
    order: Sequence[Column],
    measures: dict[str, Column],
) -> DataFrame:
    """Add, per measure, its sum over the rows before this one in the group's order.

    ``block`` must not decrease along ``order`` inside a group, and the order must
    name a row (tied rows are interchangeable). NULL in a group column or as block is a
    value of its own, so no row is lost.
    """
    group = list(group)
    keys = [*group, "_block"]
    blocked = df.withColumn("_block", block)
    for name, value in measures.items():
        blocked = blocked.withColumn(f"_m_{name}", value)

    totals = blocked.groupBy(*keys).agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures])
    before_block = _group_window(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_t_{n}").over(before_block), F.lit(0)).alias(f"_o_{n}") for n in measures]
    )

    before_row = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = blocked
    for name in measures:
        inside = inside.withColumn(f"_i_{name}", F.coalesce(F.sum(f"_m_{name}").over(before_row), F.lit(0)))
    renamed = offsets.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [inside[k].eqNullSafe(renamed[f"_k{i}"]) for i, k in enumerate(keys)])
    return inside.join(renamed, same).select(
        *[inside[c] for c in df.columns], *[(F.col(f"_i_{n}") + F.col(f"_o_{n}")).alias(n) for n in measures]
    )


def position_in_group(
    df: DataFrame, group: Sequence[str], block: Column, order: Sequence[Column], out: str
) -> DataFrame:
    """0-based place of each row in its group's order."""
    return running_totals(df, group, block, order, {out: F.lit(1).cast("bigint")})


def dense_position(df: DataFrame, keys: Sequence[str], out: str, digits: int = 3) -> DataFrame:
    """0..n-1 over all rows, in the order of the md5 of ``keys``.

    The first ``digits`` hexadecimal digits are the block, so rows spread evenly over
    16**digits sorts whatever the keys are. One digit more for every 16 times the rows
    keeps a sort at the same size; three serve some 10**9 rows.
    """
    digest = key_digest(*keys)
    return position_in_group(
        df, [], F.substring(digest, 1, digits), [digest, *[F.col(k) for k in keys]], out
    )


def quantile_blocks(df: DataFrame, value: str, out: str = "_q", n_blocks: int = 256) -> DataFrame:
    """Add the block number of ``value`` by approximate quantiles of its values in ``df``.

    The cut points (fewer than ``n_blocks`` numbers) are fixed here, so every use of the
    frame and every repeated task sees the same ones; each row is placed by binary search.
    NaN, which sorts above all numbers, and NULL share the last block.
    """
    number = F.col(value).cast("double")
    cuts = df.agg(F.percentile_approx(F.nanvl(number, F.lit(None).cast("double")), [i / n_blocks for i in range(1, n_blocks)], 10 * n_blocks)).first()[0]
    splits = [float("-inf"), *sorted({float(c) for c in cuts or [0.0]}), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_value", outputCol=out, handleInvalid="keep")
    placed = bucketizer.transform(df.withColumn("_value", F.coalesce(number, F.lit(float("nan")))))
    return placed.drop("_value")


def carry_forward(
    points: DataFrame, marks: DataFrame, group: Sequence[str], at: str, mark_at: str, carried: Sequence[str],
    block_size: int = BLOCK,
) -> DataFrame:
    """For each point the last mark of its group with ``mark_at <= at`` (an as-of lookup).

    Positions are whole numbers from 0; ``block_size`` of them share a block. Marks of
    earlier blocks arrive through one carried row per (group, block).
    """
    group = list(group)
    keys = [*group, "_block"]
    mark = F.struct(F.col(mark_at).alias("_at"), *[F.col(c) for c in carried])
    as_marks = marks.select(*group, F.col(mark_at).alias("_pos"), F.lit(0).alias("_kind"), mark.alias("_mark"))
    as_points = points.select(*group, F.col(at).alias("_pos"), F.lit(1).alias("_kind")).withColumn(
        "_mark", F.lit(None).cast(as_marks.schema["_mark"].dataType)
    )
    rows = as_marks.unionByName(as_points).withColumn("_block", F.floor(F.col("_pos") / block_size))

    last_in_block = rows.groupBy(*keys).agg(F.max("_mark").alias("_last"))
    earlier = _group_window(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried_in = last_in_block.select(*keys, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))

    upto = Window.partitionBy(*keys).orderBy("_pos", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_near", F.last("_mark", ignorenulls=True).over(upto)).filter("_kind = 1")
    found = inside.join(carried_in, keys).withColumn("_hit", F.coalesce("_near", "_carried"))
    return found.select(
        *group,
        F.col("_pos").alias(at),
        F.col("_hit._at").alias(mark_at),
        *[F.col(f"_hit.{c}").alias(c) for c in carried],
    )


def first_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """Best ``k`` rows per group.

    Catalyst cuts every task's share to ``k`` rows per group before the shuffle
    (WindowGroupLimit), so a group holding a large share of the table stays small.
    """
    place = F.row_number().over(_group_window(list(group)).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= F.lit(int(k)))
