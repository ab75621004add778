"""Joining per-key figures to rows whose keys are unevenly used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.session import written

# A key with more than 1/HOT_SHARE of all rows is hot; fewer than HOT_SHARE keys can be.
HOT_SHARE = 1000
# Rows of one key on one side that a lot of ``join_in_lots`` holds, on average.
LOT_ROWS = 1000


def shares(rows: DataFrame, key: str, size: int) -> list[Column]:
    """Conditions that part rows by their ``key`` into shares of about ``size`` rows; every row, also one without key, meets one."""
    n = max(1, -(-rows.count() // size))
    return [F.pmod(F.xxhash64(key), F.lit(n)) == r for r in range(n)]


def attach_stats(rows: DataFrame, stats: DataFrame, key: str, n: str) -> DataFrame:
    """Inner join of ``stats`` (one row per key, ``n`` = how often the key occurs in ``rows``).

    The fewer than HOT_SHARE hot keys are broadcast, so their rows stay where they are;
    only rows of ordinary keys are shuffled. ``rows`` and ``stats`` are read twice.
    """
    total = stats.agg(F.sum(n)).scalar()
    is_hot = F.col(n) * F.lit(HOT_SHARE) > total
    hot = stats.filter(is_hot)
    cold = stats.filter(~is_hot)
    rows_hot = rows.join(F.broadcast(hot), key)
    rows_cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rows_hot.unionByName(rows_cold)


def join_in_lots(left: DataFrame, right: DataFrame, key: str, deal_left: str, deal_right: str) -> DataFrame:
    """Inner join on a key that may be frequent on both sides at once.

    Each side's rows of a key are dealt over lots of about LOT_ROWS by the hash of a column
    (``deal_left``, ``deal_right``), and every lot of one side meets every lot of the other: a cell
    (key, lot, lot) makes some LOT_ROWS ** 2 rows at most, however frequent the key is. A row is copied
    once for each lot of the other side, so copies are fewer than joined rows by a factor of LOT_ROWS.
    Both sides are read three times. The sides share no column but ``key``; NULL keys meet nothing.
    """
    sizes = left.groupBy(key).agg(F.count("*").alias("_n_left")).join(right.groupBy(key).agg(F.count("*").alias("_n_right")), key)
    sizes = written(sizes)
    lots = lambda n: F.ceil(F.col(n) / F.lit(LOT_ROWS)).cast("bigint")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), lots(n) - 1))
    own = lambda column, n: F.pmod(F.xxhash64(column), lots(n))
    dealt_left = attach_stats(left, sizes, key, "_n_left").select(
        *left.columns, own(deal_left, "_n_left").alias("_lot_left"), every("_n_right").alias("_lot_right")
    )
    dealt_right = attach_stats(right, sizes, key, "_n_right").select(
        *right.columns, every("_n_left").alias("_lot_left"), own(deal_right, "_n_right").alias("_lot_right")
    )
    return dealt_left.join(dealt_right, [key, "_lot_left", "_lot_right"]).drop("_lot_left", "_lot_right")
