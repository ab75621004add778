"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions.skew import HOT_SHARE

# Most bits of the broadcast filter of ``passing``: 2**26 bits are 2048 bitmaps of 4 KB, 8 MB in
# all, whatever the number of keys.
FILTER_BITS = 1 << 26
# Bits for each key where the keys are counted first: of other rows one in so many passes at most.
BITS_A_KEY = 256
BITMAP_BITS = 1 << 15


# Most bytes of rows that go to a Python worker in one batch.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; batches for Python workers are bounded by bytes from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def handing_back(run):
    """``run`` (a function of ``mapInArrow``) that gives memory back to the system when its task ends.

    Python workers outlive their tasks: what one operator freed would otherwise stay with them.
    """

    def all_batches(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return all_batches


def fold_ascii(text: Column) -> Column:
    """Lower case of A-Z only; null stays null."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc32_mod(key: str, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def filter_bits(keys: int) -> int:
    """Bits of a filter of so many keys: the driver holds every broadcast several times over."""
    return min(FILTER_BITS, max(BITMAP_BITS, 1 << (BITS_A_KEY * keys - 1).bit_length()))


def key_filter(keys: DataFrame, key: str, bits: int | None = None) -> DataFrame:
    """``keys`` (hashes, bigint) folded into bitmaps of ``bits`` bits in all, default FILTER_BITS.

    They are small enough to broadcast whatever the number of keys.
    """
    bit = F.pmod(F.col(key), F.lit(bits or FILTER_BITS))
    return (
        keys.filter(F.col(key).isNotNull())
        .select(F.bitmap_bucket_number(bit).alias("_bucket"), F.bitmap_bit_position(bit).alias("_place"))
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_place").alias("_bitmap"))
    )


def in_filter(rows: DataFrame, key: Column, bitmaps: DataFrame, passing: bool = True, bits: int | None = None) -> DataFrame:
    """Rows whose ``key`` (a hash, bigint) is perhaps among those of ``key_filter`` with the same ``bits``.

    A few other rows pass, so an exact step has to follow; it saves shuffling whole texts of
    rows that cannot be meant. ``passing=False``: the other rows, all of which are certain.
    """
    mine = F.pmod(key, F.lit(bits or FILTER_BITS))
    place = F.bitmap_bit_position(mine)
    byte = F.conv(F.hex(F.substring("_bitmap", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))
    joined = rows.withColumn("_bucket", F.bitmap_bucket_number(mine)).join(F.broadcast(bitmaps), "_bucket", "inner" if passing else "left")
    return joined.filter(is_set if passing else ~is_set).select(rows.columns)


def attach_left(rows: DataFrame, stats: DataFrame, key: str, n: str) -> DataFrame:
    """Left join of ``stats``, one row per ``key`` with ``n`` rows of it in ``rows``.

    A key with more than 1/HOT_SHARE of what ``n`` sums up to is broadcast, which fewer than
    HOT_SHARE keys can be; only rows of other keys are shuffled.
    """
    total = stats.agg(F.sum(n)).head()[0] or 0
    is_hot = F.col(n) * F.lit(HOT_SHARE) > F.lit(total)
    hot, cold = stats.filter(is_hot), stats.filter(~is_hot)
    held = [c for c in stats.columns if c != key]
    first = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    found = first.filter(F.col("_hot")).drop("_hot")
    rest = first.filter(F.col("_hot").isNull()).drop("_hot", *held).join(cold, key, "left")
    return found.unionByName(rest)


def text_key(id_col: str, text_col: str) -> list[Column]:
    """What a row is known by where its text does not travel: ID, hash and length of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("len")]


def packed(rows: DataFrame, *more: Column) -> DataFrame:
    """Whole rows in one column ``row`` beside ``more``: their column names cannot clash with ours."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *more)


def without(rows: DataFrame, dropped: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``rows`` less those whose ``text_key`` is in ``dropped`` (id, hash, len), a written table.

    Rows that are certainly not meant stay where they are; only the rest is joined.
    """
    held = packed(rows, *text_key(id_col, text_col))
    size = filter_bits(dropped.count())
    bits = key_filter(dropped, "hash", size)
    certain = in_filter(held, F.col("hash"), bits, passing=False, bits=size)
    maybe = in_filter(held, F.col("hash"), bits, bits=size)
    gone = dropped.select("id", "hash", "len").distinct().withColumn("gone", F.lit(True))
    same = [maybe[n].eqNullSafe(gone[n]) for n in ("id", "hash", "len")]
    # No anti join: the optimizer would move it below the filter and shuffle every text.
    left = maybe.join(gone, same[0] & same[1] & same[2], "left").filter(F.col("gone").isNull()).select("row")
    return certain.select("row").unionByName(left).select("row.*")
