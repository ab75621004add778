"""Column expressions: seeded uniforms, vector arithmetic, normalised order keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hexadecimal digits are 52 bits: the integer is exact in a DOUBLE.
_UNIFORM_DIGITS = 13
_UNIFORM_RANGE = float(16**_UNIFORM_DIGITS)


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_digest(*keys: str | Column) -> Column:
    """md5 of the keys joined by '|': a well spread text key that any engine can repeat."""
    return F.md5(F.concat_ws("|", *[as_col(k).cast("string") for k in keys]))


def seeded_uniform(seed: int | str, *keys: str | Column) -> Column:
    """Uniform number in [0, 1) that depends only on the seed and the row's keys.

    Unlike ``rand(seed)`` it does not change with the partitioning or when a lost
    task is run again.
    """
    digest = key_digest(F.lit(str(seed)), *keys)
    return F.conv(F.substring(digest, 1, _UNIFORM_DIGITS), 16, 10).cast("double") / F.lit(_UNIFORM_RANGE)


# Half rounds of the permutation, an even number, and how often it is repeated at most.
PERMUTATION_ROUNDS, PERMUTATION_WALKS = 6, 64


def keyed_permutation(place: Column, size: Column, seed: int | str, *keys: str | Column) -> Column:
    """Where ``place`` (0..size-1) goes in a random order of 0..size-1 that belongs to the seed and keys.

    A Feistel network on a x b numbers, a = ceil(sqrt(size)), b = ceil(size / a): a number is (l, r) with
    l = number div b, and in turn l moves by a seeded draw that depends on r, and r by one that depends on l.
    Numbers of ``size`` or more are sent through again; fewer than a of them exist, so an order of any
    size needs no sort and no table. An orbit is followed PERMUTATION_WALKS steps, which covers
    every size below PERMUTATION_WALKS ** 2 for certain; above, a longer orbit has a chance of
    less than 64 ** -64, and the result is NULL.
    """
    a = F.ceil(F.sqrt(size.cast("double"))).cast("bigint")
    b = F.ceil(size / a).cast("bigint")

    def half_round(state, number):
        span = F.when(number % 2 == 0, a).otherwise(b)
        move = F.floor(seeded_uniform(seed, *keys, number, state["r"]) * span).cast("bigint")
        return F.struct(state["r"].alias("l"), ((state["l"] + move) % span).alias("r"))

    def once(x):
        start = F.struct(F.floor(x / b).cast("bigint").alias("l"), (x % b).alias("r"))
        numbers = F.sequence(F.lit(0), F.lit(PERMUTATION_ROUNDS - 1))
        return F.aggregate(numbers, start, half_round, lambda state: state["l"] * b + state["r"])

    walks = F.sequence(F.lit(0).cast("bigint"), F.least(a * b - size, F.lit(PERMUTATION_WALKS - 1)))
    end = F.aggregate(walks, place.cast("bigint"), lambda x, step: F.when((step > 0) & (x < size), x).otherwise(once(x)))
    return F.when(end < size, end)


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: str | Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine of two arrays; NULL where one has length zero."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms)


def sigmoid(x: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_col(x)))
