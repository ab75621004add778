"""Seeded samples and train / validate / test partitions.

Every draw is a function of a seed and the row's key, so a repeated task or another
partitioning gives the same sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.columns import key_digest, seeded_uniform
from tastegraph.functions.ordering import first_k, position_in_group
from tastegraph.functions.skew import attach_stats
from tastegraph.functions.unseen import pick_unseen, unseen_ranges
from tastegraph.session import written
from tastegraph.operators.shaping import add_example_id, dense_index, join_partition_label


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int, out: str = "row_pos", digits: int = 3) -> DataFrame:
    """Random order of whole rows, as a dense position to sort by; ``digits`` as in ``dense_position``."""
    digest = key_digest(F.lit(str(seed)), *keys)
    return position_in_group(df, [], F.substring(digest, 1, digits), [digest, *[F.col(k) for k in keys]], out)


def bernoulli_sample(df: DataFrame, probability: str, keys: Sequence[str], seed: int, out: str = "bought") -> DataFrame:
    """1 where the row's uniform is below the row's own probability, else 0."""
    return df.withColumn(out, (seeded_uniform(seed, *keys) < F.col(probability)).cast("int"))


def group_sample_k(
    df: DataFrame, group: str, keys: Sequence[str], min_k: int, max_k: int, seed: int
) -> DataFrame:
    """k rows per group without replacement, k uniform in min_k..max_k per group."""
    drawn = first_k(
        df.withColumn("_u", seeded_uniform(seed, group, *keys)), [group],
        [F.col("_u"), *[F.col(k) for k in keys]], max_k, "_draw",
    )
    size = F.floor(F.lit(min_k) + seeded_uniform(f"{seed}-k", group) * F.lit(max_k - min_k + 1))
    return drawn.filter(F.col("_draw") <= size).drop("_draw", "_u")


def random_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows drawn at random, the queries of the similarity examples."""
    return df.orderBy(seeded_uniform(seed, *keys), *keys).limit(n)


def negative_sample(
    positives: DataFrame, items: DataFrame, user: str, item: str, keys: Sequence[str], seed: int
) -> DataFrame:
    """For each positive row one uniform item the user never bought; context kept.

    ``keys`` name a positive row. Draws are independent, so an item may repeat. A user
    who bought every item gives no row. ``positives`` is read four times.
    """
    index = written(dense_index(items, item, "_item_idx"))
    history = written(positives.select(user, item).distinct().join(index, item).select(user, "_item_idx"))
    n_items = index.agg(F.count("*")).scalar()
    n_bought = history.groupBy(user).agg(F.count("*").alias("_n_bought"))
    # how often a user occurs among the rows, not among the distinct items, makes it hot
    per_user = positives.groupBy(user).agg(F.count("*").alias("_n_rows")).join(n_bought, user)
    draws = (
        attach_stats(positives.withColumn("_u", seeded_uniform(seed, *keys)).drop(item), per_user, user, "_n_rows")
        .withColumn("_nth", F.floor(F.col("_u") * (n_items - F.col("_n_bought"))).cast("bigint"))
        .filter(n_items > F.col("_n_bought"))
        .drop("_u", "_n_bought", "_n_rows")
    )
    ranges = written(unseen_ranges(n_bought, history, user, "_item_idx", n_items))
    picked = pick_unseen(written(draws), ranges, user, "_nth", "_item_idx")
    return picked.join(index, "_item_idx").drop("_item_idx", "_nth")


def training_examples(
    positives: DataFrame, items: DataFrame, user: str, item: str, context: Sequence[str], keys: Sequence[str], seed: int
) -> DataFrame:
    """Positives (bought = 1) and as many negatives (0) in the same contexts, with an example ID."""
    pos_id = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    columns = [user, item, *context, "_src"]
    based = written(positives.withColumn("_src", pos_id).select(*dict.fromkeys([*columns, *keys])))
    negatives = negative_sample(based, items, user, item, keys, seed).select(*columns).withColumn("bought", F.lit(0))
    rows = based.select(*columns).withColumn("bought", F.lit(1)).unionByName(negatives)
    return add_example_id(written(rows), ["_src", "bought"]).drop("_src")


def _random_firsts(df: DataFrame, user: str, keys: Sequence[str], seed: int, k: int) -> DataFrame:
    """The k rows of each user with the smallest uniforms, with their place and the user's row count."""
    drawn = first_k(
        df.select(user, *keys).withColumn("_u", seeded_uniform(seed, user, *keys)), [user],
        [F.col("_u"), *[F.col(k_) for k_ in keys]], k, "_draw",
    )
    return drawn.join(df.groupBy(user).agg(F.count("*").alias("_n")), user)


def _label_rows(df: DataFrame, firsts: DataFrame, user: str, keys: Sequence[str], label: Column) -> DataFrame:
    marked = firsts.withColumn("model_data_partition", label).filter("model_data_partition IS NOT NULL")
    return join_partition_label(df, marked, [user, *keys])


def split_train_validate_test(df: DataFrame, user: str, keys: Sequence[str], seed: int) -> DataFrame:
    """Per user one test row, one validate row, the rest train.

    A user with one row gets test or validate by chance. Only the picked rows are
    labelled before the join on the whole row key, so no user is gathered in one task.
    """
    firsts = _random_firsts(df, user, keys, seed, 2)
    single = F.when(seeded_uniform(f"{seed}-single", user) < 0.5, "test").otherwise("validate")
    label = F.when(F.col("_n") == 1, single).when(F.col("_draw") == 1, "test").otherwise("validate")
    return _label_rows(df, firsts, user, keys, label)


def split_leave_one_out(df: DataFrame, user: str, keys: Sequence[str], seed: int) -> DataFrame:
    """Per user one validate row, the rest train; a user with one row is all train."""
    firsts = _random_firsts(df, user, keys, seed, 1)
    return _label_rows(df, firsts, user, keys, F.when(F.col("_n") > 1, "validate"))
