"""Tables from logs, attributes and histories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.ordering import dense_position, position_in_group
from tastegraph.functions.unseen import expand_ranges, unseen_ranges
from tastegraph.session import written

LOG_SEGMENT = 10_000


def union_by_name(frames: Sequence[DataFrame], newest_first: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Stack frames (columns a frame lacks become NULL), latest first, chosen columns."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.orderBy(*[F.col(c).desc() for c in newest_first]).select(*columns)


def number_transactions(
    df: DataFrame, user: str, order: Sequence[str], block: Column, out: str = "transaction_num"
) -> DataFrame:
    """Running number from 1 per user; ``block`` (a day, say) must follow the order."""
    placed = position_in_group(df, [user], block, [F.col(c) for c in order], out)
    return placed.withColumn(out, (F.col(out) + 1).cast("bigint"))


def collect_interaction_log(
    df: DataFrame, user: str, fields: Sequence[str], number: str = "transaction_num",
    segment_rows: int = LOG_SEGMENT,
) -> DataFrame:
    """Flat log -> ordered arrays of structs.

    A user's log is one row per ``segment_rows`` interactions (one row for most users),
    so no row or task has to hold an arbitrarily long history.
    """
    segment = F.floor((F.col(number) - 1) / segment_rows)
    entry = F.struct(number, *fields)
    return (
        df.groupBy(user, segment.alias("segment"))
        .agg(F.array_sort(F.collect_list(entry)).alias("log"))
        .withColumn("log", F.transform("log", lambda e: F.struct(*[e[f].alias(f) for f in fields])))
    )


def explode_interaction_log(
    users: DataFrame, user: str, fields: Sequence[str], segment_rows: int = LOG_SEGMENT,
    number: str = "transaction_num",
) -> DataFrame:
    """Nested log -> one row per interaction, numbered from 1; empty logs give no row."""
    start = F.col("segment") * segment_rows if "segment" in users.columns else F.lit(0)
    rows = users.select(user, start.alias("_start"), F.posexplode("log").alias("_pos", "_entry"))
    return rows.select(
        user,
        (F.col("_start") + F.col("_pos") + 1).cast("bigint").alias(number),
        *[F.col(f"_entry.{f}").alias(f) for f in fields],
    )


def project_attributes(df: DataFrame, key: str, attrs: Sequence[str], attr_map: str) -> DataFrame:
    """Attribute map -> one column per attribute."""
    return df.select(key, *[F.col(attr_map)[a].alias(a) for a in attrs])


def pivot_attributes(df: DataFrame, key: str, attrs: Sequence[str], attr: str = "attr", val: str = "val") -> DataFrame:
    """Long attribute rows -> one column per attribute."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col(attr) == a, F.col(val))).alias(a) for a in attrs])


def melt_attributes(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """One column per attribute -> long rows (key, attr, val)."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("val")) for a in attrs])
    return df.select(key, F.explode(pairs).alias("_p")).select(key, "_p.attr", "_p.val")


def fill_concat_text(df: DataFrame, columns: Sequence[str], out: str = "all_product_text") -> DataFrame:
    """Join text columns with single blanks, NULL counting as ''."""
    return df.withColumn(out, F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def add_example_id(df: DataFrame, keys: Sequence[str], out: str = "example_id", digits: int = 3) -> DataFrame:
    """Dense row number 0..n-1; ``keys`` must name a row. ``digits`` as in ``dense_position``."""
    return dense_position(df, keys, out, digits)


def dense_index(df: DataFrame, column: str, out: str = "idx", digits: int = 3) -> DataFrame:
    """Distinct values of a column with indices 0..n-1 (the lookup both ways)."""
    return dense_position(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], out, digits)


def apply_index(
    df: DataFrame, index: DataFrame, column: str, out: str = "idx", on_unseen: str = "null"
) -> DataFrame:
    """Look up indices; a value without one is NULL, or stops the job with ``on_unseen='error'``."""
    joined = df.join(index.select(column, out), column, "left")
    if on_unseen == "error":
        message = F.concat(F.lit(f"value of {column} not in the index: "), F.col(column).cast("string"))
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.raise_error(message).cast("bigint")))
    elif on_unseen != "null":
        raise ValueError("on_unseen is 'null' or 'error'")
    return joined


def one_hot_encoder(train: DataFrame, columns: Sequence[str], out: str = "one_hot"):
    """(function that adds the one-hot vector to a frame, slot names), fitted on ``train`` once."""
    indexed = [f"_ix_{c}" for c in columns]
    hot = [f"_oh_{c}" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(train)
    # "keep" puts unknown values into a last extra slot, which dropLast then removes.
    encoder = OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True).fit(indexer.transform(train))
    names = [f"{c}_{label}" for c, labels in zip(columns, indexer.labelsArray) for label in labels]

    def encode(df: DataFrame) -> DataFrame:
        coded = encoder.transform(indexer.transform(df))
        return VectorAssembler(inputCols=hot, outputCol=out).transform(coded).drop(*indexed, *hot)

    return encode, names


def one_hot_encode(train: DataFrame, df: DataFrame, columns: Sequence[str], out: str = "one_hot"):
    """Add a sparse one-hot vector; categories come from ``train``, sorted per column.

    Returns (frame, slot names ``<column>_<category>``). A category that ``train``
    lacks gets all zeros. Meant for attributes: the category list lives on the driver.
    """
    encode, names = one_hot_encoder(train, columns, out)
    return encode(df), names


def one_hot_rows(df: DataFrame, key: str, names: Sequence[str], vector: str = "one_hot") -> DataFrame:
    """One-hot vectors as long rows (key, feature) for the slots that are 1."""
    labels = F.array(*[F.lit(n) for n in names])
    slots = df.select(key, F.posexplode(vector_to_array(vector)).alias("_slot", "_on")).filter("_on = 1")
    return slots.select(key, labels[F.col("_slot")].alias("feature"))


def attach_attributes(df: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Left join of user or item attributes; Catalyst broadcasts the table if it is small."""
    return df.join(attributes, key, "left")


def left_join_flag(df: DataFrame, marks: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """1 where the row's key is among the marks, else 0."""
    marked = marks.select(*keys).distinct().withColumn(flag, F.lit(1))
    return df.join(marked, list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)).cast("int"))


def join_partition_label(
    df: DataFrame, labels: DataFrame, keys: Sequence[str], label: str = "model_data_partition", default: str = "train"
) -> DataFrame:
    """Attach split labels; rows the label table does not name get ``default``."""
    joined = df.join(labels.select(*keys, label), list(keys), "left")
    return joined.withColumn(label, F.coalesce(F.col(label), F.lit(default)))


def candidate_items(users: DataFrame, items: DataFrame, seen: DataFrame, user: str, item: str) -> DataFrame:
    """Every (user, item) the user has not had.

    The complement of each history comes from the gaps in the dense item index, so no
    user x item product is joined and nothing is anti-joined.
    """
    index = written(dense_index(items, item, "_item_idx"))
    history = written(seen.select(user, item).distinct().join(index, item).select(user, "_item_idx"))
    n_items = index.agg(F.count("*")).scalar()
    ranges = unseen_ranges(users, history, user, "_item_idx", n_items)
    return expand_ranges(ranges, "_item_idx").join(index, "_item_idx").select(user, item)


def attach_context(df: DataFrame, context: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of a one-row context on every row."""
    return df.withColumns({c: context.select(c).scalar() for c in columns})


def basket_sets(users: DataFrame, interactions: DataFrame, user: str, item: str, keep: Column) -> DataFrame:
    """Sorted set of the items that pass ``keep``; users without any have an empty set."""
    sets = interactions.filter(keep).groupBy(user).agg(F.array_sort(F.collect_set(item)).alias("items"))
    empty = F.array().cast(f"array<{interactions.schema[item].dataType.simpleString()}>")
    return (
        users.select(user).distinct().join(sets, user, "left").withColumn("items", F.coalesce(F.col("items"), empty))
    )


def basket_matrix(
    users: DataFrame, interactions: DataFrame, user: str, item: str, items: Sequence, keep: Column, prefix: str = "item_"
) -> DataFrame:
    """User x item 0/1 frame for an explicit list of items, however long."""
    has = [F.max(F.when(F.col(item) == i, 1).otherwise(0)).alias(f"{prefix}{i}") for i in items]
    wide = interactions.filter(keep).groupBy(user).agg(*has)
    return users.select(user).distinct().join(wide, user, "left").fillna(0)


def drop_inactive_users(users: DataFrame, interactions: DataFrame, user: str) -> tuple[DataFrame, DataFrame]:
    """(users with an interaction, one-row frame ``n_dropped``)."""
    active = interactions.select(user).distinct()
    dropped = users.join(active, user, "left_anti").agg(F.count("*").alias("n_dropped"))
    return users.join(active, user, "left_semi"), dropped


def restrict_to_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def grid_bucket_lookup(df: DataFrame, cells: DataFrame, x: str, y: str, width: int = 25) -> DataFrame:
    """Value of the grid cell that two features fall into."""
    placed = df.withColumn("qx", F.floor(F.col(x) / width).cast("int")).withColumn(
        "qy", F.floor(F.col(y) / width).cast("int")
    )
    return placed.join(cells, ["qx", "qy"], "left")


def category_range_stats(df: DataFrame, category: str, number: str) -> DataFrame:
    return df.groupBy(category).agg(F.min(number).alias("low"), F.max(number).alias("high"))


def user_response_rate(df: DataFrame, user: str, response: str, alpha: float = 0.0, prior: float = 0.5) -> DataFrame:
    """Mean response per user, pulled towards ``prior`` with weight ``alpha`` (0: plain mean)."""
    total = F.sum(F.col(response).cast("double"))
    n = F.count("*")
    rate = (total + F.lit(alpha * prior)) / (n + F.lit(float(alpha)))
    return df.groupBy(user).agg(n.alias("n_obs"), rate.alias("rate"))
