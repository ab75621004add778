"""Affinity of users to items from attribute preferences, with ordered context adjustments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.ordering import BLOCK

# A preference score counts towards a maximum of 10 per attribute,
# scores themselves are 0..9.
MAX_SCORE_PER_ATTRIBUTE = 10
SCORE_RANGE = (0, 9)
# Modifiers of one (user, attribute, value) that are folded to a table, not kept as a list.
FOLD_CHUNK = 256


def _scaled(raw: Column, n_attrs: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + raw * F.lit(float(hi) - float(lo)) / (F.lit(MAX_SCORE_PER_ATTRIBUTE) * n_attrs)


def attribute_scores(pairs: DataFrame, prefs: DataFrame, item_attrs: DataFrame, scores: list[str]) -> DataFrame:
    """One row per (user, item, attr) with the user's scores for the item's value; none counts 0.

    pairs(user_id, item_id), prefs(user_id, attr, val, <scores>), item_attrs(item_id, attr, val).
    Further columns of ``item_attrs`` are kept. The preference join is on the full (user, attr, val) key, so
    an active user's pairs spread over as many keys as the user has values. Both tables grow with the data, and the
    size of a file says little of the rows that are unfolded from it: neither is ever broadcast.
    """
    joined = pairs.select("user_id", "item_id").join(item_attrs.hint("merge"), "item_id").join(
        prefs.select("user_id", "attr", "val", *scores).hint("merge"), ["user_id", "attr", "val"], "left"
    )
    kept = [c for c in item_attrs.columns if c != "item_id"]
    return joined.select("user_id", "item_id", *kept, *[F.coalesce(s, F.lit(0)).alias(s) for s in scores])


def affinity_score(pairs: DataFrame, prefs: DataFrame, item_attrs: DataFrame, lo: float, hi: float) -> DataFrame:
    """Sum of the user's scores for the item's attribute values, scaled to lo..hi."""
    rows = attribute_scores(pairs, prefs, item_attrs, ["score"])
    summed = rows.groupBy("user_id", "item_id").agg(F.sum("score").alias("raw"), F.count("*").alias("_n"))
    return summed.select("user_id", "item_id", "raw", _scaled(F.col("raw"), F.col("_n"), lo, hi).alias("affinity"))


def apply_context_mods(
    prefs: DataFrame, mods: DataFrame, context: DataFrame, lo: float, hi: float,
    score_range: tuple[int, int] = SCORE_RANGE,
) -> DataFrame:
    """Adjust each preference by the user's modifiers for their context, in list order.

    A modifier that would leave lo..hi is skipped and the next one applies to the
    unchanged score. prefs(user_id, attr, val, score), mods(user_id, ctx_cat, ctx_val,
    mod_seq, attr, val, delta), context(user_id, ctx_seq, ctx_cat, ctx_val).

    Scores are few whole numbers, so a run of modifiers is a lookup table from the score
    before to the score after. The modifiers of a preference are cut along their order, by ctx_seq and BLOCK
    numbers of mod_seq, into runs; a run of FOLD_CHUNK or more becomes such a table, a shorter one is
    applied as it is. The runs are made in parallel and then chained, which keeps a heavily
    modified preference from being one long list in one task.
    """
    least = min(score_range[0], int(lo))
    most = max(score_range[1], int(hi))

    def step(score: Column, delta: Column) -> Column:
        moved = score + delta
        return F.when((moved >= F.lit(lo)) & (moved <= F.lit(hi)), moved).otherwise(score)

    active = mods.join(context.hint("merge"), ["user_id", "ctx_cat", "ctx_val"]).select(
        "user_id", "attr", "val", "ctx_seq", "mod_seq", F.col("delta").cast("int").alias("delta")
    )
    group = ["user_id", "attr", "val"]
    runs = active.groupBy(*group, "ctx_seq", F.floor(F.col("mod_seq") / BLOCK).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct("mod_seq", "delta"))).alias("_run")
    )
    every_score = F.sequence(F.lit(least), F.lit(most))
    table = F.aggregate("_run", every_score, lambda t, mod: F.transform(t, lambda s: step(s, mod["delta"])))
    full = F.size("_run") >= FOLD_CHUNK
    link = F.struct("ctx_seq", "_block", F.when(~full, F.col("_run")).alias("_run"), F.when(full, table).alias("_table"))
    chains = runs.groupBy(*group).agg(F.array_sort(F.collect_list(link)).alias("_chain"))

    def follow(score: Column, run: Column) -> Column:
        looked_up = F.element_at(run["_table"], score - F.lit(least - 1))
        return F.when(run["_run"].isNull(), looked_up).otherwise(
            F.aggregate(run["_run"], score, lambda s, mod: step(s, mod["delta"]))
        )

    adjusted = F.aggregate("_chain", F.col("score").cast("int"), follow)
    return prefs.join(chains.hint("merge"), ["user_id", "attr", "val"], "left").select(
        *prefs.columns,
        F.when(F.col("_chain").isNull(), F.col("score").cast("int")).otherwise(adjusted).alias("adj_score"),
    )


def context_affinity(
    pairs: DataFrame, prefs: DataFrame, mods: DataFrame, context: DataFrame, item_attrs: DataFrame,
    lo: float, hi: float,
) -> DataFrame:
    """Affinity with and without the context, from one join."""
    adjusted = apply_context_mods(prefs, mods, context, lo, hi)
    rows = attribute_scores(pairs, adjusted, item_attrs, ["score", "adj_score"])
    summed = rows.groupBy("user_id", "item_id").agg(
        F.sum("score").alias("_raw"), F.sum("adj_score").alias("_adj"), F.count("*").alias("_n")
    )
    return summed.select(
        "user_id",
        "item_id",
        _scaled(F.col("_raw"), F.col("_n"), lo, hi).alias("rating_ignore_context"),
        _scaled(F.col("_adj"), F.col("_n"), lo, hi).alias("rating_in_this_context"),
    )


def affinity_breakdown(
    pairs: DataFrame, prefs: DataFrame, mods: DataFrame, context: DataFrame, item_attrs: DataFrame,
    lo: float, hi: float,
) -> DataFrame:
    """Per attribute of each pair: score, adjusted score, and both parts of the rating."""
    adjusted = apply_context_mods(prefs, mods, context, lo, hi)
    n_attrs = item_attrs.groupBy("item_id").agg(F.count("*").alias("_n"))
    sized = item_attrs.select("item_id", "attr", "val").join(n_attrs.hint("merge"), "item_id")
    rows = attribute_scores(pairs, adjusted, sized, ["score", "adj_score"])
    part = F.lit(float(hi) - float(lo)) / (F.lit(MAX_SCORE_PER_ATTRIBUTE) * F.col("_n"))
    return rows.select(
        "user_id", "item_id", "attr", "val", "score", "adj_score",
        (F.col("score") * part).alias("share"), (F.col("adj_score") * part).alias("adj_share"),
    )


def observed_rating(df: DataFrame, affinity: str) -> DataFrame:
    """The rating shown and its whole number, halves going to the even neighbour."""
    return df.withColumn("observed_rating", F.col(affinity)).withColumn(
        "rounded_observed_rating", F.bround(F.col(affinity), 0).cast("int")
    )
