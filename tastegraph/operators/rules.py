"""Association rules mined from baskets and the recommendations they give."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegraph.functions.ordering import dense_position, first_k
from tastegraph.session import written

# Items that one number holds as bits.
WORD = 64

def frequent_itemsets(baskets: DataFrame, min_support: float, max_len: int | None = None) -> DataFrame:
    """itemsets(items, freq, n_baskets, support) held by at least ``min_support`` of all baskets.

    Empty baskets count in the denominator. ``baskets`` has an ``items`` array of
    distinct items and is read several times by the miner.
    """
    n_baskets = baskets.count()
    found = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(baskets).freqItemsets
    sets = found.select(
        F.array_sort("items").alias("items"), "freq", F.lit(n_baskets).cast("bigint").alias("n_baskets"),
        (F.col("freq") / F.lit(n_baskets)).alias("support"),
    )
    return sets if max_len is None else sets.filter(F.size("items") <= max_len)


def association_rules(itemsets: DataFrame, metric: str = "lift", threshold: float = 1.0) -> DataFrame:
    """Every split of every itemset into antecedents => consequents that reaches the threshold.

    Both sides may hold several items. ``itemsets`` must contain the subsets of its
    members, as the miner's output does; their number depends on the support threshold
    and the catalogue, not on the number of baskets.
    """
    full = F.pow(F.lit(2), F.size("items")).cast("bigint")
    splits = itemsets.filter(F.size("items") > 1).select(
        "items", "freq", "n_baskets", F.explode(F.sequence(F.lit(1).cast("bigint"), full - 2)).alias("_mask")
    )

    def side(chosen: int) -> Column:
        return F.filter("items", lambda _, i: F.getbit(F.col("_mask"), i) == F.lit(chosen))

    sides = splits.select("freq", "n_baskets", side(1).alias("antecedents"), side(0).alias("consequents"))
    single = itemsets.select("items", F.col("freq").alias("_f"))
    n = F.col("n_baskets")
    counted = (
        sides.join(single.withColumnsRenamed({"items": "antecedents", "_f": "antecedent_count"}), "antecedents")
        .join(single.withColumnsRenamed({"items": "consequents", "_f": "consequent_count"}), "consequents")
        .select(
            "antecedents", "consequents", "antecedent_count", F.col("freq").alias("both_count"),
            (F.col("antecedent_count") / n).alias("antecedent_support"),
            (F.col("consequent_count") / n).alias("consequent_support"),
            (F.col("freq") / n).alias("support"),
            (F.col("freq") / F.col("antecedent_count")).alias("confidence"),
        )
    )
    expected = F.col("antecedent_support") * F.col("consequent_support")
    rules = counted.withColumns(
        {
            "lift": F.col("support") / expected,
            "leverage": F.col("support") - expected,
            "conviction": F.when(F.col("confidence") == 1, F.lit(float("inf"))).otherwise(
                (F.lit(1.0) - F.col("consequent_support")) / (F.lit(1.0) - F.col("confidence"))
            ),
        }
    )
    return rules.filter(F.col(metric) >= threshold)


def rank_rules(rules: DataFrame, by: str = "lift") -> DataFrame:
    """Strongest rules first."""
    return rules.orderBy(F.col(by).desc(), "antecedents", "consequents")


def _contents(baskets: DataFrame) -> DataFrame:
    """Distinct basket contents with an ID. They are few bytes that expand into many rule
    rows, so they are dealt out by number and not left to size-based coalescing."""
    spark = baskets.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = baskets.filter(F.size("items") > 0).select("items").distinct()
    keyed = distinct.withColumn("_key", F.to_json("items"))
    return written(dense_position(keyed, ["_key"], "content_id").drop("_key")).repartition(parts, "content_id")


def _lots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _in_every_lot(table: DataFrame) -> DataFrame:
    """``table`` once per lot: rows dealt over the lots meet it without gathering on its keys, however few they are."""
    lots = _lots(table.sparkSession)
    return table.withColumn("_lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))


def antecedent_tree(rules: DataFrame) -> DataFrame:
    """The prefix tree of the antecedents as nodes (path, depth, is_end): every beginning of every antecedent.

    ``is_end``: the path is an antecedent itself. Antecedents are sorted, as the miner gives them.
    """
    places = rules.select("antecedents").distinct().select(
        "antecedents", F.explode(F.sequence(F.lit(1), F.size("antecedents"))).alias("depth")
    )
    return (
        places.groupBy(F.slice("antecedents", F.lit(1), F.col("depth")).alias("path"), "depth")
        .agg(F.max(F.col("depth") == F.size("antecedents")).alias("is_end"))
    )


def contained_antecedents(contents: DataFrame, rules: DataFrame, key: str = "content_id") -> DataFrame:
    """(key, items, antecedents): every antecedent that the ``items`` of a row contain.

    The prefix tree is descended item by item: a row stands at the nodes it has reached, is extended by
    each later item it holds, and is kept where the longer path is a node. So only beginnings of
    antecedents are formed, never all subsets of a row. The join key is the whole path with a lot: the nodes are
    in every lot and the rows dealt over the lots, so no path is hot. ``key`` is unique. Empty and NULL
    ``items`` contain nothing; repeated ones count once.
    """
    tree = written(antecedent_tree(rules))
    deepest = tree.agg(F.max("depth")).head()[0] or 0
    lots = _lots(contents.sparkSession)
    held = contents.select(key, F.array_distinct("items").alias("items"), F.pmod(F.xxhash64(key), F.lit(lots)).cast("int").alias("_lot"))
    nodes = _in_every_lot(tree)
    found = None
    step = held.withColumn("path", F.expr("slice(items, 1, 0)"))
    for depth in range(1, deepest + 1):
        later = F.col("items") if depth == 1 else F.expr("filter(items, x -> x > element_at(path, -1))")
        longer = step.select(key, "items", "_lot", "path", F.explode(later).alias("_item"))
        longer = longer.select(key, "items", "_lot", F.concat("path", F.array("_item")).alias("path"))
        level = nodes.filter(F.col("depth") == depth).drop("depth")
        step = longer.join(level, ["_lot", "path"])
        if depth < deepest:
            step = written(step)
        ends = step.filter("is_end").select(key, "items", "_lot", F.col("path").alias("antecedents"))
        found = ends if found is None else found.unionByName(ends)
    if found is None:
        kind = rules.schema["antecedents"].dataType.simpleString()
        return held.filter("false").withColumn("antecedents", F.array().cast(kind))
    return found


def _match(contents: DataFrame, rules: DataFrame, extra: Column | None = None) -> DataFrame:
    """Contents and the rules that they contain and that add an item to them."""
    found = contained_antecedents(contents, rules)
    matched = found.join(_in_every_lot(rules), ["_lot", "antecedents"]).drop("_lot")
    return (matched if extra is None else matched.filter(extra)).filter(F.size(F.array_except("consequents", "items")) > 0)


def applicable_rules(rules: DataFrame, baskets: DataFrame) -> DataFrame:
    """Rules whose antecedents a basket contains and whose consequents add an item to it.

    One row per *distinct* basket content and rule, with the ``new_items``: equal baskets
    get equal rules, so a content is matched once however many baskets share it. The
    antecedents are found by descending their prefix tree, which never forms the subsets of a basket.
    """
    applied = _match(_contents(baskets), rules)
    return applied.drop("content_id").withColumn("new_items", F.array_except("consequents", "items"))


def applicable_rules_of_rows(rules: DataFrame, rows: DataFrame, basket: str, item: str) -> DataFrame:
    """(basket, antecedents, consequents, n_new, other columns of ``rules``) from rows (basket, item).

    For baskets too large for an array in one row, such as all that a user ever bought: only items that some
    rule names matter, and those are at most the mean basket length / least support, so what a basket holds of
    them is a few words of WORD bits, a rule's sides likewise. A basket then meets every rule where it lies,
    and what comes out is neither shuffled nor kept: rules, not rows, are broadcast, and their number depends on the
    support threshold. Neither an item nor a basket is hot.
    Rows with a NULL item hold nothing; rows with a NULL basket are one basket. The items of a side are distinct.
    """
    spark = rows.sparkSession
    rules = written(rules.filter(F.size("antecedents") > 0))
    columns = rules.columns
    sides = rules.select(F.explode(F.array("antecedents", "consequents")).alias("_side")).distinct()
    needs = sides.select("_side", F.explode("_side").alias("_item"))
    numbered = written(dense_position(needs.select("_item").distinct(), ["_item"], "_no"))
    words = range(max(1, -(-numbered.count() // WORD)))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_no") % WORD).cast("int"))

    def packed(df: DataFrame, by: str, name: str) -> DataFrame:
        held = df.join(F.broadcast(numbered), "_item")
        inside = lambda w: F.bit_or(F.when(F.floor(F.col("_no") / WORD) == w, bit).otherwise(F.lit(0).cast("bigint")))
        return held.groupBy(by).agg(*[inside(w).alias(f"{name}{w}") for w in words])

    of_side = written(packed(needs, "_side", "_s"))
    for side, name in (("antecedents", "_a"), ("consequents", "_c")):
        rules = rules.join(of_side.withColumnsRenamed({"_side": side, **{f"_s{w}": f"{name}{w}" for w in words}}), side)
    baskets = packed(rows.select(F.col(basket).alias("_basket"), F.col(item).alias("_item")), "_basket", "_u")
    # few bytes that meet every rule: dealt out by number, not left to size-based coalescing
    dealt = baskets.repartition(max(spark.sparkContext.defaultParallelism, _lots(spark)), "_basket")
    missing = [F.col(f"_c{w}").bitwiseAND(F.bitwise_not(F.col(f"_u{w}"))) for w in words]
    holds = reduce(lambda x, y: x & y, [F.col(f"_u{w}").bitwiseAND(F.col(f"_a{w}")) == F.col(f"_a{w}") for w in words])
    adds = reduce(lambda x, y: x | y, [m != 0 for m in missing])
    told = dealt.join(F.broadcast(rules), holds & adds)
    n_new = reduce(lambda x, y: x + y, [F.bit_count(m) for m in missing])
    return told.select(F.col("_basket").alias(basket), *columns, n_new.alias("n_new"))


def rule_recommend(rules: DataFrame, baskets: DataFrame, basket: str, k: int = 3) -> DataFrame:
    """Per basket the items its top ``k`` applicable rules (by lift) add, with the counts that explain them.

    Of the rules with antecedents A at most 2**(|B|-|A|) - 1 add nothing to a basket B
    (their consequents are subsets of the rest of B). So only the first
    k + 2**(|B|-|A|) - 1 rules of A can be among B's best, and the others are dropped
    before ranking without changing the result.
    """
    strongest = [F.col("lift").desc(), F.col("antecedents"), F.col("consequents")]
    place = F.row_number().over(Window.partitionBy("antecedents").orderBy(*strongest))
    placed = written(rules.withColumn("_place", place))
    keys = placed.select("lift", "_place", "antecedents", "consequents")
    contents = _contents(baskets)
    spare = F.size("items") - F.size("antecedents")
    reachable = F.col("_place") <= F.lit(k) + F.pow(F.lit(2.0), F.least(spare, F.lit(60))) - 1
    pairs = _match(contents, keys, reachable).select("content_id", "lift", "antecedents", "consequents")
    best = first_k(pairs, ["content_id"], strongest, k, "rule_rank").drop("lift")
    chosen = (
        best.join(placed.drop("_place"), ["antecedents", "consequents"])
        .join(contents, "content_id")
        .select(
            "items", "rule_rank", "antecedents", "consequents", "antecedent_count", "both_count", "confidence", "lift",
            F.explode(F.array_except("consequents", "items")).alias("new_item"),
        )
    )
    return baskets.select(basket, "items").join(chosen, "items").drop("items")
