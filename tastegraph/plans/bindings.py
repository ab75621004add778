"""Roles of the test tables: users, items, purchases, interaction log, baskets, documents.

Each frame has a SQL twin; the twins are joined into ``WITH`` lists by ``with_ctes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.shaping import basket_sets
from tastegraph.sources.catalog import Tables

SEED = 20


def users(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") < 0, "debt")
        .when(F.col("c_acctbal") < 5000, "low")
        .otherwise("high")
        .alias("affluence"),
    )


def items(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    return t.part.select(
        F.col("p_partkey").alias("item_id"),
        words[0].alias("colour"),
        words[1].alias("kind"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("style"),
    )


def lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def purchases(t: Tables) -> DataFrame:
    """Distinct (user, item) pairs with a context and the largest quantity."""
    return (
        lines(t)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(
            F.min("o_orderpriority").alias("priority"),
            F.min("l_returnflag").alias("flag"),
            F.max("l_quantity").alias("quantity"),
        )
    )


def pairs(t: Tables) -> DataFrame:
    return (
        lines(t)
        .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .distinct()
    )


def product_lines(t: Tables) -> DataFrame:
    """The catalogue at the level of brand and type (150 entries at any scale)."""
    return t.part.select(F.concat_ws("/", "p_brand", "p_type").alias("line")).distinct()


def line_purchases(t: Tables) -> DataFrame:
    """Distinct (user, product line) pairs with the mean quantity as a rating."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_brand", "p_type").alias("line"))
    return (
        lines(t)
        .join(part, "l_partkey")
        .groupBy(F.col("o_custkey").alias("user_id"), "line")
        .agg(F.avg("l_quantity").alias("quantity"))
    )


def event_log(t: Tables) -> DataFrame:
    return t.events.select("user_id", "ts", "event_id", "event_type", "value")


def order_baskets(t: Tables, keep: str = "TRUE") -> DataFrame:
    """Brands per order; orders without lines have an empty basket."""
    branded = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket_id"), F.col("p_brand").alias("item"), "l_returnflag"
    )
    orders = t.orders.select(F.col("o_orderkey").alias("basket_id"))
    return basket_sets(orders, branded, "basket_id", "item", F.expr(keep))


def unit(seed: int | str, *keys: str) -> str:
    """SQL form of ``seeded_uniform``."""
    joined = ", ".join(keys)
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {joined})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


CTES = {
    "users": """SELECT c_custkey AS user_id, n_name AS location, c_mktsegment AS segment,
        CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS affluence
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "items": """SELECT p_partkey AS item_id, split_part(p_name, ' ', 1) AS colour, split_part(p_name, ' ', 2) AS kind,
        p_brand AS brand, p_type AS style FROM part""",
    "purchases": """SELECT o_custkey AS user_id, l_partkey AS item_id, min(o_orderpriority) AS priority,
        min(l_returnflag) AS flag, max(l_quantity) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "pairs": """SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "product_lines": "SELECT DISTINCT concat_ws('/', p_brand, p_type) AS line FROM part",
    "line_purchases": """SELECT o_custkey AS user_id, concat_ws('/', p_brand, p_type) AS line, avg(l_quantity) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "branded": """SELECT DISTINCT l_orderkey AS basket_id, p_brand AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "order_baskets": """SELECT o_orderkey AS basket_id,
        coalesce(list_sort(list(item) FILTER (WHERE item IS NOT NULL)), []::VARCHAR[]) AS items
        FROM orders LEFT JOIN branded ON o_orderkey = basket_id GROUP BY 1""",
}


def with_ctes(names: str, body: str, **extra: str) -> str:
    """``WITH`` the named frames (in order) and the extra ones, then the body."""
    parts = [f"{n} AS ({CTES[n]})" for n in names.split()] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}"
