"""Association rules between brands bought in one order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegraph.operators import rules
from tastegraph.plans import bindings as b
from tastegraph.plans.bindings import with_ctes
from tastegraph.session import written
from tastegraph.sources.catalog import Tables

QUERIES: dict = {}
ORACLES: dict = {}
MIN_SUPPORT = 0.002


def query(name, sql):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        ORACLES[name] = sql
        return fn

    return register


_SQL = {
    "n": "SELECT count(*) AS n FROM orders",
    "subsets": """SELECT basket_id, [item] AS items, item AS last FROM branded
        UNION ALL SELECT s.basket_id, list_append(s.items, b.item), b.item FROM subsets s
        JOIN branded b ON b.basket_id = s.basket_id AND b.item > s.last""",
    "sets": f"""SELECT items, count(*) AS freq, any_value(n) AS n FROM subsets, n GROUP BY 1
        HAVING count(*) / any_value(n) >= {MIN_SUPPORT}""",
    "masks": "SELECT items, freq, n, unnest(range(1, (1 << len(items)) - 1)) AS mask FROM sets WHERE len(items) > 1",
    "sides": """SELECT freq, n, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS antecedents,
        list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS consequents FROM masks""",
    "measured": """SELECT antecedents, consequents, a.freq AS antecedent_count, s.freq AS both_count,
        a.freq / s.n AS antecedent_support, c.freq / s.n AS consequent_support, s.freq / s.n AS support,
        s.freq / a.freq AS confidence
        FROM sides s JOIN sets a ON a.items = antecedents JOIN sets c ON c.items = consequents""",
    "rules": """SELECT *, support / (antecedent_support * consequent_support) AS lift,
        support - antecedent_support * consequent_support AS leverage,
        CASE WHEN confidence = 1 THEN 'inf'::DOUBLE ELSE (1 - consequent_support) / (1 - confidence) END AS conviction
        FROM measured WHERE support / (antecedent_support * consequent_support) >= 1.0""",
}
_APPLIED = {
    "applied": """SELECT basket_id, o.items, r.* FROM subsets s JOIN rules r ON s.items = antecedents
        JOIN order_baskets o USING (basket_id) WHERE NOT list_has_all(o.items, consequents)""",
}
_COLUMNS = """array_to_string(antecedents, ',') AS antecedents, array_to_string(consequents, ',') AS consequents,
    antecedent_count, both_count, antecedent_support, consequent_support, support, confidence, lift, leverage, conviction"""


def _readable(df):
    """Sets as text. The measures are the same few divisions of counts in both engines, so they stay unrounded."""
    return df.withColumns({c: F.array_join(c, ",") for c in ("antecedents", "consequents") if c in df.columns})


def mined(t):
    """(baskets, rules), both written out: the miner and the rule joins read them repeatedly."""
    baskets = written(b.order_baskets(t))
    itemsets = written(rules.frequent_itemsets(baskets, MIN_SUPPORT))
    return baskets, written(rules.association_rules(itemsets, "lift", 1.0))


@query(
    "frequent_itemsets",
    with_ctes(
        "branded", "SELECT array_to_string(items, ',') AS items, freq, round(freq / n, 6) AS support FROM sets", **_SQL
    ),
)
def itemsets(t):
    found = rules.frequent_itemsets(written(b.order_baskets(t)), MIN_SUPPORT)
    return found.select(F.array_join("items", ",").alias("items"), "freq", F.round("support", 6).alias("support"))


@query("association_rules", with_ctes("branded", f"SELECT {_COLUMNS} FROM rules", **_SQL))
def all_rules(t):
    return _readable(mined(t)[1])


@query("rank_rules", with_ctes("branded", f"SELECT {_COLUMNS} FROM rules ORDER BY rules.confidence DESC", **_SQL))
def ranked(t):
    return _readable(rules.rank_rules(mined(t)[1], "confidence"))


@query(
    "applicable_rules",
    with_ctes(
        "branded order_baskets",
        """SELECT basket_id, count(*) AS n_rules, max(lift) AS best_lift,
        sum(len(list_filter(consequents, lambda c: NOT list_contains(items, c))))::BIGINT AS n_new
        FROM applied GROUP BY 1""",
        **_SQL, **_APPLIED,
    ),
)
def applicable(t):
    """Rules per basket, summed per content before they meet the baskets."""
    baskets, found = mined(t)
    per_content = rules.applicable_rules(found, baskets).groupBy("items").agg(
        F.count("*").alias("n_rules"), F.max("lift").alias("best_lift"),
        F.sum(F.size("new_items")).alias("n_new"),
    )
    return baskets.join(per_content, "items").select("basket_id", "n_rules", "best_lift", "n_new")


@query(
    "applicable_rules_of_users",
    with_ctes(
        "branded",
        """SELECT user_id, count(*) AS n_rules, max(lift) AS best_lift, sum(bit_count(c & ~u))::BIGINT AS n_new
        FROM owned JOIN masked ON (u & a) = a AND (u & c) <> c GROUP BY 1""",
        **_SQL,
        bits="SELECT p_brand, 1::BIGINT << (row_number() OVER (ORDER BY p_brand) - 1) AS bit FROM (SELECT DISTINCT p_brand FROM part)",
        owned="""SELECT o_custkey AS user_id, bit_or(bit) AS u FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN bits USING (p_brand) GROUP BY 1""",
        numbered="SELECT antecedents, consequents, lift, row_number() OVER () AS rule FROM rules",
        a_side="""SELECT rule, lift, bit_or(bit) AS a FROM (SELECT rule, lift, unnest(antecedents) AS p_brand FROM numbered)
        JOIN bits USING (p_brand) GROUP BY 1, 2""",
        c_side="""SELECT rule, bit_or(bit) AS c FROM (SELECT rule, unnest(consequents) AS p_brand FROM numbered)
        JOIN bits USING (p_brand) GROUP BY 1""",
        masked="SELECT lift, a, c FROM a_side JOIN c_side USING (rule)",
    ),
)
def applicable_of_users(t):
    """Rules that everything a user ever bought calls for, counted over rows and never gathered into a basket."""
    bought = b.lines(t).join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("o_custkey").alias("user_id"), "p_brand")
    return rules.applicable_rules_of_rows(mined(t)[1], bought, "user_id", "p_brand").groupBy("user_id").agg(
        F.count("*").alias("n_rules"), F.max("lift").alias("best_lift"), F.sum("n_new").alias("n_new")
    )


@query(
    "rule_recommend",
    with_ctes(
        "branded order_baskets",
        """SELECT basket_id, rule_rank::INTEGER AS rule_rank, array_to_string(antecedents, ',') AS antecedents,
        array_to_string(consequents, ',') AS consequents, antecedent_count, both_count,
        confidence, lift,
        unnest(list_filter(consequents, lambda c: NOT list_contains(items, c))) AS new_item
        FROM (SELECT *, row_number() OVER (PARTITION BY basket_id ORDER BY lift DESC, antecedents, consequents) AS rule_rank
              FROM applied) WHERE rule_rank <= 3""",
        **_SQL, **_APPLIED,
    ),
)
def recommend(t):
    baskets, found = mined(t)
    return _readable(rules.rule_recommend(found, baskets, "basket_id", 3))
