"""Affinity scoring of every purchased pair in the user's own context."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegraph.functions.skew import shares
from tastegraph.operators import affinity, shaping
from tastegraph.plans import bindings as b
from tastegraph.plans.bindings import with_ctes
from tastegraph.session import discard, one_by_one, written
from tastegraph.sources.catalog import Tables

QUERIES: dict = {}
ORACLES: dict = {}
ATTRS = ["colour", "kind", "brand", "style"]
LO, HI = 1, 10


def query(name, sql):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        ORACLES[name] = sql
        return fn

    return register


# Purchases of the users that a round takes, on average.
ROUND_ROWS = 6_000_000


def inputs(bought, wide, attrs):
    """(pairs, prefs, mods, context, item attributes) taken from the purchases; ``wide`` has the items' attributes."""
    prefs = (
        shaping.melt_attributes(wide, "user_id", ATTRS)
        .groupBy("user_id", "attr", "val")
        .agg(F.least(F.lit(9), F.count("*")).cast("int").alias("score"))
    )
    size = (F.col("quantity").cast("int") % 5 + 1) * F.when(F.col("flag") == "N", 1).otherwise(-1)

    def mod(category, attr, delta):
        return F.struct(
            F.lit(category).alias("ctx_cat"), F.col(category).alias("ctx_val"), F.col("item_id").alias("mod_seq"),
            F.lit(attr).alias("attr"), F.col(attr).alias("val"), delta.alias("delta"),
        )

    each = F.array(mod("priority", "kind", size), mod("flag", "kind", -size), mod("priority", "colour", size))
    mods = wide.select("user_id", F.inline(each))
    latest = bought.groupBy("user_id").agg(F.max(F.struct("quantity", "item_id", "priority", "flag")).alias("_last"))
    entries = F.array(
        F.struct(F.lit(1).alias("ctx_seq"), F.lit("priority").alias("ctx_cat"), F.col("_last.priority").alias("ctx_val")),
        F.struct(F.lit(2).alias("ctx_seq"), F.lit("flag").alias("ctx_cat"), F.col("_last.flag").alias("ctx_val")),
    )
    context = latest.select("user_id", F.explode(entries).alias("_e")).select("user_id", "_e.*")
    return bought.select("user_id", "item_id"), prefs, mods, context, attrs


def in_rounds(t, scored):
    """``scored`` of the inputs, by rounds of users: what a round shuffles is gone before the next, however many users there are."""
    items = b.items(t)
    attrs = shaping.melt_attributes(items, "item_id", ATTRS)
    bought = written(b.purchases(t))
    wide = written(bought.join(items.hint("merge"), "item_id"))
    rounds = shares(bought, "user_id", ROUND_ROWS)
    found = one_by_one(scored(*inputs(bought.filter(mine), wide.filter(mine), attrs)) for mine in rounds)
    if len(rounds) > 1:
        discard(bought, wide)
    return found


_SQL = {
    "attrs": "SELECT item_id, attr, val FROM items UNPIVOT (val FOR attr IN (colour, kind, brand, style))",
    "prefs": """SELECT user_id, attr, val, least(9, count(*))::INTEGER AS score
        FROM purchases JOIN attrs USING (item_id) GROUP BY 1, 2, 3""",
    "sized": """SELECT *, (quantity::INTEGER % 5 + 1) * (CASE WHEN flag = 'N' THEN 1 ELSE -1 END) AS size
        FROM purchases JOIN items USING (item_id)""",
    "mods": """SELECT user_id, 'priority' AS ctx_cat, priority AS ctx_val, item_id AS mod_seq, 'kind' AS attr, kind AS val, size AS delta FROM sized
        UNION ALL SELECT user_id, 'flag', flag, item_id, 'kind', kind, -size FROM sized
        UNION ALL SELECT user_id, 'priority', priority, item_id, 'colour', colour, size FROM sized""",
    "latest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY quantity DESC, item_id DESC) AS rn
        FROM purchases) WHERE rn = 1""",
    "context": """SELECT user_id, 1 AS ctx_seq, 'priority' AS ctx_cat, priority AS ctx_val FROM latest
        UNION ALL SELECT user_id, 2, 'flag', flag FROM latest""",
    "chains": """SELECT user_id, attr, val, list(delta ORDER BY ctx_seq, mod_seq) AS deltas
        FROM mods JOIN context USING (user_id, ctx_cat, ctx_val) GROUP BY 1, 2, 3""",
    "adjusted": f"""SELECT p.*, CASE WHEN deltas IS NULL THEN score ELSE list_reduce(list_prepend(score, deltas),
        lambda s, d: CASE WHEN s + d BETWEEN {LO} AND {HI} THEN s + d ELSE s END) END::INTEGER AS adj_score
        FROM prefs p LEFT JOIN chains USING (user_id, attr, val)""",
    "scored": """SELECT user_id, item_id, a.attr, a.val, coalesce(score, 0)::INTEGER AS score, coalesce(adj_score, 0)::INTEGER AS adj_score
        FROM purchases JOIN attrs a USING (item_id) LEFT JOIN adjusted USING (user_id, attr, val)""",
}


def _sql(body):
    return with_ctes("items purchases", body, **_SQL)


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "affinity_score",
    _sql(f"""SELECT user_id, item_id, sum(score)::BIGINT AS raw, round({LO}.0::DOUBLE + sum(score) * {HI - LO}.0::DOUBLE / 40, 6) AS affinity
        FROM scored GROUP BY 1, 2"""),
)
def score(t):
    def scored(pairs, prefs, mods, context, attrs):
        return _round(affinity.affinity_score(pairs, prefs, attrs, LO, HI), "affinity")

    return in_rounds(t, scored)


@query("apply_context_mods", _sql("SELECT user_id, attr, val, score, adj_score FROM adjusted"))
def adjusted_prefs(t):
    return in_rounds(t, lambda pairs, prefs, mods, context, attrs: affinity.apply_context_mods(prefs, mods, context, LO, HI))


@query(
    "context_affinity",
    _sql(f"""SELECT user_id, item_id, round({LO}.0::DOUBLE + sum(score) * {HI - LO}.0::DOUBLE / 40, 6) AS rating_ignore_context,
        round({LO}.0::DOUBLE + sum(adj_score) * {HI - LO}.0::DOUBLE / 40, 6) AS rating_in_this_context FROM scored GROUP BY 1, 2"""),
)
def in_context(t):
    def scored(*frames):
        return _round(affinity.context_affinity(*frames, LO, HI), "rating_ignore_context", "rating_in_this_context")

    return in_rounds(t, scored)


@query(
    "observed_rating",
    _sql(f"""SELECT user_id, item_id, observed_rating, round_even(observed_rating, 0)::INTEGER AS rounded_observed_rating
        FROM (SELECT user_id, item_id, round({LO}.0::DOUBLE + sum(score) * {HI - LO}.0::DOUBLE / 40, 6) AS observed_rating
              FROM scored GROUP BY 1, 2)"""),
)
def observed(t):
    shown = affinity.observed_rating(score(t), "affinity")
    return shown.select("user_id", "item_id", "observed_rating", "rounded_observed_rating")


@query(
    "affinity_breakdown",
    _sql(f"""SELECT user_id, item_id, attr, val, score, adj_score, round(score * {HI - LO}.0::DOUBLE / 40, 6) AS share,
        round(adj_score * {HI - LO}.0::DOUBLE / 40, 6) AS adj_share FROM scored"""),
)
def breakdown(t):
    def scored(*frames):
        return _round(affinity.affinity_breakdown(*frames, LO, HI), "share", "adj_share")

    return in_rounds(t, scored)
