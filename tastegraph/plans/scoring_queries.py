"""Batch scoring and learning on purchases; vectors come from the embeddings table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tastegraph.functions.columns import sigmoid
from tastegraph.functions.skew import shares
from tastegraph.operators import learners, retrieval, sampling, scoring, shaping
from tastegraph.plans import bindings as b
from tastegraph.plans.bindings import SEED, unit, with_ctes
from tastegraph.plans.shaping_queries import examples
from tastegraph.session import discard, one_by_one, written
from tastegraph.sources.catalog import Tables

QUERIES: dict = {}
ORACLES: dict = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _vectors(t, ids, key, out, shift=0):
    """A vector for every ID: the embeddings are handed out in turn. Their numbers stay as narrow as they are stored."""
    n = t.embeddings.agg(F.count("*")).scalar()
    rows = t.embeddings.select("vec_id", F.col("embedding").alias(out))
    return ids.select(key).distinct().withColumn("vec_id", (F.col(key) + F.lit(shift)) % n).join(rows, "vec_id").drop("vec_id")


# Pairs of the users that a round takes, on average.
ROUND_ROWS = 10_000_000


def _in_rounds(pairs, scored):
    """``scored`` of the pairs, by rounds of users: a pair is shuffled with a vector, and what a round
    shuffles is gone before the next, however many pairs there are."""
    rounds = shares(pairs, "user_id", ROUND_ROWS)
    found = one_by_one(scored(pairs.filter(mine)) for mine in rounds)
    if len(rounds) > 1:
        discard(pairs)
    return found


_FACTORS = {
    "n": "SELECT count(*) AS n FROM embeddings",
    "uf": "SELECT user_id, embedding::DOUBLE[] AS u FROM (SELECT DISTINCT user_id FROM pairs), n JOIN embeddings ON vec_id = user_id % n",
    "vf": "SELECT item_id, embedding::DOUBLE[] AS v FROM (SELECT DISTINCT item_id FROM pairs), n JOIN embeddings ON vec_id = (item_id + 7) % n",
}
_MF = "round(1.0::DOUBLE + 9.0::DOUBLE / (1 + exp(-list_dot_product(u, v))), 6)"


def _mf(t):
    def scored(pairs):
        rated = scoring.mf_score(pairs, _vectors(t, pairs, "user_id", "u"), _vectors(t, pairs, "item_id", "v", 7))
        return rated.withColumn("predicted_rating", F.round("predicted_rating", 6))

    return _in_rounds(written(b.pairs(t)), scored)


@query(
    "mf_score",
    with_ctes(
        "pairs",
        f"SELECT user_id, item_id, {_MF} AS predicted_rating FROM pairs JOIN uf USING (user_id) JOIN vf USING (item_id)",
        **_FACTORS,
    ),
)
def mf(t):
    return _mf(t)


# Every part, whether anybody bought it or not, has factors.
_UNSEEN = {
    "n": _FACTORS["n"],
    "uf": _FACTORS["uf"],
    "af": "SELECT p_partkey AS item_id, embedding::DOUBLE[] AS v FROM part, n JOIN embeddings ON vec_id = (p_partkey + 7) % n",
    "unseen": """SELECT user_id, item_id, round(list_dot_product(u, v), 9) + 0.0 AS score FROM uf CROSS JOIN af
        ANTI JOIN pairs USING (user_id, item_id)""",
    "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM unseen)
        WHERE rank <= {k}""",
}


def unseen_sql(k: int) -> dict[str, str]:
    return _UNSEEN | {"best": _UNSEEN["best"].format(k=k)}


def best_unseen(t, pairs, k):
    """Each customer's ``k`` best parts among those not bought."""
    items = b.items(t).select("item_id")
    return retrieval.topk_unseen(_vectors(t, pairs, "user_id", "u"), _vectors(t, items, "item_id", "v", 7), pairs, k)


@query(
    "topk_per_user",
    with_ctes(
        "pairs",
        "SELECT user_id, item_id, round(1.0::DOUBLE + 9.0::DOUBLE / (1 + exp(-score)), 6) AS predicted_rating, rank::INTEGER AS rank FROM best",
        **unseen_sql(5),
    ),
)
def top5(t):
    """The five best new parts of every customer."""
    rating = F.lit(1.0) + F.lit(9.0) * sigmoid("score")
    return best_unseen(t, written(b.pairs(t)), 5).select("user_id", "item_id", F.round(rating, 6).alias("predicted_rating"), "rank")


_CENTROIDS = """SELECT label, dim - 1 AS dim, avg(value::DOUBLE) AS w FROM (
    SELECT label, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY 1, 2"""


def _dims(t):
    return t.embeddings.select("vec_id", "label", F.posexplode("embedding").alias("dim", "value"))


def _centroids(t):
    """Mean vector per label: ten rows of weights."""
    return _dims(t).groupBy("label", "dim").agg(F.avg(F.col("value").cast("double")).alias("w"))


@query(
    "two_tower_score",
    with_ctes(
        "purchases pairs",
        """SELECT user_id, item_id, priority, round(1.0::DOUBLE / (1 + exp(-list_sum(list_transform(range(1, len(u) + 1),
            lambda i: u[i] * v[i] * c[i] * 64)))), 6) AS pred_y
        FROM purchases JOIN uf USING (user_id) JOIN vf USING (item_id) JOIN towers ON label = left(priority, 1)::INTEGER""",
        **_FACTORS,
        towers=f"SELECT label, list(w ORDER BY dim) AS c FROM ({_CENTROIDS}) GROUP BY 1",
    ),
)
def towers(t):
    context = _centroids(t).groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "w"))), lambda e: e["w"] * 64).alias("c")
    )
    context = written(context)

    def scored(bought):
        ready = (
            bought.withColumn("label", F.substring("priority", 1, 1).cast("int"))
            .join(_vectors(t, bought, "user_id", "u"), "user_id")
            .join(_vectors(t, bought, "item_id", "v", 7), "item_id")
            .join(F.broadcast(context), "label")  # a row of weights per label
        )
        return ready.select("user_id", "item_id", "priority", F.round(scoring.two_tower_score("u", "v", "c"), 6).alias("pred_y"))

    return _in_rounds(written(b.purchases(t).select("user_id", "item_id", "priority")), scored)


def _layer(df, number, out, inp, w):
    return df.select(F.lit(number).alias("layer"), F.col(out).alias("out"), F.col(inp).alias("inp"), F.col(w).alias("w"))


def _offsets(df, number, out, value):
    return df.groupBy(F.col(out).alias("out")).agg(F.avg(value).alias("b")).select(F.lit(number).alias("layer"), "out", "b")


_CENTROID_SQL = {
    "centroids": _CENTROIDS,
    "label_bias": "SELECT label, avg(w) AS b FROM centroids GROUP BY 1",
    "dim_bias": "SELECT dim, avg(w) AS b FROM centroids GROUP BY 1",
    "x": "SELECT vec_id, value::DOUBLE AS value, dim - 1 AS dim FROM (SELECT vec_id, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS dim FROM embeddings)",
}


@query(
    "dense_relu_stack",
    with_ctes(
        "",
        """SELECT vec_id, dim::INTEGER AS slot, round(y2, 6) + 0.0 AS value FROM (
            SELECT vec_id, c.dim, greatest(0.0::DOUBLE, sum(h.y * c.w) + any_value(d.b)) AS y2
            FROM hidden h JOIN centroids c USING (label) JOIN dim_bias d ON d.dim = c.dim GROUP BY 1, 2)""",
        **_CENTROID_SQL,
        hidden="""SELECT vec_id, c.label, greatest(0.0::DOUBLE, sum(value * w) + any_value(l.b)) AS y
            FROM x JOIN centroids c USING (dim) JOIN label_bias l ON l.label = c.label GROUP BY 1, 2""",
    ),
)
def dense(t):
    """Two layers (64 -> 10 -> 64) whose weights are the label centroids and their transpose."""
    centroids = written(_centroids(t))
    weights = _layer(centroids, 1, "label", "dim", "w").unionByName(_layer(centroids, 2, "dim", "label", "w"))
    bias = _offsets(centroids, 1, "label", "w").unionByName(_offsets(centroids, 2, "dim", "w"))
    scored = scoring.dense_relu_stack(t.embeddings, "embedding", scoring.load_layers(weights, bias), "y")
    return scored.select("vec_id", F.posexplode("y").alias("slot", "value")).withColumn("value", F.round("value", 6) + 0.0)


def _moments(t):
    """Second moments of the vector dimensions as a square weight matrix."""
    dims = t.embeddings.select(F.posexplode("embedding").alias("out", "a"), "embedding")
    both = dims.select("out", "a", F.posexplode("embedding").alias("inp", "b"))
    return both.groupBy("out", "inp").agg(F.avg(F.col("a").cast("double") * F.col("b").cast("double") * 64).alias("w"))


_MOMENTS_SQL = """SELECT p.dim AS out, q.dim AS inp, avg(p.value * q.value * 64) AS w
    FROM x p JOIN x q USING (vec_id) GROUP BY 1, 2"""


def _cross_sql(before: str) -> str:
    return f"""SELECT vec_id, x0.dim, x0.value * (s + b) + p.value AS value
        FROM (SELECT vec_id, out, sum(w * value) AS s FROM {before} JOIN moments ON inp = dim GROUP BY 1, 2) m
        JOIN x x0 ON x0.vec_id = m.vec_id AND x0.dim = out JOIN {before} p ON p.vec_id = m.vec_id AND p.dim = out
        JOIN dim_bias d ON d.dim = out"""


_CROSS_SQL = {**_CENTROID_SQL, "moments": _MOMENTS_SQL}
_CROSS_SQL["crossed1"] = _cross_sql("x").replace("SELECT vec_id, x0.dim", "SELECT m.vec_id, x0.dim")
_CROSS_SQL["crossed2"] = _cross_sql("crossed1").replace("SELECT vec_id, x0.dim", "SELECT m.vec_id, x0.dim")


@query(
    "dcn_cross_layer",
    with_ctes("", "SELECT vec_id, dim::INTEGER AS slot, round(value, 6) + 0.0 AS value FROM crossed2", **_CROSS_SQL),
)
def cross(t):
    moments = written(_moments(t))
    weights = moments.withColumn("layer", F.explode(F.array(F.lit(1), F.lit(2))))
    offsets = _offsets(written(_centroids(t)), 1, "dim", "w")
    bias = offsets.unionByName(offsets.withColumn("layer", F.lit(2)))
    scored = scoring.dcn_cross_layer(t.embeddings, "embedding", scoring.load_layers(weights, bias), "y")
    return scored.select("vec_id", F.posexplode("y").alias("slot", "value")).withColumn("value", F.round("value", 6) + 0.0)


_TYPES = "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"
# A row's inputs: the user's vector and the value (deep), the event type's vector and the value (cross).
_DCN_SQL = {
    **_CENTROID_SQL,
    "moments": _MOMENTS_SQL,
    "n": "SELECT count(*) AS n FROM embeddings",
    "ins": f"""SELECT event_id, list_append(e.embedding::DOUBLE[], value / 100) AS dx, list_append(c.c, value / 100) AS cx
        FROM events, n JOIN embeddings e ON e.vec_id = user_id % n
        JOIN (SELECT label, list(w ORDER BY dim) AS c FROM centroids GROUP BY 1) c ON c.label = {_TYPES}""",
    # cross matrix: second moments, with a last row and column for the direct feature
    "mrows": """SELECT out, list_append(list(w ORDER BY inp), 0.25::DOUBLE) AS row, any_value(b) AS b
            FROM moments JOIN dim_bias ON dim = out GROUP BY 1
        UNION ALL SELECT 64, list_append(list(b ORDER BY dim), 0.5::DOUBLE), 0.1::DOUBLE FROM dim_bias""",
    "crossed": """SELECT event_id, out, cx[out + 1] * (list_dot_product(row, cx) + b) + cx[out + 1] AS y FROM ins, mrows""",
    "drows": """SELECT label, list_append(list(w ORDER BY dim), 0.1::DOUBLE) AS row, any_value(b) AS b
        FROM centroids JOIN label_bias USING (label) GROUP BY 1""",
}


def _dcn_inputs(t):
    codes = F.expr(_TYPES)
    user = _vectors(t, t.events, "user_id", "embed_deep")
    kinds = _centroids(t).groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "w"))), lambda e: e["w"]).alias("embed_cross")
    )
    direct = F.array(F.col("value") / 100)
    return (
        t.events.join(user, "user_id").withColumn("label", codes).join(kinds, "label")
        .select("event_id", "embed_deep", direct.alias("direct_deep"), "embed_cross", direct.alias("direct_cross"))
    )


def _dcn_layers(t):
    """(deep layer 10 x 65, cross layer 65 x 65) as arrays."""
    centroids = written(_centroids(t))
    (deep_w, deep_b), = scoring.load_layers(_layer(centroids, 1, "label", "dim", "w"), _offsets(centroids, 1, "label", "w"))
    (cross_w, cross_b), = scoring.load_layers(
        _moments(t).withColumn("layer", F.lit(1)), _offsets(centroids, 1, "dim", "w")
    )
    deep = (np.hstack([deep_w, np.full((len(deep_w), 1), 0.1)]), deep_b)
    wide = np.vstack([np.hstack([cross_w, np.full((len(cross_w), 1), 0.25)]), np.append(cross_b, 0.5)])
    return deep, (wide, np.append(cross_b, 0.1))


_OUT_DEEP, _OUT_CROSS, _OUT_BIAS = 2.0, 0.5, -0.1


@query(
    "dcn_score",
    with_ctes(
        "",
        f"""SELECT event_id, round(1.0::DOUBLE / (1 + exp(-(d.s * {_OUT_DEEP} + c.s * {_OUT_CROSS} + {_OUT_BIAS}))), 6) AS pred_y
        FROM (SELECT event_id, sum(greatest(0.0::DOUBLE, list_dot_product(row, dx) + b)) AS s FROM ins, drows GROUP BY 1) d
        JOIN (SELECT event_id, sum(y) AS s FROM crossed GROUP BY 1) c USING (event_id)""",
        **_DCN_SQL,
    ),
)
def dcn_parallel(t):
    deep, wide = _dcn_layers(t)
    weights = np.concatenate([np.full(len(deep[1]), _OUT_DEEP), np.full(len(wide[1]), _OUT_CROSS)])[None, :]
    net = scoring.DeepCrossNet("parallel", [deep], (weights, np.array([_OUT_BIAS])), [wide])
    scored = scoring.dcn_score(_dcn_inputs(t), net, "embed_deep", "direct_deep", "embed_cross", "direct_cross")
    return scored.select("event_id", F.round("pred_y", 6).alias("pred_y"))


@query(
    "dcn_score_stacked",
    with_ctes(
        "",
        f"""SELECT event_id, round(1.0::DOUBLE / (1 + exp(-(s * {_OUT_DEEP} + {_OUT_BIAS}))), 6) AS pred_y FROM (
            SELECT event_id, sum(greatest(0.0::DOUBLE, list_dot_product(row, dx) + list_dot_product(row, cy) + b)) AS s
            FROM ins JOIN (SELECT event_id, list(y ORDER BY out) AS cy FROM crossed GROUP BY 1) USING (event_id), drows GROUP BY 1)""",
        **_DCN_SQL,
    ),
)
def dcn_stacked(t):
    """The deep layer sees the deep inputs and, with the same weights, the cross output."""
    (deep_w, deep_b), wide = _dcn_layers(t)
    output = (np.full((1, len(deep_b)), _OUT_DEEP), np.array([_OUT_BIAS]))
    net = scoring.DeepCrossNet("stacked", [(np.hstack([deep_w, deep_w]), deep_b)], output, [wide])
    scored = scoring.dcn_score(_dcn_inputs(t), net, "embed_deep", "direct_deep", "embed_cross", "direct_cross")
    return scored.select("event_id", F.round("pred_y", 6).alias("pred_y"))


_CONTROL = {
    "user_id": ["embed_then_deep"],
    "item_id": ["embed_then_deep", "embed_then_cross"],
    "priority": ["one_hot_then_deep", "one_hot_then_cross"],
    "flag": ["one_hot_then_deep"],
    "quantity": ["direct_to_deep", "direct_to_cross"],
}
_HOT = ", ".join(f"(priority = '{p}')::INTEGER" for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


def _index_sql(column):
    return f"""SELECT {column}, row_number() OVER (ORDER BY md5({column}::VARCHAR)) - 1 AS {column}_ix
        FROM (SELECT DISTINCT {column} FROM purchases WHERE flag <> 'R')"""


@query(
    "feature_routes",
    with_ctes(
        "purchases",
        f"""SELECT user_id, item_id, concat_ws(',', {_HOT}, (flag = 'A')::INTEGER, (flag = 'N')::INTEGER, quantity::INTEGER) AS to_deep,
        concat_ws(',', {_HOT}, quantity::INTEGER) AS to_cross,
        concat_ws(',', coalesce(user_id_ix, -1), coalesce(item_id_ix, -1)) AS embed_deep_ids,
        concat_ws(',', coalesce(item_id_ix, -1)) AS embed_cross_ids
        FROM purchases LEFT JOIN ui USING (user_id) LEFT JOIN ii USING (item_id)""",
        ui=_index_sql("user_id"),
        ii=_index_sql("item_id"),
    ),
)
def routed(t):
    """Features learned from rows without returns, so the flag R and some IDs are unseen."""
    bought = written(b.purchases(t))
    blocks = scoring.feature_routes(bought.filter("flag <> 'R'"), bought, _CONTROL)
    whole = lambda c: F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",")
    ids = lambda c: F.array_join(F.transform(c, lambda x: F.coalesce(x, F.lit(-1)).cast("string")), ",")
    return blocks.select(
        "user_id", "item_id", whole("to_deep").alias("to_deep"), whole("to_cross").alias("to_cross"),
        ids("embed_deep_ids").alias("embed_deep_ids"), ids("embed_cross_ids").alias("embed_cross_ids"),
    )


# Rank 2 and two rounds: few enough numbers to solve the normal equations in SQL as well.
RANK, ROUNDS, REG = 2, 2, 0.1


def _half_step_sql(ratings: str, own: str, other: str, fixed: str) -> str:
    return f"""SELECT {own}, (c1 * a22 - c2 * a12) / (a11 * a22 - a12 * a12) AS f1, (c2 * a11 - c1 * a12) / (a11 * a22 - a12 * a12) AS f2
        FROM (SELECT {own}, sum(f1 * f1) + {REG}::DOUBLE * count(*) AS a11, sum(f1 * f2) AS a12, sum(f2 * f2) + {REG}::DOUBLE * count(*) AS a22,
                     sum(f1 * rating) AS c1, sum(f2 * rating) AS c2 FROM {ratings} JOIN {fixed} USING ({other}) GROUP BY 1)"""


def _als_sql(ratings: str) -> dict[str, str]:
    steps = {
        "v0": f"SELECT item_id, {unit(SEED, 'item_id', '0')} AS f1, {unit(SEED, 'item_id', '1')} AS f2 FROM (SELECT DISTINCT item_id FROM {ratings})"
    }
    for i in range(1, ROUNDS + 1):
        steps[f"u{i}"] = _half_step_sql(ratings, "user_id", "item_id", f"v{i - 1}")
        steps[f"v{i}"] = _half_step_sql(ratings, "item_id", "user_id", f"u{i}")
    return {name: sql if name == "v0" else f"SELECT * FROM ({sql})" for name, sql in steps.items()}


def _ratings(t):
    """Every customer's largest quantity of a part as a rating."""
    return written(b.purchases(t).select("user_id", "item_id", F.col("quantity").alias("rating")))


_RATED = "SELECT user_id, item_id, quantity AS rating FROM purchases"


@query(
    "mf_als_recommend",
    with_ctes(
        "purchases",
        f"""SELECT user_id, item_id, round(score, 6) AS predicted_rating, rank::INTEGER AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
                SELECT user_id, item_id, round(u.f1 * v.f1 + u.f2 * v.f2, 9) AS score
                FROM u{ROUNDS} u CROSS JOIN v{ROUNDS} v ANTI JOIN ratings USING (user_id, item_id))) WHERE rank <= 5""",
        ratings=_RATED,
        **_als_sql("ratings"),
    ),
)
def als_recommend(t):
    ratings = _ratings(t)
    model = learners.mf_als_fit(ratings, RANK, ROUNDS, SEED, REG)
    best = learners.mf_als_recommend(model, ratings, 5)
    return best.withColumn("predicted_rating", F.round("predicted_rating", 6))


@query(
    "predict_holdout",
    with_ctes(
        "purchases",
        f"""SELECT user_id, item_id, rating, round(coalesce(u.f1 * v.f1 + u.f2 * v.f2, um.m, im.m, (SELECT avg(rating) FROM train)), 6) AS prediction
        FROM held LEFT JOIN u{ROUNDS} u USING (user_id) LEFT JOIN v{ROUNDS} v USING (item_id)
        LEFT JOIN (SELECT user_id, avg(rating) AS m FROM train GROUP BY 1) um USING (user_id)
        LEFT JOIN (SELECT item_id, avg(rating) AS m FROM train GROUP BY 1) im USING (item_id)""",
        ratings=_RATED,
        drawn=f"""SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {unit(SEED, 'user_id', 'item_id')}, item_id) AS rn,
            count(*) OVER (PARTITION BY user_id) AS n, {unit(f'{SEED}-single', 'user_id')} < 0.5 AS heads FROM ratings""",
        train="SELECT user_id, item_id, rating FROM drawn WHERE n > 1 AND rn > 2",
        held="SELECT user_id, item_id, rating FROM drawn WHERE CASE WHEN n = 1 THEN heads ELSE rn = 1 END",
        **_als_sql("train"),
    ),
)
def als_holdout(t):
    parts = written(sampling.split_train_validate_test(_ratings(t), "user_id", ["item_id"], SEED))
    train = parts.filter("model_data_partition = 'train'")
    model = learners.mf_als_fit(train, RANK, ROUNDS, SEED, REG)
    test = parts.filter("model_data_partition = 'test'").select("user_id", "item_id", "rating")
    return learners.predict_holdout(model, test, train).withColumn("prediction", F.round("prediction", 6))


def _labelled(t):
    """(training, validation) examples with user and item attributes."""
    rows = shaping.attach_attributes(examples(t), b.users(t), "user_id")
    rows = shaping.attach_attributes(rows, b.items(t), "item_id").withColumn("bought", F.col("bought").cast("double"))
    parts = written(sampling.split_leave_one_out(written(rows), "user_id", ["example_id"], SEED))
    return parts.filter("model_data_partition = 'train'"), parts.filter("model_data_partition = 'validate'")


_CATEGORIES = ["segment", "affluence", "colour", "kind", "style", "priority", "flag"]


@query("interaction_classifier")
def wide(t):
    train, held = _labelled(t)
    scored = learners.interaction_classifier(train, held, "bought", _CATEGORIES, seed=SEED)
    return scored.select("example_id", "user_id", "item_id", "bought", "p")


@query("deep_classifier")
def deep(t):
    train, held = _labelled(t)
    scored = learners.deep_classifier(train, held, "bought", _CATEGORIES, seed=SEED)
    return scored.select("example_id", "user_id", "item_id", "bought", "p")
