"""Shaping, sampling and partition queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tastegraph.operators import sampling, shaping
from tastegraph.plans import bindings as b
from tastegraph.plans.bindings import SEED, unit, with_ctes
from tastegraph.session import shared_folder, written
from tastegraph.sources.catalog import Tables, csv_catalog_scan

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _described(t):
    """Documents with the three nullable text fields of a catalogue."""
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("title"),
        F.col("text").alias("description"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("categories"),
    )


_DESCRIBED_SQL = """SELECT d.doc_id, source AS title, text AS description, 'quality ' || quality AS categories
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query("csv_catalog_scan", _DESCRIBED_SQL)
def csv_scan(t):
    path = f"{shared_folder(t.spark)}/catalog-{uuid.uuid4().hex}"
    _described(t).write.option("header", True).option("escape", '"').csv(path)
    schema = StructType(
        [StructField("doc_id", LongType())]
        + [StructField(c, StringType()) for c in ("title", "description", "categories")]
    )
    return csv_catalog_scan(t.spark, path, schema)


@query(
    "union_by_name",
    """SELECT topic, last_update, date_added, resources FROM (
        SELECT 'order ' || o_orderkey AS topic, strftime(o_orderdate, '%Y-%m-%d') AS last_update,
               strftime(o_orderdate, '%Y-%m') AS date_added, o_orderpriority AS resources FROM orders
        UNION ALL
        SELECT 'line ' || l_orderkey || ' ' || l_linenumber || ' ' || l_partkey,
               strftime(l_shipdate, '%Y-%m-%d'), strftime(l_shipdate, '%Y-%m'), NULL FROM lineitem
    ) ORDER BY last_update DESC, topic DESC""",
)
def stacked(t):
    orders = t.orders.select(
        F.concat_ws(" ", F.lit("order"), "o_orderkey").alias("topic"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_update"),
        F.date_format("o_orderdate", "yyyy-MM").alias("date_added"),
        F.col("o_orderpriority").alias("resources"),
    )
    lines = t.lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("last_update"),
        F.concat_ws(" ", F.lit("line"), "l_orderkey", "l_linenumber", "l_partkey").alias("topic"),
        F.date_format("l_shipdate", "yyyy-MM").alias("date_added"),
    )
    return shaping.union_by_name(
        [orders, lines], ["last_update", "topic"], ["topic", "last_update", "date_added", "resources"]
    )


def _numbered_events(t):
    return shaping.number_transactions(b.event_log(t), "user_id", ["ts", "event_id"], F.to_date("ts"))


_LOG_FIELDS = ["event_id", "event_type", "value"]
_NUMBERED_SQL = """SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS transaction_num,
    event_id, event_type, value FROM events"""


@query("explode_interaction_log", _NUMBERED_SQL)
def exploded_log(t):
    nested = shaping.collect_interaction_log(_numbered_events(t), "user_id", _LOG_FIELDS, segment_rows=100)
    return shaping.explode_interaction_log(nested, "user_id", _LOG_FIELDS, segment_rows=100)


@query(
    "collect_interaction_log",
    f"""SELECT user_id, (transaction_num - 1) // 100 AS segment, count(*) AS n,
        string_agg(event_id || ':' || event_type, ',' ORDER BY transaction_num) AS log
        FROM ({_NUMBERED_SQL}) GROUP BY 1, 2""",
)
def nested_log(t):
    nested = shaping.collect_interaction_log(_numbered_events(t), "user_id", _LOG_FIELDS, segment_rows=100)
    entry = F.transform("log", lambda e: F.concat_ws(":", e["event_id"].cast("string"), e["event_type"]))
    return nested.select(
        "user_id", "segment", F.size("log").cast("bigint").alias("n"), F.array_join(entry, ",").alias("log")
    )


_ITEM_ATTRS = ["colour", "kind", "brand", "style"]


@query("project_attributes", with_ctes("items", "SELECT * FROM items"))
def projected(t):
    entries = [x for a in _ITEM_ATTRS for x in (F.lit(a), F.col(a))]
    nested = b.items(t).select("item_id", F.create_map(*entries).alias("attrs"))
    return shaping.project_attributes(nested, "item_id", _ITEM_ATTRS, "attrs")


@query("pivot_attributes", with_ctes("users", "SELECT * FROM users"))
def pivoted(t):
    names = ["location", "segment", "affluence"]
    return shaping.pivot_attributes(shaping.melt_attributes(b.users(t), "user_id", names), "user_id", names)


@query(
    "fill_concat_text",
    f"""SELECT doc_id, coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(categories, '')
        AS all_product_text FROM ({_DESCRIBED_SQL})""",
)
def concatenated(t):
    text = shaping.fill_concat_text(_described(t), ["title", "description", "categories"])
    return text.select("doc_id", "all_product_text")


@query(
    "add_example_id",
    with_ctes(
        "pairs",
        """SELECT user_id, item_id,
        row_number() OVER (ORDER BY md5(concat_ws('|', user_id, item_id)), user_id, item_id) - 1 AS example_id
        FROM pairs""",
    ),
)
def example_ids(t):
    return shaping.add_example_id(written(b.pairs(t)), ["user_id", "item_id"])


_ORDERING_USERS = """SELECT o_custkey AS user_id, row_number() OVER (ORDER BY md5(o_custkey::VARCHAR)) - 1 AS idx
    FROM (SELECT DISTINCT o_custkey FROM orders)"""


@query("dense_index", f"SELECT c_custkey AS user_id, coalesce(idx, -1) AS idx FROM customer LEFT JOIN ({_ORDERING_USERS}) ON c_custkey = user_id")
def indexed(t):
    fitted = shaping.dense_index(t.orders.select(F.col("o_custkey").alias("user_id")), "user_id")
    coded = shaping.apply_index(t.customer.select(F.col("c_custkey").alias("user_id")), fitted, "user_id")
    return coded.withColumn("idx", F.coalesce("idx", F.lit(-1)))


@query(
    "one_hot_encode",
    """WITH fitted AS (SELECT DISTINCT source, lang FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
    SELECT doc_id, 'source_' || source AS feature FROM documents WHERE source IN (SELECT source FROM fitted)
    UNION ALL SELECT doc_id, 'lang_' || lang FROM documents WHERE lang IN (SELECT lang FROM fitted)""",
)
def one_hot(t):
    train = t.documents.join(t.labels.filter("toxic = 1"), "doc_id", "left_semi").select("source", "lang")
    frame, names = shaping.one_hot_encode(train, t.documents.select("doc_id", "source", "lang"), ["source", "lang"])
    return shaping.one_hot_rows(frame, "doc_id", names)


@query(
    "attach_attributes",
    with_ctes(
        "pairs users items",
        """SELECT user_id, item_id, location, segment, affluence, colour, kind, brand, style
        FROM pairs LEFT JOIN users USING (user_id) LEFT JOIN items USING (item_id)""",
    ),
)
def attached(t):
    with_users = shaping.attach_attributes(b.pairs(t), b.users(t), "user_id")
    return shaping.attach_attributes(with_users, b.items(t), "item_id")


@query(
    "left_join_flag",
    with_ctes(
        "pairs",
        """SELECT user_id, item_id, CASE WHEN (user_id, item_id) IN (
            SELECT (o_custkey, l_partkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')
        THEN 1 ELSE 0 END::INTEGER AS returned FROM pairs""",
    ),
)
def flagged(t):
    marks = b.lines(t).filter("l_returnflag = 'R'").select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    )
    return shaping.left_join_flag(b.pairs(t), marks, ["user_id", "item_id"], "returned")


@query(
    "join_partition_label",
    """WITH picked AS (SELECT user_id, max(event_id) AS event_id, 'validate' AS model_data_partition
        FROM events GROUP BY user_id)
    SELECT user_id, event_id, event_type, coalesce(model_data_partition, 'train') AS model_data_partition
    FROM events LEFT JOIN picked USING (user_id, event_id)""",
)
def partition_label(t):
    rows = t.events.select("user_id", "event_id", "event_type")
    latest = rows.groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return shaping.join_partition_label(
        rows, latest.withColumn("model_data_partition", F.lit("validate")), ["user_id", "event_id"]
    )


_CANDIDATES_SQL = """SELECT c_custkey AS user_id, p.line FROM customer CROSS JOIN product_lines p
    WHERE NOT EXISTS (SELECT 1 FROM line_purchases s WHERE s.user_id = c_custkey AND s.line = p.line)"""


def _candidates(t):
    buyers = t.customer.select(F.col("c_custkey").alias("user_id"))
    return shaping.candidate_items(buyers, b.product_lines(t), b.line_purchases(t), "user_id", "line")


@query("candidate_items", with_ctes("product_lines line_purchases", _CANDIDATES_SQL))
def candidates(t):
    return _candidates(t)


_CONTEXT_SQL = f"""SELECT o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m') AS month
    FROM orders ORDER BY {unit(SEED, 'o_orderkey')}, o_orderkey LIMIT 1"""


@query(
    "attach_context",
    with_ctes(
        "product_lines line_purchases",
        f"SELECT user_id, line, priority, month FROM ({_CANDIDATES_SQL}) CROSS JOIN ctx",
        ctx=_CONTEXT_SQL,
    ),
)
def with_context(t):
    context = sampling.random_rows(t.orders, ["o_orderkey"], 1, SEED).select(
        F.col("o_orderpriority").alias("priority"), F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    return shaping.attach_context(_candidates(t), context, ["priority", "month"])


@query(
    "basket_sets",
    """WITH kept AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag <> 'R')
    SELECT o_orderkey AS basket_id, count(p_brand) AS n_items, coalesce(string_agg(p_brand, ',' ORDER BY p_brand), '') AS items
    FROM orders LEFT JOIN kept ON o_orderkey = l_orderkey GROUP BY 1""",
)
def baskets(t):
    sets = b.order_baskets(t, "l_returnflag <> 'R'")
    return sets.select(
        "basket_id", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", ",").alias("items")
    )


_BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query(
    "basket_matrix",
    "SELECT c_custkey AS user_id, "
    + ", ".join(
        f"coalesce(max(CASE WHEN p_brand = '{x}' THEN 1 ELSE 0 END), 0)::INTEGER AS \"item_{x}\"" for x in _BRANDS
    )
    + """ FROM customer LEFT JOIN (orders JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity >= 40
        JOIN part ON l_partkey = p_partkey) ON o_custkey = c_custkey GROUP BY 1""",
)
def matrix(t):
    bought = b.lines(t).join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("p_brand").alias("item"), "l_quantity"
    )
    buyers = t.customer.select(F.col("c_custkey").alias("user_id"))
    return shaping.basket_matrix(buyers, bought, "user_id", "item", _BRANDS, F.col("l_quantity") >= 40)


_LARGE_SQL = "SELECT o_custkey FROM orders WHERE o_totalprice > 400000"


@query(
    "drop_inactive_users",
    with_ctes(
        "users",
        f"""SELECT user_id, location, segment, affluence,
        (SELECT count(*) FROM users WHERE user_id NOT IN ({_LARGE_SQL})) AS n_dropped
        FROM users WHERE user_id IN ({_LARGE_SQL})""",
    ),
)
def active_users(t):
    large = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("user_id"))
    kept, dropped = shaping.drop_inactive_users(b.users(t), large, "user_id")
    return kept.withColumn("n_dropped", dropped.scalar())


@query(
    "restrict_to_ids",
    with_ctes("pairs", "SELECT * FROM pairs WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"),
)
def restricted(t):
    debtors = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return shaping.restrict_to_ids(b.pairs(t), debtors, "user_id")


_GRID_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_discount + 0.0 AS discount,
    (l_quantity * 2 - 1)::INTEGER AS x1, (p_size * 2 - 1)::INTEGER AS x2 FROM lineitem JOIN part ON l_partkey = p_partkey"""


@query(
    "grid_bucket_lookup",
    f"""WITH grid AS ({_GRID_SQL}),
    cells AS (SELECT (x1 // 25)::INTEGER AS qx, (x2 // 25)::INTEGER AS qy, round(avg(discount), 6) AS prob FROM grid GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_partkey, qx, qy, prob FROM grid JOIN cells ON x1 // 25 = qx AND x2 // 25 = qy""",
)
def grid_cells(t):
    grid = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") + 0.0).alias("discount"),
        (F.col("l_quantity") * 2 - 1).cast("int").alias("x1"), (F.col("p_size") * 2 - 1).alias("x2"),
    )
    cells = grid.groupBy(
        F.floor(F.col("x1") / 25).cast("int").alias("qx"), F.floor(F.col("x2") / 25).cast("int").alias("qy")
    ).agg(F.round(F.avg("discount"), 6).alias("prob"))
    found = shaping.grid_bucket_lookup(grid, cells, "x1", "x2")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "qx", "qy", "prob")


@query(
    "category_range_stats",
    "SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1",
)
def ranges(t):
    return shaping.category_range_stats(t.orders, "o_orderpriority", "o_totalprice")


@query(
    "user_response_rate",
    """SELECT user_id, count(*) AS n_obs,
    round((sum(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) + 1.0::DOUBLE) / (count(*) + 2.0::DOUBLE), 6) AS rate
    FROM events GROUP BY 1""",
)
def response_rate(t):
    observed = t.events.select("user_id", (F.col("event_type") == "purchase").cast("int").alias("y"))
    rates = shaping.user_response_rate(observed, "user_id", "y", alpha=2.0)
    return rates.withColumn("rate", F.round("rate", 6))


@query(
    "shuffle_rows",
    f"""SELECT event_id, event_type, value, row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', event_id)), event_id) - 1
    AS row_pos FROM events""",
)
def shuffled(t):
    return sampling.shuffle_rows(t.events.select("event_id", "event_type", "value"), ["event_id"], SEED)


@query(
    "bernoulli_sample",
    with_ctes(
        "purchases",
        f"""SELECT user_id, item_id, quantity / 50.0::DOUBLE AS p,
        ({unit(SEED, 'user_id', 'item_id')} < quantity / 50.0::DOUBLE)::INTEGER AS bought FROM purchases""",
    ),
)
def bernoulli(t):
    offers = b.purchases(t).select("user_id", "item_id", (F.col("quantity") / 50.0).alias("p"))
    return sampling.bernoulli_sample(offers, "p", ["user_id", "item_id"], SEED)


@query(
    "group_sample_k",
    with_ctes(
        "pairs",
        f"""SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY {unit(SEED, 'user_id', 'item_id')}, item_id) AS rn FROM pairs)
        WHERE rn <= floor(1 + {unit(f'{SEED}-k', 'user_id')} * 19)""",
    ),
)
def sampled_k(t):
    return sampling.group_sample_k(b.pairs(t), "user_id", ["item_id"], 1, 19, SEED)


def _negatives_sql(source: str, key: str) -> dict[str, str]:
    return {
        "indexed": "SELECT item_id, row_number() OVER (ORDER BY md5(item_id::VARCHAR)) - 1 AS idx FROM items",
        "bought": "SELECT user_id, count(*) AS m FROM pairs GROUP BY 1",
        "unseen": """SELECT u.user_id, i.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY idx) - 1 AS nth
            FROM bought u CROSS JOIN indexed i ANTI JOIN pairs s ON s.user_id = u.user_id AND s.item_id = i.item_id""",
        "negatives": f"""SELECT d.user_id, n.item_id, d.item_id AS pos_item, d.priority, d.flag
            FROM (SELECT p.*, floor({unit(SEED, key)} * ((SELECT count(*) FROM indexed) - m))::BIGINT AS nth
                  FROM {source} p JOIN bought USING (user_id)) d
            JOIN unseen n ON n.user_id = d.user_id AND n.nth = d.nth""",
    }


@query(
    "negative_sample",
    with_ctes(
        "purchases pairs items",
        "SELECT user_id, item_id, priority, flag FROM negatives",
        **_negatives_sql("purchases", "concat_ws('|', p.user_id, p.item_id)"),
    ),
)
def negatives(t):
    positives = written(b.purchases(t)).withColumn("pos", F.concat_ws("|", "user_id", "item_id"))
    drawn = sampling.negative_sample(positives, b.items(t).select("item_id"), "user_id", "item_id", ["pos"], SEED)
    return drawn.select("user_id", "item_id", "priority", "flag")


def examples(t):
    return sampling.training_examples(
        b.purchases(t), b.items(t).select("item_id"), "user_id", "item_id", ["priority", "flag"],
        ["user_id", "item_id"], SEED,
    )


@query(
    "training_examples",
    with_ctes(
        "purchases pairs items",
        """SELECT user_id, item_id, priority, flag, bought,
        row_number() OVER (ORDER BY md5(concat_ws('|', src, bought)), src, bought) - 1 AS example_id
        FROM (SELECT user_id, item_id, priority, flag, concat_ws('|', user_id, item_id) AS src, 1::INTEGER AS bought FROM purchases
              UNION ALL SELECT user_id, item_id, priority, flag, concat_ws('|', user_id, pos_item), 0::INTEGER FROM negatives)""",
        **_negatives_sql("purchases", "p.user_id, p.item_id"),
    ),
)
def example_rows(t):
    return examples(t)


_EVENT_DRAW = f"""SELECT user_id, event_id, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY {unit(SEED, 'user_id', 'event_id')}, event_id) AS rn,
    count(*) OVER (PARTITION BY user_id) AS n FROM events"""


def _log(t):
    return t.events.select("user_id", "event_id", "event_type")


@query(
    "split_train_validate_test",
    f"""WITH drawn AS ({_EVENT_DRAW})
    SELECT user_id, event_id, event_type, CASE
        WHEN n = 1 THEN CASE WHEN {unit(f'{SEED}-single', 'user_id')} < 0.5 THEN 'test' ELSE 'validate' END
        WHEN rn = 1 THEN 'test' WHEN rn = 2 THEN 'validate' ELSE 'train' END AS model_data_partition FROM drawn""",
)
def three_way_split(t):
    return sampling.split_train_validate_test(_log(t), "user_id", ["event_id"], SEED)


@query(
    "split_leave_one_out",
    f"""WITH drawn AS ({_EVENT_DRAW})
    SELECT user_id, event_id, event_type, CASE WHEN n > 1 AND rn = 1 THEN 'validate' ELSE 'train' END
    AS model_data_partition FROM drawn""",
)
def leave_one_out(t):
    return sampling.split_leave_one_out(_log(t), "user_id", ["event_id"], SEED)
