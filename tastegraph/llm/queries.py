"""The operators of this subpackage, each applied to its whole table, and SQL where there is one."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import bpe_automaton, exact_dedup, jaccard_join, language_mix, mixing, periodic_runs, quality, secrets, token_files, topk_blocks, toxicity, url_filter, whitening
from tastegraph.llm.common import crc32_mod, table
from tastegraph.session import drop_at_exit, shared_folder


def tokenizer_definition(name: str = "word_bpe_49k.json") -> str:
    """Content of a tokenizer file that the driver can read."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_topk_blocks(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk_blocks.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op2_language_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc32_mod("doc_id", 3) == 1
    model = language_mix.learn(docs.filter(~held_out))
    return language_mix.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "langs", "shares")


# Targets of the mixture: each margin's present tokens to this power.
MIX_POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
# Share of the present tokens that the pipeline's mixture keeps.
MIX_BUDGET = 0.5


def mix_margins() -> dict:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.length_topic(mixing.token_count(F.col("text")))}


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix_report(table(spark, folder, "documents"), mix_margins(), MIX_POWERS)
    return found.withColumn("weight", F.round("weight", 6)).withColumn("probability", F.round("probability", 6))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.similar_documents(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc32_mod("doc_id", 5) == 0
    model = toxicity.train(docs, table(spark, folder, "labels"), ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_automaton.digests(table(spark, folder, "documents"), tokenizer_definition())


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.withColumnRenamed("id", "doc_id").drop("hash", "len")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(table(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    drop_at_exit(spark, path)
    token_files.write_ids(table(spark, folder, "documents"), tokenizer_definition(), path, end_id=1)
    return token_files.read_ids(spark, path, digests_only=True).withColumnRenamed("id", "doc_id")


# The rules of the contract (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in URL_RULES])
    rules = spark.range(1).select(F.inline(listed))
    return url_filter.verdicts(table(spark, folder, "pages"), rules)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"), k=32)
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


def looped_text(doc_id: Column, text: Column) -> Column:
    """The contract's texts: of one ID in ten the words from the a-th on repeat with period p."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def looped(words):
        n = F.size(words).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("bigint")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        again = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(words, place(i)))
        return F.when(n > 0, F.array_join(again, " "))

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # the words are made once, as the only element of an array
    return F.when(h % 10 != 0, text).otherwise(F.get(F.transform(F.array(words), looped), F.lit(0)))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", looped_text(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.digests(docs)


QUERIES = {
    "op1_topk_blocks": op1_topk_blocks,
    "op8_quality": op8_quality,
    "op9_secrets": op9_secrets,
    "op10_token_files": op10_token_files,
    "op2_language_mix": op2_language_mix,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_bpe_automaton": op7_bpe_automaton,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

def _secrets_sql() -> str:
    """The rules run over every text: gaps and matches in turn give the offsets."""

    def quoted(rule):
        return "'" + (("(?i)" if rule.ignore_case else "") + rule.pattern).replace("'", "''") + "'"

    parts = " UNION ALL ".join(
        f"""
        SELECT doc_id, {i} AS kind, '{r.kind}' AS name, {r.least} AS least, {str(r.base).lower()} AS base,
               generate_subscripts(gaps, 1) AS no, unnest(gaps) AS gap, unnest(matches) AS found, unnest(vals) AS val
        FROM (SELECT doc_id, string_split_regex(text, {quoted(r)}) AS gaps,
                     regexp_extract_all(text, {quoted(r)}) AS matches,
                     regexp_extract_all(text, {quoted(r)}, {r.group}) AS vals
              FROM documents WHERE text IS NOT NULL)
        """
        for i, r in enumerate(secrets.RULES)
    )
    counts = ", ".join(f"count(*) FILTER (name = '{r.kind}') AS n_{r.kind}" for r in secrets.RULES if r.base)
    return f"""
        WITH p AS ({parts}),
        ends AS (
            SELECT *, CAST(sum(length(gap) + coalesce(length(found), 0))
                OVER (PARTITION BY doc_id, kind ORDER BY no) AS BIGINT) AS stop FROM p),
        m AS (SELECT *, stop - length(found) AS start, name || ':' || (stop - length(found)) || ':' || stop AS span
              FROM ends WHERE found IS NOT NULL AND length(val) >= least),
        g AS (
            SELECT doc_id, {counts},
                   coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (base), '') AS own,
                   string_agg(span, ',' ORDER BY start, kind) AS spans
            FROM m GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES if r.base)},
               sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN g USING (doc_id)
    """


def _mixing_sql() -> str:
    """The rounds of raking, written out."""
    steps, last = [], "c0"
    for step in range(mixing.ROUNDS * len(MIX_POWERS)):
        margin = list(MIX_POWERS)[step % len(MIX_POWERS)]
        held = f"sum(weight) OVER (PARTITION BY {margin})"
        steps.append(f"""c{step + 1} AS (
            SELECT c.* REPLACE (CASE WHEN {held} > 0 THEN weight * coalesce(share, 0) / {held} ELSE 0 END AS weight)
            FROM {last} c LEFT JOIN t_{margin} USING ({margin}))""")
        last = f"c{step + 1}"
    goals = ", ".join(
        f"""t_{m} AS (SELECT {m}, target / sum(target) OVER () AS share FROM (
            SELECT {m}, pow(CAST(sum(base) AS DOUBLE), {p}) AS target FROM c0 GROUP BY {m} HAVING sum(base) > 0))"""
        for m, p in MIX_POWERS.items()
    )
    return f"""
        WITH words AS (
            SELECT doc_id, coalesce('=' || source, '') AS source, coalesce('=' || lang, '') AS lang,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens FROM documents),
        d AS (SELECT *, CASE WHEN tokens < 200 THEN '=short' WHEN tokens < 800 THEN '=medium' ELSE '=long' END AS topic FROM words),
        c0 AS (SELECT source, lang, topic, sum(tokens) AS base, CAST(sum(tokens) AS DOUBLE) AS weight FROM d GROUP BY ALL),
        {goals}, {", ".join(steps)},
        r AS (SELECT source, lang, topic, CASE WHEN base > 0 THEN weight * (SELECT sum(base) FROM c0) / base END AS ratio FROM {last}),
        p AS (SELECT *, coalesce(ratio / (SELECT max(ratio) FROM r), 1) AS chance FROM r)
        SELECT doc_id, CAST(tokens AS BIGINT) AS tokens, round(coalesce(ratio, 0), 6) AS weight, round(chance, 6) AS probability,
               CAST('0x' || substr(md5('mix3|' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 < chance AS kept
        FROM d JOIN p USING (source, lang, topic)
    """


NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_topk_blocks": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 5
    """,
    "op5_jaccard_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({NORMAL}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4])
                     WHEN len(words) > 0 THEN [words] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
            WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
    """,
    "op9_secrets": _secrets_sql(),
    "op3_mixing": _mixing_sql(),
    "op11_url_filter": f"""
        WITH u AS (SELECT row_number() OVER () AS no, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        p AS (
            SELECT no, page_id, {NORMAL.replace("text", "regexp_extract(rest, '^[^/?#]*')")} AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
        r(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
        j AS (
            SELECT no, page_id, host, path, rule_host || rule_path AS rule, r.verdict
            FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            QUALIFY row_number() OVER (PARTITION BY no ORDER BY length(rule) DESC NULLS LAST, length(rule_host) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j
    """,
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {NORMAL} AS normal FROM documents)
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               CAST(count(*) OVER same AS BIGINT) AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(normal) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY normal)
    """,
}
