"""Quality of documents: hierarchical empirical Bayes over documents, hosts and paths.

1. A document classifier (logistic regression on the form of the text: repetition, symbols,
   capitals, word shapes) gives each document its evidence, the log-odds less the prior's.
   It is fitted on at most LABELLED labelled rows, those with the smallest hashes of their IDs.
2. Grouped aggregation adds the documents' probabilities up for hosts and paths. A host's rate
   is shrunk toward the global one, a path's rate toward its host's. The strength of either
   prior comes from the variance between the groups (method of moments), so a site of few
   documents follows its parent. A document is left out of its own site's rates.
3. A document's posterior log-odds are its evidence plus those of its path's rate.

Null texts count as empty; a null host or path is a value of its own. Labels that are null are no
labels; of several for an ID the largest counts. If the labelled rows are of one class or there
are none, the evidence is zero and every posterior is the prior (0.5 without labels). Rows that
repeat are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import attach_left, handing_back, without
from tastegraph.session import written

LABELLED = 20_000
RIDGE, STEPS = 1.0, 30
# Prior strengths (in documents) stay in this range.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
NAMES = [
    "words", "distinct", "distinct_words", "symbols", "repeated_signs", "bangs", "pipes", "capitals", "digits",
    "other_letters", "word_length", "top_word", "short_words", "distinct_lines", "line_words", "ends",
]
_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_DIGIT = bytes(set(range(256)) - set(range(48, 58)))
_SIGNS = re.compile(r"[#$%&*@^~|<>{}\\_=+\[\]]")
_DOUBLED = re.compile(r"([^\w\s])\1")


def features(text: str | None) -> list[float]:
    """Numbers on the form of a text; they do not depend on what it is about."""
    text = text or ""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    raw = text.encode("utf-8", "replace")
    lines = [line for line in text.split("\n") if line]
    distinct = len(set(words)) / n
    return [
        np.log1p(len(words)),
        distinct,
        distinct * np.log1p(len(words)),
        len(_SIGNS.findall(text)) / n,
        len(_DOUBLED.findall(text)) / n,
        text.count("!") / n,
        text.count("|") / n,
        len(raw.translate(None, _UPPER)) / size,
        len(raw.translate(None, _DIGIT)) / size,
        (len(raw) - len(text)) / size,
        min(30.0, len(text) / n),
        (Counter(words).most_common(1)[0][1] if words else 0) / n,
        sum([len(w) <= 3 for w in words]) / n,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        (text.count(".") + text.count("?")) / n,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with intercept last, mean, scale) of a ridge logistic regression by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([expand((x - mean) / scale), np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, scale


def expand(z: np.ndarray) -> np.ndarray:
    """Standardised features within +-6, and their squares."""
    z = np.clip(z, -6, 6)
    return np.hstack([z, z * z])


def _measured(docs: DataFrame, text_col: str, id_col: str, host: Column, path: Column) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = pa.array([features(t.as_py()) for t in batch.column(5)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(5)], rows], ["id", "hash", "len", "host", "path", "x"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    named = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("len"),
        named(host).alias("host"), F.concat_ws("/", named(host), named(path)).alias("path"), text.alias("text"),
    )
    return rows.mapInArrow(handing_back(run), f"id {kind}, hash long, len int, host string, path string, x array<double>")


def _evidence(measured: DataFrame, model) -> DataFrame:
    if model is None:
        return measured.withColumn("evidence", F.lit(0.0)).drop("x")
    weights, mean, scale, prior = model
    schema = f"id {measured.schema['id'].dataType.simpleString()}, hash long, len int, host string, path string, evidence double"

    def run(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(mean))
            odds = expand((x - mean) / scale) @ weights[:-1] + weights[-1] - np.log(prior / (1 - prior))
            own = [batch.column(c) for c in ("id", "hash", "len", "host", "path")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.clip(odds, -30, 30), pa.float64())], ["id", "hash", "len", "host", "path", "evidence"])

    return measured.mapInArrow(run, schema)


def _rates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(f"{key}_n"), F.sum("p").alias(f"{key}_sum"))


def _strength(groups: DataFrame, key: str, mean: float) -> float:
    """Prior strength in documents: large if the groups' rates differ no more than by chance."""
    n, rate = F.col(f"{key}_n"), F.col(f"{key}_sum") / F.col(f"{key}_n")
    weighted, total, squares, count = groups.agg(
        F.sum(n * (rate - mean) * (rate - mean)), F.sum(n), F.sum(n * n.cast("double")), F.count(F.lit(1))
    ).head()
    if not total or count < 2:
        return MOST_STRENGTH
    noise = mean * (1 - mean)
    between = (weighted - (count - 1) * noise) / max(1e-9, total - squares / total)
    return MOST_STRENGTH if between <= 0 else float(np.clip(noise / between - 1, LEAST_STRENGTH, MOST_STRENGTH))


def score(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    host: Column | None = None,
    path: Column | None = None,
) -> DataFrame:
    """(id, hash, len, host_rate, path_rate, evidence, posterior, kept) of every row of ``docs``.

    ``host`` and ``path`` default to the columns source and lang. ``kept``: posterior >= 0.5.
    """
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    measured = written(_measured(docs, text_col, id_col, host, path))
    own = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).alias("label"))
    )
    known = measured.join(own, "id").select("x", "label", F.xxhash64("id").alias("o"))
    if (n := known.select("label").count()) > 2 * LABELLED:  # so that no task ships LABELLED rows of its own
        known = known.filter(F.col("o") < F.lit(round(2.0**64 * 1.5 * LABELLED / n) - (1 << 63)))
    sample = known.orderBy("o", "x").limit(LABELLED).toPandas()
    y = sample["label"].to_numpy(float) if len(sample) else np.empty(0)
    prior = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    model = None
    if len(y) and y.min() < y.max():
        model = (*fit_logistic(np.stack(sample["x"].to_numpy()), (y > 0).astype(float)), prior)
    start = float(np.log(prior / (1 - prior)))
    rows = written(_evidence(measured, model)).withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + start))))
    hosts, paths = written(_rates(rows, "host")), written(_rates(rows, "path"))
    total, good = hosts.agg(F.sum("host_n"), F.sum("host_sum")).head()
    mean = float(np.clip(good / total, 0.001, 0.999)) if total else prior
    host_strength, path_strength = _strength(hosts, "host", mean), _strength(paths, "path", mean)
    found = attach_left(attach_left(rows, hosts, "host", "host_n"), paths, "path", "path_n")
    host_rate = (F.col("host_sum") - F.col("p") + host_strength * mean) / (F.col("host_n") - 1 + host_strength)
    path_rate = (F.col("path_sum") - F.col("p") + path_strength * F.col("host_rate")) / (F.col("path_n") - 1 + path_strength)
    rate = F.least(F.greatest(F.col("path_rate"), F.lit(1e-4)), F.lit(1 - 1e-4))
    odds = F.col("evidence") + F.log(rate / (1 - rate))
    return (
        found.withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .select("id", "hash", "len", "host_rate", "path_rate", "evidence", "posterior", (F.col("posterior") >= 0.5).alias("kept"))
    )


def filter_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with their columns."""
    rejected = written(score(docs, labels, text_col, id_col, **options).filter("NOT kept").select("id", "hash", "len"))
    return without(docs, rejected, text_col, id_col)
