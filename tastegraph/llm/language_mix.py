"""Languages of multilingual texts: mixture proportions by expectation-maximisation.

Each language has a distribution over letter trigrams (hashed to GRAMS numbers), counted over all
training texts. A text's trigrams are taken as drawn from a mixture of the languages, whose
proportions EM estimates. The set of languages is selected by penalised likelihood: sets grow in
order of their proportions, and a larger set has to gain more than 0.5 log n + GAIN * n for each
language it adds.

Letters are lower-cased, everything else counts as one blank. Null texts and texts without a
letter are ``und`` with score 0. Without any labelled training text all texts are ``und``.
Ties go to the language that comes first in the alphabet; rows that repeat get the same answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAMS = 1 << 16
ROUNDS, GAIN, SMOOTH = 15, 0.02, 0.5
_TABLE = 0x3000


def _fold_table() -> np.ndarray:
    table = np.full(_TABLE, 32, np.uint32)
    for c in range(_TABLE):
        if chr(c).isalpha():
            table[c] = ord(chr(c).lower()[0])
    return table


_fold: np.ndarray | None = None


def trigrams(text: str) -> np.ndarray:
    """Numbers of the letter trigrams, one for each place."""
    global _fold
    if _fold is None:
        _fold = _fold_table()
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), "<u4")
    low = codes < _TABLE
    folded = _fold[np.where(low, codes, 0)] if not low.all() else _fold[codes]
    if not low.all():
        folded = np.where(low, folded, codes)
    blank = folded == 32
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    f = folded[keep].astype(np.uint32)
    if len(f) < 3:
        return np.empty(0, np.int64)
    mixed = f[:-2] * np.uint32(0x9E3779B1) + f[1:-1] * np.uint32(0x85EBCA6B) + f[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(16)).astype(np.int64)


def em(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of a mixture; ``likelihood`` is distinct grams x languages."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    total = counts.sum()
    for _ in range(ROUNDS):
        share = share * (likelihood.T @ (counts / (likelihood @ share))) / total
    return share, float(counts @ np.log(likelihood @ share))


def select(likelihood: np.ndarray, counts: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The languages (by number) chosen by penalised likelihood, and their proportions."""
    total = float(counts.sum())
    single = counts @ np.log(likelihood)
    chosen, share, best = [int(single.argmax())], np.ones(1), float(single.max())
    price = 0.5 * np.log(total) + GAIN * total
    full, most = em(likelihood, counts)
    if most - best <= price:  # no set can be worth another language
        return chosen, share
    order = np.argsort(-full, kind="stable")
    for size in range(2, len(order) + 1):
        if most - (size - 1) * price <= best:
            break
        some = sorted(order[:size])
        own, reached = em(likelihood[:, some], counts)
        if reached - (size - 1) * price > best:
            chosen, share, best = [int(s) for s in some], own, reached - (size - 1) * price
    return chosen, share


def learn(texts: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, distribution of each over the grams) from all texts with a language.

    Tasks add up their grams first. The model has GRAMS numbers for each language.
    """

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in held:
                    held[lang] = np.zeros(GRAMS, np.int64)
                held[lang] += np.bincount(trigrams(text), minlength=GRAMS)
        for lang, counts in held.items():
            grams = np.flatnonzero(counts)
            arrays = [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(counts[grams], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "gram", "n"])

    rows = texts.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    found = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.full((len(langs), GRAMS), SMOOTH)
    for i, lang in enumerate(langs):
        own = found[found["lang"] == lang]
        counts[i, own["gram"].to_numpy()] += own["n"].to_numpy()
    return langs, (counts / counts.sum(axis=1, keepdims=True) if langs else counts).T


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, langs, shares): the main language, its proportion, and the mixture."""
    sent = docs.sparkSession.sparkContext.broadcast((model[0], model[1].astype(np.float64)))

    def one(text, langs, likelihood):
        if not langs or not text or not any(map(str.isalpha, text)):
            return "und", 0.0, [], []
        grams = trigrams(text)
        if not len(grams):
            return "und", 0.0, [], []
        counts = np.bincount(grams, minlength=GRAMS)
        held = np.flatnonzero(counts)
        chosen, share = select(likelihood[held], counts[held].astype(np.float64))
        top = int(share.argmax())
        return langs[chosen[top]], float(min(1.0, share[top])), [langs[c] for c in chosen], share.tolist()

    def run(batches):
        langs, likelihood = sent.value
        for batch in batches:
            out = [one(text, langs, likelihood) for text in batch.column(1).to_pylist()]
            pred, score, names, shares = zip(*out) if out else ((), (), (), ())
            arrays = [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            arrays += [pa.array(names, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "lang_pred", "score", "langs", "shares"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double, langs array<string>, shares array<double>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
