"""Toxicity scores by non-negative positive-unlabelled (nnPU) learning.

Confirmed toxic texts are the positives; all training texts together are the unlabelled set,
a sample of the marginal distribution. A linear classifier over words and word beginnings is
trained in numpy on the class-prior-corrected risk

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)),

whose negative part may not fall below zero: where it does, the step goes the other way.

Vocabulary: every feature of the positives is counted in them and in all training texts; the
FEATURES whose rates differ most are taken, by DIFFERENT standard errors at least. There is no
frequency cut. Words and beginnings that no positive holds are passed over by a filter of fixed
size, and tasks count before the shuffle. The fit itself uses at most POSITIVES positives and UNLABELLED texts, those with the smallest hashes
of their IDs (a documented bound; the scores cover every row).

A null text counts as empty and gets the classifier's intercept. Labels that are null are no
labels; of several labels for an ID the largest counts. Without any positive, every score is
the prior. Rows that repeat are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import FILTER_BITS, in_filter, key_filter
from tastegraph.session import written

FEATURES, BEGINNINGS = 1_000, (4, 5, 6, 7, 8)
# Standard errors between a feature's rates in positives and in all texts to count as different.
DIFFERENT = 2.0
POSITIVES, UNLABELLED = 4_000, 16_000
STEPS, RATE, RIDGE = 300, 0.05, 1e-3
# Distinct words whose features a task keeps, and their characters; then it starts anew.
KEPT_WORDS, KEPT_CHARS = 200_000, 8_000_000
# Distinct stems that a task counts before it hands its counts on.
COUNTED_STEMS = 300_000
# Words of whole texts whose stems are counted at once.
SLICE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


class Finder:
    """Features of a text: its words, and how many of its distinct words share a beginning.

    ``=word`` is a word held; ``beg#n`` says that at least n (1 to 3) distinct words begin with
    ``beg`` (of a length in BEGINNINGS). With ``known``, only those features are looked for; with
    ``among``, those that ``stem_bits`` may mean.
    """

    def __init__(self, known=None, among: bytes | None = None):
        self.among = among
        self.known = None if known is None else frozenset(known)
        self.stems = None if known is None else {f if f[0] == "=" else f[:-2] for f in known}
        self.kept: dict[str, tuple] = {}

    def _of_word(self, word: str) -> tuple:
        found = self.kept.get(word)
        if found is None:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            found = stems_of_word(word)
            if self.stems is not None:
                found = tuple(f for f in found if f in self.stems)
            if self.among is not None:
                found = tuple(f for f in found if self._may_be(f))
            if len(word) <= 64:
                self.kept[word] = found
        return found

    def _may_be(self, stem: str) -> bool:
        # Bit 0 of key_filter has no place of its own: it passes.
        place = zlib.crc32(stem.encode()) % FILTER_BITS - 1
        return place < 0 or bool(self.among[place >> 3] >> (place & 7) & 1)

    def stems_of(self, text: str | None) -> Counter:
        """Words (``=word``) and beginnings of a text, each with how many distinct words have it."""
        words = set(_WORD.findall(text.lower())) if text else ()
        return Counter(chain.from_iterable([self._of_word(word) for word in words]))

    def __call__(self, text: str | None) -> list[str]:
        counts = self.stems_of(text)
        out = [f for f in counts if f[0] == "="]
        out += [f"{f}#{n}" for f, c in counts.items() if f[0] != "=" for n in range(1, min(c, 3) + 1)]
        return sorted(out if self.known is None else self.known.intersection(out))


def stems_of_word(word: str) -> tuple[str, ...]:
    return ("=" + word, *(word[:n] for n in BEGINNINGS if len(word) >= n))


class StemCounts(dict):
    """Numbers words as they are met, with the numbers of their stems, and counts stems in arrays.

    ``number`` gives a stem's number below ``span()``, or None for a stem that is not looked for.
    """

    def __init__(self, number, span):
        self.number, self.span = number, span
        self.forget()

    def forget(self):
        self.clear()
        self.chars = 0
        self.stems, self.ends = array("q"), array("q", [0])

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self.ends) - 1
        self.chars += len(word)
        self.stems.extend([n for n in map(self.number, stems_of_word(word)) if n is not None])
        self.ends.append(len(self.stems))
        return place

    def __call__(self, texts):
        """Slices of whole texts: (texts in it, rows, stems, counts). A count is the number of a
        text's distinct words that have the stem; rows start at 0 in each slice and are sorted."""
        words, sizes = [], []
        for text in texts:
            found = set(_WORD.findall(text.lower())) if text else ()
            words.extend(map(self.__getitem__, found))
            sizes.append(len(found))
            if len(words) >= SLICE_WORDS:
                yield self._counted(words, sizes)
                words, sizes = [], []
                if len(self) > KEPT_WORDS or self.chars > KEPT_CHARS:
                    self.forget()
        if sizes:
            yield self._counted(words, sizes)

    def _counted(self, words: list[int], sizes: list[int]):
        of_word, ends = np.array(words, np.int64), np.array(self.ends)
        start, n = ends[of_word], ends[of_word + 1] - ends[of_word]
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        rows = np.repeat(np.repeat(np.arange(len(sizes)), sizes), n)
        span = max(1, self.span())
        keys, counts = np.unique(rows * span + np.array(self.stems, np.int64)[at], return_counts=True)
        return len(sizes), keys // span, keys % span, counts


@dataclass
class Model:
    prior: float
    weights: dict[str, float]
    intercept: float

    def scorer(self):
        """Function from a list of texts to their scores."""
        stems = {s: i for i, s in enumerate(sorted({f if f[0] == "=" else f[:-2] for f in self.weights}))}
        # gain[s, c]: what stem s adds where c (at most 3) distinct words have it.
        gain = np.zeros((len(stems) + 1, 4))
        for name, weight in self.weights.items():
            if name[0] == "=":
                gain[stems[name], 1:] += weight
            else:
                gain[stems[name[:-2]], int(name[-1]) :] += weight
        counter = StemCounts(stems.get, lambda: len(stems))

        def score(texts: list[str | None]) -> np.ndarray:
            z = [
                np.bincount(rows, weights=gain[found, np.minimum(counts, 3)], minlength=n)
                for n, rows, found, counts in counter(texts)
            ]
            return 1 / (1 + np.exp(-np.clip(self.intercept + np.concatenate([np.empty(0), *z]), -700, 700)))

        return score


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def nnpu_fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and intercept from rows given as arrays of feature numbers (Adam, logistic loss)."""
    both = [*positive, *unlabelled]
    n, n_pos = len(both), len(positive)
    rows = np.repeat(np.arange(n), [len(b) for b in both])
    cols = np.concatenate(both).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    is_pos = np.arange(n) < n_pos
    p, u = 1 / max(1, n_pos), 1 / max(1, n - n_pos)
    theta, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    theta[size] = np.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        z = theta[size] + _sums(theta[cols], rows, n)
        chance = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        soft = np.logaddexp(0, z)
        negative = u * soft[~is_pos].sum() - prior * p * soft[is_pos].sum()
        # Gradient of each row's part: the positive risk, and the corrected negative risk.
        up = np.where(is_pos, -prior * p * (1 - chance), 0.0)
        down = np.where(is_pos, -prior * p * chance, u * chance)
        slope = up + down if negative >= 0 else -down
        grad = np.append(_sums(slope[rows], cols, size), slope.sum())
        grad[:size] += RIDGE * theta[:size]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[size])


def stem_bits(features: DataFrame) -> bytes:
    """Words and beginnings of ``features`` folded into FILTER_BITS bits (8 MB), whatever their number."""
    name = F.col("feature")
    stem = F.when(name.startswith("="), name).otherwise(F.expr("left(feature, length(feature) - 2)"))
    bits = bytearray(FILTER_BITS >> 3)
    for row in key_filter(features.select(F.crc32(stem.cast("binary")).alias("key")), "key").collect():
        if row["_bucket"] > 0:
            start = (row["_bucket"] - 1) * 4096
            bits[start : start + 4096] = row["_bitmap"]
    return bytes(bits)


def _feature_counts(texts: DataFrame, among: bytes | None = None) -> DataFrame:
    """(feature, n): how many texts hold each feature, or each that may be ``among`` (``stem_bits``)."""
    sent = texts.sparkSession.sparkContext.broadcast(among)

    def run(batches):
        finder = Finder(among=sent.value)
        places: dict[str, int] = {}

        def number(stem):
            place = places.get(stem)
            if place is None and (finder.among is None or finder._may_be(stem)):
                place = places[stem] = len(places)
            return place

        counter = StemCounts(number, lambda: len(places))
        held = np.zeros((3, 0), np.int64)  # texts with at least 1, 2, 3 words of a stem

        def handed():
            stems = pa.array(list(places), pa.string())
            is_word = pc.starts_with(stems, "=")
            for n in range(3):
                some = np.flatnonzero(held[n])
                names = pc.if_else(is_word, stems, pc.binary_join_element_wise(stems, f"#{n + 1}", "")).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([names, pa.array(held[n][some])], ["feature", "n"])

        for batch in batches:
            for _, _, stems, counts in counter(batch.column(0).to_pylist()):
                if len(places) > held.shape[1]:
                    held = np.pad(held, ((0, 0), (0, 2 * len(places) - held.shape[1])))
                for n in range(3):
                    some = np.bincount(stems[counts > n])
                    held[n, : len(some)] += some
                if len(places) >= COUNTED_STEMS:
                    held = held[:, : len(places)]
                    yield from handed()
                    places.clear()
                    counter.forget()
                    held = np.zeros((3, 0), np.int64)
        held = held[:, : len(places)]
        yield from handed()

    return texts.mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _numbered(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Feature numbers of every text."""
    sent = texts.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def run(batches):
        place = sent.value
        finder = Finder(place)
        for batch in batches:
            found = [[place[f] for f in finder(text)] for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["features"])

    return texts.mapInArrow(run, "features array<int>")


def choose_features(in_positive: DataFrame, in_all: DataFrame, toxic: int, total: int) -> list[str]:
    """The FEATURES of ``in_positive`` whose rates differ most from ``in_all`` (feature, n), in standard errors."""
    both = in_positive.select("feature", F.col("n").alias("p")).join(in_all, "feature", "left")
    a, b = (F.col("p") + 0.5) / (toxic + 1), (F.coalesce("n", F.lit(0)) + 0.5) / (total + 1)
    # A positive held by several rows may give rates above 1.
    spread = F.greatest(a * (1 - a), F.lit(0.0)) / (toxic + 1) + F.greatest(b * (1 - b), F.lit(0.0)) / (total + 1) + 1e-12
    rated = both.select("feature", (F.abs(a - b) / F.sqrt(spread)).alias("distance")).filter(F.col("distance") >= DIFFERENT)
    return sorted(r.feature for r in rated.orderBy(F.desc("distance"), "feature").limit(FEATURES).collect())


def _texts_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts of the rows with these IDs (``key``, distinct); only those texts are shuffled."""
    hashed = ids.select("key", F.xxhash64("key").alias("hash"))
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("key"))
    return in_filter(rows, F.xxhash64("key"), key_filter(hashed, "hash")).join(hashed.select("key"), "key").select("text")


def train(docs: DataFrame, labels: DataFrame, training: Column, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    """Fit on the rows of both frames for which ``training`` (a condition on the ID) holds."""
    own = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .filter(training)
        .groupBy(F.col(id_col).alias("key"))
        .agg(F.max(label_col).alias("label"))
    )
    n, toxic = own.agg(F.count(F.lit(1)), F.sum((F.col("label") == 1).cast("bigint"))).head()
    prior = min(0.99, max(1e-4, (toxic or 0) / n)) if n else 0.5
    if not toxic:
        return Model(prior, {}, float(np.log(prior / (1 - prior))))
    positive = own.filter("label = 1").select("key")
    rows = docs.filter(training)
    held = written(_feature_counts(_texts_of(rows, positive, id_col, text_col)))
    features = choose_features(held, _feature_counts(rows.select(text_col), stem_bits(held)), toxic, rows.count())

    def sample(keys: DataFrame, most: int) -> list[np.ndarray]:
        some = keys.distinct().orderBy(F.xxhash64("key"), "key").limit(most)
        found = _numbered(_texts_of(rows, some, id_col, text_col), features).collect()
        return [np.array(r.features, np.int64) for r in found]

    known = rows.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("key"))
    weights, intercept = nnpu_fit(sample(positive, POSITIVES), sample(known, UNLABELLED), len(features), prior)
    return Model(prior, dict(zip(features, weights.tolist())), intercept)


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, score) of every whole text; a map without shuffle. The model has a bounded size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        one = sent.value.scorer()
        for batch in batches:
            out = one(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
