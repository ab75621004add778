"""Periodic runs of words: passages that repeat themselves with a fixed period.

A run is a stretch of consecutive words whose smallest period is q, of at least
max(LEAST_LENGTH, LEAST_EXPONENT * q) words, that no neighbouring word extends keeping the period.
All runs of a text are found, by multi-scale minimizers:

* Scale w (a power of two from 2 * SHORT on) finds the periods q with w/2 < q <= w. The w-grams
  of words have names (equal names for equal w-grams, made from the names of their halves). Inside
  a run of such a period, w-grams are equal exactly where they are a multiple of q apart, and the
  run holds more than 2q of them. The minimizer of w/2 + 1 neighbouring w-grams (smallest hash of the
  name) therefore comes back q words later, with no equal one between: neighbouring equal
  minimizers at a distance in the scale's range seed all runs.
* A seed (place, lag) is extended to both sides word by word as far as the lag holds. Seeds inside
  a stretch already found for their lag are passed over, and a stretch that has a smaller period
  is left to that period.
* A w-gram that is alone in its text is in no run; places are kept only in stretches of repeated
  w-grams long enough for the scale, so ordinary prose has no places left after a few scales.
* Periods up to SHORT are too short for minimizers: each of these lags is scanned directly.

Texts are cut into words ``[^\\x20\\x09-\\x0D]+``. A task works on slices of about SLICE_WORDS
words; each text lies in one slice, whole, however long it is. Null and empty texts have no words and
no runs; repeated rows and IDs each get their result; a null ID stays null. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
# Largest period that is scanned directly; the first scale is twice it.
SHORT = 8
# Words that a task looks at together, unless one text has more.
SLICE_WORDS = 1 << 17

WORD = re.compile("[^\x20\x09-\x0d]+")


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of true values, ``least`` long at least."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _primes(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] if n > 1 else found


def _is_smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Has a stretch from ``start`` with this period (4 of them at least) no smaller one?

    A smaller one would divide it, so only the period over a prime has to be tried.
    """
    for p in _primes(period):
        q = period // p
        if np.array_equal(words[start : start + period], words[start + q : start + q + period]):
            return False
    return True


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values agree; looks at growing pieces."""
    done, step, n = 0, 64, min(len(a), len(b))
    while done < n:
        differ = np.flatnonzero(a[done : min(done + step, n)] != b[done : min(done + step, n)])
        if len(differ):
            return done + int(differ[0])
        done, step = min(done + step, n), step * 2
    return n


def _names(keys: np.ndarray) -> np.ndarray:
    """Whole numbers for equal keys, -1 for a key that occurs once."""
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[which] > 1, which, -1).astype(np.int64)


def _mixed(names: np.ndarray) -> np.ndarray:
    """31 well spread bits of a name."""
    x = names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(33)).astype(np.int64)


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values, by minima inside blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.int64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _seeds(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per scale the (places, lags) of neighbouring equal minimizers."""
    n = len(words)
    names, width = _names(words), 1
    while True:
        # Where a run of this or a later scale can be: its w-grams are repeated and side by side.
        period = max(width // 2, SHORT) + 1
        starts, ends = _stretches(names >= 0, LEAST_EXPONENT * period - width + 1)
        if not len(starts):
            return
        places = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)])
        if width > SHORT:
            span = width // 2 + 1
            ranked = (_mixed(names[places]) << 32) | np.arange(len(places))
            least = np.unique(_window_minima(ranked, span) & 0xFFFFFFFF)
            chosen = places[least]
            order = np.lexsort((chosen, names[chosen]))
            chosen = chosen[order]
            lags = np.diff(chosen)
            pairs = (names[chosen[1:]] == names[chosen[:-1]]) & (lags > width // 2) & (lags <= width)
            yield chosen[:-1][pairs], lags[pairs]
        # Names of w-grams twice as long, where both halves are still in question.
        kept = np.full(n + width, -1, np.int64)
        kept[places] = names[places]
        both = places[(kept[places + width] >= 0)]
        names = np.full(n, -1, np.int64)
        if len(both):
            names[both] = _names(kept[both] * np.int64(n) + kept[both + width])
        width *= 2


def find(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the sequence, by start, then period.

    ``words`` are whole numbers, equal for equal words.
    """
    runs = set()
    n = len(words)
    for period in range(1, min(SHORT, n // LEAST_EXPONENT) + 1):
        least = max(LEAST_LENGTH, LEAST_EXPONENT * period)
        for a, b in zip(*_stretches(words[:-period] == words[period:], least - period)):
            if _is_smallest(words, int(a), period):
                runs.add((int(a), int(b - a) + period, period))
    for places, lags in _seeds(words):
        known: dict[int, int] = {}
        for at, lag in sorted(zip(places.tolist(), lags.tolist())):
            if at < known.get(lag, -1):
                continue
            end = at + _agreement(words[at:], words[at + lag :])
            start = at - _agreement(words[:at][::-1], words[: at + lag][::-1])
            known[lag] = end
            length = end - start + lag
            if length >= max(LEAST_LENGTH, LEAST_EXPONENT * lag) and _is_smallest(words, start, lag):
                runs.add((start, length, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay if every run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def _slices(texts: Iterator[tuple[int, str | None]]) -> Iterator[list[tuple[int, list[str]]]]:
    held, size = [], 0
    for number, text in texts:
        found = WORD.findall(text or "")
        held.append((number, found))
        size += len(found)
        if size >= SLICE_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _runs_of_slice(slice_: list[tuple[int, list[str]]]) -> Iterator[tuple[int, list[str], list[tuple[int, int, int]]]]:
    """(number, words, runs) of every text. Words of different texts never count as equal."""
    ids, starts, used = [], [], 0
    for _, words in slice_:
        starts.append(len(ids))
        seen: dict[str, int] = {}
        ids += [seen.setdefault(w, len(seen) + used) for w in words]
        used += len(seen)
    found = find(np.array(ids, dtype=np.int64))
    owner = np.searchsorted(np.array(starts + [len(ids)]), np.array([r[0] for r in found], dtype=np.int64), side="right") - 1
    per_text: dict[int, list] = {}
    for text, (start, length, period) in zip(owner.tolist(), found):
        per_text.setdefault(text, []).append((start - starts[text], length, period))
    for i, (number, words) in enumerate(slice_):
        yield number, words, per_text.get(i, [])


def _mapped(docs: DataFrame, id_col: str, text_col: str, columns: str, row) -> DataFrame:
    """A row (id, *row(words, runs)) for every text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {columns}"
    kinds = docs.sparkSession.createDataFrame([], schema).schema.fields[1:]
    names = [f.name for f in kinds]
    types = [pa.string() if f.dataType.simpleString() == "string" else pa.int64() if f.dataType.simpleString() == "bigint" else None for f in kinds]
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    types = [t or runs_type for t in types]

    def run(batches):
        for batch in batches:
            texts = ((i, batch.column(1)[i].as_py()) for i in range(batch.num_rows))
            for slice_ in _slices(texts):
                numbers, out = [], []
                for number, words, runs in _runs_of_slice(slice_):
                    numbers.append(number)
                    out.append(row(words, runs))
                columns = [pa.array([r[j] for r in out], t) for j, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(numbers)), *columns], ["id", *names])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, runs): the runs (start, length, period) of every text, counted in words from 0."""
    shape = "runs array<struct<start:bigint,length:bigint,period:bigint>>"
    make = lambda words, found: ([{"start": s, "length": n, "period": p} for s, n, p in found],)
    return _mapped(docs, id_col, text_col, shape, make)


def collapsed(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, text): the words left when every run keeps its first period only, joined by one blank."""
    return _mapped(docs, id_col, text_col, f"{text_col} string", lambda words, found: (_collapse(words, found),))


def _collapse(words: list[str], found: list[tuple[int, int, int]]) -> str:
    return " ".join([words[i] for i in np.flatnonzero(kept_words(len(words), found))] if found else words)


def _digest(words: list[str], found: list[tuple[int, int, int]]) -> tuple:
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    # Greatest length / period, compared in whole numbers; then the smallest start and period.
    best = (None, None, None)
    for start, length, period in found:
        if best[0] is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    sha = lambda text: hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
    return (len(found), *best, exponent, sha(listed), sha(_collapse(words, found)))


def digests(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every text.

    The four numbers are those of the run with the greatest exponent, null without runs.
    """
    columns = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _mapped(docs, id_col, text_col, columns, _digest)
