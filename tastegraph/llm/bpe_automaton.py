"""BPE encoding and decoding through a tokenization automaton.

The merges are compiled, one merge gadget after the other, into a deterministic automaton
whose arcs are tokens: a path from the start spells a word, and exactly one path spells each
word, namely its BPE tokenization. The gadget of merge (u, v) -> w at step k

* lets the state that the u-arcs lead to lose its v-arc,
* gives every state that has a u-arc a w-arc, and
* lets the w-arcs lead to a new state, a copy of the one that the v-arcs lead to.

The states are kept with shared arcs: a state names the state it was copied from, the step of
the copy, and the arcs it has lost since. An arc of w is there if the arc of u was there when
w was made. Transitions that were looked up once stay in a table.

Encoding splits a text as the tokenizer file says, walks every piece through the automaton and
keeps the pieces between white space in a bounded table. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tastegraph.llm.common import handing_back

NEVER = 1 << 62
# Distinct pieces (between white space) and words of a generation: a task keeps two of them, the one
# being filled and the one before, so that frequent ones stay. Bounds its memory.
KEPT_PIECES = 200_000
_FILE_SEPARATORS = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")


def byte_labels() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    place = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [place[b] for b in range(256)]


class Recent:
    """A table of the latest entries: up to ``most`` being gathered, and the generation before them."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def __len__(self) -> int:
        return len(self.young) + len(self.old)


class Automaton:
    """Deterministic automaton over the tokens of a BPE vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str = "", kept: int | None = None):
        self.ids, self.end = vocab, end
        size = max(vocab.values(), default=-1) + 1
        self.born = [-1] * size  # step that made a token; -1: given from the start
        self.left = [-1] * size
        self.copied = [-1] * size  # token whose state this token's state is a copy of
        self.lost: dict[tuple[int, int], int] = {}  # (state, arc) -> step
        self.dead: set[int] = set()
        self.table = Recent(2 * (kept or KEPT_PIECES))
        made = {t for m in merges for t in ["".join(m)]}
        known = {i for t, i in vocab.items() if t not in made}
        for step, (u, v) in enumerate(merges):
            self._gadget(step, vocab[u], vocab[v], vocab[u + v], known)
        # What a word may end with, and the starts of the other tokens (-1: no token yet).
        self.finals = {t[: len(t) - len(end)]: i for t, i in vocab.items() if t.endswith(end)}
        self.starts: dict[str, int] = {}
        for t, i in vocab.items():
            if not end or not t.endswith(end):
                for n in range(1, len(t)):
                    self.starts.setdefault(t[:n], -1)
                self.starts[t] = i

    def _gadget(self, step: int, u: int, v: int, w: int, known: set[int]) -> None:
        if u not in known or v not in known or w in known:
            raise ValueError("a merge uses a token before it is made, or makes it twice")
        if u not in self.dead and self._has(u, v):
            self.lost[u, v] = step
        else:  # v never follows u: no path has this token
            self.dead.add(w)
        self.born[w], self.left[w], self.copied[w] = step, u, v
        known.add(w)

    def _lost_at(self, state: int, arc: int) -> int:
        """Step at which the state lost the arc, counting what it was copied without."""
        before = NEVER
        while state >= 0:
            step = self.lost.get((state, arc), NEVER)
            if step < before:
                return step
            before, state = self.born[state], self.copied[state]
        return NEVER

    def _has(self, state: int, arc: int) -> bool:
        """Is there an arc? state: the token whose arcs lead there, -1 for the start."""
        if arc in self.dead:
            return False
        until = NEVER - 1
        while True:
            if state >= 0 and self._lost_at(state, arc) <= until:
                return False
            if self.born[arc] < 0:
                return True
            until, arc = self.born[arc], self.left[arc]

    def has_arc(self, state: int, arc: int) -> bool:
        key = (state + 1) << 32 | arc
        found = self.table.get(key)
        if found is None:
            found = self._has(state, arc)
            self.table.put(key, found)
        return found

    def path(self, word: str) -> list[int]:
        """The token ids of the one path that spells ``word``.

        Follows the longest arc first and turns back where there is none. A prefix of a word
        has one path only, so a place is entered once.
        """
        n, starts, finals, has_arc = len(word), self.starts, self.finals, self.has_arc
        out: list[int] = []
        at, state, back, entered = 0, -1, [], set()
        while at < n:
            last = finals.get(word[at:])
            if last is not None and has_arc(state, last):
                out.append(last)
                return out
            arcs = []
            for j in range(at + 1, n):
                token = starts.get(word[at:j])
                if token is None:
                    break
                if token >= 0:
                    arcs.append((j, token))
            while True:
                while arcs:
                    j, token = arcs.pop()
                    if j not in entered and has_arc(state, token):
                        break
                else:
                    at, state, arcs = back.pop()
                    out.pop()
                    continue
                break
            back.append((at, state, arcs))
            entered.add(j)
            out.append(token)
            at, state = j, token
        return out


class Codec:
    """Encoder and decoder for the text of a tokenizer file with byte-level BPE and word ends.

    Understood: NFC, white space folding and lower case as normaliser, one splitting pattern,
    byte level, BPE with or without a word-end suffix, special tokens, no decoder (labels are
    joined with a blank).
    """

    def __init__(self, definition: str, kept: int | None = None):
        spec = json.loads(definition)
        model = spec["model"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if spec.get("decoder") is not None or model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("this kind of tokenizer file is not supported")
        self.library = Tokenizer.from_str(definition)
        self.automaton = Automaton(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "", kept)
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        marks = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(marks) + ")") if marks else None
        self.labels = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.byte_label = dict(enumerate(byte_labels()))
        self.words, self.kept = Recent(kept or KEPT_PIECES), Recent(kept or KEPT_PIECES)

    def _piece(self, piece: str) -> tuple[bytes, str]:
        """Ids (little-endian, 32 bits) and joined labels of a text without white space."""
        if piece.isascii():
            words = self.pattern.findall(piece.lower())
        else:
            folded = unicodedata.normalize("NFC", piece)
            folded = "".join([c.lower() for c in folded]) if "Σ" in folded else folded.lower()
            words = self.pattern.findall(folded)
        if not piece.isascii() and any(unicodedata.category(c) == "Cn" for c in piece):
            # Assigned lately or not at all: the library's Unicode tables decide how to split.
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))
            paths = [self.automaton.path(word) for word, _ in split]
        else:
            paths = map(self._word, words)
        ids = [i for path in paths for i in path]
        return array("I", ids).tobytes(), " ".join([self.labels[i] for i in ids])

    def _word(self, word: str) -> list[int] | array:
        path = self.words.get(word)
        if path is None:
            if word.isascii() and word.isprintable():
                path = self.automaton.path(word)
            else:
                path = self.automaton.path(word.encode("utf-8", "replace").decode("latin-1").translate(self.byte_label))
            if len(word) <= 64:
                path = array("I", path)
                self.words.put(word, path)
        return path

    def _pieces(self, text: str) -> list[tuple[bytes, str]]:
        kept, out = self.kept, []
        young = kept.young
        for piece in _SPACE.split(text) if _FILE_SEPARATORS.search(text) else text.split():
            found = young.get(piece)
            if found is None:
                found = kept.get(piece)
                if found is None:
                    found = self._piece(piece)
                    if len(piece) <= 64:
                        kept.put(piece, found)
                young = kept.young
            out.append(found)
        return out

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the text that decoding them gives."""
        if self.marks and self.marks.search(text):
            pieces = []
            for i, part in enumerate(self.marks.split(text)):
                pieces += [(array("I", [self.special[part]]).tobytes(), part)] if i % 2 else self._pieces(part)
        else:
            pieces = self._pieces(text)
        return b"".join([p[0] for p in pieces]), " ".join([p[1] for p in pieces if p[0]])

    def forget(self) -> None:
        """Empty the tables that were filled on the way."""
        for table in (self.words, self.kept, self.automaton.table):
            table.clear()

    def decode(self, ids) -> str:
        """Labels of the arcs, joined with a blank; ids without a label are left out."""
        return " ".join([self.labels[i] for i in map(int, ids) if i in self.labels])


_codecs: dict[str, Codec] = {}


def codec(definition: str, kept: int | None = None) -> Codec:
    """One codec for each tokenizer and Python worker."""
    key = f"{hashlib.sha256(definition.encode()).hexdigest()} {kept}"
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(definition, kept)
    return _codecs[key]


def _coding(run):
    """``run(codec, batches)`` on the codec of a definition that was sent; its tables go when the task ends."""

    def started(sent, kept=None):
        def task(batches):
            coder = codec(sent.value, kept)
            yield from run(coder, batches)
            coder.forget()

        return handing_back(task)

    return started


def encode(docs: DataFrame, definition: str, text_col: str = "text", id_col: str = "doc_id", kept: int | None = None) -> DataFrame:
    """(id, ids array<int>, decoded string) of every whole text; a null text counts as empty.

    A map without shuffle: a row in, a row out, other columns are left out, repeated rows stay.
    ``definition`` is the content of a tokenizer file (a fixed size), sent to the tasks once.
    ``kept``: pieces and words of a generation in a task's tables (KEPT_PIECES); fewer take less memory
    and more time.
    """
    sent = docs.sparkSession.sparkContext.broadcast(definition)

    def run(coder, batches):
        for batch in batches:
            out = [coder.encode(text.as_py() or "") for text in batch.column(1)]
            ids = pa.array([np.frombuffer(x[0], "u4").astype("i4") for x in out], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([x[1] for x in out], pa.string())], ["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_coding(run)(sent, kept), f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, definition: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """(id, decoded) of rows of token ids; null counts as no ids."""
    sent = coded.sparkSession.sparkContext.broadcast(definition)

    def run(coder, batches):
        for batch in batches:
            texts = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "decoded"])

    kind = coded.schema[id_col].dataType.simpleString()
    return coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(_coding(run)(sent), f"id {kind}, decoded string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, definition: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): ``encode`` and ``decode`` with only digests leaving the task."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)

    def run(coder, batches):
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids, decoded = coder.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_coding(run)(sent), schema).withColumnRenamed("id", id_col)
