"""Secret scans through a trigram inverted index, in DataFrame operations only.

From each rule's pattern a Boolean trigram query is derived: alternatives (OR) of trigrams that
a match must contain (AND). The index holds, for every trigram that some query names, its
postings (the rows whose lower-cased text contains it). Intersecting the postings of an
alternative gives candidates, whose texts are fetched and verified with the pattern. A rule
without mandatory trigrams scans every text.

Rows are known by ID, a 64-bit hash of the text and its length. Null texts count as empty;
texts without a match give zeros and empty lists; rows that repeat ID and text each get the
same result; an empty table gives an empty result. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import in_filter, key_filter
from tastegraph.session import written

# More literal strings than this for one stretch of a pattern: the stretch is split.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match of ``pattern`` counts if ``group`` of it has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False
    base: bool = False


# Fixed values of the contract (the first three kinds), then kinds that this library adds.
# Access keys and hexadecimal runs state their length in the pattern: a shorter run has no
# match inside it, so this equals dropping short matches.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)


def _strings(item) -> set[str] | None:
    """All strings that a parsed item matches, if they are few; None otherwise."""
    op, value = item
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in value) and len(value) <= 4:
            return {chr(v).lower() for _, v in value}
        return None
    if op is sre.SUBPATTERN:
        return _joined(value[3])
    if op is sre.BRANCH:
        found = [_joined(branch) for branch in value[1]]
        return None if None in found else set().union(*found)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = value
        one = _joined(inner)
        if one is None or high > 2:
            return None
        return {"".join(p) for n in range(low, high + 1) for p in itertools.product(one, repeat=n)}
    return None


def _joined(items) -> set[str] | None:
    out = {""}
    for item in items:
        found = _strings(item)
        if found is None:
            return None
        out = {a + b for a in out for b in found}
        if len(out) > MOST_STRINGS:
            return None
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams (lower case) that a match must contain; empty: none is mandatory."""
    stretches, run = [], {""}
    for item in [*sre_parse.parse(pattern), None]:
        found = None if item is None else _strings(item)
        longer = None if found is None else {a + b for a in run for b in found}
        if longer is not None and len(longer) <= MOST_STRINGS:
            run = longer
            continue
        stretches.append(run)
        run = {""} if found is None else found
    stretches.append(run)
    queries = []
    for strings in stretches:
        terms = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in terms:
            queries.append(terms)
    if not queries:
        return []
    joined = reduce(lambda a, b: {x | y for x in a for y in b}, queries)
    return sorted((t for t in joined if not any(o < t for o in joined)), key=sorted)


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"), F.length(text).alias("len"))


KEY = ["id", "hash", "len"]


def trigram_index(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, id, hash, len): the rows whose lower-cased text contains a trigram."""
    lower = F.lower("text")
    held = [F.when(F.contains(F.col("lower"), F.lit(t)), F.lit(t)) for t in trigrams]
    return rows.select(*KEY, lower.alias("lower")).select(*KEY, F.explode(F.array_compact(F.array(*held))).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(id, hash, len, kinds): rows in the intersected postings of an alternative of a rule."""
    bits = {t: i for i, t in enumerate(sorted({t for q in queries.values() for a in q for t in a}))}
    found = postings.groupBy(*KEY).agg(*[F.max((F.col("trigram") == t).cast("int")).alias(f"t{i}") for t, i in bits.items()])
    kinds = []
    for kind, alternatives in queries.items():
        every = [reduce(lambda a, b: a & b, [F.col(f"t{bits[t]}") == 1 for t in sorted(terms)]) for terms in alternatives]
        kinds.append(F.when(reduce(lambda a, b: a | b, every), F.lit(kind)))
    return found.select(*KEY, F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def _matches(rows: DataFrame, rules: list[Rule], order: dict[str, int], meant: bool) -> DataFrame:
    """(id, hash, len, kind, start, end) of the matches in rows (id, hash, len, text[, kinds]).

    The stretches between the matches and the matches themselves add up to the offsets.
    """
    found = []
    for rule in rules:
        pattern = ("(?i)" if rule.ignore_case else "") + rule.pattern
        hit = F.col("text").rlike(pattern)
        if meant:
            hit = F.array_contains("kinds", rule.kind) & hit
        parts = F.arrays_zip(
            F.split("text", pattern, -1).alias("gap"),
            F.regexp_extract_all("text", F.lit(pattern), 0).alias("match"),
            F.regexp_extract_all("text", F.lit(pattern), rule.group).alias("value"),
        )
        lengths = F.transform(
            parts,
            lambda p: F.struct(
                F.length(p["gap"]).alias("gap"), F.length(p["match"]).alias("match"), F.length(p["value"]).alias("value")
            ),
        )
        found.append(F.when(hit, F.struct(F.lit(order[rule.kind]).alias("kind"), lengths.alias("parts"))))
    rows = rows.select(*KEY, F.explode(F.array_compact(F.array(*found))).alias("found"))
    rows = rows.select(*KEY, "found.kind", F.posexplode("found.parts").alias("no", "part")).dropDuplicates([*KEY, "kind", "no"])
    before = Window.partitionBy(*KEY, "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("part.gap") + F.coalesce("part.match", F.lit(0))).over(before).cast("int")
    least = reduce(lambda a, r: F.when(F.col("kind") == order[r.kind], r.least).otherwise(a), rules, F.lit(1))
    return (
        rows.withColumn("end", end)
        .filter(F.col("part.match").isNotNull() & (F.col("part.value") >= least))
        .select(*KEY, "kind", (F.col("end") - F.col("part.match")).alias("start"), "end")
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (id, spans array<struct<start, kind, end>>), kinds by number.

    Spans are in order of start, then kind as listed in ``rules``.
    """
    order = {r.kind: i for i, r in enumerate(rules)}
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    rows = _keyed(docs, text_col, id_col)
    # The full scan of the rules without a query.
    matches = []
    scanned = [r for r in rules if r.kind not in indexed]
    if scanned:
        matches.append(_matches(rows, scanned, order, meant=False))
    if indexed:
        trigrams = sorted({t for q in indexed.values() for a in q for t in a})
        postings = written(trigram_index(rows, trigrams))
        meant = written(candidates(postings, indexed))
        texts = in_filter(rows, F.col("hash"), key_filter(meant, "hash")).dropDuplicates(KEY)
        same = [texts[k].eqNullSafe(meant[k]) for k in KEY]
        verified = texts.join(meant, reduce(lambda a, b: a & b, same)).select(*[texts[c] for c in texts.columns], "kinds")
        matches.append(_matches(verified, [r for r in rules if r.kind in indexed], order, meant=True))
    spans = (
        reduce(DataFrame.unionByName, matches)
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    )
    narrow = rows.select(*KEY)
    same = reduce(lambda a, b: a & b, [narrow[k].eqNullSafe(spans[k]) for k in KEY])
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return narrow.join(spans, same, "left").select(narrow["id"].alias(id_col), F.coalesce("spans", none).alias("spans"))


def _joined_spans(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_digests(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_<kind> of the base kinds, base_sha256, spans as text)."""
    found = find_secrets(docs, rules, text_col, id_col)
    base = [i for i, r in enumerate(rules) if r.base]
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, F.lit(i)))).cast("bigint").alias(f"n_{rules[i].kind}") for i in base
    ]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        id_col,
        *counts,
        F.sha2(_joined_spans(own, rules).cast("binary"), 256).alias("base_sha256"),
        _joined_spans(F.col("spans"), rules).alias("spans"),
    )
