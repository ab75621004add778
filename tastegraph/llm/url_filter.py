"""URL filter: allow and block rules on hosts and path prefixes, found through hash prefixes.

A rule (host, path, verdict) fits the URLs of its host and of all its subdomains whose path
starts with the rule's path. Every URL is expanded into expressions: its host suffixes (cut at
dots) joined to its path prefixes. An expression is looked up by the first 32 bits of its
SHA-256, and a hit counts only if the whole digest is a rule's. Of the rules that fit, the one
with the longest host and path together decides, then the one with the longer host; if a rule
is listed with both verdicts, ``block`` holds.

* Only prefixes as long as some rule is are formed: a shape is (labels of the host, length of the
  path), and the shapes of all rules travel as one array, bounded by the labels of a host times the
  lengths of the rules' paths. Prefixes need not end at a slash, as rules need not.
* Equal URLs are judged once (host and path, with the number of rows). The rules' hash prefixes,
  folded into a bitmap of fixed size, drop nearly all other expressions where they arise. What is
  left is counted per digest, so a rule meets one row for all URLs below it.
* Expressions and URLs that are frequent (a large host, a common page) find their rule by
  broadcast, others by a shuffle (``attach_stats``, ``attach_left``).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there
up to ``?``, ``#`` or the end. A URL that is null or has no ``://`` has both empty; so have empty URLs.
Rules with a null host, path or verdict are passed over. Repeated rows each get their verdict;
without rules, or where none fits, the verdict is ``default`` and the rule null. Everything is
DataFrame functions, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.skew import attach_stats
from tastegraph.llm.common import attach_left, fold_ascii, in_filter, key_filter, packed
from tastegraph.session import written

PREFIX_DIGITS = 8  # hexadecimal digits of a digest that are joined on: 32 bits


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = fold_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.split(host, "\\.")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_DIGITS), 16, 10).cast("bigint")


def compiled(rules: DataFrame) -> DataFrame:
    """rules(host, path, verdict) -> (prefix, digest, labels, cut, rule, verdict), one row a rule."""
    host = fold_ascii(F.col("host"))
    named = rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(host.alias("host"), "path", "verdict")
    once = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.concat("host", "path")
    digest = _digest(rule)
    return once.select(
        _prefix(digest).alias("prefix"), digest.alias("digest"), F.size(_labels(F.col("host"))).alias("labels"),
        F.length("path").alias("cut"), F.length("host").alias("host_length"), rule.alias("rule"), "verdict",
    )


def expressions(targets: DataFrame, shapes: Column) -> DataFrame:
    """(target, digest) of every expression of (target, host, path) that has one of the ``shapes``."""
    labels = _labels(F.col("host"))
    each = targets.select("target", "host", "path", shapes.alias("shapes")).select("*", F.explode("shapes").alias("shape"))
    each = each.filter((F.col("shape.labels") <= F.size(labels)) & (F.col("shape.cut") <= F.length("path")))
    suffix = F.array_join(F.slice(labels, F.size(labels) - F.col("shape.labels") + 1, F.col("shape.labels")), ".")
    return each.select("target", _digest(F.concat(suffix, F.substring("path", F.lit(1), F.col("shape.cut")))).alias("digest"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """(row, host, path, rule, verdict): every row of ``pages`` whole in ``row``, with its verdict."""
    known = written(compiled(rules))
    shapes = known.agg(F.collect_set(F.struct("labels", "cut"))).scalar()

    host, path = host_and_path(F.col(f"`{url_col}`"))
    split = packed(pages, host.alias("host"), path.alias("path"))
    # a host holds no slash and a path starts with one: the text of both names the pair
    held = split.withColumn("target", F.concat("host", "path"))
    targets = written(held.groupBy("target", "host", "path").agg(F.count("*").alias("rows")))

    bits = key_filter(known, "prefix")
    asked = expressions(targets, shapes)
    likely = written(in_filter(asked, _prefix(F.col("digest")), bits))
    wanted = likely.groupBy("digest").agg(F.count("*").alias("asked")).withColumn("prefix", _prefix(F.col("digest")))
    hits = wanted.join(known.withColumnRenamed("digest", "full"), "prefix").filter("digest = full")
    confirmed = written(hits.select("digest", "asked", "rule", "verdict", F.struct(F.length("rule"), "host_length").alias("order")))
    found = attach_stats(likely, confirmed, "digest", "asked")
    best = found.groupBy("target").agg(F.max_by(F.struct("rule", "verdict"), "order").alias("best"))
    judged = written(targets.join(best, "target").select("target", "rows", "best.rule", "best.verdict"))
    return attach_left(held, judged, "target", "rows").select(
        "row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def verdicts(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id", default: str = "allow"
) -> DataFrame:
    """(id_col, host, path, rule, verdict) of every row."""
    narrow = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    found = judge(narrow, rules, "url", default)
    return found.select(F.col("row.id").alias(id_col), "host", "path", "rule", "verdict")


def allowed(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose verdict is ``allow``, their columns unchanged."""
    return judge(pages, rules, url_col, default).filter("verdict = 'allow'").select("row.*")
