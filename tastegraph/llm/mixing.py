"""Mixing documents to target weights: iterative proportional fitting, then calibrated sampling.

Token counts are added up by cell (one value of each margin: source, language, topic). Raking
scales the cells' weights in turn until every margin has its target shares. A document's
probability follows its cell's ratio of raked to present weight. Whether it is drawn depends on the
seed and its ID alone; a document with probability 1 always stays. Two scales:

* ``budget`` (a share of the present tokens): min(1, c * ratio), c such that the expected tokens are
  the budget. A rare cell with a large ratio is taken whole and hardly moves the others' rates; what
  it lacks (``shortfall``) goes to the cells below 1.
* without a budget: ratio / largest ratio. The expected tokens have exactly the raked shares, but the
  rarest cell sets the rate of the whole corpus.

DataFrame operations only. A null margin is a value of its own. Documents without a token weigh
nothing and stay. Rows that repeat an ID share their draw; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.columns import seeded_uniform
from tastegraph.llm.common import attach_left, packed
from tastegraph.session import discard, written

ROUNDS = 6
SEPARATOR = "\x01"


def token_count(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def length_topic(tokens: Column) -> Column:
    """A stand-in topic for tables that have none: the length band of the text."""
    return F.when(tokens < 200, "short").when(tokens < 800, "medium").otherwise("long")


def named(value: Column) -> Column:
    """A margin's value as text that tells null from empty."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target weights (value, target) of a margin: its present tokens to a power (0: all equal)."""
    return (
        cells.groupBy(F.col(margin).alias("value"))
        .agg(F.sum("base").alias("tokens"))
        .filter("tokens > 0")
        .select("value", F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("target"))
    )


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margins, base) with ``weight``: raked to ``targets`` (value, target) of each margin.

    Targets are shares; they need not add up to one. Values without a target get weight 0. After
    each margin the cells are written: a plan holds one join, where those of a whole round in one
    would read the cells eight times and have the driver hold seven broadcasts.
    """
    weights = cells.withColumn("weight", F.col("base").cast("double"))
    goals = []
    for margin, target in targets.items():
        target = written(target)
        goals.append(target)
        total = target.agg(F.sum("target")).head()[0] or 1.0
        share = target.select(F.col("value").alias(margin), (F.col("target") / total).alias(f"share{margin}"))
        weights = weights.join(share, margin, "left")
    weights = written(weights.fillna(0.0, [f"share{m}" for m in targets]))
    discard(*goals)
    for margin in [*targets] * rounds:
        # Every cell knows its value's share, so a margin takes one join.
        factor = F.when(F.sum("weight") > 0, F.max(f"share{margin}") / F.sum("weight")).otherwise(0.0)
        scaled = weights.join(weights.groupBy(margin).agg(factor.alias("factor")), margin)
        before, weights = weights, written(scaled.withColumn("weight", F.col("weight") * F.col("factor")).drop("factor"))
        discard(before)
    return weights.select(*cells.columns, "weight")


def _celled(docs: DataFrame, margins: dict[str, Column], text_col: str, extra: list[Column]) -> DataFrame:
    text = F.col(text_col)
    names = [f"_{m}" for m in margins]
    rows = docs.select(*extra, token_count(text).alias("_tokens"), *[named(c).alias(n) for n, c in zip(names, margins.values())])
    return rows.withColumn("_cell", F.concat_ws(SEPARATOR, *names))


def budget_scale(raked: DataFrame, budget: float) -> float | None:
    """The c for which min(1, c * ratio) of every cell's tokens add up to ``budget`` tokens.

    None: even all cells that have a ratio hold no more. Cells that reach 1 stay there as c grows,
    so each round adds up the others anew until no further cell reaches 1.
    """
    scale, reached = 0.0, -1
    full = F.col("ratio") * F.lit(scale) >= 1
    while True:
        part = raked.filter("ratio > 0").agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("base"))), F.sum(F.when(~full, F.col("base") * F.col("ratio")))
        )
        n, held, open_weight = part.head()
        if not open_weight:
            return None
        if n == reached:
            return scale
        reached, scale = n, max(scale, (budget - (held or 0)) / open_weight)
        full = F.col("ratio") * F.lit(scale) >= 1


def probabilities(docs: DataFrame, margins: dict[str, Column], powers: dict[str, float], targets: dict[str, DataFrame] | None = None, text_col: str = "text", rounds: int = ROUNDS, budget: float | None = None) -> DataFrame:
    """(_cell, n, tokens, weight, wanted, probability) of every cell of ``docs``.

    A margin's targets come from ``targets`` (value as of ``named``, target) or else from its
    present tokens to the power in ``powers``. ``wanted`` is the probability before it is held at 1.
    """
    if budget is not None and not 0 < budget <= 1:
        raise ValueError("budget has to be a share of the present tokens")
    names = [f"_{m}" for m in margins]
    counted = _celled(docs, margins, text_col, [])
    cells = written(counted.groupBy(*names, "_cell").agg(F.sum("_tokens").alias("base"), F.count(F.lit(1)).alias("n")))
    goals = {f"_{m}": (targets or {}).get(m) for m in margins}
    goals = {m: tempered(cells, m, powers[m[1:]]) if t is None else t for m, t in goals.items()}
    total = cells.agg(F.sum("base")).head()[0] or 0
    raked = rake(cells, goals, rounds).withColumn("ratio", F.when(F.col("base") > 0, F.col("weight") * total / F.col("base")))
    if budget is None:
        most = raked.agg(F.max("ratio")).head()[0] or 1.0
        wanted = F.col("ratio") / most
    else:
        raked = written(raked)
        scale = budget_scale(raked, budget * total)
        wanted = F.col("ratio") * scale if scale is not None else (F.col("ratio") > 0).cast("double")
    wanted = F.coalesce(wanted, F.lit(1.0))
    return raked.select(
        "_cell", "n", F.col("base").alias("tokens"), F.coalesce("ratio", F.lit(0.0)).alias("weight"),
        wanted.alias("wanted"), F.least(wanted, F.lit(1.0)).alias("probability"),
    )


def shortfall(cells: DataFrame) -> DataFrame:
    """(cell, tokens, wanted, short) of the saturated ``cells`` of ``probabilities``: the tokens they
    hold, would need for their raked share of the sample, and lack."""
    need = F.col("tokens") * F.col("wanted")
    return cells.filter("wanted > 1").select(F.col("_cell").alias("cell"), "tokens", need.alias("wanted"), (need - F.col("tokens")).alias("short"))


def mix_report(docs: DataFrame, margins: dict[str, Column], powers: dict[str, float], seed: int = 3, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """(id, tokens, weight, probability, kept) of every row."""
    cells = written(probabilities(docs, margins, powers, text_col=text_col, **options))
    rows = _celled(docs, margins, text_col, [F.col(id_col).alias("_id")]).select("_id", "_tokens", "_cell")
    found = attach_left(rows, cells.select("_cell", "n", "weight", "probability"), "_cell", "n")
    return found.select(
        F.col("_id").alias(id_col), F.col("_tokens").alias("tokens"), "weight", "probability", _drawn("_id", seed).alias("kept")
    )


def _drawn(id_col: str, seed: int) -> Column:
    return seeded_uniform(f"mix{seed}", F.coalesce(F.col(id_col).cast("string"), F.lit(""))) < F.col("probability")


def mix(docs: DataFrame, margins: dict[str, Column], powers: dict[str, float], seed: int = 3, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The sampled rows of ``docs`` with their columns."""
    cells = written(probabilities(docs, margins, powers, text_col=text_col, **options)).select("_cell", "n", "probability")
    rows = packed(docs, F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[c.alias(f"_m{i}") for i, c in enumerate(margins.values())])
    celled = _celled(rows, {m: F.col(f"_m{i}") for i, m in enumerate(margins)}, "_text", [F.col("row"), F.col("_id")])
    kept = attach_left(celled.select("row", "_id", "_cell"), cells, "_cell", "n").filter(_drawn("_id", seed))
    return kept.select("row.*")
