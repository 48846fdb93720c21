"""Mixing sources to target weights (DataFrame operations only).

Temperature mixing: a source's weight is its token share raised to an
exponent between 0 (equal weights) and 1 (natural shares), normalised. The
exponent is bisected until the weights reach a target entropy without any
source being repeated more often than allowed. Weights become a token budget
per source: whole passes over the source, and a last pass over a random part.
Every pass is a permutation of its own, and the passes are dealt into blocks
of equal token budget, each holding all sources in the wanted proportions.

Scale: the text is read once to count words; everything else runs on narrow
rows. Sums over sources are Spark aggregates. A running total is a total per
bucket, cumulated, plus a window inside a bucket of some thousand rows, and a
source gets as many buckets as its size needs, so a hot source is split.

Defined cases: a null source is a source of its own; a null text has no words;
sources without words keep one pass and weight 0; repeated rows count each;
an empty table gives an empty result; other columns are ignored by
``mix_blocks`` and returned unchanged by ``mix_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import UNIT, WORD_PATTERN, text_or_empty, unit_hash
from lapse.operators.materialize import join_small, land

# Entropy target as a share of the largest possible one (all sources equal).
ENTROPY_SHARE = 0.95
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 20
BUCKET_ROWS = 4096
SEED = 7
LEVELS, PASSES = 4, 6  # bisection levels per aggregate, aggregates


def _measures(plan: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """Entropy of the weights and the largest repetition, per exponent."""
    sums = []
    for j, a in enumerate(exponents):
        p = F.pow("share", F.lit(a))
        ratio = F.pow("share", F.lit(a - 1.0))
        sums += [
            F.sum(p).alias(f"z{j}"),
            F.sum(p * F.log("share")).alias(f"l{j}"),
            F.max(ratio).alias(f"hi{j}"),
            F.min(ratio).alias(f"lo{j}"),
        ]
    row = plan.where("share > 0").agg(F.sum("tokens").alias("total"), *sums).first()
    out = []
    for j, a in enumerate(exponents):
        z = row[f"z{j}"]
        entropy = math.log(z) - a * row[f"l{j}"] / z
        repeats = row[f"hi{j}"] / row[f"lo{j}"] if budget is None else budget / row["total"] * row[f"hi{j}"] / z
        out.append((entropy, repeats))
    return out


def solve_exponent(plan: DataFrame, entropy_share: float, max_repeats: float, budget: float | None) -> float:
    """The largest exponent that reaches the entropy, raised where the
    repetition limit asks for it. Both measures fall as the exponent grows;
    each aggregate evaluates ``LEVELS`` levels of the bisection at once."""
    sources = plan.where("share > 0").count()
    if sources < 2:
        return 1.0
    target = entropy_share * math.log(sources)

    def bisect(holds_low) -> float:
        lo, hi = 0.0, 1.0  # holds_low is true at lo, false at hi
        for _ in range(PASSES):
            n = 1 << LEVELS
            grid = [lo + (hi - lo) * i / n for i in range(1, n)]
            good = [holds_low(*m) for m in _measures(plan, grid, budget)]
            k = good.index(False) if False in good else len(good)
            lo, hi = ([lo, *grid][k], [*grid, hi][k])
        return (lo + hi) / 2

    (_, r0), (e1, _) = _measures(plan, [0.0, 1.0], budget)
    by_entropy = 1.0 if e1 >= target else bisect(lambda e, r: e >= target)
    by_repeats = 0.0 if r0 <= max_repeats else bisect(lambda e, r: r > max_repeats)
    return max(by_entropy, by_repeats)


def _draw(seed: int = SEED) -> Column:
    return unit_hash(F.lit(seed), F.col("doc_id"), F.col("text"))


def _narrow(docs: DataFrame) -> DataFrame:
    tokens = F.regexp_count(text_or_empty(), F.lit(WORD_PATTERN)).cast("long")
    return land(docs.select("doc_id", "source", tokens.alias("tokens"), _draw().alias("draw")), "mix-rows")


def mixing_plan(rows: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS, budget: float | None = None) -> DataFrame:
    """One row per source: weight, whole passes, and the part of a last pass.

    ``budget`` in tokens; None takes the smallest one that gives every source
    at least one whole pass. ``threshold``: rows whose draw is not above it
    belong to the last pass.
    """
    sources = rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    plan = land(sources, "mix-sources")
    all_tokens = plan.agg(F.sum("tokens")).first()[0] or 0
    plan = plan.withColumn("share", F.col("tokens") / F.lit(float(max(1, all_tokens))))
    exponent = solve_exponent(plan, entropy_share, max_repeats, budget)
    power = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent))).otherwise(F.lit(0.0))
    norm, least = plan.agg(F.sum(power), F.min(F.when(F.col("share") > 0, power / F.col("tokens")))).first()
    if not norm:
        norm, least = 1.0, 1.0
    wanted = float(budget) if budget is not None else norm / least
    plan = plan.withColumns({"exponent": F.lit(exponent), "weight": power / F.lit(norm)})
    passes = F.when(F.col("tokens") > 0, F.round(F.col("weight") * wanted / F.col("tokens"), 9)).otherwise(F.lit(1.0))
    plan = plan.withColumn("passes", passes).withColumns(
        {
            "whole": F.floor("passes").cast("int"),
            "rest": F.round((F.col("passes") - F.floor("passes")) * F.col("tokens")).cast("long"),
            "buckets": F.ceil(F.col("docs") / BUCKET_ROWS),
        }
    )
    plan = land(plan, "mix-plan")
    return land(_thresholds(rows, plan), "mix-plan")


def _bucket(column: Column) -> Column:
    return F.floor(column / F.lit(float(UNIT)) * F.col("buckets"))


def _thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Find where the last pass of each source ends, bucket first, row next."""
    asked = plan.where("rest > 0").select(F.col("source").alias("s"), "rest", "buckets")
    drawn = join_small(rows, asked, rows["source"].eqNullSafe(F.col("s")), "inner")
    drawn = drawn.groupBy("source", "rest", _bucket(F.col("draw")).alias("bucket"), "draw").agg(F.sum("tokens").alias("tokens"))
    totals = drawn.groupBy("source", "rest", "bucket").agg(F.sum("tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    edge = totals.withColumn("upto", upto).where("upto - n < rest and upto >= rest")
    edge = edge.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("rest") - F.col("upto") + F.col("n")).alias("left_over"))
    inside = drawn.join(edge, drawn["source"].eqNullSafe(F.col("s")) & (drawn["bucket"] == F.col("b")))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1))
    ends = (
        inside.withColumn("before", F.coalesce(before, F.lit(0)))
        .where("before < left_over")
        .groupBy(F.col("source").alias("t"))
        .agg(F.max("draw").alias("threshold"))
    )
    return plan.join(ends, plan["source"].eqNullSafe(F.col("t")), "left").drop("t")


def _with_passes(rows: DataFrame, plan: DataFrame, draw: Column, keep: list[str], name: str) -> DataFrame:
    """Join each row with its source's plan (columns prefixed ``__mix_``) and
    repeat it as often as the passes say; ``name`` gets the pass from 0."""
    small = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in {"source", "whole", "threshold", *keep}])
    joined = join_small(rows, small, rows["source"].eqNullSafe(F.col("__mix_source")), "inner")
    n = F.col("__mix_whole") + F.when(draw <= F.col("__mix_threshold"), F.lit(1)).otherwise(F.lit(0))
    return joined.withColumn(name, F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as documents: every row once per pass it takes part in,
    all columns unchanged."""
    plan = mixing_plan(_narrow(docs), **options)
    out = _with_passes(docs, plan, _draw(), [], "__mix_pass")
    return out.select(*[docs[c] for c in docs.columns])


def mix_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, **options) -> DataFrame:
    """The mixture's order: per copy its pass, block and place in its source.

    Returns doc_id, source, n_tokens, pass, source_start (tokens of the source
    before this copy), block, block_key (order inside the block), weight,
    exponent and passes.
    """
    rows = _narrow(docs)
    plan = mixing_plan(rows, **options)
    copies = _with_passes(rows, plan, F.col("draw"), ["tokens", "weight", "exponent", "passes", "buckets"], "pass")
    copies = copies.withColumnsRenamed({f"__mix_{c}": c for c in ("weight", "exponent", "passes", "buckets")})
    copies = copies.withColumn("key", unit_hash("draw", "pass")).withColumn("bucket", _bucket(F.col("key")))
    inner = ["source", "pass", "bucket"]
    totals = copies.groupBy(*inner).agg(F.sum("tokens").alias("n"))
    earlier = Window.partitionBy("source", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"{c}_") for c in inner], F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*inner).orderBy("key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    copies = copies.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    same = copies["source"].eqNullSafe(F.col("source_")) & (copies["pass"] == F.col("pass_")) & (copies["bucket"] == F.col("bucket_"))
    start = F.col("pass") * F.col("__mix_tokens") + F.col("offset") + F.col("inside")
    share = F.greatest(F.col("weight") * block_tokens, F.lit(1e-9))
    placed = copies.join(offsets, same).withColumn("source_start", start.cast("long"))
    block = F.when(F.col("weight") > 0, F.floor(F.col("source_start") / share)).otherwise(F.lit(0))
    return placed.select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), "pass", "source_start",
        block.cast("long").alias("block"), unit_hash("key", F.lit(SEED)).alias("block_key"),
        "weight", "exponent", "passes",
    )
