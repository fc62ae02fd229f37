"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent
between 0 (all sources alike) and 1 (as they are), normalised. The exponent is
the largest on a grid of ``1 / STEPS`` whose weights reach a target entropy;
a repetition limit (the most passes over any source that the budget may take)
overrides it upwards. Both are found by bisection; entropy falls and the
repetition limit is met more easily as the exponent grows.

Each source then gets ``floor(weight * budget)`` tokens (rounding errors aside) as a sequence of
blocks. A block is a keyed permutation of the source's documents; all blocks
but the last are complete, the last stops at the last document that fits.
``start`` is a document's token offset in its source's sequence, so
``start / quota`` interleaves sources evenly at any place of the mixture.

DataFrame and SQL functions only. Prefix sums go over ``PREFIX`` digits of the
permutation key first and then within a digit group, so a source of any size
is spread over tasks. A null source is a source of its own; null and blank
texts have no tokens; a source without tokens gets weight 0 and no rows. Rows
that share a doc_id (null included) are one document of its least source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Grid of the exponent: 2 ** 20 steps, found in rounds of 5 bisection steps a job.
LEVELS, LEVELS_A_JOB = 20, 5
STEPS = 1 << LEVELS
#: Hex digits of the permutation key that form a digit group.
PREFIX = 3
TARGET_ENTROPY = 0.95
MAX_REPEATS = 4.0
SEED = "mix-1"
#: Lifts a quota that rounding leaves a hair below a whole number, such as a whole pass at exponent 1.
SLACK = 1 + 1e-12
WORD = r"[^ \t\n\x0B\f\r]+"


def document_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, source and n_tokens (words) of each document."""
    n = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", n.alias("n")).groupBy("doc_id").agg(
        F.min("source").alias("source"), F.sum("n").alias("n_tokens"))


def _largest(shares: DataFrame, holds) -> int:
    """Largest grid step that ``holds`` (true at 0, then false for good), by bisection.

    A job evaluates all points that the next steps may ask for, as
    aggregates over the sources; the driver sees those scalars alone.
    """
    low, high = 0, STEPS + 1  # holds at low, not at high
    while high - low > 1:
        points: list[int] = []
        spans = [(low, high)]
        for _ in range(LEVELS_A_JOB):
            spans = [s for s in spans if s[1] - s[0] > 1]
            mids = [(a + b) // 2 for a, b in spans]
            points += mids
            spans = [x for (a, b), m in zip(spans, mids, strict=True) for x in ((a, m), (m, b))]
        row = shares.agg(*(holds(F.lit(p / STEPS)).alias(f"p{p}") for p in points)).first()
        for _ in range(LEVELS_A_JOB):
            if high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if row[f"p{mid}"] else (low, mid)
    return low


def _total(alpha: Column) -> Column:
    return F.sum(F.pow("share", alpha))


def entropy(alpha: Column) -> Column:
    """Entropy of the weights at an exponent, as an aggregate over sources."""
    z = _total(alpha)
    return F.log(z) - alpha * F.sum(F.pow("share", alpha) * F.log("share")) / z


def most_repeats(alpha: Column, passes: float) -> Column:
    """Most passes over a source, where the budget is ``passes`` times all tokens."""
    return F.max(F.pow("share", alpha) / F.col("share")) / _total(alpha) * F.lit(passes)


def weigh_sources(tokens: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY,
                  max_repeats: float = MAX_REPEATS) -> DataFrame:
    """source, tokens, weight and quota of each source that has tokens.

    ``target_entropy`` is a share of the greatest possible entropy. Without a
    budget, as many tokens as there are.
    """
    sources = cut(tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    n, total = sources.agg(F.count("*"), F.sum("tokens")).first()
    if not n:
        return sources.select("source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota"))
    budget = total if budget is None else budget
    passes = budget / total
    shares = sources.withColumn("share", F.col("tokens") / F.lit(total))
    flat = _largest(shares, lambda a: entropy(a) >= F.lit(target_entropy * math.log(n)))
    # the repetition limit holds from some exponent on: bisect its complement
    over = _largest(shares, lambda a: most_repeats(a, passes) > F.lit(max_repeats)) + 1 \
        if shares.agg(most_repeats(F.lit(0.0), passes)).first()[0] > max_repeats else 0
    alpha = F.lit(min(max(flat, over), STEPS) / STEPS)
    z = shares.agg(_total(alpha)).first()[0]
    weight = F.pow("share", alpha) / F.lit(z)
    return shares.select("source", "tokens", weight.alias("weight"), F.floor(weight * F.lit(budget) * F.lit(SLACK)).cast("long").alias("quota"))


def draw(tokens: DataFrame, weights: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixture: doc_id, source, block, start, n_tokens, weight and quota."""
    plan = weights.where("quota > 0").withColumnRenamed("source", "of")
    blocks = (tokens.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
              .withColumn("block", F.explode(F.expr("sequence(0L, quota div tokens)")))
              .withColumn("h", F.md5(F.concat_ws(":", F.lit(seed), "block", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
              .withColumn("digits", F.substring("h", 1, PREFIX)))
    groups = blocks.groupBy("source", "block", "digits").agg(F.sum("n_tokens").alias("held"))
    before = Window.partitionBy("source", "block").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(groups.select(F.col("source").alias("of"), F.col("block").alias("at"), F.col("digits").alias("group"),
                                F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead")))
    within = Window.partitionBy("source", "block", "digits").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (blocks.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")) & (F.col("digits") == F.col("group")))
              .withColumn("start", F.col("block") * F.col("tokens") + F.col("ahead") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))))
    return placed.where("start + n_tokens <= quota").select("doc_id", "source", "block", "start", "n_tokens", "weight", "quota")


def mix(docs: DataFrame, **limits) -> DataFrame:
    """The mixture of ``docs`` (see ``draw``); ``limits`` as in ``weigh_sources``."""
    tokens = cut(document_tokens(docs))
    return draw(tokens, weigh_sources(tokens, **limits))


def mix_documents(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture draws its document."""
    drawn = mix(docs, **limits).select(F.col("doc_id").alias("drawn_id"))
    return docs.join(drawn, F.col("doc_id").eqNullSafe(F.col("drawn_id"))).select(*(docs[c] for c in docs.columns))


#: DuckDB SQL of ``mix`` over documents; the exponent by a search in two levels of 1,024 steps.
MIX_SQL = rf"""
WITH tok AS (SELECT doc_id, min(source) AS source, sum(coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0))::BIGINT AS n_tokens
             FROM documents GROUP BY doc_id),
src AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM tok GROUP BY source HAVING sum(n_tokens) > 0),
tot AS (SELECT count(*) AS n, sum(tokens)::DOUBLE AS total FROM src),
sh AS (SELECT source, tokens, tokens / total AS share, n, total FROM src, tot),
g1 AS (SELECT range AS step FROM range(0, {STEPS} + 1, 1024)),
e1 AS (SELECT step, ln(sum(pow(share, step / {STEPS}.0))) - step / {STEPS}.0 * sum(pow(share, step / {STEPS}.0) * ln(share)) / sum(pow(share, step / {STEPS}.0)) AS h,
       max(pow(share, step / {STEPS}.0) / share) / sum(pow(share, step / {STEPS}.0)) AS rep, max(n) AS n FROM sh, g1 GROUP BY step),
f1 AS (SELECT coalesce(max(step) FILTER (WHERE h >= {TARGET_ENTROPY} * ln(n)), 0) AS s1, coalesce(max(step) FILTER (WHERE rep > {MAX_REPEATS}), 0) AS r1, bool_or(rep > {MAX_REPEATS} AND step = 0) AS lim FROM e1),
g2 AS (SELECT DISTINCT step FROM (SELECT unnest(range(s1, s1 + 1024)) AS step FROM f1 UNION ALL SELECT unnest(range(r1, r1 + 1024)) FROM f1) WHERE step <= {STEPS}),
e2 AS (SELECT step, ln(sum(pow(share, step / {STEPS}.0))) - step / {STEPS}.0 * sum(pow(share, step / {STEPS}.0) * ln(share)) / sum(pow(share, step / {STEPS}.0)) AS h,
       max(pow(share, step / {STEPS}.0) / share) / sum(pow(share, step / {STEPS}.0)) AS rep, max(n) AS n FROM sh, g2 GROUP BY step),
al AS (SELECT least(greatest(coalesce(max(step) FILTER (WHERE h >= {TARGET_ENTROPY} * ln(n)), 0),
              CASE WHEN (SELECT lim FROM f1) THEN coalesce(max(step) FILTER (WHERE rep > {MAX_REPEATS}), 0) + 1 ELSE 0 END), {STEPS}) / {STEPS}.0 AS alpha FROM e2),
w AS (SELECT source, tokens, pow(share, alpha) / (SELECT sum(pow(share, alpha)) FROM sh, al) AS weight, total FROM sh, al),
plan AS (SELECT source, tokens, weight, floor(weight * total * {SLACK!r}::DOUBLE)::BIGINT AS quota FROM w),
blk AS (SELECT t.doc_id, t.source, t.n_tokens, p.tokens, p.weight, p.quota, unnest(range(0, p.quota // p.tokens + 1)) AS block
        FROM tok t JOIN plan p ON t.source IS NOT DISTINCT FROM p.source WHERE p.quota > 0),
pos AS (SELECT *, block * tokens + coalesce(sum(n_tokens) OVER (PARTITION BY source, block
        ORDER BY md5('{SEED}:' || block || ':' || coalesce(doc_id::VARCHAR, '')), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM blk)
SELECT doc_id, source, block::BIGINT AS block, start::BIGINT AS start, n_tokens, round(weight, 9) AS weight, quota
FROM pos WHERE start + n_tokens <= quota
"""
