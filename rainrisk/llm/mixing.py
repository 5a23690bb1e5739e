"""Mixing sources to target weights: temperature mixing, DataFrame functions only.

A source's natural share is its share of all tokens (words). Weights are
shares to the power ``alpha``, normalised. ``alpha`` in [0, 1] is bisected on
a grid of 2**21 steps (seven levels of the bisection per job, over one row
per source):

* ``entropy``: the largest alpha whose weights have at least that share of
  the entropy of equal weights (1 keeps nature if it is flat enough);
* ``max_repetition``: the smallest alpha with which no source is read more
  than that many times. With both, the larger of the two alphas holds: the
  limit wins over the entropy.

``budget`` is the number of tokens to deal (default: all tokens of the
table); ``"cover"`` takes the smallest budget with which every source is
read in full at least once, so that no document is lost.

Realisation: a source's documents are dealt to blocks by a hash of doc_id;
blocks are permuted by a hash of seed and block, documents inside a block by
their hash. A source gets its budget as whole passes over this permutation
and a last pass that ends with the document that fills the budget. Sums go
block by block (partial aggregates, then a running sum over blocks, then one
inside each block), so no task holds a source.

Cases: null text has no tokens; a document without tokens is read as often
as the permutation reads its place; a null source is a source of its own; a
null doc_id hashes as the empty text; repeated rows are dealt separately;
an empty table gives an empty table, a table without any token keeps each
document once; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

LEVELS, DEPTH = 7, 3          # bisection levels per job, jobs
GRID = 1 << (LEVELS * DEPTH)  # steps of alpha in [0, 1]
BLOCK_DIGITS = 3              # hex digits of a block's number
WORDS = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, seed: str, block_digits: int) -> DataFrame:
    """(doc_id, source, n_tokens, spot, block) of every document."""
    text = F.coalesce("text", F.lit(""))
    spot = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORDS)).cast("long").alias("n_tokens"),
                       spot.alias("spot")).withColumn("block", F.substring("spot", 1, block_digits))


def _alpha(totals: DataFrame, meets, least: bool) -> int:
    """Bisect alpha's grid number: the largest that ``meets`` (monotone
    falling), or with ``least`` the smallest (monotone rising)."""
    lo, width = 0, GRID
    ends = _evaluate(totals, [0, GRID], meets)
    if ends.get(0 if least else GRID):
        return 0 if least else GRID
    if not ends.get(GRID if least else 0):  # even the flattest (or natural) mix fails
        return GRID if least else 0
    while width > 1:
        width //= 1 << LEVELS
        pts = [lo + k * width for k in range(1, 1 << LEVELS)]
        ok = _evaluate(totals, pts, meets)
        flips = sum(1 for p in pts if bool(ok.get(p)) != least)
        lo += flips * width
    return lo + 1 if least else lo


def _evaluate(totals: DataFrame, points: list[int], meets) -> dict[int, bool]:
    grid = totals.withColumn("i", F.explode(F.array(*[F.lit(p) for p in points])))
    p = F.pow(F.col("share"), F.col("i") / F.lit(float(GRID)))
    agg = grid.withColumn("p", p).groupBy("i").agg(
        F.sum("p").alias("z"), F.sum(F.col("p") * F.ln("p")).alias("plp"),
        F.max(F.col("p") / F.col("share")).alias("most"), F.min(F.col("p") / F.col("share")).alias("fewest"),
        F.count(F.lit(1)).alias("n"))
    return {r["i"]: r["ok"] for r in agg.select("i", meets.alias("ok")).collect()}


def temperature(totals: DataFrame, entropy: float | None, max_repetition: float | None, budget) -> float:
    """The exponent for ``totals (share)``, shares above 0."""
    got = []
    if entropy is not None:
        h = F.ln("z") - F.col("plp") / F.col("z")
        got.append(_alpha(totals, h >= F.lit(entropy) * F.ln("n"), least=False))
    if max_repetition is not None:
        reads = F.col("most") / F.col("fewest") if budget == "cover" else \
            F.col("most") / F.col("z") * F.lit(float(budget))
        got.append(_alpha(totals, reads <= F.lit(float(max_repetition)), least=True))
    return max(got, default=GRID) / GRID


def mix_sources(docs: DataFrame, entropy: float | None = None, max_repetition: float | None = None,
                budget=None, seed: str = "mix", block_digits: int = BLOCK_DIGITS) -> DataFrame:
    """Per document: doc_id, source, n_tokens, start (tokens before it in its
    source's permutation) and copies (how often the mix reads it)."""
    m = materialise(measured(docs, seed, block_digits), "mix-docs")
    blocks = materialise(m.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "mix-blocks")
    per = blocks.groupBy("source").agg(F.sum("tokens").alias("total"))
    all_tokens = per.agg(F.sum("total")).first()[0] or 0
    if not all_tokens:
        return m.select("doc_id", "source", "n_tokens", F.lit(0).cast("long").alias("start"),
                        F.lit(1).cast("long").alias("copies"))
    shares = per.where("total > 0").withColumn("share", F.col("total") / F.lit(float(all_tokens)))
    want = "cover" if budget == "cover" else (budget or all_tokens) / all_tokens
    alpha = temperature(shares, entropy, max_repetition, want)
    raised = per.withColumn("p", F.when(F.col("total") > 0, F.pow(F.col("total") / F.lit(float(all_tokens)), F.lit(alpha))))
    z, fewest = raised.agg(F.sum("p"), F.min(F.col("p") / F.col("total"))).first()
    # a source's budget in tokens
    share = F.col("p") / F.lit(fewest) if budget == "cover" else F.col("p") / F.lit(z) * F.lit(float(budget or all_tokens))
    dealt = raised.select(F.col("source").alias("s"), "total", F.floor(F.coalesce(share, F.lit(0.0)) + 0.5).alias("due"))
    order = Window.partitionBy("source").orderBy(F.md5(F.concat(F.lit(f"{seed}/"), "block")), "block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select(F.col("source").alias("bs"), F.col("block").alias("bb"),
                         F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    base = base.join(dealt, F.col("bs").eqNullSafe(F.col("s"))).drop("s")
    inside = Window.partitionBy("source", "block").orderBy("spot", "doc_id", "n_tokens") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = m.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    j = placed.join(base, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
    start = F.col("base") + F.col("inner")
    full = F.when(F.col("total") > 0, F.floor(F.col("due") / F.col("total"))).otherwise(F.lit(1))
    rest = F.col("due") - full * F.col("total")
    last = F.when((F.col("total") > 0) & (start < rest), F.lit(1)).otherwise(F.lit(0))
    return j.select("doc_id", "source", "n_tokens", start.cast("long").alias("start"),
                    (full + last).cast("long").alias("copies"))


ENTROPY, MAX_REPETITION = 0.95, 4.0


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), entropy=ENTROPY, max_repetition=MAX_REPETITION)


OP10_SQL = rf"""
WITH RECURSIVE m AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS n_tokens,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS spot
  FROM documents),
t AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS total FROM m GROUP BY source),
a AS (SELECT CAST(sum(total) AS DOUBLE) AS n FROM t),
s AS (SELECT total / n AS share FROM t, a WHERE total > 0),
-- halve the range of the exponent until one step is left
ent(k, lo, width) AS (
  SELECT 0, 0, {GRID}
  UNION ALL
  SELECT k + 1,
         CASE WHEN (SELECT ln(sum(pow(share, (lo + width // 2) / {GRID}.0)))
                         - sum(pow(share, (lo + width // 2) / {GRID}.0) * ln(pow(share, (lo + width // 2) / {GRID}.0)))
                           / sum(pow(share, (lo + width // 2) / {GRID}.0)) >= {ENTROPY} * ln(count(*)) FROM s)
              THEN lo + width // 2 ELSE lo END,
         width // 2
  FROM ent WHERE width > 1),
rep(k, lo, width) AS (
  SELECT 0, 0, {GRID}
  UNION ALL
  SELECT k + 1,
         CASE WHEN (SELECT max(pow(share, (lo + width // 2) / {GRID}.0) / share)
                           / sum(pow(share, (lo + width // 2) / {GRID}.0)) <= {MAX_REPETITION} FROM s)
              THEN lo ELSE lo + width // 2 END,
         width // 2
  FROM rep WHERE width > 1),
alpha AS (
  SELECT greatest(
    (SELECT CASE WHEN (SELECT ln(sum(share)) - sum(share * ln(share)) / sum(share) >= {ENTROPY} * ln(count(*)) FROM s)
                 THEN {GRID} ELSE lo END FROM ent WHERE width = 1),
    (SELECT CASE WHEN (SELECT max(1 / share) / count(*) <= {MAX_REPETITION} FROM s)
                 THEN 0 ELSE lo + 1 END FROM rep WHERE width = 1)) / {GRID}.0 AS e),
w AS (SELECT source, total, CASE WHEN total > 0 THEN pow(total / n, e) END AS p FROM t, a, alpha),
due AS (SELECT source, total, CAST(floor(coalesce(p / (SELECT sum(p) FROM w) * n, 0) + 0.5) AS BIGINT) AS due FROM w, a),
placed AS (
  SELECT doc_id, source, n_tokens,
         CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source
           ORDER BY md5('mix/' || substr(spot, 1, {BLOCK_DIGITS})), substr(spot, 1, {BLOCK_DIGITS}), spot, doc_id, n_tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM m)
SELECT doc_id, p.source AS source, n_tokens, start,
       CAST(CASE WHEN total > 0 THEN due // total + CASE WHEN start < due % total THEN 1 ELSE 0 END ELSE 1 END AS BIGINT) AS copies
FROM placed p JOIN due d ON p.source IS NOT DISTINCT FROM d.source
"""
