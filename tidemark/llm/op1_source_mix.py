"""Mixing sources to target weights: temperature, then budgeted blocks.

``temperature`` finds the exponent a in [0, 1] for weights
w_i = p_i^a / sum(p^a) over the sources' token shares p_i. A target entropy
(a share of the largest possible, ln(sources)) asks for the largest a that
reaches it; a repetition limit asks for the smallest a at which no source is
repeated more than that many times as often as the least repeated one. The
limit wins where both are given. Each bisection step is an aggregate over the
table of sources that halves the bracket eight times at once.

``mix`` turns weights into token budgets and these into blocks: every source
is permuted anew in each pass over it, and its stream is cut into one slice of
weight x ``BLOCK_TOKENS`` tokens per block, so that every block holds all
sources in the target proportion. Rows ordered by (block, order_key) are the
mixture. Without a given budget the total is the smallest that gives every
source one whole pass, so no document is lost.

Prefix sums over a source run on two levels: within cells of about
``CELL_DOCS`` documents (ranges of the permutation key) and over the cells'
totals, so a source with a third of all rows is many small windows. Texts are
read for counting words only and never shuffled.

Defined cases: null text counts no tokens; the null source is a source of its
own; a source without tokens has weight 0 and its documents appear once, in
block 0; ties of the permutation key go by id; repeated rows are documents of
their own; an empty table gives an empty mixture; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.staging import read, stage

NAME = "op1_source_mix"
SEED = "mix"
TARGET_ENTROPY = 0.99
MAX_REPETITION = 3.0
BLOCK_TOKENS = 1 << 17
CELL_DOCS = 2000
WORD = r"[^\x20\x09-\x0D]+"
POINTS, ROUNDS = 255, 7

ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n FROM documents
), s AS (
  SELECT source, sum(n)::BIGINT AS n, sum(n) / sum(sum(n)) OVER () AS p FROM d GROUP BY source
), q AS (SELECT list(p) AS ps, {TARGET_ENTROPY} * ln(count(*)) AS h, max(p) / min(p) AS r FROM s WHERE n > 0
), steps(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, mid,
               ln(list_sum([pow(x, mid) for x in ps]))
               - mid * list_sum([pow(x, mid) * ln(x) for x in ps]) / list_sum([pow(x, mid) for x in ps]) >= h AS ok
        FROM (SELECT *, (lo + hi) / 2 AS mid FROM steps, q WHERE i < 56))
), a AS (
  SELECT greatest(
    (SELECT CASE WHEN ln(list_sum(ps)) - list_sum([x * ln(x) for x in ps]) / list_sum(ps) >= h THEN 1.0 ELSE lo END
     FROM steps, q WHERE i = 56),
    (SELECT CASE WHEN r <= {MAX_REPETITION} THEN 0.0 ELSE 1 - ln({MAX_REPETITION}) / ln(r) END FROM q)) AS a
), w AS (
  SELECT source, n, CASE WHEN n > 0 THEN pow(p, a) / (SELECT sum(pow(p, a)) FROM s, a WHERE n > 0) ELSE 0 END AS w FROM s, a
), b AS (
  SELECT *, greatest(n, round(w * (SELECT max(n / w) FROM w WHERE n > 0)))::BIGINT AS budget,
         greatest(1, floor(w * {BLOCK_TOKENS}))::BIGINT AS quota FROM w
), rows AS (
  SELECT d.doc_id, d.source, d.n, pass, b.n AS total, budget, quota, md5('{SEED}:' || pass || ':' || coalesce(doc_id::VARCHAR, 'null')) AS order_key
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source, LATERAL (
    SELECT unnest(range(CASE WHEN b.n = 0 THEN 1 ELSE CAST(ceil(budget / b.n) AS BIGINT) END)) AS pass)
), placed AS (
  SELECT *, pass * total + coalesce(sum(n) OVER (PARTITION BY source, pass ORDER BY order_key, doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM rows
)
SELECT doc_id, source, pass::INTEGER AS pass, (o // quota)::BIGINT AS block, order_key, n AS n_tokens
FROM placed WHERE total = 0 OR o < budget OR pass < budget // total
"""


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_shares(tokens: DataFrame) -> DataFrame:
    """``(source, docs, n, p)`` per source; p is null for sources without tokens."""
    per = tokens.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"))
    total = stage(per, "mix-sources")
    whole = total.agg(F.sum("n")).first()[0] or 0
    return total.withColumn("p", F.when(F.col("n") > 0, F.col("n") / F.lit(float(whole or 1))))


def _measures(shares: DataFrame, points: list[float]) -> list:
    """(a, entropy of the weights, largest share of repetition ratios) at each point."""
    at = shares.filter("p IS NOT NULL").select("p", F.explode(F.array(*map(F.lit, points))).alias("a"))
    power = F.pow("p", F.col("a"))
    found = at.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("l"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    return found.select(
        "a", (F.log("z") - F.col("a") * F.col("l") / F.col("z")).alias("entropy"),
        F.pow(F.col("hi") / F.col("lo"), 1 - F.col("a")).alias("repetition"),
    ).orderBy("a").collect()  # as many rows as points


def _bisect(shares: DataFrame, holds_below) -> float:
    """Where ``holds_below(row)`` turns from true to false on [0, 1]."""
    lo, hi = 0.0, 1.0
    for row in _measures(shares, [1.0]):
        if holds_below(row):
            return 1.0
    for _ in range(ROUNDS):
        points = [lo + (hi - lo) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        rows = _measures(shares, points)
        good = [r["a"] for r in rows if holds_below(r)]
        bad = [r["a"] for r in rows if not holds_below(r)]
        lo, hi = max([lo, *good]), min([hi, *bad])
    return lo


def temperature(shares: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None) -> float:
    """The exponent for ``shares``; 1 keeps the natural shares."""
    n = shares.filter("p IS NOT NULL").count()
    if n == 0:
        return 1.0
    exponent = 0.0 if target_entropy is None and max_repetition is not None else 1.0
    if target_entropy is not None:
        goal = target_entropy * math.log(n)
        exponent = _bisect(shares, lambda r: r["entropy"] >= goal)
    if max_repetition is not None:
        exponent = max(exponent, _bisect(shares, lambda r: r["repetition"] > max_repetition))
    return exponent


def weights(shares: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """``(source, docs, total, w, budget, quota)``; ``budget`` in tokens."""
    power = F.pow("p", F.lit(exponent))
    z = shares.agg(F.sum(power)).first()[0] or 1.0
    w = shares.withColumn("w", F.coalesce(power / F.lit(z), F.lit(0.0)))
    one_pass = budget is None
    if one_pass:
        budget = w.filter("w > 0").agg(F.max(F.col("n") / F.col("w"))).first()[0] or 0.0
    own = F.round(F.col("w") * F.lit(float(budget))).cast("long")
    own = F.greatest("n", own) if one_pass else own
    quota = F.greatest(F.lit(1), F.floor(F.col("w") * BLOCK_TOKENS)).cast("long")
    return w.select("source", "docs", F.col("n").alias("total"), "w", own.alias("budget"), quota.alias("quota"))


def mix(tokens: DataFrame, plan: DataFrame, seed: str = SEED) -> DataFrame:
    """``tokens`` is (doc_id, source, n), ``plan`` the table of ``weights``.
    Returns ``(doc_id, source, pass, block, order_key, n_tokens)``, and other
    columns of ``tokens`` after these."""
    carried = [c for c in tokens.columns if c not in ("doc_id", "source", "n")]
    plan = stage(plan, "mix-plan").withColumnRenamed("source", "__source")
    passes = F.when(F.col("total") == 0, 1).otherwise(F.ceil(F.col("budget") / F.col("total")))
    rows = (
        tokens.join(plan, tokens["source"].eqNullSafe(plan["__source"]))
        .select(
            "doc_id", "source", "n", *carried, "docs", "total", "budget", "quota",
            F.explode(F.sequence(F.lit(0).cast("long"), passes.cast("long") - 1)).alias("pass"),
        )
        .withColumn("order_key", F.md5(F.concat_ws(":", F.lit(seed), "pass", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
        .withColumn(
            "cell",
            F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") * F.ceil(F.col("docs") / CELL_DOCS) / F.lit(float(1 << 32))),
        )
    )
    key = ["source", "pass", "cell"]
    cells = rows.groupBy(*key).agg(F.sum("n").alias("__sum"))
    ahead = Window.partitionBy("source", "pass").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = stage(cells.withColumn("__before", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).cast("long")).drop("__sum"), "mix-cells")
    cells = cells.select(*[F.col(c).alias(f"__{c}") for c in key], "__before")
    inside = Window.partitionBy(*key).orderBy("order_key", "doc_id", "n", *carried).rowsBetween(Window.unboundedPreceding, -1)
    same = [rows[c].eqNullSafe(cells[f"__{c}"]) for c in key]
    offset = F.col("pass") * F.col("total") + F.col("__before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = rows.join(cells, same[0] & same[1] & same[2]).withColumn("__at", offset.cast("long"))
    whole = F.col("pass") < F.floor(F.col("budget") / F.col("total"))
    return placed.filter((F.col("total") == 0) | (F.col("__at") < F.col("budget")) | whole).select(
        "doc_id", "source", F.col("pass").cast("int").alias("pass"), F.expr("__at div quota").alias("block"),
        "order_key", F.col("n").alias("n_tokens"), *carried,
    )


def source_mix(
    docs: DataFrame, target_entropy: float | None = TARGET_ENTROPY, max_repetition: float | None = MAX_REPETITION, budget: int | None = None,
    carried: tuple[Column, ...] = (),
) -> DataFrame:
    """The mixture of ``docs`` (doc_id, text, source) as rows of ``mix``."""
    tokens = stage(docs.select("doc_id", "source", count_tokens(F.col("text")).alias("n"), *carried), "mix-tokens")
    shares = source_shares(tokens)
    return mix(tokens, weights(shares, temperature(shares, target_entropy, max_repetition), budget))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(read(spark, sf_dir, "documents"))
