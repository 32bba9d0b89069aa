"""Mixing sources to target weights, in DataFrame operations only.

The tree is domain - language - source. A budget of tokens runs down the tree by the
weights. What a node cannot take, because all its tokens are used in every allowed epoch,
goes to its siblings by their weights; only what a whole family cannot take goes to the
family's own siblings. Filling every level to the capacity of its subtrees does exactly
that. A leaf then takes whole epochs and, of one more epoch, the prefix of a seeded order
whose tokens fit.

The prefix is found by radix: token sums per leading digits of the order's hash tell in
which bucket the prefix ends, twice, and only the rows of that small bucket are sorted. So
a leaf with a third of all documents is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fadecast.llm import common

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
MAX_EPOCHS = 4
SHARE = 80  # per cent of all tokens to be budgeted
SEED = 20240601
DIGITS = 3  # hash digits of a bucket

# Target weights by path; a path that is not named weighs 1.
WEIGHTS = {"web": 3, "reference": 2, "forum": 2, "web/en": 2, "reference/en": 3, "web/en/src0": 4}
DOMAINS = ("web", "reference", "forum")


def domain_of(source: Column) -> Column:
    """The domain of a source name, by its number; sources without one are ``other``."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    which = F.element_at(F.array(*map(F.lit, DOMAINS)), (F.expr("try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT)") % len(DOMAINS) + 1))
    return F.when(F.coalesce(number, F.lit("")) == "", F.lit("other")).otherwise(which)


def _path(depth: int) -> Column:
    return F.concat_ws("/", *LEVELS[:depth])


def _weights(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    rows = [f"('{k}', {int(v)})" for k, v in weights.items()] or ["('', 1)"]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(path, w)").select("path", F.col("w").cast("long"))


def budgets(leaves: DataFrame, weights: dict[str, int], total: int, max_epochs: int) -> DataFrame:
    """``leaf, tokens, budget`` for ``leaves (domain, lang, source, tokens)``.

    All arithmetic is on whole tokens. A weight of 0 shuts a branch.
    """
    named = F.broadcast(_weights(leaves.sparkSession, weights))  # as long as the given dictionary
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for depth in (3, 2, 1):  # capacities, from the leaves up
        nodes = (
            nodes.withColumn(f"p{depth}", _path(depth))
            .join(named.toDF("_p", "_w"), F.col(f"p{depth}") == F.col("_p"), "left")
            .withColumn(f"w{depth}", F.coalesce("_w", F.lit(1).cast("long")))
            .drop("_p", "_w")
        )
    shut = (F.col("w1") == 0) | (F.col("w2") == 0) | (F.col("w3") == 0)
    nodes = nodes.withColumn("cap", F.when(shut, 0).otherwise(F.col("cap")))
    nodes = common.written(nodes, "leaves")
    given = None
    for depth in (1, 2, 3):
        up = "p0" if depth == 1 else f"p{depth - 1}"
        level = nodes.withColumn("p0", F.lit("")).groupBy(up, f"p{depth}", f"w{depth}").agg(F.sum("cap").alias("c"))
        level = level.withColumnRenamed(f"w{depth}", "w")
        if given is None:  # the root: one row per domain
            level = level.withColumn("b", F.least(F.sum("c").over(Window.partitionBy(up)), F.lit(int(total)).cast("long")))
        else:
            level = level.join(given, up)
        order = Window.partitionBy(up).orderBy(F.col("c") / F.greatest("w", F.lit(1)), f"p{depth}")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        family = Window.partitionBy(up)
        level = (
            level.withColumn("w_left", F.sum("w").over(family) - F.coalesce(F.sum("w").over(before), F.lit(0)))
            .withColumn("b_left", F.col("b") - F.coalesce(F.sum("c").over(before), F.lit(0)))
            .withColumn("full", F.col("c") * F.col("w_left") <= F.col("b_left") * F.col("w"))
            .withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(family), F.lit(0)))
            .withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("w"))).over(family))
            .withColumn("b", F.expr("CASE WHEN full OR c = 0 THEN c ELSE least(c, w * (b - taken) div w_open) END"))
        )
        given = level.select(f"p{depth}", "b")
    return nodes.join(given, "p3").select(F.col("p3").alias("leaf"), "tokens", F.col("b").alias("budget"))


def _cut(rows: DataFrame, digits: int) -> DataFrame:
    """Per leaf the bucket in which the prefix ends and the tokens of the buckets before it.

    ``rows``: leaf, h, n, rest, spent. The sums hold at most 16**DIGITS rows per leaf.
    """
    sums = rows.groupBy("leaf", "rest", "spent", F.substring("h", 1, digits).alias("bucket")).agg(F.sum("n").alias("n"))
    upto = F.col("spent") + F.sum("n").over(Window.partitionBy("leaf").orderBy("bucket"))
    sums = sums.withColumn("upto", upto)
    over = F.col("upto") > F.col("rest")
    return sums.groupBy("leaf").agg(
        F.min(F.when(over, F.col("bucket"))).alias("bucket"),
        F.coalesce(F.max(F.when(~over, F.col("upto"))), F.max("spent")).alias("before"),
    )


def mix(
    docs: DataFrame,
    weights: dict[str, int],
    share: int = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, leaf, n_tokens, copies`` per row of ``docs (doc_id, text, domain, lang, source)``.

    Tokens are words between ASCII white space. ``copies`` says how often the mix takes the
    document: the whole epochs of its leaf, and one more if it stands in the prefix of the
    next epoch. The budget is ``share`` per cent of all tokens.

    Null and empty texts have no tokens and 0 copies. Null names of a level are ``(none)``.
    Rows with one id have the same place in the order: they are taken together or not at
    all. Rows without an id share one place. An empty table gives an empty table. Other
    columns are ignored.
    """
    named = docs.select("doc_id", "text", *(F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in LEVELS))
    base = named.select(
        "doc_id",
        *LEVELS,
        _path(3).alias("leaf"),
        F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long").alias("n"),
    )
    base = common.written(base, "tokens")
    leaves = common.written(base.filter("n > 0").groupBy(*LEVELS).agg(F.sum("n").alias("tokens")), "tree")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0] * share // 100
    plan = budgets(leaves, weights, total, max_epochs).select(
        "leaf", F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("rest")
    )
    plan = common.sized(plan, width=100)
    rows = base.filter("n > 0").join(plan, "leaf")
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = common.written(rows.select("doc_id", "leaf", "n", "epochs", "rest", h.alias("h")), "order")
    first = common.sized(_cut(rows.withColumn("spent", F.lit(0).cast("long")), DIGITS))
    one = rows.join(first, "leaf")
    bucket = F.substring("h", 1, DIGITS)
    inner = one.filter(bucket == F.col("bucket")).select("doc_id", "leaf", "n", "epochs", "rest", "h", F.col("before").alias("spent"))
    second = common.sized(_cut(inner, 2 * DIGITS))
    two = inner.join(second.toDF("leaf", "b2", "before"), "leaf")
    bucket2 = F.substring("h", 1, 2 * DIGITS)
    last = two.filter(bucket2 == F.col("b2"))
    upto = F.col("before") + F.sum("n").over(
        Window.partitionBy("leaf").orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    shape = ["doc_id", "leaf", "n", "epochs", "more"]
    taken = (
        one.filter(F.col("bucket").isNull() | (bucket != F.col("bucket")))
        .withColumn("more", F.col("bucket").isNull() | (bucket < F.col("bucket")))
        .select(*shape)
        .unionByName(
            two.filter(F.col("b2").isNull() | (bucket2 != F.col("b2")))
            .withColumn("more", F.col("b2").isNull() | (bucket2 < F.col("b2")))
            .select(*shape)
        )
        .unionByName(last.withColumn("more", upto <= F.col("rest")).select(*shape))
    )
    copies = F.col("epochs") + F.col("more").cast("long")
    none = base.filter("n = 0").select("doc_id", "leaf", F.col("n").alias("n_tokens"), F.lit(0).cast("long").alias("copies"))
    return taken.select("doc_id", "leaf", F.col("n").alias("n_tokens"), copies.alias("copies")).unionByName(none)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs.withColumn("domain", domain_of(F.col("source"))), WEIGHTS)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with ``leaf`` and ``copies``, which replace columns of those names."""
    plain = docs.select("doc_id", "text", "lang", "source").withColumn("domain", domain_of(F.col("source")))
    chosen = mix(plain, WEIGHTS).filter("copies > 0").select("doc_id", "leaf", "copies").distinct()
    chosen = chosen.toDF("chosen id", "chosen leaf", "chosen copies")
    names = [F.coalesce(c.cast("string"), F.lit(NONE)) for c in (domain_of(F.col("source")), F.col("lang"), F.col("source"))]
    same = F.col("doc_id").eqNullSafe(F.col("chosen id")) & (F.concat_ws("/", *names) == F.col("chosen leaf"))
    out = docs.join(common.sized(chosen, width=100), same)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("leaf", "copies")]
    return out.select(*own, F.col("chosen leaf").alias("leaf"), F.col("chosen copies").alias("copies"))


_VALUES = ", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items())
_NUMBER = "regexp_extract(source, '([0-9]{1,9})$', 1)"


def _level_sql(depth: int) -> str:
    up = "''" if depth == 1 else f"p{depth - 1}"
    return f"""
l{depth} AS (SELECT {up} AS up, p{depth} AS p, w{depth} AS w, sum(cap) AS c FROM nodes GROUP BY ALL),
o{depth} AS (
  SELECT l.*, g.b, sum(w) OVER (PARTITION BY l.up)
           - coalesce(sum(w) OVER (PARTITION BY l.up ORDER BY c / greatest(w, 1), l.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left,
         g.b - coalesce(sum(c) OVER (PARTITION BY l.up ORDER BY c / greatest(w, 1), l.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b_left
  FROM l{depth} l JOIN g{depth - 1} g ON l.up = g.p),
f{depth} AS (SELECT *, c * w_left <= b_left * w AS filled FROM o{depth}),
t{depth} AS (
  SELECT *, coalesce(sum(CASE WHEN filled THEN c END) OVER (PARTITION BY up), 0) AS taken,
         sum(CASE WHEN NOT filled THEN w END) OVER (PARTITION BY up) AS w_open FROM f{depth}),
g{depth} AS (SELECT p, CASE WHEN filled OR c = 0 THEN c ELSE least(c, (w * (b - taken)) // w_open) END AS b FROM t{depth})"""


ORACLE = f"""
WITH base AS (
  SELECT doc_id, CASE WHEN coalesce({_NUMBER}, '') = '' THEN 'other'
                      ELSE ['web', 'reference', 'forum'][CAST({_NUMBER} AS INT) % 3 + 1] END AS domain,
         coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS HUGEINT) AS n
  FROM documents),
wt(path, w) AS (VALUES {_VALUES}),
leaves AS (
  SELECT domain, domain || '/' || lang AS p2, domain || '/' || lang || '/' || source AS p3, sum(n) AS tokens
  FROM base WHERE n > 0 GROUP BY ALL),
weighed AS (
  SELECT domain AS p1, p2, p3, tokens, coalesce(a.w, 1) AS w1, coalesce(b.w, 1) AS w2, coalesce(c.w, 1) AS w3
  FROM leaves LEFT JOIN wt a ON a.path = domain LEFT JOIN wt b ON b.path = p2 LEFT JOIN wt c ON c.path = p3),
nodes AS (SELECT *, CASE WHEN w1 * w2 * w3 = 0 THEN 0 ELSE tokens * {MAX_EPOCHS} END AS cap FROM weighed),
g0 AS (SELECT '' AS p, least(sum(cap), sum(tokens) * {SHARE} // 100) AS b FROM nodes),
{_level_sql(1)},{_level_sql(2)},{_level_sql(3)},
plan AS (SELECT p3 AS leaf, b // tokens AS epochs, b % tokens AS rest FROM nodes JOIN g3 ON p = p3),
placed AS (
  SELECT doc_id, leaf, n, epochs, rest,
         md5('{SEED}:' || CAST(CAST(epochs AS BIGINT) AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM (SELECT *, domain || '/' || lang || '/' || source AS leaf FROM base WHERE n > 0) JOIN plan USING (leaf)),
taken AS (SELECT *, sum(n) OVER (PARTITION BY leaf ORDER BY h) AS upto FROM placed)
SELECT doc_id, leaf, CAST(n AS BIGINT) AS n_tokens, CAST(epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM taken
UNION ALL
SELECT doc_id, domain || '/' || lang || '/' || source, 0, 0 FROM base WHERE n = 0
"""
