"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A benchmark item is the set of its windows of SIZE words; a window is a set of shingles
of up to SHINGLE words with their offsets. A text can hold a window only if it holds the
window's rarest shingle: at full containment the necessary prefix is one shingle. So
shingles are counted in the corpus, each window enters the join with its rarest one only,
offsets give the one place where the window can start, windows that would reach over an
end of the text are dropped, and what is left is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common

SIZE = 10
SHINGLE = 3
# What separates words once A-Z are lower-cased.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# The same gaps where A-Z still stand.
RAW_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII alone take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: str) -> Column:
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.array_remove(F.split(lower_ascii(whole), GAP), "")


def n_words(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(RAW_WORD)).cast("long")


def _key(text: Column | str) -> Column:
    return F.unhex(F.md5(text))


def _shingled(df: DataFrame, w: str, size: int, at: str, *keep: str) -> DataFrame:
    """``keep``, the place ``at`` and the ``token`` (hash) of each run of ``size`` words of the
    array ``w``. The runs are shifted copies of the array side by side, so that no lambda is
    called per word."""
    n = F.greatest(F.size(w) - (size - 1), F.lit(0))
    shifted = F.arrays_zip(*(F.slice(w, k + 1, n).alias(f"s{k}") for k in range(size)))
    rows = df.select(*keep, F.posexplode(shifted).alias(at, "run"))
    return rows.select(*keep, at, F.xxhash64(*(F.col(f"run.s{k}") for k in range(size))).alias("token"))


def windows(items: DataFrame) -> DataFrame:
    """``item_id, win`` (array of words) for every window of ``items (item_id, text)``."""
    w = items.select("item_id", words("text").alias("w")).filter(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (SIZE - 1)))
    return w.select("item_id", F.explode(F.transform(at, lambda i: F.slice("w", i, SIZE))).alias("win"))


def _occurrences(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``text_key, n, size, pos, token`` of all shingles of the given sizes."""
    out = None
    w = docs.select(_key("text").alias("text_key"), words("text").alias("w")).withColumn("n", F.size("w"))
    for k in sizes:
        t = _shingled(w, "w", k, "pos", "text_key", "n").withColumn("size", F.lit(k))
        out = t if out is None else out.unionByName(t)
    return out


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``text_key, found`` for every distinct text of ``docs (text)`` that holds a window;
    ``found`` lists ``start`` (from 0) and ``win``."""
    win = common.written(windows(items).select("win").distinct(), "windows")
    size = F.least(F.size("win"), F.lit(SHINGLE))
    parts = [
        _shingled(win.filter(size == k), "win", k, "offset", "win").withColumn("size", F.lit(k))
        for k in range(1, SHINGLE + 1)
    ]
    tokens = parts[0].unionByName(parts[1]).unionByName(parts[2])
    sizes = sorted(r[0] for r in tokens.select("size").distinct().collect())  # SHINGLE values at most
    texts = docs.select("text").filter("text is not null")
    # One pass over the corpus: where any shingle of the benchmark occurs.
    known = common.sized(tokens.select("token", "size").distinct())
    seen = common.written(_occurrences(texts, sizes or [SHINGLE]).join(known, ["token", "size"]), "occurrences")
    counts = seen.groupBy("token", "size").agg(F.count(F.lit(1)).alias("seen"))
    ranked = tokens.join(counts, ["token", "size"], "left").fillna(0, ["seen"])
    # A window whose rarest shingle never occurs can be nowhere.
    prefix = (
        ranked.groupBy("win")
        .agg(F.min(F.struct("seen", "token", "offset", "size")).alias("p"))
        .filter("p.seen > 0")
        .select("p.token", "p.size", "p.offset", "win")
    )
    prefix = common.sized(prefix, width=250)
    start = F.col("pos") - F.col("offset")
    near = (
        seen.join(prefix, ["token", "size"])
        .filter((start >= 0) & (start + F.size("win") <= F.col("n")))
        .select("text_key", start.alias("start"), "win")
        .distinct()
    )
    near = common.written(near.groupBy("text_key").agg(F.collect_list(F.struct("start", "win")).alias("near")), "near")
    wanted = common.sized(near.select("text_key"))
    # Split once per text: the aggregate keeps the split out of the expression per candidate.
    full = (
        texts.select(_key("text").alias("text_key"), "text")
        .join(wanted, "text_key", "left_semi")
        .groupBy("text_key")
        .agg(F.first(words("text")).alias("w"))
    )
    same = full.join(near, "text_key").select("text_key", "w", "near")
    found = F.filter("near", lambda c: F.slice("w", c.start + 1, F.size(c.win)) == c.win)
    return common.written(same.select("text_key", found.alias("found")).filter(F.size("found") > 0), "hits")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row of
    ``docs (doc_id, text)`` against ``items (item_id, text)``.

    Null and empty texts have no words and are never hit. Items without words have no
    window, a shorter item is one window. Equal texts get equal results whatever their
    ids. An item without an id can hit words, but is not counted. No items: no hits.
    Other columns are ignored.
    """
    found = hits(docs, items)
    places = F.flatten(F.transform("found", lambda c: F.sequence(c.start, c.start + F.size(c.win) - 1)))
    n_hit = found.select("text_key", F.size(F.array_distinct(places)).cast("long").alias("n_hit"))
    named = windows(items).filter("item_id is not null").distinct()
    by_item = (
        found.select("text_key", F.explode("found.win").alias("win"))
        .distinct()
        .join(common.sized(named, width=250), "win")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    result = n_hit.join(by_item, "text_key", "left").withColumnRenamed("text_key", "k")
    rows = docs.select("doc_id", _key("text").alias("text_key"), n_words("text").alias("n_words"))
    out = rows.join(result, rows.text_key == F.col("k"), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    bad = hits(docs, common.table(spark, sf_dir, "benchmark")).select(F.col("text_key").alias("hit text"))
    return docs.join(common.sized(bad), _key("text") == F.col("hit text"), "left_anti")


_W = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_W} AS w FROM documents),
b AS (SELECT item_id, {_W} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT s.doc_id, s.i, s.n, win.item_id FROM spots s JOIN win ON s.win = win.win),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
