"""Quality rules with line frequency across documents.

Base rules look at one document. The line rule looks at all of them: every line is
normalised (trimmed, lower-cased, white space runs as one blank, digits as 0) and hashed,
and the distinct texts of its host that hold it are counted. Copies of one text count
once, since they are the concern of de-duplication and say nothing about a line. A line
above the host's limit is boilerplate. A document that loses more than half of its words
is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common

MIN_WORDS = 50
MAX_REPEAT = 50  # per cent of words in repeated windows
WINDOW = 3
LEAST = 50  # a line in fewer texts of a host is never boilerplate
SHARE = 5  # per cent of a host's texts from which a line is
LOST = 50  # per cent of words that a document may lose

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _repeat_words(w: np.ndarray) -> int:
    """Words covered by windows that occur twice or more."""
    n = len(w) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.unique(w, return_inverse=True)[1].astype(np.int64)
    run = ids[:n]
    for j in range(1, WINDOW):  # numbering the runs keeps the products small and exact
        run = np.unique(run * len(w) + ids[j : j + n], return_inverse=True)[1]
    often = (np.bincount(run) > 1)[run]
    covered = np.zeros(len(w) + 1, np.int64)
    at = np.flatnonzero(often)
    covered[at] += 1
    np.subtract.at(covered, at + WINDOW, 1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, text = batch.columns[:-1], batch.column(batch.num_columns - 1)
        for lo, hi, buf, offsets in common.text_chunks(text):
            starts, ends, first = common.words(buf, offsets, common.SPACE)
            w = common.span_hashes(buf, starts, ends)

            def per_row(mask):
                return np.diff(np.r_[0, np.cumsum(mask)][offsets])

            raw = buf.tobytes()
            spans = list(zip(offsets[:-1], offsets[1:]))
            counts = [
                np.diff(first),
                per_row(~common.SPACE[buf] & ((buf & 0xC0) != 0x80)),
                per_row(_SYMBOL[buf]),
                np.array([_dup_lines(raw[a:b]) for a, b in spans]),
                np.array([_repeat_words(w[a:b]) for a, b in zip(first[:-1], first[1:])]),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(lo, hi - lo) for c in kept), *(pa.array(c.astype(np.int64)) for c in counts)],
                names=[*batch.schema.names[:-1], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def _key(c: Column | str) -> Column:
    return F.unhex(F.md5(c))


def normal_line(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, "[\\x20\\x09-\\x0D]+", " "))), "[0-9]", "0")


def _line_words(line: Column) -> Column:
    """Words of a normalised line, which has one blank between two words."""
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def boilerplate(docs: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """``host, text_key, removed, lost_words`` of the texts of ``docs (host, text)`` that
    hold lines above their host's limit; ``removed`` lists the hashes of those lines.

    A line is above the limit if more than ``least`` distinct texts of the host hold it
    and these are more than ``share`` per cent of the host's distinct texts.
    """
    lines = F.transform(F.split("text", "\n"), normal_line)
    # One row per distinct text of a host; only hashes and word counts are moved.
    texts = docs.filter("text is not null").select(
        "host",
        _key("text").alias("text_key"),
        F.transform(
            F.filter(lines, lambda x: x != ""), lambda x: F.struct(F.xxhash64(x).alias("h"), _line_words(x).alias("w"))
        ).alias("lines"),
    )
    texts = common.written(texts.groupBy("host", "text_key").agg(F.first("lines").alias("lines")), "lines")
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("n_texts"))
    held = texts.select("host", "text_key", F.explode(F.array_distinct(F.transform("lines", lambda x: x.h))).alias("h"))
    often = held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    often = (
        often.join(sizes, often.host.eqNullSafe(sizes.host))
        .filter(F.col("n") * 100 > share * F.col("n_texts"))
        .select(often.host, "h")
    )
    rows = texts.select("host", "text_key", F.explode("lines").alias("line")).select("host", "text_key", "line.h", "line.w")
    return (
        rows.join(often.toDF("k_host", "k_h"), F.col("host").eqNullSafe(F.col("k_host")) & (F.col("h") == F.col("k_h")))
        .groupBy("host", "text_key")
        .agg(F.collect_set("h").alias("removed"), F.sum("w").alias("lost_words"))
    )


def judge(docs: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``kept`` and ``lost_words`` per row of
    ``docs (doc_id, text, host)``.

    Null texts have no words and fail the base rules, as empty ones do. A null host is a
    host of its own. Repeated rows get equal results. Other columns are ignored; an empty
    table gives an empty table.
    """
    d = docs.select("doc_id", "host", _key("text").alias("text_key"), "text")
    base = d.mapInArrow(_base, f"doc_id long, host string, text_key binary, {_BASE}")
    poor = boilerplate(docs.select("host", "text"), least, share)
    poor = poor.select(F.col("host").alias("k_host"), F.col("text_key").alias("k_key"), "lost_words")
    out = base.join(poor, F.col("host").eqNullSafe(F.col("k_host")) & (F.col("text_key") == F.col("k_key")), "left")
    lost = F.coalesce("lost_words", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (100 * lost <= LOST * F.col("n_words"))).alias("kept"),
        lost.alias("lost_words"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return judge(docs.select("doc_id", "text", F.col("source").alias("host")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines leave the texts of the others.

    All columns of ``docs`` pass through, whatever their names.
    """
    # The columns travel under numbers, so that none clashes with a measure.
    held = [F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(docs.columns)]
    at = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    kinds = [f"_c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema)]
    measured = docs.select(*held, _key("text").alias("_key"), F.col("text").alias("_text"))
    measured = measured.mapInArrow(_base, ", ".join([*kinds, "_key binary", _BASE])).filter(~base_failed())
    poor = boilerplate(docs.select(F.col("source").alias("host"), "text"))
    poor = poor.select(F.col("host").alias("_host"), F.col("text_key").alias("_poor"), "removed", "lost_words")
    host, text = F.col(at["source"]), F.col(at["text"])
    out = measured.join(poor, host.eqNullSafe(F.col("_host")) & (F.col("_key") == F.col("_poor")), "left")
    out = out.filter(F.col("lost_words").isNull() | (100 * F.col("lost_words") <= LOST * F.col("n_words")))
    rest = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("removed"), F.xxhash64(normal_line(x))))
    same = F.col("removed").isNull()
    fresh = {"text": F.when(same, text).otherwise(F.array_join(rest, "\n"))}
    if "n_chars" in at:
        fresh["n_chars"] = F.when(same, F.col(at["n_chars"])).otherwise(F.length(fresh["text"])).cast("long")
    return out.select(*(fresh.get(c, F.col(at[c])).alias(c) for c in docs.columns))


_SPACES = "\\x20\\x09-\\x0D"

ORACLE = f"""
WITH d AS (
  SELECT doc_id, source AS host, text, md5(text) AS k, coalesce(regexp_extract_all(text, '[^{_SPACES}]+'), []) AS w FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
often AS (SELECT doc_id, run FROM runs GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT r.doc_id, unnest([i, i + 1, i + 2]) AS p FROM runs r JOIN often o ON r.doc_id = o.doc_id AND r.run = o.run)
  GROUP BY doc_id),
raw_lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw_lines
  WHERE regexp_matches(line, '[^{_SPACES}]') GROUP BY doc_id),
texts AS (SELECT DISTINCT host, k, text FROM d WHERE text IS NOT NULL),
norm AS (
  SELECT host, k, regexp_replace(lower(trim(regexp_replace(line, '[{_SPACES}]+', ' ', 'g'))), '[0-9]', '0', 'g') AS line
  FROM (SELECT host, k, unnest(string_split(text, chr(10))) AS line FROM texts)),
sizes AS (SELECT host, count(*) AS n FROM texts GROUP BY host),
many AS (
  SELECT l.host, l.line FROM (SELECT DISTINCT host, k, line FROM norm WHERE line <> '') l JOIN sizes s ON l.host IS NOT DISTINCT FROM s.host
  GROUP BY l.host, l.line, s.n HAVING count(*) > {LEAST} AND count(*) * 100 > {SHARE} * s.n),
lost AS (
  SELECT n.host, n.k, sum(len(string_split(n.line, ' '))) AS lost_words
  FROM norm n JOIN many m ON n.host IS NOT DISTINCT FROM m.host AND n.line = m.line GROUP BY n.host, n.k),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost.lost_words, 0) AS BIGINT) AS lost_words
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN dups ON dups.doc_id = d.doc_id
         LEFT JOIN lost ON lost.host IS NOT DISTINCT FROM d.host AND lost.k = d.k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AND 100 * lost_words <= {LOST} * n_words AS kept,
       lost_words
FROM m
"""
