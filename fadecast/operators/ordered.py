"""Ordered operators that never put a whole series into one task.

A window partitioned by the series key alone moves that series to one task, so
one long series stalls the job. Everything ordered is therefore built from four
steps whose tasks hold a bounded number of rows:

* ``positions``        exact row numbers from an ordinal, by counting per chunk;
* ``sorted_positions`` exact row numbers for any sort order, by a range sort;
* ``haloed``           chunks of consecutive rows with copies of the neighbours
                       a sliding frame needs;
* ``running``          cumulative aggregates in two levels, rows then chunks.

The tables of chunk totals hold one row per chunk and key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fadecast.session import checkpointed

# Rows per chunk of consecutive positions, and ordinals per chunk of a file. The
# second is larger because the rows of one key may be spread thinly over a file.
CHUNK = 1 << 16
ORDINAL_CHUNK = 1 << 20
BROADCAST_ROWS = 200_000


def chunk_of(col: str | Column, size: int = CHUNK) -> Column:
    """Number of the chunk an integer ordinal falls into."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c.cast("long") / F.lit(size)).cast("long")


def _group(keys: Sequence[str], chunk: Sequence[str]) -> Column:
    # A struct compares its null fields as equal, so no row is lost to a null key.
    return F.struct(*[F.col(c) for c in (*keys, *chunk)])


def positions(
    df: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    *,
    pos: str = "pos",
    total: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """0-based position within ``keys`` in the order of a unique integer ordinal.

    A chunk is a range of ``size`` ordinals and so holds at most ``size`` rows
    of a key. Without keys nothing bounds the number of chunks of a sparse ordinal,
    and their totals would meet in one task: the rows are sorted by range instead,
    with one total per partition.
    """
    if not keys:
        return sorted_positions(df, keys, [ordinal], pos=pos, total=total)
    size = size or ORDINAL_CHUNK
    d = df.withColumn("_ch", chunk_of(ordinal, size))
    return _positions_in_chunks(d, keys, ["_ch"], [ordinal], pos, total).drop("_ch")


def file_positions(
    df: DataFrame, keys: Sequence[str] = (), *, pos: str = "pos", total: str | None = None
) -> DataFrame:
    """Position in file order for a table read with ``with_file_order``."""
    return _positions_in_chunks(
        df, keys, ["_file", "_block"], ["_row"], pos, total
    )


def _positions_in_chunks(df, keys, chunk, order, pos, total) -> DataFrame:
    d = df.withColumn("_g", _group(keys, chunk))
    counts = d.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    parts = [F.col(f"_g.{k}") for k in keys]
    w = Window.partitionBy(*parts).orderBy(*[F.col(f"_g.{c}") for c in chunk])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_g",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*parts)).alias("_tot"),
    )
    local = Window.partitionBy("_g").orderBy(*order)
    out = d.join(offsets, "_g").withColumn(
        pos, (F.col("_off") + F.row_number().over(local) - 1).cast("long")
    )
    if total:
        out = out.withColumn(total, F.col("_tot"))
    return out.drop("_g", "_off", "_tot")


def sorted_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    pos: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """0-based position within ``keys`` for any ``order`` (its last column unique).

    The rows are range-partitioned on keys and order, which balances however
    long one key or one run of equal times is; the sorted table is written once
    because the partition sizes and the rows must come from the same split.
    """
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    ranged = checkpointed(ranged)
    # The id holds the partition number above bit 33 and the row number below.
    rows = ranged.withColumn("__part", F.shiftright("__id", 33).cast("int")).withColumn(
        "__row", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    )
    rows = rows.withColumn("__g", F.struct(*keys, "__part"))
    # A key lies in one partition or in neighbouring ones, so this table has at
    # most as many rows as there are keys and partitions together.
    runs = rows.groupBy("__g").agg(F.min("__row").alias("__r0"), F.count(F.lit(1)).alias("__n"))
    parts = [F.col(f"__g.{k}") for k in keys]
    w = Window.partitionBy(*parts).orderBy("__g.__part")
    before = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = checkpointed(
        runs.select(
            "__g",
            (F.coalesce(before, F.lit(0)) - F.col("__r0")).alias("__off"),
            F.sum("__n").over(Window.partitionBy(*parts)).alias("__tot"),
        )
    )
    # Its size is known now: sent to all tasks if small, else joined by shuffle.
    few = runs.count() <= BROADCAST_ROWS
    out = rows.join(F.broadcast(runs) if few else runs, "__g")
    out = out.withColumn(pos, (F.col("__row") + F.col("__off")).cast("long"))
    if total:
        out = out.withColumn(total, F.col("__tot"))
    return out.drop("__id", "__part", "__row", "__g", "__off", "__tot")


def haloed(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    *,
    back: int = 0,
    ahead: int = 0,
    size: int = CHUNK,
) -> DataFrame:
    """Copy border rows to the neighbouring chunks.

    Adds ``_c`` (chunk of consecutive positions) and ``_own`` (false on copies).
    A chunk of a key then holds its own ``size`` rows plus ``back`` rows before
    and ``ahead`` rows after them, so a frame within those bounds is complete.
    """
    p = F.col(pos)
    lo = F.greatest(chunk_of(p - ahead, size), F.lit(0).cast("long"))
    hi = chunk_of(p + back, size)
    return df.withColumn("_c", F.explode(F.sequence(lo, hi))).withColumn(
        "_own", F.col("_c") == chunk_of(p, size)
    )


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Callable[[WindowSpec], dict[str, Column]],
    *,
    back: int = 0,
    ahead: int = 0,
    size: int = CHUNK,
) -> DataFrame:
    """Add window columns whose frames reach ``back``/``ahead`` rows."""
    h = haloed(df, keys, pos, back=back, ahead=ahead, size=size)
    w = Window.partitionBy(*keys, "_c").orderBy(pos)
    return h.withColumns(columns(w)).filter("_own").drop("_c", "_own")


_MERGE = {
    "sum": (F.sum, lambda a, b: a + b),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    aggs: dict[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
    size: int = CHUNK,
) -> DataFrame:
    """Cumulative aggregates along ``pos``: rows within a chunk, then chunks.

    ``aggs`` maps a new column to ``(kind, value)``, kind one of sum, max, min.
    With ``inclusive=False`` the current row is left out; a row with nothing
    before it gets null.
    """
    d = df.withColumn("_ch", chunk_of(pos, size))
    d = d.withColumns({f"_v_{n}": v for n, (_, v) in aggs.items()})
    d = d.withColumn("_g", _group(keys, ["_ch"]))
    totals = d.groupBy("_g").agg(
        *[_MERGE[k][0](f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in aggs.items()]
    )
    over = Window.partitionBy(*[F.col(f"_g.{k}") for k in keys]).orderBy("_g._ch")
    over = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "_g", *[_MERGE[k][0](f"_t_{n}").over(over).alias(f"_b_{n}") for n, (k, _) in aggs.items()]
    )
    local = Window.partitionBy("_g").orderBy(pos)
    local = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = d.join(carried, "_g")
    cols = {}
    for n, (k, _) in aggs.items():
        here, before = _MERGE[k][0](f"_v_{n}").over(local), F.col(f"_b_{n}")
        cols[n] = F.when(before.isNull(), here).when(here.isNull(), before).otherwise(
            _MERGE[k][1](here, before)
        )
    out = out.withColumns(cols)
    return out.drop("_g", "_ch", *[f"{p}_{n}" for n in aggs for p in ("_v", "_b")])


def segments(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    *,
    back: int = 0,
    ahead: int = 0,
    size: int = 4096,
) -> DataFrame:
    """One row per chunk with its consecutive values as arrays.

    ``start`` is the position of the first array element and ``own_from`` /
    ``own_to`` bound (half-open) the positions the chunk owns; the rest are
    neighbours. The array length is at most ``size + back + ahead``.
    """
    h = haloed(df, keys, pos, back=back, ahead=ahead, size=size)
    body = F.struct(F.col(pos).alias("_p"), *[F.col(c).alias(c) for c in columns])
    g = h.groupBy(*keys, "_c").agg(
        F.sort_array(F.collect_list(body)).alias("_s"), F.max("_own").alias("_any")
    )
    return g.filter("_any").select(
        *keys,
        F.col("_s")[0]["_p"].alias("start"),
        (F.col("_c") * size).alias("own_from"),
        ((F.col("_c") + 1) * size).alias("own_to"),
        *[F.col(f"_s.{c}").alias(c) for c in columns],
    )
