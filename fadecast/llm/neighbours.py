"""Candidate pairs between rows that stand close together in a sorted table.

Tasks walk through range-sorted partitions, so a crowded region is spread over tasks and
nothing is held but a few rows. The outermost rows of the partitions meet in one small
group per border.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from fadecast.llm.common import written

Find = Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table]


def _walk(find: Find, pairs: pa.Schema, both: pa.Schema, near: int, region: str | None):
    def as_pairs(found: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(found):
            more = [pa.nulls(len(found), f.type) for f in list(both)[len(pairs) :]]
            yield from pa.Table.from_arrays([*found.columns, *more], schema=both).to_batches()

    def as_edges(rows: pa.Table, border: int, side: int) -> Iterator[pa.RecordBatch]:
        n = len(rows)
        marks = [pa.array([x] * n, pa.int32()) for x in (border, side)]
        columns = [*(pa.nulls(n, f.type) for f in pairs), *marks, *rows.columns]
        yield from pa.Table.from_arrays(columns, schema=both).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tail = top = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            if not len(new):
                continue
            if tail is None:
                yield from as_edges(new.slice(0, near), part - 1, 1)
            held = 0 if tail is None else len(tail)
            rows = new if tail is None else pa.concat_tables([tail, new])
            for d in range(1, near + 1):
                j = np.arange(max(held, d), len(rows))
                yield from as_pairs(find(rows, j - d, j))
            if region:  # the first row of a region that this task sees meets all later ones
                led = new if top is None else pa.concat_tables([top, new])
                at = led[region].to_numpy()
                j = np.arange(len(led))
                first = np.maximum.accumulate(np.where(np.r_[True, at[1:] != at[:-1]], j, 0))
                j = j[first < j - near]
                yield from as_pairs(find(led, first[j], j))
                top = led.slice(int(first[-1]), 1)
            tail = rows.slice(max(0, len(rows) - near))
        if tail is not None:
            yield from as_edges(tail, part, 0)

    return run


def _across(find: Find, near: int):
    def run(rows: pa.Table) -> pa.Table:
        # At most ``near`` rows of either side, in the order of their partitions.
        side = rows["side"].to_numpy()
        at = np.lexsort((rows["rank"].to_numpy(), side))
        side, rows = side[at], rows.take(pa.array(at))
        found = []
        for d in range(1, near + 1):
            j = np.arange(d, len(rows))
            j = j[side[j - d] != side[j]]
            found.append(find(rows, j - d, j))
        return pa.concat_tables(found)

    return run


def close_pairs(
    ordered: DataFrame, pair_schema: str, find: Find, near: int, name: str, region: str | None = None
) -> DataFrame:
    """The pairs that ``find(rows, i, j)`` makes of rows at most ``near`` apart in the
    range-sorted table ``ordered``, and of each row and the first of its ``region``.

    ``find`` gets row numbers i < j and returns a table with ``pair_schema``.
    """
    spark: SparkSession = ordered.sparkSession
    # Rows are numbered where they leave the sort, so that borders keep their order.
    rows = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    whole = f"{pair_schema}, border int, side int, {rows}"
    kinds = _arrow(spark, whole)
    n = len(_arrow(spark, pair_schema))
    both = written(ordered.mapInArrow(_walk(find, pa.schema(list(kinds)[:n]), kinds, near, region), whole), name)
    pairs = [f.name for f in list(kinds)[:n]]
    borders = both.filter("border is not null").drop(*pairs)
    return both.filter("border is null").select(*pairs).unionByName(
        borders.groupBy("border").applyInArrow(_across(find, near), pair_schema)
    )


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
