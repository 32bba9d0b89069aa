"""Connected components of a link table that never leaves the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fadecast.llm.common import partitions, written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: every node but the roots, with its root."""
    up: dict = {}

    def root(x):
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                if y < x:
                    x, y = y, x
                up[y] = x
                up.setdefault(x, x)
    nodes = [(v, root(v)) for v in list(up)]
    nodes = [p for p in nodes if p[0] != p[1]]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in part]) for k in (0, 1)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)`` that is not the smallest of its component.

    Each round joins what meets in a partition by union-find and then lets every node
    skip to the parent of its parent, so that long chains halve. Null ends are no links;
    loops and repeated links do no harm; an empty table gives an empty table.
    """
    kind = links.schema["a"].dataType.simpleString()
    spread = partitions(links)
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.lit(False).alias("moved")).filter(
        "a <> b"
    )
    while True:
        stars = edges.repartition(spread, "a").select("a", "b").mapInArrow(_forest, f"a {kind}, b {kind}")
        stars = written(stars, "stars")
        parent = stars.groupBy(F.col("a").alias("p")).agg(F.min("b").alias("up"), F.count(F.lit(1)).alias("n"))
        # A node with two parents, or a parent that has a parent itself, is not done.
        own = parent.select(F.col("p").alias("o"), F.col("n"), F.col("up").alias("least"))
        edges = (
            stars.join(parent.select("p", "up"), stars.b == F.col("p"), "left")
            .select("a", F.coalesce("up", "b").alias("b"), F.col("up").isNotNull().alias("moved"))
        )
        edges = written(edges, "links")
        open_ends = edges.filter("moved").limit(1).count() + own.filter("n > 1").limit(1).count()
        if not open_ends:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
