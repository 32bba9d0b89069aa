"""Centroid clustering over a vector-approximation file.

Every vector is kept twice: whole, and as a cell number of BITS bits per dimension. Cell
borders are quantiles of each dimension. For a set of centroids, two lookup tables per
dimension (cell by centroid) hold the least and the largest squared difference a value of
that cell can have, less the difference from a middle point that all centroids share; their
sums over the dimensions are an interval for every squared distance, up to a part that does
not depend on the centroid. Leaving this part out makes the intervals several times
narrower: its uncertainty is that of the vector, not of the comparison. Where the interval of one centroid lies below all others, the cells decide. The
full vector is fetched only where intervals overlap, and where a vector changes its centroid:
centroid sums move by these vectors alone, so a later round reads the cells of all vectors
but the components of few. All arithmetic is on integers, thus exact.

Rounds keep no state per vector: a task derives the previous assignment from the previous
centroids' tables. What reaches the driver are sums, one line per centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.llm import common

BITS = 7
LARGEST = 1 << 27  # components beyond would let a squared distance leave 64 bits
ACCURACY = 1000  # of the quantiles that place the cells' borders
WORTH_A_JOIN = 20  # one vector of so many is fetched by a join, more by reading all where they lie
ROWS = 4096  # vectors compared at a time inside a task

_L = T.LongType()


def integers(vectors: DataFrame, vec: str, dims: int) -> DataFrame:
    """Column ``x``: floor(256 * component) of vectors with ``dims`` finite components; other
    rows go. Components of 2**27 and more are set to that size."""
    ok = (F.size(vec) == dims) & F.forall(
        vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf")))
    )
    bound = F.lit(float(LARGEST))
    cell = lambda v: F.greatest(-bound, F.least(bound, F.floor(v.cast("double") * 256).cast("double")))
    return vectors.filter(F.coalesce(ok, F.lit(False))).withColumn(
        "x", F.transform(vec, lambda v: cell(v).cast("long"))
    )


@dataclass(frozen=True)
class Cells:
    """Borders of the cells, one line per dimension: cell j holds lows[j] .. highs[j]."""

    lows: np.ndarray
    highs: np.ndarray
    bits: int = BITS

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Packed cell numbers."""
        n, dims = x.shape
        cell = np.empty((n, dims), np.uint8)
        for d in range(dims):
            cell[:, d] = np.searchsorted(self.lows[d], x[:, d], side="right") - 1
        each = (cell[:, :, None] >> np.arange(self.bits - 1, -1, -1, dtype=np.uint8)) & 1
        return np.packbits(each.reshape(n, dims * self.bits), axis=1)

    def cells(self, codes: np.ndarray) -> np.ndarray:
        dims = len(self.lows)
        each = np.unpackbits(codes, axis=1)[:, : dims * self.bits].reshape(-1, dims, self.bits)
        return each @ (1 << np.arange(self.bits - 1, -1, -1)).astype(np.uint8)

    @property
    def width(self) -> int:
        return -(-len(self.lows) * self.bits // 8)


def fit_cells(vectors: DataFrame, dims: int, bits: int = BITS) -> Cells:
    """Cells of about equal shares in every dimension, from one aggregation over all vectors."""
    n = 1 << bits
    shares = [k / n for k in range(1, n)]
    col = [F.get("x", F.lit(d)) for d in range(dims)]
    row = vectors.agg(
        *[F.min(c).alias(f"lo{d}") for d, c in enumerate(col)],
        *[F.max(c).alias(f"hi{d}") for d, c in enumerate(col)],
        *[F.percentile_approx(c, shares, ACCURACY).alias(f"q{d}") for d, c in enumerate(col)],
    ).first()
    lows = np.empty((dims, n), np.int64)
    for d in range(dims):
        q = [] if row[f"q{d}"] is None else row[f"q{d}"]
        lows[d] = [row[f"lo{d}"] or 0, *q] if len(q) else 0
    highs = np.empty_like(lows)
    highs[:, :-1] = np.maximum(lows[:, 1:] - 1, lows[:, :-1])
    highs[:, -1] = [row[f"hi{d}"] or 0 for d in range(dims)]
    return Cells(lows, np.maximum(highs, lows), bits)


class Intervals:
    """Lookup tables of one set of centroids."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        middle = centroids.sum(axis=0) // len(centroids)
        lo, hi = (cells.lows - middle[:, None])[:, :, None], (cells.highs - middle[:, None])[:, :, None]
        c = (centroids - middle).T[:, None, :]
        # (x - c)^2 - (x - middle)^2 is linear in x, so its extremes lie at a cell's ends.
        ends = c * c - 2 * c * lo, c * c - 2 * c * hi
        self.least, self.most = np.minimum(*ends), np.maximum(*ends)

    def open(self, cell: np.ndarray) -> np.ndarray:
        """For each vector the centroids that may be its nearest."""
        n, k = len(cell), self.least.shape[2]
        least, most = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        for d in range(cell.shape[1]):
            least += self.least[d][cell[:, d]]
            most += self.most[d][cell[:, d]]
        return least <= most.min(axis=1, keepdims=True)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(centroids)), np.int64)
    for k, c in enumerate(centroids):
        diff = x - c
        out[:, k] = np.einsum("nd,nd->n", diff, diff)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray, may: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid; the smaller number wins ties."""
    d = distances(x, centroids)
    if may is not None:
        d = np.where(may, d, np.iinfo(np.int64).max)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)


def store(vectors: DataFrame, cells: Cells, name: str) -> DataFrame:
    """The table of full vectors with the column ``code``; Parquet reads either without the other."""
    dims = len(cells.lows)
    schema = T.StructType([*vectors.schema.fields, T.StructField("code", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            codes = cells.codes(_vectors(b.column("x"), dims))
            yield pa.RecordBatch.from_arrays([*b.columns, common.binaries(codes)], names=schema.names)

    return common.written(vectors.mapInArrow(run, schema), name)


_SUMS = T.StructType([T.StructField(n, _L) for n in ("cluster", "dim", "total", "n")])


def _add_up(moves: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, dims: int):
    """One line per centroid and dimension: the components gained less those lost."""
    total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    for x, old, new in moves:
        np.add.at(total, new, x)
        np.add.at(count, new, 1)
        gone = old >= 0
        np.subtract.at(total, old[gone], x[gone])
        np.subtract.at(count, old[gone], 1)
    c, d = np.divmod(np.arange(k * dims), dims)
    yield pa.RecordBatch.from_arrays([pa.array(a) for a in (c, d, total.ravel(), count[c])], names=_SUMS.names)


@dataclass
class Clustering:
    """Centroids by number, how many vectors each holds, and how many were fetched a round."""

    centroids: np.ndarray
    fetched: list[int] = field(default_factory=list)

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def _moved(rows: DataFrame, totals: np.ndarray, counts: np.ndarray) -> None:
    dims = totals.shape[1]
    for r in rows.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        totals[r.cluster, r.dim] += r.total
        if r.dim == dims - 1:
            counts[r.cluster] += r.n


def cluster(
    table: DataFrame, row: str, cells: Cells, centroids: np.ndarray, rounds: int
) -> Clustering:
    """``rounds`` of assignment and floor-mean update from the given centroids.

    ``table`` comes from ``store`` and numbers its rows in ``row``. The first round reads
    every vector, since the sums need them; later ones fetch vectors that the cells leave
    open or that move.
    """
    k, dims = centroids.shape
    done = Clustering(centroids)
    if not k:
        return done
    totals, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)

    def first(batches):
        def moves():
            lookup = Intervals(cells, centroids)
            for b in _pieces(batches):
                x = _vectors(b.column("x"), dims)
                may = lookup.open(cells.cells(common.matrix(b.column("code"), cells.width)))
                new = nearest(x, centroids, may)[0]
                yield x, np.full(len(x), -1), new

        yield from _add_up(moves(), k, dims)

    _moved(table.select("x", "code").mapInArrow(first, _SUMS), totals, counts)
    before = centroids
    for _ in range(rounds - 1):
        now = np.where(counts[:, None] > 0, totals // np.maximum(counts, 1)[:, None], before)

        def unsettled(codes, old, new):
            cell = cells.cells(common.matrix(codes, cells.width))
            was, is_now = old.open(cell), new.open(cell)
            same = (was.sum(axis=1) == 1) & (is_now.sum(axis=1) == 1) & (was.argmax(axis=1) == is_now.argmax(axis=1))
            return ~same

        def wanted_rows(batches, before=before, now=now):
            old, new = Intervals(cells, before), Intervals(cells, now)
            for b in _pieces(batches):
                yield b.select([row]).filter(pa.array(unsettled(b.column("code"), old, new)))

        def settle(batches, before=before, now=now, look=False):
            def moves():
                old, new = Intervals(cells, before), Intervals(cells, now)
                for b in _pieces(batches):
                    x = _vectors(b.column("x"), dims)
                    if look:
                        x = x[unsettled(b.column("code"), old, new)]
                    was, is_now = nearest(x, before)[0], nearest(x, now)[0]
                    at = was != is_now
                    yield x[at], was[at], is_now[at]

            yield from _add_up(moves(), k, dims)

        wanted = table.select(row, "code").mapInArrow(wanted_rows, T.StructType([table.schema[row]]))
        wanted = common.written(wanted, "wanted")
        done.fetched.append(wanted.count())
        if done.fetched[-1] * WORTH_A_JOIN > counts.sum():
            # Many are open: reading both columns where they lie beats a shuffle of the vectors.
            moved = table.select("x", "code").mapInArrow(partial(settle, look=True), _SUMS)
        else:
            few = F.broadcast(wanted) if done.fetched[-1] * 16 <= common.SMALL else wanted
            moved = table.select(row, "x").join(few, row, "left_semi").select("x").mapInArrow(settle, _SUMS)
        _moved(moved, totals, counts)
        before = now
    done.centroids = np.where(counts[:, None] > 0, totals // np.maximum(counts, 1)[:, None], before) if rounds else centroids
    return done


def assign(table: DataFrame, keep: Sequence[str], cells: Cells, centroids: np.ndarray) -> DataFrame:
    """``keep``, ``cluster``, ``distance`` of every vector. The cells name the centroids that
    can be nearest, the components give the distance."""
    k, dims = centroids.shape
    names = list(keep)
    schema = T.StructType(
        [*[table.schema[c] for c in names], T.StructField("cluster", T.IntegerType()), T.StructField("distance", _L)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Intervals(cells, centroids)
        for b in _pieces(batches):
            may = lookup.open(cells.cells(common.matrix(b.column("code"), cells.width)))
            best, d = nearest(_vectors(b.column("x"), dims), centroids, may)
            cols = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(best.astype(np.int32)), pa.array(d)], names=schema.names
            )

    return table.select(*names, "x", "code").mapInArrow(run, schema)


def seeds(vectors: DataFrame, key: str, k: int, salt: str = "2") -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``salt:key``, in that order.

    Rows of one key are ordered by their vectors, rows without a key come last.
    """
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(key).cast("string")).cast("binary"), 256)
    first = vectors.select(digest.alias("_h"), "x").orderBy(F.asc_nulls_last("_h"), "x").limit(k)
    return np.array([r.x for r in first.collect()], np.int64)


def centroid_clusters(
    vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", *, dims: int = 64, k: int = 40, rounds: int = 5
) -> tuple[DataFrame, Clustering]:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector.

    Vectors that are null, of another length, or hold null or non-finite components are left
    out. Repeated rows are vectors of their own. Fewer vectors than ``k`` give as many
    centroids; an empty table gives an empty result. Columns other than ``key`` and ``vec``
    are not read. Components are limited to 2**27 in size.
    """
    rows = integers(vectors.select(F.col(key).alias("_key"), F.col(vec).alias("_vec")), "_vec", dims)
    rows = common.written(rows.select(F.monotonically_increasing_id().alias("_row"), "_key", "x"), "vectors")
    cells = fit_cells(rows, dims)
    table = store(rows, cells, "vafile")
    start = seeds(rows, "_key", k).reshape(-1, dims)
    done = cluster(table, "_row", cells, start, rounds)
    # Written: three readers, and the sums must be those of the rows returned.
    found = common.written(assign(table, ["_key"], cells, done.centroids), "clusters")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia")).first()[0]
    digests = F.array(*[F.lit(d) for d in done.digests()]) if len(start) else F.array().cast("array<string>")
    return (
        found.join(F.broadcast(per), "cluster").select(  # at most k rows
            F.col("_key").alias(key), "cluster", "distance", "cluster_inertia",
            F.lit(total).cast("long").alias("inertia"),
            F.get(digests, F.col("cluster")).alias("centroid_sha256"),
        ),
        done,
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(common.table(spark, sf_dir, "embeddings"))[0]


def _oracle(dims: int = 64, k: int = 40, rounds: int = 5) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (
  SELECT rid, c, sum((v.v - m.v) * (v.v - m.v)) AS dist FROM long v JOIN m{r} m ON v.d = m.d GROUP BY rid, c),
a{r} AS MATERIALIZED (SELECT rid, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM d{r} GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""m{r + 1} AS MATERIALIZED (
  SELECT m.c, m.d, coalesce(s.v, m.v) AS v FROM m{r} m LEFT JOIN (
    SELECT a.c, v.d, (sum(v.v) - (((sum(v.v) % count(*)) + count(*)) % count(*))) // count(*) AS v
    FROM a{r} a JOIN long v ON v.rid = a.rid GROUP BY a.c, v.d) s ON s.c = m.c AND s.d = m.d)""")
    return f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(greatest(-134217728, least(134217728, floor(256 * CAST(e AS DOUBLE)))) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
long AS MATERIALIZED (SELECT rid, generate_subscripts(x, 1) AS d, unnest(x) AS v FROM kept),
start AS (SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS c, x FROM (
  SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM kept ORDER BY h NULLS LAST, x LIMIT {k})),
m0 AS MATERIALIZED (SELECT c, generate_subscripts(x, 1) AS d, unnest(x) AS v FROM start),
{", ".join(steps)},
sha AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS s FROM m{rounds} GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
  CAST(sum(a.dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, sha.s AS centroid_sha256
FROM a{rounds} a JOIN kept k ON k.rid = a.rid JOIN sha ON sha.c = a.c"""


ORACLE = _oracle()
