"""Links that a capped candidate search leaves out.

The search makes a fixed number of candidates per row of a crowded region. Where such a
region still has rows of different components and at most WHOLE rows, all its pairs are looked
at, by sizes and sketches; in one of more than FEW rows, first a spanning forest of the
components leaves a task, and what its similar pairs do not join is looked at again. The sets of larger regions are joined exactly by prefixes: two
sets at the threshold share one of their first shingles in any fixed order, at places from
which enough of both sets is left. The order puts rare shingles first, by counts of BUCKETS
hash buckets; other counts would only make more candidates. Rows of one component need no
further pair. The rows with one shingle are dealt to tiles of two parts, which hold a bounded
number of rows each. A tile's pairs are looked at where they lie: by sizes, by places, and by
a sketch that bounds the difference of two sets from below, the parity of the shingles in
each of BITS hash buckets. Only pairs that pass, nearly all of them similar, leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fadecast.llm import common
from fadecast.llm.components import components

FEW = 64  # rows of a region whose pairs all leave the task at once
WHOLE = 4096  # rows of a region whose pairs are all looked at
PART = 1000  # rows with one shingle that a task's part holds
TOKENS = 1 << 18  # shingles of a batch
BUCKETS = 1 << 18  # counts of shingles
BITS = 1024  # of a sketch
PAIRS = 1 << 17  # pairs looked at at a time

Shingles = Callable[[bytes], np.ndarray]  # the distinct shingle hashes of a row's body


def unsettled(regions: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """The rows of ``regions (region, key, ..)`` in regions of more than ``most`` rows that
    ``roots (node, root)``, over keys, leave in different components, with ``root`` and the
    number ``c`` of the region's rows."""
    at = regions.columns[0]
    large = regions.groupBy(at).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > most)
    rows = regions.join(common.sized(large), at).join(roots, F.col("key") == F.col("node"), "left")
    rows = common.written(rows.select(*regions.columns, "c", F.coalesce("root", "key").alias("root")), "large-regions")
    mixed = rows.groupBy(at).agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select(at)
    return common.written(rows.join(common.sized(mixed), at, "left_semi"), "unsettled")


def _forest(a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Of links between groups ``a`` and ``b`` those of a cheapest spanning forest."""
    nodes, ends = np.unique(np.stack([a, b]), return_inverse=True)
    order = np.argsort(cost, kind="stable")
    ends, left = ends.reshape(2, -1)[:, order], np.arange(len(order))
    group, kept = np.arange(len(nodes)), [left[:0]]
    while True:
        x = group[ends[:, left]]
        apart = x[0] != x[1]
        left, x = left[apart], x[:, apart]
        if not len(left):
            return order[np.concatenate(kept)]
        # The first link of each group that leads to another one.
        pick = np.unique(np.unique(x.ravel(order="F"), return_index=True)[1] // 2)
        kept.append(left[pick])
        up = list(range(len(nodes)))
        for p, q in x[:, pick].T.tolist():
            while up[p] != p:
                p = up[p]
            while up[q] != q:
                q = up[q]
            up[max(p, q)] = min(p, q)
        for k in range(len(up)):  # parents are smaller
            up[k] = up[up[k]]
        group = np.array(up)[group]


def _met_before(regions: list[list[int]], at: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j share one of their ``regions`` that comes before the region ``at`` they are in."""
    rows, place = np.unique(np.stack([i, j]), return_inverse=True)
    i, j = place.reshape(2, -1)
    width = max((len(regions[r]) for r in rows.tolist()), default=0)
    # What fills up a row's regions is no region and differs between the sides.
    own = np.array([regions[r] + [-1] * (width - len(regions[r])) for r in rows.tolist()], np.int64).reshape(len(rows), width)
    now, out = at[rows][i], np.zeros(len(i), bool)
    for k in range(width):
        x = own[i, k]
        out |= (x >= 0) & (x < now) & (x[:, None] == own[j]).any(axis=1)
    return out


def _together(percent: int, bits: int, spanning: bool):
    """Pairs of a region (rows ``at, key, root, n, bits``) that sizes and sketches allow."""

    def pairs(rows: pa.Table) -> Iterator[pa.Table]:
        at, root, n = (rows.column(c).to_numpy() for c in ("at", "root", "n"))
        words = common.matrix(rows.column("bits"), bits // 8).view(np.uint64)
        keys = rows.column("key").combine_chunks()
        others = rows.column("others").to_pylist() if "others" in rows.column_names else None
        end = np.searchsorted(at, at, side="right")
        later = end - np.arange(len(at)) - 1
        upto, lo = np.cumsum(later), 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
            i = np.repeat(np.arange(lo, hi), later[lo:hi])
            j = np.arange(len(i)) - np.repeat(np.cumsum(later[lo:hi]) - later[lo:hi], later[lo:hi]) + i + 1
            ok = root[i] != root[j]
            i, j = i[ok], j[ok]
            ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[ok], j[ok]
            apart, both = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64), n[i] + n[j]
            ok = (100 + percent) * apart <= (100 - percent) * both
            i, j, cost = i[ok], j[ok], (apart / both)[ok]
            if others is not None:
                ok = ~_met_before(others, at, i, j)
                i, j, cost = i[ok], j[ok], cost[ok]
            if spanning:
                ok = _forest(root[i], root[j], cost)
                i, j, cost = i[ok], j[ok], cost[ok]
            if len(i):
                yield pa.table({"a": keys.take(pa.array(i)), "b": keys.take(pa.array(j)), "x": root[i], "y": root[j], "cost": cost})
            lo = hi

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            if t.num_rows:  # the last region waits for the next batch
                at = t.column("at").to_numpy()
                start = int(np.searchsorted(at, at[-1]))
                held = t.slice(start).combine_chunks()
                yield from pairs(t.slice(0, start))
        if held is not None:
            yield from pairs(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for t in regions(batches):
            if spanning:
                t = pa.concat_tables([tree, t]) if tree is not None else t
                tree = t.take(pa.array(_forest(*(t.column(c).to_numpy() for c in ("x", "y", "cost"))))).combine_chunks()
            else:
                yield _ends(t)
        if tree is not None:
            yield _ends(tree)

    return run


def _ends(pairs: pa.Table) -> pa.RecordBatch:
    a, b, kind = pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), pairs.schema.field("a").type
    return pa.RecordBatch.from_arrays([pa.array(map(min, a, b), kind), pa.array(map(max, a, b), kind)], names=["key_a", "key_b"])


def within(rows: DataFrame, region: str, percent: int, bits: int, spanning: bool = False, once: bool = False) -> DataFrame:
    """Pairs ``key_a, key_b`` of one region and different roots that may be similar, of
    ``rows (region, key, root, size, bits)`` with sketches of ``bits`` bits. With ``spanning``
    only the most similar ones that join the roots of a task's regions as far as all would.
    With ``once`` rows know their regions (of numbers from 0), and a pair leaves the first it shares."""
    kind = rows.schema["key"].dataType.simpleString()
    own = rows.groupBy("key").agg(F.collect_list(region).alias("others")) if once else None
    rows = rows.select(F.col(region).alias("at"), "key", F.xxhash64("root").alias("root"), F.col("size").alias("n"), "bits")
    if once:
        rows = rows.join(own, "key").select(*rows.columns, "others")
    dealt = rows.repartition(common.partitions(rows), "at").sortWithinPartitions("at")
    return dealt.mapInArrow(_together(percent, bits, spanning), f"key_a {kind}, key_b {kind}").distinct()


def _counted(shingles: Shingles):
    """Buckets that a task meets more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for body in b.column(0):
                np.add.at(seen, _buckets(shingles(body.as_py())), 1)
        at = np.flatnonzero(seen > 1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at])], names=["bucket", "c"])

    return run


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(BUCKETS - 1)).astype(np.int64)


def _levels(sets: DataFrame, shingles: Shingles) -> np.ndarray:
    """A rank of commonness per bucket: eighths of the logarithm of its count."""
    rows = sets.select("body").mapInArrow(_counted(shingles), "bucket long, c long").groupBy("bucket").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[rows["bucket"].to_numpy()] = 8 * np.log2(rows["c"].to_numpy())
    return out.clip(0, 255).astype(np.uint8)


def sketch(shingles: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parities of the shingles in ``bits`` buckets. The bits in which two sketches differ are at
    most as many as the shingles that one of the sets lacks."""
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def sketches(shingles: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """The sketch of each of the sets of ``sizes`` that stand one after the other."""
    at = np.repeat(np.arange(len(sizes)) * bits, sizes) + ((shingles >> np.uint64(40)).astype(np.int64) & (bits - 1))
    odd = np.bincount(at, minlength=len(sizes) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sizes), bits), axis=1)


def _folds(n: np.ndarray) -> np.ndarray:
    """How often the sketch of a set of ``n`` shingles is folded: it keeps a bit a shingle, a quarter of BITS at least."""
    return (2 * n <= BITS).astype(np.int64) + (4 * n <= BITS)


def folded(bits: np.ndarray, times: int) -> np.ndarray:
    """Sketches (bytes in the last axis) of half as many buckets, ``times`` over: parities add up."""
    for _ in range(times):
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


class Sketches:
    """Sketches of sets of ``n`` shingles, each folded as its size says."""

    def __init__(self, bits: list[bytes], n: np.ndarray):
        wide = np.frombuffer(b"".join(b.ljust(BITS // 8, b"\0") for b in bits), np.uint8).reshape(-1, BITS // 8)
        self.folds = _folds(n)
        self.words = [np.ascontiguousarray(folded(wide, k)).view(np.uint64) for k in range(3)]

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bits in which rows i and j differ, both folded as often as one of them is."""
        out, most = np.zeros(len(i), np.int64), np.maximum(self.folds[i], self.folds[j])
        for k, words in enumerate(self.words):
            at = np.flatnonzero(most == k)
            out[at] = np.bitwise_count(words[i[at]] ^ words[j[at]]).sum(axis=1, dtype=np.int64)
        return out


def _prefixes(levels, percent: int, shingles: Shingles):
    """The first shingles of each set, with the number of the set's shingles from there on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = levels.value

        def emit(rows):
            size = np.array([len(r[2]) for r in rows])
            n = np.array([r[3] for r in rows])
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            columns = [np.repeat(np.array([r[k] for r in rows], np.int64), size) for k in (0, 1)]
            columns += [np.repeat(n, size), np.repeat(n, size) - place, np.concatenate([r[2] for r in rows]).view(np.int64)]
            bits = pa.array([r[4].tobytes() for r in rows], pa.binary()).take(pa.array(np.repeat(np.arange(len(rows)), size)))
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), bits], names=["id", "part_of", "n", "left", "shingle", "bits"]
            )

        for b in batches:
            rows, held = [], 0
            for i, r, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                s = shingles(body.as_py())
                first = len(s) - (percent * len(s) + 99) // 100 + 1
                rows.append((i, r, s[np.lexsort((s, rank[_buckets(s)]))[:first]], len(s), folded(sketch(s), int(_folds(np.array(len(s)))))))
                held += first
                if held > TOKENS:
                    yield emit(rows)
                    rows, held = [], 0
            if rows:
                yield emit(rows)

    return run


def _passing(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """Pairs of rows of one tile that sizes, places and sketches allow."""
    column = lambda c: rows.column(c).to_numpy()
    ids, part_of, n, left, side = (column(c) for c in ("id", "part_of", "n", "left", "side"))
    sketches = Sketches(rows.column("bits").to_pylist(), n)
    tile = np.vstack([column(c) for c in ("shingle", "p", "q")])
    new = np.append(True, (tile[:, 1:] != tile[:, :-1]).any(axis=0))
    end = np.append(np.flatnonzero(new)[1:], len(ids))[np.cumsum(new) - 1]
    within = column("p") == column("q")
    later = end - np.arange(len(ids)) - 1
    upto, found = np.cumsum(later), []
    lo = 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
        i = np.repeat(np.arange(lo, hi), later[lo:hi])
        j = np.arange(len(i)) - np.repeat(np.cumsum(later[lo:hi]) - later[lo:hi], later[lo:hi]) + i + 1
        ok = (part_of[i] != part_of[j]) & (within[i] | (side[i] != side[j]))
        ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        ok &= (100 + percent) * np.minimum(left[i], left[j]) >= percent * (n[i] + n[j])
        i, j = i[ok], j[ok]
        ok = (100 + percent) * sketches.apart(i, j) <= (100 - percent) * (n[i] + n[j])
        found.append(np.stack([ids[i[ok]], ids[j[ok]]]))
        lo = hi
    pairs = np.unique(np.sort(np.hstack(found), axis=0), axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["id_a", "id_b"])


def _tiles(percent: int):
    """Passing pairs of whole tiles; the last tile of a batch waits for the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            if not t.num_rows:
                continue
            last = [t.column(c)[t.num_rows - 1] for c in ("shingle", "p", "q")]
            same = np.logical_and.reduce([t.column(c).to_numpy() == v.as_py() for c, v in zip(("shingle", "p", "q"), last)])
            start = t.num_rows - int(same.sum())
            held = t.slice(start)
            if start:
                yield _passing(t.slice(0, start), percent)
        if held is not None:
            yield _passing(held, percent)

    return run


def candidates(sets: DataFrame, percent: int, shingles: Shingles) -> DataFrame:
    """All pairs ``id_a, id_b`` of ``sets (id, part_of, body)`` that may be similar and are
    not part of one component."""
    levels = sets.sparkSession.sparkContext.broadcast(_levels(sets, shingles))
    first = sets.select("id", "part_of", "body").mapInArrow(
        _prefixes(levels, percent, shingles), "id long, part_of long, n long, left long, shingle long, bits binary"
    )
    first = common.written(first, "prefixes")
    parts = first.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("part_of").alias("x"), F.max("part_of").alias("y"))
    parts = parts.filter("x <> y").select("shingle", F.ceil(F.col("c") / PART).cast("int").alias("parts"))
    rows = first.join(common.sized(parts), "shingle").withColumn("side", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "shingle", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"),
        "id", "part_of", "n", "left", "side", "bits",
    )
    tile = ["shingle", "p", "q"]
    dealt = rows.repartition(common.partitions(sets), *tile).sortWithinPartitions(*tile)
    return dealt.mapInArrow(_tiles(percent), "id_a long, id_b long").distinct()


def _confirmed(percent: int, shingles: Shingles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = shingles(x.as_py()), shingles(y.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["a", "b"])

    return run


def links(sets: DataFrame, percent: int, shingles: Shingles) -> DataFrame:
    """All links ``a, b`` between ``sets (root, body)`` of different roots."""
    kind = sets.schema["root"].dataType.simpleString()
    sets = sets.select("root", "body", F.xxhash64("root").alias("part_of"), F.monotonically_increasing_id().alias("id"))
    sets = common.written(sets, "crowded-sets")
    pairs = candidates(sets, percent, shingles)
    return (
        pairs.join(sets.select(F.col("id").alias("id_a"), F.col("root").alias("root_a"), F.col("body").alias("body_a")), "id_a")
        .join(sets.select(F.col("id").alias("id_b"), F.col("root").alias("root_b"), F.col("body").alias("body_b")), "id_b")
        .select("root_a", "root_b", "body_a", "body_b")
        .mapInArrow(_confirmed(percent, shingles), f"a {kind}, b {kind}")
    )


def settled(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots (node, root)`` with the links ``found (a, b)`` between nodes, too."""
    for c in ("a", "b"):
        found = found.join(roots.toDF(c, "up"), c, "left").withColumn(c, F.coalesce("up", c)).drop("up")
    more = common.written(components(found.select("a", "b").distinct()), "more-roots")
    moved = roots.join(more.toDF("old", "new"), F.col("root") == F.col("old"), "left")
    return moved.select("node", F.coalesce("new", "root").alias("root")).unionByName(more)
