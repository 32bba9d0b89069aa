"""Near duplicates by an LSH forest over MinHash signatures.

Every distinct set of word shingles gets one signature. The forest holds it in several
sorted orders, each of which starts at other hash functions. In an order the sets with
the longest common prefix stand next to each other, so the nearest rows are the
candidates and the depth adapts to each region: in a crowded region neighbours share a
long prefix, in an empty one a short prefix. Rows of crowded regions are also held
against the region's hubs, sets whose prefixes are the most common ones over all orders,
which is how many edited copies of one text find the text they come from. No pairs are
made beyond these: their number grows with the number of sets only.

Candidates are confirmed on the full sets, then joined to groups by distributed union-find.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common
from fadecast.llm.components import components
from fadecast.llm.neighbours import close_pairs

PERMS = 64  # hash functions of a signature
TREES = 10  # sorted orders
STEP = 6  # an order starts so many hash functions after the one before
DEPTH = 8  # hash values that an order sorts by
NEAR = 6  # neighbours on each side
CROWDED = 6  # rows above which a region has hubs
HUBS = 8  # hubs of a crowded region
ROWS = 4000  # rows of an order that a task should at least have

_rng = np.random.default_rng(811)
_MUL = _rng.integers(1, 2**63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, PERMS, dtype=np.uint64)


def word_sets(text: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """``first row, end row, sorted distinct shingle hashes of each row``."""
    for lo, hi, buf, offsets in common.text_chunks(text):
        buf = common.LOWER[buf]
        starts, ends, first = common.words(buf, offsets, common.SPACE)
        w = common.span_hashes(buf, starts, ends)
        yield lo, hi, [np.unique(s) for s in common.shingles(w, first, width)]


def set_key(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of PERMS minima per set; sets must not be empty."""
    if not sets:
        return np.zeros((0, PERMS), np.uint32)
    lengths = np.array([len(s) for s in sets])
    flat, at = np.concatenate(sets), np.r_[0, np.cumsum(lengths)[:-1]]
    out = np.empty((len(sets), PERMS), np.uint32)
    for j in range(PERMS):
        out[:, j] = np.minimum.reduceat((flat * _MUL[j] + _ADD[j]) >> np.uint64(32), at)
    return out


def _signed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in word_sets(batch.column(1), width):
                n = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(n)
                sig = signatures([sets[i] for i in some])
                order = np.zeros((len(n), PERMS * 4), np.uint8)
                order[some] = sig.astype(">u4").view(np.uint8).reshape(len(some), PERMS * 4)
                low = np.zeros((len(n), PERMS), np.uint8)
                low[some] = sig & np.uint32(255)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(n),
                        pa.array([set_key(s) for s in sets], pa.binary()),
                        common.binaries(order),
                        common.binaries(low),
                    ],
                    names=["doc_id", "n_shingles", "key", "sig", "low"],
                )

    return run


def _alike(x: np.ndarray, y: np.ndarray, floor: float) -> np.ndarray:
    return (x == y).mean(axis=1) >= floor if len(x) else np.zeros(0, bool)


_PAIR = "key_a binary, rep_a long, key_b binary, rep_b long"


def _pairs(floor: float):
    """Rows of one order that share a prefix and look alike, the smaller key first."""

    def find(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
        t, order, low = rows["t"].to_numpy(), common.matrix(rows["ord"], DEPTH * 4), common.matrix(rows["low"], PERMS)
        ok = t[i] == t[j]
        i, j = i[ok], j[ok]
        ok = (order[i, :4] == order[j, :4]).all(axis=1)
        i, j = i[ok], j[ok]
        ok = _alike(low[i], low[j], floor)
        i, j = i[ok], j[ok]
        keys, reps = rows["key"].combine_chunks(), rows["rep"].to_numpy()
        a, b = keys.take(pa.array(i)).to_pylist(), keys.take(pa.array(j)).to_pylist()
        turn = np.array([x > y for x, y in zip(a, b)], bool)
        return pa.Table.from_arrays(
            [
                pa.array([y if t else x for x, y, t in zip(a, b, turn)], pa.binary()),
                pa.array(np.where(turn, reps[j], reps[i]), pa.int64()),
                pa.array([x if t else y for x, y, t in zip(a, b, turn)], pa.binary()),
                pa.array(np.where(turn, reps[i], reps[j]), pa.int64()),
            ],
            names=["key_a", "rep_a", "key_b", "rep_b"],
        )

    return find


def _with_hub(floor: float):
    """Rows beside the hub of their region: those that look alike, as candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = common.matrix(b.column(2), PERMS), common.matrix(b.column(5), PERMS)
            ok = pa.array(_alike(x, y, floor))
            a, ra, h, rh = (b.column(k).filter(ok).to_pylist() for k in (0, 1, 3, 4))
            rows = [(p, rp, q, rq) if p < q else (q, rq, p, rp) for p, rp, q, rq in zip(a, ra, h, rh) if p != q]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64() if k % 2 else pa.binary()) for k in range(4)],
                names=["key_a", "rep_a", "key_b", "rep_b"],
            )

    return run


def candidates(sets: DataFrame, n: int, similarity: float) -> DataFrame:
    """Pairs of distinct sets ``key_a, rep_a, key_b, rep_b`` that the forest holds close together.

    ``floor`` lets pairs through whose signatures agree about four standard deviations
    less often than a pair at the threshold does.
    """
    floor = max(0.0, similarity - 4.3 * math.sqrt(similarity * (1 - similarity) / PERMS))
    sig = F.concat("sig", "sig")
    trees = sets.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))).select(
        F.col("t").cast("int").alias("t"),
        sig.substr(F.col("t") * (STEP * 4) + 1, F.lit(DEPTH * 4)).alias("ord"),
        "key",
        "rep",
        # The low bytes of all hash values, from where the order's own prefix ends: rows with
        # one prefix are sorted on by them, through the whole signature.
        F.concat("low", "low").substr((F.col("t") * STEP + DEPTH) % PERMS + 1, F.lit(PERMS)).alias("low"),
    )
    spread = max(1, min(common.partitions(sets), n * TREES // ROWS))
    ordered = trees.repartitionByRange(spread, "t", "ord", "low", "key").sortWithinPartitions("t", "ord", "low", "key")
    near = close_pairs(ordered.withColumn("rank", F.monotonically_increasing_id()), _PAIR, _pairs(floor), NEAR, "neighbours")
    # Unrelated sets share a hash value about once in fifty; at this depth they meet by chance no more.
    depth = min(DEPTH, max(3, math.ceil(math.log(max(n, 2)) / math.log(50))))
    narrow = trees.select("t", F.col("ord").substr(1, depth * 4).alias("region"), "key", "rep", "low")
    crowded = narrow.groupBy("t", "region").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > CROWDED)
    dense = common.written(narrow.join(crowded, ["t", "region"]), "regions")
    common_ness = dense.groupBy("key").agg(F.sum(F.log2("c")).alias("score"))
    # Several hubs a region, each from a part of its sets that differs by order.
    hubs = (
        dense.join(common_ness, "key")
        .groupBy("t", "region", F.pmod(F.xxhash64("key", "t"), F.lit(HUBS)))
        .agg(F.max_by(F.struct("key", "rep", "low"), F.struct("score", "key")).alias("hub"))
        .select("t", "region", "hub")
    )
    beside = dense.join(hubs, ["t", "region"]).select(
        "key", "rep", "low", F.col("hub.key").alias("hk"), F.col("hub.rep").alias("hr"), F.col("hub.low").alias("hl")
    )
    found = near.unionByName(beside.mapInArrow(_with_hub(floor), _PAIR))
    return found.dropDuplicates(["key_a", "key_b"])


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column(0).to_pylist()
            for lo, hi, sets in word_sets(batch.column(1), width):
                rows = [(k, s.tobytes()) for k, s in zip(want[lo:hi], sets) if set_key(s) == k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], names=["key", "full"]
                )

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                # The smaller share of sizes is an upper bound of the similarity.
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its
    distinct runs of ``width`` words. Documents with ``100 * intersection >= percent *
    union`` are linked; ``component_id`` is the smallest ``doc_id`` that links reach.

    Null and empty texts and texts of white space have no shingle and link with nothing.
    A text with fewer words is one shingle. Equal sets are linked through their set, so
    copies make no pairs. Rows that repeat a ``doc_id`` are one document: equal rows get
    equal results and different texts of one id are linked. Rows without an id link with
    nothing, have no ``component_id`` and are kept. An empty table gives an empty table;
    other columns are ignored.
    """
    ids = docs.select("doc_id", "text")
    signed = common.written(
        ids.mapInArrow(_signed(width), "doc_id long, n_shingles long, key binary, sig binary, low binary"), "signatures"
    )
    sets = common.written(
        signed.filter("doc_id is not null and n_shingles > 0")
        .groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("low").alias("low")),
        "sets",
    )
    n = sets.count()
    pairs = common.written(candidates(sets, n, percent / 100), "pairs")
    wanted = (
        pairs.select(F.col("key_a").alias("key"), F.col("rep_a").alias("doc_id"))
        .union(pairs.select("key_b", "rep_b"))
        .distinct()
    )
    full = common.written(
        ids.join(common.sized(wanted), "doc_id")
        .select("key", "text")
        .mapInArrow(_full_sets(width), "key binary, full binary")
        .dropDuplicates(["key"]),
        "full",
    )
    a, b = full.toDF("key_a", "full_a"), full.toDF("key_b", "full_b")
    links = (
        pairs.join(a, "key_a")
        .join(b, "key_b")
        .select("rep_a", "rep_b", "full_a", "full_b")
        .mapInArrow(_confirmed(percent), "a long, b long")
    )
    # Different texts under one id: their sets are linked through the id.
    same = signed.filter("doc_id is not null and n_shingles > 0").select(F.col("doc_id").alias("a"), "key")
    same = same.join(sets.select("key", F.col("rep").alias("b")), "key").select("a", "b").filter("a <> b")
    roots = components(links.unionByName(same)) if _repeats(signed) else components(links)
    reps = sets.select("key", "rep").join(roots, F.col("rep") == F.col("node"), "left")
    classes = reps.select("key", F.coalesce("root", "rep").alias("root"))
    out = signed.select("doc_id", "n_shingles", "key").join(classes, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _repeats(signed: DataFrame) -> bool:
    """Whether an id has two different sets."""
    some = signed.filter("doc_id is not null and n_shingles > 0")
    return bool(some.groupBy("doc_id").agg(F.min("key").alias("x"), F.max("key").alias("y")).filter("x <> y").limit(1).count())


def op8_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), width=3, percent=85)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    kept = near_duplicates(docs).filter("kept").select("doc_id").distinct()
    return docs.filter("doc_id is null").unionByName(docs.join(kept, "doc_id", "left_semi"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x20\\x09-\\x0D]+')"
)

ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 2), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, root) AS (
  SELECT x, x FROM (SELECT DISTINCT x FROM edge)
  UNION
  SELECT e.x, r.root FROM reach r JOIN edge e ON e.y = r.doc_id WHERE r.root < e.x),
least AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
       coalesce(root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""
