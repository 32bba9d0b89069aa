"""Scores texts by a hierarchical Pitman-Yor language model trained on the corpus.

The restaurant of a context (the word before) serves words; a table that opens there is a
customer of the parent restaurant, which all contexts share and whose own base is even over
the vocabulary. Seating is sampled by Gibbs: the number of tables of a dish is drawn from its
distribution given all other dishes of its restaurant and the parent's probabilities. For up
to EXACT customers the weights come from generalised Stirling numbers, which sum over all
seatings with so many tables; for more, from their saddle point. Predictive probabilities are
averaged over the samples that are kept, and a text's score is the sum of the logarithms.

Words seen once in training, and unknown ones, are one dish whose probability is shared
evenly by its members and one more word.

Layout on Spark. Runs of documents hold their tokens as numbers. Dishes (context, word) are
dealt to cells by context, those of contexts with many tokens by context and word; a cell
sees counts summed per run, never single tokens, and its size is set by the number of tokens.
Dishes of a cell are drawn in a few interleaved classes against the table totals of their
restaurants; totals of the restaurants that are spread over cells come from the last round.
The parent is dealt to blocks of words; cells ask blocks for the words they hold. A text's
sum is added up per cell and run. What grows with the corpus stays in written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.llm import common

END, RARE = 0, 1  # the end of a text, as a context its start; words seen at most once
RUN = 3_000_000  # words of a run, but for a longer text
PIECE = 1 << 18  # tokens of a run that one numpy step sorts or adds up
CELL = 2_000_000  # tokens a cell is meant to see; twice as many occurrences are split
LEAST_CELLS = 64
HOT = 256  # a context with more than one token in so many is spread over all cells
ROUNDS, SWEEPS, CLASSES = 2, 3, 4
EXACT = 512
THETA = 1.0
SEED = 11

_MASK = np.uint64(0xFFFFFFFF)
_L, _D = T.LongType(), T.DoubleType()
MESSAGE = T.StructType(
    [T.StructField("key", _L), T.StructField("kind", T.IntegerType()), T.StructField("part", _L),
     T.StructField("body", T.ArrayType(T.BinaryType()))]
)
# Kinds of messages. STATE and DOWN are followed by one kind per round.
ASK, REPLY, STAT, TOP, DISHES, SIZE, UP, HOT_TABLES, HOT_COUNT, OCCURRENCES, SCORE = range(11)
STATE, DOWN = 100, 200


def pack(a: np.ndarray, *, sorted_: bool = False) -> bytes:
    """Numbers, compressed with bytes of one weight side by side; sorted ones as steps."""
    if sorted_ and len(a):
        a = np.diff(a, prepend=a.dtype.type(0))
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes, kind, *, sorted_: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    a = np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(a, dtype=kind) if sorted_ else a


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.binary()))
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=MESSAGE.names)


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _mapped(df: DataFrame, fn) -> DataFrame:
    """Messages made of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                rows = iter(fn({n: b.column(n)[k].as_py() for n in b.schema.names}))
                while some := list(islice(rows, 64)):
                    yield _batch(some)

    return df.mapInArrow(run, MESSAGE)


def _grouped(messages: DataFrame, fn) -> DataFrame:
    """Messages made of all messages of a key. A fixed number of partitions: adaptive
    execution would merge groups by their bytes, which are few for the work they make."""
    dealt = messages.repartition(common.partitions(messages), "key")
    return dealt.groupBy("key").applyInArrow(lambda t: _table(fn(t.to_pylist())), MESSAGE)


def _of(messages: DataFrame, *kinds: int) -> DataFrame:
    return messages.filter(F.col("kind").isin(*kinds))


def _dealt(values: np.ndarray, n: int) -> list[np.ndarray]:
    """Positions of the values that go to each of n places, in their order."""
    place = (values % np.uint64(n)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    return np.split(order, np.searchsorted(place[order], np.arange(1, n)))


# --- runs of documents with numbered words


def _runs(docs: DataFrame) -> DataFrame:
    ids = T.ArrayType(docs.schema["_id"].dataType)
    fields = [("run", _L), ("ids", ids), ("held", T.ArrayType(T.BooleanType())), ("lens", T.BinaryType()),
              ("words", T.BinaryType()), ("vocabulary", T.BinaryType()), ("counts", T.BinaryType()), ("n_train", _L)]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, hashes, lens, ids, size = TaskContext.get().partitionId() << 32, [], [], [], [], 0

        def flush(number):
            n, h = np.concatenate(lens), np.concatenate(held)
            vocabulary = np.unique(np.concatenate(hashes))
            word = np.concatenate([np.searchsorted(vocabulary, w).astype(np.uint32) for w in hashes])
            counts, train = np.zeros(len(vocabulary), np.uint64), np.repeat(~h, n)
            for lo in range(0, len(word), PIECE):
                part = word[lo : lo + PIECE][train[lo : lo + PIECE]]
                counts += np.bincount(part, minlength=len(vocabulary)).astype(np.uint64)
            who = pa.concat_arrays(ids)
            cols = [
                pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(who)], pa.int32()), who),
                pa.array([h.tolist()], pa.list_(pa.bool_())),
                *[pa.array([b], pa.binary()) for b in (
                    pack(n.astype(np.uint32)), pack(word), pack(vocabulary, sorted_=True), pack(counts))],
                pa.array([int((~h).sum())], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        for b in batches:
            who, out = b.column("_id"), b.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, buf, offsets in common.text_chunks(b.column("text")):
                low = common.LOWER[buf]
                starts, ends, before = common.words(low, offsets, common.SPACE)
                hashes.append(common.span_hashes(low, starts, ends))
                lens.append(np.diff(before))
                ids.append(who.slice(lo, hi - lo))
                held.append(out[lo:hi])
                size += len(starts) + hi - lo
                if size >= RUN:
                    yield flush(first)
                    first, held, hashes, lens, ids, size = first + 1, [], [], [], [], 0
        if ids:
            yield flush(first)

    return common.written(docs.select("_id", "held", "text").mapInArrow(run, schema), "runs")


@dataclass
class Vocabulary:
    """Sizes of the training vocabulary; ``hot`` are ids of contexts that many tokens have."""

    tokens: int  # training tokens with ends
    types: int  # distinct ones
    texts: int  # training texts
    once: int  # words seen once
    dishes: int
    hot: np.ndarray


def _ask(blocks: int):
    def fn(row):
        vocabulary, counts = unpack(row["vocabulary"], np.uint64, sorted_=True), unpack(row["counts"], np.uint64)
        return [
            (k, ASK, row["run"], [pack(vocabulary[at], sorted_=True), pack(counts[at])])
            for k, at in enumerate(_dealt(vocabulary, blocks))
        ]

    return fn


def _number(blocks: int):
    """Counts of a block's words over all runs, and ids by falling count."""

    def fn(rows):
        block = rows[0]["key"]
        asked = [unpack(r["body"][0], np.uint64, sorted_=True) for r in rows]
        words, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, at, np.concatenate([unpack(r["body"][1], np.uint64) for r in rows]).astype(np.int64))
        order = np.lexsort((words, -total))
        ids = np.full(len(words), RARE, np.uint64)
        kept = order[: int((total >= 2).sum())]
        ids[kept] = 2 + np.arange(len(kept), dtype=np.uint64) * np.uint64(blocks) + np.uint64(block)
        out, lo = [], 0
        for r, a in zip(rows, asked):
            mine = at[lo : lo + len(a)]
            lo += len(a)
            out.append((r["part"], REPLY, block, [pack(ids[mine].astype(np.uint32)), pack(total[mine].astype(np.uint64))]))
        sizes = (total.sum(), (total > 0).sum(), (total == 1).sum(), len(kept))
        out += [(k, STAT, int(v), []) for k, v in enumerate(sizes)]
        out += [(int(ids[k]), TOP, int(total[k]), []) for k in kept[:HOT]]
        return out

    return fn


def _vocabulary(runs: DataFrame, replies: DataFrame) -> Vocabulary:
    texts = runs.agg(F.sum("n_train")).first()[0] or 0
    stat = {r.key: r.n for r in _of(replies, STAT).groupBy("key").agg(F.sum("part").alias("n")).collect()}
    words, types, once, dishes = (stat.get(k, 0) for k in range(4))
    tokens = words + texts
    top = _of(replies, TOP).filter(F.col("part") * HOT > tokens).select("key").collect()  # below HOT rows
    hot = np.array(sorted({END, RARE, *[r.key for r in top]}), np.uint64)
    return Vocabulary(tokens, types + (texts > 0), texts, once, dishes + 2, hot)


def _numbered(runs: DataFrame, replies: DataFrame, v: Vocabulary, blocks: int) -> DataFrame:
    """Runs with global word numbers, an END after each text, and the measures of each text
    that need counts alone."""
    fields = [("run", _L), ("ids", runs.schema["ids"].dataType), ("held", T.ArrayType(T.BooleanType())),
              ("n_tokens", T.ArrayType(_L)), ("n_known", T.ArrayType(_L)), ("base", T.ArrayType(_D)),
              ("tokens", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    room = np.log10(float(v.tokens) + (v.types + 1))

    def measure(row):
        n, word = unpack(row["lens"], np.uint32).astype(np.int64), unpack(row["words"], np.uint32)
        vocabulary = unpack(row["vocabulary"], np.uint64, sorted_=True)
        ids, total = np.zeros(len(vocabulary), np.uint32), np.zeros(len(vocabulary), np.int64)
        place = _dealt(vocabulary, blocks)
        for r in row["replies"]:
            ids[place[r["part"]]] = unpack(r["body"][0], np.uint32)
            total[place[r["part"]]] = unpack(r["body"][1], np.uint64)
        ends = np.cumsum(n + 1) - 1
        tokens = np.full(len(word) + len(n), END, np.uint32)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner] = ids[word]
        each = np.log10(total + 1.0) - room
        base, known = np.zeros(len(n)), np.zeros(len(n), np.int64)
        first = np.append(0, np.cumsum(n))
        lo = 0
        while lo < len(n):  # whole texts of about PIECE words at a time
            hi = max(lo + 1, int(np.searchsorted(first, first[lo] + PIECE, side="right")) - 1)
            text, part = np.repeat(np.arange(hi - lo), n[lo:hi]), word[first[lo] : first[hi]]
            base[lo:hi] = np.bincount(text, weights=each[part], minlength=hi - lo)
            known[lo:hi] = np.bincount(text, weights=(total > 0)[part], minlength=hi - lo)
            lo = hi
        return n + 1, known + (v.texts > 0), base + np.log10(v.texts + 1.0) - room, tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                names = ("lens", "words", "vocabulary", "replies")
                n, known, base, tokens = measure({c: one.column(c)[0].as_py() for c in names})
                cols = [one.column("run"), one.column("ids"), one.column("held"),
                        pa.array([n], pa.list_(pa.int64())), pa.array([known], pa.list_(pa.int64())),
                        pa.array([base], pa.list_(pa.float64())), pa.array([pack(tokens)], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    answers = _of(replies, REPLY).groupBy("key").agg(F.collect_list(F.struct("part", "body")).alias("replies"))
    answers = _side(answers.withColumnRenamed("key", "run"), "replies")
    rows = runs.select("run", "ids", "held", "lens", "words", "vocabulary").join(answers, "run", "left")
    rows = rows.withColumn("replies", F.coalesce("replies", F.array().cast(answers.schema["replies"].dataType)))
    return common.written(rows.mapInArrow(run, schema), "tokens")


def _side(answers: DataFrame, column: str) -> DataFrame:
    """A join side, broadcast if its bytes are counted to be few."""
    answers = common.written(answers, "side")
    size = F.aggregate(column, F.lit(0).cast("long"), lambda n, r: n + F.aggregate(
        r["body"], F.lit(0).cast("long"), lambda m, b: m + F.length(b)))
    total = answers.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(answers) if total <= common.SMALL else answers


# --- dishes and their cells


def _cell_of(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    context = keys >> np.uint64(32)
    return common.mix(np.where(np.isin(context, hot), keys, context))


def _dishes_of(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The dish of the tokens at some places. The END before a text is the context of its first word."""
    context = np.where(at > 0, tokens[at - 1], np.uint32(END))
    return (context.astype(np.uint64) << np.uint64(32)) | tokens[at].astype(np.uint64)


def _in_cells(tokens: np.ndarray, cells: int, hot: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first cell, end cell, sorted dishes, their places`` of a run, for ranges of cells with
    about PIECE tokens, so that no sort holds a whole run."""
    place = np.empty(len(tokens), np.uint32)
    for lo in range(0, len(tokens), PIECE):
        keys = _dishes_of(tokens, np.arange(lo, min(lo + PIECE, len(tokens))))
        place[lo : lo + PIECE] = _cell_of(keys, hot) % np.uint64(cells)
    step = -(-cells // max(1, -(-len(tokens) // PIECE)))
    for lo in range(0, cells, step):
        at = np.flatnonzero((place >= lo) & (place < lo + step))
        if len(at):
            keys = _dishes_of(tokens, at)
            order = np.argsort(keys, kind="stable")
            yield lo, min(lo + step, cells), keys[order], at[order]


def _per_cell(dishes: np.ndarray, lo: int, hi: int, cells: int, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Cells from ``lo`` up to ``hi`` that have dishes, with the places of theirs."""
    for k, at in enumerate(_dealt(_cell_of(dishes, hot) % np.uint64(cells) - np.uint64(lo), hi - lo)):
        if len(at):
            yield lo + k, at


def _counted(cells: int, hot: np.ndarray):
    def fn(row):
        train = np.repeat(~np.array(row["held"], bool), row["n_tokens"])
        for lo, hi, keys, places in _in_cells(unpack(row["tokens"], np.uint32), cells, hot):
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.add.reduceat(train[places].astype(np.uint64), first)
            size = np.diff(np.append(first, len(keys)))
            dishes = keys[first]
            for k, at in _per_cell(dishes, lo, hi, cells, hot):
                yield k, DISHES, int(size[at].sum()), [pack(dishes[at], sorted_=True), pack(counts[at])]

    return fn


def _merged(rows):
    """All dishes of a cell with their training counts; sizes for the discount and the split."""
    keys, at = np.unique(
        np.concatenate([unpack(r["body"][0], np.uint64, sorted_=True) for r in rows]), return_inverse=True
    )
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, at, np.concatenate([unpack(r["body"][1], np.uint64) for r in rows]).astype(np.int64))
    cell = rows[0]["key"]
    return [
        (cell, DISHES, 0, [pack(keys, sorted_=True), pack(counts)]),
        (cell, SIZE, sum(r["part"] for r in rows), []),
        *[(k, STAT, int((counts == k).sum()), []) for k in (1, 2)],
    ]


def _occurring(cells: int, hot: np.ndarray, split: dict[int, int]):
    """Per dish the texts of a run that hold it and how often."""

    def fn(row):
        texts = np.repeat(np.arange(len(row["n_tokens"]), dtype=np.uint32), row["n_tokens"])
        for lo, hi, keys, places in _in_cells(unpack(row["tokens"], np.uint32), cells, hot):
            text = texts[places]
            first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])))
            times = np.diff(np.append(first, len(keys))).astype(np.uint32)
            keys, text = keys[first], text[first]
            start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            size = np.diff(np.append(start, len(keys)))
            dishes = keys[start]
            for k, at in _per_cell(dishes, lo, hi, cells, hot):
                n = size[at]
                each = np.repeat(start[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
                body = [pack(dishes[at], sorted_=True), pack(n.astype(np.uint32)), pack(text[each]), pack(times[each])]
                yield k + cells * (row["run"] % split.get(k, 1)), OCCURRENCES, row["run"], body

    return fn


# --- seating


def discount(once: int, twice: int) -> float:
    """From the numbers of dishes with one and with two customers."""
    return float(np.clip(once / max(1, once + 2 * twice), 0.05, 0.95))


@cache
def stirling(d: float, most: int) -> np.ndarray:
    """Logarithms of generalised Stirling numbers by customers and tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, most + 1)
    for c in range(1, most):
        stay = out[c, 1 : c + 1] + np.log(c - d * t[:c])
        out[c + 1, 1 : c + 1] = np.logaddexp(out[c, :c], stay)
        out[c + 1, c + 1] = 0.0
    return out


def draw_tables(rng, c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, theta: float, numbers: np.ndarray) -> np.ndarray:
    """Numbers of tables for dishes with ``c`` customers in restaurants that have ``others``
    tables for other dishes, if the parent serves them with probability ``p``."""
    t = np.minimum(c, 1)
    few = (c > 1) & (c <= EXACT)
    log_p = np.log(np.maximum(p, 1e-300))
    for n in np.unique(c[few]):
        where = np.flatnonzero(c == n)
        tables = np.arange(1, n + 1)
        step = max(1, (1 << 20) // int(n))
        for lo in range(0, len(where), step):
            at = where[lo : lo + step]
            grow = np.log(theta + d * (others[at, None] + np.arange(n)))
            w = numbers[n, 1 : n + 1] + np.cumsum(grow, axis=1) + tables * log_p[at, None]
            w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            t[at] = 1 + (w < rng.random(len(at))[:, None] * w[:, -1:]).sum(axis=1)
    many = np.flatnonzero(c > EXACT)
    if len(many):
        t[many] = _draw_many(rng, c[many], others[many], log_p[many], d, theta)
    return t


def _draw_many(rng, c, others, log_p, d, theta):
    """A normal draw around the mode. The ratio of the weights of neighbouring numbers of
    tables comes from the saddle point x of the Stirling numbers, with s = -log(1 - x)."""

    def steep(s):
        return 1 / np.expm1(s) + (1 - d) - d / np.expm1(d * s)

    def at(s):
        t = c * -np.expm1(-d * s) / (d * -np.expm1(-s) * np.exp(np.minimum(s * (1 - d), 700.0)))
        # The width of the saddle, c steep(s) (e^s - 1), changes with t, too.
        e = 1e-4 * s
        width = (np.log(steep(s + e)) - np.log(steep(s - e))) / (2 * e) - 1 / np.expm1(-s)
        rise = -np.log(t + 1) - np.log(d) + np.log(-np.expm1(-d * s)) + np.log(theta + d * (others + t)) + log_p
        return t, rise + width / (2 * np.maximum(t, 1e-9) * steep(s))

    lo, hi = np.full(len(c), 1e-4), np.log(c / d) / (1 - d) + 10
    for _ in range(50):
        s = (lo + hi) / 2
        up = at(s)[1] > 0  # the weight still rises with another table: s is too large
        lo, hi = np.where(up, lo, s), np.where(up, s, hi)
    (t, r), (t2, r2) = at(s), at(s * 1.001)
    with np.errstate(all="ignore"):
        wide = np.sqrt(np.abs((t2 - t) / (r2 - r)))
    t = np.rint(t + 0.5 + np.where(np.isfinite(wide), wide, 0.0) * rng.standard_normal(len(c)))
    return np.clip(t, 1, c).astype(np.int64)


@dataclass
class Root:
    """The parent restaurant: customers, tables, discount, dishes of its base."""

    customers: int
    tables: int
    discount: float
    dishes: int

    def probability(self, own: np.ndarray) -> np.ndarray:
        """From the customers of a word less the discount of its tables."""
        return (own + (THETA + self.discount * self.tables) / self.dishes) / (THETA + self.customers)


class Cell:
    """The dishes of one cell, and the words its parent is asked for."""

    def __init__(self, body: list[bytes], blocks: int, hot: np.ndarray):
        self.keys, self.c = unpack(body[0], np.uint64, sorted_=True), unpack(body[1], np.int64)
        context = self.keys >> np.uint64(32)
        first = np.append(True, context[1:] != context[:-1])
        self.context, self.contexts = np.cumsum(first) - 1, context[first]
        self.words, self.word = np.unique(self.keys & _MASK, return_inverse=True)
        self.blocks = _dealt(self.words, blocks)
        self.hot = np.isin(self.contexts, hot)

    def per_context(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=v, minlength=len(self.contexts)).astype(np.int64)

    def totals(self, v: np.ndarray, known: dict[int, int]) -> np.ndarray:
        """Sums of each dish's context; those of spread contexts are known from outside."""
        out = self.per_context(v)
        for k in np.flatnonzero(self.hot):
            out[k] = known.get(int(self.contexts[k]), 0)
        return out

    def spread(self, cell: int, kind: int, v: np.ndarray) -> list[tuple]:
        out = self.per_context(v)
        return [(int(self.contexts[k]), kind, int(out[k]), []) for k in np.flatnonzero(self.hot)]

    def ask(self, cell: int, tables: np.ndarray) -> list[tuple]:
        sums = np.bincount(self.word, weights=tables, minlength=len(self.words)).astype(np.uint64)
        return [(k, UP, cell, [pack(self.words[at], sorted_=True), pack(sums[at])]) for k, at in enumerate(self.blocks) if len(at)]

    def parent(self, answers: list[dict], root: Root) -> np.ndarray:
        own = np.zeros(len(self.words))
        for r in answers:
            own[self.blocks[r["part"]]] = unpack(r["body"][0], np.float32)
        return root.probability(own)[self.word]


def _first_tables(blocks: int, hot: np.ndarray):
    """One table a dish."""

    def fn(row):
        cell = Cell(row["body"], blocks, hot)
        t = np.minimum(cell.c, 1)
        return [
            (row["key"], STATE, 0, [pack(t)]), *cell.ask(row["key"], t),
            *cell.spread(row["key"], HOT_TABLES, t), *cell.spread(row["key"], HOT_COUNT, cell.c),
        ]

    return fn


def _seat_root(root: Root, number: int):
    """Customers of a block's words, their tables, and what each cell is told of them."""

    def fn(rows):
        block = rows[0]["key"]
        asked = [unpack(r["body"][0], np.uint64, sorted_=True) for r in rows]
        words, at = np.unique(np.concatenate(asked), return_inverse=True)
        c = np.zeros(len(words), np.int64)
        np.add.at(c, at, np.concatenate([unpack(r["body"][1], np.uint64) for r in rows]).astype(np.int64))
        rng = np.random.default_rng([SEED, 1, block, number])
        others = np.full(len(c), max(0, root.tables - 1))
        t = draw_tables(rng, c, others, np.full(len(c), 1.0 / root.dishes), root.discount, THETA, stirling(root.discount, EXACT))
        own = (c - root.discount * t).astype(np.float32)
        out, lo = [], 0
        for r, a in zip(rows, asked):
            out.append((r["part"], DOWN + number, block, [pack(own[at[lo : lo + len(a)]])]))
            lo += len(a)
        sizes = (c.sum(), t.sum(), (c == 1).sum(), (c == 2).sum())
        return out + [(k, STAT, int(v), []) for k, v in enumerate(sizes)]

    return fn


def _sweep(root: Root, d: float, hot_tables: dict[int, int], blocks: int, hot: np.ndarray, number: int):
    """Gibbs sweeps over a cell's dishes given the parent."""

    def fn(rows):
        key = rows[0]["key"]
        cell = Cell(next(r["body"] for r in rows if r["kind"] == DISHES), blocks, hot)
        t = unpack(next(r["body"][0] for r in rows if STATE <= r["kind"] < DOWN), np.int64)
        p = cell.parent([r for r in rows if r["kind"] >= DOWN], root)
        total = cell.totals(t, hot_tables)
        rng, numbers = np.random.default_rng([SEED, 0, key, number]), stirling(d, EXACT)
        free = np.flatnonzero(cell.c > 1)  # one customer always has one table
        group = common.mix(cell.keys[free] + np.uint64(number)) % np.uint64(CLASSES)
        t = t.copy()
        for _ in range(SWEEPS):
            for g in range(CLASSES):
                at = free[group == g]
                where = cell.context[at]
                new = draw_tables(rng, cell.c[at], total[where] - t[at], p[at], d, THETA, numbers)
                total = total + np.bincount(where, weights=new - t[at], minlength=len(total)).astype(np.int64)
                t[at] = new
        return [(key, STATE + number, 0, [pack(t)]), *cell.ask(key, t), *cell.spread(key, HOT_TABLES, t)]

    return fn


@dataclass
class Sample:
    """What a seating is outside the cells."""

    root: Root
    hot_tables: dict[int, int]


def _score(samples: dict[int, Sample], d: float, hot_count: dict[int, int], blocks: int, hot: np.ndarray, rare: float):
    """Sums of log10 of the averaged predictive probability, per run and text."""

    def fn(rows):
        occurring = [r for r in rows if r["kind"] == OCCURRENCES]
        if not occurring:
            return []
        cell = Cell(next(r["body"] for r in rows if r["kind"] == DISHES), blocks, hot)
        customers = cell.totals(cell.c, hot_count)[cell.context]
        p = np.zeros(len(cell.c))
        for k, s in samples.items():
            t = unpack(next(r["body"][0] for r in rows if r["kind"] == STATE + k), np.int64)
            parent = cell.parent([r for r in rows if r["kind"] == DOWN + k], s.root)
            tables = cell.totals(t, s.hot_tables)[cell.context]
            p += (cell.c - d * t + (THETA + d * tables) * parent) / (THETA + customers)
        log_p = np.log10(p / len(samples)) - np.where((cell.keys & _MASK) == RARE, np.log10(rare), 0.0)
        out = []
        for r in occurring:
            keys, n, text, times = (unpack(b, k, sorted_=o) for b, k, o in zip(
                r["body"], (np.uint64, np.uint32, np.uint32, np.uint32), (True, False, False, False)))
            each = np.repeat(log_p[np.searchsorted(cell.keys, keys)], n) * times
            texts, at = np.unique(text, return_inverse=True)
            sums = np.bincount(at, weights=each, minlength=len(texts))
            out.append((r["part"], SCORE, r["key"], [pack(texts, sorted_=True), sums.tobytes()]))
        return out

    return fn


def _sums(df: DataFrame, kind: int) -> dict[int, int]:
    return {r.key: r.n for r in _of(df, kind).groupBy("key").agg(F.sum("part").alias("n")).collect()}


def _ask_root(asked: DataFrame, root: Root, number: int) -> tuple[DataFrame, Root]:
    answers = common.written(_grouped(_of(asked, UP), _seat_root(root, number)), "root")
    stat = _sums(answers, STAT)
    customers, tables, once, twice = (stat.get(k, 0) for k in range(4))
    return answers, Root(customers, tables, root.discount, root.dishes), discount(once, twice)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", held: str = "held_out") -> DataFrame:
    """``key, held, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Rows whose ``held`` is true are scored and not learned from; a null ``held`` is false. A
    null or empty text is one token, the end. Every row counts, repeated ones again; a null
    ``key`` is kept. A long text is one run of its own if it exceeds RUN words. Without
    training rows all words are unknown and probabilities even. An empty table gives an empty
    result. Only the three columns named are read.
    """
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(held), F.lit(False)).alias("held"), F.col(text).alias("text"))
    runs = _runs(rows)
    blocks = common.partitions(docs)
    replies = common.written(_grouped(_mapped(runs.select("run", "vocabulary", "counts"), _ask(blocks)), _number(blocks)), "vocabulary")
    v = _vocabulary(runs, replies)
    tokens = _numbered(runs, replies, v, blocks)
    seen = tokens.agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, n: s + n))).first()[0] or 0
    cells = max(LEAST_CELLS, -(-seen // CELL))
    of_run = tokens.select("run", "held", "n_tokens", "tokens")
    dishes = common.written(_grouped(_mapped(of_run, _counted(cells, v.hot)), _merged), "dishes")
    stat = _sums(dishes, STAT)
    d = discount(stat.get(1, 0), stat.get(2, 0))
    split = {r.key: -(-r.part // (2 * CELL)) for r in _of(dishes, SIZE).filter(F.col("part") > 2 * CELL).collect()}
    dishes = _of(dishes, DISHES)

    state = common.written(_mapped(dishes, _first_tables(blocks, v.hot)), "state")
    hot_count, hot_tables = _sums(state, HOT_COUNT), _sums(state, HOT_TABLES)
    answers, root, d_root = _ask_root(state, Root(0, v.dishes, 0.5, v.dishes), 0)
    samples, kept = {}, []
    for number in range(1, ROUNDS + 1):
        known = dishes.unionByName(_of(state, STATE + number - 1)).unionByName(_of(answers, DOWN + number - 1))
        state = common.written(_grouped(known, _sweep(root, d, hot_tables, blocks, v.hot, number)), "state")
        hot_tables = _sums(state, HOT_TABLES)
        answers, root, d_next = _ask_root(state, Root(root.customers, root.tables, d_root, root.dishes), number)
        d_root, samples[number] = d_next, Sample(root, hot_tables)
        kept += [_of(state, STATE + number), _of(answers, DOWN + number)]

    known = dishes
    for k in kept:
        known = known.unionByName(k)
    if split:  # cells with very many occurrences of a dish are read by several groups
        times = F.create_map(*[F.lit(x).cast("long") for kv in split.items() for x in kv])
        copies = F.sequence(F.lit(0).cast("long"), F.coalesce(F.try_element_at(times, F.col("key")), F.lit(1).cast("long")) - 1)
        known = known.withColumn("_copy", F.explode(copies))
        known = known.select((F.col("key") + F.col("_copy") * cells).alias("key"), "kind", "part", "body")
    known = known.unionByName(_mapped(of_run, _occurring(cells, v.hot, split)))
    sums = _grouped(known, _score(samples, d, hot_count, blocks, v.hot, v.once + 1.0))
    return _per_text(tokens, sums, docs.schema[key], held, v.tokens)


def _per_text(tokens: DataFrame, sums: DataFrame, key: T.StructField, held: str, n_train: int) -> DataFrame:
    schema = T.StructType(
        [key, T.StructField(held, T.BooleanType()), *[T.StructField(c, _L) for c in ("n_tokens", "n_known", "train_tokens")],
         *[T.StructField(c, _D) for c in ("base_score", "score")]]
    )

    def run(texts: pa.Table, parts: pa.Table) -> pa.Table:
        column = lambda c: texts.column(c).combine_chunks().flatten()
        n = len(column("n_tokens"))
        score = np.zeros(n)
        for r in parts.sort_by("part").to_pylist():
            score[unpack(r["body"][0], np.uint32, sorted_=True)] += np.frombuffer(r["body"][1])
        cols = [column("ids"), column("held"), column("n_tokens"), column("n_known"),
                pa.array(np.full(n, n_train)), column("base"), pa.array(score)]
        return pa.Table.from_arrays(cols, names=schema.names)

    meta = tokens.select("run", "ids", "held", "n_tokens", "n_known", "base")
    return meta.groupBy("run").cogroup(sums.withColumnRenamed("key", "run").groupBy("run")).applyInArrow(run, schema)


def op11_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score_texts(docs.withColumn("held_out", held))
