"""Fuzzy line de-duplication.

Lines are compared in a normal form (lower-cased, white space runs as one blank). A line of
at least SHINGLE characters gets MinHash signatures of its character shingles; BANDS bands of
ROWS values each find at least 99 % of the lines at the threshold. Most bands are one line's
alone; packed chunks of lines ask blocks of bands which are not, and only lines with such bands
go on. Equal ones (of any length) collapse, and ask again. Their texts are picked where they
lie, by a filter of the wanted lines. Inside a band the rows are sorted, the most frequent line
first, and each meets its neighbours and the first of the band, unless parity sketches keep them
apart. Candidates are confirmed by exact Jaccard similarity and joined to
components by distributed union-find. Crowded bands that these few links per line leave in
several components are settled (``crowded``). One line of each component stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common, crowded
from fadecast.llm.components import components
from fadecast.llm.neighbours import close_pairs
from fadecast.llm.pitmanyor import pack, unpack

SHINGLE = 8  # characters
BANDS = 8
ROWS = 3
PERCENT = 80
NEAR = 2
HELD = 1 << 17  # characters that one numpy step looks at
CHUNK_LINES = 80_000  # lines that ask for their bands together
WIDE = 5  # bytes of a band; an equal hash of different bands only makes candidates
KEY = 12  # bytes of a line's key
BITS = 512  # of a line's sketch
SLICE = 1 << 16  # bits of a slice of the filter of wanted lines
SPARE = 12  # bits of it for each line

_rng = np.random.default_rng(4177)
_MUL = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
# Further bands of lines in crowded regions.
_MUL = np.append(_MUL, _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
_XOR = np.append(_XOR, _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32))
_P1 = np.uint64(0x9E3779B97F4A7C15)
_P2 = np.uint64(0x9E3779B97F4A7C15**2 % 2**64)
_P4 = np.uint64(0x9E3779B97F4A7C15**4 % 2**64)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def line_key(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=KEY).digest()


def char_shingles(text: str) -> np.ndarray:
    """Hashes of the runs of SHINGLE characters, at all places of ``text``."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < SHINGLE:
        return np.zeros(0, np.uint64)
    c += np.uint64(1)
    h = c[:-1] * _P1
    h += c[1:]
    c = h[:-2] * _P2
    c += h[2:]
    h = c[:-4] * _P4
    h += c[4:]
    return _mixed(h)


def _mixed(h: np.ndarray) -> np.ndarray:
    """``common.mix`` in place."""
    t = h >> np.uint64(33)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= t
        h *= np.uint64(factor)
        np.right_shift(h, np.uint64(33), out=t)
    h ^= t
    return h


def _pieces(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of lines with about HELD characters; a longer line makes a run of its own."""
    lo = 0
    while lo < len(lines):
        hi, size = lo + 1, len(lines[lo])
        while hi < len(lines) and size + len(lines[hi]) <= HELD:
            size += len(lines[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _runs(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all places of lines of SHINGLE characters or more, and where each line's end."""
    lengths = np.array([len(x) for x in lines])
    ends = np.cumsum(lengths)
    found = char_shingles("".join(lines))
    if len(lines) > 1:  # runs that reach into the next line are not shingles
        inside = np.ones(len(found), bool)
        inside[(ends[:-1, None] - np.arange(1, SHINGLE)).ravel()] = False
        found = found[inside]
    return found, ends - (SHINGLE - 1) * np.arange(1, len(lines) + 1)


def bands(lines: list[str]) -> np.ndarray:
    """A row of BANDS hashes per normal line; all lines have SHINGLE characters or more."""
    out = np.empty((len(lines), BANDS), np.uint64)
    for lo, hi in _pieces(lines):
        out[lo:hi] = _bands(*_runs(lines[lo:hi]), range(BANDS))
    return out


def _bands(found: np.ndarray, ends: np.ndarray, which: range) -> np.ndarray:
    """Bands of sets of shingles that stand one after the other and end at ``ends``."""
    found = (found >> np.uint64(32)).astype(np.uint32)
    starts, hashed = np.append(0, ends[:-1]), np.empty_like(found)
    least = np.empty((len(which), ROWS, len(ends)), np.uint64)
    for j in range(which[0] * ROWS, (which[-1] + 1) * ROWS):
        np.bitwise_xor(found, _XOR[j], out=hashed)
        np.multiply(hashed, _MUL[j], out=hashed)
        least[j // ROWS - which[0], j % ROWS] = np.minimum.reduceat(hashed, starts)
    out = np.repeat(np.array(which, np.uint64)[:, None] + np.uint64(1), len(ends), axis=1)
    for k in range(ROWS):
        out = common.mix(out * _P1 + least[:, k])
    return out.T


def _sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each line, one line after the other, and where each line's end."""
    found, ends = _runs(lines)
    starts = np.append(0, ends[:-1])
    for a, b in zip(starts.tolist(), ends.tolist()):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[starts] = True
    return found[new], np.cumsum(new)[ends - 1]


def _lines_of(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, int, str]]:
    """``row, line number, normal line`` of all lines that are not blank."""
    for i, text in enumerate(batch.column(text_at)):
        text = text.as_py()
        if text:
            for k, line in enumerate(text.split("\n")):
                line = normal(line)
                if line:
                    yield i, k, line


def _packed(found: np.ndarray) -> np.ndarray:
    """The first WIDE bytes of each hash, as bytes in a last axis."""
    low = (found >> np.uint64(64 - 8 * WIDE)).astype("<u8")
    return np.ascontiguousarray(low[..., None].view(np.uint8)[..., :WIDE])


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDE, 8), np.uint8)
    out[:, :WIDE] = np.frombuffer(data, np.uint8).reshape(-1, WIDE)
    return out.view("<u8").ravel()


# Columns of lines as they lie in a chunk, each as one string of bytes; ``many`` is the number of a line's bands.
_KINDS = {"doc_id": "<i8", "text_key": "<i8", "line_no": "<i4", "n": "<i8", "key": f"V{KEY}", "many": "<u1"}
_ARROW = {"<i8": pa.int64(), "<i4": pa.int32()}
_PLACED = ["doc_id", "text_key", "line_no", "key"]
_SQL = {"doc_id": "long", "text_key": "long", "line_no": "int", "n": "long", "key": "binary"}


def _chunk_schema(names: list[str]) -> str:
    return "chunk long, " + ", ".join(f"{c} binary" for c in [*names, "many", "bands"])


def _chunks(parts: Iterator[dict[str, bytes]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Chunks of about CHUNK_LINES lines, one row each, of smaller parts."""
    chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

    def emit():
        columns = [pa.array([b"".join(p[c] for p in held)], pa.binary()) for c in (*names, "many", "bands")]
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *columns], names=["chunk", *names, "many", "bands"])

    for part in parts:
        held.append(part)
        size += len(part["many"])
        if size >= CHUNK_LINES:
            yield emit()
            chunk, held, size = chunk + 1, [], 0
    if size:
        yield emit()


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of all lines. A line without a shingle has one band for itself, from its key: only
    equal ones are its copies."""

    def part(batch, rows, at, lines):
        rows = np.array(rows)
        keys = [line_key(x) for x in lines]
        many = np.array([BANDS if len(x) >= SHINGLE else 1 for x in lines], np.uint8)
        own = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY)[:, :WIDE]
        found = np.empty((int(many.sum()), WIDE), np.uint8)
        long = np.repeat(many == BANDS, many)
        found[long] = _packed(bands([x for x in lines if len(x) >= SHINGLE])).reshape(-1, WIDE)
        found[~long] = own[many == 1]
        columns = [batch.column(k).to_numpy()[rows].astype("<i8").tobytes() for k in (0, 1)]
        columns += [np.array(at, "<i4").tobytes(), b"".join(keys), many.tobytes(), found.tobytes()]
        return dict(zip((*_PLACED, "many", "bands"), columns))

    def parts():
        for batch in batches:
            rows, at, lines, size = [], [], [], 0
            for i, k, line in _lines_of(batch, 2):
                rows.append(i)
                at.append(k)
                lines.append(line)
                size += len(line)
                if size > 4 * common.CHUNK or len(lines) >= CHUNK_LINES:
                    yield part(batch, rows, at, lines)
                    rows, at, lines, size = [], [], [], 0
            if lines:
                yield part(batch, rows, at, lines)

    return _chunks(parts(), _PLACED)


def _chunked(names: list[str]):
    """Lines (columns ``names`` and ``bands``) in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(batch):
            found = batch.column("bands").to_pylist()
            out = {"many": bytes(len(x) // WIDE for x in found), "bands": b"".join(found)}
            for c in names:
                column = batch.column(c)
                out[c] = b"".join(column.to_pylist()) if c == "key" else column.to_numpy().astype(_KINDS[c]).tobytes()
            return out

        return _chunks((part(b.slice(i, CHUNK_LINES)) for b in batches for i in range(0, b.num_rows, CHUNK_LINES)), names)

    return run


def _starts(asked: np.ndarray, blocks: int) -> np.ndarray:
    """Where in the sorted bands each block's range starts (and the last one's ends)."""
    place = (asked * np.uint64(blocks)) >> np.uint64(8 * WIDE)
    return np.searchsorted(place, np.arange(blocks + 1, dtype=np.uint64))


def _new(values: np.ndarray) -> np.ndarray:
    """Which of the sorted values differ from the one before."""
    return np.append(np.ones(min(1, len(values)), bool), values[1:] != values[:-1])


def _ask(blocks: int):
    """The distinct bands of a chunk, dealt to blocks by ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                asked = np.sort(_unpacked(found))
                asked = asked[_new(asked)]
                start = _starts(asked, blocks)
                some = np.flatnonzero(np.diff(start))
                parts = [pack(asked[start[k] : start[k + 1]], sorted_=True) for k in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array([chunk] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                    names=["block", "chunk", "asked"],
                )

    return run


def _shared(rows: pa.Table) -> pa.Table:
    """To each chunk a bit for each of its bands in a block: another chunk has it, too."""
    asked = [unpack(x, np.uint64, sorted_=True) for x in rows.column("asked").to_pylist()]
    found = np.sort(np.concatenate(asked))
    found = found[1:][found[1:] == found[:-1]]
    bits = []
    for x in asked:
        at = np.searchsorted(found, x)
        at[at == len(found)] = 0
        bits.append(np.packbits(found[at] == x).tobytes() if len(found) else b"")
    some = pa.array([any(x) for x in bits])
    return pa.table({c: rows.column(c).combine_chunks().filter(some) for c in ("chunk", "block")} | {"bits": pa.array(bits, pa.binary()).filter(some)})


def _met(names: list[str], blocks: int, all_lines: bool):
    """The lines of a chunk that are repeated or share a band, with the bands they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                many = np.frombuffer(row["many"], np.uint8).astype(np.int64)
                found = _unpacked(row["bands"])
                order = np.argsort(found)
                new = _new(found[order])
                first = np.flatnonzero(new)
                start = _starts(found[order[first]], blocks)
                told = np.diff(np.append(first, len(found))) > 1  # twice in the chunk
                for reply in row["replies"] or []:
                    a, b = start[reply["block"]], start[reply["block"] + 1]
                    told[a:b] |= np.unpackbits(np.frombuffer(reply["bits"], np.uint8), count=b - a).view(bool)
                shared = np.empty(len(found), bool)
                shared[order] = told[np.cumsum(new) - 1]
                line = np.repeat(np.arange(len(many)), many)
                count = np.bincount(line[shared], minlength=len(many))
                keep = count > 0
                if all_lines:  # a single band of a line without a shingle has done its work
                    shared &= (many == BANDS)[line]
                    count[many == 1] = 0
                else:
                    keep |= np.frombuffer(row["n"], _KINDS["n"]) > 1
                at = np.flatnonzero(keep)
                ends = pa.array(np.append(0, np.cumsum(count[at]) * WIDE), pa.int32())
                data = np.frombuffer(row["bands"], np.uint8).reshape(-1, WIDE)[shared]
                out = [pa.Array.from_buffers(pa.binary(), len(at), [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(data))])]
                for c in names:
                    values = np.frombuffer(row[c], _KINDS[c])[at]
                    out.append(common.binaries(values.view(np.uint8).reshape(-1, KEY)) if c == "key" else pa.array(values, _ARROW[_KINDS[c]]))
                yield pa.RecordBatch.from_arrays(out, names=["bands", *names])

    return run


def _meeting(chunks: DataFrame, names: list[str], blocks: int, name: str, all_lines: bool = False) -> DataFrame:
    """The lines of ``chunks`` that are repeated or share a band with another line, each with
    the bands it shares (none if it is repeated only, or has no shingle)."""
    with common.passing(chunks.sparkSession) as stays:
        chunks = common.written(chunks, f"{name}-chunks")
        asked = chunks.select("chunk", "bands").mapInArrow(_ask(blocks), "block long, chunk long, asked binary")
        told = asked.repartition(blocks, "block").groupBy("block").applyInArrow(_shared, "chunk long, block long, bits binary")
        told = common.written(told.groupBy("chunk").agg(F.collect_list(F.struct("block", "bits")).alias("replies")), "shared-bands")
        size = told.agg(F.sum(F.aggregate("replies", F.lit(0).cast("long"), lambda m, x: m + F.length(x["bits"]) + 16))).first()[0] or 0
        rows = chunks.join(F.broadcast(told) if size <= common.SMALL else told, "chunk", "left").drop("chunk")
        schema = "bands binary, " + ", ".join(f"{c} {_SQL[c]}" for c in names)
        return stays(rows.mapInArrow(_met(names, blocks, all_lines), schema), name)


def _each_band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of a line (last column)."""
    for b in batches:
        found = b.column(b.num_columns - 1).to_pylist()
        at = pa.array(np.repeat(np.arange(len(found)), [len(x) // WIDE for x in found]), pa.int64())
        each = pa.array(_unpacked(b"".join(found)).view("<i8"), pa.int64())
        yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[:-1]), each], names=[*b.schema.names[:-1], "band"])


def _same_band(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
    band, n = rows["band"].to_numpy(), rows["size"].to_numpy()
    bits = common.matrix(rows["bits"], BITS // 8).view(np.uint64)
    ok = band[i] == band[j]
    i, j = i[ok], j[ok]
    both = n[i] + n[j]
    ok = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
    ok &= (100 + PERCENT) * np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64) <= (100 - PERCENT) * both
    keys = rows["key"].combine_chunks()
    a, b = keys.take(pa.array(i[ok])).to_pylist(), keys.take(pa.array(j[ok])).to_pylist()
    return pa.Table.from_arrays(
        [pa.array([min(p) for p in zip(a, b)], pa.binary()), pa.array([max(p) for p in zip(a, b)], pa.binary())],
        names=["key_a", "key_b"],
    )


def _spots(at: np.ndarray, line_no: np.ndarray) -> np.ndarray:
    """Four bits of a slice of the filter for each line ``line_no`` of the text ``at``, as rows."""
    h = common.mix(at.astype(np.uint64) + (line_no.astype(np.uint64) + np.uint64(1)) * _P1)
    return h.view("<u2").reshape(-1, 4).astype(np.int64)


def _marked(rows: pa.Table) -> pa.Table:
    """A slice of the filter."""
    seen = np.zeros(SLICE, bool)
    seen[_spots(rows["at"].to_numpy(), rows["line_no"].to_numpy())] = True
    return pa.table({"slice": rows["slice"].slice(0, 1), "bits": pa.array([np.packbits(seen).tobytes()], pa.binary())})


def _marks(wanted: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of the ``n`` lines ``wanted (at, line_no)``; a text's lines are in one slice."""
    out = np.zeros((n * SPARE // SLICE + 1, SLICE // 8), np.uint8)
    rows = wanted.withColumn("slice", F.pmod("at", F.lit(len(out)).cast("long")))
    found = rows.groupBy("slice").applyInArrow(_marked, "slice long, bits binary").toArrow()
    out[found["slice"].to_numpy()] = common.matrix(found["bits"], SLICE // 8)
    return out


def _chosen(batch: pa.RecordBatch, marks) -> Iterator[tuple[int, int, str]]:
    """``text's hash, line number, line`` of the lines asked for by number, or by a filter that
    lets some others pass."""
    for lo in range(0, batch.num_rows, 512):
        part = batch.slice(lo, 512)
        at, texts = part.column("at").to_numpy(), [x.split("\n") for x in part.column("text").to_pylist()]
        if marks is None:
            for h, lines, wanted in zip(at.tolist(), texts, part.column("wanted").to_pylist()):
                yield from ((h, k, lines[k]) for k in wanted)
            continue
        many = np.array([len(x) for x in texts])
        at = np.repeat(at, many)
        line_no = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        spots, rows = _spots(at, line_no), (at % len(marks.value))[:, None]
        hit = np.flatnonzero((marks.value[rows, spots >> 3] << (spots & 7).astype(np.uint8) & np.uint8(128)).all(axis=1))
        lines = list(chain.from_iterable(texts))
        for h, k, i in zip(at[hit].tolist(), line_no[hit].tolist(), hit.tolist()):
            yield h, k, lines[i]


def _texts(marks):
    """The chosen lines of the texts, with the sizes of their sets, their sketches and further bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [(h, k, line) for h, k, x in _chosen(batch, marks) if len(line := normal(x)) >= SHINGLE]
            at, line_no, lines = zip(*chosen) if chosen else ((), (), ())
            sizes, bits = np.zeros(len(lines), np.int64), np.zeros((len(lines), BITS // 8), np.uint8)
            more = np.zeros((len(lines), BANDS, WIDE), np.uint8)
            for lo, hi in _pieces(lines):
                sets, ends = _sets(lines[lo:hi])
                more[lo:hi] = _packed(_bands(sets, ends, range(BANDS, 2 * BANDS)))
                sizes[lo:hi] = np.diff(ends, prepend=0)
                bits[lo:hi] = crowded.sketches(sets, sizes[lo:hi], BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(line_no, pa.int32()), pa.array([line_key(x) for x in lines], pa.binary()),
                 pa.array(lines, pa.string()), pa.array(sizes), common.binaries(bits), common.binaries(more.reshape(-1, BANDS * WIDE))],
                names=["at", "line_no", "key", "line", "size", "bits", "more"],
            )

    return run


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs ``a, b, line_a, line_b`` the similar ones."""
    for batch in batches:
        left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        one, ok = [len(x) + len(y) for x, y in zip(left, right)], np.zeros(len(left), bool)
        lo = 0
        while lo < len(left):
            hi, size = lo + 1, one[lo]
            while hi < len(left) and size + one[hi] <= HELD:
                size += one[hi]
                hi += 1
            ok[lo:hi] = _similar(left[lo:hi], right[lo:hi])
            lo = hi
        mask = pa.array(ok)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def _similar(left: list[str], right: list[str]) -> np.ndarray:
    found, ends = _sets([x for pair in zip(left, right) for x in pair])
    upto, starts = ends[1::2], np.append(0, ends[1:-1:2])
    n = upto - starts
    for a, b in zip(starts.tolist(), upto.tolist()):
        found[a:b].sort()
    twice = np.zeros(len(found) + 1, np.int64)
    np.cumsum(found[1:] == found[:-1], out=twice[1:-1])
    both = twice[upto - 1] - twice[starts]  # equal neighbours inside the pair
    return 100 * both >= PERCENT * (n - both)


def _shingles_of(line: bytes) -> np.ndarray:
    return np.unique(char_shingles(line.decode()))


def _first_texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, line, size, bits, more`` of the ``wanted (doc_id, text_key, line_no)`` lines, each
    read where it stands first. Texts are read where they lie, as long as a filter of the wanted
    lines is small; lines that pass it without being wanted, and copies of texts, go afterwards."""
    own = F.xxhash64("doc_id", "text_key").alias("at")
    places, n = wanted.select(own, "line_no"), wanted.count()
    schema = "at long, line_no int, key binary, line string, size long, bits binary, more binary"
    if n * SPARE <= 8 * common.SMALL:
        marks = keyed.sparkSession.sparkContext.broadcast(_marks(places, n))
        found = keyed.select(own, "text").mapInArrow(_texts(marks), schema)
    else:
        there = wanted.groupBy("doc_id", "text_key").agg(F.collect_list("line_no").alias("wanted"))
        found = keyed.join(there, ["doc_id", "text_key"]).select(own, "text", "wanted").mapInArrow(_texts(None), schema)
    found, place = common.written(found, "line-texts"), ["at", "line_no"]
    odd = found.groupBy(place).agg(F.count(F.lit(1)).alias("c")).join(places.withColumn("asked", F.lit(True)), place, "left")
    odd = common.written(odd.filter("asked is null or c > 1").select(*place, "asked"), "odd-lines")
    again = found.join(common.sized(odd.filter("asked").select(place)), place, "left_semi").dropDuplicates([*place, "key"])
    out = found.join(common.sized(odd.select(place)), place, "left_anti").unionByName(common.written(again, "texts-again"))
    return out.drop(*place)


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The similar ones of ``pairs (key_a, key_b)``, as ``a, b``."""
    texts = texts.select("key", "line")
    return (
        pairs.join(texts.toDF("key_a", "line_a"), "key_a")
        .join(texts.toDF("key_b", "line_b"), "key_b")
        .select("key_a", "key_b", "line_a", "line_b")
        .mapInArrow(_alike, "a binary, b binary")
    )


def _settled(texts: DataFrame, banded: DataFrame, roots: DataFrame) -> DataFrame:
    """``roots`` with the links that crowded bands still lack."""
    rows = crowded.unsettled(banded.select("band", "key", "size", "bits"), roots, NEAR + 1)
    if rows.isEmpty():
        return roots
    # The few pairs whose bands all differ share one of further bands, but for one in 100,000 at the threshold.
    once = rows.select("key", "root", "size", "bits").dropDuplicates(["key"])
    more = once.join(texts.select("key", "more"), "key")
    more = more.mapInArrow(_each_band, "key binary, root binary, size long, bits binary, band long")
    size = more.groupBy("band").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("x"), F.max("root").alias("y"))
    more = more.join(size.filter("x <> y").select("band", "c"), "band")
    rows = rows.unionByName(common.written(more.select(*rows.columns), "more-bands"))
    few, small = F.col("c") <= min(crowded.FEW, crowded.WHOLE), F.col("c") <= crowded.WHOLE

    def alike(pairs: DataFrame) -> DataFrame:
        pairs = common.written(pairs, "crowded-pairs")
        some = pairs.select(F.col("key_a").alias("key")).union(pairs.select("key_b")).distinct()
        return _links(pairs, texts.join(common.sized(some), "key", "left_semi"))

    crowd = rows.filter(~few)
    trees = crowded.within(crowd.filter(small), "band", PERCENT, BITS, spanning=True)
    pairs = crowded.within(rows.filter(few), "band", PERCENT, BITS).unionByName(trees).distinct()
    roots = common.written(crowded.settled(roots, alike(pairs)), "crowded-roots")
    rows = crowded.unsettled(crowd.select("band", "key", "size", "bits"), roots, 1)
    if rows.isEmpty():
        return roots
    links = alike(crowded.within(rows.filter(small), "band", PERCENT, BITS, once=True))
    large = rows.filter(~small).select("key", "root").distinct()
    if not large.isEmpty():
        lines = texts.select("key", "line").join(common.sized(large, 64), "key")
        sets = lines.select("root", F.col("line").cast("binary").alias("body"))
        links = links.unionByName(crowded.links(sets, PERCENT, _shingles_of))
    return crowded.settled(roots, links)


def _roots(keyed: DataFrame, shared: DataFrame, blocks: int) -> DataFrame:
    """``node, root`` of the components of similar lines among ``shared``, those that share a band."""
    with common.passing(keyed.sparkSession) as stays:
        texts = _first_texts(keyed, shared.select("doc_id", "text_key", "line_no"))
        banded = shared.join(texts.select("key", "size", "bits"), "key").select(
            (-F.least("n", F.lit(2**31 - 1))).cast("int").alias("rare"), "key", "size", "bits", "bands"
        )
        banded = banded.mapInArrow(_each_band, "rare int, key binary, size long, bits binary, band long")
        banded = common.written(banded.select("band", "rare", "key", "size", "bits"), "banded")
        order = ["band", "rare", F.xxhash64("key", "band")]
        ordered = banded.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
        ordered = ordered.withColumn("rank", F.monotonically_increasing_id())
        pairs = close_pairs(ordered, "key_a binary, key_b binary", _same_band, NEAR, "close-lines", region="band")
        links = _links(pairs.dropDuplicates(), texts)
        return stays(_settled(texts, banded, components(links)), "line-roots")


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, line_no`` of the lines of ``docs (doc_id, text)`` that go.

    Of a component of similar lines the one with the smallest (doc_id, line_no) stays.
    ``text_key`` is ``xxhash64(text)``: it tells texts apart that share an id.
    """
    keyed = docs.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    place, blocks = F.struct("doc_id", "line_no", "text_key"), common.partitions(docs)
    with common.passing(docs.sparkSession) as stays:
        lines = _meeting(keyed.mapInArrow(_keyed, _chunk_schema(_PLACED)), _PLACED, blocks, "lines", all_lines=True)
        distinct = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"), F.first("bands").alias("bands"))
        names = ["key", "n", "doc_id", "line_no", "text_key"]
        distinct = distinct.select("key", "n", "place.*", "bands")
        met = _meeting(distinct.mapInArrow(_chunked(names), _chunk_schema(names)), names, blocks, "distinct-lines")
        shared = met.filter(F.length("bands") > 0)
        roots = _roots(keyed, shared, blocks)
        member = met.select("key", place.alias("place"), "n").join(roots, F.col("key") == F.col("node"), "left")
        member = member.select("key", "place", "n", F.coalesce("root", "key").alias("root"), F.col("root").isNotNull().alias("linked"))
        # A line that is neither repeated nor linked to a smaller key can still be a root.
        tops = roots.select("root").distinct().withColumn("is_root", F.lit(True))
        member = member.join(tops.withColumnRenamed("root", "k"), F.col("key") == F.col("k"), "left")
        member = member.filter("n > 1 or linked or is_root")
        first = member.groupBy("root").agg(F.min("place").alias("stays"))
        fate = member.select("key", "root").join(first, "root").select("key", "stays")
        gone = lines.select("doc_id", "text_key", "line_no", "key").join(common.sized(fate, width=64), "key").filter(place != F.col("stays"))
        return stays(gone.select("doc_id", "text_key", "line_no"), "removed-lines")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``removed_lines``, the numbers (from 0) of the lines that are near
    copies of an earlier line of the corpus; null if there are none.

    Blank lines stay; lines of fewer than SHINGLE characters go only as equal copies. Null and
    empty texts have no line to remove. Long lines and texts are compared whole.
    Rows without an id take no part. Equal rows are one document, so they lose and keep
    the same lines. An empty table gives an empty table. Other columns pass through.
    """
    gone = removed_lines(docs).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("removed_lines"))
    gone = gone.toDF("gone id", "gone text", "removed_lines")
    docs = docs.drop("removed_lines")
    return docs.join(
        gone, (F.col("doc_id") == F.col("gone id")) & (F.xxhash64("text") == F.col("gone text")), "left"
    ).drop("gone id", "gone text")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines that go and their numbers."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = removed_lines(docs).groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    size = docs.select("doc_id", F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"))
    out = size.join(gone, "doc_id", "left")
    return out.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("gone", lambda x: x.cast("string")), ","), F.lit("")).alias("removed_lines"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies of lines leave the texts; a document that has no line left goes."""
    names = docs.columns
    held = {c: f"held {c}" for c in names if c == "removed_lines"}
    out = dedup_lines(docs.withColumnsRenamed(held))
    rest = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("removed_lines"), i))
    text = F.when(F.col("removed_lines").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    out = out.withColumn("text left", text).filter(F.col("removed_lines").isNull() | (F.trim("text left") != ""))
    fresh = {"text": F.col("text left")}
    if "n_chars" in names:
        same = F.col("removed_lines").isNull()
        fresh["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length("text left")).cast("long")
    return out.select(*(fresh.get(c, F.col(f"`{held.get(c, c)}`")).alias(c) for c in names))
