"""WARC archives: writing with segmented records, and reassembly.

The writer stores pages as records of an archive. A record longer than a segment is
continued in further records, so no record and, with a bounded number of pages a file, no
archive grows without limit. Payloads that occur before are stored as revisits.

The reader parses whole archives, groups continuation records by the identifier of the
record they continue, orders them by segment number, verifies that they are complete and
have the stated total length, and decodes chunked transfer framing.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common
from fadecast.session import shared_path

SEGMENT = 16_384  # bytes of a record's block
CHUNK = 4_096  # bytes of a chunk of the transfer framing
PAGES = 2_000  # pages of a file
MIN_REVISIT = 0  # smaller payloads are always stored whole

# Fixed values of the format.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken or cut off."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is cut off")
        size = int(framed[at:end].split(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(out)
        at = end + 2
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(framed[at : at + size])
        at += size + 2


def record(fields: dict[str, object], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items() if v is not None)
    return VERSION + b"\r\n" + head + b"Content-Length: %d" % len(block) + END + block + END


def _clean(url: str | None) -> str | None:
    """A header field is one line."""
    return None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")


def page_records(name: str, page_id, url, payload: bytes, refers_to, refers: bool, segment: int) -> Iterator[bytes]:
    """All records of a page: a response and its continuations, or a revisit."""
    about = {
        "WARC-Record-ID": f"<urn:page:{name}>",
        "WARC-Target-URI": _clean(url),
        "WARC-Payload-Digest": "sha1:" + base32_sha1(payload),
        "X-Page-Id": page_id,
    }
    if refers:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        about = {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "X-Refers-To-Page": refers_to, **about}
        yield record(about, block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    about = {"WARC-Type": "response", **about}
    if len(parts) > 1:
        about["WARC-Segment-Number"] = 1
    yield record(about, parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = len(block) if k == len(parts) else None
        yield record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<urn:page:{name}/{k}>",
                "WARC-Segment-Origin-ID": about["WARC-Record-ID"],
                "WARC-Segment-Number": k,
                "WARC-Segment-Total-Length": last,
            },
            part,
        )


def _write(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page_id, url, html, refers_to, refers in zip(*(c.to_pylist() for c in batch.columns)):
                k += 1
                payload = (html or "").encode("utf-8", "surrogatepass")
                parts = list(page_records(f"{part}-{k}", page_id, url, payload, refers_to, refers, segment))
                # The text writer ends each value with the last line feed of a record's end.
                out.append(b"".join(parts)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, min_revisit: int = MIN_REVISIT) -> None:
    """Archives of ``pages (page_id, url, html)`` in the folder ``path``, one gzip stream a file.

    Of pages with equal payloads of ``min_revisit`` bytes or more, that with the largest
    page_id is stored, the others as revisits of it. A null html is an empty payload. A
    page without an id is never the stored one unless all with its payload have none; rows
    that repeat the stored page's id are stored too.
    """
    body = F.coalesce("html", F.lit(""))
    size = F.octet_length(body)
    p = pages.select("page_id", "url", "html", F.unhex(F.sha2(body, 256)).alias("_payload"), size.alias("_size"))
    many = (
        p.filter(F.col("_size") >= min_revisit)
        .groupBy("_payload")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("_first"))
        .filter("n > 1 and _first is not null")
        .select("_payload", "_first")
    )
    rows = p.join(many, "_payload", "left")
    refers = F.col("_first").isNotNull() & (F.col("_size") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("_first"))
    rows = rows.select("page_id", "url", "html", F.when(refers, F.col("_first")).alias("refers_to"), refers.alias("refers"))
    made = rows.mapInArrow(_write(segment), "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.option("compression", "gzip").option("maxRecordsPerFile", PAGES).text(path)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record of an archive, gzipped or not."""
    if archive[:2] == b"\x1f\x8b":
        out = []
        while archive:  # one stream a record or one for all
            z = zlib.decompressobj(31)
            out.append(z.decompress(archive))
            archive = z.unused_data
        archive = b"".join(out)
    at = 0
    while at < len(archive):
        head = archive.find(END, at)
        if head < 0 or not archive.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = archive[at:head].decode("utf-8", "surrogatepass").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = head + 4
        end = start + int(fields["content-length"])
        if archive[end : end + 4] != END:
            raise ValueError(f"record at byte {at} is cut off")
        yield fields, archive[start:end]
        at = end + 4


_PARSED = (
    "origin string, segment int, total long, kind string, page_id long, refers_to long, url string, digest string, block binary"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.strip().split(" ")[0] for x in _PARSED.split(",")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    number = lambda x: None if x is None else int(x)
    for batch in batches:
        for archive in batch.column(0):
            held, size = [], 0
            for f, block in records(archive.as_py()):
                kind = f.get("warc-type")
                if kind not in ("response", "revisit", "continuation"):
                    continue
                origin = f.get("warc-segment-origin-id") or f.get("warc-record-id")
                held.append(
                    (origin, int(f.get("warc-segment-number", 0)), number(f.get("warc-segment-total-length")), kind)
                    + (number(f.get("x-page-id")), number(f.get("x-refers-to-page")), f.get("warc-target-uri"))
                    + (f.get("warc-payload-digest"), block)
                )
                size += len(block)
                if size > common.CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def payload_of(block: bytes, kind: str) -> tuple[int, bytes | None]:
    """Length and bytes of the payload of an HTTP response; a revisit has the length only."""
    head, _, body = block.partition(END)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    if kind == "revisit":
        return int(fields.get("content-length", 0)), None
    if fields.get("transfer-encoding", "").lower() == "chunked":
        body = unchunked(body)
    return len(body), body


_PAYLOAD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, problem string"


def _decode(with_payload: bool):
    names = [x.strip().split(" ")[0] for x in _PAYLOAD.split(",")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def one(page_id, url, kind, refers_to, digest, numbers, total, blocks):
        bad = lambda why: (page_id, url, kind, refers_to, None, None, None, why)
        if kind is None:
            return bad("the first segment is missing")
        if numbers != [0] and numbers != list(range(1, len(numbers) + 1)):
            return bad("a segment is missing or repeated")
        block = b"".join(blocks)
        if numbers != [0] and total is None:
            return bad("the last segment is missing")
        if total is not None and total != len(block):
            return bad("the length is not the stated one")
        try:
            size, payload = payload_of(block, kind)
        except ValueError as e:
            return bad(str(e))
        stated = (digest or "").removeprefix("sha1:")
        if payload is None:
            return page_id, url, kind, refers_to, size, stated, None, None
        own = base32_sha1(payload)
        if stated and stated != own:
            return bad("the digest is not the stated one")
        return page_id, url, kind, refers_to, size, own, payload if with_payload else None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*r) for r in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row per page of the archives below ``path``: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest (bare base32), payload, problem.

    Records may be in any order and in different archives. A page whose segments are not
    all there, or whose length, digest or framing does not fit, has a ``problem`` and nulls
    instead of measures; nothing is dropped. An archive file has to fit in one row (2 GB).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = files.mapInArrow(_parse, _PARSED)
    first = F.col("kind") != "continuation"
    whole = parsed.groupBy("origin").agg(
        *(F.max(F.when(first, F.col(c))).alias(c) for c in ("page_id", "url", "kind", "refers_to", "digest")),
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    rows = whole.select(
        "page_id", "url", "kind", "refers_to", "digest",
        F.transform("parts", lambda x: x.segment).alias("numbers"),
        "total",
        F.transform("parts", lambda x: x.block).alias("blocks"),
    )
    return rows.mapInArrow(_decode(with_payload), _PAYLOAD)


def op5_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "llm-warc")
    write_archives(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return read_archives(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, max(page_id) AS first FROM p GROUP BY html)
SELECT page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(('0x' || substr(sha1(p.html), 5 * (k // 4) + 1, 5))::INT >> (15 - 5 * (k % 4)) & 31 AS INT) + 1, 1), '' ORDER BY k)
        FROM range(32) t(k)) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f ON p.html = f.html
"""
