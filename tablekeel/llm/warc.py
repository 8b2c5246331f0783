"""WARC archives: writing captures, and assembling them again from their records.

A capture is three records. The request and the metadata name the response, or the
revisit that stands for it, in WARC-Concurrent-To; a revisit names the response with the
same payload in WARC-Refers-To. Spark's own text writer puts the records into files, with
the blank lines that end a record as its line separator, so that files appear only when
their task has succeeded. The reader parses each file as a stream, and the transaction
assembly joins records on the identifier that they share.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.llm.common import cut, pick, shared_folder, small

END = "\r\n\r\n"
#: Payloads from this size on are written once and revisited.
REVISIT_BYTES = 1000
#: Bytes of records in a file, on average; the reader streams a file, whose compressed form is one row.
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _id(kind: str, *parts: Column) -> Column:
    """A record's name: a urn:uuid made from what identifies it, the same on each attempt."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str, name: Column, uri: Column, block: Column, content: str, *more: Column) -> Column:
    """A record up to, and without, the blank lines at its end."""
    head = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "),
        name,
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        uri,
        *more,
        F.lit(f"\r\nContent-Type: {content}\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    return F.concat(head, block)


def with_originals(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) with payload_bytes, payload_digest and original.

    original has the largest page_id, and its url, among payloads with the same digest, for
    payloads of at least least_bytes that occur more than once; it is null on the rows of that id.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"))
    rows = rows.withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
    groups = groups.agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("original")).where("n > 1")
    rows = rows.join(small(groups.select("payload_digest", "original")), "payload_digest", "left")
    original = F.when(~F.col("page_id").eqNullSafe(F.col("original.page_id")), F.col("original"))
    return rows.withColumn("original", original)


def capture_records(pages: DataFrame) -> DataFrame:
    """The records, as text, of rows that with_originals has made; one row per record."""
    # A header is one line: what cannot stand in a URI is written as a percent code.
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F<>]", "%20")
    key = [F.col("page_id"), F.col("url"), F.col("payload_digest")]
    name = _id("capture", *key)
    concurrent = F.concat(F.lit("\r\nWARC-Concurrent-To: "), name)
    digest = F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    content = "application/http; msgtype=response"
    response = _record("response", name, uri, F.concat(http, F.col("html")), content, digest)
    original = _id("capture", F.col("original.page_id"), F.col("original.url"), F.col("payload_digest"))
    refers = F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), original)
    revisit = _record("revisit", name, uri, http, content, digest, refers)
    fetched = F.concat(F.lit("GET "), F.when(uri == "", F.lit("/")).otherwise(uri), F.lit(f" HTTP/1.1{END}"))
    request = _record("request", _id("request", *key), uri, fetched, "application/http; msgtype=request", concurrent)
    fields = F.concat(
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n"))),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(F.concat(F.lit("page-url: "), F.hex(F.col("url").cast("binary")), F.lit("\r\n"))),
    )
    metadata = _record("metadata", _id("metadata", *key), uri, fields, "application/warc-fields", concurrent)
    main = F.when(F.col("original").isNull(), response).otherwise(revisit)
    return pages.select(F.explode(F.array(request, main, metadata)).alias("value"))


def write_warc(
    pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = REVISIT_BYTES
) -> None:
    """Write gzipped WARC files with a request, a response or revisit, and a metadata record per row.

    A null html is an empty payload, and null ids and urls are left out of the metadata.
    Rows that agree in all three columns become records of the same names, and are that
    many captures again when read.
    """
    rows = with_originals(pick(pages, page_id=page_id, url=url, html=html), least_bytes)
    total = rows.agg(F.sum("payload_bytes").alias("bytes"), F.count("*").alias("n")).first()
    size = (total.bytes or 0) / max(1, total.n) + 1200
    options = {"lineSep": END, "compression": "gzip", "maxRecordsPerFile": max(1, int(3 * FILE_BYTES / size))}
    capture_records(rows).write.mode("errorifexists").options(**options).text(path)


FIELDS = (
    "type string, record_id string, concurrent_to string, refers_to string, uri string, date string, digest string, "
    "payload_bytes long, payload_digest string, page_id long, url string, payload binary"
)


def _stream(data: bytes) -> Iterator[memoryview]:
    """The content of a file, unpacked piece by piece; gzip members may follow one another."""
    if data[:2] != b"\x1f\x8b":
        yield memoryview(data)
        return
    unpack = zlib.decompressobj(31)
    for at in range(0, len(data), 1 << 18):
        chunk = data[at : at + (1 << 18)]
        while chunk:
            if unpack.eof:
                unpack = zlib.decompressobj(31)
            piece = unpack.decompress(chunk)
            chunk = unpack.unused_data
            if piece:
                yield memoryview(piece)
    if not unpack.eof:
        raise ValueError("a gzipped WARC file is cut off")


class Records:
    """Parses records from a stream of bytes that holds one record at a time."""

    def __init__(self, data: bytes) -> None:
        self.pieces = _stream(data)
        self.held = bytearray()
        self.at = 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        if self.at:
            del self.held[: self.at]
            self.at = 0
        self.held += piece
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            while (end := self.held.find(b"\r\n\r\n", self.at)) < 0:
                if not self._more():
                    if self.held[self.at :].strip():
                        raise ValueError("a WARC file ends within a header")
                    return
            lines = self.held[self.at : end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
            head = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            length = int(head["content-length"])
            self.at = end + 4
            while len(self.held) - self.at < length + 4:
                if not self._more():
                    raise ValueError("a WARC file ends within a record")
            yield head, bytes(self.held[self.at : self.at + length])
            self.at += length + 4


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the WARC files in a folder (plain, or gzipped as a whole or by record).

    payload_bytes and payload_digest are of the whole payload: computed from a response,
    which must agree with its own headers, and as its headers say for a revisit. The body
    of a response is in payload if that is asked for. Empty files have no records.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for head, block in Records(content.as_buffer().to_pybytes()):
                    rows.append(_row(head, block, payload))
                    size += 400 + (len(block) if payload else 0)
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(parse, FIELDS)


def _row(head: dict[str, str], block: bytes, payload: bool) -> tuple:
    kind = head.get("warc-type")
    digest = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    count = own = page = url = body = None
    if kind in ("response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        said = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        count, own = (int(said[0]) if said else None), digest
        if kind == "response":
            own = hashlib.sha1(body).hexdigest()
            if (digest and own != digest) or (count is not None and count != len(body)):
                raise ValueError(f"the payload of {head.get('warc-record-id')} is damaged")
            count = len(body)
    elif kind == "metadata":
        fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if x)
        page = int(fields["page-id"]) if "page-id" in fields else None
        url = bytes.fromhex(fields["page-url"]).decode() if "page-url" in fields else None
    names = ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date")
    return (kind, *[head.get(n) for n in names], digest, count, own, page, url, body if payload and kind == "response" else None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, page_id, url, request, response and metadata.

    An outer join of the three kinds of records on the identifier they share, the response's
    own name and the others' WARC-Concurrent-To, done as one grouping, so that each record
    is shuffled once. A capture that lacks a record has null there. If several records have
    the same names, as those of repeated rows do, there is a row for each response.
    """
    capture = F.coalesce("concurrent_to", "record_id")
    part = lambda kinds, *names: F.max(F.when(F.col("type").isin(*kinds), F.struct(*names)))
    grouped = records.where(F.col("type").isin("request", "response", "revisit", "metadata")).groupBy(capture.alias("capture_id"))
    out = grouped.agg(
        F.sum(F.when(F.col("type").isin("response", "revisit"), 1).otherwise(0)).alias("times"),
        part(["request"], "record_id", "uri", "date").alias("request"),
        part(["response", "revisit"], "type", "record_id", "uri", "date", "refers_to", "payload_bytes", "payload_digest", "payload").alias("response"),
        part(["metadata"], "record_id", "page_id", "url").alias("metadata"),
    )
    out = out.withColumn("time", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("times")))))
    return out.select("capture_id", "metadata.page_id", "metadata.url", "request", "response", "metadata")


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write the pages into a new folder of the shared one, read them back, and describe each capture."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    captures = assemble(read_warc(spark, path, payload=False)).select(
        "capture_id", "page_id", "response.type", "response.payload_bytes", "response.payload_digest", "response.refers_to"
    )
    captures = cut(captures)
    originals = captures.where("type = 'response'").select(F.col("capture_id").alias("refers_to"), F.col("page_id").alias("original"))
    wanted = captures.where("refers_to IS NOT NULL").select("refers_to").distinct()
    originals = originals.join(wanted, "refers_to", "left_semi").dropDuplicates(["refers_to"])
    out = captures.join(small(originals), "refers_to", "left")
    return out.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("original").alias("refers_to"))


def oracle(least_bytes: int = REVISIT_BYTES) -> str:
    """What the round trip gives, as DuckDB SQL over pages."""
    return f"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= {least_bytes} AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= {least_bytes} AND page_id < top THEN top END AS refers_to
        FROM m"""
