"""Operator 9, WARC: archives of pages, and reading them with segment reassembly.

Writing makes response records (HTTP with chunked transfer framing), revisit records for pages
whose payload another page has, and continuation records where a record is longer than a
segment. Reading groups continuation records by the record they continue, orders them by
segment number, verifies the total length, and decodes the chunked framing.

Records go through Spark's text sink, whose line separator is the empty lines that end a
WARC record, so a lost task leaves nothing behind. With compression a file is one gzip stream.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_path, staged

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
#: Equal payloads are stored once from this size on.
REVISIT_BYTES = 100
#: Archives have about so many bytes before compression.
FILE_BYTES = 64 << 20
#: So many payloads that pages share are broadcast, more are joined by a shuffle.
BROADCAST_ROWS = 500_000
DATE = "1970-01-01T00:00:00Z"

_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*fields: tuple[str, Column]) -> Column:
    """WARC header lines; a field whose value is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit("")) for name, value in fields])


def _joined(parts: Column) -> Column:
    """The bytes of an array of binaries, one after the other."""
    return F.array_join(F.transform(parts, lambda x: x.cast("string")), "").cast("binary")


def _cut(name: str, size: int) -> Column:
    """The bytes of column ``name`` as an array of pieces of ``size``; empty for no bytes."""
    last = F.expr(f"(octet_length({name}) - 1) div {size}").cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col(name), i * size + 1, F.lit(size)))
    return F.when(F.octet_length(name) > 0, pieces).otherwise(F.array().cast("array<binary>"))


def records(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``record``: the WARC records of ``pages`` (page_id, url, html), without the empty lines at their end.

    Of pages with equal payloads of at least REVISIT_BYTES, the one with the smallest page_id is
    a response, and the others are revisits of it; pages with that page_id are all responses. A
    null html is an empty payload. A null page_id comes after all others; if all pages
    with a payload have none, they are all responses. Other columns are not read.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", r"[\r\n]", "").alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "id", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(":"), F.hex(F.xxhash64("url", "digest")))
    )
    shared = (
        rows.where((F.octet_length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("page_id", "id")).alias("first"))
    )
    counts = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(shared.join(counts, "digest").select("digest", "first"), "shared-payloads")
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    rows = rows.join(shared, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first.page_id")), F.col("first.id"))
    )
    chunk = F.transform(
        _cut("payload", chunk_bytes),
        lambda x: F.concat(F.hex(F.octet_length(x)).cast("binary"), F.lit("\r\n").cast("binary"), x, F.lit("\r\n").cast("binary")),
    )
    response = F.concat(F.lit(_HTTP + "Transfer-Encoding: chunked" + _END).cast("binary"), _joined(chunk), F.lit("0" + _END).cast("binary"))
    is_revisit = F.col("refers_to").isNotNull()
    rows = rows.withColumn("block", F.when(is_revisit, F.lit(_HTTP + "\r\n").cast("binary")).otherwise(response))
    rows = rows.select(
        "id", "url", "digest", "refers_to", F.octet_length("block").alias("total"), F.posexplode(_cut("block", segment_bytes)).alias("k", "part")
    )
    parts = F.expr(f"(total - 1) div {segment_bytes} + 1")
    segmented, begins = parts > 1, F.col("k") == 0
    named = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    header = _lines(
        ("WARC-Type", F.when(~begins, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")),
        ("WARC-Record-ID", named(F.when(begins, F.col("id")).otherwise(F.concat("id", F.lit(":"), F.col("k") + 1)))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Refers-To", F.when(begins, named(F.col("refers_to")))),
        ("WARC-Profile", F.when(F.col("refers_to").isNotNull(), _PROFILE)),
        ("WARC-Payload-Digest", F.when(begins, F.concat(F.lit("sha256:"), "digest"))),
        ("WARC-Segment-Number", F.when(segmented, F.col("k") + 1)),
        ("WARC-Segment-Origin-ID", F.when(~begins, named(F.col("id")))),
        ("WARC-Segment-Total-Length", F.when(segmented & (F.col("k") + 1 == parts), F.col("total"))),
        ("Content-Type", F.when(begins, "application/http; msgtype=response")),
        ("Content-Length", F.octet_length("part")),
    )
    return rows.select(F.concat(F.lit("WARC/1.1\r\n"), header, F.lit("\r\n"), F.col("part").cast("string")).alias("record"))


def write(pages: DataFrame, path: str | None = None, compression: str = "gzip", **sizes) -> str:
    """Write the archives of ``pages``; returns the folder. No shuffle: a task writes what it reads."""
    size, n = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 600), F.count(F.lit(1))).first()
    most = max(1, FILE_BYTES * n // size) if n else 1
    path = path or stage_path(pages.sparkSession, "warc")
    writer = records(pages, **sizes).write.option("lineSep", _END).option("compression", compression)
    writer.option("maxRecordsPerFile", most).text(path)
    return path


_FIELDS = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")
_RECORD = "type string, id string, url string, refers_to string, digest string, number long, origin string, total long, block binary, defect string"


def parse(content: bytes) -> Iterator[dict]:
    """The records of an archive. At a defect, a last row says what it is: nothing behind it can be read."""
    file = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    try:
        while line := file.readline():
            if not line.startswith(b"WARC/"):
                raise ValueError("no WARC version line")
            fields = {}
            while (line := file.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            length = int(fields["content-length"])
            block = file.read(length)
            if len(block) < length or file.read(4) != b"\r\n\r\n":
                raise ValueError("record is cut off")
            kind, *others = (fields.get(name, "").strip("<>") or None for name in _FIELDS)
            numbers = [int(v) if (v := fields.get(f"warc-segment-{k}")) else None for k in ("number", "total-length")]
            origin = fields.get("warc-segment-origin-id", "").strip("<>") or None
            yield dict(zip(("type", "id", "url", "refers_to", "digest"), (kind, *others), strict=True)) | {
                "number": numbers[0], "origin": origin, "total": numbers[1], "block": block, "defect": None,
            }
    except (ValueError, KeyError, OSError, EOFError) as e:
        yield dict.fromkeys(("type", "id", "url", "refers_to", "digest", "number", "origin", "total", "block")) | {"defect": str(e) or "cut off"}


def unchunked(body: bytes) -> bytes:
    """What chunked transfer framing holds; ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP header")
    names = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")]
    return unchunked(body) if b"transfer-encoding:chunked" in names else body


def reassembled(parts: DataFrame) -> DataFrame:
    """Whole records from their segments: continuation records grouped by the id of the record they continue."""
    first = F.when(F.col("number") == 1, F.struct("type", "url", "refers_to", "digest"))
    whole = (
        parts.groupBy(F.coalesce("origin", "id").alias("id"))
        .agg(
            F.max(first).alias("first"),
            F.count_if(F.col("number") == 1).alias("copies"),  # of a repeated row, whose segments are all equal
            F.max("total").alias("total"),
            F.array_sort(F.collect_set(F.struct("number", "block"))).alias("parts"),
        )
        .withColumn("block", _joined(F.col("parts.block")))
        .withColumn("numbers", F.col("parts.number"))
    )
    last = F.size("numbers").cast("long")
    complete = F.col("first").isNotNull() & F.col("total").isNotNull() & (F.col("numbers") == F.sequence(F.lit(1).cast("long"), last))
    defect = F.when(~complete, "segments are missing").when(F.octet_length("block") != F.col("total"), "total length differs")
    copies = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("copies").cast("int"))))
    return whole.select("first.*", "id", "block", defect.alias("defect"), copies.alias("copy")).drop("copy")


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Response and revisit records of the archives below ``path``.

    Returns id, type, url, refers_to (id of the record that a revisit repeats), digest (as the
    header gives it), payload_bytes, payload_digest (hex SHA-256 of the payload as read; both
    null for a revisit), payload (if ``payloads``) and defect: what is wrong with the record
    or, without an id, with its archive. A record whose digest differs has a defect.
    """

    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[t]) for n, t in (f.split() for f in _RECORD.split(", "))]
        )
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for row in parse(content.as_py()):
                    rows.append(row)
                    size += len(row["block"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = files.mapInArrow(parsed, _RECORD)
    wanted = ["type", "id", "url", "refers_to", "digest", "block", "defect"]
    records = found.where("number is null").select(*wanted).unionByName(reassembled(found.where("number is not null")).select(*wanted))

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, defects = [], batch.column("defect").to_pylist()
            for i, (kind, block, digest) in enumerate(
                zip(batch.column("type").to_pylist(), batch.column("block"), batch.column("digest").to_pylist(), strict=True)
            ):
                payload = None
                if kind == "response" and not defects[i]:
                    try:
                        payload = http_payload(block.as_py())
                    except ValueError as e:
                        defects[i] = str(e)
                held.append(payload)
                if payload is not None and digest and digest != "sha256:" + hashlib.sha256(payload).hexdigest():
                    defects[i] = "payload digest differs"
            columns = {n: batch.column(n) for n in ("type", "id", "url", "refers_to", "digest")}
            columns |= {
                "payload_bytes": pa.array([None if p is None else len(p) for p in held], pa.int64()),
                "payload_digest": pa.array([None if p is None else hashlib.sha256(p).hexdigest() for p in held], pa.string()),
                "payload": pa.array(held if payloads else [None] * len(held), pa.binary()),
                "defect": pa.array(defects, pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    result = records.mapInArrow(
        decoded,
        "type string, id string, url string, refers_to string, digest string, payload_bytes long, payload_digest string, payload binary, defect string",
    )
    return result if payloads else result.drop("payload")


def page_id(record_id: Column) -> Column:
    """The page_id in an id of :func:`records`; null for a page without one."""
    part = F.split_part(record_id, F.lit(":"), F.lit(3))
    return F.when(part != "none", part.cast("long"))
