"""WARC archives: records out, records in, and transactions assembled from them.

A capture is written as three records. Its main record is a ``response`` or, when an
earlier capture has the same payload, a ``revisit``; a ``request`` and a ``metadata``
record name the main one in WARC-Concurrent-To. Records are plain text lines to Spark's
text sink (record separator CRLF CRLF), so the archives land in whatever file system the
path names and a lost task is simply written again by the commit protocol.

Defined cases: a null payload is empty; a null url leaves the target header out; a null id
is written as ``null`` and read back as null; rows that repeat an id stay separate captures;
an empty table gives archives without records and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm.common import shared_dir, stable_rows, table

_CRLF = "\r\n"
_RFC4648 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
_DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
    "header_digest string, payload_bytes long, payload_digest string, page_id long, "
    "stated_bytes long, method string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of SHA-1: eight groups of 20 bits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), *_RFC4648)


def captures(pages: DataFrame) -> DataFrame:
    """page_id, uid, url, payload, payload_digest and first: the capture to revisit, if any.

    Only digests that occur more than once take part in the join, after a partial
    aggregation; a digest that a third of all rows share is split by the skew join.
    """
    base = stable_rows(pages.select("page_id", "url", "html")).select(
        F.col("page_id").cast("long"),
        F.monotonically_increasing_id().alias("uid"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("payload_digest", base32_sha1(F.col("payload")))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "uid")
    firsts = (
        base.groupBy("payload_digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "first")
    )
    return base.join(firsts, "payload_digest", "left")


def _record(kind: Column, ident: Column, headers: list[Column], content_type: str, body: Column) -> Column:
    head = F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: "), kind, F.lit(f"{_CRLF}WARC-Record-ID: <"), ident,
        F.lit(f">{_CRLF}WARC-Date: {_DATE}{_CRLF}"), *headers,
        F.lit(f"Content-Type: {content_type}{_CRLF}Content-Length: "), F.octet_length(body).cast("string"),
        F.lit(_CRLF * 2),
    )
    return F.concat(head, body)


def _header(name: str, value: Column, when: Column | None = None) -> Column:
    line = F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    return line if when is None else F.coalesce(F.when(when, line), F.lit(""))


def write_archives(caps: DataFrame, path: str, records_per_file: int = 6000) -> None:
    """Three records a capture, gzip-compressed files of at most records_per_file records."""
    show = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    ident = F.concat(F.lit("urn:x-capture:"), show, F.lit(":"), F.col("uid").cast("string"))
    first = F.concat(
        F.lit("urn:x-capture:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("null")),
        F.lit(":"), F.col("first.uid").cast("string"),
    )
    revisit = F.col("first").isNotNull() & (F.col("first.uid") != F.col("uid"))
    safe = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    target = _header("WARC-Target-URI", safe, F.col("url").isNotNull())
    length = F.octet_length("payload").cast("string")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        length, F.lit(_CRLF * 2), F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    main = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), ident,
        [
            target,
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            _header("WARC-Refers-To", F.concat(F.lit("<"), first, F.lit(">")), revisit),
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        ],
        "application/http; msgtype=response", http,
    )
    link = _header("WARC-Concurrent-To", F.concat(F.lit("<"), ident, F.lit(">")))
    request = _record(
        F.lit("request"), F.concat(ident, F.lit(":request")), [target, link], "application/http; msgtype=request",
        F.concat(F.lit("GET "), F.coalesce(safe, F.lit("/")), F.lit(f" HTTP/1.1{_CRLF * 2}")),
    )
    metadata = _record(
        F.lit("metadata"), F.concat(ident, F.lit(":metadata")), [target, link], "application/warc-fields",
        F.concat(F.lit("pageId: "), show, F.lit(f"{_CRLF}payloadLength: "), length, F.lit(_CRLF)),
    )
    (
        caps.select(F.explode(F.array(request, main, metadata)).alias("value"))
        .write.option("lineSep", _CRLF * 2).option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def _inflate(content: bytes) -> bytes:
    """All gzip members of a file, one after the other; plain files as they are."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        one = zlib.decompressobj(31)
        parts.append(one.decompress(content) + one.flush())
        content = one.unused_data
    return b"".join(parts)


def parse_archive(content: bytes, with_payload: bool = True) -> Iterator[tuple]:
    """Records of one archive by their Content-Length, as rows of RECORD_SCHEMA."""
    data, at = _inflate(content), 0
    while (at := data.find(b"WARC/", at)) >= 0:
        split = data.find(b"\r\n\r\n", at)
        if split < 0:
            raise ValueError("a WARC header does not end")
        lines = data[at:split].decode("utf-8", "replace").split(_CRLF)[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin = split + 4
        end = begin + int(head["content-length"])
        if end > len(data):
            raise ValueError("a WARC record is cut off")
        block, at = data[begin:end], end
        kind, field = head.get("warc-type"), {}
        payload = size = digest = page = method = stated = None
        if kind in ("response", "revisit"):
            http, _, rest = block.partition(b"\r\n\r\n")
            if kind == "response":
                payload, size = rest, len(rest)
                digest = base64.b32encode(hashlib.sha1(rest).digest()).decode()
        elif kind == "metadata":
            field = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode().split(_CRLF))}
            page = None if field.get("pageId") in (None, "null") else int(field["pageId"])
            stated = int(field["payloadLength"]) if "payloadLength" in field else None
        elif kind == "request":
            method = block.partition(b" ")[0].decode("ascii", "replace")
        bare = lambda name: head[name].strip("<>") if name in head else None
        yield (
            bare("warc-record-id"), kind, bare("warc-concurrent-to"), bare("warc-refers-to"), head.get("warc-target-uri"),
            head.get("warc-payload-digest", "").removeprefix("sha1:") or None, size, digest, page, stated, method,
            payload if with_payload else None,
        )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives below a path (any file system that Spark reads)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD_SCHEMA))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse_archive(content.as_py(), with_payload))
                for k in range(0, len(rows), 2000):
                    cols = zip(*rows[k : k + 2000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(parse, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: its main record, request and metadata, or null where missing.

    Records of a transaction meet on the identifier that WARC-Concurrent-To names, whichever
    side names the other. A request or metadata record without a main record gives no row.
    """
    key = F.coalesce("concurrent_to", "record_id")
    of = lambda cond, *cols: F.max(F.when(cond, F.struct(*cols)))
    main = F.col("type").isin("response", "revisit")
    return (
        records.groupBy(key.alias("capture_id"))
        .agg(
            of(main, "type", "record_id", "refers_to", "target_uri", "header_digest", "payload_bytes", "payload_digest", "payload").alias("main"),
            of(F.col("type") == "request", "record_id", "method", "target_uri").alias("request"),
            of(F.col("type") == "metadata", "record_id", "page_id", "stated_bytes").alias("metadata"),
        )
        .where(F.col("main").isNotNull())
    )


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written, read back and assembled; digests are those of the payloads read."""
    path = shared_dir(spark)
    write_archives(captures(table(spark, sf_dir, "pages", "page_id", "url", "html")), path)
    done = assemble(read_records(spark, path, with_payload=False))
    digest = F.coalesce("main.payload_digest", "main.header_digest")
    return done.select(
        F.col("metadata.page_id").alias("page_id"),
        F.coalesce("main.payload_bytes", "metadata.stated_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        F.regexp_extract("main.refers_to", r"^urn:x-capture:(-?\d+):", 1).try_cast("long").alias("refers_to"),
        F.col("main.target_uri").alias("url"),
        (digest == F.col("main.header_digest")).alias("digest_ok"),
        F.col("request.method").alias("method"),
    )


_HEX5 = ", ".join(f"('0x' || substr(hx, {5 * k + 1}, 5))::BIGINT" for k in range(8))
SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, url, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hx FROM p),
b AS (SELECT page_id, url, payload_bytes, list_reduce(list_transform([{_HEX5}], lambda v:
  list_reduce(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1)), lambda x, y: x || y)),
  lambda x, y: x || y) AS payload_digest FROM h),
w AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, url, true AS digest_ok, 'GET' AS method
FROM w
"""
