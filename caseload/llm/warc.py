"""A content-addressed WARC archive.

Two tables make an archive.  ``payloads`` stores the bytes of every distinct
payload once, under its SHA-256; ``records`` stores the exact header bytes of
every record and that digest.  Original records are rebuilt by joining the two
on the digest, and a payload is checked against its digest when it is read.

Records with equal payloads (of at least ``min_bytes``) are revisits of the
one with the smallest page_id, the response.  Digests are computed where the
pages are read, so only (digest, id) pairs meet in the search for the smallest
id, and a payload that a third of the pages share is one row per task, there
and where its bytes move to be stored once.

Edge cases: a null html is an empty payload, a null url an empty target; rows
that repeat both page_id and payload are all of the same kind; rows with a
null page_id never are the smallest, and without another one are responses;
an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.llm.common import written

MIN_BYTES = 0
#: Payloads are stored compressed one by one, so they also move compressed.
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
_ID = "urn:x-page:"
_CRLF = b"\r\n"


def digested(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, n, sha256, sha1): the payload and its digests."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        payload.alias("payload")).withColumns({
                            "n": F.octet_length("payload").cast("long"),
                            "sha256": F.sha2("payload", 256), "sha1": F.sha1("payload")})


def _header(kind: str, page_id, url: str, sha1: str, n: int, refers_to) -> bytes:
    """The exact header block of a record; its block holds the payload, or nothing for a revisit."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{page_id}>",
             "WARC-Target-URI: " + " ".join(url.split()), f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{_ID}{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if kind == 'revisit' else n}"]
    return "\r\n".join(lines).encode() + _CRLF + _CRLF


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, n, sha256, sha1, first): the narrow rows; ``first`` is
    the smallest page_id with the payload (null if all of them are null)."""
    narrow = written(digested(pages).select("page_id", "url", "n", "sha256", "sha1"), "warc-digests")
    first = narrow.groupBy("sha256").agg(F.min("page_id").alias("first"))
    return narrow.join(first, "sha256")


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write the two tables of the archive of ``pages`` below ``path``."""
    planned = plan_records(pages)

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for page_id, url, n, sha1, first in zip(*(rows[k] for k in ("page_id", "url", "n", "sha1", "first"))):
                kind = "response" if page_id == first or n < min_bytes else "revisit"
                out.append(_header(kind, page_id, url, sha1, n, first))
            yield pa.RecordBatch.from_arrays([batch.column("sha256"), pa.array(out, pa.binary())], ["sha256", "header"])

    planned.select("sha256", "page_id", "url", "n", "sha1", "first").mapInArrow(
        headers, "sha256 string, header binary").write.parquet(f"{path}/records")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            small = [coder.compress(memoryview(p.as_buffer())) for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], ["sha256", "payload"])

    digested(pages).select("sha256", "payload").mapInArrow(compress, "sha256 string, payload binary").dropDuplicates(
        ["sha256"]).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of every record, the payload being the full one also
    for revisits.  A stored payload that differs from its digest is an error."""
    stored = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    headers = spark.read.schema("sha256 string, header binary").parquet(f"{path}/records")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                full = [coder.decompress(memoryview(p.as_buffer())) for p in part.column(2)]
                for digest, payload in zip(part.column(0).to_pylist(), full):
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged payload {digest}")
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(full, pa.binary())], ["header", "payload"])

    return headers.join(stored, "sha256").select("sha256", "header", "payload").mapInArrow(
        unpack, "header binary, payload binary")


def records(archive: DataFrame) -> DataFrame:
    """The original records, byte for byte: header block, block, two line ends."""
    return archive.select(F.concat(
        F.col("header"), F.when(_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload")),
        F.lit(_CRLF + _CRLF)).alias("record"))


def _field(name: str):
    return F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def parsed(archive: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per record from its header block and payload: page_id,
    payload_bytes, payload_digest, record_type, refers_to.  A payload whose
    SHA-1 is not that of the header is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for header, payload in zip(batch.column(0), batch.column(1)):
                fields = dict(x.split(": ", 1) for x in header.as_py().decode().split("\r\n")[1:] if x)
                data = payload.as_buffer()
                digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
                if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
                    raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                bare = lambda v: v[1:-1].removeprefix(_ID) if v else None
                out.append((bare(fields["WARC-Record-ID"]), data.size, digest, fields["WARC-Type"],
                            bare(fields.get("WARC-Refers-To"))))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k == 1 else pa.string()) for k, c in enumerate(columns)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    text = archive.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, "
                                   "refers_to string")
    return text.withColumns({c: F.when(F.col(c) != "None", F.col(c)).cast(id_type) for c in ("page_id", "refers_to")})
