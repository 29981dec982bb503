"""WARC: archives of pages, one gzip member per record, written and read back sequentially.

Writing: equal payloads (SHA-1 and length) are found by a group-by that combines on the map side; of each group the page
of the largest id is a response record and the others revisit it. Every task writes files of its own, named at
random, and returns a manifest row per file; the manifest is written by Spark, so files of lost or repeated attempts
are in no manifest and are never read.

Reading: a file is a stream. Each gzip member is inflated piece by piece, the record's header is parsed, its
content length must match what the member holds, and the digests of block and payload are verified; a record that
breaks a rule raises. A task holds one record and the rows of its current batch.

Defined results: a null html is an empty payload; a null url leaves the target header out. Control characters and spaces
in urls are percent-encoded in the header and decoded when read. Rows with a null page_id have a record id without a
number, and count as the smallest; rows that repeat page and payload are all of the same type. Extra columns are not
archived; an empty table gives no records. The folder lies in the store in which Spark resolves it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.shared import ship, written
from cartwise.session import new_folder
from cartwise.sources.tables import hadoop_path

FILE_BYTES = 128_000_000
CHUNK = 1 << 18
BATCH_BYTES = 8_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
    "payload binary"
)
_PAGE = re.compile(r"<urn:page:(-?\d*)>")


def digest_of(data: bytes) -> str:
    """SHA-1 in upper-case base 32, without a prefix."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_url(url: str) -> str:
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _page(number: int | None) -> str:
    return f"<urn:page:{'' if number is None else number}>"


def make_record(page_id, url, payload: bytes, record_type: str, refers_to) -> bytes:
    """One record as a gzip member. A revisit has the response's HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if record_type == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_page(page_id)}", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_header_url(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"WARC-Block-Digest: sha1:{digest_of(block)}",
        *([f"WARC-Refers-To: {_page(refers_to)}", f"WARC-Profile: {PROFILE}"] if record_type == "revisit" else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + press.flush()


def _headers(data: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = data.decode().split("\r\n")
    return first, {k.lower(): v.strip(" \t") for k, v in (line.split(":", 1) for line in lines)}


def parse_record(data: bytes) -> dict:
    """Fields of an inflated record; raises ValueError if framing or a digest is wrong."""
    end = data.find(b"\r\n\r\n")
    version, head = _headers(data[:end]) if end >= 0 else ("", {})
    if not version.startswith("WARC/"):
        raise ValueError("no WARC header")
    size = int(head["content-length"])
    block = data[end + 4:end + 4 + size]
    if len(block) != size or data[end + 4 + size:] != b"\r\n\r\n":
        raise ValueError("the content length does not match the record")
    if head["warc-block-digest"] != f"sha1:{digest_of(block)}":
        raise ValueError("the block digest is wrong")
    at = block.index(b"\r\n\r\n")
    payload = block[at + 4:]
    length = int(_headers(block[:at])[1]["content-length"])
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    response = head["warc-type"] == "response"
    if response and (digest != digest_of(payload) or length != len(payload)):
        raise ValueError("the payload digest or length is wrong")

    def page(name: str) -> int | None:
        number = _PAGE.fullmatch(head.get(name, "<urn:page:>"))[1]
        return int(number) if number else None

    url = head.get("warc-target-uri")
    return {
        "page_id": page("warc-record-id"), "url": None if url is None else unquote_to_bytes(url).decode(),
        "record_type": head["warc-type"], "refers_to": page("warc-refers-to"), "payload_bytes": length,
        "payload_digest": digest, "payload": payload if response else None,
    }


def read_stream(stream) -> Iterator[dict]:
    """Records of a WARC file, one gzip member after the other."""
    inflate, parts, data = zlib.decompressobj(31), [], stream.read(CHUNK)
    begun = False
    while data:
        begun = True
        parts.append(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            yield parse_record(b"".join(parts))
            inflate, parts, begun = zlib.decompressobj(31), [], False
        if not data:
            data = stream.read(CHUNK)
    if begun:
        raise ValueError("the file ends inside a record")


def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url and payload of ``pages`` (page_id, url, html) with record_type and refers_to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = rows.where(F.col("size") >= min_bytes).groupBy("sha", "size").agg(
        F.count("*").alias("n"), F.max("page_id").alias("last")
    ).where("n > 1")
    revisit = F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.join(groups, ["sha", "size"], "left").select(
        "page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )


def _writer(folder: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, size, files = None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, size, n = store.open_output_stream(name, compression=None), 0, 0
                member = make_record(**row)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= FILE_BYTES:
                    out.close()
                    files.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, n, size))
        columns = list(zip(*files)) or [(), (), ()]
        yield pa.RecordBatch.from_pydict({
            "path": pa.array(columns[0], pa.string()), "records": pa.array(columns[1], pa.int64()),
            "bytes": pa.array(columns[2], pa.int64()),
        })

    return write


def store_uri(spark: SparkSession, folder: str) -> str:
    """``folder`` as Spark resolves it, in the spelling of pyarrow, so that driver and executors mean the same store.

    A path without a scheme lies in the cluster's default store, not on an executor's disk. A store that pyarrow does not know
    is an error here and not in a task.
    """
    path, store = hadoop_path(spark, folder)
    uri = path.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()
    scheme, rest = uri.split(":", 1)
    uri = f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme)}:{rest if rest.startswith('//') else '//' + rest}"
    fs.FileSystem.from_uri(uri)
    return uri


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder`` (any store that pyarrow knows); the manifest of the files."""
    ship(pages.sparkSession)
    folder = store_uri(pages.sparkSession, folder)
    rows = classify(pages, min_bytes).select("page_id", "url", "payload", "record_type", "refers_to")
    return written(rows.mapInArrow(_writer(folder), "path string, records bigint, bytes bigint"), "warc_manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of the files of a manifest; ``payload=False`` verifies the payloads without returning them."""

    def flush(rows: list[dict]) -> pa.RecordBatch:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
        ])
        return pa.RecordBatch.from_pylist(rows, schema)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows, size, n = [], 0, 0
                with store.open_input_stream(path, compression=None) as stream:
                    for record in read_stream(stream):
                        n += 1
                        size += 200 + (len(record["payload"] or b"") if payload else 0)
                        rows.append(record if payload else record | {"payload": None})
                        if size >= BATCH_BYTES:
                            yield flush(rows)
                            rows, size = [], 0
                if n != expected:
                    raise ValueError(f"{path} has {n} records instead of {expected}")
                yield flush(rows)

    ship(spark)
    folder = store_uri(spark, folder)
    # A task for every few files: without a number the few manifest rows would end up in one task.
    return manifest.select("path", "records").repartition(max(1, min(manifest.count(), 20_000))).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, payload: bool = True) -> DataFrame:
    """Archive ``pages`` below ``folder`` (default: a new one in the shared folder) and read the records back."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    return read_archives(spark, write_archives(pages, folder, min_bytes), folder, payload)
