"""WARC archives: written from rows, read back as a table of chunks.

A payload travels as rows of a record identifier and a chunk number, at most `chunk_bytes` each; neither the writer
nor the reader holds a whole record, and the digest is carried from chunk to chunk. The first record of a payload
(smallest identifier) is a `response`, later ones `revisit` it and hold only their HTTP head, which still states the
full length. Each task writes files of its own name into the shared folder and returns their list; the list is
written as a table, so files of lost or repeated tasks are never read.

Null payloads are empty payloads. Rows with the smallest identifier are responses even when it repeats; a null
identifier never is the smallest, is written as a lone percent sign, which no percent-encoded identifier is, and read
back as null. A null or blank url is written as `about:blank`, control
characters and spaces in it are percent-encoded. Extra columns are ignored. An empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import sys
import uuid
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyarrow import fs
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloop.operators.skew import lookup_join
from tabloop.storage import scratch_path, settle

register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

CHUNK_BYTES = 256 * 1024
FILE_BYTES = 256 * 1024 * 1024  # a file is closed beyond this size
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMELESS = "%"  # in place of a null identifier; no encoded identifier is a lone percent sign
SLICE_ROWS = 64  # rows turned into Python values at a time
HEAD_BYTES = 1024 * 1024  # longest head of a record that the reader takes

FILES = "path string, records bigint, bytes bigint"
CHUNKS = (
    "path string, record_offset bigint, record_id string, record_type string, refers_to string, target_uri string, "
    "chunk_no bigint, data binary, digest_so_far string, is_last boolean, payload_bytes bigint, payload_digest string, "
    "intact boolean"
)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def with_revisits(pages: DataFrame, record_id: str, payload: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows with `sha1` and `refers_to`, the smallest identifier of an equal payload where that is another row's.

    Payloads are equal when their length and SHA-1 are. Copies are counted before the shuffle, and only groups of
    two or more rows take part in the join.
    """
    rows = pages.withColumn("sha1", F.sha1(F.col(payload)))
    slim = pages.select(F.col(record_id), F.sha1(F.col(payload)).alias("sha1"), F.length(payload).alias("_bytes"))
    groups = settle(
        slim.where(F.col("_bytes") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min(record_id).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _first is not null")
        .drop("_n"),
        "payloads",
    )
    later = F.col(record_id).isNull() | (F.col(record_id) > F.col("_first"))
    return lookup_join(rows, groups, ["sha1"]).withColumn("refers_to", F.when(later, F.col("_first"))).drop("_first")


def write(
    pages: DataFrame,
    record_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    folder: str | None = None,
    chunk_bytes: int = CHUNK_BYTES,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Writes a record per row below `folder` and returns the table of its files."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    slim = pages.select(
        F.col(record_id).alias("record_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = with_revisits(slim, "record_id", "payload", min_revisit_bytes)
    size = F.length("payload")
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    last = F.when(F.col("refers_to").isNull(), F.greatest(F.ceil(size / chunk_bytes) - 1, F.lit(0))).otherwise(F.lit(0))
    chunks = rows.select(
        F.coalesce(F.url_encode(F.col("record_id").cast("string")), F.lit(NAMELESS)).alias("record_id"),
        F.url_encode(F.col("refers_to").cast("string")).alias("refers_to"),
        "url",
        "sha1",
        size.cast("bigint").alias("payload_bytes"),
        body.alias("body"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("chunk_no"),
    ).select(
        "record_id", "refers_to", "url", "sha1", "payload_bytes", "chunk_no",
        F.expr(f"substring(body, cast(chunk_no * {chunk_bytes} + 1 as int), {chunk_bytes})").alias("data"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int, int]] = []
        out = path = None
        records, ready = 0, True  # ready: the last record is whole
        system, root = opened(folder)
        for batch in batches:
            for row in (r for at in range(0, batch.num_rows, SLICE_ROWS) for r in batch.slice(at, SLICE_ROWS).to_pylist()):
                if row["chunk_no"] == 0:
                    if out is not None and out.tell() > FILE_BYTES:
                        out.close()
                        done.append((path, records, size_of(system, path)))
                        out = None
                    if out is None:
                        system.create_dir(root, recursive=True)
                        path, records = f"{root}/{uuid.uuid4().hex}.warc", 0
                        out = system.open_output_stream(path)
                    records += 1
                    out.write(head(row))
                out.write(row["data"])
                sent = row["chunk_no"] * chunk_bytes + len(row["data"])
                ready = row["refers_to"] is not None or sent == row["payload_bytes"]
                if ready:
                    out.write(b"\r\n\r\n")
        if out is not None:
            out.close()
            done.append((path, records, size_of(system, path)))
        columns = list(zip(*done)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "records", "bytes"]
        )

    def size_of(system: fs.FileSystem, path: str) -> int:
        return system.get_file_info(path).size

    def head(row: dict) -> bytes:
        uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["url"] or "") or "about:blank"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
        revisit = row["refers_to"] is not None
        block = len(http) + (0 if revisit else row["payload_bytes"])
        lines = [
            "WARC/1.1",
            f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:record:{row['record_id']}>",
            f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(row['sha1']))}",
            "Content-Type: application/http; msgtype=response",
            f"Content-Length: {block}",
        ]
        if revisit:
            lines[5:5] = [f"WARC-Refers-To: <urn:record:{row['refers_to']}>", f"WARC-Profile: {PROFILE}"]
        return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()

    return settle(chunks.mapInArrow(run, FILES), "archives")


def read(files: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Table of chunks of the archives in `files` (paths as `write` lists them); one task reads one file.

    The last chunk of a record carries `payload_bytes`, `payload_digest` (of the bytes read, for a revisit as
    stated) and whether that equals the stated digest. An empty payload has one chunk without bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in records(system, path):
                    rows.append(row)
                    held += len(row["data"]) + 1024
                    if held >= 8 * 1024 * 1024:
                        yield pa.RecordBatch.from_pylist(rows, kinds())
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, kinds())

    def kinds() -> pa.Schema:
        text, number, flag = pa.string(), pa.int64(), pa.bool_()
        return pa.schema(
            [("path", text), ("record_offset", number), ("record_id", text), ("record_type", text), ("refers_to", text),
             ("target_uri", text), ("chunk_no", number), ("data", pa.binary()), ("digest_so_far", text),
             ("is_last", flag), ("payload_bytes", number), ("payload_digest", text), ("intact", flag)]
        )

    def lines_of(source) -> tuple[str, dict[str, str]]:
        """First line and fields of a head, up to its empty line."""
        first, fields, taken = None, {}, 0
        while True:
            line = source.readline(HEAD_BYTES)
            taken += len(line)
            if not line.endswith(b"\n") or taken > HEAD_BYTES:
                raise ValueError("a record's head is cut off or too long")
            line = line.rstrip(b"\r\n").decode("utf-8", "replace")
            if not line:
                return first or "", fields
            if first is None:
                first = line
            else:
                name, _, value = line.partition(":")
                fields[name.strip().lower()] = value.strip()

    def records(system: fs.FileSystem, path: str) -> Iterator[dict]:
        with io.BufferedReader(system.open_input_file(path), chunk_bytes) as source:
            while True:
                offset = source.tell()
                if not source.peek(1):
                    return
                version, fields = lines_of(source)
                if not version.startswith("WARC/"):
                    raise ValueError(f"no record at byte {offset} of {path}")
                begun = source.tell()
                _, http = lines_of(source)
                left = int(fields["content-length"]) - (source.tell() - begun)
                kind, stated = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
                row = {
                    "path": path, "record_offset": offset, "record_type": kind,
                    "record_id": urn(fields["warc-record-id"]), "refers_to": urn(fields.get("warc-refers-to")),
                    "target_uri": fields.get("warc-target-uri"),
                }
                sha1, sent, number = hashlib.sha1(), 0, 0
                while True:
                    data = source.read(min(chunk_bytes, left))
                    if left and not data:
                        raise ValueError(f"{path} ends inside a record")
                    left -= len(data)
                    sent += len(data)
                    sha1.update(data)
                    last = left == 0
                    found = stated if kind == "revisit" else base32(sha1.digest())
                    total = int(http["content-length"]) if kind == "revisit" else sent
                    yield row | {
                        "chunk_no": number, "data": data, "digest_so_far": base32(sha1.digest()), "is_last": last,
                        "payload_bytes": total if last else None, "payload_digest": found if last else None,
                        "intact": found == stated if last else None,
                    }
                    number += 1
                    if last:
                        break
                if source.read(4) != b"\r\n\r\n":
                    raise ValueError(f"no record end at byte {source.tell()} of {path}")

    def urn(field: str | None) -> str | None:
        name = field.removeprefix("<urn:record:").removesuffix(">") if field else NAMELESS
        return None if name == NAMELESS else unquote_plus(name)

    tasks = max(1, files.count())
    return files.select("path").repartition(tasks).mapInArrow(run, CHUNKS)

