"""Deterministic sharded WARC writer and reader.

Writing: the keys of the pages (id, SHA-1, size) are resolved first, without payloads, into the
revisits: of records with equal payloads of at least ``min_revisit_bytes`` bytes the largest id is
the response, the others revisit it. Payloads and revisit marks are then range-sorted together by
id, so one shuffle moves each payload once. A task writes the records of its range, each a gzip
member of its own with regenerated headers and digests, under temporary names, and rolls to the next
file at ``roll_bytes`` compressed bytes; a full file is renamed to its final name, which depends on
range and number only. The files' names, sizes and checksums are the manifest, a table that Spark
commits at the end; only files in the manifest count. The bytes depend on the records alone, so a
task that runs again (a lost executor, speculation) replaces a file by an equal one.

Reading: the files of the manifest are dealt to tasks and read as streams; sizes, checksums, block
and payload digests are verified.

Defined cases: a null payload is empty; a null id is written without an id and sorts first; where
all records of a payload have no id, all are responses; rows that repeat the response's id and
payload are responses as well; a null url is written as ``urn:unknown``; control characters and
blanks in a url are percent-encoded; an empty table gives an empty manifest and no records; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.llm.common import utf8_column

ROLL_BYTES = 16 << 20
RANGE_BYTES = 16 << 20
#: Most tasks of a read.
READ_TASKS = 50_000
#: The date of regenerated records: a parameter, so that bytes don't depend on the clock.
DATE = "2020-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace of RFC 4122
_MANIFEST = pa.schema(
    [("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())]
)
_MANIFEST_KINDS = "file string, bytes bigint, records bigint, sha256 string, first_id bigint, last_id bigint"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}')}>"


def header_value(value: str | None) -> str:
    """A header value on one line: control characters and blanks percent-encoded."""
    raw = (value or "urn:unknown").encode("utf-8", "surrogatepass")
    return b"".join(b"%%%02X" % c if c <= 32 or c == 127 else bytes([c]) for c in raw).decode("utf-8", "replace")


def format_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A whole WARC record: a response with its payload, or a revisit without."""
    digest = base32_sha1(payload)
    revisit = refers_to is not None
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    lines += [
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {header_value(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """The fields of a record; raises if a length or digest doesn't hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (digest != base32_sha1(payload) or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    return {
        "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
        "url": fields["WARC-Target-URI"],
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _filesystem(folder: str):
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
    return fs.LocalFileSystem(), folder


class _Roller:
    """Writes gzip members to temporary files and renames each full one to its final name."""

    def __init__(self, folder: str, part: int, roll_bytes: int):
        self.fs, self.folder = _filesystem(folder)
        self.part, self.roll_bytes, self.number = part, roll_bytes, 0
        self.attempt, self.stream, self.done = uuid.uuid4().hex, None, []

    def add(self, page_id: int | None, record: bytes) -> None:
        if self.stream is None:
            self.temporary = f"{self.folder}/_temporary/{self.part:05d}-{self.number:05d}-{self.attempt}"
            self.stream = self.fs.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sum, self.first = 0, 0, hashlib.sha256(), page_id
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.stream.write(member)
        self.sum.update(member)
        self.size += len(member)
        self.records += 1
        self.last = page_id
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is None:
            return
        self.stream.close()
        name = f"part-{self.part:05d}-{self.number:05d}.warc.gz"
        final = f"{self.folder}/{name}"
        try:
            self.fs.move(self.temporary, final)
        except OSError:  # a store whose rename doesn't replace: an equal file of an earlier attempt is there
            self.fs.delete_file(final)
            self.fs.move(self.temporary, final)
        self.done.append((name, self.size, self.records, self.sum.hexdigest(), self.first, self.last))
        self.stream, self.number = None, self.number + 1

    def manifest(self) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) if self.done else [()] * len(_MANIFEST)
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MANIFEST, strict=True)], schema=_MANIFEST)


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    roll_bytes: int = ROLL_BYTES,
    range_bytes: int = RANGE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write the pages below ``folder`` (shared by all executors) and return the manifest."""
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    )
    keys = rows.select("id", F.unhex(F.sha1(F.col("payload").cast("binary"))).alias("digest"), F.octet_length("payload").cast("bigint").alias("size"))
    total = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    n = max(1, -(-((total[0] or 0) + 500 * total[1]) // range_bytes))
    responses = keys.where(F.col("size") >= min_revisit_bytes).groupBy("digest", "size").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    marks = (
        keys.join(responses.where("n > 1 and refers_to is not null"), ["digest", "size"])
        .where(F.col("id").isNull() | (F.col("id") < F.col("refers_to")))
        .select("id", "digest", "refers_to")
        .distinct()
    )
    dealt = (
        rows.select("id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("bigint").alias("refers_to"))
        .unionByName(marks.select("id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit("").alias("payload"), "digest", "refers_to"))
        .repartitionByRange(int(n), "id")
        .sortWithinPartitions("id", "kind", "url", "payload")
    )
    fs, path = _filesystem(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)

    def write(batches):
        from pyspark import TaskContext

        out, at, refers = _Roller(folder, TaskContext.get().partitionId(), roll_bytes), object(), {}
        for batch in batches:
            ids, kinds, urls, _, digests, targets = (c.to_pylist() if i != 3 else c for i, c in enumerate(batch.columns))
            for id_, kind, url, payload, digest, target in zip(ids, kinds, urls, utf8_column(batch.column(3)), digests, targets, strict=True):
                if id_ != at:
                    at, refers = id_, {}
                if kind == 0:
                    refers[digest] = target
                else:
                    out.add(id_, format_record(id_, url, payload, refers.get(hashlib.sha1(payload).digest()) if refers else None, date))
            if out.done:
                yield out.manifest()
        out.close()
        yield out.manifest()

    dealt.mapInArrow(write, _MANIFEST_KINDS).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(pages.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_KINDS).parquet(f"{folder}/manifest")


_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)
_RECORD_KINDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _members(stream, total: hashlib._Hash):
    """The decompressed gzip members of a stream, one at a time."""
    data, unpacker, parts = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                break
            total.update(data)
        parts.append(unpacker.decompress(data))
        data = unpacker.unused_data if unpacker.eof else b""
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("an archive ends inside a record")


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives that the manifest names, one row each."""
    schema = _RECORD.append(pa.field("payload", pa.binary())) if with_payload else _RECORD

    def read(batches):
        fs, path = _filesystem(folder)
        for batch in batches:
            for name, size, checksum in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, total, held = [], hashlib.sha256(), 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for record in _members(stream, total):
                        found.append(parse_record(record))
                        held += len(record) if with_payload else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema=schema)
                            found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)
                if total.hexdigest() != checksum:
                    raise ValueError(f"{name} ({size} bytes) isn't the file of the manifest")

    files = read_manifest(spark, folder).select("file", "bytes", "sha256")
    # a task a file: a given number of partitions, which adaptive execution doesn't join together
    files = files.repartitionByRange(max(1, min(READ_TASKS, files.count())), "file")
    return files.mapInArrow(read, _RECORD_KINDS + ", payload binary" * with_payload)
