"""WARC archives: written by tasks, read back by byte ranges.

Writing: every record is a gzip member of its own. Of records with equal payloads of at least ``least_bytes``, the
one with the largest id is the response and the others are revisits, which carry the digest and headers only. Each
task writes its own files under new names, and only files that the list of finished ones names are ever read; a task
that is lost or runs twice leaves files behind that nobody reads.

Reading: a task gets a byte range of a file. It looks for the gzip magic, takes a candidate for a record if it
decodes to a WARC header, and from there on reads member after member. It owns the records that start in its range
and reads past the end of the range to finish the last of them. A file can be cut into any number of ranges.

Defined results: a null payload is an empty one. Repeated rows are records each; rows that share the largest id of
their payload are all responses. A row with a null id revisits the response of its payload; where all ids of a
payload are null, all are responses. A null address is left out. An empty table gives no file and an empty
result. Extra columns play no part. Payloads of any length are written and read whole.

The folder can be any that pyarrow's file systems reach (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept, pick
from tidemark.session import scratch

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 128 << 20
READ_BYTES = 1 << 20
HEADER_BYTES = 1 << 16
_NO_ID = "none"


class DamagedRecord(ValueError):
    """A member that isn't the record that its header promises."""


def _name(page_id: object) -> str:
    return f"<urn:page:{_NO_ID if page_id is None else quote(str(page_id), safe='-')}>"


def encode_record(page_id: object, url: str | None, payload: bytes, digest: str, length: int, refers_to: object,
                  revisit: bool, level: int = 5) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
             "WARC-Date: 2020-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~-._"))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def plan_records(pages: DataFrame, least_bytes: int = 1000, page_id: str = "page_id", url: str = "url",
                 payload: str = "html") -> DataFrame:
    """page_id, url, payload, length, digest, revisit and refers_to of each record."""
    rows = pick(pages, page_id=page_id, url=url, payload=payload)
    body = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    rows = rows.select("page_id", F.col("url").cast("string").alias("url"), body.alias("payload"),
                       F.octet_length(body).cast("long").alias("length"), F.sha1(body).alias("digest"))
    # Only payloads that occur again; counted from digests alone, so the texts move once, in the join.
    again = (rows.filter(F.col("length") >= least_bytes).groupBy("digest", "length")
             .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1 and top is not null").drop("n"))
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return (rows.join(again, ["digest", "length"], "left").withColumn("revisit", revisit)
            .select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "length", "digest",
                    "revisit", F.when(F.col("revisit"), F.col("top")).alias("refers_to")))


def write(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives and returns the list of finished files: path, bytes, records."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        out, path, size, count, done = None, "", 0, 0, []
        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if out is None:
                        system.create_dir(root, recursive=True)
                        path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = system.open_output_stream(path, compression=None)
                    data = encode_record(r["page_id"], r["url"], r["payload"] or b"", r["digest"], r["length"],
                                         r["refers_to"], r["revisit"])
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= file_bytes:
                        out.close()
                        out = None
                        done.append((path, size, count))
            if out is not None:
                out.close()
                out = None
                done.append((path, size, count))
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), *(pa.array([d[i] for d in done], pa.int64()) for i in (1, 2))],
            names=["path", "bytes", "records"])

    return kept(records.mapInArrow(work, "path string, bytes long, records long"), "archives")


class _Window:
    """A file read forward by byte position, holding only what isn't used yet."""

    def __init__(self, file, start: int) -> None:
        self.file, self.at, self.data = file, start, b""
        file.seek(start)

    def fill(self, size: int) -> bytes:
        """At least ``size`` bytes from the current position, fewer at the end of the file."""
        parts, have = [self.data], len(self.data)
        while have < size:
            got = self.file.read(max(READ_BYTES, size - have))
            if not got:
                break
            parts.append(got)
            have += len(got)
        self.data = parts[0] if len(parts) == 1 else b"".join(parts)
        return self.data

    def skip(self, n: int) -> None:
        self.data = self.data[n:]
        self.at += n


def _is_record(data: bytes) -> bool:
    """Whether a gzip member at the start of the data decodes to a WARC header."""
    try:
        head = zlib.decompressobj(31).decompress(data[:HEADER_BYTES], 4096)
    except zlib.error:
        return False
    first, _, rest = head.partition(b"\r\n")
    return first.startswith(b"WARC/1.") and b":" in rest.split(b"\r\n", 1)[0]


def members(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded member) of the records that start in [start, end)."""
    window = _Window(file, start)
    while window.at < end:
        data = window.fill(HEADER_BYTES)
        if not data:
            return
        found = data.find(MAGIC)
        if found < 0:
            window.skip(max(1, len(data) - len(MAGIC) + 1))
            continue
        if found:
            window.skip(found)
            continue
        if not _is_record(data):
            window.skip(1)
            continue
        at, out, unpacker = window.at, io.BytesIO(), zlib.decompressobj(31)
        try:
            while not unpacker.eof:
                data = window.fill(1)
                if not data:
                    raise DamagedRecord(f"the file ends inside the record at {at}")
                out.write(unpacker.decompress(data))
                window.skip(len(data) - len(unpacker.unused_data))
        except zlib.error as e:
            raise DamagedRecord(f"record at {at}: {e}") from e
        yield at, out.getvalue()


def decode_record(data: bytes) -> dict:
    """The fields of a record; raises if length or digest don't hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise DamagedRecord(f"{fields.get('WARC-Record-ID')} is longer or shorter than it says")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise DamagedRecord(f"{fields.get('WARC-Record-ID')} has another payload than its digest says")

    def page(name: str | None) -> str | None:
        short = None if name is None else name.removeprefix("<urn:page:").removesuffix(">")
        return None if short == _NO_ID else short

    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": payload,
            "payload_bytes": length, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": page(fields.get("WARC-Refers-To"))}


def read(files: DataFrame, folder: str, split_bytes: int = 8 << 20, with_payload: bool = True,
         id_type: str = "bigint") -> DataFrame:
    """Records of the listed files (path, bytes), in byte ranges of ``split_bytes``."""
    ranges = files.filter("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start"))
    ranges = ranges.withColumn("end", F.col("start") + split_bytes)
    # One task a range: the rows are tiny, so Spark would else put them all together.
    ranges = ranges.repartition(max(1, min(20_000, ranges.count())), "path", "start")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "offset"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                rows, size = [], 0
                with system.open_input_file(r["path"]) as file:
                    for at, data in members(file, r["start"], r["end"]):
                        row = decode_record(data) | {"path": r["path"], "offset": at}
                        size += len(row["payload"]) if with_payload else 0
                        rows.append({n: row[n] for n in names})
                        if size > READ_BYTES * 8 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = ", ".join(f"{n} {'long' if k == pa.int64() else 'binary' if k == pa.binary() else 'string'}"
                    for n, k in zip(names, kinds, strict=True))
    return ranges.mapInArrow(work, ddl).withColumns(
        {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, least_bytes: int = 1000, split_bytes: int = 8 << 20, page_id: str = "page_id",
               url: str = "url", payload: str = "html", with_payload: bool = False) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads the records back."""
    records = plan_records(pages, least_bytes, page_id, url, payload)
    folder = scratch(pages.sparkSession, "warc")
    files = write(records, folder)
    return read(files, folder, split_bytes, with_payload, records.schema["page_id"].dataType.simpleString())
