"""WARC archives: writing, normalising and reading back.

1. ``write_archives``: every task writes its rows as WARC response records into
   archives that are one gzip stream each, the layout a plain ``gzip`` of a
   crawl leaves behind. Nothing can be read from such a file but from its start.
2. ``revisits``: of the records with equal payloads the one with the largest id
   stays a response, the others become revisits.
3. ``normalise``: every archive is inflated once as a stream, each record is
   written as a gzip member of its own (a revisit without its payload), and the
   members' offsets go to a sidecar index (``.idx``, one JSON line each).
4. ``read_archives``: reads members at the offsets of the sidecar, parses them
   and checks each payload against its digest.

Archives live in the shared folder and are opened through Arrow's file systems
(local, HDFS, S3, ... by the folder's URI). A task writes under a name of its
own and renames when it is done, so a task that runs again replaces its file;
what later steps read is the list of files that a finished job returned.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm.common import scratch_path, stage, table

ARCHIVE_BYTES = 8 << 20   # payload bytes after which a task starts its next archive
LEVEL = 1
READ = 1 << 18
DATE = "1970-01-01T00:00:00Z"  # records carry no time: equal input gives equal archives


def file_system(uri: str):
    """(Arrow file system, path) of a URI or a plain local path."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


class _Out:
    """A file that appears under its name only when it is whole."""

    def __init__(self, uri: str):
        self.fs, self.path = file_system(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.file = self.fs.open_output_stream(self.part)
        self.size = 0

    def write(self, data: bytes):
        self.file.write(data)
        self.size += len(data)

    def close(self):
        self.file.close()
        self.fs.move(self.part, self.path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _uri(value: str | None) -> str:
    # a header value is one line
    return " ".join((value or "").split())


_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_WRITTEN = "archive string, seq int, id long, bytes long, digest string"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Step 1; returns (archive, seq, id, bytes, digest) of every record. A
    null body is an empty payload, a null url an empty target URI."""
    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        n, out, pack, seq, size, rows = 0, None, None, 0, 0, []

        def close():
            out.write(pack.flush())
            out.close()

        def flush():
            b = pa.RecordBatch.from_pylist([dict(zip(("archive", "seq", "id", "bytes", "digest"), r)) for r in rows], schema=schema)
            rows.clear()
            return b

        schema = pa.schema([("archive", pa.string()), ("seq", pa.int32()), ("id", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string())])
        for b in batches:
            for rid, url, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if out is None:
                    name = f"{folder}/raw/part-{part:06d}-{n:04d}.warc.gz"
                    out, pack, seq, size = _Out(name), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                payload = body.as_buffer().to_pybytes() if body.is_valid else b""
                digest = payload_digest(payload)
                out.write(pack.compress(record([
                    ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:record:{'' if rid is None else rid}>"), ("WARC-Date", DATE),
                    ("WARC-Target-URI", _uri(url)), ("Content-Type", "application/http; msgtype=response"),
                    ("WARC-Payload-Digest", f"sha1:{digest}")], _HTTP + payload)))
                rows.append((name, seq, rid, len(payload), digest))
                seq, size = seq + 1, size + len(payload)
                if size >= archive_bytes:
                    close()
                    out, n = None, n + 1
            if rows:
                yield flush()
        if out is not None:
            close()

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(body_col)).mapInArrow(run, _WRITTEN)


def revisits(written: DataFrame, least: int = 0) -> DataFrame:
    """(archive, seq, refers_to) of the records that become revisits: those
    with a payload of at least ``least`` bytes that a record with a larger id
    has too. Records without an id, and rows that repeat the largest id, stay
    responses."""
    known = written.where((F.col("bytes") >= least) & F.col("id").isNotNull())
    last = stage(known.groupBy("digest", "bytes").agg(F.max("id").alias("refers_to"), F.min("id").alias("first"))
                 .where("first <> refers_to").drop("first"), "warc-last")
    return known.join(last, ["digest", "bytes"]).where("id <> refers_to").select("archive", "seq", "refers_to")


def inflated_records(read, size: int = READ) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each WARC record of a gzip stream, inflated once
    with bounded memory. Reads on over the end of a member, so archives with
    one member or many are the same to it."""
    inflate, data, ended = zlib.decompressobj(31), bytearray(), False

    def more() -> bool:
        nonlocal inflate, ended
        while not ended:
            raw = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            raw = raw or read(size)
            if not raw:
                ended = True
                return False
            got = inflate.decompress(raw, size * 4)
            if got:
                data.extend(got)
                return True
        return False

    while True:
        while (end := data.find(b"\r\n\r\n")) < 0:
            if not more():
                if data.strip():
                    raise ValueError("archive ends within a record")
                return
        head = bytes(data[:end])
        length = int(fields_of(head)["content-length"])
        while len(data) < end + 4 + length + 4:
            if not more():
                raise ValueError("archive ends within a record")
        yield head, bytes(data[end + 4:end + 4 + length])
        del data[:end + 4 + length + 4]


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _payload_of(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4:]


def normalise(written: DataFrame, decided: DataFrame, folder: str) -> DataFrame:
    """Step 3; returns (archive, index) of every normalised archive. One
    archive is one task's stream; its decisions come as one list, no longer
    than the archive's records."""
    per = decided.groupBy("archive").agg(F.collect_list(F.struct("seq", "refers_to")).alias("decided"))
    work = stage(written.select("archive").distinct().join(per, "archive", "left"), "warc-work")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for r in b.to_pylist():
                name = r["archive"].rsplit("/", 1)[1]
                refers = {d["seq"]: d["refers_to"] for d in r["decided"] or []}
                fs, path = file_system(r["archive"])
                out, index = _Out(f"{folder}/normal/{name}"), _Out(f"{folder}/normal/{name}.idx")
                with fs.open_input_stream(path, compression=None) as raw:
                    for seq, (head, block) in enumerate(inflated_records(raw.read)):
                        f = fields_of(head)
                        if seq in refers:
                            payload = len(_payload_of(block))
                            data = record([
                                ("WARC-Type", "revisit"), ("WARC-Record-ID", f["warc-record-id"]), ("WARC-Date", f["warc-date"]),
                                ("WARC-Target-URI", f["warc-target-uri"]), ("Content-Type", f["content-type"]),
                                ("WARC-Payload-Digest", f["warc-payload-digest"]),
                                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                ("WARC-Refers-To", f"<urn:record:{refers[seq]}>"), ("X-Payload-Length", str(payload))], _HTTP)
                        else:
                            data = head + b"\r\n\r\n" + block + b"\r\n\r\n"
                        at, member = out.size, _member(data)
                        out.write(member)
                        index.write(json.dumps({"id": f["warc-record-id"], "offset": at, "length": len(member)}).encode() + b"\n")
                out.close()
                index.close()
                yield pa.RecordBatch.from_pylist([{"archive": f"{folder}/normal/{name}", "index": f"{folder}/normal/{name}.idx"}])

    tasks = max(1, written.sparkSession.sparkContext.defaultParallelism * 2)
    return work.repartition(tasks, "archive").mapInArrow(run, "archive string, index string")


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:record:").removesuffix(">")
    return int(digits) if digits else None


def read_archives(files: DataFrame) -> DataFrame:
    """Step 4: the records of normalised archives, through their sidecars. A
    payload that does not match its digest is an error."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for archive, index in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, path = file_system(archive)
                ifs, ipath = file_system(index)
                out = []
                with fs.open_input_file(path) as f, ifs.open_input_stream(ipath, compression=None) as i:
                    for line in i.read().splitlines():
                        at = json.loads(line)
                        f.seek(at["offset"])
                        head, _, rest = zlib.decompress(f.read(at["length"]), 31).partition(b"\r\n\r\n")
                        h = fields_of(head)
                        payload = _payload_of(rest[:int(h["content-length"])])
                        digest, revisit = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"] == "revisit"
                        if h["warc-record-id"] != at["id"] or not revisit and payload_digest(payload) != digest:
                            raise ValueError(f"{archive} is damaged at {at}")
                        out.append({"page_id": _number(h["warc-record-id"]), "payload_bytes": int(h["x-payload-length"]) if revisit else len(payload),
                                    "payload_digest": digest, "record_type": h["warc-type"], "refers_to": _number(h.get("warc-refers-to")),
                                    "url": h["warc-target-uri"]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return files.select("archive", "index").mapInArrow(run, _READ)


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write, normalise and read back; one row per page.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to,
    url. Empty and null bodies are payloads of 0 bytes; rows that share id and
    payload are records of their own; other columns are ignored; an empty
    table gives no row. The archives stay in ``folder``.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    written = stage(write_archives(pages, folder), "warc-written")
    files = stage(normalise(written, revisits(written, least), folder), "warc-files")
    tasks = max(1, pages.sparkSession.sparkContext.defaultParallelism * 2)
    return read_archives(files.repartition(tasks, "archive"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, through the normalised archives."""
    return round_trip(table(spark, sf_dir, "pages")).drop("url")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS x, html FROM p),
b AS (SELECT page_id, n, html, array_to_string(list_transform(range(0, 32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
          ((('0x' || substr(x, 1 + (k // 8) * 10, 10))::BIGINT) >> (35 - 5 * (k % 8))) & 31 AS INTEGER), 1)), '') AS digest FROM d),
m AS (SELECT html, max(page_id) AS top FROM b GROUP BY html)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b JOIN m USING (html)
"""
