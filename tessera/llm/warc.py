"""WARC archives: a writer with one gzip member per record, and a sequential reader.

The writer gives every page a record. Of pages with equal payloads of
``REVISIT_BYTES`` or more, the one with the smallest id is a ``response``, the
others are ``revisit`` records that name it and hold its HTTP header only.
Each task writes archives of about ``ARCHIVE_BYTES`` into the shared folder
under names of its own attempt and returns their names; only names that a
finished task returned are read, so a lost executor leaves no half records.

The reader takes an archive in chunks, inflates member after member, finds a
record's block by its Content-Length and checks block and payload digests and
that a member ends where its record does; anything else raises an error with
the archive's name. It keeps one record at a time.

A null html is an empty payload. A null page_id is never the smallest and is
written as a record without an id; rows that share the smallest id and the
payload are all responses. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_rows, broadcast_if_small, materialize
from tessera.session import scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 18
SALTS = 32
#: Pages carry no date; records of one crawl share this one.
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_file(path: str, write: bool = False):
    """A stream of a path in any file system that Arrow knows."""
    from pyarrow import fs
    where, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return where.open_output_stream(name, compression=None) if write else where.open_input_stream(name, compression=None)


def make_folder(path: str) -> None:
    """Create a folder in any file system that Arrow knows."""
    from pyarrow import fs
    where, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    where.create_dir(name, recursive=True)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, level: int = 4) -> bytes:
    """One record as a gzip member."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}",
             "Content-Type: application/http; msgtype=response",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    member = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return member.compress(head) + member.compress(block) + member.compress(b"\r\n\r\n") + member.flush()


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def _page(value: str | None) -> int | None:
    return int(value[10:-1]) if value else None


def read_records(stream, name: str, payloads: bool = True) -> Iterator[dict]:
    """The records of an open archive, one after another."""
    inflate, data, raw, begun = zlib.decompressobj(31), bytearray(), b"", False
    head = None  # of the record that is being read
    while True:
        raw = raw or stream.read(READ_BYTES)
        if not raw:
            if begun:
                raise ValueError(f"{name}: the archive ends within a record")
            return
        begun = True
        try:
            data += inflate.decompress(raw, READ_BYTES * 4)
        except zlib.error as e:
            raise ValueError(f"{name}: {e}") from e
        raw = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
        if head is None and (end := data.find(b"\r\n\r\n")) >= 0:
            if not data.startswith(b"WARC/1."):
                raise ValueError(f"{name}: a record begins with {bytes(data[:20])!r}")
            head = _fields(bytes(data[:end]))
            del data[:end + 4]
        if not inflate.eof:
            continue
        if head is None:
            raise ValueError(f"{name}: a member without a record header")
        size = int(head["content-length"])
        block = bytes(data[:size])
        if len(block) != size or bytes(data[size:]) != b"\r\n\r\n":
            raise ValueError(f"{name}: a record's length is not its Content-Length")
        if head["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ValueError(f"{name}: a block does not have its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(_fields(http)["content-length"])
        digest = head["warc-payload-digest"].partition(":")[2]
        revisit = head["warc-type"] == "revisit"
        if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"{name}: a payload does not have its length and digest")
        yield {"page_id": _page(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "payload_bytes": length,
               "payload_digest": digest, "record_type": head["warc-type"], "refers_to": _page(head.get("warc-refers-to")),
               "payload": payload if payloads and not revisit else None}
        inflate, head, begun = zlib.decompressobj(31), None, False
        data.clear()


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _write_task(folder: str, archive_bytes: int):
    def run(batches):
        task = TaskContext.get()
        k, out, size, records = 0, None, 0, 0
        name = ""

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [records], "bytes": [size]})
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    name, size, records = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{k}.warc.gz", 0, 0
                    out, k = open_file(name, write=True), k + 1
                page, url, html, refers = (x.as_py() for x in row)
                member = record(page, url, (html or "").encode(), refers)
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def _read_task(payloads: bool):
    def run(batches):
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, size = [], 0
                with open_file(name) as stream:
                    for r in read_records(stream, name, payloads):
                        rows.append(r)
                        size += len(r["payload"] or b"") + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)
    return run


def mark_revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to``, null for responses."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    html = F.coalesce("html", F.lit(""))
    long_ = F.octet_length(html) >= REVISIT_BYTES
    digest = F.when(long_, F.sha2(html.cast("binary"), 256))
    first = pages.where(long_).select("page_id", digest.alias("digest")).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # only payloads that occur again, each under every salt, so that one payload's pages spread
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    first = materialize(first.where("n > 1").select("digest", "first"), "first_pages").withColumn("salt", salts)
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    marked = pages.withColumns({"digest": digest, "salt": salt}).join(broadcast_if_small(first, 200), ["digest", "salt"], "left")
    return marked.select("page_id", "url", "html", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``pages``; the finished archives (archive, records, bytes)."""
    spark = pages.sparkSession
    arrow_rows(spark)
    folder = folder or scratch_path(spark, "warc")
    make_folder(folder)
    written = mark_revisits(pages).mapInArrow(_write_task(folder, archive_bytes), "archive string, records long, bytes long")
    return materialize(written, "archives")


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``archives`` (archive); an archive is read by one task."""
    # about one archive a partition, so that their number decides the parallelism
    names = archives.select("archive").repartition(max(1, min(archives.count(), 10_000)), "archive")
    return names.mapInArrow(_read_task(payloads), RECORDS)
