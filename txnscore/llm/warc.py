"""WARC archives with dictionary compression, written and read back.

Every archive file is a sequence of Zstandard frames: first a skippable frame
that holds a Zstandard dictionary, then one frame per WARC record, each
compressed on its own with that dictionary. The dictionary is built from the
records of the archive it leads, all of them, so an archive is read alone.

Payloads that occur again (equal digest, at least ``REVISIT_BYTES`` long) are
stored once, in the response with the largest page_id; the others become
revisit records that name it. The digest is hashed in the JVM, the largest id
per digest is pre-aggregated before its shuffle, and Spark may split a digest
that many pages share.

Archives lie in the folder the caller names (the shared one by default); a task
writes files of its own attempt and its manifest row is the commit: only files
in the written manifest are read, so retried or speculative tasks do no harm.

Defined results: null html is an empty payload; null url is an empty target; a
null page_id is written as a response of its own and read back as null; rows
that repeat the largest page_id of a payload are all responses; an empty table
gives no archives and no rows; extra columns are ignored; a payload of any
length is one record.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscore.llm.common import blocks, ship, written
from txnscore.session import scratch_path

#: Magic number of the dictionary's skippable frame.
DICT_MAGIC = 0x184D2A5D
REVISIT_BYTES = 1000
#: Uncompressed record bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
DICT_BYTES, LEVEL = 64 << 10, 3
#: Archives that one task reads back.
READ_ARCHIVES = 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def record_id(page_id: int | None) -> str:
    """A record URN from which the page id can be read again."""
    number = 1 << 127 if page_id is None else page_id % (1 << 64)
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(urn: str) -> int | None:
    number = uuid.UUID(urn[10:-1]).int
    if number >> 127:
        return None
    return number - (1 << 64) if number >> 63 else number


def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = "".join(c for c in url if c >= " ")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {EPOCH}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def archive(records: list[bytes]) -> bytes:
    """The bytes of one archive: dictionary frame, then a frame per record."""
    trained = b""
    if len(records) >= 8:  # too few samples make no dictionary
        try:
            trained = zstandard.train_dictionary(
                min(DICT_BYTES, sum(map(len, records)) // 8), records, k=512, d=8, f=18, accel=4, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # the samples have nothing in common
            trained = b""
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained, dict_type=kind)) \
        if trained else zstandard.ZstdCompressor(level=LEVEL)
    return b"".join([struct.pack("<II", DICT_MAGIC, len(trained)), trained, *map(press.compress, records)])


def frames(raw: bytes):
    """The records of an archive, one after the other."""
    magic, size = struct.unpack_from("<II", raw)
    if magic != DICT_MAGIC:
        raise ValueError("an archive begins with its dictionary frame")
    trained, at = raw[8:8 + size], 8 + size
    made = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    press = zstandard.ZstdDecompressor(**made)
    view = memoryview(raw)
    while at < len(raw):
        one = press.decompressobj()
        out = [one.decompress(view[at:at + (1 << 16)])]
        at += 1 << 16
        while not one.eof and at < len(raw):
            out.append(one.decompress(view[at:at + (1 << 16)]))
            at += 1 << 16
        at = min(at, len(raw)) - len(one.unused_data)
        yield b"".join(out)


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and refers_to (null: a response)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"),
                        F.sha1(payload).alias("digest"))
    long = F.octet_length("html") >= REVISIT_BYTES
    last = rows.where(long).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    last = written(last.where("n > 1 and last is not null").select("digest", "last"), "warc-last")
    again = long & (F.col("page_id") < F.col("last"))
    return rows.join(last, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(again, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives of ``pages``; the manifest of what was written."""
    ship(pages.sparkSession)

    def task(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        own = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        held, size, n = [], 0, 0

        def close():
            name = f"{base}/{own}-{n:05d}.warc.zst"
            raw = archive(held)
            with store.open_output_stream(name) as out:
                out.write(raw)
            return pa.RecordBatch.from_pydict(
                {"path": [name], "records": pa.array([len(held)], pa.int64()), "bytes": pa.array([len(raw)], pa.int64())})

        for b in blocks(batches, "html"):
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                held.append(record(page_id, url, html.encode("utf-8"), digest, refers_to))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    held, size, n = [], 0, n + 1
        if held:
            yield close()

    return marked(pages).mapInArrow(task, MANIFEST)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives: RECORDS, digests of the payloads as read."""
    ship(manifest.sparkSession)

    def task(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column("path").to_pylist():
                with store.open_input_stream(path) as f:
                    raw = f.read()
                out = []
                for fields, block in map(parse, frames(raw)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(head.rpartition(b"Content-Length: ")[2])
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (length, said):
                        raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} is damaged")
                    refers = fields.get("WARC-Refers-To")
                    out.append((page_of(fields["WARC-Record-ID"]), length, said, fields["WARC-Type"],
                                page_of(refers) if refers else None, fields["WARC-Target-URI"]))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=[x.split()[0] for x in RECORDS.split(", ")])

    tasks = -(-manifest.count() // READ_ARCHIVES) or 1
    return manifest.select("path").repartition(tasks, "path").mapInArrow(task, RECORDS)


def op3(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder
    manifest = written(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), "warc-manifest")
    return read_archives(manifest, folder).drop("url")


SQL = f"""
with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as h from pages),
m as (select *, case when n >= {REVISIT_BYTES} then max(page_id) over (partition by h) end as last from p)
select page_id, cast(n as bigint) as payload_bytes, h as payload_digest,
  case when page_id < last then 'revisit' else 'response' end as record_type,
  case when page_id < last then last end as refers_to
from m
"""
