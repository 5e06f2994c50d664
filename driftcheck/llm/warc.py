"""Operator 11: WARC archives as seekable Zstandard bundles.

A task writes its records into archives of its own. Records are grouped into
independent Zstandard frames of about ``FRAME_BYTES``; a skippable frame at the
end holds the seek table (compressed and plain size of each frame, the public
seekable format), so plain ``zstd -d`` reads the whole archive and a reader of
one record decompresses one frame. The index maps a record's identifier to
archive, frame and offset within the plain frame.

Archives go into a shared folder under names that no other attempt of a task
uses; the index, written as a table, names those of the attempts that counted,
so a lost executor leaves files that nobody reads. Reading deals frames, not
archives, to tasks, and checks every payload against its digest.

Defined cases: a null payload is empty; a null page_id has the identifier
``urn:page:``; of equal payloads all rows with the smallest id are responses
(repeated rows share an identifier), null ids revisit it, and if all ids are
null all are responses; control characters and spaces of a url are
percent-encoded, a null url has no target; a payload larger than a frame gets
a frame of its own; an empty table gives no archive and an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, prepare, table
from driftcheck.session import shared_dir

FRAME_BYTES = 1 << 20
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 128 << 20
REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"

#: Fixed values of the public formats: skippable frame, seek table, revisit profile.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = pa.schema([("record_id", pa.string()), ("archive", pa.string()), ("frame", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
_INDEX = "record_id string, archive string, frame long, offset long, length long"
RECORD = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
    ("payload", pa.binary()), ("archive", pa.string()), ("frame", pa.int64()), ("offset", pa.int64()),
])
_RECORD = "record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload binary, archive string, frame long, offset long"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path within it."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def _fields(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def record(row: dict, date: str = DATE) -> bytes:
    """The bytes of a response or revisit record."""
    payload = row["payload"] or b""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    if row["record_type"] == "response":
        block += payload
    uri = row["target_uri"]
    uri = uri and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
    revisit = row["record_type"] == "revisit"
    return _fields([
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", f"<{row['refers_to']}>" if revisit else None), ("Content-Type", "application/http; msgtype=response"),
    ], block)


class Archive:
    """One archive being written: frames, then the seek table."""

    def __init__(self, folder: str, name: str, date: str):
        import zstandard

        self.fs, root = filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.name, self.bytes, self.sizes = f"{folder}/{name}", 0, []
        self.out = self.fs.open_output_stream(f"{root}/{name}", compression=None)
        self.zstd = zstandard.ZstdCompressor()
        info = b"format: WARC file version 1.1\r\n"
        self.frame(_fields([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))

    def frame(self, plain: bytes) -> None:
        packed = self.zstd.compress(plain)
        self.out.write(packed)
        self.sizes.append((len(packed), len(plain)))
        self.bytes += len(packed)

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


def _written(folder: str, frame_bytes: int, archive_bytes: int, date: str, batches):
    """Records of a task -> its archives; yields their index."""
    archive, held, size, index = None, [], 0, []
    task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
    n = 0

    def flush():
        nonlocal held, size
        at, frame = 0, len(archive.sizes)
        for rid, raw in held:
            index.append({"record_id": rid, "archive": archive.name, "frame": frame, "offset": at, "length": len(raw)})
            at += len(raw)
        archive.frame(b"".join(raw for _, raw in held))
        held, size = [], 0

    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            raw = record(row, date)
            if held and size + len(raw) > frame_bytes:
                flush()
            if archive and archive.bytes >= archive_bytes and not held:
                archive.close()
                archive = None
            if archive is None:
                archive, n = Archive(folder, f"part-{task}-{n:04d}.warc.zst", date), n + 1
            held.append((row["record_id"], raw))
            size += len(raw)
        if index:
            yield pa.RecordBatch.from_pylist(index, INDEX)
            index = []
    if held:
        flush()
    if archive:
        archive.close()
        yield pa.RecordBatch.from_pylist(index, INDEX)


def write_archives(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``records`` into archives under ``folder``, a folder that all executors reach; returns the index.

    ``records``: record_id, record_type (response or revisit), target_uri,
    payload (binary), payload_bytes, payload_digest (hex SHA-256), refers_to.
    """
    prepare(records.sparkSession)
    names = ("record_id", "record_type", "target_uri", "payload", "payload_bytes", "payload_digest", "refers_to")
    return keep(records.select(*names).mapInArrow(partial(_written, folder.rstrip("/"), frame_bytes, archive_bytes, date), _INDEX))


def seek_table(archive: str) -> list[tuple[int, int, int]]:
    """Start, compressed and plain size of each frame of an archive, from its last bytes."""
    fs, path = filesystem(archive)
    with fs.open_input_file(path) as f:
        end = f.size()
        n, _, magic = struct.unpack("<IBI", f.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{archive} has no seek table")
        raw = f.read_at(8 * n, end - 9 - 8 * n)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


def plain_frame(archive: str, start: int, packed: int) -> bytes:
    """The records of one frame."""
    import zstandard

    fs, path = filesystem(archive)
    with fs.open_input_file(path) as f:
        return zstandard.ZstdDecompressor().decompress(f.read_at(packed, start))


def parse(plain: bytes, at: int) -> tuple[dict | None, int]:
    """The record at ``at`` (None for one that is neither response nor revisit) and where the next one starts."""
    head = plain.index(b"\r\n\r\n", at)
    lines = plain[at:head].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start = head + 4
    end = start + int(fields["Content-Length"])
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None, end + 4
    body = plain.index(b"\r\n\r\n", start) + 4
    length = int(re.search(rb"\r\nContent-Length: (\d+)", plain[start:body])[1])
    payload = plain[body:end] if fields["WARC-Type"] == "response" else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if payload is not None and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    refers = fields.get("WARC-Refers-To")
    return {
        "record_id": fields["WARC-Record-ID"][1:-1], "record_type": fields["WARC-Type"], "target_uri": fields.get("WARC-Target-URI"), "payload_bytes": length, "payload_digest": digest, "refers_to": refers and refers[1:-1],
        "payload": payload, "offset": at,
    }, end + 4


def _seek_tables(batches):
    for batch in batches:
        for archive in batch.column("archive").to_pylist():
            rows = [{"archive": archive, "frame": k, "start": a, "packed": b, "plain": c} for k, (a, b, c) in enumerate(seek_table(archive))]
            yield pa.RecordBatch.from_pylist(rows, FRAMES)


FRAMES = pa.schema([("archive", pa.string()), *((c, pa.int64()) for c in ("frame", "start", "packed", "plain"))])


def frames(index: DataFrame) -> DataFrame:
    """(archive, frame, start, packed, plain): the seek tables of the archives that ``index`` names."""
    prepare(index.sparkSession)
    return index.select("archive").distinct().mapInArrow(_seek_tables, "archive string, frame long, start long, packed long, plain long")


def _records(payload: bool, batches):
    for batch in batches:
        for f in batch.to_pylist():
            plain, at, out = plain_frame(f["archive"], f["start"], f["packed"]), 0, []
            while at < len(plain):
                row, at = parse(plain, at)
                if row:
                    out.append(row | {"archive": f["archive"], "frame": f["frame"]} | ({} if payload else {"payload": None}))
            yield pa.RecordBatch.from_pylist(out, RECORD)


def read_archives(index: DataFrame, payload: bool = True, read_bytes: int = READ_BYTES) -> DataFrame:
    """Every record of the archives that ``index`` names, about ``read_bytes`` of frames a task."""
    spark = index.sparkSession
    found = keep(frames(index))
    total = found.agg(F.sum("plain")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // read_bytes))
    return found.repartition(tasks, "archive", "frame").mapInArrow(partial(_records, payload), _RECORD)


def _fetched(batches):
    last = plain = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if (r["archive"], r["frame"]) != last:
                last, plain = (r["archive"], r["frame"]), plain_frame(r["archive"], r["start"], r["packed"])
            row, _ = parse(plain, r["offset"])
            out.append(row | {"archive": r["archive"], "frame": r["frame"]})
        yield pa.RecordBatch.from_pylist(out, RECORD)


def lookup(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records that ``ids`` (record_id) names; each needed frame is read once, no other."""
    wanted = index.join(ids.select("record_id").distinct(), "record_id").select("archive", "frame", "offset")
    placed = wanted.join(frames(index), ["archive", "frame"]).select("archive", "frame", "offset", "start", "packed")
    return placed.repartition("archive", "frame").sortWithinPartitions("archive", "frame", "offset").mapInArrow(_fetched, _RECORD)


def page_records(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) as records; equal payloads become revisits of the smallest id."""
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))
    big = rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
    # one row for each payload that occurs twice; its size on disk tells the planner whether to broadcast it
    firsts = keep(big.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.join(firsts, "payload_digest", "left").select(
        name("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, name("first")).alias("refers_to"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``pages``: written into archives of the shared folder, then read back from them."""
    folder = f"{shared_dir(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    index = write_archives(page_records(table(spark, sf_dir, "pages")), folder)
    page = lambda c: F.substring_index(F.col(c), ":", -1).try_cast("long")
    return read_archives(index, payload=False).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE = {
    "op11_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest""",
}
