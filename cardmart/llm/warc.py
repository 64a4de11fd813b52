"""WARC archives with records compressed one by one against a dictionary of their own archive.

An archive (``*.warc.zst``) is a skippable Zstandard frame that holds the
dictionary, followed by one Zstandard frame per WARC record.  Any record can so
be read alone, given the dictionary from the head of its file.

The writer runs inside the tasks.  Each task closes an archive once its records
reach ``archive_bytes``, trains the dictionary on records spread over that
archive, and puts the file into the shared folder under a name made from its
partition, so a retried task replaces its own files and leaves no second copy.

Rows: payload = html in UTF-8, null html = empty payload.  Of rows with equal
payloads of at least ``min_revisit`` bytes the smallest key is written as a
response, the others as revisits of it; shorter payloads are always responses.
Repeated rows that share the smallest key are all responses.  A row with a null
key is never a revisit's target: it revisits the smallest key of its payload if
one is not null, else it is a response.  Null URLs have no target header.  An
archive with less than 4 KB of records cannot be trained on and has no dictionary frame.  Empty
tables write no archive.  Other columns stay unread.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmart.llm.common import Scratch, write_file

#: Fixed values of the format: magic of the skippable dictionary frame, of a Zstandard frame, of a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_PREFIX = "urn:page:"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, archive string")


def plan_records(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """Adds digest, size and ``first_id`` (the response to refer to; null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    shared = (rows.where(F.col("size") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1").select("digest", "first_id"))
    out = rows.join(shared, "digest", "left")  # a hot payload is split by AQE on the left side
    return out.withColumn("first_id", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))


def _record(page_id, url, payload: bytes, digest: str, size: int, first_id, date: str) -> bytes:
    kind = "response" if first_id is None else "revisit"
    name = page_id if page_id is not None else "none:" + hashlib.sha256(
        (url or "").encode() + b"\n" + digest.encode()).hexdigest()
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD_PREFIX}{name}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if first_id is None:
        block = HTTP_HEAD % size + payload
        head.append("Content-Type: application/http; msgtype=response")
    else:
        block = b""
        head += [f"WARC-Refers-To: <{RECORD_PREFIX}{first_id}>", f"WARC-Profile: {REVISIT_PROFILE}",
                 f"X-Payload-Length: {size}"]
    head.append(f"Content-Length: {len(block)}")
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_archive(records: list[bytes], dictionary_bytes: int = 64 << 10, sample_bytes: int = 8 << 20,
                  level: int = 6) -> bytes:
    """Bytes of one archive.  The dictionary is trained on evenly spaced records of it, cut into samples of 2 KB."""
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    sample = [r[i:i + 2048] for r in records[::step] for i in range(0, len(r), 2048)]
    frames, dictionary = [], None
    if total >= 4 * 1024:
        try:
            dictionary = zstandard.train_dictionary(min(dictionary_bytes, sum(map(len, sample)) // 4), sample)
        except zstandard.ZstdError:  # records too few or too alike to train on
            dictionary = None
    if dictionary is not None:
        raw = dictionary.as_bytes()
        frames.append(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
    press = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    frames += map(press.compress, records)
    return b"".join(frames)


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = 16 << 20,
                   date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the planned records; one row per archive (archive, records, raw_bytes, bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal made, held, size
            data = build_archive(held)
            name = f"part-{part:06d}-{made:06d}.warc.zst"
            write_file(f"{folder}/{name}", data)
            row = pa.RecordBatch.from_pydict({"archive": [name], "records": [len(held)],
                                              "raw_bytes": [size], "bytes": [len(data)]})
            made, held, size = made + 1, [], 0
            return row

        for b in batches:
            cols = [b[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "size", "first_id")]
            for row in zip(*cols):
                held.append(_record(*row, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    ordered = plan.sortWithinPartitions("page_id", "digest", "url")  # the same bytes on every attempt
    return ordered.mapInArrow(run, "archive string, records long, raw_bytes long, bytes long")


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive, by its frames alone."""
    at, dictionary = 0, None
    if len(data) >= 8:
        magic, length = struct.unpack_from("<II", data)
        if magic == DICTIONARY_FRAME:
            raw = data[8:8 + length]
            if raw[:4] != DICTIONARY_MAGIC:  # the dictionary itself may be compressed
                raw = zstandard.ZstdDecompressor().decompress(raw)
            dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + length
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    view = memoryview(data)
    while at < len(data):
        one, parts = reader.decompressobj(), []
        while not one.eof:  # in small pieces: what is left of a piece is copied
            if at >= len(data):
                raise ValueError("archive is cut off")
            parts.append(one.decompress(view[at:at + 65536]))
            at = min(at + 65536, len(data))
        at -= len(one.unused_data)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        length = int(headers["Content-Length"])
        if rest[length:] != b"\r\n\r\n":
            raise ValueError("record length does not match")
        yield headers, rest[:length]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives of a folder, digests checked against the payloads that are there."""
    def key(headers: dict, name: str):
        value = headers[name].strip("<>").removeprefix(RECORD_PREFIX)
        return None if value.startswith("none:") else int(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b["path"], b["content"]):
                rows = []
                for headers, block in parse_archive(data.as_py()):
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload digest differs in {path}")
                    else:
                        size = int(headers["X-Payload-Length"])
                    rows.append((key(headers, "WARC-Record-ID"), size, digest, kind,
                                 key(headers, "WARC-Refers-To") if kind == "revisit" else None,
                                 path.as_py().rpartition("/")[2]))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
             .select("path", "content"))
    return files.mapInArrow(run, READ_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Write all pages into archives below the shared folder and read them back."""
    scratch = scratch or Scratch(spark, "warc")
    folder = scratch.path("archives")
    manifest = scratch.cut(write_archives(plan_records(pages), folder), "manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], READ_SCHEMA)
    return read_archives(spark, folder)
