"""WARC archives compressed with Zstandard: a writer and a reader.

An archive is a skippable frame that holds a dictionary, then one frame per record, as the
Zstandard profile of WARC has it. Executors write archives into a folder all of them share,
through the file system that the folder's address names; Spark's binary reader brings them back.
Of equal payloads of at least MIN_REVISIT bytes one record is the response; the others are
revisits that refer to it and hold no payload.

The reader loads the dictionary from the leading frame, decodes one frame per record and checks
frame sizes, version line, headers, block lengths, record ends and payload digests; what does not
hold is an error.

Defined cases: a NULL page is an empty payload. A NULL id is written as an empty one and comes
back NULL; it is a response only if no id is known for its payload. Rows that repeat the largest id
are all responses. Line breaks in addresses are escaped. An empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.llm.common import small_batches, stored
from usageledger.session import scratch_path

MIN_REVISIT = 1_000
# An archive is closed after so many bytes of blocks, so that a reading task can hold it.
ARCHIVE_BYTES = 32 * 1024**2
# The dictionary is trained on the first blocks of its archive.
SAMPLE_BYTES = 1024**2
DICTIONARY_BYTES = 32 * 1024
LEVEL = 3

# Fixed values of the file formats.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_ZERO_DAY = "1970-01-01T00:00:00Z"


def with_roles(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Every page with the digest of its payload and, if it is a revisit, the page it refers to."""
    body = F.coalesce(pages[page], F.lit(""))
    full = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"), body.alias("html"),
        F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body.cast("binary")).alias("payload_digest"),
    )
    large = F.col("payload_bytes") >= MIN_REVISIT
    # One narrow row per payload that occurs again; a hot payload is summed before it is shuffled.
    firsts = full.where(large).groupBy("payload_digest").agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
    firsts = stored(firsts.where("copies > 1").select(F.col("payload_digest").alias("key"), "first"), "warc-firsts")
    # Small payloads get keys of their own, so they are spread evenly and meet nothing.
    key = F.when(large, F.col("payload_digest")).otherwise(F.concat(F.lit("-"), F.hex(F.xxhash64("page_id", "url"))))
    joined = full.withColumn("key", key).join(firsts, "key", "left").drop("key")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", _ZERO_DAY),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
    ]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", _clean(url)))
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def archive_bytes(records: list[bytes]) -> bytes:
    """The dictionary's skippable frame and one frame per record."""
    samples, size = [], 0
    for record in records:
        samples.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    try:
        dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, size // 8)), samples)
    except zstandard.ZstdError:
        # Too little to train on: the samples themselves serve.
        dictionary = zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"\r\n\r\n\r\n\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    plain = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
    frames = [compressor.compress(r) for r in records]
    # A raw dictionary could look like a compressed one; it is then stored compressed.
    held = zstandard.ZstdCompressor(level=LEVEL).compress(plain)
    return b"".join([struct.pack("<II", SKIPPABLE, len(held)), held, *frames])


def _frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at `at` ends, by the sizes of its blocks."""
    if data[at : at + 4] != ZSTD_MAGIC:
        raise ValueError(f"no record frame at byte {at}")
    head = bytes(data[at : at + 18])
    at += zstandard.frame_header_size(head)
    checksum = zstandard.get_frame_parameters(head).has_checksum
    last = False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
        if kind == 3 or at > len(data):
            raise ValueError("a frame is cut short")
    return at + 4 * checksum


def parse_record(record: bytes) -> dict:
    """The checked fields of one decoded record."""
    head, cut, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not cut or lines[0] != VERSION:
        raise ValueError("a record does not start with the version line and headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon or name in headers:
            raise ValueError(f"bad header line {line!r}")
        headers[name] = value
    length = int(headers["Content-Length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError(f"a block of {len(block)} bytes does not fit its length {length}")
    if headers["WARC-Block-Digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError("a block does not have its digest")
    kind = headers["WARC-Type"]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload does not have its length and digest")
    if kind not in ("response", "revisit") or kind == "revisit" and (payload or "WARC-Refers-To" not in headers):
        raise ValueError(f"bad record of type {kind}")
    number = lambda urn: int(n) if (n := urn.removeprefix("<urn:page:").removesuffix(">")) else None
    url = headers.get("WARC-Target-URI")
    return {
        "page_id": number(headers["WARC-Record-ID"]),
        "url": None if url is None else re.sub(r"%([01][0-9A-F]|7F|25)", lambda m: chr(int(m[1], 16)), url),
        "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number(headers["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_records(archive: bytes) -> Iterator[dict]:
    """Every record of an archive, checked."""
    data = memoryview(archive)
    magic, size = struct.unpack_from("<II", data) if len(data) >= 8 else (0, 0)
    if magic != SKIPPABLE or 8 + size > len(data):
        raise ValueError("the archive does not start with its dictionary")
    held = bytes(data[8 : 8 + size])
    plain = zstandard.ZstdDecompressor().decompress(held) if held[:4] == ZSTD_MAGIC else held
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(plain))
    at = 8 + size
    while at < len(data):
        end = _frame_end(data, at)
        yield parse_record(decoder.decompress(data[at:end]))
        at = end


def _put(folder: str, name: str, data: bytes) -> str:
    """Write a file whole under its name; a repeated task writes the same bytes again."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    system.create_dir(base, recursive=True)
    draft = f"{base}/_{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{base}/{name}")
    return f"{folder}/{name}"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages with roles as archives below `folder`; (archive, records) of each, stored."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, size, records = TaskContext.get().partitionId(), 0, 0, []

        def close() -> pa.RecordBatch:
            path = _put(folder, f"part-{task:06d}-{made:05d}.warc.zst", archive_bytes(records))
            return pa.RecordBatch.from_pydict({"archive": [path], "records": pa.array([len(records)], pa.int64())})

        for part in parts:
            for row in part.to_pylist():
                records.append(
                    record_bytes(row["page_id"], row["url"], row["html"].encode(), row["payload_digest"], row["record_type"], row["refers_to"])
                )
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    made, size, records = made + 1, 0, []
        if records:
            yield close()

    return stored(pages.mapInArrow(run, "archive string, records long"), "warc-manifest")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives below `folder`."""
    names = [f.strip().split(" ")[0] for f in RECORD.split(",")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
        ])
        for part in parts:
            for content in part.column(0):
                rows: list[dict] = []
                for record in read_records(content.as_py()):
                    rows.append(record)
                    if len(rows) == 1_000:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    return files.mapInArrow(run, RECORD).select(*names)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Write all pages as archives in the shared folder and read the records back."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = scratch_path(spark, "warc-archives")
    if write_archives(with_roles(pages, page_id, url, page), folder).isEmpty():
        return spark.createDataFrame([], RECORD)
    return read_archives(spark, folder)
