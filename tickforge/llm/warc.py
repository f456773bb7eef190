"""WARC archives compressed record by record with a shared Zstandard dictionary.

An archive starts with a skippable frame that holds the dictionary; every record is a
Zstandard frame of its own after it, so a record can be read from its offset with
nothing but the dictionary.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.llm.common import local_form, stored
from tickforge.session import scratch_path

# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
TRAINING_BYTES = 4 << 20
SALTS = 16
#: Places of payloads that are never referred to, so that a small one shared by many pages is spread over all tasks.
SMALL_PLACES = 1 << 20
READ_BYTES = 64 << 10
WRITTEN = "path string, records long, payload_bytes long, stored_bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def plan_records(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 1000,
) -> DataFrame:
    """Decides per page whether its payload is stored (response) or referred to (revisit).

    Of equal payloads of at least ``min_bytes`` the one with the largest key is the response.
    Result columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and
    payload, which is null for a revisit.  A null payload counts as empty.  A null key is
    smaller than any other; copies without any key are all responses.  Of rows that repeat the
    largest key one is the response, the others revisit it.  Other columns are dropped.
    Hot payloads: copies are counted per task before the shuffle, and the join deals each
    payload to ``SALTS`` places; smaller ones meet nothing in the join and are dealt to as many places as
    there are pages, up to ``SMALL_PLACES``.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    small = -1 - F.pmod(F.xxhash64("page_id", "url"), F.lit(SMALL_PLACES))
    salted = rows.withColumn("salt", F.when(F.col("payload_bytes") < min_bytes, small).otherwise(
        F.pmod(F.xxhash64("page_id"), F.lit(SALTS))).cast("int"))
    copies = (
        rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1 AND keeper IS NOT NULL").drop("n")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    joined = salted.join(copies, ["payload_digest", "payload_bytes", "salt"], "left")
    place = Window.partitionBy("payload_digest", "payload_bytes", "salt", "page_id").orderBy("url")
    revisits = F.col("keeper").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("keeper")) | (F.col("place") > 1))
    return joined.withColumn("place", F.row_number().over(place)).select(
        "page_id", "url", "payload_bytes", "payload_digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("keeper")).alias("refers_to"),
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes planned records to archives in ``folder``; returns the list of archives.

    Each task writes its own archives of about ``archive_bytes`` of payload, under names no
    other attempt uses.  Only archives of committed tasks are in the list, so a lost executor
    leaves at most a file nobody refers to.  A task holds one archive in memory.
    """
    def write(batches):
        fs, root = local_form(folder)
        fs.create_dir(root, recursive=True)
        held, size, done = [], 0, []
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{uuid.uuid4().hex}" if task else uuid.uuid4().hex
        for batch in batches:
            for row in batch.to_pylist():
                held.append(record_bytes(row))
                size += len(held[-1])
                if size >= archive_bytes:
                    done.append(_store(fs, root, f"{name}-{len(done):04d}.warc.zst", held))
                    held, size = [], 0
        if held:
            done.append(_store(fs, root, f"{name}-{len(done):04d}.warc.zst", held))
        yield pa.RecordBatch.from_pylist(done, pa.schema([
            ("path", pa.string()), ("records", pa.int64()), ("payload_bytes", pa.int64()), ("stored_bytes", pa.int64())]))

    return stored(records.mapInArrow(write, WRITTEN), "archives")


def _store(fs, root: str, name: str, records: list[bytes]) -> dict:
    import zstandard

    dictionary = build_dictionary(records)
    data = dictionary.as_bytes()
    packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
    total = 8 + len(data)
    # The name's ending must not make the file system compress the stream once more.
    with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(data)) + data)
        for record in records:
            frame = packer.compress(record)
            out.write(frame)
            total += len(frame)
    return {"path": f"{root}/{name}", "records": len(records), "payload_bytes": sum(map(len, records)), "stored_bytes": total}


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, training_bytes: int = TRAINING_BYTES):
    """Dictionary from an archive's records, evenly spaced up to ``training_bytes``; a small archive gets a small one.

    The bound only affects how well records compress.  Where the records are too few or too
    small for training, their own bytes serve as a raw dictionary.
    """
    import zstandard

    total = sum(map(len, records))
    size = max(1 << 10, min(size, total // 32))
    samples = [r[:training_bytes] for r in records[:: max(1, -(-total // training_bytes))]]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _header(text: str) -> str:
    """Header values are single lines: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _urn(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def record_bytes(row: dict) -> bytes:
    """One WARC record; a revisit carries the HTTP header but no payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http + (row["payload"] or b"")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_urn(row['page_id'])}",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_header(row['url'])}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(row['refers_to'])}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Reads listed archives back, one row per record; digests of responses are computed anew.

    A response whose payload does not match its recorded digest raises.
    """
    spark: SparkSession = archives.sparkSession

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for row in archive_records(path):
                    size += len(row["payload"] or b"")
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) >= 2000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_RECORDS)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, ARROW_RECORDS)

    width = max(1, min(archives.count(), 10 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return archives.select("path").repartition(width).mapInArrow(read, RECORDS)


ARROW_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def archive_records(path: str):
    """Streams an archive's records as dictionaries."""
    import zstandard

    fs, inner = local_form(path)
    with fs.open_input_stream(inner, compression=None) as source:
        magic, length = struct.unpack("<II", source.read(8))
        if magic != SKIPPABLE_MAGIC:
            raise ValueError(f"{path}: no dictionary frame")
        data = source.read(length)
        kind = zstandard.DICT_TYPE_FULLDICT if data.startswith(DICTIONARY_MAGIC) else zstandard.DICT_TYPE_RAWCONTENT
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind))
        rest, ended = b"", False
        frame, parts = unpacker.decompressobj(), []
        while not ended or rest:
            if not rest:
                rest = source.read(READ_BYTES)
                ended = not rest
                if ended:
                    break
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
            if frame.eof:
                yield parse_record(b"".join(parts))
                frame, parts = unpacker.decompressobj(), []
        if any(parts):
            raise ValueError(f"{path}: last record is cut off")


def parse_record(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: payload and digest differ")

    def key(text):
        digits = text.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    return {
        "page_id": key(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": length,
        "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": key(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload,
    }


def archive_pages(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Writes pages to archives in ``folder`` (default: a new shared one) and reads them back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages, **columns), folder), payloads=False)
