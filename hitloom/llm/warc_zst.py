"""Zstandard-compressed WARC archives: a dictionary in front, one frame for each record."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = struct.pack("<I", 0xEC30A437)
FRAME_MAGIC = struct.pack("<I", 0xFD2FB528)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payload bytes after which an archive is closed, and of the sample its dictionary is trained on.
ARCHIVE_BYTES = 4 << 20
SAMPLE_BYTES = 256 << 10
DICTIONARY_BYTES = 16 << 10
DATE = "2020-01-01T00:00:00Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_value(text: str) -> str:
    """A value that stays in its line: control characters are percent-encoded."""
    return "".join(c if ord(c) >= 32 and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit (`refers_to` given) has the HTTP header without the payload."""
    digest = sha1_base32(payload)
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def make_archive(records: list[bytes]) -> bytes:
    """Skippable frame with the (compressed) dictionary, then a frame with its content size per record."""
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample += [r[i : i + 2048] for i in range(0, min(len(r), SAMPLE_BYTES), 2048)]
        size += len(r)
    try:
        found = zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8)
        raw = found.as_bytes()
    except zstandard.ZstdError:  # too few bytes to train on: their start is a plain-content dictionary
        raw = b"".join(sample)[:DICTIONARY_BYTES] + bytes(8)
        found = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    stored = zstandard.ZstdCompressor(level=3).compress(raw)
    packer = zstandard.ZstdCompressor(level=3, dict_data=found, write_content_size=True, write_checksum=True)
    return b"".join(
        [struct.pack("<II", DICTIONARY_FRAME, len(stored)), stored, *[packer.compress(r) for r in records]]
    )


def frames(content: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive; raises ValueError where the archive breaks its format."""
    if len(content) < 8:
        raise ValueError("archive without a dictionary frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_FRAME or 8 + size > len(content):
        raise ValueError("archive without a dictionary frame")
    raw = content[8 : 8 + size]
    if raw.startswith(FRAME_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    kind = zstandard.DICT_TYPE_FULLDICT if raw.startswith(DICTIONARY_MAGIC) else zstandard.DICT_TYPE_RAWCONTENT
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    view, at, step = memoryview(content), 8 + size, 1 << 14
    while at < len(view):
        frame, out, used = reader.decompressobj(), [], 0
        while not frame.eof:
            piece = view[at + used : at + used + step]
            if not piece:
                raise ValueError("the last frame is cut off")
            try:
                out.append(frame.decompress(piece))
            except zstandard.ZstdError as e:
                raise ValueError(f"broken frame: {e}") from e
            used += len(piece)
        at += used - len(frame.unused_data)
        yield b"".join(out)


def read_record(record: bytes) -> dict:
    """Header fields and payload of a record; raises ValueError unless version, the mandatory fields,
    both lengths, the digests and the record's end are right."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.strip().lower() in fields:
            raise ValueError(f"bad header line {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"record without {name}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4:
        raise ValueError("Content-Length is not the length of the block")
    block = rest[:-4]
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("record does not end in two empty lines")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != "sha1:" + sha1_base32(block):
        raise ValueError("block digest is wrong")
    http, sep, payload = block.partition(b"\r\n\r\n")
    sent = {
        k.strip().lower(): v.strip()
        for k, _, v in (line.partition(":") for line in http.decode("latin-1").split("\r\n")[1:])
    }
    if not sep or not sent.get("content-length", "").isdigit():
        raise ValueError("block without an HTTP header")
    kind, size = fields["warc-type"], int(sent["content-length"])
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size or digest != sha1_base32(payload):
            raise ValueError("payload length or digest is wrong")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise ValueError("revisit with a payload or without its target")
    else:
        raise ValueError(f"unknown record type {kind}")

    def page(name: str) -> int | None:
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return None if text in ("", "null") else int(text)

    return {
        "page_id": page("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def plan_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """(page_id, url, payload, refers_to): null `refers_to` means response.

    The largest id of each payload is found by digest with sums before the shuffle; pages meet it by
    an equality join on the digest, whose hot keys adaptive execution splits.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    best = rows.filter(F.length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("best"))
    revisit = F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return rows.join(best, "digest", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("best")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """(archive, content): archives of some `ARCHIVE_BYTES`, a record for each page.

    The payload is the UTF-8 text or binary (null: empty). Among pages of equal payload of at least
    `min_bytes` that of the largest id is the response and the others revisit it; rows that repeat this
    id are responses too, and a null id revisits an id that is not null. The dictionary is trained in
    the task on the first `SAMPLE_BYTES` of its archive. ``url`` goes to the record if there is such a
    column; other columns are left out. An empty table gives no archive. A task that runs again writes
    the same archive names.

    Rows of this table are files: ``.warc.zst`` when written out one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        records, size = [], 0

        def close() -> pa.RecordBatch:
            nonlocal made, records, size
            name, content = f"part-{part:05d}-{made:05d}.warc.zst", make_archive(records)
            made, records, size = made + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([content], pa.binary())], names=["archive", "content"]
            )

        for batch in batches:
            for k in range(batch.num_rows):
                page_id, url, payload, refers_to = (c[k].as_py() for c in batch.columns)
                records.append(make_record(page_id, url, bytes(payload), refers_to))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
        if records:
            yield close()

    return plan_revisits(pages, id_col, payload_col, min_bytes).mapInArrow(run, "archive string, content binary")


def read_archives(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """Every record of every archive; the table may come from ``spark.read.format("binaryFile")`` too.

    Raises where an archive or a record breaks its format. A null content holds no records.
    """

    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary"
    )
    types = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                if data is not None:
                    found = [read_record(r) for r in frames(data)]
                    yield pa.RecordBatch.from_pylist(found, schema=types)

    return archives.select(F.col(content_col).alias("content")).mapInArrow(run, schema)
