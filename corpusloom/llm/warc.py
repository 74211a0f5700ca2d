"""Operator 4, WARC archives compressed by Zstandard with a dictionary.

An archive starts with a skippable frame that holds its dictionary; each record follows as a frame of its own. The
reader loads the dictionary, decodes frame by frame and validates what it finds: magic numbers, the frame's content
size and checksum, the version line, mandatory headers, block and payload lengths, and both digests.

Equal payloads are written once: the record of the largest id is a response, others are revisits that refer to it.
Only ids and hashes are grouped for that; the payloads are dealt by id, so that a payload which a third of all pages
share is written from many tasks. Writers give their archives names of their own and hand the names on as rows of a
stored table: what a lost or repeated task leaves behind is never read."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, mapped, scratch, stored, table

#: Fixed values of the format.
DICTIONARY_MAGIC, FRAME_MAGIC, SKIPPABLE = 0x184D2A5D, 0xFD2FB528, range(0x184D2A50, 0x184D2A60)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

#: Uncompressed bytes in an archive; bytes of a dictionary and of the records that it is trained on.
ARCHIVE_BYTES, DICTIONARY_BYTES, TRAINED_BYTES = 16 << 20, 32 << 10, 2 << 20
LEVEL, DATE = 3, "1970-01-01T00:00:00Z"
_URN = "urn:corpusloom:page:"


class CorruptArchive(ValueError):
    """An archive, frame or record isn't what its headers say."""


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<{_URN}{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of the page that is referred to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "urn:none", safe="%/:?#[]@!$&'()*+,;=~-._")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The records as frames, after the dictionary's frame; without one, if there is too little to train it on."""
    samples, size = [], 0
    for r in records:
        if size >= TRAINED_BYTES:
            break
        samples.append(r[: 1 << 16])
        size += len(samples[-1])
    out, trained = [], None
    if len(samples) >= 16 and size >= 4 * DICTIONARY_BYTES:
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
        except zstandard.ZstdError:
            trained = None
    if trained:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True, write_checksum=True)
    return b"".join(out + [compressor.compress(r) for r in records])


def frames(data: bytes) -> Iterator[bytes]:
    """The content of each frame; the dictionary in the leading skippable frame, if there is one, serves them all."""
    at, trained, view = 0, None, memoryview(data)
    while at < len(data):
        if len(data) - at < 8:
            raise CorruptArchive(f"{len(data) - at} bytes after the last frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(data):
                raise CorruptArchive("a skippable frame is longer than the archive")
            if magic == DICTIONARY_MAGIC and at == 0:
                body = data[8 : 8 + size]
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompress(body)
                trained = zstandard.ZstdCompressionDict(body)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise CorruptArchive(f"no frame at byte {at}")
        try:
            stated = zstandard.get_frame_parameters(data[at : at + 18]).content_size
            one, content, fed = zstandard.ZstdDecompressor(dict_data=trained).decompressobj(), [], at
            while not one.eof:
                if fed >= len(data):
                    raise CorruptArchive("the last frame is cut off")
                content.append(one.decompress(view[fed : fed + (1 << 16)]))
                fed = min(len(data), fed + (1 << 16))
        except zstandard.ZstdError as e:
            raise CorruptArchive(f"frame at byte {at}: {e}") from e
        content = b"".join(content)
        if stated not in (zstandard.CONTENTSIZE_UNKNOWN, len(content)):
            raise CorruptArchive(f"a frame of {stated} bytes holds {len(content)}")
        yield content
        at = fed - len(one.unused_data)


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of the one record in a frame, validated."""
    head, sep, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise CorruptArchive(f"not a record: {content[:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise CorruptArchive(f"not a header: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    if missing := [n for n in MANDATORY if n.lower() not in headers]:
        raise CorruptArchive(f"a record lacks {', '.join(missing)}")
    if not headers["content-length"].isdigit():
        raise CorruptArchive("Content-Length isn't a number")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise CorruptArchive(f"a block of {size} bytes is followed by something else than the record's end")
    block = rest[:size]
    if headers.get("warc-block-digest", "sha1:" + digest_of(block)) != "sha1:" + digest_of(block):
        raise CorruptArchive("a block doesn't have its digest")
    return headers, block


def read_record(content: bytes) -> dict:
    """page_id, url, payload (None for revisits), payload_bytes, payload_digest, record_type, refers_to."""
    headers, block = parsed(content)
    http, sep, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not sep or not http.startswith(b"HTTP/") or not size:
        raise CorruptArchive("a block isn't a response with its length")
    kind, stated = headers["warc-type"], headers.get("warc-payload-digest", "")
    number = lambda v: None if v.endswith(":none>") else int(v.removeprefix(f"<{_URN}").removesuffix(">"))
    if kind == "revisit":
        if payload or "warc-refers-to" not in headers or headers.get("warc-profile") != PROFILE:
            raise CorruptArchive("a revisit has a payload or refers to nothing")
    elif kind != "response":
        raise CorruptArchive(f"a record of type {kind}")
    elif len(payload) != int(size[1]) or stated != f"sha1:{digest_of(payload)}":
        raise CorruptArchive("a payload doesn't have its length or digest")
    return {
        "page_id": number(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "payload": payload if kind == "response" else None, "payload_bytes": int(size[1]),
        "payload_digest": stated.removeprefix("sha1:"), "record_type": kind, "refers_to": number(headers["warc-refers-to"]) if kind == "revisit" else None,
    }


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


_ARCHIVES = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """pages(page_id, url, html, ...) -> archive, records, bytes: one row per archive that was written under folder.

    Of payloads that are equal and have at least so many bytes, that of the largest page_id is a response, others are
    revisits. A null html is an empty payload. A null page_id is a response of its own. Rows that repeat both id and
    payload are records each. Payloads of any length are written whole. What is known of payloads that recur is stored before it
    is joined back, so that a hot one can be split. Other columns are not looked at; without rows nothing is written."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    known = rows.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("page_id", "sha")
    keepers = stored(known.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to").drop("least"), "keepers")
    revisits = known.distinct().join(keepers, "sha").where("page_id <> refers_to")
    typed = rows.join(revisits, ["page_id", "sha"], "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        held: list[bytes] = []
        size = 0

        def written() -> pa.RecordBatch:
            data, path = archive(held), f"pages-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/{path}") as out:
                out.write(data)
            return batch(_ARCHIVES, {"archive": [f"{folder}/{path}"], "records": [len(held)], "bytes": [len(data)]})

        store.create_dir(base, recursive=True)
        for given in batches:
            columns = [c.to_pylist() for c in given.columns]
            for page_id, url, html, refers_to in zip(*columns):
                held.append(record(page_id, url, html.encode(), refers_to))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield written()
                    held, size = [], 0
        if held:
            yield written()

    return stored(typed.transform(mapped, run, "archive string, records long, bytes long"), "archives")


_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """archives(archive, ...) -> page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for path in given.column(0).to_pylist():
                store, at = opened(path)
                with store.open_input_stream(at) as f:
                    data = f.read()
                out: dict = {n: [] for n in _RECORDS.names}
                size = 0
                for content in frames(data):
                    for name, value in read_record(content).items():
                        out[name].append(value if payloads or name != "payload" else None)
                    size += len(content)
                    if size > 1 << 22:
                        yield batch(_RECORDS, out)
                        out, size = {n: [] for n in _RECORDS.names}, 0
                yield batch(_RECORDS, out)

    parts = max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return archives.select("archive").repartition(parts, "archive").transform(mapped, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def op4_warc_round_trip(spark, sf_dir):
    archives = write_archives(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read_archives(archives, payloads=False).drop("url", "payload")


#: The same digests and references without an archive.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(p.h, 1 + 5 * CAST(i // 4 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN k.keeper = p.page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to
FROM p JOIN k USING (h)
"""
