"""RAR archives of stored members, made field by field for queries and tests, and the inventory of archives."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..sources import rar, readers
from .catalog import query
from .fixtures import PATHS, dealt


def _varied(n: int) -> bytes:
    out = b""
    while n >= 0x80:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _new_block(*fields: int, tail: bytes = b"") -> bytes:
    header = b"".join(map(_varied, fields)) + tail
    sized = _varied(len(header)) + header
    return struct.pack("<I", zlib.crc32(sized)) + sized


def new_archive(members: list[tuple[str, bytes]], method: int = 0, encrypted: bool = False, locked: bool = False) -> bytes:
    """An archive of format 5. locked: its headers claim to be encrypted."""
    out = rar.NEW + (_new_block(4, 0, 0, 0, 15) if locked else b"") + _new_block(1, 0, 0)
    for name, data in members:
        raw, extra = name.encode(), b"\x02\x01\x00" if encrypted else b""
        fields = (2, 3, len(extra), len(data)) if extra else (2, 2, len(data))
        tail = struct.pack("<II", 0, zlib.crc32(data)) + _varied(method << 7) + b"\x01" + _varied(len(raw)) + raw + extra
        out += _new_block(*fields, 6, len(data), 0, tail=tail) + data
    return out + _new_block(5, 4, 0)


def _old_block(kind: int, flags: int, body: bytes) -> bytes:
    head = struct.pack("<BHH", kind, flags, 7 + len(body)) + body
    return struct.pack("<H", zlib.crc32(head) & 0xFFFF) + head


def old_archive(members: list[tuple[str, bytes]], method: int = 0, encrypted: bool = False, locked: bool = False) -> bytes:
    """An archive of the older format."""
    out = rar.OLD + _old_block(0x73, 0x80 if locked else 0, bytes(6))
    for name, data in members:
        raw = name.encode()
        body = struct.pack("<IIBIIBBHI", len(data), len(data), 3, zlib.crc32(data), 0, 29, 0x30 + method, len(raw), 0) + raw
        out += _old_block(0x74, 0x8000 | 0x200 | (4 if encrypted else 0), body) + data
    return out + _old_block(0x7B, 0x4000, b"")


@F.pandas_udf(BinaryType())
def _rars(kinds: pd.Series, names: pd.Series, texts: pd.Series) -> pd.Series:
    def one(kind: int, ns: list[str], ts: list[str]) -> bytes:
        found = (new_archive if kind % 2 else old_archive)([(n, t.encode()) for n, t in zip(ns, ts)], locked=kind == 5)
        return found[:-20] + b"?" + found[-19:] if kind == 4 else found

    return pd.Series([one(*x) for x in zip(kinds, names, texts)])


#: Of six RAR archives one is damaged (4) and one is encrypted (5); they are of both formats in turn.
@query(f"""WITH f AS (SELECT *, {PATHS} AS path FROM part), a AS (SELECT *, p_partkey // 11 % 6 AS kind, regexp_matches(path, '\\.rar$') AS rar FROM f WHERE regexp_matches(path, '\\.(zip|rar)$')),
m AS (SELECT path, rar, unnest(['top/a.txt', 'top/' || p_partkey || '.txt']) AS member, unnest([p_name, p_brand]) AS text FROM a WHERE NOT rar OR kind < 4)
SELECT path, CASE WHEN rar THEN 'rar' ELSE 'zip' END AS format, member, strlen(text) AS size, CASE WHEN rar THEN sha1(text) END AS content_sha1, NULL AS error FROM m
UNION ALL SELECT path, 'rar', NULL, NULL, NULL, CASE kind WHEN 4 THEN 'archive_failed: checksum of a header' ELSE 'archive_failed: encrypted' END FROM a WHERE rar AND kind >= 4""")
def archive_inventory(spark, sf_dir):
    found = dealt(spark, sf_dir, "part", "p_partkey").withColumn("path", F.expr(PATHS)).where(F.col("path").rlike(r"\.(zip|rar)$"))
    names, texts = F.expr("array('top/a.txt', 'top/' || p_partkey || '.txt')"), F.array("p_name", "p_brand")
    is_rar = F.col("path").endswith(".rar")
    made = found.where(is_rar).select("path", _rars(F.expr("p_partkey DIV 11 % 6"), names, texts).alias("content"))
    zips = found.where(~is_rar).select("path", readers.zipped(names, texts).alias("content"))
    return rar.inventory(made.unionAll(zips)).select("path", "format", "member", "size", F.sha1("content").alias("content_sha1"), "error")
