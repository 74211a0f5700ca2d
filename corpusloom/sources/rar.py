"""What RAR archives hold, read from their headers: no member is decompressed, and no other program is needed.

An archive is a signature and a chain of blocks, each a header with a checksum and perhaps an area of data that is skipped.
Both formats are walked: the older one with fields of fixed width, and that of version 5 with integers of variable
length. Members that are stored rather than compressed are read out as they are. An archive whose headers are encrypted,
damaged or cut off fails as a whole, as does one whose members' data end behind it."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

# Signatures; block types and flags of both formats.
OLD, NEW = b"Rar!\x1a\x07\x00", b"Rar!\x1a\x07\x01\x00"
_OLD_MAIN, _OLD_FILE, _OLD_END = 0x73, 0x74, 0x7B
_OLD_FROM_BEFORE, _OLD_GOES_ON, _OLD_ENCRYPTED, _OLD_DIRECTORY, _OLD_LARGE, _OLD_UNICODE, _OLD_HAS_DATA, _OLD_LOCKED = 0x01, 0x02, 0x04, 0xE0, 0x100, 0x200, 0x8000, 0x80
_MAIN, _FILE, _LOCKED, _END = 1, 2, 4, 5
_HAS_EXTRA, _HAS_DATA, _FROM_BEFORE, _GOES_ON = 0x01, 0x02, 0x08, 0x10
_DIRECTORY, _HAS_TIME, _HAS_CRC, _SIZE_UNKNOWN = 0x01, 0x02, 0x04, 0x08
_ENCRYPTION, _OLD_STORED = 1, 0x30

INVENTORY = "path string, format string, member string, size long, packed long, method int, crc32 long, directory boolean, encrypted boolean, split boolean, content binary, error string"
_NAMES = [c.split()[0] for c in INVENTORY.split(", ")]
FRAME_BYTES, FRAME_ROWS = 8 << 20, 1000


class Broken(ValueError):
    """An archive that can't be read; the text says why."""


@dataclass
class Member:
    name: str
    size: int | None
    packed: int
    method: int
    crc32: int | None
    directory: bool
    encrypted: bool
    split: bool
    content: bytes | None


class _Bytes:
    """A header's fields, one after the other."""

    def __init__(self, data: bytes, at: int = 0, end: int | None = None) -> None:
        self.data, self.at, self.end = data, at, len(data) if end is None else end

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > self.end:
            raise Broken("cut off")
        self.at += n
        return self.data[self.at - n : self.at]

    def fixed(self, layout: str) -> tuple[int, ...]:
        return struct.unpack("<" + layout, self.take(struct.calcsize("<" + layout)))

    def varied(self) -> int:
        """Seven bits a byte, the lowest first; the highest bit says that more follow."""
        out = 0
        for shift in range(0, 70, 7):
            b = self.take(1)[0]
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out
        raise Broken("number too long")


def _data(content: bytes, at: int, size: int) -> bytes:
    if at + size > len(content):
        raise Broken("cut off")
    return content[at : at + size]


def _stored(data: bytes, stored: bool, crc: int | None, split: bool, encrypted: bool, directory: bool) -> bytes | None:
    if not stored or split or encrypted or directory:
        return None
    if crc is not None and zlib.crc32(data) != crc:
        raise Broken("checksum of a member")
    return data


def _new_members(content: bytes) -> Iterator[Member]:
    at = len(NEW)
    while at < len(content):
        crc = struct.unpack("<I", _data(content, at, 4))[0]
        sized = _Bytes(content, at + 4)
        size = sized.varied()
        header = _Bytes(content, sized.at, sized.at + size)
        if zlib.crc32(_data(content, at + 4, sized.at - at - 4 + size)) != crc:
            raise Broken("checksum of a header")
        kind, flags = header.varied(), header.varied()
        extra = header.varied() if flags & _HAS_EXTRA else 0
        packed = header.varied() if flags & _HAS_DATA else 0
        data_at = sized.at + size
        data = _data(content, data_at, packed)
        if kind == _LOCKED:
            raise Broken("encrypted")
        if kind == _END:
            return
        if kind == _FILE:
            is_, unpacked, _ = header.varied(), header.varied(), header.varied()
            if is_ & _HAS_TIME:
                header.fixed("I")
            of = header.fixed("I")[0] if is_ & _HAS_CRC else None
            method, _ = header.varied() >> 7 & 7, header.varied()
            name = header.take(header.varied()).decode("utf-8", errors="replace")
            encrypted = _ENCRYPTION in _extra_kinds(content, data_at - extra, data_at)
            split, directory = bool(flags & (_FROM_BEFORE | _GOES_ON)), bool(is_ & _DIRECTORY)
            whole = _stored(data, method == 0, of, split, encrypted, directory)
            yield Member(name, None if is_ & _SIZE_UNKNOWN else unpacked, packed, method, of, directory, encrypted, split, whole)
        at = data_at + packed


def _extra_kinds(content: bytes, at: int, end: int) -> set[int]:
    out, record = set(), _Bytes(content, at, end)
    while record.at < end:
        size = record.varied()
        last = record.at + size
        out.add(record.varied())
        if not record.at <= last <= end:
            raise Broken("cut off")
        record.at = last
    return out


def _old_members(content: bytes) -> Iterator[Member]:
    at = len(OLD)
    while at < len(content):
        header = _Bytes(content, at)
        crc, kind, flags, size = header.fixed("HBHH")
        if size < 7 or zlib.crc32(_data(content, at, size)[2:]) & 0xFFFF != crc:
            raise Broken("checksum of a header")
        header.end = at + size
        packed = 0
        if kind == _OLD_MAIN and flags & _OLD_LOCKED:
            raise Broken("encrypted")
        if kind == _OLD_END:
            return
        if kind == _OLD_FILE:
            packed, unpacked, _, of, _, _, method, length, _ = header.fixed("IIBIIBBHI")
            if flags & _OLD_LARGE:
                more = header.fixed("II")
                packed, unpacked = packed | more[0] << 32, unpacked | more[1] << 32
            name = _old_name(header.take(length), bool(flags & _OLD_UNICODE))
            encrypted, split = bool(flags & _OLD_ENCRYPTED), bool(flags & (_OLD_FROM_BEFORE | _OLD_GOES_ON))
            directory = flags & _OLD_DIRECTORY == _OLD_DIRECTORY
            whole = _stored(_data(content, at + size, packed), method == _OLD_STORED, of, split, encrypted, directory)
            yield Member(name.replace("\\", "/"), unpacked, packed, method - _OLD_STORED, of, directory, encrypted, split, whole)
        elif flags & _OLD_HAS_DATA:
            packed = header.fixed("I")[0]
            _data(content, at + size, packed)
        at += size + packed


def _old_name(raw: bytes, unicode: bool) -> str:
    """A name in the archive's code page or UTF-8; or followed by its UTF-16 units, packed: two bits tell of each whether it is a
    byte, a byte with the common high byte, two bytes, or a run of the plain name."""
    plain, zero, packed = raw.partition(b"\0")
    if not unicode or not zero:
        try:
            return raw.decode("utf-8") if unicode else raw.decode("ascii")
        except UnicodeDecodeError:
            return raw.decode("cp437")
    units: list[int] = []
    source = _Bytes(packed)
    try:
        high, bits = source.take(1)[0] << 8, []
        while source.at < source.end:
            if not bits:
                b = source.take(1)[0]
                bits = [b & 3, b >> 2 & 3, b >> 4 & 3, b >> 6]
            how = bits.pop()
            if how < 3:
                low = source.take(1)[0]
                units.append(low | (0, high, source.take(1)[0] << 8 if how == 2 else 0)[how])
                continue
            n = source.take(1)[0]
            add = source.take(1)[0] if n & 0x80 else None
            for _ in range((n & 0x7F) + 2):
                c = plain[len(units)] if len(units) < len(plain) else 0
                units.append(c if add is None else (c + add & 0xFF) | high)
    except Broken:
        return plain.decode("cp437")
    return b"".join(struct.pack("<H", u) for u in units).decode("utf-16-le", errors="replace")


def members_of(content: bytes | None) -> list[Member]:
    """All members; raises Broken."""
    content = content or b""
    if content.startswith(NEW):
        return list(_new_members(content))
    if content.startswith(OLD):
        return list(_old_members(content))
    raise Broken("no archive")


def _zip_members(content: bytes) -> list[Member]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            infos = z.infolist()
    except (zipfile.BadZipFile, NotImplementedError, OSError, ValueError, EOFError, struct.error) as e:
        raise Broken(type(e).__name__) from e
    return [Member(i.filename, i.file_size, i.compress_size, i.compress_type, i.CRC, i.is_dir(), bool(i.flag_bits & 1), False, None) for i in infos]


def _rows(path: str, content: bytes | None) -> Iterator[tuple]:
    kind = "rar" if (content or b"").startswith(b"Rar!") else "zip" if (content or b"").startswith(b"PK") else None
    try:
        found = _zip_members(content) if kind == "zip" else members_of(content)
    except Broken as e:
        yield path, kind, *[None] * 9, f"archive_failed: {e}"
        return
    for m in found:
        error = "archive_failed: encrypted member" if m.encrypted else None
        yield path, kind, m.name, m.size, m.packed, m.method, m.crc32, m.directory, m.encrypted, m.split, m.content, error


def _inventory(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for f in frames:
        for path, content in zip(f["path"], f["content"]):
            for row in _rows(path, content):
                held.append(row)
                size += len(row[10] or b"")
                if size >= FRAME_BYTES or len(held) >= FRAME_ROWS:
                    yield _frame(held)
                    held, size = [], 0
    if held:
        yield _frame(held)


def _frame(held: list[tuple]) -> pd.DataFrame:
    kinds = {"size": "Int64", "packed": "Int64", "method": "Int32", "crc32": "Int64", "directory": "boolean", "encrypted": "boolean", "split": "boolean"}
    return pd.DataFrame(held, columns=_NAMES).astype(kinds)


def inventory(archives: DataFrame) -> DataFrame:
    """archives(path, content) -> a row for each member of ZIP and RAR archives, folders too, with sizes and checksums as declared.

    content holds members that a RAR archive stores uncompressed; those of ZIP archives are read by archive_members(). An encrypted
    member is listed and has an error. An archive that is damaged, cut off, encrypted as a whole or none is one row with its error,
    as is a null; an empty one has no rows."""
    return archives.select("path", "content").mapInPandas(_inventory, INVENTORY)
