"""RAR headers: blocks as real archives hold them, archives of both formats built field by field, and damaged ones."""

import struct
import zipfile
import zlib
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from corpusloom.plans.archives import new_archive, old_archive
from corpusloom.sources import rar

#: Blocks that archivers write with the same bytes into most archives.
NEW_END = bytes.fromhex("1d775651 03 05 04 00")
NEW_MAIN = bytes.fromhex("3392b5e5 0a 01 05 06 00 05 01 01 80 80 00")
OLD_END = bytes.fromhex("c43d 7b 0040 0700")
OLD_MAIN = bytes.fromhex("cf90 73 0000 0d00 000000000000")


def test_blocks_of_real_archives():
    assert rar.members_of(rar.NEW + NEW_MAIN + NEW_END) == [] and rar.members_of(rar.OLD + OLD_MAIN + OLD_END) == []
    for signature, blocks in ((rar.NEW, NEW_MAIN + NEW_END), (rar.OLD, OLD_MAIN + OLD_END)):
        for k in range(len(blocks) - 1):  # a changed byte is seen, whichever it is
            with pytest.raises(rar.Broken):
                rar.members_of(signature + blocks[:k] + bytes([blocks[k] ^ 0x11]) + blocks[k + 1 :])


@pytest.mark.parametrize("make", [new_archive, old_archive])
def test_members(make):
    content = make([("a/b.txt", b"text"), ("ü 漢.bin", b"\x00" * 300), ("empty", b"")])
    got = rar.members_of(content)
    assert [(m.name, m.size, m.packed, m.method, m.crc32, m.content) for m in got] == [("a/b.txt", 4, 4, 0, zlib.crc32(b"text"), b"text"), ("ü 漢.bin", 300, 300, 0, zlib.crc32(b"\x00" * 300), b"\x00" * 300), ("empty", 0, 0, 0, 0, b"")]
    for cut in (len(content) - 40, len(content) // 2, 9):
        with pytest.raises(rar.Broken):
            rar.members_of(content[:cut])
    at = content.index(b"text")
    with pytest.raises(rar.Broken):
        rar.members_of(content[:at] + b"next" + content[at + 4 :])


@pytest.mark.parametrize("make", [new_archive, old_archive])
def test_compressed_encrypted_and_locked(make):
    packed = rar.members_of(make([("a", b"xyz")], method=3))[0]
    assert (packed.method, packed.packed, packed.content) == (3, 3, None)
    secret = rar.members_of(make([("a", b"xyz")], encrypted=True))[0]
    assert secret.encrypted and secret.content is None
    with pytest.raises(rar.Broken, match="encrypted"):
        rar.members_of(make([("a", b"xyz")], locked=True))


def old_file(name, flags):
    body = struct.pack("<IIBIIBBHI", 0, 0, 2, 0, 0, 29, 0x30, len(name), 0) + name
    head = struct.pack("<BHH", 0x74, flags, 7 + len(body)) + body
    return rar.OLD + OLD_MAIN + struct.pack("<H", zlib.crc32(head) & 0xFFFF) + head + OLD_END


@pytest.mark.parametrize(
    "raw,flags,want",
    [
        (b"plain.txt", 0, "plain.txt"),
        (b"a\\b", 0, "a/b"),
        (b"\x81.txt", 0, "ü.txt"),
        ("ü.txt".encode(), 0x200, "ü.txt"),
        (b"ab\0" + bytes([0x04, 0b00_01_10_00, 0x61, 0x10, 0x42, 0x4E, 0x7A]), 0x200, "aА乂z"),
        (b"?bcd.txt\0" + bytes([0x04, 0b01_11_00_00, 0x10, 0x05]), 0x200, "Аbcd.txt"),
        (b"abc\0" + bytes([0x04, 0b11_00_00_00, 0x81, 0x01]), 0x200, "ѢѣѤ"),
        (b"abc\0" + bytes([0x04, 0b10_00_00_00, 0x81]), 0x200, "abc"),
    ],
)
def test_old_names(raw, flags, want):
    assert rar.members_of(old_file(raw, flags))[0].name == want


def test_folders_and_large_files():
    assert rar.members_of(old_file(b"d", 0xE0))[0].directory
    with pytest.raises(rar.Broken):  # a member of 2^40 bytes that the archive doesn't hold
        body = struct.pack("<IIBIIBBHIII", 0, 0, 2, 0, 0, 29, 0x31, 1, 0, 256, 256) + b"x"
        head = struct.pack("<BHH", 0x74, 0x100, 7 + len(body)) + body
        rar.members_of(rar.OLD + OLD_MAIN + struct.pack("<H", zlib.crc32(head) & 0xFFFF) + head + OLD_END)


def test_inventory(spark):
    data = BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("d/", "")
        z.writestr("d/x", "x" * 100)
    rows = [("z", data.getvalue()), ("r", new_archive([("m", b"1")])), ("e", new_archive([("m", b"1")], encrypted=True)), ("l", old_archive([], locked=True)), ("n", None), ("t", b"Rar!"), ("o", rar.NEW + NEW_MAIN + NEW_END), ("c", data.getvalue()[:50])]
    df = spark.createDataFrame(rows, "path string, content binary").withColumn("member", F.lit("clash"))
    got = {}
    for r in rar.inventory(df).collect():
        got.setdefault(r.path, []).append((r.format, r.member, r.size, r.directory, r.error))
    assert got == {
        "z": [("zip", "d/", 0, True, None), ("zip", "d/x", 100, False, None)],
        "r": [("rar", "m", 1, False, None)],
        "e": [("rar", "m", 1, False, "archive_failed: encrypted member")],
        "l": [("rar", None, None, None, "archive_failed: encrypted")],
        "n": [(None, None, None, None, "archive_failed: no archive")],
        "t": [("rar", None, None, None, "archive_failed: no archive")],
        "c": [("zip", None, None, None, "archive_failed: BadZipFile")],
    }
    assert rar.inventory(df.limit(0)).collect() == []
