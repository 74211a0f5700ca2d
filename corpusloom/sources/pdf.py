"""PDF files as rows: pages, text blocks with their places, and tables that are ruled by lines.

What a task does for a file is small and bounded by the file: it follows the cross-references (tables or streams, or, where
they are damaged, the objects themselves), unpacks a page's content, and follows its operators as far as they place text,
draw lines or show images. Rows leave page by page. What is made of the rows, such as routes, scans, what lies outside
tables, Markdown, is the business of the operators over pages and tables.

Encrypted files are rows with an error. Text of fonts that say nothing of its characters is replaced by U+FFFD."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEMS = "path string, pages int, page int, kind string, n int, row_no int, col_no int, x0 double, y0 double, x1 double, y1 double, text string, error string"
_NAMES = [c.split()[0] for c in ITEMS.split(", ")]
FRAME_ROWS, MOST_DEPTH, SNAP, THIN = 2000, 12, 3.0, 3.0

Matrix = tuple[float, float, float, float, float, float]
ONE: Matrix = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


class Broken(ValueError):
    """A file that can't be read; the text says why."""


@dataclass(frozen=True)
class Ref:
    number: int


class Name(str):
    __slots__ = ()


class Word(str):
    """An operator, or a keyword of a file."""

    __slots__ = ()


@dataclass
class Stream:
    about: dict
    raw: bytes


_SPACE = re.compile(rb"(?:[\x00\t\n\x0c\r ]|%[^\r\n]*)*")
#: White space, then what follows it: a reference (1, 2), a number (3), a name (4), another word (5) or a mark (6).
_TOKEN = re.compile(
    rb"(?:[\x00\t\n\x0c\r ]|%[^\r\n]*)*+(?:(\d+)[\x00\t\n\x0c\r ]+(\d+)[\x00\t\n\x0c\r ]+R(?![^\x00\t\n\x0c\r ()<>\[\]{}/%])"
    rb"|([+-]?(?:\d+\.?\d*|\.\d+))(?![^\x00\t\n\x0c\r ()<>\[\]{}/%])|/([^\x00\t\n\x0c\r ()<>\[\]{}/%]*)|([^\x00\t\n\x0c\r ()<>\[\]{}/%]+)|(<<|>>|[()<>\[\]{}]))?"
)
#: Up to six numbers and the operator that takes them, as most of a page's content is.
_PLAIN = re.compile(rb"[\t\n\x0c\r ]*+((?:[+-]?(?:\d{1,18}+(?:\.\d{0,18}+)?+|\.\d{1,18}+)[\t\n\x0c\r ]++){0,6}+)([A-Za-z*'\"]++)(?![^\x00\t\n\x0c\r ()<>\[\]{}/%])")
#: Words that are objects or end one.
_NO_OPERATORS = frozenset((b"true", b"false", b"R"))
_IMAGE_END = re.compile(rb"[\x00\t\n\x0c\r ]EI(?=[\x00\t\n\x0c\r ]|$)")
#: A usual line of a cross-reference table.
_ENTRY = re.compile(rb"[\t\n\r ]*(\d{10}) \d{5} ([nf])(?=[\t\n\r ])")
#: Characters of a string that mean themselves.
_UNMARKED = re.compile(rb"[^()\\]+")
_OCTAL = re.compile(rb"[0-7]{1,3}")
_CODED = re.compile(rb"#([0-9A-Fa-f]{2})")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


@lru_cache(4096)
def _word(raw: bytes) -> bool | Word:
    return {b"true": True, b"false": False}.get(raw, Word(raw.decode("latin-1")))


@lru_cache(4096)
def _name(raw: bytes) -> Name:
    return Name(_CODED.sub(lambda x: bytes([int(x[1], 16)]), raw).decode("latin-1"))


class Reader:
    """Objects of a byte string, one after the other."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def skip(self) -> None:
        self.at = _SPACE.match(self.data, self.at).end()

    def next(self, depth: int = 0):
        """The next object; None at the end; Word("]") and Word(">>") where an array or a dictionary ends."""
        data, m = self.data, _TOKEN.match(self.data, self.at)
        self.at, kind = m.end(), m.lastindex
        if kind is None:
            return None
        if depth > 100:
            raise Broken("nested too deeply")
        if kind == 3:
            raw = m[3]
            return float(raw) if b"." in raw else int(raw)
        if kind == 5:
            return _word(m[5])
        if kind == 4:
            return _name(m[4])
        if kind == 2:
            return Ref(int(m[1]))
        c, at = m[6], m.start(6)
        if c == b"(":
            self.at = at
            return self._string()
        if c == b"<<":
            return self._dictionary(depth)
        if c == b"<":
            end = data.find(b">", at)
            end = len(data) if end < 0 else end
            self.at = end + 1
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", data[at + 1 : end])
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if c == b"[":
            out = []
            while (x := self.next(depth + 1)) is not None and not (isinstance(x, Word) and x == "]"):
                out.append(x)
            return out
        return Word(c.decode())

    def _dictionary(self, depth: int) -> dict:
        out: dict = {}
        while (key := self.next(depth + 1)) is not None and not (isinstance(key, Word) and key == ">>"):
            value = self.next(depth + 1)
            if isinstance(value, Word):
                if value == ">>":
                    break
                value = None if value == "null" else value
            if isinstance(key, Name):
                out[str(key)] = value
        return out

    def _string(self) -> bytes:
        data, at, open_, out = self.data, self.at + 1, 1, bytearray()
        while at < len(data):
            if (plain := _UNMARKED.match(data, at)) is not None:
                out += plain[0]
                at = plain.end()
                continue
            c = data[at : at + 1]
            at += 1
            if c == b"\\":
                c = data[at : at + 1]
                at += 1
                if m := _OCTAL.match(data, at - 1):
                    out.append(int(m[0], 8) & 255)
                    at = m.end()
                elif c == b"\r":
                    at += data[at : at + 1] == b"\n"
                elif c != b"\n":
                    out += _ESCAPES.get(c, c)
                continue
            open_ += (c == b"(") - (c == b")")
            if not open_:
                break
            out += c
        self.at = at
        return bytes(out)


# ---- streams


def _predicted(data: bytes, about: dict) -> bytes:
    """Rows of a stream from their differences, as PNG makes them."""
    kind, width = about.get("Predictor", 1), max(1, about.get("Colors", 1) * about.get("BitsPerComponent", 8) // 8)
    if kind < 10:
        return data
    size = (about.get("Columns", 1) * about.get("Colors", 1) * about.get("BitsPerComponent", 8) + 7) // 8
    out, above = bytearray(), bytearray(size)
    for at in range(0, len(data) - size, size + 1):
        how, row = data[at], bytearray(data[at + 1 : at + 1 + size])
        for k in range(size if how else 0):
            left, up, corner = row[k - width] if k >= width else 0, above[k], above[k - width] if k >= width else 0
            if how == 4:
                p = left + up - corner
                near = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            else:
                near = (0, left, up, (left + up) // 2)[how] if how < 4 else 0
            row[k] = (row[k] + near) & 255
        out += row
        above = row
    return bytes(out)


def _hexadecimal(data: bytes) -> bytes:
    digits = re.sub(rb"[^0-9A-Fa-f]", b"", data.split(b">")[0])
    return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())


def _eighty_five(data: bytes) -> bytes:
    out, held = bytearray(), []
    for c in data.split(b"~")[0]:
        if c == 122 and not held:
            out += bytes(4)
        elif 33 <= c <= 117:
            held.append(c - 33)
            if len(held) == 5:
                out += sum(x * 85 ** (4 - k) for k, x in enumerate(held)).to_bytes(5, "big")[-4:]
                held = []
    if len(held) > 1:
        n = len(held)
        out += sum(x * 85 ** (4 - k) for k, x in enumerate(held + [84] * (5 - n))).to_bytes(5, "big")[-4:][: n - 1]
    return bytes(out)


def _runs(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and data[at] != 128:
        n = data[at]
        out += data[at + 1 : at + 2 + n] if n < 128 else data[at + 1 : at + 2] * (257 - n)
        at += n + 2 if n < 128 else 2
    return bytes(out)


def _inflated(data: bytes) -> bytes:
    """As much as can be unpacked: a cut or spoilt end leaves what comes before."""
    unpack, out = zlib.decompressobj(), b""
    try:
        out = unpack.decompress(data)
        return out + unpack.flush()
    except zlib.error:
        if out:
            return out
    pieces = []
    unpack = zlib.decompressobj()
    try:
        for at in range(0, len(data), 256):
            pieces.append(unpack.decompress(data[at : at + 256]))
    except zlib.error:
        pass
    return b"".join(pieces)


_FILTERS = {"FlateDecode": _inflated, "Fl": _inflated, "ASCIIHexDecode": _hexadecimal, "AHx": _hexadecimal, "ASCII85Decode": _eighty_five, "A85": _eighty_five, "RunLengthDecode": _runs, "RL": _runs}


class File:
    def __init__(self, data: bytes | None) -> None:
        self.data = data or b""
        if b"%PDF-" not in self.data[:1024]:
            raise Broken("no PDF")
        self.places: dict[int, int | tuple[int, int]] = {}
        self.trailer: dict = {}
        self.kept: dict[int, object] = {}
        self.packed: dict[int, list] = {}
        try:
            self._tables()
            usable = isinstance(self.get(self.get(self.trailer.get("Root"))["Pages"]), dict)
        except (Broken, ValueError, KeyError, TypeError, IndexError, AttributeError, RecursionError):
            usable = False
        if not usable:
            self._searched()
        if self.trailer.get("Encrypt") is not None:
            raise Broken("encrypted")

    # the places of objects

    def _tables(self) -> None:
        at = self.data.rfind(b"startxref")
        m = re.compile(rb"startxref\s+(\d+)").match(self.data, at) if at >= 0 else None
        todo, seen = [int(m[1])] if m else [], set()
        while todo:
            at = todo.pop(0)
            if at in seen or not 0 <= at < len(self.data):
                continue
            seen.add(at)
            about = self._table(at)
            for key, value in about.items():
                self.trailer.setdefault(key, value)
            todo += [about[k] for k in ("XRefStm", "Prev") if isinstance(about.get(k), int)]

    def _table(self, at: int) -> dict:
        reader = Reader(self.data, at)
        reader.skip()
        if not self.data.startswith(b"xref", reader.at):
            return self._packed_table(reader.at)
        reader.at += 4
        while isinstance(first := reader.next(), int):
            count = reader.next()
            for number in range(first, first + count):
                if m := _ENTRY.match(self.data, reader.at):
                    place, used, reader.at = int(m[1]), m[2].decode(), m.end()
                else:
                    place, _, used = reader.next(), reader.next(), reader.next()
                if used is None:
                    raise Broken("cross-references")
                if used == "n":
                    self.places.setdefault(number, place)
        about = reader.next()
        if not isinstance(about, dict):
            raise Broken("trailer")
        return about

    def _packed_table(self, at: int) -> dict:
        found = self._object_at(at, None)
        if not isinstance(found, Stream):
            raise Broken("cross-references")
        data, widths = self.content(found), found.about["W"]
        index = found.about.get("Index") or [0, found.about["Size"]]
        row, at = sum(widths), 0
        for first, count in zip(index[::2], index[1::2]):
            for number in range(first, first + count):
                cut, fields = at, []
                for w in widths:
                    fields.append(int.from_bytes(data[cut : cut + w], "big"))
                    cut += w
                at += row
                if cut > len(data):
                    return found.about
                kind = fields[0] if widths[0] else 1
                if kind in (1, 2):
                    self.places.setdefault(number, fields[1] if kind == 1 else (fields[1], fields[2]))
        return found.about

    def _searched(self) -> None:
        """Objects where they are written, the last of each number; those in object streams after that."""
        self.places = {int(m[1]): m.start() for m in re.finditer(rb"(?<![0-9])(\d+)[ \t\r\n]+\d+[ \t\r\n]+obj\b", self.data)}
        self.kept.clear(), self.packed.clear()
        self.trailer = {}
        for m in re.finditer(rb"trailer", self.data):
            about = Reader(self.data, m.end()).next()
            self.trailer |= about if isinstance(about, dict) else {}
        for number in list(self.places):
            found = self.get(Ref(number))
            about = found.about if isinstance(found, Stream) else found if isinstance(found, dict) else {}
            if about.get("Type") == "ObjStm":
                for k, (inner, _) in enumerate(self._inner(number)):
                    self.places.setdefault(inner, (number, k))
            elif about.get("Type") == "XRef":
                self.trailer = about | self.trailer
        if not isinstance(self.get(self.trailer.get("Root")), dict):
            root = next((Ref(n) for n in self.places if isinstance(x := self.get(Ref(n)), dict) and x.get("Type") == "Catalog"), None)
            if root is None:
                raise Broken("no catalog")
            self.trailer["Root"] = root

    # objects

    def get(self, x):
        """What an object refers to."""
        for _ in range(20):
            if not isinstance(x, Ref):
                return x
            x = self._numbered(x.number)
        raise Broken("a reference to itself")

    def _numbered(self, number: int):
        if number not in self.kept:
            place = self.places.get(number)
            self.kept[number] = None  # while it is read
            if isinstance(place, int):
                self.kept[number] = self._object_at(place, number)
            elif place is not None:
                inner = self._inner(place[0])
                self.kept[number] = next((x for n, x in inner if n == number), None)
        return self.kept[number]

    def _object_at(self, at: int, number: int | None):
        reader = Reader(self.data, at)
        found, _, word = reader.next(), reader.next(), reader.next()
        if word != "obj" or number is not None and found != number:
            raise Broken(f"no object {number}")
        value = reader.next()
        reader.skip()
        if not isinstance(value, dict) or not self.data.startswith(b"stream", reader.at):
            return value
        start = reader.at + 6
        start += 2 if self.data.startswith(b"\r\n", start) else self.data[start : start + 1] in (b"\n", b"\r")
        length = value.get("Length")
        length = self.get(length) if isinstance(length, Ref) else length
        if not isinstance(length, int) or not re.compile(rb"\s*endstream").match(self.data, start + length):
            end = self.data.find(b"endstream", start)
            length = (len(self.data) if end < 0 else end) - start
        return Stream(value, self.data[start : start + length])

    def _inner(self, number: int) -> list[tuple[int, object]]:
        if number not in self.packed:
            self.packed[number] = []
            holder = self.get(Ref(number))
            if isinstance(holder, Stream):
                data, first = self.content(holder), holder.about.get("First", 0)
                heads = Reader(data)
                pairs = [(heads.next(), heads.next()) for _ in range(holder.about.get("N", 0))]
                self.packed[number] = [(n, Reader(data, first + at).next()) for n, at in pairs if isinstance(n, int) and isinstance(at, int)]
        return self.packed[number]

    def content(self, stream: Stream) -> bytes:
        """A stream unpacked; Broken if one of its filters isn't known."""
        names, about = self.get(stream.about.get("Filter", stream.about.get("F"))), self.get(stream.about.get("DecodeParms", stream.about.get("DP")))
        names = names if isinstance(names, list) else [names] if names else []
        about = about if isinstance(about, list) else [about]
        data = stream.raw
        for k, name in enumerate(names):
            name = self.get(name)
            if name not in _FILTERS:
                raise Broken(f"filter {name}")
            how = self.get(about[k]) if k < len(about) else None
            data = _predicted(_FILTERS[name](data), how) if isinstance(how, dict) else _FILTERS[name](data)
        return data

    def pages(self) -> list[dict]:
        """The pages in order, with what they inherit."""
        out: list[dict] = []
        seen: set[int] = set()

        def walk(x, given: dict, depth: int) -> None:
            if isinstance(x, Ref):
                if x.number in seen:
                    return
                seen.add(x.number)
            node = self.get(x)
            if not isinstance(node, dict) or depth > 60:
                return
            given = given | {k: node[k] for k in ("Resources", "MediaBox", "CropBox") if node.get(k) is not None}
            if node.get("Type") == "Page" or "Kids" not in node:
                out.append(given | node)
                return
            for kid in self.get(node["Kids"]) or []:
                walk(kid, given, depth + 1)

        root = self.get(self.trailer.get("Root"))
        if isinstance(root, dict):
            walk(root.get("Pages"), {}, 0)
        return out


# ---- fonts

# Glyph names beside letters, which name themselves.
GLYPHS = dict(zip(
    "space exclam quotedbl numbersign dollar percent ampersand quotesingle parenleft parenright asterisk plus comma hyphen period slash "
    "zero one two three four five six seven eight nine colon semicolon less equal greater question at bracketleft backslash bracketright "
    "asciicircum underscore grave braceleft bar braceright asciitilde quoteleft quoteright quotedblleft quotedblright endash emdash bullet ellipsis "
    "fi fl germandbls Adieresis Odieresis Udieresis adieresis odieresis udieresis eacute egrave agrave ccedilla ntilde Euro sterling section degree".split(),
    [*" !\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~‘’“”–—•…", "fi", "fl", *"ßÄÖÜäöüéèàçñ€£§°"],
))
_CODECS = {"WinAnsiEncoding": "cp1252", "MacRomanEncoding": "mac_roman"}


def _glyph(name: str) -> str:
    bare = name.split(".")[0]
    if bare in GLYPHS or len(bare) == 1:
        return GLYPHS.get(bare, bare)
    m = re.fullmatch(r"uni([0-9A-F]{4})|u([0-9A-F]{4,6})", bare)
    return chr(int(m[1] or m[2], 16)) if m and int(m[1] or m[2], 16) < 0x110000 else "�"


def _utf16(b: bytes) -> str:
    return b.decode("utf-16-be", errors="replace")


@cache
def _encoded(codec: str) -> dict[int, str]:
    """The characters of all codes."""
    return {code: bytes([code]).decode(codec, errors="replace") for code in range(256)}


class Font:
    """Codes of a font: their characters and widths."""

    def __init__(self, file: File, about: dict) -> None:
        get = file.get
        self.wide = about.get("Subtype") == "Type0"
        self.text: dict[int, str] = {}
        self.widths: dict[int, float] = {}
        self.default = 500.0
        if isinstance(told := get(about.get("ToUnicode")), Stream):
            self._mapped(file.content(told))
        if self.wide:
            inner = get((get(about.get("DescendantFonts")) or [None])[0]) or {}
            self.default = float(get(inner.get("DW")) or 1000)
            self._spread(get, get(inner.get("W")) or [])
            return
        first, widths = get(about.get("FirstChar")) or 0, get(about.get("Widths")) or []
        self.widths = {first + k: float(w) for k, x in enumerate(widths) if isinstance(w := get(x), (int, float))}
        encoding = get(about.get("Encoding"))
        base = encoding.get("BaseEncoding") if isinstance(encoding, dict) else encoding
        codec = _CODECS.get(base, "cp1252")
        self.text = _encoded(codec) | self.text
        at = 0
        for x in get(encoding.get("Differences")) or [] if isinstance(encoding, dict) else []:
            if isinstance(x, int):
                at = x
            else:
                if not told:
                    self.text[at] = _glyph(str(x))
                at += 1

    def _spread(self, get, given: list) -> None:
        k = 0
        while k + 1 < len(given):
            first, then = given[k], get(given[k + 1])
            if isinstance(then, list):
                self.widths |= {first + n: float(w) for n, w in enumerate(then) if isinstance(w, (int, float))}
                k += 2
            elif k + 2 < len(given) and isinstance(then, int):
                self.widths |= dict.fromkeys(range(first, min(then, first + 65535) + 1), float(given[k + 2]))
                k += 3
            else:
                return

    def _mapped(self, data: bytes) -> None:
        """What a character map says: codes to UTF-16, one by one or in ranges."""
        reader, held = Reader(data), []
        while (x := reader.next()) is not None:
            if not isinstance(x, Word):
                held.append(x)
                continue
            if x == "endbfchar":
                for code, to in zip(held[::2], held[1::2]):
                    if isinstance(code, bytes) and isinstance(to, bytes):
                        self.text[int.from_bytes(code, "big")] = _utf16(to)
            elif x == "endbfrange":
                for low, high, to in zip(held[::3], held[1::3], held[2::3]):
                    if not isinstance(low, bytes) or not isinstance(high, bytes):
                        continue
                    a, b = int.from_bytes(low, "big"), int.from_bytes(high, "big")
                    for n in range(min(b - a + 1, 65536)):
                        if isinstance(to, list):
                            if n < len(to) and isinstance(to[n], bytes):
                                self.text[a + n] = _utf16(to[n])
                        elif isinstance(to, bytes) and len(to) >= 2:
                            self.text[a + n] = _utf16(to[:-2]) + _utf16((int.from_bytes(to[-2:], "big") + n & 0xFFFF).to_bytes(2, "big"))
            held = []

    def codes(self, b: bytes) -> list[int]:
        return [int.from_bytes(b[k : k + 2], "big") for k in range(0, len(b) - 1, 2)] if self.wide else list(b)


# ---- content


def times(a: Matrix, b: Matrix) -> Matrix:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


def put(m: Matrix, x: float, y: float) -> tuple[float, float]:
    return x * m[0] + y * m[2] + m[4], x * m[1] + y * m[3] + m[5]


@dataclass
class Run:
    x0: float
    x1: float
    y: float
    size: float
    text: str


@dataclass
class Drawn:
    """What a page shows: runs of text, lines as (x0, y0, x1, y1), images."""

    runs: list[Run] = field(default_factory=list)
    lines: list[tuple[float, float, float, float]] = field(default_factory=list)
    images: int = 0


class Painter:
    """Follows a content stream."""

    def __init__(self, file: File, to: Drawn) -> None:
        self.file, self.to, self.fonts = file, to, {}

    def paint(self, data: bytes, resources: dict, matrix: Matrix, depth: int = 0) -> None:
        get = self.file.get
        reader, held, stack = Reader(data), [], []
        state = {"m": matrix, "font": None, "size": 0.0, "space": 0.0, "word": 0.0, "wide": 1.0, "lead": 0.0, "rise": 0.0}
        line = text = ONE
        path: list[list[tuple[float, float]]] = []
        boxes: list[tuple[float, float, float, float]] = []

        def number(k: int) -> float:
            return float(held[k]) if -len(held) <= k < len(held) and isinstance(held[k], (int, float)) else 0.0

        def show(b) -> None:
            nonlocal text
            if not isinstance(b, bytes) or state["font"] is None:
                return
            font, size = state["font"], state["size"]
            at = times((size * state["wide"], 0, 0, size, 0, state["rise"]), times(text, state["m"]))
            shown, moved = "", 0.0
            for code in font.codes(b):
                shown += font.text.get(code, "�")
                w = font.widths.get(code, font.default) / 1000 * size + state["space"] + (state["word"] if code == 32 and not font.wide else 0.0)
                moved += w * state["wide"]
            x0, y0 = put(at, 0, 0)
            text = times((1, 0, 0, 1, moved, 0), text)
            x1, _ = put(times(text, state["m"]), 0, state["rise"])
            if shown:
                self.to.runs.append(Run(x0, x1, y0, abs(at[3]) or abs(at[1]) or 1.0, shown))

        def draw(stroke: bool) -> None:
            for x0, y0, x1, y1 in boxes:
                a, b = put(state["m"], x0, y0), put(state["m"], x1, y1)
                left, right, low, high = min(a[0], b[0]), max(a[0], b[0]), min(a[1], b[1]), max(a[1], b[1])
                if right - left <= THIN or high - low <= THIN:
                    self.to.lines.append((left, low, right, high))
                elif stroke:
                    self.to.lines += [(left, low, right, low), (left, high, right, high), (left, low, left, high), (right, low, right, high)]
            for points in path if stroke else ():
                self.to.lines += [(*a, *b) for a, b in zip(points, points[1:])]

        while True:
            plain = _PLAIN.match(data, reader.at)
            if plain is not None and (raw := plain[2]) not in _NO_OPERATORS:
                reader.at = plain.end()
                held += map(float, plain[1].split())
                op = str(_word(raw))
            elif (x := reader.next()) is None:
                break
            elif isinstance(x, Word):
                op = str(x)
            else:
                held.append(x)
                continue
            if op == "m":
                path.append([put(state["m"], number(-2), number(-1))])
            elif op == "l" and path:
                path[-1].append(put(state["m"], number(-2), number(-1)))
            elif op == "q":
                stack.append(dict(state))
            elif op == "Q":
                state = stack.pop() if stack else state
            elif op == "cm" and len(held) >= 6:
                state["m"] = times(tuple(number(k) for k in range(-6, 0)), state["m"])
            elif op == "BT":
                line = text = ONE
            elif op == "Tf" and len(held) >= 2:
                state["font"], state["size"] = self._font(resources, held[-2]), number(-1)
            elif op in ("Td", "TD"):
                if op == "TD":
                    state["lead"] = -number(-1)
                line = text = times((1, 0, 0, 1, number(-2), number(-1)), line)
            elif op == "Tm" and len(held) >= 6:
                line = text = tuple(number(k) for k in range(-6, 0))
            elif op in ("T*", "'", '"'):
                if op == '"' and len(held) >= 3:
                    state["word"], state["space"] = number(-3), number(-2)
                line = text = times((1, 0, 0, 1, 0, -state["lead"]), line)
                if op != "T*" and held:
                    show(held[-1])
            elif op == "Tj" and held:
                show(held[-1])
            elif op == "TJ" and held and isinstance(held[-1], list):
                for part in held[-1]:
                    if isinstance(part, (int, float)):
                        text = times((1, 0, 0, 1, -part / 1000 * state["size"] * state["wide"], 0), text)
                    else:
                        show(part)
            elif op in ("Tc", "Tw", "TL", "Ts"):
                state[{"Tc": "space", "Tw": "word", "TL": "lead", "Ts": "rise"}[op]] = number(-1)
            elif op == "Tz":
                state["wide"] = number(-1) / 100
            elif op in ("c", "v", "y") and path:
                path.append([put(state["m"], number(-2), number(-1))])  # curves rule nothing
            elif op == "h" and path:
                path[-1].append(path[-1][0])
            elif op == "re" and len(held) >= 4:
                boxes.append((number(-4), number(-3), number(-4) + number(-2), number(-3) + number(-1)))
            elif op in ("S", "s", "B", "B*", "b", "b*", "f", "F", "f*", "n"):
                if op in ("s", "b", "b*") and path:
                    path[-1].append(path[-1][0])
                if op != "n":
                    draw(op not in ("f", "F", "f*"))
                path, boxes = [], []
            elif op == "BI":
                self.to.images += 1
                end = _IMAGE_END.search(data, reader.at)
                reader.at = end.end() if end else len(data)
            elif op == "Do" and held:
                form = get((get(resources.get("XObject")) or {}).get(str(held[-1])))
                if isinstance(form, Stream) and form.about.get("Subtype") == "Image":
                    self.to.images += 1
                elif isinstance(form, Stream) and depth < MOST_DEPTH:
                    own = get(form.about.get("Matrix"))
                    own = tuple(float(get(v)) for v in own) if isinstance(own, list) and len(own) == 6 else ONE
                    inner = get(form.about.get("Resources"))
                    self.paint(self.file.content(form), inner if isinstance(inner, dict) else resources, times(own, state["m"]), depth + 1)
            held = []

    def _font(self, resources: dict, name) -> Font | None:
        about = (self.file.get(resources.get("Font")) or {}).get(str(name))
        key = about.number if isinstance(about, Ref) else id(about)
        if key not in self.fonts:
            found = self.file.get(about)
            self.fonts[key] = Font(self.file, found) if isinstance(found, dict) else None
        return self.fonts[key]


@dataclass
class Box:
    x0: float
    y0: float
    x1: float
    y1: float
    text: str


def drawn(file: File, page: dict) -> Drawn:
    """What a page shows, from its upper left corner on."""
    get, out = file.get, Drawn()
    box = get(page.get("CropBox")) or get(page.get("MediaBox"))
    box = [float(get(v)) for v in box] if isinstance(box, list) and len(box) == 4 else [0.0, 0.0, 612.0, 792.0]
    streams = get(page.get("Contents"))
    streams = streams if isinstance(streams, list) else [streams]
    data = b"\n".join(file.content(s) for x in streams if isinstance(s := get(x), Stream))
    Painter(file, out).paint(data, get(page.get("Resources")) or {}, (1, 0, 0, -1, -min(box[0], box[2]), max(box[1], box[3])))
    return out


def text_lines(runs: list[Run]) -> list[Box]:
    """Runs of a baseline, from left to right; a gap of a quarter of the size is a space, one of three sizes parts two lines."""
    out: list[Box] = []
    rows: list[list[Run]] = []
    for r in sorted(runs, key=lambda r: (r.y, r.x0)):
        if rows and abs(rows[-1][0].y - r.y) <= max(rows[-1][0].size, r.size) * 0.3:
            rows[-1].append(r)
        else:
            rows.append([r])
    for row in rows:
        held: list[Run] = []
        text = ""
        for r in [*sorted(row, key=lambda r: r.x0), None]:
            gap = r.x0 - max(h.x1 for h in held) if held and r else 0.0
            if held and (r is None or gap > 3 * r.size):
                if text.strip():
                    out.append(Box(min(h.x0 for h in held), held[0].y - max(h.size for h in held) * 0.8, max(h.x1 for h in held), held[0].y + max(h.size for h in held) * 0.2, text.strip()))
                held, text = [], ""
            if r is not None:
                text += (" " if held and gap > 0.25 * r.size and not text.endswith(" ") and not r.text.startswith(" ") else "") + r.text
                held.append(r)
    return out


def text_blocks(lines: list[Box]) -> list[Box]:
    """Lines below each other that overlap and stand no further apart than a line and a half."""
    out: list[Box] = []
    for line in sorted(lines, key=lambda b: (b.y0, b.x0)):
        high = line.y1 - line.y0
        near = next((b for b in reversed(out) if line.y0 - b.y1 <= 0.75 * high and line.x0 < b.x1 and line.x1 > b.x0), None)
        if near is None:
            out.append(Box(line.x0, line.y0, line.x1, line.y1, line.text))
        else:
            near.x0, near.x1, near.y1, near.text = min(near.x0, line.x0), max(near.x1, line.x1), max(near.y1, line.y1), f"{near.text}\n{line.text}"
    return out


def _snapped(values: list[float]) -> list[float]:
    out: list[list[float]] = []
    for v in sorted(values):
        if out and v - out[-1][-1] <= SNAP:
            out[-1].append(v)
        else:
            out.append([v])
    return [sum(g) / len(g) for g in out]


def ruled_tables(drawn_: Drawn) -> list[tuple[Box, list[list[str]]]]:
    """Grids of lines that cross, from the top: their places and their cells. Text belongs to the cell that holds its middle."""
    level = [(min(a, c), (b + d) / 2, max(a, c)) for a, b, c, d in drawn_.lines if abs(b - d) <= THIN and abs(a - c) > THIN]
    upright = [((a + c) / 2, min(b, d), max(b, d)) for a, b, c, d in drawn_.lines if abs(a - c) <= THIN and abs(b - d) > THIN]
    group = list(range(len(level) + len(upright)))

    def top(k: int) -> int:
        while group[k] != k:
            group[k] = k = group[group[k]]
        return k

    for i, (x0, y, x1) in enumerate(level):
        for j, (x, y0, y1) in enumerate(upright):
            if x0 - SNAP <= x <= x1 + SNAP and y0 - SNAP <= y <= y1 + SNAP:
                group[top(i)] = top(len(level) + j)
    parts: dict[int, tuple[list[float], list[float]]] = {}
    for k in range(len(group)):
        xs, ys = parts.setdefault(top(k), ([], []))
        if k < len(level):
            ys.append(level[k][1])
        else:
            xs.append(upright[k - len(level)][0])
    out = []
    for xs, ys in parts.values():
        xs, ys = _snapped(xs), _snapped(ys)
        if len(xs) < 2 or len(ys) < 2 or (len(xs) - 1) * (len(ys) - 1) < 2:
            continue
        held: list[list[list[Run]]] = [[[] for _ in xs[1:]] for _ in ys[1:]]
        for r in drawn_.runs:
            x, y = (r.x0 + r.x1) / 2, r.y - 0.3 * r.size
            at = next((k for k in range(len(xs) - 1) if xs[k] <= x < xs[k + 1]), None)
            row = next((k for k in range(len(ys) - 1) if ys[k] <= y < ys[k + 1]), None)
            if at is not None and row is not None:
                held[row][at].append(r)
        cells = [["\n".join(b.text for b in text_lines(c)) for c in row] for row in held]
        out.append((Box(xs[0], ys[0], xs[-1], ys[-1], ""), cells))
    return sorted(out, key=lambda t: (t[0].y0, t[0].x0))


# ---- rows


def _page_rows(path: str, pages: int, n: int, file: File, page: dict) -> Iterator[tuple]:
    try:
        found = drawn(file, page)
    except (Broken, ValueError, KeyError, TypeError, IndexError, AttributeError, RecursionError, OverflowError, MemoryError) as e:
        yield path, pages, n, "page", 0, None, None, None, None, None, None, "", f"page_failed: {e}"
        return
    tables = ruled_tables(found)
    blocks = text_blocks(text_lines(found.runs))
    yield path, pages, n, "page", found.images, None, None, None, None, None, None, "\n".join(b.text for b in blocks), None
    for k, b in enumerate(blocks, 1):
        yield path, pages, n, "text", k, None, None, b.x0, b.y0, b.x1, b.y1, b.text, None
    for k, (box, cells) in enumerate(tables, 1):
        for y, row in enumerate(cells, 1):
            for x, text in enumerate(row, 1):
                yield path, pages, n, "cell", k, y, x, box.x0, box.y0, box.x1, box.y1, text, None


def _rows(path: str, content: bytes | None) -> Iterator[tuple]:
    try:
        file = File(content)
        pages = file.pages()
    except (Broken, ValueError, KeyError, TypeError, IndexError, AttributeError, RecursionError) as e:
        yield path, None, None, "file", *[None] * 8, f"pdf_failed: {e if isinstance(e, Broken) else type(e).__name__}"
        return
    if not pages:
        yield path, 0, None, "file", *[None] * 9
    for n, page in enumerate(pages, 1):
        yield from _page_rows(path, len(pages), n, file, page)


def _items(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for f in frames:
        for path, content in zip(f["path"], f["content"]):
            for row in _rows(path, content):
                held.append(row)
                if len(held) >= FRAME_ROWS:
                    yield _frame(held)
                    held = []
    if held:
        yield _frame(held)


def _frame(held: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(held, columns=_NAMES).astype({c: "Int32" for c in ("pages", "page", "n", "row_no", "col_no")})


def items(files: DataFrame) -> DataFrame:
    """files(path, content) -> a row for each page (n: its images; text), text block (n: its number, with its place) and cell of a ruled
    table (n: the table's number, with the table's place), from the upper left corner; one row of kind file, with an
    error, for what can't be read, as for a null; one without an error for a file without pages.

    A page that can't be read is a row with an error. Store the result where several of the following read it."""
    return files.select("path", "content").mapInPandas(_items, ITEMS)


def pages(found: DataFrame) -> DataFrame:
    """items() -> path, page, n_text_chars, n_images, n_tables, table_detection_ok: what routes are chosen by."""
    some = found.where("kind IN ('page', 'cell')").groupBy("path", "page")
    page = F.col("kind") == "page"
    return some.agg(
        F.coalesce(F.max(F.when(page, F.length(F.trim("text")))), F.lit(0)).alias("n_text_chars"),
        F.max(F.when(page, F.col("n"))).alias("n_images"),
        F.coalesce(F.max(F.when(F.col("kind") == "cell", F.col("n"))), F.lit(0)).alias("n_tables"),
        F.bool_and(F.col("error").isNull()).alias("table_detection_ok"),
    )


def table_rows(found: DataFrame) -> DataFrame:
    """items() -> path, page, table_no, row_no, cells, x0, y0, x1, y1: the rows of ruled tables."""
    cell = F.struct("col_no", F.coalesce("text", F.lit("")).alias("text"))
    each = found.where("kind = 'cell'").groupBy("path", "page", F.col("n").alias("table_no"), "row_no")
    rows = each.agg(F.array_sort(F.collect_list(cell)).alias("c"), *(F.first(c).alias(c) for c in ("x0", "y0", "x1", "y1")))
    return rows.select("path", "page", "table_no", "row_no", F.transform("c", lambda x: x["text"]).alias("cells"), "x0", "y0", "x1", "y1")
