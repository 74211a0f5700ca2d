"""Office Open XML packages: documents, workbooks and presentations as rows of cells and as Markdown, without an office library.

A package is a graph: its parts are members of a ZIP archive, and each part's relationships name others by id. All parts are
reached by relationships, never by the usual names, and elements are known by their local names, so that strict and
transitional packages read alike. A package is one row and is read in one task; rows leave in bounded frames, and large sheets
are read element by element. A package that is broken, encrypted or of another kind is one row with its error."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import batches

CELLS = "path string, kind string, part_no int, name string, row_no int, col_no int, text string, merged boolean, error string"
TEXTS = "path string, kind string, markdown string, error string"
_CELL_NAMES = [c.split()[0] for c in CELLS.split(", ")]
FRAME_ROWS, MOST_COLUMNS, SMALL = 5000, 1000, 1 << 20

#: What a broken package raises.
BROKEN = (zipfile.BadZipFile, zlib.error, ET.ParseError, KeyError, ValueError, NotImplementedError, RuntimeError, EOFError, OSError, RecursionError)
_NOT_SHOWN = frozenset(("del", "moveFrom", "instrText", "delText", "delInstrText", "drawing", "pict", "object", "AlternateContent", "rPr", "pPr", "sdtPr", "fldData"))
_BREAKS = {"tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "-"}
# Number formats of workbooks that show dates or times.
_DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))


@lru_cache(4096)
def _local(name: object) -> str:
    """The local name of an element or attribute; a comment has none. Names are few, elements many."""
    return name.rpartition("}")[2] if isinstance(name, str) else ""


def _tag(x: ET.Element) -> str:
    return _local(x.tag)


def _attr(x: ET.Element | None, name: str, default: str | None = None) -> str | None:
    """An attribute by its local name."""
    if x is not None:
        for k, v in x.attrib.items():
            if _local(k) == name:
                return v
    return default


def _of(x: ET.Element | None, *path: str) -> ET.Element | None:
    """The first child along a path of local names."""
    for name in path:
        if x is None:
            return None
        for c in x:
            if _local(c.tag) == name:
                x = c
                break
        else:
            return None
    return x


def _each(x: ET.Element | None, name: str) -> list[ET.Element]:
    return [] if x is None else [c for c in x if _local(c.tag) == name]


class Package:
    def __init__(self, content: bytes | None) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(content or b""))
        self.links: dict[str, dict[str, tuple[str, str, bool]]] = {}
        self.root: ET.Element | None = None
        self.names = {n.lower(): n for n in self.zip.namelist()}
        self.main = next((t for kind, t, _ in self.related("").values() if kind == "officeDocument"), None)
        if self.main is None:
            raise ValueError("no main part")

    def open(self, part: str) -> io.BufferedIOBase:
        return self.zip.open(self.names[part.lstrip("/").lower()])

    def size(self, part: str) -> int:
        """How long a part is, unpacked."""
        return self.zip.getinfo(self.names[part.lstrip("/").lower()]).file_size

    def xml(self, part: str) -> ET.Element:
        data = self.open(part).read()
        if b"<!DOCTYPE" in data:
            raise ValueError("a part declares a document type")
        return ET.fromstring(data)

    def main_root(self) -> ET.Element:
        """The main part, read once."""
        if self.root is None:
            self.root = self.xml(self.main)
        return self.root

    def related(self, part: str) -> dict[str, tuple[str, str, bool]]:
        """Of a part's relationships, by id: the last word of its type, the part or address, whether that is outside."""
        if part not in self.links:
            self.links[part] = self._related(part)
        return self.links[part]

    def _related(self, part: str) -> dict[str, tuple[str, str, bool]]:
        folder, name = posixpath.split(part)
        at = posixpath.join(folder, "_rels", f"{name}.rels")
        if at.lower() not in self.names:
            return {}
        out = {}
        for x in self.xml(at):
            outside = x.get("TargetMode") == "External"
            target = x.get("Target", "")
            if not outside:
                target = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
            out[x.get("Id")] = x.get("Type", "").rpartition("/")[2], target, outside
        return out

    def one(self, part: str, kind: str) -> ET.Element | None:
        """The part of a kind that this one is related to."""
        return next((self.xml(t) for k, t, outside in self.related(part).values() if k == kind and not outside), None)


# ---- documents


def _shown(x: ET.Element) -> str:
    """The text of a paragraph or run, with tabs and line ends."""
    tag = _tag(x)
    if tag == "t":
        return x.text or ""
    if tag in _BREAKS:
        return _BREAKS[tag]
    return "" if tag in _NOT_SHOWN else "".join(map(_shown, x))


def _cell_text(tc: ET.Element) -> str:
    return "\n".join(_shown(p) for p in _each(tc, "p"))


def _number(x: ET.Element | None, default: int) -> int:
    found = _attr(x, "val", "")
    return int(found) if re.fullmatch(r"\d{1,6}", found or "") else default


def word_rows(tbl: ET.Element) -> Iterator[list[tuple[int, str, bool]]]:
    """Rows of (column from 1, text, whether it repeats a merged cell): a merged cell stands in each place that it spans."""
    above: dict[int, str] = {}
    for tr in _each(tbl, "tr"):
        at, row, now = 1 + _number(_of(tr, "trPr", "gridBefore"), 0), [], {}
        for tc in _each(tr, "tc"):
            properties = _of(tc, "tcPr")
            merge, wide = _of(properties, "vMerge"), min(_number(_of(properties, "gridSpan"), 1), MOST_COLUMNS)
            goes_on = merge is not None and _attr(merge, "val", "continue") == "continue" and at in above
            text = above[at] if goes_on else _cell_text(tc)
            for k in range(wide):
                row.append((at + k, text, goes_on or k > 0))
                now[at + k] = text
            at += wide
        above = now
        yield row


def _word_cells(package: Package) -> Iterator[tuple]:
    """All cells of the tables of the body."""
    for n, tbl in enumerate(_each(_of(package.main_root(), "body"), "tbl"), 1):
        for y, row in enumerate(word_rows(tbl), 1):
            for x, text, merged in row:
                yield n, None, y, x, text, merged


class _Word:
    """Writes a document's body as Markdown."""

    def __init__(self, package: Package) -> None:
        self.links = package.related(package.main)
        self.styles = {_attr(s, "styleId"): (_attr(_of(s, "name"), "val") or "").lower() for s in _each(package.one(package.main, "styles"), "style")}
        numbering = package.one(package.main, "numbering")
        kinds = {_attr(a, "abstractNumId"): {_attr(v, "ilvl"): _attr(_of(v, "numFmt"), "val") for v in _each(a, "lvl")} for a in _each(numbering, "abstractNum")}
        self.lists = {_attr(n, "numId"): kinds.get(_attr(_of(n, "abstractNumId"), "val"), {}) for n in _each(numbering, "num")}
        self.body = _of(package.main_root(), "body")

    def markdown(self) -> str:
        out: list[tuple[str, str]] = []
        for x in self._flat(self.body):
            kind, text = ("table", self._table(x)) if _tag(x) == "tbl" else self._paragraph(x)
            if text:
                out.append((kind, text))
        found = "".join(("" if k == 0 else "\n" if kind == out[k - 1][0] and kind.startswith(("item", "code", "quote")) else "\n\n") + text for k, (kind, text) in enumerate(out))
        return re.sub(r"(?m)^\x00(.*(?:\n\x00.*)*)", lambda m: "```\n" + m[0].replace("\x00", "") + "\n```", found) + "\n"

    def _flat(self, x: ET.Element | None) -> Iterator[ET.Element]:
        """Paragraphs and tables, also of content controls and insertions."""
        for c in x if x is not None else ():
            if _tag(c) in ("p", "tbl"):
                yield c
            elif _tag(c) in ("sdt", "sdtContent", "customXml", "ins", "moveTo"):
                yield from self._flat(c)

    def _runs(self, x: ET.Element) -> str:
        out = ""
        for c in x:
            tag = _tag(c)
            if tag == "r":
                out += self._marked(c)
            elif tag == "hyperlink":
                kind, target, outside = self.links.get(_attr(c, "id"), ("", "", False))
                text = self._runs(c)
                out += f"[{text}]({target})" if outside and text.strip() else text
            elif tag not in _NOT_SHOWN:
                out += self._runs(c)
        return out

    def _marked(self, run: ET.Element) -> str:
        text, properties = _shown(run), _of(run, "rPr")
        image = next((self.links[i][1] for x in run.iter() if _tag(x) == "blip" and (i := _attr(x, "embed") or _attr(x, "link")) in self.links), None)
        if image:
            alt = next((_attr(x, "descr") or "" for x in run.iter() if _tag(x) == "docPr"), "")
            return f"{text}![{alt}]({image})"
        for name, mark in (("i", "*"), ("b", "**")):
            if (on := _of(properties, name)) is not None and _attr(on, "val", "1") not in ("0", "false") and text.strip():
                before, inner, after = re.fullmatch(r"(\s*)(.*?)(\s*)", text, re.S).groups()
                text = f"{before}{mark}{inner}{mark}{after}"
        if (self.styles.get(_attr(_of(properties, "rStyle"), "val")) or "") in ("code", "html code", "source text", "verbatim char") and text.strip():
            text = f"`{text}`"
        return text

    def _paragraph(self, p: ET.Element) -> tuple[str, str]:
        properties = _of(p, "pPr")
        style = self.styles.get(_attr(_of(properties, "pStyle"), "val"), "")
        if style in ("code", "source code", "html preformatted", "preformatted text"):
            return "code", "\n".join("\x00" + line for line in _shown(p).split("\n"))
        text = self._runs(p).strip()
        if not text:
            return ("rule", "---") if _of(properties, "pBdr", "bottom") is not None and not _shown(p) else ("", "")
        if m := re.fullmatch(r"heading ([1-6])|title", style):
            plain = re.sub(r"\s+", " ", _shown(p)).strip()
            return "heading", f"{'#' * int(m[1] or 1)} {plain}"
        numbered = _of(properties, "numPr")
        if numbered is not None:
            level, which = _attr(_of(numbered, "ilvl"), "val", "0"), _attr(_of(numbered, "numId"), "val")
            mark = "-" if self.lists.get(which, {}).get(level, "bullet") == "bullet" else "1."
            return f"item {which}", "  " * int(level) + f"{mark} " + text.replace("\n", "\n" + "  " * (int(level) + 1))
        if style in ("quote", "intense quote"):
            return "quote", "\n".join(f"> {line}".rstrip() for line in text.split("\n"))
        return "p", text

    def _table(self, tbl: ET.Element) -> str:
        return pipe_table([[text for _, text, _ in row] for row in word_rows(tbl)])


def pipe_table(rows: list[list[str]]) -> str:
    """Rows as a Markdown table, whose head is the first row."""
    width = max(map(len, rows), default=0)
    cell = lambda c: re.sub(r"\s*\n\s*", "<br>", c.strip()).replace("|", "\\|")
    lines = ["| " + " | ".join([cell(c) for c in r] + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]) if width else ""


# ---- workbooks


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Za-z]*", ref)[0].upper():
        n = n * 26 + ord(c) - 64
    return n


def _plain(x: ET.Element) -> str:
    """The text of a shared or inline string; phonetic readings are left out."""
    return "".join(t.text or "" for c in x if _tag(c) != "rPh" for t in c.iter() if _tag(t) == "t") if _tag(x) != "t" else x.text or ""


def _walked(x: ET.Element) -> Iterator[tuple[str, ET.Element]]:
    yield "start", x
    for c in x:
        yield from _walked(c)
    yield "end", x


class _Book:
    def __init__(self, package: Package) -> None:
        self.package, self.links = package, package.related(package.main)
        book = package.main_root()
        self.sheets = [(_attr(s, "name") or "", self.links[_attr(s, "id")][1]) for s in _each(_of(book, "sheets"), "sheet") if self.links.get(_attr(s, "id"), ("",))[0] == "worksheet"]
        self.start = datetime(1904, 1, 1) if _attr(_of(book, "workbookPr"), "date1904") in ("1", "true") else datetime(1899, 12, 30)
        self.strings = [_plain(s) for s in _each(package.one(package.main, "sharedStrings"), "si")]
        styles = package.one(package.main, "styles")
        dated = {_attr(f, "numFmtId") for f in _each(_of(styles, "numFmts"), "numFmt") if re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", _attr(f, "formatCode") or "").lower())}
        self.dates = {str(k) for k, f in enumerate(_each(_of(styles, "cellXfs"), "xf")) if (n := _attr(f, "numFmtId", "0")) in dated or int(n) in _DATE_FORMATS}

    def value(self, c: ET.Element) -> str | None:
        kind, v = c.get("t", "n"), _of(c, "v")
        if kind == "inlineStr":
            return _plain(found) if (found := _of(c, "is")) is not None else None
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return "TRUE" if v.text == "1" else "FALSE"
        if kind == "n" and c.get("s") in self.dates:
            return self.date(float(v.text))
        return v.text

    def date(self, days: float) -> str:
        if not 0 <= days < 2_958_466:  # the end of the year 9999
            return str(days)
        at = self.start + timedelta(seconds=round(days * 86400))
        if days < 1:
            return at.strftime("%H:%M:%S")
        return at.strftime("%Y-%m-%d" if (at.hour, at.minute, at.second) == (0, 0, 0) else "%Y-%m-%d %H:%M:%S")

    def cells(self) -> Iterator[tuple]:
        """Cells that hold a value; merged is true where a cell stands for a merged range."""
        for n, (name, part) in enumerate(self.sheets, 1):
            walk = self._walks(part)
            merged = self._merged(walk())
            y = 0
            for event, x in walk():
                tag = _tag(x)
                if event == "start":
                    if tag == "row":
                        y, at = int(x.get("r") or y + 1), 0
                elif tag == "c":
                    at = _column(x.get("r") or "") or at + 1
                    if (text := self.value(x)) not in (None, ""):
                        yield n, name, y, at, text, (y, at) in merged

    def _walks(self, part: str) -> Callable[[], Iterator[tuple[str, ET.Element]]]:
        """What goes through a sheet's elements as they start and end. A small sheet is parsed once and kept, another each time."""
        if self.package.size(part) > SMALL:
            return lambda: self._streamed(part)
        root = ET.fromstring(self.package.open(part).read())
        return lambda: _walked(root)

    def _streamed(self, part: str) -> Iterator[tuple[str, ET.Element]]:
        for event, x in ET.iterparse(self.package.open(part), ("start", "end")):
            yield event, x
            if event == "end" and _tag(x) == "row":
                x.clear()

    @staticmethod
    def _merged(walk: Iterator[tuple[str, ET.Element]]) -> set[tuple[int, int]]:
        """The first cells of merged ranges."""
        out = set()
        for event, x in walk:
            if event == "end" and _tag(x) == "mergeCell" and (m := re.match(r"\$?([A-Z]+)\$?(\d+)", x.get("ref", ""))):
                out.add((int(m[2]), _column(m[1])))
        return out

    def markdown(self) -> str:
        out, rows, now = [], {}, None

        def done() -> None:
            if now is not None:
                held = sorted({x for r in rows.values() for x in r})  # rows and columns without a value are left out
                out.append(f"## {now[1]}\n\n" + pipe_table([[r.get(x, "") for x in held] for _, r in sorted(rows.items())]))

        for n, name, y, x, text, _ in self.cells():
            if now != (n, name):
                done()
                now, rows = (n, name), {}
            rows.setdefault(y, {})[x] = text
        done()
        return "\n\n".join(out) + "\n"


# ---- presentations


class _Slides:
    def __init__(self, package: Package) -> None:
        self.package = package
        links = package.related(package.main)
        # a slide has a number of its own under the same local name, so the relationship's id is known by having a namespace
        order = [next((v for k, v in s.attrib.items() if k.endswith("}id")), None) for s in _each(_of(package.main_root(), "sldIdLst"), "sldId")]
        self.slides = [links[i][1] for i in order if i in links]

    @staticmethod
    def _paragraphs(body: ET.Element | None) -> list[str]:
        def text(x: ET.Element) -> str:
            return "\n" if _tag(x) == "br" else (x.text or "") if _tag(x) == "t" else "".join(map(text, x))

        return [found for p in _each(body, "p") if (found := text(p).strip())]

    def _shapes(self, x: ET.Element | None) -> Iterator[ET.Element]:
        for c in x if x is not None else ():
            if _tag(c) == "grpSp":
                yield from self._shapes(c)
            elif _tag(c) in ("sp", "graphicFrame", "pic"):
                yield c

    def _tables(self, shape: ET.Element) -> Iterator[list[list[tuple[str, bool]]]]:
        for tbl in (x for x in shape.iter() if _tag(x) == "tbl"):
            above: list[tuple[str, bool]] = []
            rows = []
            for tr in _each(tbl, "tr"):
                row: list[tuple[str, bool]] = []
                for tc in _each(tr, "tc"):
                    if tc.get("hMerge") in ("1", "true") and row:
                        row.append((row[-1][0], True))
                    elif tc.get("vMerge") in ("1", "true") and len(row) < len(above):
                        row.append((above[len(row)][0], True))
                    else:
                        row.append(("\n".join(self._paragraphs(_of(tc, "txBody"))), False))
                rows.append(row)
                above = row
            yield rows

    def cells(self) -> Iterator[tuple]:
        for n, part in enumerate(self.slides, 1):
            k = 0
            for shape in self._shapes(_of(self.package.xml(part), "cSld", "spTree")):
                for rows in self._tables(shape):
                    k += 1
                    for y, row in enumerate(rows, 1):
                        for x, (text, merged) in enumerate(row, 1):
                            yield n, f"table {k}", y, x, text, merged

    def markdown(self) -> str:
        out = []
        for n, part in enumerate(self.slides, 1):
            out.append(f"<!-- Slide number: {n} -->")
            for shape in self._shapes(_of(self.package.xml(part), "cSld", "spTree")):
                if _tag(shape) == "graphicFrame":
                    out += [t for rows in self._tables(shape) if (t := pipe_table([[c for c, _ in r] for r in rows]))]
                elif _tag(shape) == "sp":
                    kind = _attr(_of(shape, "nvSpPr", "nvPr", "ph"), "type", "")
                    found = self._paragraphs(_of(shape, "txBody"))
                    if kind in ("title", "ctrTitle"):
                        out += ["# " + " ".join(found).replace("\n", " ")] if found else []
                    elif kind not in ("sldNum", "dt", "ftr"):
                        out += ["\n".join(found)] if found else []
            notes = self.package.one(part, "notesSlide")
            for shape in self._shapes(_of(notes, "cSld", "spTree")):
                if _attr(_of(shape, "nvSpPr", "nvPr", "ph"), "type") == "body" and (found := self._paragraphs(_of(shape, "txBody"))):
                    out.append("### Notes:\n\n" + "\n".join(found))
        return "\n\n".join(out) + "\n"


# ---- rows

#: Kinds by the main part's root element.
_KINDS = {"document": "docx", "workbook": "xlsx", "presentation": "pptx"}


def _kind(package: Package) -> str:
    if (tag := _tag(package.main_root())) in _KINDS:
        return _KINDS[tag]
    raise ValueError("no document, workbook or presentation")


def cells_of(content: bytes | None) -> Iterator[tuple]:
    package = Package(content)
    kind = _kind(package)
    found = _word_cells(package) if kind == "docx" else _Book(package).cells() if kind == "xlsx" else _Slides(package).cells()
    for row in found:
        yield kind, *row


def markdown_of_package(content: bytes | None) -> tuple[str, str]:
    package = Package(content)
    kind = _kind(package)
    return kind, (_Word if kind == "docx" else _Book if kind == "xlsx" else _Slides)(package).markdown()


def _error(e: Exception) -> str:
    return f"package_failed: {type(e).__name__}"


def _framed(rows: Callable[[str, bytes], Iterator[tuple]], names: list[str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for f in frames:
            for path, content in zip(f["path"], f["content"]):
                for row in rows(path, content):
                    held.append(row)
                    if len(held) >= FRAME_ROWS:
                        yield _frame(held, names)
                        held = []
        if held:
            yield _frame(held, names)

    return run


def _frame(held: list[tuple], names: list[str]) -> pd.DataFrame:
    found = pd.DataFrame(held, columns=names)
    return found.astype({c: "Int32" for c in ("part_no", "row_no", "col_no") if c in names} | ({"merged": "boolean"} if "merged" in names else {}))


def _cell_rows(path: str, content: bytes | None) -> Iterator[tuple]:
    try:
        for kind, n, name, y, x, text, merged in cells_of(content):
            yield path, kind, n, name, y, x, text, merged, None
    except BROKEN as e:
        yield path, None, None, None, None, None, None, None, _error(e)


def _text_rows(path: str, content: bytes | None) -> Iterator[tuple]:
    try:
        kind, text = markdown_of_package(content)
        yield path, kind, text, None
    except BROKEN as e:
        yield path, None, None, _error(e)


def office_cells(packages: DataFrame) -> DataFrame:
    """packages(path, content) -> a row for each cell: kind (docx, xlsx, pptx), part_no (table, sheet or slide, from 1), name (of the
    sheet; of the table on a slide), row_no and col_no from 1, text, merged, error.

    Documents and slides repeat a merged cell in each place that it spans, where merged is true; in workbooks only its first
    place has a value, and merged is true there. Documents give the tables of the body; cells of tables within cells are left out, as
    is deleted text. Workbooks give values as they are stored, dates and times as ISO, and cells without a value not at all. A package that
    breaks off gives the cells before and a row with its error. A null content is broken. Without packages there are no rows."""
    return batches.small(packages).select("path", "content").mapInPandas(_framed(_cell_rows, _CELL_NAMES), CELLS)


def office_markdown(packages: DataFrame) -> DataFrame:
    """packages(path, content) -> path, kind, markdown, error: one row for each package."""
    return batches.small(packages).select("path", "content").mapInPandas(_framed(_text_rows, [c.split()[0] for c in TEXTS.split(", ")]), TEXTS)
