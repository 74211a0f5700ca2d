"""Documents as DOCX files: packages made of Markdown blocks, and a sink that commits them.

`df.write.format("docx").mode("append").save(folder)` writes each row of (name, body) as a file. A task writes into a staging
folder of its own attempt, and tells the driver which; when all tasks have succeeded, the folders of the attempts that
count are moved to their place, one move a task, and the staging folder goes with whatever other attempts left in it.
If the job fails nothing but the staging folder was written, and it is deleted."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape, quoteattr

from pyarrow import fs
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..functions.blocks import Block, blocks_of
from ..functions.labels import INLINE

# Namespaces and content types of packages, the styles that are written.
_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_P = "http://schemas.openxmlformats.org/package/2006"
_TYPES = "application/vnd.openxmlformats-officedocument.wordprocessingml"
_STYLES = (
    *((f"Heading{n}", f"heading {n}", "paragraph", f'<w:rPr><w:b/><w:sz w:val="{44 - 4 * n}"/></w:rPr>') for n in range(1, 7)),
    ("Quote", "Quote", "paragraph", '<w:pPr><w:ind w:left="720"/></w:pPr><w:rPr><w:i/></w:rPr>'),
    ("Code", "Code", "paragraph", '<w:rPr><w:rFonts w:ascii="Courier New" w:hAnsi="Courier New"/></w:rPr>'),
    ("CodeChar", "Verbatim Char", "character", '<w:rPr><w:rFonts w:ascii="Courier New" w:hAnsi="Courier New"/></w:rPr>'),
)
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
#: Characters that XML can't hold.
_NOT_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ud800-\udfff￾￿]")


class _Document:
    def __init__(self) -> None:
        self.out: list[str] = []
        self.links: list[str] = []
        self.lists: list[str] = []

    def run(self, text: str, properties: str = "") -> str:
        inner = "<w:br/>".join(f'<w:t xml:space="preserve">{escape(_NOT_XML.sub("", x))}</w:t>' for x in text.split("\n"))
        return f"<w:r>{f'<w:rPr>{properties}</w:rPr>' if properties else ''}{inner}</w:r>" if text else ""

    def runs(self, text: str) -> str:
        """Plain text and bold, italic, code and link marks."""
        out, at = "", 0
        for m in re.finditer(INLINE, text):
            out += self.run(text[at : m.start()])
            at, mark = m.end(), m[0]
            if mark.startswith("**"):
                out += self.run(mark[2:-2], "<w:b/>")
            elif mark.startswith("*"):
                out += self.run(mark[1:-1], "<w:i/>")
            elif mark.startswith("`"):
                out += self.run(mark[1:-1], '<w:rStyle w:val="CodeChar"/>')
            else:
                label, _, target = mark[1:-1].partition("](")
                self.links.append(target)
                out += f'<w:hyperlink r:id="link{len(self.links)}">{self.run(label)}</w:hyperlink>'
        return out + self.run(text[at:])

    def paragraph(self, inner: str, properties: str = "") -> str:
        return f"<w:p>{f'<w:pPr>{properties}</w:pPr>' if properties else ''}{inner}</w:p>"

    def styled(self, style: str, inner: str) -> str:
        return self.paragraph(inner, f'<w:pStyle w:val="{style}"/>')

    def table(self, rows: list[str]) -> str:
        split = [[c.strip().replace("\\|", "|").replace("<br>", "\n") for c in re.split(r"(?<!\\)\|", re.sub(r"^\s*\||(?<!\\)\|\s*$", "", r))] for r in rows]
        width = max(map(len, split))
        cell = lambda c, head: f"<w:tc><w:tcPr/>{self.paragraph(self.run(c, '<w:b/>') if head else self.runs(c))}</w:tc>"
        lines = ["<w:tr>" + "".join(cell(c, k == 0) for c in [*r, *[""] * (width - len(r))]) + "</w:tr>" for k, r in enumerate(split)]
        edges = "".join(f'<w:{e} w:val="single" w:sz="4"/>' for e in ("top", "left", "bottom", "right", "insideH", "insideV"))
        return f"<w:tbl><w:tblPr><w:tblBorders>{edges}</w:tblBorders></w:tblPr><w:tblGrid>{'<w:gridCol/>' * width}</w:tblGrid>{''.join(lines)}</w:tbl>"

    def add(self, b: Block) -> None:
        if b.kind == "heading":
            self.out.append(self.styled(f"Heading{b.level}", self.runs(b.lines[0])))
        elif b.kind == "code":
            self.out.append(self.styled("Code", self.run("\n".join(b.lines))))
        elif b.kind == "quote":
            self.out += [self.styled("Quote", self.runs(x)) for x in b.lines if x.strip()]
        elif b.kind == "table":
            self.out += [self.table(b.lines), self.paragraph("")]
        elif b.kind in ("ul", "ol"):
            self.lists.append(b.kind)
            mark = f'<w:numPr><w:ilvl w:val="0"/><w:numId w:val="{len(self.lists)}"/></w:numPr>'
            self.out += [self.paragraph(self.runs(x), mark) for x in b.lines]
        elif b.kind == "image":
            self.out.append(self.paragraph(self.runs(f"[{b.alt or b.target}]({b.target})") if b.target else self.run(b.alt or b.via or "")))
        elif b.kind == "hr":
            self.out.append(self.paragraph("", '<w:pBdr><w:bottom w:val="single" w:sz="6"/></w:pBdr>'))
        else:
            self.out.append(self.paragraph(self.runs(b.lines[0])))

    def parts(self) -> Iterator[tuple[str, str]]:
        link = lambda i, kind, target, more="": f'<Relationship Id="{i}" Type="{_R}/{kind}" Target={quoteattr(_NOT_XML.sub("", target))}{more}/>'
        related = lambda xs: f'{_HEAD}<Relationships xmlns="{_P}/relationships">{"".join(xs)}</Relationships>'
        kinds = "".join(f'<Override PartName="/word/{n}.xml" ContentType="{_TYPES}.{t}+xml"/>' for n, t in (("document", "document.main"), ("styles", "styles"), ("numbering", "numbering")))
        yield "[Content_Types].xml", f'{_HEAD}<Types xmlns="{_P}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{kinds}</Types>'
        yield "_rels/.rels", related([link("main", "officeDocument", "word/document.xml")])
        outside = [link(f"link{n}", "hyperlink", target, ' TargetMode="External"') for n, target in enumerate(self.links, 1)]
        yield "word/_rels/document.xml.rels", related([link("styles", "styles", "styles.xml"), link("numbering", "numbering", "numbering.xml"), *outside])
        yield "word/document.xml", f'{_HEAD}<w:document xmlns:w="{_W}" xmlns:r="{_R}"><w:body>{"".join(self.out)}<w:sectPr/></w:body></w:document>'
        styles = "".join(f'<w:style w:type="{kind}" w:styleId="{i}"><w:name w:val="{name}"/>{look}</w:style>' for i, name, kind, look in _STYLES)
        yield "word/styles.xml", f'{_HEAD}<w:styles xmlns:w="{_W}">{styles}</w:styles>'
        level = lambda fmt, text: f'<w:lvl w:ilvl="0"><w:start w:val="1"/><w:numFmt w:val="{fmt}"/><w:lvlText w:val="{text}"/><w:pPr><w:ind w:left="360" w:hanging="360"/></w:pPr></w:lvl>'
        numbers = "".join(f'<w:abstractNum w:abstractNumId="{n}">{level("bullet", "•") if k == "ul" else level("decimal", "%1.")}</w:abstractNum>' for n, k in enumerate(self.lists, 1))
        used = "".join(f'<w:num w:numId="{n}"><w:abstractNumId w:val="{n}"/></w:num>' for n in range(1, len(self.lists) + 1))
        yield "word/numbering.xml", f'{_HEAD}<w:numbering xmlns:w="{_W}">{numbers}{used}</w:numbering>'


def docx_of(body: str | None) -> bytes:
    """A Markdown text as a package. Equal texts give equal bytes; characters that XML can't hold are left out."""
    document = _Document()
    for b in blocks_of(body):
        document.add(b)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in document.parts():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text, zipfile.ZIP_DEFLATED)
    return data.getvalue()


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    files: int


def file_name(name: str | None) -> str:
    """A name without folders and without characters that file systems refuse; it ends with .docx."""
    bare = re.sub(r'[\x00-\x1f<>:"/\\|?*]+', "_", name or "").strip(" .")
    stem = re.sub(r"(?i)\.docx$", "", bare).encode()[:200].decode(errors="ignore")
    return f"{stem or 'untitled'}.docx"


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex
        self.staging = f"_staging-{self.job}"

    def _files(self) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.path)
        return system, root.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        system, root = self._files()
        folder, names, n = uuid.uuid4().hex, {}, 0
        for row in iterator:
            if n == 0:
                system.create_dir(f"{root}/{self.staging}/{folder}")
            name = file_name(row["name"])
            names[name] = again = names.get(name, 0) + 1
            with system.open_output_stream(f"{root}/{self.staging}/{folder}/{name if again == 1 else f'{name[:-5]} ({again}).docx'}") as out:
                out.write(docx_of(row["body"]))
            n += 1
        return _Written(folder, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = self._files()
        system.create_dir(root)
        if self.overwrite:
            for x in system.get_file_info(fs.FileSelector(root)):
                if x.base_name.startswith("part-") and x.type == fs.FileType.Directory:
                    system.delete_dir(x.path)
        for k, m in enumerate(messages):
            if m is not None and m.files:
                system.move(f"{root}/{self.staging}/{m.folder}", f"{root}/part-{self.job}-{k:05d}")
        self._drop(system, root)
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop(*self._files())

    def _drop(self, system: fs.FileSystem, root: str) -> None:
        if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.staging}")


class DocxSink(DataSource):
    """Format docx: rows of (name, body). The folder must be one that all executors reach by Arrow's file systems (a shared
    mount, HDFS, S3). A null name is untitled, names that repeat in a task are numbered, a null body is an empty document."""

    @classmethod
    def name(cls) -> str:
        return "docx"

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if missing := {"name", "body"} - {*schema.names}:
            raise ValueError(f"no such column: {', '.join(sorted(missing))}")
        return _Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocxSink)
