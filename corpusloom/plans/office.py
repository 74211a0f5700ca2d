"""Queries over office packages that are built from the tables' rows, part by part."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..sources import ooxml, readers
from ..sources.docx_sink import docx_of
from .catalog import query
from .fixtures import dealt

_NS = "http://schemas.openxmlformats.org"
_RELATION = f"{_NS}/officeDocument/2006/relationships"


def _relations(*links: tuple[str, str, str]) -> str:
    inner = "".join(f'<Relationship Id="{i}" Type="{_RELATION}/{kind}" Target="{target}"/>' for i, kind, target in links)
    return f'<Relationships xmlns="{_NS}/package/2006/relationships">{inner}</Relationships>'


def _packages(part: DataFrame, parts: dict[str, str]) -> DataFrame:
    """(path, content): for each row a package of parts, whose texts are SQL expressions; every tenth is no package."""
    names = F.when(F.expr("p_partkey % 10 <> 9"), F.array(*(F.lit(n) for n in parts)))
    texts = F.array(*(F.expr(t) for t in parts.values()))
    return part.select(F.col("p_partkey").cast("string").alias("path"), readers.zipped(names, texts).alias("content"))


def _quoted(text: str) -> str:
    """Text with {expressions} as an SQL expression."""
    out, rest = [], text
    while rest:
        plain, _, rest = rest.partition("{")
        inner, _, rest = rest.partition("}")
        out += ["'" + plain.replace("'", "''") + "'", *([f"CAST({inner} AS STRING)"] if inner else [])]
    return f"concat({', '.join(out)})"


_WORD = f"{_NS}/wordprocessingml/2006/main"
_P = "<w:p><w:r><w:t>%s</w:t></w:r></w:p>"
_DOCUMENT = f"""<w:document xmlns:w="{_WORD}"><w:body>{_P % "before"}<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr>{_P % "A {p_name}"}</w:tc><w:tc><w:tcPr><w:vMerge w:val="restart"/></w:tcPr>
<w:p><w:r><w:t>B</w:t><w:tab/><w:t>c</w:t></w:r><w:del><w:r><w:delText>gone</w:delText></w:r></w:del></w:p>{_P % "{p_partkey}"}</w:tc></w:tr><w:tr><w:tc>{_P % "{p_brand}"}<w:tbl><w:tr><w:tc>{_P % "inner"}</w:tc></w:tr></w:tbl></w:tc><w:tc><w:p/></w:tc>
<w:tc><w:tcPr><w:vMerge/></w:tcPr><w:p/></w:tc></w:tr></w:tbl><w:tbl>{{array_join(transform(sequence(1, p_size % 3 + 1), i -> '<w:tr><w:tc><w:p><w:r><w:t>r' || i || '</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>' || p_brand || '</w:t></w:r></w:p></w:tc></w:tr>'), '')}}</w:tbl></w:body></w:document>"""


@query("""WITH p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS path FROM part), g AS (SELECT * FROM p WHERE p_partkey % 10 <> 9),
a AS (SELECT path, 1 AS part_no, unnest([1, 1, 1, 2, 2, 2]) AS row_no, unnest([1, 2, 3, 1, 2, 3]) AS col_no, unnest(['A ' || p_name, 'A ' || p_name, 'B' || chr(9) || 'c' || chr(10) || p_partkey, p_brand, '', 'B' || chr(9) || 'c' || chr(10) || p_partkey]) AS text,
 unnest([false, true, false, false, false, true]) AS merged FROM g),
r AS (SELECT path, p_brand, unnest(range(1, p_size % 3 + 2)) AS i FROM g),
b AS (SELECT path, 2, i, unnest([1, 2]), unnest(['r' || i, p_brand]), false FROM r)
SELECT path, 'docx' AS kind, part_no::INTEGER AS part_no, row_no::INTEGER AS row_no, col_no::INTEGER AS col_no, text, merged, NULL AS error FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
UNION ALL SELECT path, NULL, NULL, NULL, NULL, NULL, NULL, 'package_failed: BadZipFile' FROM p WHERE p_partkey % 10 = 9""")
def word_cells(spark, sf_dir):
    parts = {"_rels/.rels": _quoted(_relations(("a", "officeDocument", "doc/main.xml"))), "doc/main.xml": _quoted(_DOCUMENT)}
    return ooxml.office_cells(_packages(dealt(spark, sf_dir, "part", "p_partkey"), parts)).drop("name")


_SHEET = f"{_NS}/spreadsheetml/2006/main"
_BOOK = {
    "_rels/.rels": _quoted(_relations(("a", "officeDocument", "/xl/book.xml"))),
    "xl/book.xml": _quoted(f'<workbook xmlns="{_SHEET}" xmlns:r="{_RELATION}"><sheets><sheet name="Prices" sheetId="7" r:id="s2"/><sheet name="Rest" sheetId="1" r:id="s1"/></sheets></workbook>'),
    "xl/_rels/book.xml.rels": _quoted(_relations(("s1", "worksheet", "b.xml"), ("s2", "worksheet", "sheets/a.xml"), ("t", "sharedStrings", "texts.xml"), ("u", "styles", "styles.xml"))),
    "xl/texts.xml": _quoted(f'<sst xmlns="{_SHEET}"><si><t>{{p_name}}</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>'),
    "xl/styles.xml": _quoted(f'<styleSheet xmlns="{_SHEET}"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>'),
    "xl/sheets/a.xml": _quoted(
        f'<worksheet xmlns="{_SHEET}"><sheetData><row r="3"><c r="B3" t="s"><v>0</v></c><c r="D3" t="s"><v>1</v></c><c r="AB3"><v>{{p_size}}</v></c></row><row><c t="b"><v>1</v></c><c t="inlineStr"><is><t>{{p_brand}}</t></is></c>'
        f'<c s="1"><v>{{40000 + p_partkey}}</v></c><c s="2"><v>{{40000 + p_partkey}}.25</v></c><c/></row></sheetData><mergeCells><mergeCell ref="B3:C9"/></mergeCells></worksheet>'
    ),
    "xl/b.xml": _quoted(f'<worksheet xmlns="{_SHEET}"><sheetData><row><c t="str"><v>{{p_partkey}}</v></c></row></sheetData></worksheet>'),
}


@query("""WITH p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS path, strftime(DATE '1899-12-30' + CAST(40000 + p_partkey AS INTEGER), '%Y-%m-%d') AS day FROM part)
SELECT path, 'xlsx' AS kind, unnest([1, 1, 1, 1, 1, 1, 1, 2])::INTEGER AS part_no, unnest(['Prices', 'Prices', 'Prices', 'Prices', 'Prices', 'Prices', 'Prices', 'Rest']) AS name, unnest([3, 3, 3, 4, 4, 4, 4, 1])::INTEGER AS row_no,
 unnest([2, 4, 28, 1, 2, 3, 4, 1])::INTEGER AS col_no, unnest([p_name, 'rich', p_size::VARCHAR, 'TRUE', p_brand, day, day || ' 06:00:00', p_partkey::VARCHAR]) AS text,
 unnest([true, false, false, false, false, false, false, false]) AS merged FROM p WHERE p_partkey % 10 <> 9""")
def workbook_cells(spark, sf_dir):
    return ooxml.office_cells(_packages(dealt(spark, sf_dir, "part", "p_partkey"), _BOOK)).where("error IS NULL").drop("error")


_DRAWING, _SLIDES = f"{_NS}/drawingml/2006/main", f"{_NS}/presentationml/2006/main"
_BODY = "<p:txBody><a:p><a:r><a:t>%s</a:t></a:r></a:p></p:txBody>"
_SHAPE = '<p:sp><p:nvSpPr><p:nvPr><p:ph type="%s"/></p:nvPr></p:nvSpPr>' + _BODY + "</p:sp>"
_TREE = f'<p:%s xmlns:p="{_SLIDES}" xmlns:a="{_DRAWING}"><p:cSld><p:spTree>%s</p:spTree></p:cSld></p:%s>'
_CELL = "<a:tc%s><a:txBody><a:p><a:r><a:t>%s</a:t></a:r></a:p></a:txBody></a:tc>"
_GRID = f'<p:graphicFrame><a:tbl><a:tr>{_CELL % (" gridSpan=\"2\"", "{p_brand}")}{_CELL % (" hMerge=\"1\"", "")}</a:tr><a:tr>{_CELL % ("", "x|y")}{_CELL % ("", "{p_size}")}</a:tr></a:tbl></p:graphicFrame>'
_SHOW = {
    "_rels/.rels": _quoted(_relations(("a", "officeDocument", "ppt/show.xml"))),
    "ppt/show.xml": _quoted(f'<p:presentation xmlns:p="{_SLIDES}" xmlns:r="{_RELATION}"><p:sldIdLst><p:sldId id="256" r:id="r2"/><p:sldId id="257" r:id="r1"/></p:sldIdLst></p:presentation>'),
    "ppt/_rels/show.xml.rels": _quoted(_relations(("r1", "slide", "s1.xml"), ("r2", "slide", "s2.xml"))),
    "ppt/s2.xml": _quoted(_TREE % ("sld", _SHAPE % ("title", "{p_name}") + _SHAPE % ("sldNum", "1") + f"<p:grpSp>{_SHAPE % ('body', 'in a group')}</p:grpSp>", "sld")),
    "ppt/s1.xml": _quoted(_TREE % ("sld", _GRID, "sld")),
    "ppt/_rels/s1.xml.rels": _quoted(_relations(("n", "notesSlide", "../notes/n.xml"))),
    "notes/n.xml": _quoted(_TREE % ("notes", _SHAPE % ("body", "say {p_partkey}"), "notes")),
}


@query("""SELECT CAST(p_partkey AS VARCHAR) AS path, CASE WHEN p_partkey % 10 <> 9 THEN 'pptx' END AS kind, CASE WHEN p_partkey % 10 <> 9 THEN '<!-- Slide number: 1 -->' || chr(10) || chr(10) || '# ' || p_name || chr(10) || chr(10) || 'in a group' || chr(10) || chr(10)
 || '<!-- Slide number: 2 -->' || chr(10) || chr(10) || '| ' || p_brand || ' | ' || p_brand || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| x\\|y | ' || p_size || ' |' || chr(10) || chr(10) || '### Notes:' || chr(10) || chr(10) || 'say ' || p_partkey || chr(10) END AS markdown,
 CASE WHEN p_partkey % 10 = 9 THEN 'package_failed: BadZipFile' END AS error FROM part""")
def slide_markdown(spark, sf_dir):
    return ooxml.office_markdown(_packages(dealt(spark, sf_dir, "part", "p_partkey"), _SHOW))


@F.pandas_udf(BinaryType())
def _docx(bodies: pd.Series) -> pd.Series:
    return bodies.map(docx_of)


_MARKDOWN = """'# Head ' || doc_id || chr(10) || chr(10) || 'see **' || lang || '** and [it](http://x/' || doc_id || '), `a*b`' || chr(10) || chr(10) || '- one' || chr(10) || '- *two*' || chr(10) || chr(10) || '1. a' || chr(10) || '1. b' || chr(10) || chr(10)
 || '> q ' || source || chr(10) || chr(10) || '| A | ' || source || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| 1<br>2 | x\\|y |' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '```' || chr(10) || 'SELECT *' || chr(10) || '  FROM <t>' || chr(10) || '```' || chr(10) || chr(10) || '###### & ' || lang"""


@query(f"SELECT CAST(doc_id AS VARCHAR) AS path, 'docx' AS kind, {_MARKDOWN} || chr(10) AS markdown FROM documents")
def docx_round_trip(spark, sf_dir):
    docs = dealt(spark, sf_dir, "documents", "doc_id").select(F.col("doc_id").cast("string").alias("path"), _docx(F.expr(_MARKDOWN.replace("\\", "\\\\"))).alias("content"))
    return ooxml.office_markdown(docs).drop("error")
