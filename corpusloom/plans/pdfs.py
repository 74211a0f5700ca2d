"""PDF files made from the tables' rows, object by object, and what is read from them."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..operators import pages, tables
from ..sources import pdf, route, scratch
from .catalog import query
from .fixtures import dealt


def _stream(data: bytes, about: bytes = b"") -> bytes:
    packed = zlib.compress(data)
    return b"<< /Length %d /Filter /FlateDecode %s >>\nstream\n%s\nendstream" % (len(packed), about, packed)


def _literal(text: str) -> bytes:
    return b"(" + text.encode("cp1252").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b")"


def text_at(x: float, y: float, text: str, size: float = 11) -> bytes:
    return b"BT /F1 %g Tf %g %g Td %s Tj ET\n" % (size, x, y, _literal(text))


def ruled(left: float, top: float, width: float, height: float, rows: int, columns: int) -> bytes:
    """The lines of a table, from its upper left corner."""
    across = [b"%g %g m %g %g l S\n" % (left, top - k * height / rows, left + width, top - k * height / rows) for k in range(rows + 1)]
    down = [b"%g %g m %g %g l S\n" % (left + k * width / columns, top, left + k * width / columns, top - height) for k in range(columns + 1)]
    return b"".join(across + down)


def objects(contents: list[bytes]) -> dict[int, bytes]:
    """The objects of a file with these pages; /I1 is an image, /F1 a font of equal widths."""
    kids = b" ".join(b"%d 0 R" % (5 + 2 * k) for k in range(len(contents)))
    out = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>",
        2: b"<< /Type /Pages /Count %d /MediaBox [0 0 600 800] /Resources << /Font << /F1 3 0 R >> /XObject << /I1 4 0 R >> >> /Kids [%s] >>" % (len(contents), kids),
        3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>",
        4: _stream(b"\xff" * 12, b"/Type /XObject /Subtype /Image /Width 2 /Height 2 /ColorSpace /DeviceRGB /BitsPerComponent 8"),
    }
    for k, data in enumerate(contents):
        out[5 + 2 * k] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (6 + 2 * k)
        out[6 + 2 * k] = _stream(data)
    return out


def file_of(parts: dict[int, bytes], more: bytes = b"") -> bytes:
    """A file with a cross-reference table."""
    out, places = b"%PDF-1.4\n%\xe2\xe3\xcf\xd3\n", {}
    for n, body in parts.items():
        places[n] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    size = max(parts) + 1
    rows = b"".join(b"%010d 00000 n \n" % places[n] if n in places else b"0000000000 65535 f \n" for n in range(size))
    return out + b"xref\n0 %d\n%strailer\n<< /Size %d /Root 1 0 R %s >>\nstartxref\n%d\n%%%%EOF\n" % (size, rows, size, more, len(out))


def packed_file_of(parts: dict[int, bytes]) -> bytes:
    """A file whose plain objects are in an object stream and whose cross-references are a stream of differences."""
    plain = {n: b for n, b in parts.items() if b"stream\n" not in b}
    heads, bodies = [], b""
    for n, body in plain.items():
        heads.append(b"%d %d" % (n, len(bodies)))
        bodies += body + b" "
    head = b" ".join(heads) + b" "
    holder, table = max(parts) + 1, max(parts) + 2
    streams = {n: b for n, b in parts.items() if n not in plain} | {holder: _stream(head + bodies, b"/Type /ObjStm /N %d /First %d" % (len(plain), len(head)))}
    out, rows = b"%PDF-1.5\n", {0: (0, 0, 0)}
    for n, body in streams.items():
        rows[n] = (1, len(out), 0)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    rows |= {n: (2, holder, k) for k, n in enumerate(plain)} | {table: (1, len(out), 0)}
    raw = [bytes([a]) + b.to_bytes(3, "big") + bytes([c]) for a, b, c in (rows.get(n, (0, 0, 0)) for n in range(table + 1))]
    up = b"".join(b"\x02" + bytes((x - y) & 255 for x, y in zip(r, p)) for r, p in zip(raw, [bytes(5), *raw]))
    about = b"/Type /XRef /Size %d /W [1 3 1] /Root 1 0 R /DecodeParms << /Predictor 12 /Columns 5 >>" % (table + 1)
    return out + b"%d 0 obj\n%s\nendobj\nstartxref\n%d\n%%%%EOF\n" % (table, _stream(up, about), len(out))


def table_page(cells: list[list[str]], before: str = "") -> bytes:
    out = text_at(72, 760, before) if before else b""
    out += ruled(72, 700, 300, 40 * len(cells), len(cells), len(cells[0]))
    return out + b"".join(text_at(80 + k * 300 / len(cells[0]), 676 - 40 * y, c) for y, row in enumerate(cells) for k, c in enumerate(row) if c)


@F.pandas_udf(BinaryType())
def _pdfs(kinds: pd.Series, names: pd.Series, brands: pd.Series) -> pd.Series:
    """Text, an image, a table, a page of each; of these the fourth has lost its cross-references; and what is no PDF."""

    def one(kind: int, name: str, brand: str) -> bytes:
        text = text_at(72, 720, f"{name} is the name") + text_at(72, 706, f"of {brand} (all of it) and more text of it")
        table = table_page([["Name", "Value"], [name, "100"], [brand, ""]], "Before it")
        image = b"q 100 0 0 100 72 600 cm /I1 Do Q\n"
        found = objects([[text], [image], [table], [text, image, table]][kind] if kind < 4 else [])
        if kind == 4:
            return b"no PDF at all"
        whole = packed_file_of(found) if kind == 1 else file_of(found)
        return whole.replace(b"startxref", b"startxxxx").replace(b"xref\n0", b"xxxx\n0") if kind == 3 else whole

    return pd.Series([one(*x) for x in zip(kinds, names, brands)])


def _read(spark, sf_dir) -> DataFrame:
    part = dealt(spark, sf_dir, "part", "p_partkey").select(F.col("p_partkey").cast("string").alias("path"), _pdfs(F.expr("p_partkey % 5"), "p_name", "p_brand").alias("content"))
    return pdf.items(part)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS path, CAST(k.n AS BIGINT) AS pages, round(CASE p_partkey % 5 WHEN 0 THEN t WHEN 1 THEN 0 WHEN 2 THEN b ELSE (t + b) / 3.0 END, 1) AS average_text_chars,
 CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN (b < 40)::INT ELSE 1 + (b < 40)::INT END::BIGINT AS low_text_pages, CASE WHEN p_partkey % 5 IN (1, 3) THEN 1 ELSE 0 END::BIGINT AS image_pages,
 CASE WHEN p_partkey % 5 >= 2 THEN 1 ELSE 0 END::BIGINT AS table_pages, CASE p_partkey % 5 WHEN 0 THEN 'pdf_text' WHEN 1 THEN 'needs_ocr' ELSE 'pdf_table' END AS bucket
FROM (SELECT *, length(p_name || ' is the name' || chr(10) || 'of ' || p_brand || ' (all of it) and more text of it') AS t, length('Before it' || 'Name' || 'Value' || p_name || '100' || p_brand) + 5 AS b FROM part)
JOIN (SELECT unnest([0, 1, 2, 3]) AS m, unnest([1, 1, 1, 3]) AS n) AS k ON k.m = p_partkey % 5""")
def pdf_file_routes(spark, sf_dir):
    return route.pdf_route(pdf.pages(_read(spark, sf_dir)))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS path, CASE WHEN p_partkey % 5 = 2 THEN 1 ELSE 3 END AS page, 1 AS table_no, CAST(unnest([1, 2, 3]) AS INTEGER) AS row_no, unnest(['Name|Value', p_name || '|100', p_brand || '|']) AS cells FROM part WHERE p_partkey % 5 IN (2, 3)""")
def pdf_tables(spark, sf_dir):
    return pdf.table_rows(_read(spark, sf_dir)).select("path", "page", "table_no", "row_no", F.array_join("cells", "|").alias("cells"))


def page_markdown(found: DataFrame) -> DataFrame:
    """items() -> path, page, markdown: text outside tables, and tables, in reading order under their page's mark."""
    keys = ["path", "page"]
    box = ["x0", "y0", "x1", "y1"]
    rows = pdf.table_rows(found)
    places = rows.select(*keys, *box).distinct()
    texts = tables.outside_boxes(found.where("kind = 'text'").select(*keys, *box, "text"), places, keys).select(*keys, F.lit("text").alias("kind"), F.col("x0").alias("x"), F.col("y0").alias("y"), "text")
    drawn = tables.rendered(rows, [*keys, "table_no", "x0", "y0"], "row_no")
    head = F.concat(F.lit("### Source PDF page "), F.col("page").cast("string"), F.lit(" table "), F.col("table_no").cast("string"), F.lit("\n\n"), "markdown")
    return pages.interleaved(texts.unionByName(drawn.select(*keys, F.lit("table").alias("kind"), F.col("x0").alias("x"), F.col("y0").alias("y"), head.alias("text"))), ["path"])


@query("""WITH t AS (SELECT CAST(p_partkey AS VARCHAR) AS path, p_partkey % 5 AS k, p_name || ' is the name' || chr(10) || 'of ' || p_brand || ' (all of it) and more text of it' AS words,
 '| Name | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || p_name || ' | 100 |' || chr(10) || '| ' || p_brand || ' |  |' AS grid FROM part)
SELECT path, 1 AS page, '<!-- source_page: 1 -->' || chr(10) || chr(10) || words AS markdown FROM t WHERE k IN (0, 3)
UNION ALL SELECT path, CASE k WHEN 2 THEN 1 ELSE 3 END, '<!-- source_page: ' || CASE k WHEN 2 THEN 1 ELSE 3 END || ' -->' || chr(10) || chr(10) || 'Before it' || chr(10) || chr(10) || '### Source PDF page ' || CASE k WHEN 2 THEN 1 ELSE 3 END || ' table 1' || chr(10) || chr(10) || grid FROM t WHERE k IN (2, 3)""")
def pdf_page_markdown(spark, sf_dir):
    path = scratch.folder(spark, "pdf")
    found = _read(spark, sf_dir)
    found.write.parquet(path)  # read four times, and the files only once
    return page_markdown(spark.read.schema(found.schema).parquet(path))
