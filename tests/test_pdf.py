"""PDF files: routes of the usual kinds, text operators, fonts, filters, damaged files."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.plans.pdfs import _stream, file_of, objects, packed_file_of, page_markdown, ruled, table_page, text_at
from corpusloom.sources import pdf, route


def shown(content, **fonts):
    """The lines that a page's content shows; fonts: more of the page's fonts, by name."""
    parts = objects([content])
    for k, (name, body) in enumerate(fonts.items()):
        parts[20 + k] = body
        parts[2] = parts[2].replace(b"/F1 3 0 R", b"/F1 3 0 R /%s %d 0 R" % (name.encode(), 20 + k))
    file = pdf.File(file_of(parts))
    return [b.text for b in pdf.text_lines(pdf.drawn(file, file.pages()[0]).runs)]


def routed(spark, rows):
    return {r.path: r for r in route.pdf_route(pdf.pages(pdf.items(spark.createDataFrame(rows, "path string, content binary")))).collect()}


def test_routes(spark):
    text = text_at(72, 720, "This is embedded document text. " * 8)
    scan = b"q 595 0 0 842 0 0 cm /I1 Do Q"
    table = ruled(72, 720, 320, 120, 3, 2) + b"".join(text_at(x, y, t) for x, y, t in ((82, 696, "Name"), (242, 696, "Value"), (82, 656, "Alpha"), (242, 656, "100"), (82, 616, "Beta"), (242, 616, "200")))
    got = routed(spark, [("text", file_of(objects([text]))), ("scan", packed_file_of(objects([scan]))), ("table", file_of(objects([table]))), ("blank", file_of(objects([b""]))), ("mixed", file_of(objects([text, table])))])
    assert {k: r.bucket for k, r in got.items()} == {"text": "pdf_text", "scan": "needs_ocr", "table": "pdf_table", "blank": "manual_review", "mixed": "pdf_table"}
    assert got["text"].average_text_chars > 40 and got["scan"].image_pages == 1 and got["mixed"].pages == 2


def test_text_operators():
    assert shown(b"BT /F1 10 Tf 50 700 Td (a) Tj 0 -20 Td [(b) -10 (c) -800 (d)] TJ ET") == ["a", "bc d"]
    assert shown(b"BT /F1 10 Tf 14 TL 1 0 0 1 50 700 Tm (x) Tj T* (y) Tj (z) ' 1 2 (w) \" ET") == ["x", "y", "z", "w"]
    assert shown(b"q 2 0 0 2 10 10 cm BT /F1 10 Tf 20 300 TD (big) Tj ET Q BT /F1 9 Tf 20 500 Td (small) Tj ET") == ["big", "small"]
    assert shown(b"BT /F1 10 Tf 50 700 Td (left) Tj 200 0 Td (right) Tj ET") == ["left", "right"]  # columns
    assert shown(b"BT 50 700 Td (no font) Tj ET") == []


def test_strings():
    assert shown(rb"BT /F1 10 Tf 50 700 Td (a\(b\)(c)\\ \101\7z\
n) Tj ET") == ["a(b)(c)\\ A\x07zn"]
    assert shown(b"BT /F1 10 Tf 50 700 Td <48 65 6C6c6F2> Tj % comment (no)\n ET") == ["Hello"]
    assert shown(b"BT /F1 10 Tf 50 700 Td (\xe9\x80\x93) Tj ET") == ["é€“"]


def test_fonts():
    differ = b"<< /Type /Font /Subtype /Type1 /Encoding << /BaseEncoding /WinAnsiEncoding /Differences [65 /Euro /fi /uni6F22 /g12 70 /adieresis] >> >>"
    assert shown(b"BT /F2 10 Tf 50 700 Td (ABCDEF) Tj ET", F2=differ) == ["€fi漢�Eä"]
    cmap = b"/CIDInit /ProcSet findresource begin 2 beginbfchar <0001> <0041> <0002> <D83DDE00> endbfchar 2 beginbfrange <0010> <0012> <0061> <0020> <0021> [<0078> <00790079>] endbfrange"
    wide = b"<< /Type /Font /Subtype /Type0 /Encoding /Identity-H /ToUnicode 30 0 R /DescendantFonts [<< /DW 600 /W [1 [250 300] 16 18 400] >>] >>"
    parts = objects([b"BT /F2 10 Tf 50 700 Td <00010002001000110012002000210099> Tj ET"])
    parts |= {20: wide, 30: _stream(cmap)}
    parts[2] = parts[2].replace(b"/F1 3 0 R", b"/F2 20 0 R")
    file = pdf.File(packed_file_of(parts))
    runs = pdf.drawn(file, file.pages()[0]).runs
    assert [r.text for r in runs] == ["A😀abcxyy�"] and round(runs[0].x1 - runs[0].x0, 6) == 10 * (0.25 + 0.3 + 3 * 0.4 + 3 * 0.6)


def test_filters():
    for data in (b"", b"a", b"hello world" * 30, bytes(range(256))):
        packed = bytearray()
        for k in range(0, len(data), 100):
            piece = data[k : k + 100]
            packed += bytes([len(piece) - 1]) + piece
        assert pdf._runs(bytes(packed) + b"\x80") == data
        assert pdf._hexadecimal(data.hex().encode() + b">") == data
    assert pdf._runs(bytes([254]) + b"x" + b"\x80") == b"xxx"
    import base64

    for data in (b"ab", b"abc", b"abcd" + bytes(4) + b"e", bytes(9)):
        assert pdf._eighty_five(base64.a85encode(data) + b"~>") == data
    rng = random.Random(2)
    rows = [bytes(rng.randrange(256) for _ in range(6)) for _ in range(5)]
    coded = b""
    for n, row in enumerate(rows):
        above, how = rows[n - 1] if n else bytes(6), n % 5
        out = []
        for k, x in enumerate(row):
            a, b, c = row[k - 3] if k >= 3 else 0, above[k], above[k - 3] if k >= 3 else 0
            p = a + b - c
            paeth = min(((abs(p - v), i, v) for i, v in enumerate((a, b, c))))[2]
            out.append(x - (0, a, b, (a + b) // 2, paeth)[how] & 255)
        coded += bytes([how]) + bytes(out)
    assert pdf._predicted(coded, {"Predictor": 15, "Columns": 2, "Colors": 3}) == b"".join(rows)
    assert pdf._predicted(b"x", {"Predictor": 1}) == b"x"


def test_forms_and_inline_images():
    parts = objects([b"q 1 0 0 1 100 0 cm /X1 Do Q BI /W 1 /H 1 ID \xff\x00(Tj EI /I1 Do"])
    parts[20] = _stream(b"BT /F1 10 Tf 5 700 Td (within) Tj ET /X1 Do", b"/Subtype /Form /Matrix [1 0 0 1 10 0]")
    parts[2] = parts[2].replace(b"/I1 4 0 R", b"/I1 4 0 R /X1 20 0 R")
    file = pdf.File(file_of(parts))
    found = pdf.drawn(file, file.pages()[0])
    assert found.images == 2 and found.runs[0].text == "within" and found.runs[0].x0 == 115 and len(found.runs) == pdf.MOST_DEPTH


def test_tables_of_filled_and_stroked_boxes():
    cell = b"%g %g 100 20 re S\n"
    boxes = b"".join(cell % (50 + 100 * x, 700 - 20 * y) for x in range(2) for y in range(3)) + text_at(60, 705, "a") + text_at(160, 665, "f")
    bars = b"".join(b"300 %g 200 0.5 re f\n" % (600 - 30 * k) for k in range(3)) + b"".join(b"%g 540 0.5 60 re f\n" % (300 + 100 * k) for k in range(3)) + text_at(310, 588, "one") + text_at(310, 574, "two")
    file = pdf.File(file_of(objects([boxes + bars + b"0 0 600 800 re S 20 20 m 500 20 l S"])))
    found = pdf.ruled_tables(pdf.drawn(file, file.pages()[0]))
    assert [cells for _, cells in found] == [[["a", ""], ["", ""], ["", "f"]], [["one\ntwo", ""], ["", ""]]]


def test_a_border_around_the_page_is_no_table():
    file = pdf.File(file_of(objects([b"10 10 580 780 re S" + text_at(50, 700, "text")])))
    assert pdf.ruled_tables(pdf.drawn(file, file.pages()[0])) == []


def test_markdown(spark):
    content = file_of(objects([table_page([["H", "I"], ["x|y", "2"]], "Above") + text_at(72, 500, "Below"), text_at(72, 700, "Next")]))
    got = {r.page: r.markdown for r in page_markdown(pdf.items(spark.createDataFrame([("p", content)], "path string, content binary"))).collect()}
    assert got[1] == "<!-- source_page: 1 -->\n\nAbove\n\n### Source PDF page 1 table 1\n\n| H | I |\n| --- | --- |\n| x\\|y | 2 |\n\nBelow" and got[2].endswith("Next")


def test_what_cannot_be_read(spark):
    whole = file_of(objects([text_at(72, 700, "text")]))
    secret = file_of(objects([b""]), b"/Encrypt << /Filter /Standard >>")
    lzw = whole.replace(b"/FlateDecode", b"/LZWDecode  ")
    rows = [("none", None), ("text", b"hello"), ("secret", secret), ("lzw", lzw), ("empty", file_of(objects([]))), ("loop", file_of(objects([b""]) | {2: b"2 0 R"}))]
    got = {r.path: r for r in pdf.items(spark.createDataFrame(rows, "path string, content binary").withColumn("page", F.lit("clash"))).collect()}
    assert {k: (r.kind, r.error) for k, r in got.items()} == {
        "none": ("file", "pdf_failed: no PDF"), "text": ("file", "pdf_failed: no PDF"), "secret": ("file", "pdf_failed: encrypted"),
        "lzw": ("page", "page_failed: filter LZWDecode"), "empty": ("file", None), "loop": ("file", got["loop"].error),
    }
    assert pdf.items(spark.createDataFrame([], "path string, content binary")).collect() == []


@pytest.mark.parametrize("make", [file_of, packed_file_of])
def test_damaged_files_end_in_rows(make):
    """Cut anywhere, or with bytes changed anywhere: rows or an error, in bounded time; without its references a file is read whole."""
    rng = random.Random(1)
    whole = make(objects([table_page([["a", "b"], ["c", "d"]]), text_at(72, 700, "words on a page")]))
    good = list(pdf._rows("p", whole))
    assert [r[11] for r in good if r[3] == "text"][-1] == "words on a page"
    assert [r[3:] for r in pdf._rows("p", whole.replace(b"startxref", b"startxxxx"))] == [r[3:] for r in good]
    for _ in range(250):
        data = bytearray(whole[: rng.randrange(len(whole))] if rng.random() < 0.3 else whole)
        for _ in range(rng.randrange(12)):
            if data:
                data[rng.randrange(len(data))] = rng.randrange(256)
        rows = list(pdf._rows("p", bytes(data)))
        assert rows and all(len(r) == len(pdf._NAMES) for r in rows)
