"""Office packages: odd and broken ones, Markdown there and back, and the sink's commit and abort."""

import io
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpusloom.functions.blocks import blocks_of
from corpusloom.plans import office
from corpusloom.sources import docx_sink, ooxml, readers
from corpusloom.sources.docx_sink import docx_of, file_name


def package(parts):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return data.getvalue()


def word(body, **more):
    main = f'<w:document xmlns:w="{office._WORD}" xmlns:r="{office._RELATION}"><w:body>{body}</w:body></w:document>'
    return package({"_rels/.rels": office._relations(("a", "officeDocument", "w/d.xml")), "w/d.xml": main, **more})


def cells(content):
    return [(n, y, x, t, m) for _, n, _, y, x, t, m in ooxml.cells_of(content)]


P = "<w:p><w:r><w:t>%s</w:t></w:r></w:p>"


def test_merged_cells_against_a_plain_grid():
    """Spans of columns and rows of every kind: each place shows the text of the cell that covers it."""
    row = lambda *cs: "<w:tr>" + "".join(f"<w:tc><w:tcPr>{a}</w:tcPr>{P % t}</w:tc>" for t, a in cs) + "</w:tr>"
    span, start, on = '<w:gridSpan w:val="2"/>', '<w:vMerge w:val="restart"/>', "<w:vMerge/>"
    body = "<w:tbl>" + row(("a", span + start), ("b", "")) + row(("", span + on), ("c", start)) + row(("d", ""), ("e", ""), ("", on)) + row(("", on), ("f", span)) + "</w:tbl>"
    found = cells(word(body))
    assert [t for *_, t, _ in found] == ["a", "a", "b", "a", "a", "c", "d", "e", "c", "d", "f", "f"]
    assert [m for *_, m in found] == [False, True, False, True, True, False, False, False, True, True, False, True]
    assert [(y, x) for _, y, x, *_ in found] == [(y, x) for y in range(1, 5) for x in range(1, 4)]


def test_skipped_columns_and_parts_that_are_not_shown():
    body = f'<w:tbl><w:tr><w:trPr><w:gridBefore w:val="2"/></w:trPr><w:tc>{P % "x"}</w:tc></w:tr></w:tbl><w:sdt><w:sdtContent><w:tbl><w:tr><w:tc>{P % "not of the body"}</w:tc></w:tr></w:tbl></w:sdtContent></w:sdt>'
    assert cells(word(body)) == [(1, 1, 3, "x", False)]
    field = '<w:p><w:r><w:instrText>PAGE</w:instrText></w:r><w:ins><w:r><w:t>new</w:t></w:r></w:ins><w:del><w:r><w:t>old</w:t></w:r></w:del><w:r><w:noBreakHyphen/><w:br/><w:t>l</w:t></w:r></w:p>'
    assert ooxml.markdown_of_package(word(field)) == ("docx", "new-\nl\n")


@pytest.mark.parametrize(
    "content",
    [
        None,
        b"",
        b"text",
        package({"a.txt": "x"}),
        package({"_rels/.rels": office._relations(("a", "officeDocument", "none.xml"))}),
        package({"_rels/.rels": office._relations(("a", "officeDocument", "d.xml")), "d.xml": "<open>"}),
        package({"_rels/.rels": office._relations(("a", "officeDocument", "d.xml")), "d.xml": "<other/>"}),
        word('<!DOCTYPE x [<!ENTITY a "b">]>'),
        docx_of("# a\n\n" + "word " * 500)[:-40],
    ],
)
def test_broken_packages(spark, content):
    df = spark.createDataFrame([("p", content), ("ok", docx_of("| a |\n|---|\n| b |"))], "path string, content binary").withColumn("text", F.lit("clash"))
    found = ooxml.office_cells(df).collect()
    assert [(r.path, r.error is None) for r in found] == [("p", False), ("ok", True), ("ok", True)]
    texts = {r.path: r for r in ooxml.office_markdown(df).collect()}
    assert texts["p"].markdown is None and texts["p"].error.startswith("package_failed") and texts["ok"].markdown == "| a |\n| --- |\n| b |\n"
    assert {r.path: r.error is None for r in readers.converted(df.withColumn("path", F.concat("path", F.lit(".DOCX")))).collect()} == {"p.DOCX": False, "ok.DOCX": True}


def test_no_packages(spark):
    assert ooxml.office_cells(spark.createDataFrame([], "path string, content binary")).collect() == []


def test_long_sheets_leave_in_frames(monkeypatch):
    monkeypatch.setattr(ooxml, "FRAME_ROWS", 100)
    rows = "".join(f'<row r="{y}"><c><v>{y}</v></c></row>' for y in range(1, 1002))
    main = f'<workbook xmlns="{office._SHEET}" xmlns:r="{office._RELATION}"><sheets><sheet name="s" r:id="a"/></sheets></workbook>'
    book = package({"_rels/.rels": office._relations(("a", "officeDocument", "b.xml")), "b.xml": main, "_rels/b.xml.rels": office._relations(("a", "worksheet", "s.xml")), "s.xml": f'<worksheet xmlns="{office._SHEET}"><sheetData>{rows}</sheetData></worksheet>'})
    frames = list(ooxml._framed(ooxml._cell_rows, ooxml._CELL_NAMES)(iter([ooxml.pd.DataFrame({"path": ["p"], "content": [book]})])))
    assert [len(f) for f in frames] == [100] * 10 + [1] and [x for f in frames for x in f["text"]] == [str(y) for y in range(1, 1002)]


BODY = "# T <&>\n\np **b** *i* `c` [l](http://u?a=1&b=2)\n\n- a\n- b\n\n1. c\n\n- d\n\n> q1\n> q2\n\n| A | B |\n|---|---|\n| x<br>y | p\\|q |\n| one |\n\n---\n\n```py\ncode\n\n  <x>\n```\n\n> ![pic][m]\n\n[m]: p.png"


def test_markdown_there_and_back():
    kind, text = ooxml.markdown_of_package(docx_of(BODY))
    assert kind == "docx"
    got = [(b.kind, list(b.lines)) for b in blocks_of(text)]
    want = [(b.kind, list(b.lines)) for b in blocks_of(BODY)]
    want = [("p", ["[pic](p.png)"]) if k == "image" else (k, ls) for k, ls in want]
    want = [(k, ["| A | B |", "| x<br>y | p\\|q |", "| one |  |"]) if k == "table" else (k, ls) for k, ls in want]
    assert got == want
    assert docx_of(BODY) == docx_of(BODY) and ooxml.markdown_of_package(docx_of("a\x01b\x00c"))[1] == "abc\n"
    assert ooxml.markdown_of_package(docx_of(None))[1] == "\n"


@pytest.mark.parametrize("name,want", [("a", "a.docx"), ("a.DOCX", "a.docx"), ("../x/y", "_x_y.docx"), (None, "untitled.docx"), ("..", "untitled.docx"), ("é" * 200, "é" * 100 + ".docx")])
def test_file_names(name, want):
    assert file_name(name) == want


def test_sink_commits_all_or_nothing(spark, tmp_path):
    docx_sink.register(spark)
    out = str(tmp_path / "out")
    rows = [(f"doc {i % 7}", f"# Head {i}\n\n| a | {i} |\n|---|---|\n| b | c |") for i in range(40)] + [(None, None)]
    df = spark.createDataFrame(rows, "name string, body string").repartition(3)
    df.write.format("docx").mode("append").save(out)
    files = readers.files(spark, out, "*.docx")
    assert files.count() == 41 and not list((tmp_path / "out").glob("_staging*")) and (tmp_path / "out/_SUCCESS").exists()
    back = ooxml.office_cells(files)
    assert sorted(int(r.text) for r in back.where("row_no = 1 AND col_no = 2").collect()) == list(range(40))

    bad = df.withColumn("body", F.when(F.col("name") == "doc 3", F.raise_error(F.lit("fails on purpose"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="fails on purpose"):
        bad.write.format("docx").mode("append").save(out)
    assert readers.files(spark, out, "*.docx").count() == 41 and not list((tmp_path / "out").glob("_staging*"))

    df.limit(2).write.format("docx").mode("overwrite").save(out)
    assert readers.files(spark, out, "*.docx").count() == 2


def test_a_lost_attempt_leaves_nothing(tmp_path):
    """A task that runs twice, as after the loss of an executor: only the attempt that reported counts."""
    writer = docx_sink._Writer(str(tmp_path), False)
    with pytest.raises(ZeroDivisionError):
        writer.write(Row(name="x", body=str(1 // (1 - k))) for k in range(2))
    first = writer.write(iter([Row(name="x", body="lost")]))
    second = writer.write(iter([Row(name="x", body="kept"), Row(name="x", body="again")]))
    assert first.folder != second.folder
    writer.commit([second, writer.write(iter([])), None])
    left = sorted(p.relative_to(tmp_path).as_posix() for p in tmp_path.rglob("*") if p.is_file())
    assert [x.split("/")[-1] for x in left] == ["_SUCCESS", "x (2).docx", "x.docx"] and len({x.split("/")[0] for x in left}) == 2
    assert ooxml.markdown_of_package(next(tmp_path.rglob("x.docx")).read_bytes())[1] == "kept\n"
