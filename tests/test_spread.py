"""Work on files that are made of short rows is dealt to all cores, and done once."""

import re
import sys
from xml.etree import ElementTree as ET

import pytest
from conftest import SF

from corpusloom.plans.catalog import QUERIES
from corpusloom.sources import ooxml, pdf


def tasks(df):
    return df.rdd.getNumPartitions()


def calls(f):
    """How many functions are called, whatever the machine."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    before = sys.getprofile()
    sys.setprofile(count)
    try:
        f()
    finally:
        sys.setprofile(before)
    return n


@pytest.mark.parametrize("name", ["pdf_tables", "pdf_file_routes"])
def test_pdf_files_are_dealt(spark, name):
    from corpusloom.plans import pdfs

    assert tasks(pdfs._read(spark, SF)) >= 2 * spark.sparkContext.defaultParallelism
    assert "hashpartitioning(p_partkey" in QUERIES[name](spark, SF)._jdf.queryExecution().toString()


def test_pdf_files_are_read_once(spark):
    assert QUERIES["pdf_page_markdown"](spark, SF)._jdf.queryExecution().toString().count("MapInPandas") == 0


@pytest.mark.parametrize("name", ["workbook_cells", "slide_markdown", "word_cells", "nested_archives", "archive_members", "archive_inventory"])
def test_packages_are_dealt(spark, name):
    assert tasks(QUERIES[name](spark, SF)) >= 2 * spark.sparkContext.defaultParallelism


def test_parts_are_read_once(spark, monkeypatch):
    from corpusloom.plans import office
    from corpusloom.plans.fixtures import load

    content = office._packages(load(spark, SF, "part").where("p_partkey = 1"), office._BOOK).first()["content"]
    opened = []
    plain = ooxml.Package.open
    monkeypatch.setattr(ooxml.Package, "open", lambda self, part: (opened.append(part), plain(self, part))[1])
    found = [*ooxml.cells_of(content)]
    assert len(opened) == len({*opened}) == 7
    monkeypatch.setattr(ooxml, "SMALL", 0)
    assert [*ooxml.cells_of(content)] == found


def test_plain_operators_are_read_at_once(monkeypatch):
    """An operator with its numbers takes one match; it means what it means when it is read object by object."""
    from corpusloom.plans.pdfs import file_of, objects, ruled, text_at

    odd = b"q 1 2 3 4 5 6 7 8 re S Q true 1 0 R null % 9 9 m\n12abc 1e5 --3 +4 -.5 3. m 99999999999999999999 5 l 72 10 m 300 10 l S [1 2] 0 d /F1 9 Tf (k) ' BI x ID zz EI\n"
    file = pdf.File(file_of(objects([ruled(72, 700, 300, 600, 40, 20) + b"".join(b"%d %d 9 9 re f\n" % (k, k) for k in range(300)) + text_at(80, 690, "here"), odd])))
    first, second = file.pages()
    found = [pdf.drawn(file, first), pdf.drawn(file, second)]
    assert len(found[0].lines) == 62 and found[0].runs[0].text == "here"
    assert calls(lambda: pdf.drawn(file, first)) < 50 * 362
    monkeypatch.setattr(pdf, "_PLAIN", re.compile(rb"(?!)"))
    assert [pdf.drawn(file, first), pdf.drawn(file, second)] == found


def test_names_of_parts_are_cut_once():
    cell = '<w:tc><w:tcPr><w:gridSpan w:val="1"/></w:tcPr><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc>'
    tbl = ET.fromstring('<w:tbl xmlns:w="http://x/main">' + f"<w:tr>{cell * 10}</w:tr>" * 50 + "</w:tbl>")
    assert sum(map(len, ooxml.word_rows(tbl))) == 500
    assert calls(lambda: list(ooxml.word_rows(tbl))) < 40 * 500
