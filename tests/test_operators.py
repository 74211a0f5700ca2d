"""The behaviours that the surveyed tests check, as literal rows."""

from pyspark.sql import functions as F

from corpusloom.functions import ocr
from corpusloom.functions import text as T
from corpusloom.operators import audit, clean, tables
from corpusloom.sources import route


def one(df):
    return df.collect()[0]


def test_ocr_text_beats_an_empty_page_aware_body(spark):
    base = spark.createDataFrame([(1, "", True), (2, "b", False)], "doc_id long, body string, is_pdf boolean")
    side = lambda *r: spark.createDataFrame(list(r), "doc_id long, body string")
    got = {r.doc_id: (r.origin, r.body) for r in audit.assembled(base, side((1, "seen")), side((1, ""), (2, "p"), (3, "new"))).collect()}
    assert got == {1: ("ocr", "seen"), 2: ("original", "b"), 3: ("page_aware", "new")}


def test_inspection(spark):
    tiny = "\n".join(chr(0x4E00 + i) for i in range(24))
    docs = spark.createDataFrame([(1, tiny), (2, ""), (3, "a server ERROR � here, and enough other text to be no short one"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in audit.inspected(docs).collect()}
    assert got[1].fragmented and got[2].near_empty and got[3].replacement_char and got[3].provider_error and not got[3].near_empty


def test_page_issues(spark):
    pages = spark.createDataFrame([(1, p, "Only a title" if p == 1 else "") for p in range(1, 8)] + [(2, 1, "x" * 40), (2, 3, "y")], "doc_id long, page int, text string")
    got = {r.doc_id: r for r in audit.page_issues(pages).collect()}
    assert got[1].sparse and got[1].mostly_blank and not got[1].non_contiguous and got[2].non_contiguous


def test_tables(spark):
    docs = spark.createDataFrame([(1, "| A | B |\n| --- | --- |\n| x | y | z |"), (2, "| A | B |\n| value |"), (3, "none")], "doc_id long, body string")
    got = {r.doc_id: r for r in tables.syntax_issues(docs).collect()}
    assert got[1].column_mismatch == 1 and got[1].missing_separator == 0 and got[2].missing_separator == 1 and 3 not in got
    rows = [r.row for r in tables.normalized(docs.where("doc_id = 2")).orderBy("line_no").collect()]
    assert rows == ["| A | B |", "| --- | --- |", "| value ||"]


def test_recall(spark):
    pairs = spark.createDataFrame([(1, "甲甲乙", "乙甲甲"), (2, "甲甲乙", "甲乙"), (3, "--", "")], "item_id long, a string, b string")
    got = {r.item_id: r.recall for r in audit.char_recall(pairs, "a", "b", "item_id").collect()}
    assert got == {1: 1.0, 2: round(2 / 3, 6), 3: 1.0}


def test_chunks_cover_the_text_and_keep_the_limit(spark):
    text = "\n".join("word " * (n % 90) for n in range(400)) + "x" * 5000
    docs = spark.createDataFrame([(1, text), (2, "  \n "), (3, None)], "doc_id long, text string")
    parts = clean.chunk(docs).orderBy("seq").collect()
    assert all(r.doc_id == 1 and 0 < len(r.chunk) <= 2200 for r in parts)
    assert "".join("".join(r.chunk.split()) for r in parts) == "".join(text.split())


def test_cleaning_is_idempotent(spark):
    body = "Page 1 of 2\nhead\nChapter 1 Start here\nhead\n\n\n\nbody text\nhead\n---\nhead\r\nlast"
    docs = spark.createDataFrame([(1, body)], "doc_id long, body string")
    first = one(clean.clean_lines(docs)).cleaned
    assert first == "## Chapter 1 Start here\n\nbody text\nlast\n"
    assert one(clean.clean_lines(spark.createDataFrame([(1, first)], "doc_id long, body string"))).cleaned == first


def test_functions(spark):
    df = spark.createDataFrame([("a/b: c  d.", "3, 1;3，x 2", 10, 4)], "s string, p string, n long, m long")
    r = one(df.select(T.slug(F.col("s")).alias("slug"), T.page_numbers(F.col("p")).alias("pages"), T.sample_indexes(F.col("n"), F.col("m")).alias("at")))
    assert (r.slug, r.pages, r.at) == ("a_b__c_d", [1, 2, 3], [0, 3, 6, 9])
    answers = spark.createDataFrame([("```markdown\n# A\n```",), ('{"text": "t", "content": "c"}',), ("  ",)], "a string")
    assert [r.x for r in answers.select(ocr.answer(F.col("a")).alias("x")).collect()] == ["# A", "t", "[blank page]"]


def test_pdf_routes(spark):
    schema = "path string, page int, n_text_chars int, n_images int, n_tables int, table_detection_ok boolean"
    pages = spark.createDataFrame([("text", 1, 400, 0, 0, True), ("scan", 1, 0, 1, 0, True), ("ruled", 1, 20, 0, 1, True), ("odd", 1, 400, 0, 0, False)], schema)
    assert {r.path: r.bucket for r in route.pdf_route(pages).collect()} == {"text": "pdf_text", "scan": "needs_ocr", "ruled": "pdf_table", "odd": "manual_review"}
