"""Cleaning of rows with null and empty bodies: none is lost, and bodies are evaluated once a row."""

from pyspark.sql import functions as F

from corpusloom.operators import clean


def test_rows_without_text_stay(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a &amp; b <b>c</b>\n\n\n\nd"), (3, "a &amp; b <b>c</b>\n\n\n\nd")], "doc_id long, body string")
    got = sorted((r.doc_id, r.cleaned) for r in clean.clean_markdown(docs).collect() if r.doc_id > 1)
    assert clean.clean_markdown(docs).count() == clean.clean_lines(docs).count() == 4
    assert got == [(2, "\n"), (3, "a & b c\n\nd\n"), (3, "a & b c\n\nd\n")]


def test_bound_keeps_rows_and_names(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, `b.c` string")
    out = clean.bound(df, "d", F.upper(F.col("`b.c`")))
    assert out.columns == ["a", "b.c", "d"]
    assert sorted(map(tuple, out.collect())) == [(1, None, None), (2, "x", "X")]
    assert {tuple(r) for r in clean.bound(df, "a", F.col("a") + 1).collect()} == {(None, 2), ("x", 3)}
