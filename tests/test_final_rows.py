"""The final audit gives its counts with each global issue."""

from conftest import SF

from corpusloom.operators import audit
from corpusloom.plans.catalog import QUERIES


def test_each_issue_has_its_row(spark):
    rows = QUERIES["final_audit"](spark, SF).collect()
    named = {(r["nth"], r["issue"]) for r in QUERIES["final_issues"](spark, SF).collect()}
    assert {(r["nth"], r["issue"]) for r in rows} == named and any("invalid_chunk_json_line:" in x for _, x in named)
    assert {r["global_issues"] for r in rows} == {len(rows)} and len({r[:8] for r in rows}) == 1


def test_a_clean_corpus_has_one_row(spark):
    docs = spark.createDataFrame([("d", "s", "", [])], "doc_id string, source_path string, member string, issues array<string>")
    chunks = spark.createDataFrame([("c", "d", "m", "s", None)], "chunk_id string, doc_id string, markdown_path string, source_path string, bad_line int")
    inventory = spark.createDataFrame([("m",), ("s",)], "path string")
    assert [tuple(r) for r in audit.audited_issues(docs, chunks, inventory, 1).collect()] == [(1, 0, 1, 1, 1, 1, 0, True, None, None)]
    found = audit.audited_issues(docs, chunks, inventory, 2).collect()
    assert [(r["nth"], r["issue"], r["global_issues"], r["clean"]) for r in found] == [(0, "document_count_mismatch:1!=2", 1, False)]
