"""Reports word for word, in order, of one file; long and empty ones."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import reports


def text(lines):
    return [r.line for r in lines.orderBy("part", "key").collect()]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_conversion(spark):
    rows = [("converted",)] * 12 + [("failed",), ("archive_failed",), (None,)]
    got = text(reports.conversion(frame(spark, rows, "conversion_status string"), 7))
    assert got[:9] == ["# Conversion Report", "", "## Summary", "", "- Manifest records: 15", "- Retrieval chunks: 7", "- archive_failed: 1", "- converted: 12", "- failed: 1"]
    assert got[9:13] == ["- unknown: 1", "", "## Acceptance Checks", ""] and got[-1].startswith("- Automated conversion can miss") and len(got) == 22


def test_unresolved(spark):
    schema = "nth long, conversion_status string, quality_status string, ocr_status string, source_path string, archive_member_path string, error string, probe_note string"
    rows = [(10, "failed", "unresolved", None, "in/b", "m.txt", "boom", ""), (2, "converted", "needs_review", "needs_ocr", "in/a", "", None, "low text")]
    assert text(reports.unresolved(frame(spark, rows, schema))) == [
        "# Unresolved and Review Items", "",
        "- `converted` `needs_review` `needs_ocr`", "  - Source: in/a", "  - Probe: low text",
        "- `failed` `unresolved` ``", "  - Source: in/b", "  - Archive member: m.txt", "  - Error: boom",
    ]
    assert text(reports.unresolved(spark.createDataFrame([], schema))) == ["# Unresolved and Review Items", "", "No unresolved items found by automated checks."]


def test_preflight(spark):
    rows = [(k, f"t{k}", "scanned", k % 5, [1, k], None) for k in range(1, 60)] + [(60, "bad", "error", None, None, "no file")]
    got = text(reports.preflight(frame(spark, rows, "nth long, title string, status string, tables long, table_pages array<int>, error string")))
    want = sorted((r for r in rows if r[3]), key=lambda r: -r[3])[:30]
    assert got == [
        "# PDF Table Preflight Report", "", "- PDFs scanned: 60", "- PDFs with detected tables: 48", f"- Total detected tables: {sum(r[3] or 0 for r in rows)}", "- Errors: 1", "", "## High Table Count Files", "",
        *(f"- `{t}`: tables={n}, pages=1,{k}" for k, t, _, n, *_ in want), "", "## Errors", "", "- `bad`: no file",
    ]


def test_page_repair(spark):
    rows = [(2, "f2", "T2", "error", None, "why"), (1, "f1", "T1", "converted", 3, ""), (3, "f3", "T3", "converted", 0, "")]
    schema = "nth long, file_id string, title string, status string, tables long, note string"
    got = text(reports.page_repair(frame(spark, rows, schema), "out", 4))
    assert got[:7] == ["# PDF Page Table Repair Report", "", "- Output root: `out`", "- Converted PDFs: 2", "- PDFs with detected tables: 1", "- Errors: 1", "- Repaired chunks: 4"]
    assert got[-3:] == ["## Errors", "", "- `f2` T2: why"]
    assert text(reports.page_repair(frame(spark, rows[1:], schema), "out", 4))[-1] == "- none"


def test_quality(spark):
    files = [(k, f"s{k}", ("green", "yellow", "red")[k % 3], "r" * 300, k) for k in range(300)]
    got = text(reports.quality(frame(spark, files, "nth long, source_name string, level string, reasons string, expected_tables long"), frame(spark, [("red",), ("green",), ("red",)], "level string")))
    assert got[:12] == ["# PDF Table Quality Audit", "", "This is a risk audit, not a guarantee of cell-level correctness.", "", "## Summary", "", "- Files green: 100", "- Files yellow: 100", "- Files red: 100", "- Tables green: 1", "- Tables yellow: 0", "- Tables red: 2"]
    assert got[15 : 15 + 80] == [f"- `s{k}`: {'r' * 300}" for k in range(2, 242, 3)]
    assert got[95:98] == ["", "## Yellow Files With Most Tables", ""] and got[98:] == [f"- `s{k}`: tables={k}; {'r' * 240}" for k in range(298, 148, -3)]


def test_source_content(spark):
    rows = [(1, "a.md", "3", "1", "checked", 0.8512), (2, "b.md", "", "all", "checked", 0.95), (3, "c.md", "2", "", "source_missing", 0.0), (4, "d.md", "1", "1", "attested:ok", 0.0)]
    schema = "nth long, document string, page string, `table` string, status string, char_recall double"
    got = text(reports.source_content(frame(spark, rows, schema)))
    assert got[4:9] == ["- Checked rows: 2", "- Below 90% character recall: 1", "- Attested manual reviews: 1", "- Manual review queue: 1", "- Minimum checked character recall: 85.12%"]
    assert got[9:] == ["", "## Below Threshold", "", "- `a.md` page 3 table 1: 85.12%", "", "## Manual Review Queue", "", "- `c.md` page 2: `source_missing`"]
    empty = text(reports.source_content(spark.createDataFrame([], schema)))
    assert empty[8] == "- Minimum checked character recall: 100.00%" and empty.count("- none") == 2


def test_final(spark):
    result = spark.createDataFrame([(3, 1, 3, 2, 5, 3, 2, False)], "documents long, failed_documents long, unique_doc_ids long, unique_source_paths long, chunks long, unique_chunk_doc_ids long, global_issues long, clean boolean")
    named = frame(spark, [(7, "a"), (2, "b:1")], "nth long, issue string")
    issues = frame(spark, [("z.md", ["x", "y"]), ("a.md", []), ("b.md", ["q"])], "path string, issues array<string>")
    got = text(reports.final(result, named, issues))
    assert got == ["# Final Corpus Audit", "", "- Documents: 3", "- Failed documents: 1", "- Unique doc IDs: 3", "- Unique source paths: 2", "- Chunks: 5", "- Chunk document coverage: 3", "- Global issues: 2", "- Clean: `false`", "", "## Global Issues", "", "- b:1", "- a", "", "## Failed Documents", "", "- `b.md`: q", "- `z.md`: x, y"]


def test_ready(spark):
    docs = frame(spark, [("1", "A", "p/a", "needs_ocr", "ok", 10, []), ("2", "B", "p/b", "text_ok", "needs_human_spotcheck", 99, ["x", "y"])], "doc_id string, title string, path string, ocr_status string, quality_status string, body_chars long, issues array<string>")
    taken = frame(spark, [("page_aware",), ("ocr_backfill",), ("original_pdf_fallback",), ("page_aware_extra",), ("original_non_pdf",)], "status string")
    got = text(reports.ready(docs, taken, "out", 8))
    assert got[2:13] == ["- Output documents: `out`", "- Markdown files copied: 5", "- PDFs replaced with page-aware version: 2", "- PDFs using OCR backfill: 1", "- PDF fallbacks to original conversion: 1", "- Chunks: 8", "- Unresolved OCR documents: 1", "- Near-empty Markdown documents: 1", "- Documents with suspicious content: 1", "- Documents needing human spot-check: 1", "- Ready for import: `false`"]
    assert text(reports.ready_unresolved(docs))[6:] == ["## Unresolved OCR", "", "- `1` A - `needs_ocr` - `p/a`", "", "## Near-Empty Markdown", "", "- `1` A - 10 chars - `p/a`", "", "## Suspicious Content", "", "- `2` B - `x,y` - `p/b`"]


def test_prefilter_and_repair(spark):
    rows = [("f2", "T2", 4, "conflict", "b"), ("f2", "T2", 2, "conflict", "a"), ("f1", None, 1, "conflict", "c"), ("f3", "T3", 1, "high", "d")]
    got = text(reports.prefilter(frame(spark, rows, "file_id string, title string, page int, confidence string, reason string"), 3, 9, "ok", "c.csv", "s.json", "Vision", "Second"))
    assert got[6:14] == ["- Documents scanned: 3", "- Pages scanned: 9", "- Tables compared: 4", "- Low-risk local agreements: 1", "- Conflicts queued for Vision/manual review: 3", "- Second status: ok", "- Vision candidate CSV: `c.csv`", "- Vision selection JSON: `s.json`"]
    assert got[-2:] == ["- `f1` f1: pages=1; c", "- `f2` T2: pages=2,4; a; b"]
    records = frame(spark, [(2, "d", 1, 2, "replaced", 5, 6), (1, "c", 3, 1, "kept", 4, 0)], "nth long, doc_id string, page int, `table` int, status string, original_rows int, enhanced_rows int")
    assert text(reports.repair_apply(records, "Vision"))[5:] == ["- kept: 1", "- replaced: 1", "", "## Records", "", "- `c` p3 t1: kept (4 -> 0)", "- `d` p1 t2: replaced (5 -> 6)"]


def test_written_in_order_as_one_file(spark, tmp_path):
    rows = [(k, "failed", "q", "o", f"in/{k}", "", "line\nbreak", "") for k in range(5000)]
    items = frame(spark, rows, "nth long, conversion_status string, quality_status string, ocr_status string, source_path string, archive_member_path string, error string, probe_note string")
    for _ in range(2):  # a second report replaces the first
        reports.write_report(reports.unresolved(items), f"file://{tmp_path}/qa/report.md")
    lines = (tmp_path / "qa/report.md").read_text().split("\n")
    assert [x for x in lines if "Source" in x] == [f"  - Source: in/{k}" for k in range(5000)] and lines[4] == "  - Error: line break" and lines[-1] == ""
    assert {p.name for p in (tmp_path / "qa").iterdir()} <= {"report.md", ".report.md.crc"}
    bad = items.withColumn("error", F.when(F.col("nth") == 4000, F.raise_error(F.lit("on purpose"))).otherwise(F.col("error")))
    with pytest.raises(Exception, match="on purpose"):
        reports.write_report(reports.unresolved(bad), f"file://{tmp_path}/qa/report.md")
    assert (tmp_path / "qa/report.md").read_text().split("\n") == lines
