"""Queries that write files from the tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports
from ..sources import adapter, readers, scratch
from .catalog import query
from .fixtures import load

#: Documents to a file; every seventh line is cut off, every fifth has a blank line before it.
_TO_A_FILE = 50


@query(f"""WITH d AS (SELECT doc_id, text, doc_id // {_TO_A_FILE} AS file, sum(CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END) OVER (PARTITION BY doc_id // {_TO_A_FILE} ORDER BY doc_id) AS line_no FROM documents)
SELECT CAST(file AS VARCHAR) AS file, CAST(line_no AS BIGINT) AS line_no, CASE WHEN doc_id % 7 <> 0 THEN doc_id END AS doc_id, CASE WHEN doc_id % 7 <> 0 THEN sha1(text) END AS text_sha1, CASE WHEN doc_id % 7 = 0 THEN 'invalid_chunk_json_line:' || line_no END AS issue FROM d""")
def json_lines_round_trip(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").withColumn("file", F.expr(f"doc_id DIV {_TO_A_FILE}"))
    whole = F.to_json(F.struct("doc_id", "text"))
    line = F.concat(F.expr("CASE WHEN doc_id % 5 = 0 THEN '\n' ELSE '' END"), F.when(F.expr("doc_id % 7 = 0"), F.expr("'{\"doc_id\": '")).otherwise(whole))
    path = scratch.folder(spark, "lines")
    docs.repartition("file").sortWithinPartitions("file", "doc_id").select("file", line.alias("line")).write.partitionBy("file").text(path)
    found = readers.json_lines(spark, path, "doc_id long, text string")
    return found.select(F.regexp_extract("path", "file=([0-9]+)/", 1).alias("file"), "line_no", F.when(F.col("issue").isNull(), F.col("row.doc_id")).alias("doc_id"), F.when(F.col("issue").isNull(), F.sha1("row.text")).alias("text_sha1"), "issue")


@query("SELECT doc_id, sha1(text) AS text_sha1, '\"q\", ' || source AS note FROM documents")
def csv_round_trip(spark, sf_dir):
    path = scratch.folder(spark, "csv")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", F.concat(F.lit('"q", '), "source").alias("note"))
    readers.write_csv(docs, path)
    return readers.csv_rows(spark, path, "doc_id long, text string, note string").select("doc_id", F.sha1("text").alias("text_sha1"), "note")


def _fake_engine():
    """Fails for some pages once, for some twice, and for some always."""
    tried: dict[tuple, int] = {}

    def call(row: dict) -> dict:
        key = row["conv_id"], row["turn"]
        tried[key] = tried.get(key, 0) + 1
        if tried[key] <= (0, 1, 2, 9)[(key[0] + key[1]) % 4]:
            raise ConnectionError("engine is busy")
        return {"markdown": f"# {row['role']}\n\n{row['text']}", "n": len(row["text"])}

    return call


@query("""WITH c AS (SELECT *, (conv_id + turn) % 4 AS bad FROM conversations)
SELECT conv_id, turn, CASE WHEN bad < 3 THEN sha1('# ' || role || chr(10) || chr(10) || text) END AS markdown_sha1, CASE WHEN bad < 3 THEN length(text) END AS n, CASE WHEN bad < 3 THEN 'ok' ELSE 'failed' END AS status,
 CASE WHEN bad < 3 THEN bad + 1 ELSE 3 END::INTEGER AS tries, CASE WHEN bad = 3 THEN 'ConnectionError: engine is busy' END AS error FROM c""")
def engine_calls(spark, sf_dir):
    todo = load(spark, sf_dir, "conversations")
    policy = adapter.Policy(step=0.0, most=0.0, rows=500)
    found = adapter.worked_off(todo, ["conv_id", "turn"], _fake_engine, "markdown string, n long", scratch.folder(spark, "journal"), policy)
    return found.select("conv_id", "turn", F.sha1("markdown").alias("markdown_sha1"), "n", "status", "tries", "error")


def _written(spark, lines):
    """The lines of a report as its file holds them."""
    path = scratch.folder(spark, "report") + "/report.md"
    reports.write_report(lines, path)
    return readers.numbered_lines(spark, path).select("line_no", "line")


@query("""WITH s AS (SELECT CASE p_partkey % 6 WHEN 0 THEN 'failed' WHEN 1 THEN 'unsupported' ELSE 'converted' END AS status FROM part),
n AS (SELECT 10 + row_number() OVER (ORDER BY status) - 4 AS line_no, '- ' || status || ': ' || count(*) AS line FROM s GROUP BY status),
t AS (SELECT unnest(range(1, 22)) AS line_no, unnest(['# Conversion Report', '', '## Summary', '', '- Manifest records: ' || (SELECT count(*) FROM part), '- Retrieval chunks: ' || (SELECT count(*) FROM documents), NULL, NULL, NULL, '', '## Acceptance Checks', '',
 '- Open several converted Markdown files and compare headings, tables, and visible text against the source.', '- Review `qa/unresolved.md` before using the corpus for search, RAG, or formal answers.',
 '- Treat `needs_ocr`, `needs_review`, and `unresolved` records as not fully reliable until checked.', '- Confirm archive member paths and source paths are preserved in frontmatter and `manifest.jsonl`.', '', '## Notes', '',
 '- Low-text PDFs and image files may require vision OCR credentials.', '- Automated conversion can miss layout semantics, merged cells, handwritten notes, seals, and scanned text.']) AS line)
SELECT CAST(line_no AS BIGINT) AS line_no, line FROM t WHERE line IS NOT NULL UNION ALL SELECT line_no, line FROM n""")
def conversion_report(spark, sf_dir):
    manifest = load(spark, sf_dir, "part").selectExpr("CASE p_partkey % 6 WHEN 0 THEN 'failed' WHEN 1 THEN 'unsupported' ELSE 'converted' END AS conversion_status")
    return _written(spark, reports.conversion(manifest, load(spark, sf_dir, "documents").count()))


@query("""WITH r AS (SELECT p_partkey AS nth, p_name AS title, p_partkey % 13 = 0 AS bad, p_size % 9 AS tables, p_brand FROM part),
h AS (SELECT row_number() OVER (ORDER BY tables DESC, nth) AS i, '- `' || title || '`: tables=' || tables || ', pages=1,' || (tables + 1) AS line FROM r WHERE NOT bad AND tables > 0),
e AS (SELECT row_number() OVER (ORDER BY nth) AS i, '- `' || title || '`: no pages in ' || p_brand AS line FROM r WHERE bad),
c AS (SELECT least(30, count(*)) AS n FROM h)
SELECT CAST(unnest(range(1, 10)) AS BIGINT) AS line_no, unnest(['# PDF Table Preflight Report', '', '- PDFs scanned: ' || (SELECT count(*) FROM r), '- PDFs with detected tables: ' || (SELECT count(*) FROM h), '- Total detected tables: ' || (SELECT sum(tables) FROM r WHERE NOT bad), '- Errors: ' || (SELECT count(*) FROM e), '', '## High Table Count Files', '']) AS line
UNION ALL SELECT 9 + i, line FROM h WHERE i <= 30
UNION ALL SELECT 9 + n + unnest([1, 2, 3]), unnest(['', '## Errors', '']) FROM c
UNION ALL SELECT 12 + n + i, line FROM e, c""")
def preflight_report(spark, sf_dir):
    rows = load(spark, sf_dir, "part").selectExpr("p_partkey AS nth", "p_name AS title", "CASE WHEN p_partkey % 13 = 0 THEN 'error' ELSE 'scanned' END AS status", "CASE WHEN p_partkey % 13 <> 0 THEN p_size % 9 END AS tables", "array(1, p_size % 9 + 1) AS table_pages", "'no pages in ' || p_brand AS error")
    return _written(spark, reports.preflight(rows))
