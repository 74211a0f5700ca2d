"""Inputs that the queries derive from the test tables. The expressions are SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import batches

#: documents as Markdown: headings, chapter lines, page noise, rules, tables and blank runs by doc_id.
MD = """CASE doc_id % 6
 WHEN 0 THEN '# Title ' || doc_id || chr(10) || text || chr(10) || '---' || chr(10) || '## Part two' || chr(10) || text
 WHEN 1 THEN 'Chapter 1 Introduction' || chr(10) || text || chr(10) || 'Page 3 of 9' || chr(10) || '3 / 9' || chr(10) || 'Section 2.1 Results'
 WHEN 2 THEN text || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || '| A | B |' || chr(10) || '| x |' || chr(10) || '| y | z | w |' || chr(10) || 'end'
 WHEN 3 THEN 'Running head' || chr(10) || text || chr(10) || 'Running head' || chr(10) || 'tail' || chr(10) || 'Running head' || chr(10) || '___' || chr(10) || ' Running head '
 WHEN 4 THEN text || chr(10) || '| H1 | H2 |' || chr(10) || '| --- | :---: |' || chr(10) || '| a | b |' || chr(10) || chr(10) || chr(10) || 'after'
 ELSE text END"""
PATHS = """CASE p_partkey % 9 WHEN 0 THEN 'in/.cache/' WHEN 1 THEN 'in/a/~$' ELSE 'in/b/' END || p_partkey || CASE p_partkey % 11 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX' WHEN 2 THEN '.doc' WHEN 3 THEN '.html'
 WHEN 4 THEN '.csv' WHEN 5 THEN '.png' WHEN 6 THEN '.zip' WHEN 7 THEN '.rar' WHEN 8 THEN '.xyz' WHEN 9 THEN CASE p_partkey % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.TIFF' WHEN 2 THEN '.webp' WHEN 3 THEN '.pptx' ELSE '.gif' END ELSE '' END"""
PDF_PAGES = """SELECT 'c' || conv_id AS path, turn + 1 AS page, CASE WHEN conv_id % 4 = 1 THEN length(text) % 30 ELSE length(text) END AS n_text_chars, CASE WHEN conv_id % 4 = 1 THEN 1 ELSE turn % 2 END AS n_images,
 CASE WHEN conv_id % 5 = 2 AND turn = 1 THEN 1 ELSE 0 END AS n_tables, conv_id % 7 <> 3 AS ok FROM conversations"""
#: A table for each order: a header, then a row for each line item, with blanks and long cells by key.
LINES = "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS row_no FROM lineitem) AS numbered"
CELLS = f"""SELECT l_orderkey AS doc_id, CAST(row_no AS INT) AS row_no, CASE WHEN row_no = 1 THEN CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE 'part' END ELSE CAST(l_partkey AS VARCHAR(20)) END AS c1,
 CASE WHEN l_orderkey % 5 = 0 AND row_no > 1 THEN '' ELSE l_returnflag || '|' || l_linestatus END AS c2, CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE repeat('z', CAST(l_partkey % 140 AS INT)) END AS c3 FROM {LINES}"""


#: Tasks for each core where a table is dealt.
SHARES = 4


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return batches.small(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table dealt to all cores by its key, for files that are made of its rows: a table of short rows is a small file, which
    Spark reads in one task or a few, however long the work on each row. Tasks aren't merged again, as their sizes say nothing."""
    return load(spark, sf_dir, name).repartition(SHARES * spark.sparkContext.defaultParallelism, key)


def md_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").selectExpr("doc_id", f"{MD} AS body")


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CELLS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=load(spark, sf_dir, "lineitem")).selectExpr("doc_id", "row_no", "array(c1, c2, c3) AS cells")
