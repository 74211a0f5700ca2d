"""Documents as pages: written, read back, interleaved with tables; tables of headings and of HTML; what is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

# How pages and tables are marked.
PAGE_MARK = r"<!--\s*source_page:\s*(\d+)\s*-->"
_PAGE = r"(?s)<!--\s*source_page:\s*(\d+)\s*-->\s*(.*?)(?=<!--\s*source_page:\s*\d+\s*-->|\z)"
_OCR_PAGE = r"(?sm)^## Page (\d+)[^\S\n]*\n(.*?)(?=^## Page \d+[^\S\n]*\n|\z)"
_TABLE = r"(?sm)^### Source PDF page (\d+) table (\d+)\s*$(.*?)(?=^### Source PDF page \d+ table \d+\s*$|\z)"
_RUN = r"(?m)((?:^[^\S\n]*\|[^\n]*(?:\n|\z))+)"
_ENHANCED = r"(?sm)^## Source Page (\d+)\s*$(.*?)(?=^## Source Page \d+\s*$|\z)"
LEAST_CELLS = 2


def _sections(body: Column, pattern: str) -> Column:
    """Array of (page, text) by a pattern of two groups."""
    both = F.arrays_zip(F.regexp_extract_all(body, F.lit(pattern), F.lit(1)).alias("p"), F.regexp_extract_all(body, F.lit(pattern), F.lit(2)).alias("t"))
    return F.transform(both, lambda x: F.struct(x["p"].cast("long").alias("page"), T.strip(x["t"]).alias("text")))


def page_sections(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """key, page, text of each section that a page mark opens."""
    return docs.select(key, F.explode(_sections(F.col(body), _PAGE)).alias("x")).select(key, "x.page", "x.text")


def marked_pages(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, page, text) -> key, body: pages under their marks, in order."""
    part = lambda x: F.concat(F.lit("<!-- source_page: "), x["page"].cast("string"), F.lit(" -->\n\n"), x["text"])
    return _joined(pages, key, part)


def ocr_body(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, page, text) -> key, body: pages under their headings, in order, closed by a newline."""
    out = _joined(pages, key, lambda x: T.strip(F.concat(F.lit("## Page "), x["page"].cast("string"), F.lit("\n\n"), x["text"])))
    return out.withColumn("body", F.concat("body", F.lit("\n")))


def _joined(pages: DataFrame, key: str, part) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy(key).agg(ordered.alias("ps")).select(key, F.array_join(F.transform("ps", part), "\n\n").alias("body"))


def ocr_pages(docs: DataFrame, key: str = "doc_id", body: str = "body", method: str = "extraction_method") -> DataFrame:
    """key, page, text: pages that OCR has finished, so that a further run can leave them out; empty ones are to do again."""
    done = docs.where(F.startswith(method, F.lit("vision_ocr:")))
    return done.select(key, F.explode(_sections(F.col(body), _OCR_PAGE)).alias("x")).where("x.text <> ''").groupBy(key, "x.page").agg(F.max("x.text").alias("text"))


def interleaved(items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page, kind, x, y, text) -> keys, page, markdown: what stands higher comes first, then what stands further
    left, then text before tables; places are rounded to a tenth."""
    at = F.struct(F.round("y", 1).alias("y"), F.round("x", 1).alias("x"), (F.col("kind") != "text").cast("int").alias("k"), "text")
    each = items.groupBy(*keys, "page").agg(F.array_sort(F.collect_list(at)).alias("items"))
    body = F.array_join(F.transform("items", lambda i: i["text"]), "\n\n")
    return each.select(*keys, "page", F.concat(F.lit("<!-- source_page: "), F.col("page").cast("string"), F.lit(" -->\n\n"), body).alias("markdown"))


def table_scan(rows: DataFrame, path: str = "path") -> DataFrame:
    """(path, page, table_no, cells) of each table's rows -> path, tables, max_rows, max_cols, table_pages, needs_repair.
    Tables with fewer than LEAST_CELLS cells that hold something don't count."""
    filled = F.size(F.filter("cells", lambda c: F.length(T.strip(F.coalesce(c, F.lit("")))) > 0))
    each = rows.groupBy(path, "page", "table_no").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("cells")).alias("w"), F.sum(filled).alias("f"))
    dense = F.col("f") >= LEAST_CELLS
    out = each.groupBy(path).agg(F.count_if(dense).alias("tables"), F.coalesce(F.max(F.when(dense, F.col("n"))), F.lit(0)).alias("max_rows"), F.coalesce(F.max(F.when(dense, F.col("w"))), F.lit(0)).cast("long").alias("max_cols"), F.array_sort(F.collect_set(F.when(dense, F.col("page")))).alias("table_pages"))
    return out.withColumn("needs_repair", F.size("table_pages") > 0)


def missing_pages(expected: Column, found: Column) -> Column:
    """Pages of one set that the other lacks, in order."""
    return F.array_sort(F.array_except(expected, found))


def headed_tables(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """key, page, table_no, row_no, cells: the first run of pipe rows after each table's heading; rules are no rows."""
    whole = F.regexp_extract_all(F.col(body), F.lit(_TABLE), F.lit(0))
    found = docs.select(key, F.explode(whole).alias("t")).select(key, *(F.regexp_extract("t", _TABLE, n).cast("long").alias(c) for n, c in ((1, "page"), (2, "table_no"))), F.regexp_extract(F.regexp_extract("t", _TABLE, 3), _RUN, 1).alias("run"))
    cells = lambda line: F.transform(F.split(F.btrim(T.strip(line), F.lit("|")), r"\|"), T.strip)
    rows = F.transform(F.filter(F.split("run", "\n"), lambda x: T.strip(x) != ""), cells)
    rows = F.filter(rows, lambda r: ~F.forall(r, lambda c: c.rlike("^:?-{3,}:?$")))
    return found.select(key, "page", "table_no", F.posexplode_outer(rows).alias("row_no", "cells")).withColumn("row_no", F.col("row_no").cast("long") + 1)


#: Two pipe rows or more, one below the other.
_TABLE_RUN = r"(?m)((?:^[^\S\n]*\|[^\n]*(?:\n|\z)){2,})"


def section_tables(sections: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, page, text) of page sections -> key, page, table_no (from 1), markdown: each run of two pipe rows or more; in a section
    without one, its HTML tables instead."""
    runs = F.transform(F.regexp_extract_all(F.col(text), F.lit(_TABLE_RUN), F.lit(1)), lambda r: F.array_join(F.transform(F.split(F.rtrim(r, F.lit("\n")), "\n"), T.rstrip), "\n"))
    each = sections.select(key, "page", F.col(text).alias("_text"), F.explode(F.array(runs)).alias("_runs"))
    piped = each.select(key, "page", F.posexplode("_runs").alias("_n", "markdown")).select(key, "page", (F.col("_n") + 1).cast("long").alias("table_no"), "markdown")
    bare = each.where((F.size("_runs") == 0) & F.lower("_text").contains("<table")).select(F.struct(key, "page").alias("_at"), "_text")
    return piped.unionByName(html_tables(bare, "_at", "_text").select("_at.*", "table_no", "markdown"))


def enhanced_tables(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """(key, body) -> key, page, table_no, markdown: the tables of the sections that page headings open; of two sections of a page
    the last that has tables counts."""
    each = docs.select(key, F.posexplode(_sections(F.col(body), _ENHANCED)).alias("_nth", "_x"))
    found = section_tables(each.select(F.struct(key, "_nth").alias("_at"), "_x.page", "_x.text"), "_at")
    last = F.max("_at._nth").over(Window.partitionBy(f"_at.{key}", "page"))
    return found.withColumn("_last", last).where("_at._nth = _last").select(f"_at.{key}", "page", "table_no", "markdown")


def html_tables(docs: DataFrame, key: str = "doc_id", html: str = "html") -> DataFrame:
    """key, table_no (from 1), markdown of each table element: the first row is the header, short rows are padded, rows
    without text are left out, as are tables without rows."""
    inner = lambda c, tag: F.regexp_extract_all(c, F.lit(rf"(?is)<(?:{tag})\b[^>]*>(.*?)(?=</(?:{tag})\s*>|<(?:{tag})\b|\z)"), F.lit(1))
    cell = lambda c: F.replace(T.strip(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", ""), rf"{T.WS}+", " ")), F.lit("|"), F.lit("\\|"))
    rows = F.filter(F.transform(inner(F.col("t"), "tr"), lambda r: F.transform(inner(r, "td|th"), cell)), lambda r: F.exists(r, lambda c: c != ""))
    each = docs.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<table\b[^>]*>(.*?)</table\s*>"), F.lit(1))).alias("n", "t"))
    each = each.select(key, "n", rows.alias("rows")).where(F.size("rows") > 0).withColumn("w", F.array_max(F.transform("rows", F.size)))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), F.col("w") - F.size(r))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("w")), " | "), F.lit(" |"))
    lines = F.transform("rows", line)
    markdown = F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.size(lines))), "\n")
    return each.select(key, (F.col("n") + 1).cast("long").alias("table_no"), T.decoded(markdown).alias("markdown"))


def ocr_targets(rows: DataFrame, statuses: list[str], title: str = "", include: tuple = (), exclude: tuple = (), most_pages: int = 0, limit: int = 0) -> DataFrame:
    """rows(ocr_status, doc_title, document_kind, pages, nth) that OCR should work on, and those over most_pages with an
    error; the limit, by nth, is the feature."""
    some = rows.where(F.col("ocr_status").isin(statuses))
    if title:
        some = some.where(F.contains("doc_title", F.lit(title)))
    if include:
        some = some.where(F.col("document_kind").isin(*include))
    if exclude:
        some = some.where(~F.coalesce(F.col("document_kind").isin(*exclude), F.lit(False)))
    if most_pages:
        over = F.coalesce(F.col("pages") > most_pages, F.lit(False))
        some = some.withColumn("ocr_error", F.when(over, F.concat(F.lit(f"skipped by --skip-over-pages={most_pages}; source pages="), F.col("pages").cast("string"))))
    else:
        some = some.withColumn("ocr_error", F.lit(None).cast("string"))
    if limit:
        todo = some.where("ocr_error IS NULL").orderBy("nth").limit(limit)
        some = todo.unionByName(some.where("ocr_error IS NOT NULL"))
    return some
