"""The pipe-table engine: rendering, parsing, profiling, levels, syntax issues, comparison of two engines, repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Thresholds of the table levels.
EMPTY_RED, EMPTY_YELLOW, WIDE, LONG, LONG_CELL = 0.65, 0.42, 8, 20, 120
OVERLAP = 0.18


def cell_text(c: Column) -> Column:
    """A cell within a pipe row: newlines become <br>, pipes are escaped."""
    return F.replace(F.regexp_replace(T.strip(F.coalesce(c, F.lit(""))), r"\r\n?|\n", "<br>"), F.lit("|"), F.lit("\\|"))


def flat_cell(c: Column) -> Column:
    """A cell for comparison of engines: newlines and runs of blanks become one space."""
    spaced = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"\r\n?", "\n"), r"[ \t\u3000]+", " "), r"\n+", " ")
    uneven = lambda x: x.contains("  ") | x.contains("\n") | x.contains("\t") | x.contains("\r") | x.contains("\u3000")
    return T.once(F.coalesce(c, F.lit("")), lambda x: T.strip(F.when(uneven(x), spaced(x)).otherwise(x)))


def rendered(rows: DataFrame, keys: list[str], order: str, cells: str = "cells") -> DataFrame:
    """keys, order, cells: array -> keys, markdown: a pipe table whose first row is the header; short rows are padded."""
    each = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, cells))).alias("rs"), F.max(F.size(cells)).alias("width"))
    one = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r[cells], cell_text), F.array_repeat(F.lit(""), F.col("width") - F.size(r[cells]))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("width")), " | "), F.lit(" |"))
    body = F.transform("rs", one)
    return each.select(*keys, F.array_join(F.concat(F.slice(body, 1, 1), F.array(rule), F.slice(body, F.lit(2), F.size(body))), "\n").alias("markdown"))


def row_cells(line: Column) -> Column:
    """Cells of a pipe row as the syntax check reads them: one outer delimiter goes, escaped pipes don't split."""
    s = T.strip(line)
    return F.split(s.substr(F.lit(2), F.length(s) - 2), r"(?<!\\)\|", -1)


def profile(rows: DataFrame, keys: list[str], order: str, cells: str = "cells") -> DataFrame:
    """keys -> rows, cols, empty_ratio, blank_header_cells, header_cells, long_cell_count of each table."""
    filled = F.size(F.filter(cells, lambda x: F.length(T.strip(F.coalesce(x, F.lit("")))) > 0))
    longs = F.size(F.filter(cells, lambda x: F.length(x) > LONG_CELL))
    each = rows.select(*keys, order, F.size(cells).alias("n"), filled.alias("filled"), longs.alias("longs"))
    header = F.min(F.struct(order, "n", "filled"))
    out = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.max("n").cast("long").alias("cols"), F.round(1 - F.sum("filled") / F.greatest(F.sum("n"), F.lit(1)), 4).alias("empty_ratio"), header.alias("h"), F.sum("longs").alias("long_cell_count"))
    return out.select(*keys, "rows", "cols", "empty_ratio", (F.col("h.n") - F.col("h.filled")).cast("long").alias("blank_header_cells"), F.col("h.n").cast("long").alias("header_cells"), "long_cell_count")


def leveled(profiles: DataFrame) -> DataFrame:
    """profiles with level (green, yellow, red) and reasons, in their order, joined by commas."""
    small = (F.col("rows") < 2) | (F.col("cols") < 2)
    blank = (F.col("header_cells") > 0) & (F.col("blank_header_cells") / F.greatest("header_cells", F.lit(1)) >= 0.5)
    empty, some = F.col("empty_ratio") >= EMPTY_RED, (F.col("empty_ratio") >= EMPTY_YELLOW) & (F.col("empty_ratio") < EMPTY_RED)
    wide, long, wrapped = F.col("cols") >= WIDE, F.col("rows") >= LONG, F.col("long_cell_count") > 0
    why = [(small, "table_too_small_or_parse_failed"), (blank, "mostly_blank_header"), (empty, "too_many_empty_cells"), (some, "many_empty_cells"), (wide, "wide_table"), (long, "long_table"), (wrapped, "long_wrapped_cells")]
    level = F.when(small | blank | empty, "red").when(some | wide | long | wrapped, "yellow").otherwise("green")
    return profiles.withColumn("level", level).withColumn("reasons", F.concat_ws(",", *(F.when(c, n) for c, n in why)))


def syntax_issues(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """key, column_mismatch, missing_separator: counts over the pipe blocks of each document that has any."""
    rows = docs.where(F.col(body).contains("|")).select(key, F.posexplode(T.lines(F.col(body))).alias("n", "line"))
    s = T.strip(F.col("line"))
    rows = rows.where(s.startswith("|") & s.endswith("|")).withColumn("cells", row_cells(F.col("line")))
    by_doc = Window.partitionBy(key).orderBy("n")
    rows = rows.withColumn("block", F.col("n") - F.row_number().over(by_doc)).withColumn("w", F.size("cells"))
    is_rule = F.forall("cells", lambda c: c.rlike(T.SEPARATOR_CELL))
    first = F.first("w").over(Window.partitionBy(key, "block").orderBy("n"))
    rows = rows.select(key, "block", (F.col("w") != first).cast("long").alias("off"), is_rule.cast("int").alias("is_rule"))
    blocks = rows.groupBy(key, "block").agg(F.sum("off").alias("off"), F.max("is_rule").alias("has_rule"))
    return blocks.groupBy(key).agg(F.sum("off").alias("column_mismatch"), F.sum((F.col("has_rule") == 0).cast("long")).alias("missing_separator"))


def normalized(docs: DataFrame, key: str = "doc_id", body: str = "body") -> DataFrame:
    """key, block, line_no, row: rows of each pipe block padded to the block's width, with a rule after the first row if it has none."""
    rows = docs.where(F.col(body).contains("|")).select(key, F.posexplode(T.lines(F.col(body))).alias("n", "line"))
    s = T.strip(F.col("line"))
    rows = rows.where(s.startswith("|") & s.endswith("|")).withColumn("cells", row_cells(F.col("line")))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy("n"))).withColumn("block", F.col("n") - F.col("nth"))
    whole = Window.partitionBy(key, "block")
    rows = rows.withColumn("width", F.max(F.size("cells")).over(whole)).withColumn("cells", F.concat("cells", F.array_repeat(F.lit(""), F.col("width") - F.size("cells"))))
    rows = rows.withColumn("is_rule", F.forall("cells", lambda c: c.rlike(T.SEPARATOR_CELL)))
    rows = rows.withColumn("ruled", F.max("is_rule").over(whole)).withColumn("first", F.col("n") == F.min("n").over(whole))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit(" --- "), F.col("width")), "|"), F.lit("|"))
    row = F.when(F.col("is_rule"), rule).otherwise(F.concat(F.lit("|"), F.array_join("cells", "|"), F.lit("|")))
    parts = F.array(F.struct((F.col("n") * 2).alias("at"), row.alias("row")), F.struct((F.col("n") * 2 + 1).alias("at"), F.when(F.col("first") & ~F.col("ruled"), rule).alias("row")))
    out = rows.select(key, "block", F.explode(parts).alias("p")).where("p.row IS NOT NULL")
    order = F.row_number().over(Window.partitionBy(key, "block").orderBy("p.at"))
    return out.select(key, F.dense_rank().over(Window.partitionBy(key).orderBy("block")).cast("long").alias("block"), order.cast("long").alias("line_no"), F.col("p.row").alias("row"))


#: Audit reasons that make a page a candidate by themselves; those of the document come without a page.
HARD_REASONS = ("mostly_blank_header", "too_many_empty_cells", "table_too_small_or_parse_failed", "table_count_mismatch", "missing_table_pages", "missing_repaired_markdown")
DOCUMENT_REASONS = ("table_count_mismatch", "missing_table_pages", "missing_repaired_markdown")
MISMATCHES = 3


def _gathered(rows: DataFrame, keys: list[str], order: str, cells: str) -> DataFrame:
    """One row per table: its rows in order, cells flattened, once each; rows without content at the end go."""
    flat = rows.select(*keys, F.col(order).alias("o"), F.explode(F.array(F.transform(cells, flat_cell))).alias("c"))
    each = flat.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "c"))), lambda r: r["c"]).alias("t"))
    filled = F.transform("t", lambda r, i: F.when(F.exists(r, lambda c: c != ""), i + 1).otherwise(0))
    return each.select(*keys, F.slice("t", F.lit(1), F.array_max(filled)).alias("t")).where(F.size("t") > 0)


def compared(a: DataFrame, b: DataFrame, keys: list[str], order: str = "row_no", cells: str = "cells") -> DataFrame:
    """Rows of the tables of two engines (keys, order, cells) -> keys, confidence (high, conflict), reason.

    Shapes first, then cells, as numbers or in their relaxed forms; counting ends at MISMATCHES. Values of reason are fixed."""
    side = lambda d, n: _gathered(d, keys, order, cells).withColumnRenamed("t", n)
    both = side(a, "x").join(side(b, "y"), keys, "full_outer")
    width = lambda t: F.array_max(F.transform(t, F.size))
    shape = lambda t: F.concat(F.size(t).cast("string"), F.lit("x"), width(t).cast("string"))
    both = both.withColumn("sx", shape("x")).withColumn("sy", shape("y"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    off = lambda p, q: F.size(F.filter(F.zip_with(p, q, lambda u, v: T.same_cell(blank(u), blank(v))), lambda ok: ~ok))
    count = F.aggregate(F.zip_with("x", "y", off), F.lit(0), lambda n, k: F.least(n + k, F.lit(MISMATCHES)))
    both = both.withColumn("n", F.when(F.col("sx") == F.col("sy"), count))
    reason = (
        F.when(F.col("x").isNull(), "pdfplumber_missing_table").when(F.col("y").isNull(), "camelot_missing_table")
        .when(F.col("sx") != F.col("sy"), F.concat(F.lit("shape_mismatch:"), "sx", F.lit("!="), "sy"))
        .when(F.col("n") >= MISMATCHES, f"cell_mismatch:{MISMATCHES}_or_more").when(F.col("n") > 0, F.concat(F.lit("cell_mismatch:"), F.col("n").cast("string")))
        .otherwise("engines_agree_structure_and_cells")
    )
    return both.select(*keys, F.when(F.col("n") == 0, "high").otherwise("conflict").alias("confidence"), reason.alias("reason"))


def conflicts(found: DataFrame, key: str, page: str, reason: str) -> DataFrame:
    """key, page, page_reason, file_reason: the first five reasons of each page and eight of each file, in order."""
    text = lambda most, over: F.concat(F.lit("dual_engine_conflict:"), F.array_join(F.slice(F.array_sort(over), 1, most), ";"))
    once = found.select(key, page, reason).distinct()
    return once.groupBy(key, page).agg(text(5, F.collect_set(reason)).alias("page_reason")).join(once.groupBy(key).agg(text(8, F.collect_set(reason)).alias("file_reason")), key)


def candidates(rows: DataFrame, levels: tuple[str, ...], priorities: tuple[str, ...]) -> DataFrame:
    """rows(level, priority, pages) of these levels and priorities, in any case, that name a page at least."""
    return rows.where(F.lower("level").isin(*levels) & F.lower("priority").isin(*priorities) & (F.size(T.page_numbers(F.col("pages"))) > 0))


def hard_reasons(reasons: Column, page: Column) -> Column:
    """Of a document's audit reasons, joined by semicolons, those that make this page a candidate."""
    parts = F.split(reasons, ";")

    def found(name: str) -> Column:
        here = F.exists(parts, lambda x: x.rlike(rf"^p\d+t\d+:{name}$") & (F.regexp_extract(x, r"^p(\d+)", 1) == page.cast("string")))
        return reasons.contains(name) if name in DOCUMENT_REASONS else here

    return F.array_compact(F.array(*(F.when(found(n), n) for n in HARD_REASONS)))


def outside_boxes(texts: DataFrame, boxes: DataFrame, page: list[str], most: float = OVERLAP) -> DataFrame:
    """Text blocks that no table box of their page covers by more than most of their own area (1.0 at least)."""
    t, b = texts.alias("t"), boxes.alias("b")
    wide = F.greatest(F.lit(0.0), F.least("t.x1", "b.x1") - F.greatest("t.x0", "b.x0"))
    high = F.greatest(F.lit(0.0), F.least("t.y1", "b.y1") - F.greatest("t.y0", "b.y0"))
    area = F.greatest(F.lit(1.0), (F.col("t.x1") - F.col("t.x0")) * (F.col("t.y1") - F.col("t.y0")))
    on = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in page] + [wide * high / area > most]
    return t.join(b, on, "left_anti")


def file_levels(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """found(key, page, level), expected(key, page, tables) -> key, expected_tables, markdown_tables, missing_pages, level.

    A count that differs or pages without their tables are red; several tables on a page or ten in a document are yellow
    at least; a document that no table is expected of is green."""
    rank = F.when(F.col("level") == "red", 2).when(F.col("level") == "yellow", 1).otherwise(0)
    pages = found.groupBy(key, "page").agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("worst"))
    both = expected.withColumnRenamed("tables", "e").join(pages, [key, "page"], "full_outer")
    each = both.groupBy(key).agg(F.coalesce(F.sum("e"), F.lit(0)).alias("expected_tables"), F.coalesce(F.sum("n"), F.lit(0)).alias("markdown_tables"), F.count_if((F.col("e") > 0) & F.col("n").isNull()).alias("missing_pages"), F.coalesce(F.max("worst"), F.lit(0)).alias("w"), F.coalesce(F.max("n"), F.lit(0)).alias("crowd"))
    red = (F.col("expected_tables") != F.col("markdown_tables")) | (F.col("missing_pages") > 0) | (F.col("w") == 2)
    level = F.when(F.col("expected_tables") == 0, "green").when(red, "red").when((F.col("w") == 1) | (F.col("crowd") > 1) | (F.col("expected_tables") >= 10), "yellow").otherwise("green")
    return each.withColumn("level", level).drop("w", "crowd")


def repaired(original: DataFrame, enhanced: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, table_no, rows) of a document's tables and of the enhanced ones -> keys, table_no, status, original_rows,
    enhanced_rows: the k-th table of a page is replaced by the k-th enhanced one."""
    ranked = lambda d: d.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("table_no")))
    side = ranked(enhanced).select(*keys, "k", F.col("rows").alias("enhanced_rows"))
    both = ranked(original).join(side, [*keys, "k"], "left")
    return both.select(*keys, "table_no", F.when(F.col("enhanced_rows").isNull(), "kept_missing_enhanced_table").otherwise("replaced").alias("status"), F.col("rows").alias("original_rows"), F.coalesce("enhanced_rows", F.lit(0)).alias("enhanced_rows"))


def file_reasons(files: DataFrame, found: DataFrame) -> DataFrame:
    """files(key, expected_tables, expected_pages, has_markdown, markers), found(key, page, table_no, level, reasons array) ->
    key, level, reasons: what is wrong with a file's tables, in the order of the checks. Values of reasons are fixed."""
    rank = F.when(F.col("level") == "red", 2).when(F.col("level") == "yellow", 1).otherwise(0)
    own = F.transform("reasons", lambda r: F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("t"), F.col("table_no").cast("string"), F.lit(":"), r))
    pages = found.groupBy("key", "page").agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("w"), F.collect_list(F.struct("table_no", own.alias("own"))).alias("own"))
    each = pages.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("crowd"), F.max("w").alias("w"), F.collect_set("page").alias("pages"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", F.array_sort("own").alias("own")))), lambda p: F.flatten(F.transform(p["own"], lambda t: t["own"])))).alias("own"))
    d = files.join(each, "key", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("pages", F.coalesce("pages", F.array().cast("array<long>"))).withColumn("own", F.coalesce("own", F.array().cast("array<string>")))
    d = d.withColumn("lost", F.array_sort(F.array_except("expected_pages", "pages")))
    has = F.col("has_markdown")
    gap = (F.size("markers") > 0) & (F.array_sort(F.array_distinct("markers")) != F.sequence(F.lit(1).cast("long"), F.array_max("markers")))
    why = [
        (~has, F.lit("missing_repaired_markdown"), 2), (has & (F.col("expected_tables") != F.col("n")), F.concat(F.lit("table_count_mismatch:"), F.col("expected_tables").cast("string"), F.lit("!="), F.col("n").cast("string")), 2),
        (has & (F.size("lost") > 0), F.concat(F.lit("missing_table_pages:"), F.array_join(F.col("lost").cast("array<string>"), ",")), 2), (has & gap, F.lit("non_contiguous_page_markers"), 1),
    ]
    late = [(has & (F.col("crowd") > 1), F.lit("multiple_tables_on_page"), 1), (has & (F.col("expected_tables") >= 10), F.lit("many_tables_in_document"), 1)]
    text = lambda cs: F.array_compact(F.array(*(F.when(c, t) for c, t, _ in cs)))
    worst = F.greatest(F.coalesce(F.when(has, F.col("w")), F.lit(0)), *(F.when(c, n).otherwise(0) for c, _, n in why + late))
    none = F.col("expected_tables") == 0
    reasons = F.when(none, F.array(F.lit("no_detected_tables"))).otherwise(F.array_distinct(F.concat(text(why), F.when(has, F.col("own")).otherwise(F.array().cast("array<string>")), text(late))))
    return d.select("key", F.when(none, "green").otherwise(F.element_at(F.array(*map(F.lit, ("green", "yellow", "red"))), worst + 1)).alias("level"), F.array_join(reasons, ";").alias("reasons"))
