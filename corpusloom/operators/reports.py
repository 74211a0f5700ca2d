"""Markdown reports: declared layouts, filled from frames, each committed as one file.

A layout is a list of lines. A line may name columns of the report's one row of counts in braces; an Each stands for a line, or
several, for each row of a frame, in an order, or for a line that says that there is none. The lines of a report are a frame with
keys that sort them; nothing is gathered to render it. Writing sorts them by ranges and lets one task write the ranges one after
the other, so that a long report needs no more memory than a short one; the file gets its name when it is complete."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels

LINES = "part int, key string, line string"
_HALF = 1 << 62


@dataclass(frozen=True)
class Each:
    """frame: its name. lines: what stands for a row; a pair of a column and a line leaves the line out where the column is blank.
    by: columns in order, with a - before those that fall. none: the line without rows. most: so many rows are the report."""

    frame: str
    lines: tuple[str | tuple[str, str], ...]
    by: tuple[str, ...]
    none: str | None = None
    most: int | None = None


# The reports' lines.
LAYOUTS: dict[str, list[str | Each]] = {
    "conversion": [
        "# Conversion Report",
        "",
        "## Summary",
        "",
        "- Manifest records: {records}",
        "- Retrieval chunks: {chunks}",
        Each("statuses", ("- {conversion_status}: {n}",), ("conversion_status",)),
        "",
        "## Acceptance Checks",
        "",
        "- Open several converted Markdown files and compare headings, tables, and visible text against the source.",
        "- Review `qa/unresolved.md` before using the corpus for search, RAG, or formal answers.",
        "- Treat `needs_ocr`, `needs_review`, and `unresolved` records as not fully reliable until checked.",
        "- Confirm archive member paths and source paths are preserved in frontmatter and `manifest.jsonl`.",
        "",
        "## Notes",
        "",
        "- Low-text PDFs and image files may require vision OCR credentials.",
        "- Automated conversion can miss layout semantics, merged cells, handwritten notes, seals, and scanned text.",
    ],
    "unresolved": [
        "# Unresolved and Review Items",
        "",
        Each(
            "unresolved",
            (
                "- `{conversion_status}` `{quality_status}` `{ocr_status}`",
                "  - Source: {source_path}",
                ("archive_member_path", "  - Archive member: {archive_member_path}"),
                ("error", "  - Error: {error}"),
                ("probe_note", "  - Probe: {probe_note}"),
            ),
            ("nth",),
            none="No unresolved items found by automated checks.",
        ),
    ],
    "preflight": [
        "# PDF Table Preflight Report",
        "",
        "- PDFs scanned: {files}",
        "- PDFs with detected tables: {with_tables}",
        "- Total detected tables: {tables}",
        "- Errors: {errors}",
        "",
        "## High Table Count Files",
        "",
        Each("with_tables", ("- `{title}`: tables={tables}, pages={table_pages}",), ("-tables", "nth"), most=30),
        "",
        "## Errors",
        "",
        Each("errors", ("- `{title}`: {error}",), ("nth",), none="- none"),
    ],
    "page_repair": [
        "# PDF Page Table Repair Report",
        "",
        "- Output root: `{out_root}`",
        "- Converted PDFs: {converted}",
        "- PDFs with detected tables: {with_tables}",
        "- Errors: {errors}",
        "- Repaired chunks: {chunks}",
        "",
        "## Notes",
        "",
        "- This output is page-aware: each page has a `source_page` marker.",
        "- Text blocks overlapping detected table bounding boxes are skipped, then Markdown tables are inserted at their page positions.",
        "- Files with tables remain `needs_human_spotcheck` until source-page QA is complete.",
        "",
        "## Errors",
        "",
        Each("errors", ("- `{file_id}` {title}: {note}",), ("nth",), none="- none"),
    ],
    "quality": [
        "# PDF Table Quality Audit",
        "",
        "This is a risk audit, not a guarantee of cell-level correctness.",
        "",
        "## Summary",
        "",
        "- Files green: {files_green}",
        "- Files yellow: {files_yellow}",
        "- Files red: {files_red}",
        "- Tables green: {tables_green}",
        "- Tables yellow: {tables_yellow}",
        "- Tables red: {tables_red}",
        "",
        "## Red Files",
        "",
        Each("red", ("- `{source_name}`: {reasons}",), ("nth",), none="- none", most=80),
        "",
        "## Yellow Files With Most Tables",
        "",
        Each("yellow", ("- `{source_name}`: tables={expected_tables}; {short_reasons}",), ("-expected_tables", "nth"), most=50),
    ],
    "source_content": [
        "# Source Table Content Audit",
        "",
        "This compares source table cell text with the Markdown on the same source page. It is a coverage gate, not proof of merged-cell geometry.",
        "",
        "- Checked rows: {checked}",
        "- Below {threshold} character recall: {below}",
        "- Attested manual reviews: {attested}",
        "- Manual review queue: {review}",
        "- Minimum checked character recall: {minimum}",
        "",
        "## Below Threshold",
        "",
        Each("below", ("- `{document}` page {page} table {table}: {recall}",), ("nth",), none="- none"),
        "",
        "## Manual Review Queue",
        "",
        Each("review", ("- `{document}` page {page}: `{status}`",), ("nth",), none="- none"),
    ],
    "final": [
        "# Final Corpus Audit",
        "",
        "- Documents: {documents}",
        "- Failed documents: {failed_documents}",
        "- Unique doc IDs: {unique_doc_ids}",
        "- Unique source paths: {unique_source_paths}",
        "- Chunks: {chunks}",
        "- Chunk document coverage: {unique_chunk_doc_ids}",
        "- Global issues: {global_issues}",
        "- Clean: `{clean}`",
        "",
        "## Global Issues",
        "",
        Each("global_issues", ("- {issue}",), ("nth",), none="- none"),
        "",
        "## Failed Documents",
        "",
        Each("failed", ("- `{path}`: {issues}",), ("path",), none="- none"),
    ],
    "ready": [
        "# LLM Ready Corpus Report",
        "",
        "- Output documents: `{out_docs}`",
        "- Markdown files copied: {copied}",
        "- PDFs replaced with page-aware version: {replaced_pdf}",
        "- PDFs using OCR backfill: {ocr_pdf}",
        "- PDF fallbacks to original conversion: {fallbacks}",
        "- Chunks: {chunks}",
        "- Unresolved OCR documents: {unresolved_ocr}",
        "- Near-empty Markdown documents: {near_empty}",
        "- Documents with suspicious content: {suspicious}",
        "- Documents needing human spot-check: {spotcheck}",
        "- Ready for import: `{ready}`",
        "",
        "## Rule",
        "",
        "- OCR-backfilled PDF files use the OCR Markdown from `documents/`.",
        "- Other PDF files use `documents_page_aware/` when available.",
        "- Non-PDF files use the original `documents/` conversion.",
        "- This directory is the preferred import target after table repair QA.",
    ],
    "ready_unresolved": [
        "# LLM Ready Unresolved Items",
        "",
        "- Unresolved OCR documents: {unresolved_ocr}",
        "- Near-empty Markdown documents: {near_empty}",
        "- Documents with suspicious content: {suspicious}",
        "",
        "## Unresolved OCR",
        "",
        Each("unresolved_ocr", ("- `{doc_id}` {title} - `{ocr_status}` - `{path}`",), ("path",)),
        "",
        "## Near-Empty Markdown",
        "",
        Each("near_empty", ("- `{doc_id}` {title} - {body_chars} chars - `{path}`",), ("path",)),
        "",
        "## Suspicious Content",
        "",
        Each("suspicious", ("- `{doc_id}` {title} - `{issues}` - `{path}`",), ("path",)),
    ],
    "prefilter": [
        "# Dual Engine Table Prefilter",
        "",
        "This is a local risk prefilter. `high` means the two local engines agree on shape and cell text for the selected table, not full source verification.",
        "",
        "## Summary",
        "",
        "- Documents scanned: {documents}",
        "- Pages scanned: {pages}",
        "- Tables compared: {tables}",
        "- Low-risk local agreements: {high}",
        "- Conflicts queued for {enhancer}/manual review: {conflict}",
        "- {second_engine} status: {note}",
        "- {enhancer} candidate CSV: `{candidate_csv}`",
        "- {enhancer} selection JSON: `{selection_json}`",
        "",
        "## Conflict Documents",
        "",
        Each("conflicts", ("- `{file_id}` {title}: pages={pages}; {short_reasons}",), ("file_id",), none="- none", most=80),
    ],
    "repair_apply": [
        "# {enhancer} Table Repair Apply Report",
        "",
        "Visual table rebuilds were inserted only at existing page-aware table headings.",
        "Generated Markdown still requires human spot-check before formal citation.",
        "",
        Each("statuses", ("- {status}: {n}",), ("status",)),
        "",
        "## Records",
        "",
        Each("records", ("- `{doc_id}` p{page} t{table}: {status} ({original_rows} -> {enhanced_rows})",), ("nth",)),
    ],
}


def _filled(line: str) -> Column:
    """A line with the columns that it names; nulls are blank."""
    parts = re.split(r"\{(\w+)\}", line)
    return F.concat(*(F.lit(p) if k % 2 == 0 else F.coalesce(F.col(f"`{p}`").cast("string"), F.lit("")) for k, p in enumerate(parts)))


def _key(frame: DataFrame, by: tuple[str, ...]) -> Column:
    """Columns as one string that sorts as they do: numbers in equal width, texts ended by the least character."""
    out = []
    for name in by:
        falls, name = name.startswith("-"), name.removeprefix("-")
        c = F.coalesce(F.col(f"`{name}`"), F.lit(0) if frame.schema[name].dataType.typeName() != "string" else F.lit(""))
        if frame.schema[name].dataType.typeName() == "string":
            if falls:
                raise ValueError("texts only rise")
            out += [c, F.lit("\x01")]
        else:
            c = c.cast("long")
            out.append(F.lpad(((F.lit(_HALF) - c) if falls else (c + F.lit(_HALF))).cast("string"), 20, "0"))
    return F.concat(*out)


def _rows(part: int, each: Each, frame: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) == ""
    lines = [_filled(x) if isinstance(x, str) else F.when(~blank(x[0]), _filled(x[1])) for x in each.lines]
    keyed = frame.select(_key(frame, each.by).alias("key"), F.array(*lines).alias("lines"))
    if each.most is not None:
        keyed = keyed.orderBy("key").limit(each.most)
    found = keyed.select("key", F.posexplode("lines").alias("n", "line")).where("line IS NOT NULL")
    found = found.select(F.lit(part).alias("part"), F.concat("key", F.lpad(F.col("n").cast("string"), 3, "0")).alias("key"), "line")
    if each.none is None:
        return found
    none = keyed.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(part).alias("part"), F.lit("").alias("key"), F.lit(each.none).alias("line"))
    return found.unionByName(none)


def report_lines(name: str, counts: DataFrame, frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """part, key, line of a report, in the order of part and key; counts is one row, frames are named as in the layout."""
    layout = LAYOUTS[name]
    plain = [F.struct(F.lit(k).alias("part"), F.lit("").alias("key"), _filled(x).alias("line")) for k, x in enumerate(layout) if isinstance(x, str)]
    found = [counts.select(F.explode(F.array(*plain)).alias("x")).select("x.*")]
    found += [_rows(k, x, (frames or {})[x.frame]) for k, x in enumerate(layout) if isinstance(x, Each)]
    return reduce(DataFrame.unionByName, found)


def write_report(lines: DataFrame, path: str) -> None:
    """report_lines() as one file at path, which replaces another there when it is complete."""
    spark = lines.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    staging = at(at(path).getParent(), f"_{uuid.uuid4().hex}")
    ordered = lines.orderBy("part", "key").select(F.regexp_replace("line", r"[\r\n]+", " ").alias("line"))
    ordered.coalesce(1).write.text(staging.toString())  # ranges, each sorted by itself, one after the other
    try:
        made = [x.getPath() for x in files.listStatus(staging) if x.getPath().getName().startswith("part-")]
        files.delete(at(path), False)
        if not files.rename(made[0], at(path)):
            raise OSError(f"can't move the report to {path}")
    finally:
        files.delete(staging, True)


# ---- what the reports are filled with


def _one(df: DataFrame, **columns: Column) -> DataFrame:
    return df.agg(*(c.alias(n) for n, c in columns.items()))


def _given(counts: DataFrame, **values: object) -> DataFrame:
    return counts.withColumns({k: F.lit(v) for k, v in values.items()}) if values else counts


def conversion(manifest: DataFrame, chunks: int) -> DataFrame:
    """manifest(conversion_status)"""
    status = F.coalesce("conversion_status", F.lit("unknown")).alias("conversion_status")
    return report_lines("conversion", _given(_one(manifest, records=F.count(F.lit(1))), chunks=chunks), {"statuses": manifest.groupBy(status).agg(F.count(F.lit(1)).alias("n"))})


def unresolved(items: DataFrame) -> DataFrame:
    """The unresolved rows of a manifest, with nth, their place in it."""
    return report_lines("unresolved", _one(items.limit(0), n=F.count(F.lit(1))), {"unresolved": items})


def preflight(rows: DataFrame) -> DataFrame:
    """rows(nth, title, status, tables, table_pages array, error)"""
    scanned, failed = F.col("status") == "scanned", F.col("status") == "error"
    some = scanned & (F.coalesce("tables", F.lit(0)) > 0)
    counts = _one(rows, files=F.count(F.lit(1)), with_tables=F.count_if(some), tables=F.coalesce(F.sum(F.when(scanned, F.col("tables"))), F.lit(0)), errors=F.count_if(failed))
    flat = rows.withColumn("table_pages", F.array_join(F.col("table_pages").cast("array<string>"), ","))
    return report_lines("preflight", counts, {"with_tables": flat.where(some), "errors": flat.where(failed)})


def page_repair(rows: DataFrame, out_root: str, chunks: int) -> DataFrame:
    """rows(nth, file_id, title, status, tables, note)"""
    done, failed = F.col("status") == "converted", F.col("status") == "error"
    counts = _one(rows, converted=F.count_if(done), with_tables=F.count_if(done & (F.col("tables") > 0)), errors=F.count_if(failed))
    return report_lines("page_repair", _given(counts, out_root=out_root, chunks=chunks), {"errors": rows.where(failed)})


def quality(files: DataFrame, tables: DataFrame) -> DataFrame:
    """files(nth, source_name, level, reasons, expected_tables), tables(level)"""
    levels = ("green", "yellow", "red")
    of = lambda df, kind: _one(df, **{f"{kind}_{x}": F.count_if(F.col("level") == x) for x in levels})
    at = lambda level: files.where(F.col("level") == level)
    yellow = at("yellow").withColumn("short_reasons", F.substring("reasons", 1, 240))
    return report_lines("quality", of(files, "files").join(of(tables, "tables")), {"red": at("red"), "yellow": yellow})  # a row on either side


def _percent(c: Column, places: int) -> Column:
    """As a percentage; halves of doubles are rounded to even, as they stand."""
    return F.format_string(f"%.{places}f%%", F.bround(c.cast("double") * 100, places))


def source_content(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """rows(nth, document, page, table, status, char_recall)"""
    checked, attested = F.col("status") == "checked", F.startswith("status", F.lit("attested:"))
    low = checked & (F.col("char_recall") < threshold)
    counts = _one(rows, checked=F.count_if(checked), below=F.count_if(low), attested=F.count_if(attested), review=F.count_if(~checked & ~attested), least=F.coalesce(F.min(F.when(checked, F.col("char_recall"))), F.lit(1.0)))
    counts = _given(counts.withColumn("minimum", _percent(F.col("least"), 2)), threshold=f"{threshold:.0%}")
    return report_lines("source_content", counts, {"below": rows.where(low).withColumn("recall", _percent(F.col("char_recall"), 2)), "review": rows.where(~checked & ~attested)})


def final(result: DataFrame, named: DataFrame, issues: DataFrame) -> DataFrame:
    """What final_audit() gives, one row, final_issues() and document_issues()."""
    failed = issues.where(F.size("issues") > 0).withColumn("issues", F.array_join("issues", ", "))
    return report_lines("final", result.withColumn("clean", F.col("clean").cast("string")), {"global_issues": named, "failed": failed})


def _judged(docs: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    found = {
        "unresolved_ocr": docs.where(F.col("ocr_status").isin(*labels.UNRESOLVED_OCR)),
        "near_empty": docs.where("body_chars < 30"),
        "suspicious": docs.where(F.size("issues") > 0).withColumn("issues", F.array_join("issues", ",")),
    }
    counts = _one(docs, unresolved_ocr=F.count_if(F.col("ocr_status").isin(*labels.UNRESOLVED_OCR)), near_empty=F.count_if(F.col("body_chars") < 30), suspicious=F.count_if(F.size("issues") > 0), spotcheck=F.count_if(F.col("quality_status").isin(*labels.REVIEW)))
    return counts.withColumn("ready", (F.expr("unresolved_ocr + near_empty + suspicious") == 0).cast("string")), found


def ready(docs: DataFrame, assembled: DataFrame, out_docs: str, chunks: int) -> DataFrame:
    """docs(doc_id, title, path, ocr_status, quality_status, body_chars, issues array), assembled(status) of every document taken."""
    kinds = lambda *names: F.count_if(F.col("status").isin(*names))
    taken = _one(assembled, copied=F.count(F.lit(1)), replaced_pdf=kinds("page_aware", "page_aware_extra"), ocr_pdf=kinds("ocr_backfill"), fallbacks=kinds("original_pdf_fallback"))
    return report_lines("ready", _given(_judged(docs)[0].join(taken), out_docs=out_docs, chunks=chunks))  # a row on either side


def ready_unresolved(docs: DataFrame) -> DataFrame:
    counts, found = _judged(docs)
    return report_lines("ready_unresolved", counts, found)


def prefilter(rows: DataFrame, documents: int, pages: int, note: str, candidate_csv: str, selection_json: str, enhancer: str, second_engine: str) -> DataFrame:
    """rows(file_id, title, page, confidence, reason): one for each table that two engines were compared on."""
    counts = _one(rows, tables=F.count(F.lit(1)), high=F.count_if(F.col("confidence") == "high"), conflict=F.count_if(F.col("confidence") == "conflict"))
    # a file's pages and reasons are few: reasons come from a list, pages are cut by the engines' own limits
    each = rows.where("confidence = 'conflict'").groupBy("file_id").agg(F.first("title").alias("title"), F.array_sort(F.collect_set("page")).alias("p"), F.array_sort(F.collect_set("reason")).alias("r"))
    conflicts = each.select("file_id", F.coalesce("title", "file_id").alias("title"), F.array_join(F.col("p").cast("array<string>"), ",").alias("pages"), F.substring(F.array_join("r", "; "), 1, 260).alias("short_reasons"))
    given = {"documents": documents, "pages": pages, "note": note, "candidate_csv": candidate_csv, "selection_json": selection_json, "enhancer": enhancer, "second_engine": second_engine}
    return report_lines("prefilter", _given(counts, **given), {"conflicts": conflicts})


def repair_apply(records: DataFrame, enhancer: str) -> DataFrame:
    """records(nth, doc_id, page, table, status, original_rows, enhanced_rows)"""
    statuses = records.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return report_lines("repair_apply", _given(_one(records.limit(0), n=F.count(F.lit(1))), enhancer=enhancer), {"statuses": statuses, "records": records})
