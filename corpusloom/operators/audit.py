"""Assembly, inspection, source recall and the final audit."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions import labels
from ..functions import text as T

# Thresholds of the checks.
NEAR_EMPTY, FRAGMENT_LINES, FRAGMENT_SHARE, LEAST_RECALL = 30, 20, 0.65, 0.9


def assembled(base: DataFrame, ocr: DataFrame, page_aware: DataFrame) -> DataFrame:
    """(doc_id, body, is_pdf) and two (doc_id, body) -> doc_id, origin, body: OCR text, then page-aware text, then the
    original; documents that are no PDF keep theirs; ids that only the others have are appended."""
    ranked = base.select("doc_id", "body", F.lit("original").alias("origin"), F.lit(3).alias("rank"), "is_pdf").unionByName(ocr.select("doc_id", "body", F.lit("ocr").alias("origin"), F.lit(1).alias("rank"), F.lit(None).cast("boolean").alias("is_pdf"))).unionByName(page_aware.select("doc_id", "body", F.lit("page_aware").alias("origin"), F.lit(2).alias("rank"), F.lit(None).cast("boolean").alias("is_pdf")))
    # one aggregation finds the best body of each id; bodies are not sorted
    best = ranked.groupBy("doc_id").agg(F.min(F.struct("rank", "origin", "body")).alias("best"), F.max("is_pdf").alias("is_pdf"), F.max(F.when(F.col("origin") == "original", F.struct("origin", "body"))).alias("own"))
    own = F.col("own").isNotNull() & ~F.coalesce("is_pdf", F.lit(False))
    return best.select("doc_id", F.when(own, F.col("own.origin")).otherwise(F.col("best.origin")).alias("origin"), F.when(own, F.col("own.body")).otherwise(F.col("best.body")).alias("body"))


def inspected(docs: DataFrame, body: str = "text") -> DataFrame:
    """docs with compact_chars, near_empty, replacement_char, provider_error, fragmented."""
    lower = F.lower(body)
    errors = F.lit(False)
    for e in T.PROVIDER_ERRORS:
        errors = errors | lower.contains(e)
    content = F.filter(F.transform(T.lines(F.regexp_replace(body, T.COMMENT, "")), lambda x: F.regexp_replace(x, T.COMPACTED, "")), lambda x: F.length(x) > 0)
    docs = docs.withColumn("_content", content).withColumn("compact_chars", F.length(T.compact(F.col(body))).cast("long"))
    tiny = F.size(F.filter("_content", lambda x: F.length(x) <= 2))
    broken = (F.size("_content") >= FRAGMENT_LINES) & (tiny / F.greatest(F.size("_content"), F.lit(1)) >= FRAGMENT_SHARE)
    return docs.withColumn("near_empty", F.col("compact_chars") < NEAR_EMPTY).withColumn("replacement_char", F.contains(F.col(body), F.lit("�"))).withColumn("provider_error", errors).withColumn("fragmented", broken).drop("_content")


def page_issues(pages: DataFrame) -> DataFrame:
    """(doc_id, page, text) of completed OCR -> doc_id, n_pages, duplicate_markers, non_contiguous, sparse, mostly_blank."""
    size = F.length(T.compact(F.col("text")))
    each = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.count_distinct("page").alias("d"), F.min("page").alias("lo"), F.max("page").alias("hi"), F.sum(size).alias("chars"), F.count_if(size < 5).alias("blank"))
    return each.select("doc_id", "n_pages", (F.col("d") != F.col("n_pages")).alias("duplicate_markers"), ((F.col("lo") != 1) | (F.col("hi") != F.col("d"))).alias("non_contiguous"), (F.col("chars") < F.greatest(F.lit(30), F.col("n_pages") * 12)).alias("sparse"), ((F.col("n_pages") >= 3) & (F.col("blank") / F.col("n_pages") > 0.5)).alias("mostly_blank"))


@F.pandas_udf(DoubleType())
def recall_of(source: pd.Series, target: pd.Series) -> pd.Series:
    """Share of the source's letters and digits, as a multiset, that the target has; 1.0 for none. Counted within the row."""

    def one(a: str | None, b: str | None) -> float:
        want, have = Counter(T.alphanumeric(a)), Counter(T.alphanumeric(b))
        return (want & have).total() / want.total() if want else 1.0

    return pd.Series([one(a, b) for a, b in zip(source, target)], dtype="float64")


def char_recall(pairs: DataFrame, source: str, target: str, key: str) -> DataFrame:
    """key, recall: one row per row of pairs; nothing is shuffled."""
    return pairs.select(key, F.round(recall_of(source, target), 6).alias("recall"))


def attested(rows: DataFrame, attestations: DataFrame) -> DataFrame:
    """rows(document, page, table_no, status) ⟕ attestations(document, page, table_no, status): an exact key comes before the page's,
    that before the document's; empty strings stand for any."""
    out = rows
    for n, (p, t) in enumerate(((F.col("page"), F.col("table_no")), (F.col("page"), F.lit("")), (F.lit(""), F.lit("")))):
        side = attestations.select(F.col("document").alias(f"d{n}"), F.col("page").alias(f"p{n}"), F.col("table_no").alias(f"t{n}"), F.col("status").alias(f"s{n}")).dropDuplicates([f"d{n}", f"p{n}", f"t{n}"])
        out = out.join(side, (F.col("document") == F.col(f"d{n}")) & (p == F.col(f"p{n}")) & (t == F.col(f"t{n}")), "left")
    return out.select(*rows.columns, F.coalesce("s0", "s1", "s2", "status").alias("final_status"))


def duplicates(df: DataFrame, *keys: str | Column) -> DataFrame:
    """keys, n of those that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def latest(log: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Upsert: the last row of each key, by order; an aggregation, so a hot key is combined before the shuffle."""
    return log.groupBy(*key).agg(F.max(F.struct(*order, value)).alias("last")).select(*key, *(F.col(f"last.{c}").alias(c) for c in (*order, value)))


def within_budget(rows: DataFrame, key: str, size: str, budget: int, parts: int = 64) -> DataFrame:
    """Rows in the order of key, a whole number, while the running sum of size, which isn't negative, is within budget.

    Keys are cut into ranges of about as many rows, whatever their spread; sums before a range come from one row per range, sums within
    it from its own rows. Rows with equal keys are added one by one, in any order; null keys come first."""
    cuts = rows.agg(F.percentile_approx(F.col(key).cast("long"), F.array(*(F.lit(k / parts) for k in range(1, parts))))).first()[0]
    bounds = F.array(*(F.lit(c) for c in sorted({*(cuts or [])}))).cast("array<bigint>")
    ranged = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.coalesce(F.col(key), F.lit(-(1 << 63))))))
    before = ranged.groupBy("_range").agg(F.sum(size).alias("_sum"))
    before = before.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before")).where(F.col("_before") <= budget)  # parts rows at most
    within = F.sum(size).over(Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(F.broadcast(before), "_range").withColumn("running", F.col("_before") + within).where(F.col("running") <= budget).drop("_range", "_before")


def coverage(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """doc_id, side of ids that only documents or only chunks have."""
    d, c = documents.select("doc_id").distinct(), chunks.select("doc_id").distinct()
    return d.join(c, "doc_id", "left_anti").withColumn("side", F.lit("without_chunks")).unionByName(c.join(d, "doc_id", "left_anti").withColumn("side", F.lit("without_document")))


@F.pandas_udf(StructType([StructField("cells", LongType()), StructField("rate", DoubleType())]))
def _cells_found(cells: pd.Series, text: pd.Series) -> pd.DataFrame:
    def one(given, t: str | None) -> tuple[int, float]:
        wanted, target = [x for x in map(T.alphanumeric, given if given is not None else ()) if x], T.alphanumeric(t)
        return len(wanted), sum(x in target for x in wanted) / len(wanted) if wanted else 1.0

    return pd.DataFrame([one(c, t) for c, t in zip(cells, text)], columns=["cells", "rate"])


def exact_cell_rate(cells: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """cells(key, cell), targets(key, text) -> key, cells, exact_cell_rate: share of cells whose letters and digits the
    target holds, after NFKC; 1.0 for none. Short cells match almost anywhere: this isn't cell-exact."""
    both = targets.select(key, "text").join(cells.groupBy(key).agg(F.collect_list("cell").alias("_cells")), key, "left").withColumn("_found", _cells_found("_cells", "text"))
    return both.select(key, F.col("_found.cells").alias("cells"), F.round("_found.rate", 6).alias("exact_cell_rate"))


def issues_of(docs: DataFrame, body: str) -> DataFrame:
    """docs with issues, an array in the order of the checks, after inspected()."""
    checks = (("replacement_character", "replacement_char"), ("provider_error", "provider_error"), ("garbled_or_fragmented", "fragmented"))
    return inspected(docs, body).withColumn("issues", F.array_compact(F.array(*(F.when(F.col(c), n) for n, c in checks))))


def readiness(docs: DataFrame, body: str = "body") -> DataFrame:
    """docs(ocr_status, quality_status, body) -> one row of counts and ready. Spot checks don't stand in the way."""
    d = issues_of(docs, body)
    counts = {"unresolved_ocr": F.col("ocr_status").isin(*labels.UNRESOLVED_OCR), "near_empty": F.col("near_empty"), "suspicious": F.size("issues") > 0, "needs_spotcheck": F.col("quality_status").isin(*labels.REVIEW)}
    out = d.agg(F.count(F.lit(1)).alias("documents"), *(F.count_if(c).alias(n) for n, c in counts.items()))
    return out.withColumn("ready", (F.col("unresolved_ocr") == 0) & (F.col("near_empty") == 0) & (F.col("suspicious") == 0))


def document_issues(docs: DataFrame, inventory: DataFrame) -> DataFrame:
    """docs(path, raw binary, doc_id, source_path, body), inventory(path) -> path, doc_id, source_path, body_chars, issues: encoding
    first, then the text's, then ids and paths that are missing."""
    there = inventory.select(F.col("path").alias("source_path"), F.lit(True).alias("_there")).distinct()
    d = issues_of(docs.join(there, "source_path", "left"), "body")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    checks = [("utf8_bom", F.hex(F.substring("raw", 1, 3)) == "EFBBBF"), ("invalid_utf8", ~F.is_valid_utf8(F.col("raw").cast("string")))]
    after = [("missing_doc_id", blank("doc_id")), ("missing_source_path", blank("source_path")), ("source_path_not_found", ~blank("source_path") & F.col("_there").isNull())]
    some = lambda cs: F.array_compact(F.array(*(F.when(c, n) for n, c in cs)))
    return d.select("path", "doc_id", "source_path", F.col("compact_chars").alias("body_chars"), F.array_distinct(F.concat(some(checks), F.col("issues"), some(after))).alias("issues"))


def _found(docs: DataFrame, chunks: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row of counts over documents and chunks; each part of it is one row as well."""
    member = F.when(F.col("member") != "", F.col("member"))
    keyed = F.when(F.coalesce(F.col("source_path"), F.lit("")) != "", F.concat_ws("::", "source_path", member))
    known = inventory.select("path").distinct()
    good = chunks.where("bad_line IS NULL")

    def twice(d: DataFrame, c: Column, name: str) -> DataFrame:
        some = d.where(F.coalesce(c, F.lit("")) != "").groupBy(c.alias("k")).count().where("count > 1")
        return some.agg(F.count(F.lit(1)).alias(name))

    def lost(c: str, name: str) -> DataFrame:
        return good.join(known, good[c] == known["path"], "left_anti").agg(F.count(F.lit(1)).alias(name))

    ids = lambda d, name: d.where("coalesce(doc_id, '') <> ''").select("doc_id").distinct().withColumn(name, F.lit(1))
    apart = F.count_if(F.col("d").isNull() | F.col("c").isNull()).alias("apart")
    parts = [
        docs.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.size("issues") > 0).alias("failed_documents"), F.count_distinct(keyed).alias("unique_source_paths")),
        ids(docs, "d").join(ids(chunks, "c"), "doc_id", "full_outer").agg(apart, F.count("d").alias("unique_doc_ids"), F.count("c").alias("unique_chunk_doc_ids")),
        twice(docs, F.col("doc_id"), "same_ids"),
        twice(docs, keyed, "same_sources"),
        twice(chunks, F.col("chunk_id"), "same_chunks"),
        lost("markdown_path", "lost_markdown"),
        lost("source_path", "lost_sources"),
        chunks.agg(F.count_if(F.col("bad_line").isNull()).alias("chunks"), F.count_distinct("bad_line").alias("bad_lines")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part)  # a row on either side
    return out


def _named(expected: int | None) -> list[Column]:
    """The issues of the row of counts, in their order, null where there is none; bad lines come between the third and the fourth."""
    count = lambda name, c: F.when(F.col(c) > 0, F.concat(F.lit(f"{name}:"), F.col(c).cast("string")))
    mismatch = F.concat(F.lit("document_count_mismatch:"), F.col("documents").cast("string"), F.lit(f"!={expected}"))
    return [
        F.when(F.col("documents") != expected, mismatch) if expected is not None else F.lit(None).cast("string"),
        count("duplicate_doc_ids", "same_ids"),
        count("duplicate_source_paths", "same_sources"),
        count("duplicate_chunk_ids", "same_chunks"),
        F.lit(None).cast("string"),
        count("missing_chunk_markdown_paths", "lost_markdown"),
        count("missing_chunk_source_paths", "lost_sources"),
        F.when(F.col("apart") > 0, "chunk_document_coverage_mismatch"),
    ]


def final_issues(docs: DataFrame, chunks: DataFrame, inventory: DataFrame, expected: int | None = None) -> DataFrame:
    """The global issues that final_audit() counts, a row each -> nth, issue, in the order of nth; each bad line is one."""
    return audited_issues(docs, chunks, inventory, expected).where("issue IS NOT NULL").select("nth", "issue")


def audited_issues(docs: DataFrame, chunks: DataFrame, inventory: DataFrame, expected: int | None = None) -> DataFrame:
    """The row of final_audit() for each global issue, with nth and issue; once, with nulls in these, if there is none."""
    counts = _audited(docs, chunks, inventory, expected)
    bad = chunks.where("bad_line IS NOT NULL").select(F.lit(4).cast("long").alias("k"), F.col("bad_line").cast("long").alias("line")).distinct()
    places = docs.sparkSession.range(len(_named(expected))).select(F.col("id").alias("k"), F.lit(None).cast("long").alias("line"))
    each = places.unionByName(bad).crossJoin(F.broadcast(counts))  # one row of counts
    named = F.concat(F.lit("invalid_chunk_json_line:"), F.col("line").cast("string"))
    each = each.withColumn("issue", F.coalesce(named, F.get("named", F.col("k").cast("int"))))
    each = each.where("issue IS NOT NULL OR global_issues = 0 AND k = 0")
    nth = F.when(F.col("issue").isNotNull(), F.col("k") * F.lit(1 << 40) + F.coalesce("line", F.lit(0)))
    return each.select(*_COUNTS, nth.alias("nth"), "issue")


def final_audit(docs: DataFrame, chunks: DataFrame, inventory: DataFrame, expected: int | None = None) -> DataFrame:
    """Issues of documents as document_issues() gives them, with member; chunks(chunk_id, doc_id, markdown_path,
    source_path, bad_line) -> one row: counts, global_issues (how many final_issues() names), clean."""
    return _audited(docs, chunks, inventory, expected).select(*_COUNTS)


_COUNTS = ["documents", "failed_documents", "unique_doc_ids", "unique_source_paths", "chunks", "unique_chunk_doc_ids", "global_issues", "clean"]


def _audited(docs: DataFrame, chunks: DataFrame, inventory: DataFrame, expected: int | None) -> DataFrame:
    """One row of counts, with named, what the issues beside bad lines are called."""
    out = _found(docs, chunks, inventory).withColumn("named", F.array(*_named(expected)))
    out = out.withColumn("global_issues", F.size(F.array_compact("named")).cast("long") + F.col("bad_lines"))
    return out.withColumn("clean", (F.col("failed_documents") == 0) & (F.col("global_issues") == 0))
