"""Routing of files to conversion paths, and what their manifest says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Extensions of the buckets.
EXTENSIONS = {
    "simple_direct": (".csv", ".docx", ".htm", ".html", ".json", ".md", ".pptx", ".txt", ".xlsx", ".xml"),
    "legacy_office": (".doc", ".ppt", ".xls"),
    "needs_ocr": (".bmp", ".jpeg", ".jpg", ".png", ".tif", ".tiff", ".webp"),
    "archive": (".rar", ".zip"),
    "pdf_text": (".pdf",),
}
BUCKETS = {e: b for b, es in EXTENSIONS.items() for e in es}
LOW_TEXT, NEEDS_OCR_SHARE, IMAGE_SHARE = 40, 0.7, 0.5


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def bucket(ext: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in BUCKETS.items() for x in kv))
    return F.coalesce(F.element_at(known, ext), F.lit("unsupported"))


def hidden(path: Column) -> Column:
    """A part of the path starts with a dot, or the name with ~$."""
    return path.rlike(r"(^|/)\.[^/]") | path.rlike(r"(^|/)~\$[^/]*$")


def routed(files: DataFrame) -> DataFrame:
    """files(path, bytes) -> path, extension, bytes, bucket; hidden ones are left out. What a PDF's pages say (pdf_route) comes later."""
    return files.where(~hidden(F.col("path"))).select("path", extension(F.col("path")).alias("extension"), "bytes", bucket(extension(F.col("path"))).alias("bucket"))


def pdf_route(pages: DataFrame) -> DataFrame:
    """(path, page, n_text_chars, n_images, n_tables, table_detection_ok) -> path, pages, average_text_chars, low_text_pages,
    image_pages, table_pages, bucket: tables first, then scans, then what only a person can tell."""
    low = F.count_if(F.col("n_text_chars") < LOW_TEXT)
    each = pages.groupBy("path").agg(F.count(F.lit(1)).alias("pages"), F.round(F.avg("n_text_chars"), 1).alias("average_text_chars"), low.alias("low_text_pages"), F.count_if(F.col("n_images") > 0).alias("image_pages"), F.count_if(F.col("n_tables") > 0).alias("table_pages"), F.min("table_detection_ok").alias("ok"))
    share = lambda c: F.col(c) / F.col("pages")
    route = F.when(F.col("table_pages") > 0, "pdf_table").when((share("low_text_pages") >= NEEDS_OCR_SHARE) & (share("image_pages") >= IMAGE_SHARE), "needs_ocr").when((F.col("low_text_pages") == F.col("pages")) | ~F.col("ok"), "manual_review").otherwise("pdf_text")
    return each.withColumn("bucket", route).drop("ok")


def text_status(chars: Column) -> Column:
    """OCR status by characters per sampled page; null where no page could be sampled."""
    return F.when(chars.isNull(), "needs_ocr").when(chars < 180, "needs_review").otherwise("text_ok")


def resume(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to do: rows whose keys are not finished."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


# The order in which buckets are recommended, and those that a run takes by default.
ORDER = ("simple_direct", "pdf_text", "legacy_office", "needs_ocr", "pdf_table", "archive", "manual_review", "unsupported")
CHEAP = ("simple_direct", "pdf_text", "legacy_office")


#: What works a bucket off, by names of our own; planned() takes others.
WORKERS = {
    "simple_direct": "converter",
    "pdf_text": "converter",
    "legacy_office": "converter",
    "needs_ocr": "ocr",
    "pdf_table": "table_repair",
    "archive": "converter",
    "manual_review": "router",
    "unsupported": "router",
}


def planned(entries: DataFrame, workers: dict[str, str] = WORKERS) -> DataFrame:
    """entries(path, bytes, bucket, ...) with skill and place, the bucket's worker and its place in the order of all buckets.

    A plan is a table of entries: its order is that of place and lower-cased path, which whoever writes it out sorts by."""
    each = lambda kv: F.element_at(F.create_map(*(F.lit(x) for pair in kv for x in pair)), F.col("bucket"))
    return entries.withColumns({"skill": each(workers.items()), "place": each((b, k + 1) for k, b in enumerate(ORDER))})


def recommended(plan: DataFrame) -> DataFrame:
    """planned(bucket, skill, place) -> bucket, skill, n, recommended_order: from 1, without the buckets that have no entries."""
    counts = plan.groupBy("bucket", "skill", "place").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bucket", "skill", "n", F.row_number().over(Window.orderBy("place")).alias("recommended_order"))


def selected(plan: DataFrame, buckets: tuple[str, ...] = CHEAP) -> DataFrame:
    """planned(bucket, path) -> distinct path of the buckets asked for; an absent bucket is empty, an unknown one an error."""
    if unknown := [b for b in buckets if b not in ORDER]:
        raise ValueError(f"no such bucket: {', '.join(unknown)}")
    return plan.where(F.col("bucket").isin(*buckets)).select("path").distinct()
