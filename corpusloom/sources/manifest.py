"""Manifest rows: statuses of conversions, what is unresolved, slices and targets, upserts of finished work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

# Status sets and image extensions.
UNRESOLVED = {"conversion_status": ("failed", "unsupported", "archive_failed"), "quality_status": ("unresolved", "needs_review"), "ocr_status": ("needs_ocr", "needs_review")}
IMAGES = (".png", ".jpg", ".jpeg", ".bmp", ".tif", ".tiff", ".webp")
SHORT = 80


def ocr_status(extension: Column, pdf_status: Column, has_model: Column) -> Column:
    image = extension.isin(*IMAGES)
    return F.when(image & ~has_model, "needs_ocr").when(image | ((pdf_status == "needs_ocr") & has_model), "vision_ocr_attempted").otherwise(F.coalesce(F.when(pdf_status != "", pdf_status), F.lit("not_required")))


def quality_status(text: Column, ocr: Column) -> Column:
    return F.when((F.length(strip(text)) < SHORT) | ocr.isin("needs_ocr", "needs_review"), "needs_review").otherwise("ok")


def sampled_density(pages: DataFrame, key: str) -> DataFrame:
    """(key, page, text): the first three of the first ten pages with 30 characters or more -> key, ocr_status, samples."""
    some = pages.where("page <= 10").withColumn("t", strip(F.col("text"))).where(F.length("t") >= 30)
    first = some.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy("page"))).where("k <= 3")
    each = first.groupBy(key).agg(F.count(F.lit(1)).alias("samples"), ((F.sum(F.length("t")) + F.count(F.lit(1)) - 1) / F.count(F.lit(1))).alias("density"))
    out = pages.select(key).distinct().join(each, key, "left")
    return out.select(key, F.when(F.col("samples").isNull(), "needs_ocr").when(F.col("density") < 180, "needs_review").otherwise("text_ok").alias("ocr_status"), F.coalesce("samples", F.lit(0)).alias("samples"))


def unresolved(rows: DataFrame) -> DataFrame:
    some = F.lit(False)
    for c, values in UNRESOLVED.items():
        some = some | F.coalesce(F.col(c).isin(*values), F.lit(False))
    return rows.where(some)


def sliced(rows: DataFrame, order: list[str], start: int, limit: int) -> DataFrame:
    """limit rows from the start-th (from 1) in order; the limit is the feature."""
    return rows.orderBy(*order).offset(start - 1).limit(limit)


def upserted(rows: DataFrame, updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """rows with the columns of updates where these have the key; of updates that repeat a key the last by order counts.
    Null keys equal each other."""
    columns = [c for c in updates.columns if c not in (*keys, order)]
    last = updates.groupBy(*keys).agg(F.max(F.struct(order, *columns)).alias("_last")).select(*(F.col(k).alias(f"_{k}") for k in keys), "_last")
    on = [rows[k].eqNullSafe(last[f"_{k}"]) for k in keys]
    out = rows.join(last, on, "left")
    return out.select(*(F.when(F.col("_last").isNotNull(), F.col(f"_last.{c}")).otherwise(rows[c]).alias(c) if c in columns else rows[c] for c in rows.columns))
