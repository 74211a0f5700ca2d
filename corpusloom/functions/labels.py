"""Column functions that name things: titles, callouts, data URIs, inline marks, what a document is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# MIME types of image names; status sets; marks of callouts, the first that fits counts.
MIME = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".gif": "image/gif", ".webp": "image/webp", ".bmp": "image/bmp", ".svg": "image/svg+xml"}
UNRESOLVED_OCR = ("needs_ocr", "paddleocr_partial", "vision_ocr_partial")
REVIEW = ("needs_review", "needs_human_spotcheck")
CALLOUTS = (("warning", "⚠️"), ("tip", "💡"), ("ok", "✅"))
#: Inline marks: bold, italic, code, link.
INLINE = r"\*\*[^*]+\*\*|\*[^*\n]+\*|`[^`]+`|\[[^\]]+\]\([^)]+\)"


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]*$", "")


def data_uri(path: Column, content: Column) -> Column:
    """data:<type>;base64,<content>; the type by the name, application/octet-stream if it tells none."""
    mime = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in MIME.items() for x in kv)), suffix(path)), F.lit("application/octet-stream"))
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def inline_tokens(text: Column) -> Column:
    """Array of (kind, text, target): plain runs and bold, italic, code and link marks in order."""
    parts = F.filter(F.split(F.regexp_replace(text, f"({INLINE})", "\u0000$1\u0000"), "\u0000"), lambda x: x != "")

    def token(x: Column) -> Column:
        marks = (("bold", r"^\*\*([^*]+)\*\*$", ""), ("italic", r"^\*([^*\n]+)\*$", ""), ("code", r"^`([^`]+)`$", ""), ("link", r"^\[([^\]]+)\]\([^)]+\)$", r"^\[[^\]]+\]\(([^)]+)\)$"))
        of = lambda kind, inner, target: F.struct(F.lit(kind).alias("kind"), inner.alias("text"), target.alias("target"))
        found = of("text", x, F.lit(None).cast("string"))
        for kind, inner, target in reversed(marks):
            found = F.when(x.rlike(inner), of(kind, F.regexp_extract(x, inner, 1), F.regexp_extract(x, target, 1) if target else F.lit(None).cast("string"))).otherwise(found)
        return found

    return F.transform(parts, token)


def clean_title(title: Column) -> Column:
    """A first-level heading without its chapter mark, then without two digits; the title itself if nothing is left."""
    short = F.regexp_replace(F.regexp_replace(title, r"^(第\s*\d+\s*章|附录|后记)\s*", ""), r"^\d{2}\s+", "")
    return F.when(short == "", title).otherwise(short)


def title_and_body(body: Column, given: Column, path: Column) -> Column:
    """(title, body): the title given, else the first-level heading that the text begins with, else the file's stem. Such a
    heading leaves the body, with the blank lines after it."""
    top = r"(?s)\A((?:[^\S\n]*\n)*)[^\S\n]*# ([^\n]*)(?:\n[^\S\n]*(?=\n|\z))*(?:\n|\z)"
    heading = F.when(body.rlike(top), strip(F.regexp_extract(body, top, 2)))
    first = lambda *cs: F.coalesce(*(F.when(c != "", c) for c in cs))
    return F.struct(first(given, heading, stem(path)).alias("title"), F.regexp_replace(body, top, "$1").alias("body"))


def callout(quote: Column) -> Column:
    """Kind of a quoted block: its mark within the first ten characters or in bold anywhere; note without one."""
    found = F.lit("note")
    for kind, mark in reversed(CALLOUTS):
        found = F.when(F.substring(quote, 1, 10).contains(mark) | quote.contains(f"**{mark}"), kind).otherwise(found)
    return found


def is_pdf(kind: Column, extension: Column, source_path: Column, path: Column) -> Column:
    """By kind, extension, source path or first folder of the document."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return (F.coalesce(kind, F.lit("")) == "pdf") | (low(extension) == ".pdf") | F.endswith(low(source_path), F.lit(".pdf")) | (F.lower(F.substring_index(path, "/", 1)) == "pdf")
