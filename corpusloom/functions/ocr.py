"""Clean-up of answers of vision models, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The keys that a JSON answer may hold its text under, in their order; lines of commentary; a blank page.
KEYS = ("markdown", "ocr_markdown", "text", "content")
COMMENTARY = (
    r"The user wants\b", r"Let me\b", r"I can see\b", r"I see\b", r"The page appears\b", r"The document appears\b", r"The document is\b", r"The rest of the page\b",
    r"Starting from\b", r"Body text starts\b", r"Header:", r"Document number:", r"Title:", r"Signature area\b", r"Page number:", r"At the (?:top|bottom),\b", r"And the page number\b",
    r"I'll mark\b", "我看到", "让我", "下面是", "以下是.*转写",
)
BLANK = "[blank page]"


def answer(c: Column) -> Column:
    """The text of an answer: code fences go, a JSON object is unwrapped, lines of commentary go, nothing becomes BLANK."""
    s = F.regexp_replace(F.regexp_replace(strip(c), r"(?i)^```(?:json|markdown|md)?\s*", ""), r"\s*```$", "")
    found = F.regexp_extract(s, r"(?s)(\{.*\})", 1)
    values = (strip(F.get_json_object(found, f"$.{k}")) for k in KEYS)
    s = F.coalesce(*(F.when(F.length(v) > 0, v) for v in values), s)
    kept = F.filter(F.split(s, "\r\n|\r|\n"), lambda x: ~x.rlike(rf"(?i)^\s*(?:{'|'.join(COMMENTARY)})"))
    s = strip(F.array_join(kept, "\n"))
    return F.when(F.length(s) > 0, s).otherwise(BLANK)
