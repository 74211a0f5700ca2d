"""Frontmatter: a block of key: "value" lines before the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The keys that come first, in their order, and those that hold paths.
ORDER = ("doc_id", "doc_title", "source_path", "origin_archive", "archive_member_path", "document_kind", "source_extension", "source_size", "extraction_method", "ocr_status", "quality_status")
PATHS = ("source_path", "origin_archive", "archive_member_path", "output_markdown")
_BLOCK = r"(?s)\A---\s*\n(.*?)\n---\s*\n"


def body(c: Column) -> Column:
    return F.regexp_replace(c, _BLOCK, "")


def parsed(c: Column) -> Column:
    """map of the keys and values; a quoted value is unescaped, a path's doubled backslashes become one."""
    given = F.filter(F.split(F.regexp_extract(c, _BLOCK, 1), "\n"), lambda x: x.contains(":"))

    def pair(line: Column) -> Column:
        key, value = strip(F.substring_index(line, ":", 1)), strip(line.substr(F.instr(line, ":") + 1, F.length(line)))
        plain = F.regexp_replace(value, r'^"+|"+$', "")
        quoted = F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v"), plain)
        value = F.when(value.rlike(r'^".*"$') & (F.length(value) > 1), quoted).otherwise(plain)
        return F.struct(key.alias("key"), F.when(key.isin(*PATHS), F.regexp_replace(value, r"\\{2,}", r"\\")).otherwise(value).alias("value"))

    pairs = F.transform(given, pair)
    # the last of equal keys counts
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def quoted(value: Column) -> Column:
    text = F.regexp_replace(F.replace(F.replace(F.coalesce(value, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), "\n", " ")
    return F.concat(F.lit('"'), strip(text), F.lit('"'))


def encoded(meta: Column) -> Column:
    """The block for a map: known keys in their order, then the others by name."""
    line = lambda k: F.concat(k, F.lit(": "), quoted(F.element_at(meta, k)))
    known = F.filter(F.array(*map(F.lit, ORDER)), lambda k: F.map_contains_key(meta, k))
    rest = F.array_sort(F.array_except(F.map_keys(meta), known))
    return F.concat(F.lit("---\n"), F.array_join(F.transform(F.concat(known, rest), line), "\n"), F.lit("\n---\n\n"))
