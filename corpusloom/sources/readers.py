"""Readers and writers: files, JSON lines with their bad ones, CSV, archives; and the seam for outside engines."""

from __future__ import annotations

import csv
import io
import lzma
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from ..operators.publish import markdown_of
from .ooxml import BROKEN, markdown_of_package
from .route import hidden

MEMBERS = "archive string, via array<string>, member string, target string, bytes binary, error string"
_MEMBER_NAMES = ["archive", "via", "member", "target", "bytes", "error"]
#: What reading a broken, encrypted or unknown archive raises.
_BROKEN = (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError, EOFError, ValueError, zlib.error, lzma.LZMAError)
#: Members are handed on in frames of so many bytes or rows; archives within archives are expanded so deep.
FRAME_BYTES, FRAME_ROWS, DEPTH = 8 << 20, 1000, 16
#: What Spark's CSV reader takes for null, else it takes "" for it. A text of this sign alone, once or more, has one more in the file.
_NULL = "\ue000"


def files(spark: SparkSession, path: str, pattern: str | None = None, with_hidden: bool = False, without: str | None = None, excluded: tuple[str, ...] = ()) -> DataFrame:
    """path, content, length of all files below path, found by Spark's own reader, in the order of their lower-cased paths.

    without: a folder, of output for example, that is left out with all below it. excluded: parts of names that are left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path).select("path", "content", "length")
    bare = F.regexp_replace("path", "^[a-z]+:/*", "/")
    found = found if with_hidden else found.where(~hidden(F.regexp_replace(bare, "^/", "")))
    if without:
        found = found.where(~F.startswith(bare, F.lit(without.rstrip("/") + "/")))
    for part in excluded:
        found = found.where(~F.contains(F.regexp_extract("path", "([^/]*)$", 1), F.lit(part)))
    return found.orderBy(F.lower("path"))


def json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One row per document: an object, or each object of an array, over any number of lines."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """Each row as an indented object in a file of its own; for documents of a few rows, such as plans and summaries."""
    df.select(F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def _table_of(rows: list[list[str]]) -> str:
    width = max(map(len, rows), default=0)
    lines = ["| " + " | ".join([c.replace("|", "\\|").replace("\n", "<br>") for c in r] + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([*lines[:1], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]) if width else ""


def _converted(path: str, content: bytes | None) -> tuple[str | None, str | None]:
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("docx", "xlsx", "pptx"):
        try:
            return markdown_of_package(content)[1], None
        except BROKEN as e:
            return None, f"package_failed: {type(e).__name__}"
    text = (content or b"").decode("utf-8-sig", errors="replace")
    if kind in ("txt", "md"):
        return text, None
    if kind == "csv":
        return _table_of(list(csv.reader(io.StringIO(text)))), None
    if kind in ("html", "htm"):
        return markdown_of(text), None
    if kind in ("json", "xml"):
        return f"```{kind}\n{text.strip()}\n```", None
    return None, f"unsupported: .{kind}"


def converted(found: DataFrame) -> DataFrame:
    """(path, content) -> path, markdown, error: text, Markdown, CSV, JSON, XML, HTML and Office Open XML natively; a row
    of another kind has its error, and goes to an engine by adapted()."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(p, *_converted(p, c)) for p, c in zip(f["path"], f["content"])], columns=["path", "markdown", "error"])

    return found.select("path", "content").mapInPandas(run, "path string, markdown string, error string")


def report(title: str, counts: DataFrame, items: DataFrame | None = None, most: int = 100) -> DataFrame:
    """counts(name, value) and items(line) -> markdown, one row: a heading, a line per count by name, the first items by
    their text. The cut of the list is the feature of a report; the rows themselves are what the queries give."""
    lines = counts.agg(F.array_sort(F.collect_list(F.concat(F.lit("- "), "name", F.lit(": "), F.col("value").cast("string")))).alias("c"))
    whole = F.concat(F.lit(f"# {title}\n\n"), F.array_join("c", "\n"))
    if items is None:
        return lines.select(whole.alias("markdown"))
    top = items.orderBy("line").limit(most).agg(F.array_sort(F.collect_list(F.concat(F.lit("- "), "line"))).alias("i"))
    return lines.join(top).select(F.concat(whole, F.when(F.size("i") > 0, F.concat(F.lit("\n\n"), F.array_join("i", "\n"))).otherwise("")).alias("markdown"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no (from 1), line of text files of any size: each file is read in as many splits as Spark makes of it.

    A line's number is its place in its split plus the lines of the file's earlier splits. Only the counts of splits, one row
    each, are summed up and joined back. Lines end with LF, CR LF or CR; a BOM is left out."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("id"))
    splits = rows.groupBy("path", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("path", "start", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("from"))
    numbered = rows.join(before, ["path", "start"]).select("path", (F.col("id") + F.col("from")).alias("line_no"), "line")
    return numbered.withColumn("line", F.when(F.col("line_no") == 1, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line")))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """path, line_no (from 1), row, issue: a line that isn't an object is kept with its number in issue. Blank lines are left out
    but counted."""
    lines = numbered_lines(spark, path).where(F.col("line").rlike(r"\S"))
    lines = lines.withColumn("row", F.from_json("line", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("row._bad").isNotNull() | ~F.col("line").rlike(r"^\s*\{")
    return lines.select("path", "line_no", "row", F.when(bad, F.concat(F.lit("invalid_chunk_json_line:"), "line_no")).alias("issue"))


def json_lines_or_missing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """json_lines(), or where there is no such file one row that says so."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return json_lines(spark, path, schema)
    return spark.createDataFrame([(path, None, None, "chunks_file_missing")], f"path string, line_no long, row struct<{schema}, _bad string>, issue string")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _texts(df: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    names = ["`" + n.replace("`", "``") + "`" for n in df.columns]
    return df.select(*[f(F.col(q)).alias(n) if kind == "string" else F.col(q) for q, (n, kind) in zip(names, df.dtypes)])


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Values as the file holds them, with blanks and line ends; a quoted empty text is a text, nothing at all is null."""
    found = spark.read.csv(path, header=True, schema=schema, encoding="UTF-8", multiLine=True, nullValue=_NULL, emptyValue="")
    return _texts(found, lambda c: F.when(c.rlike(rf"^{_NULL}{{2,}}\z"), F.substr(c, F.lit(2))).otherwise(c))


def write_csv(df: DataFrame, path: str) -> None:
    """Nothing is trimmed from the ends of texts; null and empty texts stay apart: csv_rows() gives the same rows again. Null is
    written as nothing, or in a file of one column, whose blank lines are skipped by readers, as the sign for it."""
    marked = _texts(df, lambda c: F.when(c.rlike(rf"^{_NULL}+\z"), F.concat(c, F.lit(_NULL))).otherwise(c))
    marked.write.mode("overwrite").csv(path, header=True, nullValue=_NULL if len(df.columns) == 1 else "", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def repaired_name(name: str, is_utf8: bool) -> str:
    """A member name without the UTF-8 flag whose bytes are GBK for Chinese text."""
    if is_utf8:
        return name
    try:
        again = name.encode("cp437").decode("gbk")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return name
    return again if any("一" <= c <= "鿿" for c in again) else name


def _members(content: bytes | None) -> Iterator[tuple[str, str | None, bytes | None, str | None]]:
    """(name, target, bytes, error) of each member. All are read through once before, so that a broken archive fails as a
    whole while only one member is held at a time."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        if (bad := z.testzip()) is not None:
            raise zipfile.BadZipFile(bad)
        named = [(repaired_name(i.filename, bool(i.flag_bits & 0x800)).replace("\\", "/"), i) for i in z.infolist() if not i.is_dir()]
        shared = len({n.split("/", 1)[0] for n, _ in named}) == 1 and all("/" in n for n, _ in named)
        for n, i in named:
            if n.startswith("/") or ".." in n.split("/"):
                yield n, None, None, "unsafe_member_path"
            else:
                yield n, n.split("/", 1)[1] if shared else n, z.read(i), None


def _within(content: bytes | None, via: tuple[str, ...], depth: int) -> Iterator[tuple]:
    """(via, name, target, bytes, error), with the members of archives down to that depth in place of these."""
    try:
        for name, target, data, error in _members(content):
            if error is None and depth > 0 and name.lower().endswith(".zip"):
                yield from _within(data, (*via, name), depth - 1)
            else:
                yield via, name, target, data, error
    except _BROKEN as e:
        yield via, None, None, None, f"archive_failed: {type(e).__name__}"


def _expanded(depth: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                for via, name, target, data, error in _within(content, (), depth):
                    held.append((path, list(via), name, target, data, error))
                    size += len(data or b"")
                    if size >= FRAME_BYTES or len(held) >= FRAME_ROWS:
                        yield pd.DataFrame(held, columns=_MEMBER_NAMES)
                        held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=_MEMBER_NAMES)

    return run


@F.pandas_udf(BinaryType())
def zipped(names: pd.Series, texts: pd.Series) -> pd.Series:
    """Archives of so many texts under their names; a null list of names gives bytes that are no archive."""

    def one(ns, ts) -> bytes:
        if ns is None:
            return b"none"
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for n, t in zip(ns, ts):
                z.writestr(n, t)
        return data.getvalue()

    return pd.Series([one(n, t) for n, t in zip(names, texts)])


def archive_members(archives: DataFrame) -> DataFrame:
    """archives(path, content) -> archive, member, target, bytes, error. A folder that holds all members is left out of
    target; members that would leave the folder aren't read; a broken archive is one row with its error."""
    return archives.select("path", "content").mapInPandas(_expanded(0), MEMBERS).drop("via")


def nested_members(archives: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The same with the members of ZIP archives within archives in place of these, and via, the names of the archives that
    lead from the outermost one, archive, to the member. A broken inner archive is one row without a member, via its name.

    An archive below depth others, as one that holds itself would be, and one of another kind has an error and its bytes."""
    unread = F.col("error").isNull() & F.lower("member").rlike(r"\.(zip|rar)$")
    return archives.select("path", "content").mapInPandas(_expanded(depth), MEMBERS).withColumn("error", F.when(unread, F.lit("archive_failed: not expanded")).otherwise(F.col("error")))


def adapted(df: DataFrame, engine: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """The seam for converters, OCR clients and PDF engines: iterator of frames in, iterator of frames out.

    Filters aren't pushed through it, so choose the rows before."""
    return df.mapInPandas(engine, schema)
