"""Joins that find a row's counterpart step by step: by key, else by a unique name, else by what a name contains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import name, stem


def by_path_or_name(left: DataFrame, right: DataFrame, path: str = "source_path", order: str = "nth") -> DataFrame:
    """left(path, ...) ⟕ right(path, order, ...): on the case-folded path, the last of equal ones; else on the case-folded
    name, if one row alone has it. Columns of right come as a struct, match."""
    rest = F.struct(*right.columns).alias("match")
    exact = right.where(F.col(path) != "").groupBy(F.lower(path).alias("_p")).agg(F.max(F.struct(order, rest)).alias("_x")).select("_p", F.col("_x.match").alias("_exact"))
    named = right.groupBy(F.lower(name(F.col(path))).alias("_n")).agg(F.count(F.lit(1)).alias("_k"), F.first(rest).alias("_named")).where("_k = 1 AND _n <> ''").select("_n", "_named")
    out = left.withColumn("_p", F.lower(path)).withColumn("_n", F.lower(name(F.col(path)))).join(exact, "_p", "left").join(named, "_n", "left")
    return out.select(*left.columns, F.coalesce("_exact", "_named").alias("match"))


#: Sizes of the pieces by which names are found; the last is for parts that are as long at least.
GRAMS = (1, 2, 3, 6)


def _pieces(c: Column, n: int) -> Column:
    """All pieces of n characters; none of shorter texts."""
    at = F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1)))
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(at, lambda i: c.substr(i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def containing(left: DataFrame, key: str, part: str, right: DataFrame, whole: str) -> DataFrame:
    """key, whole: the first of the names in right, by order, that contains the row's part; rows without one are left out.

    Parts and names meet by pieces of names. A part as short as a piece needs only the first name that holds it, which each piece
    knows. A longer one is looked up by its rarest piece, so that a beginning that all names share brings no names together;
    the names that hold this piece are then tested. Equal parts are looked up once."""
    parts = left.where(F.col(part) != "").select(F.col(part).alias("_part")).distinct()
    size = F.length("_part")
    which = F.when(size >= GRAMS[-1], _pieces(F.col("_part"), GRAMS[-1])).when(size > 3, _pieces(F.col("_part"), 3)).otherwise(F.array("_part"))
    asked = parts.select("_part", F.explode(which).alias("_g"))
    names = right.select(F.col(whole).alias("_whole")).distinct().select("_whole", F.explode(F.concat(*(_pieces(F.col("_whole"), n) for n in GRAMS))).alias("_g"))
    named = names.join(asked.select("_g").distinct(), "_g", "left_semi")
    held = named.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.min("_whole").alias("_first"))
    looked = asked.join(held, "_g")
    short = looked.where(size <= 3).select("_part", F.col("_first").alias("_whole"))
    rarest = looked.where(size > 3).groupBy("_part").agg(F.min(F.struct("_n", "_g")).alias("_x")).select("_part", F.col("_x._g").alias("_g"))
    long = rarest.join(named, "_g").where(F.contains("_whole", F.col("_part"))).groupBy("_part").agg(F.min("_whole").alias("_whole"))
    found = short.unionByName(long).select(F.col("_part").alias(part), F.col("_whole").alias(whole))
    return left.select(key, part).join(found, part).groupBy(key).agg(F.min(whole).alias(whole))


def markdown_of(repairs: DataFrame, markdown: DataFrame) -> DataFrame:
    """repairs(row_id, source_path, file_id, output_markdown), markdown(path) -> row_id, markdown_path: by the id in the
    file's name (after the last --), else the stated path if it exists, else the first name that holds the source's stem."""
    files = markdown.select("path", F.substring_index(stem(F.col("path")), "--", -1).alias("file_id"), name(F.col("path")).alias("name"))
    by_id = files.groupBy("file_id").agg(F.max("path").alias("_id"))
    there = files.select(F.col("path").alias("output_markdown"), F.col("path").alias("_there")).distinct()
    out = repairs.join(by_id, "file_id", "left").join(there, "output_markdown", "left").withColumn("_found", F.coalesce("_id", "_there"))
    open_ = out.where("_found IS NULL").select("row_id", stem(F.col("source_path")).alias("_stem"))
    held = containing(open_, "row_id", "_stem", files, "name").join(files.groupBy("name").agg(F.min("path").alias("_held")), "name").select("row_id", "_held")
    return out.join(held, "row_id", "left").select("row_id", F.coalesce("_found", "_held").alias("markdown_path"))


def first_existing(rows: DataFrame, candidates: list[str], inventory: DataFrame, key: str, path: str = "path") -> DataFrame:
    """key, source: the first of the candidate columns that the inventory of paths has. One join for all candidates."""
    each = rows.select(key, F.posexplode(F.array(*candidates)).alias("_n", path)).where(F.coalesce(F.col(path), F.lit("")) != "")
    found = each.join(inventory.select(path).distinct(), path, "left_semi").groupBy(key).agg(F.min(F.struct("_n", path)).alias("_x"))
    return rows.select(key).join(found, key, "left").select(key, F.col(f"_x.{path}").alias("source"))


def table_sources(markers: DataFrame, documents: DataFrame, tables: DataFrame) -> DataFrame:
    """markers(document, page, table_no) ⟕ documents(document, pages) and tables(document, page, table_no) -> status."""
    keys = ["document", "page", "table_no"]
    conf, cores = markers.sparkSession.conf, markers.sparkSession.sparkContext.defaultParallelism
    n = max(int(conf.get("spark.sql.shuffle.partitions")), 4 * cores)  # a fixed number, so that tasks aren't merged to a few large ones
    hits = tables.select(*keys).repartition(n, *keys).distinct().withColumn("_hit", F.lit(True))  # dealt first: no task holds all keys of its input
    out = markers.join(documents, "document", "left").repartition(n, *keys).join(hits, keys, "left")
    status = F.when((F.col("page") < 1) | (F.col("page") > F.coalesce("pages", F.lit(0))), "source_page_out_of_range").when(F.col("_hit").isNull(), "source_table_not_redetected").otherwise("checked")
    return out.select("document", "page", "table_no", status.alias("status"))


def page_targets(candidates: DataFrame, selected: DataFrame, manual: DataFrame) -> DataFrame:
    """candidates(file_id) with selected(file_id, page, reason, type) and manual(file_id, page): a selected page comes
    before a manual one; pages of other files are left out."""
    both = selected.select("file_id", "page", F.lit(0).alias("_rank"), "reason", "type").unionByName(manual.select("file_id", "page", F.lit(1).alias("_rank"), F.lit("manual").alias("reason"), F.lit("manual").alias("type")))
    best = both.join(candidates.select("file_id").distinct(), "file_id", "left_semi").groupBy("file_id", "page").agg(F.min(F.struct("_rank", "reason", "type")).alias("x"))
    return best.select("file_id", "page", "x.reason", "x.type")


def image_files(refs: DataFrame, inventory: DataFrame, images: str) -> DataFrame:
    """refs(ref_id, folder, target) -> ref_id, source: the target itself if it is absolute, else in the document's folder, else by its
    name in the folder of images; null if none exists."""
    at = F.when(F.startswith("target", F.lit("/")), F.col("target")).otherwise(F.concat("folder", F.lit("/"), "target"))
    rows = refs.withColumn("_at", at).withColumn("_in", F.concat(F.lit(f"{images}/"), name(F.col("target"))))
    return first_existing(rows, ["_at", "_in"], inventory, "ref_id")


def numbered(df: DataFrame, by: list[str], order: list[str], to: str = "nth") -> DataFrame:
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
