"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of documents, also of names that the operators use themselves.

In every stage a null text counts as an empty one and stays null, null ids stay null, and rows that repeat are judged
each, but for near copies, of which one row stays. Without rows a stage returns none; texts of any length are read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, near_dedup, packing, suffix_dedup, toxicity
from corpusloom.llm.common import made, release, stored, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are toxic by the ordinal model go; it is fitted on the labelled documents among docs."""
    return toxicity.not_toxic(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one row stays, with the least id; rows without an id take part, as the last."""
    return near_dedup.without_near_duplicates(docs)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur again are cut out of the texts; n_chars follows."""
    cut = suffix_dedup.cleaned(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in cut.columns else cut


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as copies or with other parameters, go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of sequences of 2048 ids."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("near_dedup", near_copies_out),
    ("suffix_array_dedup", repeats_out),
    ("decontamination", leaks_out),
    ("packing", pack),
]

#: No stage can be told in SQL; run() is tested against the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        release(spark, before, keep=1)  # the stage's own tables and its input; its output is stored
    return docs
