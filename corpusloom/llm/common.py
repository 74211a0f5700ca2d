"""Helpers shared by the training-data operators: tables, the shared work folder, lineage cuts, Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; where it is unset (tests, local mode), one of our own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


#: Paths in the shared folder that aren't deleted yet, in the order in which they were made.
_made: list[str] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; it is deleted by release() or when the driver ends."""
    path = f"{shared_dir(spark)}/corpusloom-{tag}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(release, spark)
    _made.append(path)
    return path


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Deletes the tables stored since so many were, but for the last few: for when what was made of them is stored itself."""
    gone = _made[since : len(_made) - keep]
    for path in gone:
        _delete(spark, path)
    _made[since : len(_made) - keep] = []


def made() -> int:
    return len(_made)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the session may be gone; the folder is then left to the cluster's clean-up
        pass


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df as a written table in the shared folder: lineage ends here, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, f, schema) -> DataFrame:
    """df.mapInArrow(f, schema), with batches of bounded size, whatever the length of texts.

    Python workers are used again by later stages; at its end a task gives its memory back to the system."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 4000), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        if not 0 < _number(conf.get(key)) <= most:
            conf.set(key, str(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def _number(value: str) -> int:
    value = value.removesuffix("b")
    return int(value) if value.isdigit() else 0


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def pieces(texts: list, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about limit characters; a longer text stands alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t or "") + 64
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)




def rows_where(docs: DataFrame, decide) -> DataFrame:
    """The rows of docs that decide() keeps, all columns as they are. decide() gives a worker a function of a list of texts."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = decide()
        for given in batches:
            texts = given.column(at).to_pylist()
            yield given.filter(pa.array([x for a, b in pieces(texts) for x in keep(texts[a:b])], pa.bool_()))

    return mapped(docs, run, docs.schema)
