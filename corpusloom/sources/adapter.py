"""The seam for outside engines, such as OCR clients and converters: one call a row, with retries, a time limit and a journal.

Finished rows are written down while the job runs. Each task appends what it has finished to files of its own in the
journal's folder, a file at a time, which appear whole or not at all. So a call is lost with a task only if it was made since
the task's last file, and a new attempt of the task reads its predecessor's files first. A later run works off the rows that the journal
doesn't have, by an anti-join; what failed is tried again, if the policy says so."""

from __future__ import annotations

import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType
from pyspark.sql.window import Window

Engine = Callable[[dict[str, Any]], dict[str, Any]]
_ADDED = [("status", StringType()), ("tries", IntegerType()), ("error", StringType()), ("seconds", DoubleType()), ("partition", IntegerType()), ("run", StringType())]


@dataclass(frozen=True)
class Policy:
    """tries: of a call. step, most: seconds to wait after the first failure, as much more after each, and at most. limit: seconds
    that a call may take. pause: seconds between calls. rows: finished rows in a file of the journal."""

    # Tries, waits, and the limit of a client.
    tries: int = 3
    step: float = 2.0
    most: float = 8.0
    limit: float = 600.0
    pause: float = 0.0
    rows: int = 20
    again: bool = True


class Late(TimeoutError):
    """A call that took too long."""


def limited(engine: Engine, row: dict[str, Any], limit: float) -> dict[str, Any]:
    """engine(row), or Late after so many seconds; the call itself can't be stopped and is left to end by itself."""
    out: queue.SimpleQueue = queue.SimpleQueue()

    def call() -> None:
        try:
            out.put((engine(row), None))
        except Exception as e:  # noqa: BLE001  whatever an engine raises is the row's failure
            out.put((None, e))

    threading.Thread(target=call, daemon=True).start()
    try:
        found, error = out.get(timeout=limit)
    except queue.Empty:
        raise Late(f"no answer within {limit:g} seconds") from None
    if error is not None:
        raise error
    return found


def called(engine: Engine, row: dict[str, Any], policy: Policy, sleep: Callable[[float], None] = time.sleep) -> tuple[dict[str, Any] | None, int, str | None]:
    """The result, the tries that it took, and the last error if all failed."""
    error = None
    for n in range(1, max(1, policy.tries) + 1):
        try:
            return limited(engine, row, policy.limit), n, None
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {e}"
            if n < policy.tries:
                sleep(min(policy.step * n, policy.most))
    return None, policy.tries, error


class Journal:
    """Files of finished rows in a folder that all executors reach by Arrow's file systems."""

    def __init__(self, path: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(path)
        self.files.create_dir(self.root, recursive=True)

    def append(self, table: pa.Table, run: str, partition: int) -> None:
        name = f"{run}-{partition:06d}-{uuid.uuid4().hex}.parquet"
        with self.files.open_output_stream(f"{self.root}/_{name}") as out:  # names with a _ aren't read
            pq.write_table(table, out)
        self.files.move(f"{self.root}/_{name}", f"{self.root}/{name}")

    def finished(self, run: str, partition: int, keys: list[str]) -> set[tuple]:
        """Keys that earlier attempts of a task have finished, successfully or not."""
        some = [x.path for x in self.files.get_file_info(fs.FileSelector(self.root)) if x.base_name.startswith(f"{run}-{partition:06d}-")]
        return {tuple(r.values()) for path in some for r in pq.read_table(self.files.open_input_file(path), columns=keys).select(keys).to_pylist()}


def _schema(todo: DataFrame, keys: list[str], result: StructType) -> StructType:
    return StructType([*(StructField(k, todo.schema[k].dataType) for k in keys), *result.fields, *(StructField(n, t) for n, t in _ADDED)])


def journal(spark: SparkSession, path: str, keys: list[str], schema: StructType) -> DataFrame:
    """The last row of each key, one that succeeded before any that failed; no rows where nothing is written yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at) or not len(files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "[!_]*.parquet"))):
        return spark.createDataFrame([], schema)
    best = Window.partitionBy(*keys).orderBy(F.col("status") != "ok", F.desc("run"))
    rows = spark.read.schema(schema).parquet(path)
    return rows.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth")


def worked_off(todo: DataFrame, keys: list[str], engine: Callable[[], Engine], result: str | StructType, path: str, policy: Policy = Policy()) -> DataFrame:
    """Calls the engine for each row of todo whose keys the journal at path doesn't have, and returns the journal's rows of todo's keys.

    engine: makes, once in each task, a function of a row (a dict) that returns a dict of result's columns. Returned are keys,
    result's columns (null where the call failed), status (ok or failed), tries, error, seconds, partition and run. Rows
    with equal keys are one, the first by the other columns' hash; rows with a null key are left out. Without rows nothing is called. todo is
    read twice by tasks that run again, so it should be a stored table."""
    spark = todo.sparkSession
    result = StructType.fromDDL(result) if isinstance(result, str) else result
    schema, run = _schema(todo, keys, result), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    known = journal(spark, path, keys, schema)
    finished = (known.where("status = 'ok'") if policy.again else known).select(*keys)
    named = todo.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    once = named.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*todo.columns)))).where("_nth = 1").drop("_nth")
    arrow, names = to_arrow_schema(schema), schema.names

    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        own, call = Journal(path), None
        before = own.finished(run, partition, keys)
        held: list[dict[str, Any]] = []

        def write() -> None:
            if held:
                own.append(pa.Table.from_pylist(held, schema=arrow), run, partition)
                held.clear()

        n = 0
        try:
            for given in batches:
                for row in given.to_pylist():
                    if tuple(row[k] for k in keys) in before:
                        continue
                    call = call or engine()
                    if n and policy.pause:
                        time.sleep(policy.pause)
                    start = time.monotonic()
                    found, tries, error = called(call, row, policy)
                    added = {"status": "failed" if found is None else "ok", "tries": tries, "error": error, "seconds": time.monotonic() - start, "partition": partition, "run": run}
                    held.append(dict.fromkeys(names) | {k: row[k] for k in keys} | {f.name: (found or {}).get(f.name) for f in result.fields} | added)
                    n += 1
                    if len(held) >= policy.rows:
                        write()
        finally:
            write()
        yield pa.RecordBatch.from_pydict({"calls": pa.array([n], pa.int64())})

    once.join(finished, keys, "left_anti").mapInArrow(run_task, "calls long").write.format("noop").mode("overwrite").save()
    return journal(spark, path, keys, schema).join(named.select(*keys).distinct(), keys, "left_semi")
