"""Calls of outside engines: retries, waits, limits, the journal, restarts and lost tasks, with engines that fail on schedule."""

import time

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import adapter

FAST = adapter.Policy(step=0.0, most=0.0, limit=20.0, rows=2)


def test_tries_and_waits():
    calls, waits = [], []

    def engine(row):
        calls.append(row["k"])
        if len(calls) < row["good"]:
            raise KeyError("not yet")
        return {"v": len(calls)}

    assert adapter.called(engine, {"k": 1, "good": 3}, adapter.Policy(), waits.append) == ({"v": 3}, 3, None) and waits == [2.0, 4.0]
    calls.clear(), waits.clear()
    found, tries, error = adapter.called(engine, {"k": 1, "good": 99}, adapter.Policy(tries=6), waits.append)
    assert (found, tries, error) == (None, 6, "KeyError: 'not yet'") and waits == [2.0, 4.0, 6.0, 8.0, 8.0]


def test_a_call_that_takes_too_long():
    start = time.monotonic()
    found, tries, error = adapter.called(lambda row: time.sleep(30), {}, adapter.Policy(tries=2, step=0.0, limit=0.2))
    assert (found, tries) == (None, 2) and error.startswith("Late") and time.monotonic() - start < 5


def engine_at(log, bad=(), down=lambda k: False):
    """An engine that writes down each call, fails once for each of bad, and always where it is down."""

    def make():
        failed = set()

        def call(row):
            with open(f"{log}/{row['k']}", "a") as f:
                f.write("x")
            if down(row["k"]) or row["k"] in bad and row["k"] not in failed:
                failed.add(row["k"])
                raise RuntimeError(f"page {row['k']}")
            return {"text": f"<{row['note']}>", "n": row["k"] * 2}

        return call

    return make


def calls(log):
    return {int(p.name): len(p.read_text()) for p in log.iterdir()}


def test_a_second_run_calls_nothing_twice(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rows = [(k, f"n{k}") for k in range(30)] + [(3, "n3"), (None, "x")]
    todo = spark.createDataFrame(rows, "k long, note string").withColumn("status", F.lit("clash")).repartition(4)
    path = f"file://{tmp_path}/journal"
    first = adapter.worked_off(todo, ["k"], engine_at(log, bad={4, 5}, down=lambda k: k % 10 == 7), "text string, n long", path, FAST)
    got = {r.k: r for r in first.collect()}
    assert sorted(got) == list(range(30))
    assert (got[1].text, got[1].n, got[1].status, got[1].tries, got[1].error) == ("<n1>", 2, "ok", 1, None)
    assert (got[4].status, got[4].tries) == ("ok", 2) and (got[7].status, got[7].tries, got[7].text, got[7].error) == ("failed", 3, None, "RuntimeError: page 7")
    made = calls(log)
    assert made == {k: 2 if k in (4, 5) else 3 if k % 10 == 7 else 1 for k in range(30)}

    again = adapter.worked_off(todo, ["k"], engine_at(log), "text string, n long", path, FAST)
    assert all(r.status == "ok" for r in again.collect()) and again.count() == 30
    assert calls(log) == {k: n + (k % 10 == 7) for k, n in made.items()}
    adapter.worked_off(todo, ["k"], engine_at(log), "text string, n long", path, FAST)
    assert sum(calls(log).values()) == sum(made.values()) + 3


def test_failures_can_be_left(spark, tmp_path):
    (tmp_path / "log").mkdir()
    todo, path = spark.createDataFrame([(7, "a"), (8, "b")], "k long, note string"), f"file://{tmp_path}/journal"
    keep = adapter.Policy(tries=1, step=0.0, again=False)
    for _ in range(2):
        got = adapter.worked_off(todo, ["k"], engine_at(tmp_path / "log", down=lambda k: k == 7), "text string, n long", path, keep)
        assert {r.k: r.status for r in got.collect()} == {7: "failed", 8: "ok"}
    assert calls(tmp_path / "log") == {7: 1, 8: 1}


def test_a_job_that_dies_keeps_what_it_finished(spark, tmp_path):
    """The engine kills its worker at one row, as the loss of an executor would; what is in files by then isn't called again."""
    (tmp_path / "log").mkdir()
    todo, path = spark.createDataFrame([(k, "a") for k in range(40)], "k long, note string").coalesce(1), f"file://{tmp_path}/journal"
    make = engine_at(tmp_path / "log")

    def dying():
        import os

        call, n = make(), []

        def one(row):
            n.append(row["k"])
            return os._exit(1) if len(n) == 8 else call(row)

        return one

    with pytest.raises(Exception, match="Python worker"):
        adapter.worked_off(todo, ["k"], dying, "text string, n long", path, FAST)
    kept = [r.k for r in spark.read.parquet(path).collect()]
    made = calls(tmp_path / "log")
    assert len(kept) >= 6 and set(kept) <= set(made) and set(made.values()) == {1}
    got = adapter.worked_off(todo, ["k"], make, "text string, n long", path, FAST)
    assert got.where("status = 'ok'").count() == 40
    after = calls(tmp_path / "log")
    assert all(after[k] == 1 for k in kept) and sum(after.values()) <= 41


def test_an_attempt_reads_its_predecessors_files(tmp_path):
    own = adapter.Journal(f"file://{tmp_path}/j")
    own.append(adapter.pa.table({"k": [1, 2], "v": ["a", "b"]}), "run", 3)
    own.append(adapter.pa.table({"k": [5], "v": ["c"]}), "run", 3)
    own.append(adapter.pa.table({"k": [9], "v": ["d"]}), "run", 4)
    assert own.finished("run", 3, ["k"]) == {(1,), (2,), (5,)} and own.finished("other", 3, ["k"]) == set()


def test_nothing_to_do(spark, tmp_path):
    todo = spark.createDataFrame([], "k long, note string")
    assert adapter.worked_off(todo, ["k"], engine_at(tmp_path), "text string, n long", f"file://{tmp_path}/j", FAST).collect() == []
