"""Loads that fail between their steps and are repeated; the job of a load runs once."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfspark.sources import sinks


def folder():
    return tempfile.mkdtemp(prefix="load-", dir=os.environ.get("TMPDIR", "/tmp"))


def values(spark, path):
    return sorted(r["n"] for r in spark.read.parquet(path).collect())


def numbers(spark, *rows):
    return spark.createDataFrame([*rows], "n int, day string")


def broken(*args, **kwargs):
    raise OSError("lost")


STEPS = ["write", "move", "remove", "write_done"]


def fail_at(monkeypatch, step):
    """Break a file operation of the loads: the plan, a move, a removal, or the last mark."""
    if step == "write_done":
        whole = sinks._Folder.write
        monkeypatch.setattr(sinks._Folder, "write", lambda self, name, text: broken() if name.endswith(".done") else whole(self, name, text))
    elif step == "remove":
        whole = sinks._Folder.remove
        monkeypatch.setattr(sinks._Folder, "remove", lambda self, name: whole(self, name) if name.startswith("_") else broken())
    elif step == "move":
        whole, moved = sinks._Folder.move, []

        def second(self, source, target):
            if source.startswith("_staging") and (moved or broken_first):
                broken()
            moved.append(source) if source.startswith("_staging") else None
            whole(self, source, target)

        broken_first = False
        monkeypatch.setattr(sinks._Folder, "move", second)
    else:
        monkeypatch.setattr(sinks._Folder, step, broken)


@pytest.mark.parametrize("step", STEPS)
def test_a_failed_replacement_is_finished_by_its_repetition(spark, monkeypatch, step):
    path = folder()
    days = ["a", "b", "c"]
    sinks.replace_period(numbers(spark, (1, "a"), (2, "b"), (3, "c"), (9, "z")), path, ["n", "day"], "day", [*days, "z"], run_id="one")
    new = numbers(spark, (10, "a"), (20, "b"))
    with monkeypatch.context() as m:
        fail_at(m, step)
        with pytest.raises(OSError):
            sinks.replace_period(new, path, ["n", "day"], "day", days, run_id="two")
    assert sinks.replace_period(new, path, ["n", "day"], "day", days, run_id="two")
    assert values(spark, path) == [9, 10, 20]
    assert not sinks.replace_period(new, path, ["n", "day"], "day", days, run_id="two")
    assert values(spark, path) == [9, 10, 20]


@pytest.mark.parametrize("step", ["write", "move", "write_done"])
def test_a_repeated_append_adds_its_rows_once(spark, monkeypatch, step):
    path = folder()
    rows = numbers(spark, *[(i, "a") for i in range(20)]).repartition(4)
    sinks.append(numbers(spark, (100, "a")), path, ["n", "day"])
    with monkeypatch.context() as m:
        fail_at(m, step)
        with pytest.raises(OSError):
            sinks.append(rows, path, ["n", "day"], run_id="load")
    assert sinks.append(rows, path, ["n", "day"], run_id="load")
    assert not sinks.append(rows, path, ["n", "day"], run_id="load")
    assert values(spark, path) == [*range(20), 100]
    sinks.append(numbers(spark, (101, "a")), path, ["n", "day"], run_id="other")
    assert values(spark, path) == [*range(20), 100, 101]


def test_the_job_of_a_load_runs_once(spark):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    rows = numbers(spark, *[(i, "ab"[i % 2]) for i in range(50)]).mapInArrow(count, "n int, day string")
    path = folder()
    sinks.replace_period(rows, path, ["n", "day"], "day", ["a", "b", "c"])
    assert passed.value == 50
    sinks.append(rows, path, ["n", "day"], partitions=["day"])
    assert passed.value == 100 and len(values(spark, path)) == 100


def test_a_period_that_lost_its_rows_and_an_empty_load(spark):
    path = folder()
    sinks.replace_period(numbers(spark, (1, "a"), (2, "b")), path, ["n", "day"], "day", ["a", "b"])
    sinks.replace_period(numbers(spark).filter(F.lit(False)), path, ["n", "day"], "day", ["a"])
    assert values(spark, path) == [2]
