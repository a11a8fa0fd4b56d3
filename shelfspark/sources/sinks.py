"""Sinks for the reporting tables.

The reference appends positional ``INSERT ... SELECT`` results; re-running a load then duplicates
it. Here every output has a canonical column order (``schemas``), and a load is a run with an id:

1. the job runs once, into the hidden folder ``_staging/<run id>`` of the table;
2. the plan of the run (files to add, files that they replace) is stored under ``_runs``;
3. staged files are renamed into the table, replaced files removed, and the run marked as done.

A run that failed anywhere is repeated with the same id: without a plan it starts afresh, with a
plan it finishes the moves without running the job, and a run that is done changes nothing. Readers
skip folders that begin with ``_``. Between a run's moves a reader can see a period's new files
beside its old ones; a plain folder of files has no atomic swap.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGING, RUNS = "_staging", "_runs"


class _Folder:
    """The few file operations a load needs, on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.top = self.fs.makeQualified(self.root).toString().rstrip("/")

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.top}/{name}" if name else self.top)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def files(self, name: str) -> list[str]:
        """Data files below a folder, relative to it."""
        if not self.exists(name):
            return []
        top, found = self.fs.makeQualified(self.path(name)).toString(), []
        every = self.fs.listFiles(self.path(name), True)
        while every.hasNext():
            at = every.next().getPath().toString()[len(top) + 1:]
            if not any(part.startswith(("_", ".")) for part in at.split("/")):
                found.append(at)
        return sorted(found)

    def move(self, source: str, target: str) -> None:
        if self.exists(source):
            self.fs.mkdirs(self.path(target).getParent())
            if not self.fs.rename(self.path(source), self.path(target)):
                raise OSError(f"cannot move {source} to {target}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write(self, name: str, text: str) -> None:
        """A small file, whole or not at all."""
        part = f"{name}.part"
        out = self.fs.create(self.path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(part, name)

    def read(self, name: str) -> str:
        data = self.fs.open(self.path(name))
        try:
            return bytes(data.readAllBytes()).decode()
        finally:
            data.close()


def _load(df: DataFrame, path: str, run_id: str | None, fmt: str, partitions: list[str], replaced) -> bool:
    """Stage, plan and publish one run. ``replaced``: folders whose present files go, or None."""
    run = run_id or uuid.uuid4().hex
    folder = _Folder(df.sparkSession, path)
    plan_file, done = f"{RUNS}/{run}.json", f"{RUNS}/{run}.done"
    if folder.exists(done):
        return False
    staging = f"{STAGING}/{run}"
    if not folder.exists(plan_file):
        folder.remove(staging)
        writer = df.write.format(fmt).partitionBy(*partitions) if partitions else df.write.format(fmt)
        writer.save(folder.path(staging).toString())
        add = folder.files(staging)
        remove = [f"{f}/{x}" for f in replaced or [] for x in folder.files(f)]
        folder.write(plan_file, json.dumps({"add": add, "remove": remove}))
    publish(df.sparkSession, path, run)
    return True


def publish(spark: SparkSession, path: str, run_id: str) -> None:
    """Carry out the stored plan of a run; steps that were done before are left out."""
    folder = _Folder(spark, path)
    plan = json.loads(folder.read(f"{RUNS}/{run_id}.json"))
    staging = f"{STAGING}/{run_id}"
    for name in plan["add"]:
        folder.move(f"{staging}/{name}", name)
    for name in plan["remove"]:
        folder.remove(name)
    folder.write(f"{RUNS}/{run_id}.done", "")
    folder.remove(staging)


def append(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet", run_id: str | None = None,
           partitions: list[str] | None = None) -> bool:
    """Append ``df`` in the table's column order; a run id that is done already is not appended again.

    Returns whether this call finished the run. Without ``run_id`` every call is a run of its own.
    """
    return _load(df.select(*columns), path, run_id, fmt, partitions or [], None)


def replace_period(df: DataFrame, path: str, columns: list[str], period_col: str, periods: list,
                   fmt: str = "parquet", run_id: str | None = None) -> bool:
    """Replace whole periods of a table that is stored by period.

    ``periods`` are all values of ``period_col`` that the run covers, whether or not it has rows
    for them: a period that no longer has rows loses its old ones, so re-running a period is
    idempotent. Other periods are untouched. The job runs once; its periods are read from the
    staged folders.
    """
    wanted = [str(p) for p in periods]
    rows = df.select(*columns).filter(F.col(period_col).cast("string").isin(*wanted))
    return _load(rows, path, run_id, fmt, [period_col], [f"{period_col}={p}" for p in wanted])


def read_table(spark, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt).option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
