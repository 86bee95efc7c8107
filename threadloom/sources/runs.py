"""Runs of a store, each put in place by one rename.

A run writes all its tables into folders of its own attempt, which nobody reads. Its
manifest, a small JSON file that names the run, its attempt and its tables, is then
renamed to the run's number, if no file has that name yet. Until then nothing of the run
is there, after it everything is; an attempt cut short leaves folders that no manifest
names. Ledgers are views over the tables that manifests name.

Two runs that work side by side want the same number. One gets it; the other finds out at
its rename and has to start again from what is there now.

Ledgers are kept short by carrying: the n-th table of a ledger also holds the rows of the
``FAN ** k - 1`` tables before it, where ``FAN ** k`` is the largest power that divides n.
A reader skips what a later table holds too, so after n runs it opens at most
``FAN - 1`` tables per digit of n, and a row is copied about log n times in all. Tables
that are skipped stay, as a reader may still be in them.

The rename is atomic on HDFS and on local disks. A store that has no such rename needs a
committer of its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from threadloom.sources.files import hadoop_path, path_exists

MANIFESTS = "manifests"
MANIFEST = "number long, source string, attempt string, tables array<string>, values map<string,string>"
TRIES = 5
FAN = 8

Result = TypeVar("Result")


class RunTaken(RuntimeError):
    """Another run has been committed under the number of this one."""


@dataclass(frozen=True)
class Run:
    """What a manifest says of a committed run."""

    number: int
    source: str
    attempt: str
    tables: tuple[str, ...] = ()
    values: dict[str, str] = field(default_factory=dict)

    def folder(self, root: str, table: str) -> str:
        return f"{root}/{table}/run_no={self.number}/attempt={self.attempt}"

    def first(self, table: str) -> int:
        """The first run whose rows this run's table holds."""
        return int(self.values.get(f"{table}_from", self.number))


def committed(spark: SparkSession, root: str) -> list[Run]:
    """All runs of a store in order: one small record each."""
    folder = f"{root}/{MANIFESTS}"
    if not path_exists(spark, folder):
        return []
    rows = spark.read.schema(MANIFEST).json(folder).collect()
    runs = [Run(r["number"], r["source"], r["attempt"], tuple(r["tables"]), dict(r["values"])) for r in rows]
    return sorted(runs, key=lambda run: run.number)


def run_of(spark: SparkSession, root: str, source: str) -> Run | None:
    """The run that was committed for ``source``, if there is one."""
    return next((run for run in committed(spark, root) if run.source == source), None)


def live(runs: list[Run], table: str) -> list[Run]:
    """The runs whose folders of a table together hold all rows of it, each once."""
    found: list[Run] = []
    for run in reversed(runs):
        if table in run.tables and (not found or run.number < found[-1].first(table)):
            found.append(run)
    return found[::-1]


def folders(spark: SparkSession, root: str, table: str, numbers: set[int] | None = None) -> list[str]:
    """Folders of a table over all runs, or over the runs of the given numbers."""
    runs = live(committed(spark, root), table)
    return [run.folder(root, table) for run in runs if numbers is None or run.number in numbers]


def read_table(
    spark: SparkSession, root: str, table: str, schema: str | None = None, numbers: set[int] | None = None
) -> DataFrame:
    """A table over all runs, or some; without any run it is empty, and then needs a ``schema``."""
    paths = folders(spark, root, table, numbers)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


class Attempt:
    """One try at the next run of a store."""

    def __init__(self, spark: SparkSession, root: str, source: str = "") -> None:
        self.spark, self.root = spark, root
        self.before = committed(spark, root)
        number = self.before[-1].number + 1 if self.before else 1
        name = uuid.uuid4().hex
        self.run = Run(number, source or name, name)

    def write(self, table: str, save: Callable[[str], None]) -> None:
        """Have ``save`` write a table of this run into the folder it is given."""
        save(self.run.folder(self.root, table))
        self.run = Run(**{**asdict(self.run), "tables": (*self.run.tables, table)})

    def add(self, table: str, rows: DataFrame) -> None:
        """Write ``rows`` as a Parquet table of this run."""
        self.write(table, rows.write.parquet)

    def carried(self, table: str) -> list[Run]:
        """The runs whose rows this run's table of a ledger has to hold too."""
        holders = [run for run in self.before if table in run.tables]
        count, step = len(holders) + 1, 1
        while count % (step * FAN) == 0:
            step *= FAN
        return live(holders[count - step :], table)

    def add_ledger(self, table: str, rows: DataFrame) -> None:
        """Write ``rows``, and what the run carries, as a ledger's table of this run."""
        older = self.carried(table)
        if older:
            reader = self.spark.read.schema(rows.schema)
            rows = rows.unionByName(reader.parquet(*(run.folder(self.root, table) for run in older)))
            self.note(**{f"{table}_from": older[0].first(table)})
        self.add(table, rows.hint("rebalance"))

    def note(self, **values: object) -> None:
        """Values for the manifest."""
        known = {name: str(value) for name, value in values.items()}
        self.run = Run(**{**asdict(self.run), "values": {**self.run.values, **known}})

    def commit(self, **values: object) -> Run:
        """Put the manifest in place; all tables of the run are there from here on."""
        self.note(**values)
        final = f"{self.root}/{MANIFESTS}/{self.run.number:010d}.json"
        _put_if_absent(self.spark, json.dumps(asdict(self.run)), final)
        return self.run


def _put_if_absent(spark: SparkSession, text: str, path: str) -> None:
    """Write ``text`` to a hidden file beside ``path`` and rename it, unless ``path`` is there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = hadoop_path(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = hidden.getFileSystem(conf).create(hidden, False)
    stream.write((text + "\n").encode())
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(hidden, target, options)
    except Py4JJavaError as error:
        hidden.getFileSystem(conf).delete(hidden, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise RunTaken(path) from error
        raise


def until_committed(work: Callable[[], Result]) -> Result:
    """Do ``work`` again from its start as long as another run takes its number."""
    for _ in range(TRIES - 1):
        try:
            return work()
        except RunTaken:
            continue
    return work()
