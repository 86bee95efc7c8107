"""Listings read with a record of what could not be read.

``read_listings`` leaves it to Spark to pass over broken files, and Spark only logs them.
Here a reader of the Python Data Source API takes a file per task and streams its rows in
batches; a file that breaks keeps the rows before the break and adds one row that names
the cause. Memory is that of one batch, whatever the size of the file.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from threadloom.session import materialize

logger = logging.getLogger(__name__)

FORMAT = "reported_listings"
# Columns behind those of a listing's rows.
ADDED = "listing string, listing_rank int, file_name string, error string"
FAILURES = ("listing", "listing_rank", "file_name", "error")
BATCH_ROWS = 10_000


@dataclass
class ListingFile(InputPartition):
    """One file of one listing: the listing's address and the file's name in that store."""

    listing: str
    rank: int
    root: str
    name: str


def _store(path: str) -> tuple[FileSystem, str]:
    """The store of an address, or of a plain local path, and the name in it."""
    return FileSystem.from_uri(path) if ":/" in path else (LocalFileSystem(), path)


class ListingReader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[tuple[str, str]]) -> None:
        self.schema, self.paths = schema, paths

    def partitions(self) -> list[ListingFile]:
        """All files of all listings; a listing whose path is not there has none."""
        found = []
        for rank, (listing, path) in enumerate(self.paths):
            store, folder = _store(path)
            there = store.get_file_info(folder).type
            if there == FileType.NotFound:
                logger.warning("listing %s is not there, skipping: %s", listing, path)
                continue
            names = [folder]
            if there == FileType.Directory:
                inside = store.get_file_info(FileSelector(folder, recursive=True))
                names = [i.path for i in inside if i.type == FileType.File and not _hidden(i.path[len(folder) :])]
            found += [ListingFile(listing, rank, path, name) for name in sorted(names)]
        return found

    def read(self, partition: ListingFile | None) -> Iterator[pa.RecordBatch]:
        # Spark asks once without a partition where there are none.
        if partition is None:
            return
        target = to_arrow_schema(self.schema)
        own = target.names[: len(target) - len(FAILURES)]
        place = {"listing": partition.listing, "listing_rank": partition.rank, "file_name": partition.name}
        try:
            with _store(partition.root)[0].open_input_file(partition.name) as file:
                table = pq.ParquetFile(file)
                held = [column for column in own if column in table.schema_arrow.names]
                for batch in table.iter_batches(BATCH_ROWS, columns=held):
                    yield self._conform(batch, target, place)
        # Whatever a broken file raises is the cause that is reported.
        except Exception as error:  # noqa: BLE001
            row = {**place, "error": f"{type(error).__name__}: {error}"}
            yield pa.RecordBatch.from_pylist([row], schema=target)

    def _conform(self, batch: pa.RecordBatch, target: pa.Schema, place: dict[str, object]) -> pa.RecordBatch:
        columns = []
        for field in target:
            if field.name in place:
                columns.append(pa.repeat(pa.scalar(place[field.name], field.type), batch.num_rows))
            elif field.name != "error" and field.name in batch.schema.names:
                columns.append(batch.column(field.name).cast(field.type))
            else:
                columns.append(pa.nulls(batch.num_rows, field.type))
        return pa.RecordBatch.from_arrays(columns, schema=target)


def _hidden(path: str) -> bool:
    return any(part[:1] in ("_", ".") for part in path.split("/") if part)


class ListingSource(DataSource):
    """Options: ``paths``, a JSON list of (label, path); the schema is given by the caller."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> ListingReader:
        return ListingReader(schema, [tuple(pair) for pair in json.loads(self.options["paths"])])


def read_reported(spark: SparkSession, paths: Mapping[str, str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, failures) of listings kept as Parquet files, in the given order.

    ``rows`` are those of ``read_listings``: the columns of ``schema``, ``listing`` and
    ``listing_rank``. ``failures`` has a row (listing, listing_rank, file_name, error) per file that
    broke, was no Parquet file, or held a column that does not fit ``schema``. A column that
    a file lacks is null; only a missing path skips a listing. Files are read once, into
    the checkpoint folder. The store has to be one that Arrow opens, on every executor.
    """
    spark.dataSource.register(ListingSource)
    listed = json.dumps(list(paths.items()))
    read = spark.read.format(FORMAT).schema(f"{schema}, {ADDED}").option("paths", listed).load()
    read = materialize(read)
    rows = read.filter("error is null").drop("file_name", "error")
    return rows, read.filter(F.col("error").isNotNull()).select(*FAILURES)
