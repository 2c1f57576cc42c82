"""Event logs as a data source: ``spark.read`` and ``spark.readStream`` with format ``event_logs`` over a catalog of log files."""

from __future__ import annotations

import csv
import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.functions.times import NO_BOUNDS, Bounds, parse_iso
from tidemark.sources.logs import first_line, opened, text_schema
from tidemark.sources.tables import MARK

FORMAT = "event_logs"
#: Instants, in microseconds, before and after all others.
FIRST, LAST = -(2**63), 2**63 - 1
_KEYS = ["event_type", "interval", "log_date"]


def _micros(value: str) -> int:
    at = parse_iso(value)
    return int(at.replace(microsecond=0).timestamp()) * 1_000_000 + at.microsecond


def _instants(dates: pa.ChunkedArray) -> pa.Array:
    """Dates of a catalog as microseconds; dates, and timestamps without a zone, are in UTC."""
    dates = dates.combine_chunks()
    if pa.types.is_string(dates.type) or pa.types.is_large_string(dates.type):
        coded = dates.dictionary_encode()
        return pa.array([_micros(v) for v in coded.dictionary.to_pylist()], pa.int64()).take(coded.indices)
    return dates.cast(pa.timestamp("us", getattr(dates.type, "tz", None))).cast(pa.int64())


@dataclass
class Files(InputPartition):
    """The files of one row group of the catalog, inside a window, whose paths' hash is ``which`` of ``of``."""

    part: str
    group: int
    after: int
    until: int
    which: int
    of: int


class Catalog:
    """A Parquet table ``event_type, interval, log_date, path, field_names`` that only grows, asked for one type and interval."""

    def __init__(self, options):
        missing = [o for o in ("catalog", "eventType", "interval", "fields") if not options.get(o)]
        if missing:
            raise ValueError(f"the source {FORMAT} needs the options {', '.join(missing)}")
        self.path, self.kind = options["catalog"], (options["eventType"], options["interval"])
        self.fields: list[str] = json.loads(options["fields"])
        self.per_task, self.block = int(options.get("filesPerTask", 64)), int(options.get("blockBytes", 1 << 24))
        start, mark, end = (options.get(o) for o in ("start", "mark", "end"))
        self.after = _micros(start) - 1 if start else _micros(mark) if mark else FIRST
        self.until = _micros(end) if end else LAST

    def parts(self) -> list[str]:
        store, name = opened(self.path)
        found = store.get_file_info(fs.FileSelector(name, recursive=True))
        return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")

    def _file(self, part: str) -> pq.ParquetFile:
        return pq.ParquetFile(opened(self.path)[0].open_input_file(part), coerce_int96_timestamp_unit="us")

    def rows(self, file: pq.ParquetFile, group: int, after: int, until: int, columns: Sequence[str] = ()) -> pa.Table:
        """Rows of a row group inside the window, with their instants as ``micros``."""
        found = file.read_row_group(group, [*_KEYS, *columns])
        found = found.append_column("micros", _instants(found.column("log_date")))
        kind, interval = self.kind
        return found.filter((pc.field("event_type") == kind) & (pc.field("interval") == interval) & (pc.field("micros") > after) & (pc.field("micros") <= until))

    def groups(self, after: int, until: int) -> Iterator[tuple[str, int, int, int]]:
        """``part, row group, number of files, newest instant`` of row groups with files inside the window; one is held at a time."""
        for part in self.parts():
            file = self._file(part)
            for group in range(file.num_row_groups):
                found = self.rows(file, group, after, until)
                if found.num_rows:
                    yield part, group, found.num_rows, pc.max(found.column("micros")).as_py()

    def tasks(self, after: int, until: int) -> list[Files]:
        out = []
        for part, group, n, _ in self.groups(after, until):
            of = -(-n // self.per_task)
            out += [Files(part, group, after, until, which, of) for which in range(of)]
        return out

    def read(self, task: Files) -> Iterator[pa.RecordBatch]:
        """Rows of a task's files; of a file that its row group lists more than once, the newest date counts."""
        newest: dict[str, tuple[int, list[str]]] = {}
        for row in self.rows(self._file(task.part), task.group, task.after, task.until, ["path", "field_names"]).to_pylist():
            if zlib.crc32(row["path"].encode()) % task.of == task.which and (row["path"] not in newest or row["micros"] > newest[row["path"]][0]):
                newest[row["path"]] = row["micros"], row["field_names"]
        for path, (micros, names) in newest.items():
            yield from self._log(path, micros, names)

    def _log(self, path: str, micros: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        store, name = opened(path)
        parse = pacsv.ParseOptions(newlines_in_values=True)
        asked = [f for f in self.fields if f in names]
        convert = pacsv.ConvertOptions(
            column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=True, quoted_strings_can_be_null=True, null_values=[""], include_columns=asked or names[:1]
        )
        with store.open_input_stream(name) as stream:
            line = first_line(stream)
        if line is None:
            return
        header = next(csv.reader([line.lstrip("\ufeff")]))
        if header != names:
            raise ValueError(f"{path} has the header {header}, its catalog {names}")
        with store.open_input_stream(name) as stream:
            for batch in pacsv.open_csv(stream, pacsv.ReadOptions(block_size=self.block), parse, convert):
                none, date = pa.nulls(batch.num_rows, pa.string()), pa.array([micros], pa.int64()).cast(pa.timestamp("us", "UTC"))
                columns = [batch.column(f) if f in asked else none for f in self.fields]
                yield pa.RecordBatch.from_arrays([*columns, date.take(pa.array([0] * batch.num_rows, pa.int32()))], [*self.fields, MARK])


class _Reader(DataSourceReader):
    def __init__(self, catalog: Catalog):
        self.catalog = catalog

    def partitions(self) -> Sequence[InputPartition]:
        # Spark reads without partitions by one call with None
        return self.catalog.tasks(self.catalog.after, self.catalog.until) or [Files("", 0, FIRST, FIRST, 0, 0)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.catalog.read(partition) if partition.of else iter(())


class _StreamReader(DataSourceStreamReader):
    """An offset is a mark: files up to its instant are read, later ones are to come."""

    def __init__(self, catalog: Catalog):
        self.catalog, self.newest = catalog, catalog.after

    def initialOffset(self) -> dict:
        return {"micros": self.catalog.after}

    def latestOffset(self) -> dict:
        for *_, newest in self.catalog.groups(self.newest, self.catalog.until):
            self.newest = max(self.newest, newest)
        return {"micros": self.newest}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.catalog.tasks(start["micros"], end["micros"])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return self.catalog.read(partition)


class EventLogs(DataSource):
    """Log files that a catalog lists, with the date of each one's file as ``MARK``; see :func:`log_frame` and :func:`log_stream`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return T.StructType([*text_schema(Catalog(self.options).fields).fields, T.StructField(MARK, T.TimestampType())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(Catalog(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(Catalog(self.options))


def _options(catalog: str, event_type: str, interval: str, fields: Sequence[str], bounds: Bounds, mark: str | None, files_per_task: int) -> dict[str, str]:
    found = {"catalog": catalog, "eventType": event_type, "interval": interval, "fields": json.dumps(list(fields)), "filesPerTask": str(files_per_task)}
    return found | {k: v for k, v in (("start", bounds.start), ("end", bounds.end), ("mark", mark)) if v is not None}


def log_frame(
    spark: SparkSession, catalog: str, event_type: str, interval: str, fields: Sequence[str], bounds: Bounds = NO_BOUNDS, mark: str | None = None, files_per_task: int = 64
) -> DataFrame:
    """``fields`` of the log files that the Parquet folder ``catalog`` lists in the window, as text, and the date of each one's file as ``MARK``.

    Tasks are groups of some ``files_per_task`` files, and they read the catalog for the paths: the driver sees dates and counts of one row
    group of the catalog at a time, so neither the list of files nor anything as large is held or sent. Columns are matched by name, missing
    ones are null. A header other than the catalog's, a row of another width, text that is not UTF-8 and a row of more than ``blockBytes``
    fail the job. An empty cell is null, quoted or not, as in scans by Spark; a file without lines has no rows. A file that a row group lists twice
    is read once, with the newest date; listings in different row groups are different files. Rows of the catalog without a date, type or
    interval are in no window. Folders are local or in object stores.
    """
    spark.dataSource.register(EventLogs)
    return spark.read.format(FORMAT).options(**_options(catalog, event_type, interval, fields, bounds, mark, files_per_task)).load()


def log_stream(
    spark: SparkSession, catalog: str, event_type: str, interval: str, fields: Sequence[str], bounds: Bounds = NO_BOUNDS, mark: str | None = None, files_per_task: int = 64
) -> DataFrame:
    """:func:`log_frame` as a stream whose offsets are marks: each batch reads the files dated after the last one's newest.

    As with marks of runs, a file that is listed later with an earlier date, or with the mark's own, is not read.
    """
    spark.dataSource.register(EventLogs)
    return spark.readStream.format(FORMAT).options(**_options(catalog, event_type, interval, fields, bounds, mark, files_per_task)).load()
