"""Event logs and CSV drops: text columns, one header for each file."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import NO_BOUNDS, Bounds, as_instant, lower_bound, upper_bound
from tidemark.sources.tables import MARK


def text_schema(names: Sequence[str]) -> T.StructType:
    """All columns as text: nothing is inferred from log or CSV files."""
    if not names or any(not n for n in names):
        raise ValueError("a header needs at least one column and no empty names")
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(spark: SparkSession, path: str | list[str], names: Sequence[str], strict: bool = False, nulls: bool = False) -> DataFrame:
    """Whole CSV files as text columns; headers and empty lines are dropped, cells may hold newlines. ``strict`` checks each header.

    An empty cell is null, quoted or not; with ``nulls`` a quoted one is empty text."""
    reader = spark.read.schema(text_schema(names)).option("header", True).option("multiLine", True).option("escape", '"')
    reader = reader.option("charToEscapeQuoteEscaping", '"')  # unset it is NUL, and the parser drops NULs from cells with quotes
    if nulls:
        reader = reader.option("nullValue", uuid.uuid4().hex)  # a text that is null too, so one that no cell can be made to hold
    return reader.option("enforceSchema", not strict).csv(path)


def select_logs(catalog: DataFrame, event_type: str, interval: str, bounds: Bounds = NO_BOUNDS, mark: str | None = None) -> DataFrame:
    """Rows of a log catalog, or of a partitioned log table, of one type and interval inside the window."""
    kind = catalog.schema["log_date"].dataType
    rows = catalog.where((F.col("event_type") == event_type) & (F.col("interval") == interval))
    for condition in (lower_bound(F.col("log_date"), kind, bounds, mark), upper_bound(F.col("log_date"), kind, bounds)):
        if condition is not None:
            rows = rows.where(condition)
    return rows


def scan_log_table(logs: DataFrame, event_type: str, interval: str, fields: Sequence[str], bounds: Bounds = NO_BOUNDS, mark: str | None = None) -> DataFrame:
    """Rows of a log table partitioned by ``event_type, interval, log_date``; only the partitions in the window are read."""
    return select_logs(logs, event_type, interval, bounds, mark).select(*fields, F.col("log_date").alias(MARK))


def listed_logs(catalog: DataFrame, event_type: str, interval: str, bounds: Bounds = NO_BOUNDS, mark: str | None = None) -> list[Row]:
    """``path, field_names, log_date, micros`` (of the date) of the files that a catalog lists inside the window: all that reaches the driver of a log."""
    micros = F.unix_micros(as_instant(F.col("log_date"), catalog.schema["log_date"].dataType)).alias("micros")
    return select_logs(catalog, event_type, interval, bounds, mark).select("path", "field_names", "log_date", micros).collect()


def _file_names(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths as a file scan reports them: with scheme and authority, encoded as a URI, and one slash where there is no authority."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    full = [p.getFileSystem(conf).makeQualified(p).toUri().toString() for p in map(path, paths)]
    return [re.sub("^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", f) for f in full]


def read_logs(spark: SparkSession, rows: Sequence[Row], strict: bool = False) -> DataFrame | None:
    """Rows of the listed log files, with the log date of each one's file as ``MARK``; None if none is listed.

    Files are read by the header that the catalog holds for them. Where headers differ, columns are matched by name and missing ones are
    null; ``strict`` refuses that. A row of a file that is not among the listed ones fails the job. Cells may hold newlines, so a file is
    read by one task.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in rows:
        by_header.setdefault(tuple(row["field_names"]), []).append(row["path"])
    if not by_header:
        return None
    if strict and len(by_header) > 1:
        raise ValueError(f"the log files have {len(by_header)} different headers")
    out = None
    for names, paths in by_header.items():
        part = read_csv(spark, list(dict.fromkeys(paths)), names, strict=True).withColumn("__path", F.col("_metadata.file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    newest: dict[str, object] = {}
    for name, row in zip(_file_names(spark, [r["path"] for r in rows]), rows, strict=True):
        newest[name] = max(row["log_date"], newest.get(name, row["log_date"]))
    dates = F.broadcast(spark.createDataFrame(list(newest.items()), T.StructType([T.StructField("__name", T.StringType()), T.StructField(MARK, _kind(rows))])))  # the list of paths
    plain = F.regexp_replace("__path", "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
    unknown = F.raise_error(F.concat(F.lit("not in the catalog: "), "__path"))
    date = F.when(F.col("__name").isNull(), unknown.cast(_kind(rows))).otherwise(F.col(MARK))
    return out.join(dates, plain == F.col("__name"), "left").withColumn(MARK, date).drop("__path", "__name")


def _kind(rows: Sequence[Row]) -> T.DataType:
    value = rows[0]["log_date"]
    return T.StringType() if isinstance(value, str) else T.TimestampType() if hasattr(value, "hour") else T.DateType()


def scan_log_files(
    spark: SparkSession, catalog: DataFrame, event_type: str, interval: str, bounds: Bounds = NO_BOUNDS, mark: str | None = None, strict: bool = False
) -> DataFrame | None:
    """Rows of the log files that a catalog ``(event_type, interval, log_date, path, field_names)`` lists in the window, or None."""
    return read_logs(spark, listed_logs(catalog, event_type, interval, bounds, mark), strict)


#: Schemes whose files tasks open by themselves, as local or object stores; of others, Spark's text source reads files whole.
RANGED = {"", "file", "s3", "s3a", "gs", "abfs", "abfss"}
#: Bytes that are read at a time until the first line ends.
CHUNK = 64 * 1024


def first_line(stream, chunk: int = CHUNK) -> str | None:
    """The first line that is not blank; no more is read than up to the end of the chunk in which it ends."""
    held = b""
    while True:
        more = stream.read(chunk)
        *lines, held = re.split(rb"\r\n|\n|\r", held + more)
        for line in lines if more else [*lines, held]:
            if line.strip(b" "):
                return line.decode(errors="replace")
        if not more:
            return None


def _scheme(path: str) -> str:
    found = re.match("([A-Za-z][A-Za-z0-9+.-]*):/", path)
    return found[1].lower() if found else ""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, without Spark, and its name there."""
    if _scheme(path) in ("", "file"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for path in batch.column(0).to_pylist():
            store, name = opened(path)
            with store.open_input_stream(name, buffer_size=CHUNK) as stream:
                lines.append(first_line(stream))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], ["file", "line"])


def _scanned_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    first = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    ).where("block = 0 and trim(value) <> ''")
    return first.groupBy("file").agg(F.min_by("value", "at").alias("line"))


def headers(spark: SparkSession, path: str | list[str] | DataFrame) -> DataFrame:
    """``file, names`` for each file with a line: its first one that is not blank as column names, without a byte-order mark, quotes, outer
    blanks and empty cells.

    ``path`` are files, folders and patterns, or a DataFrame with a column ``path``, such as a catalog, whose files tasks open without a
    listing in the driver. Only the first bytes of a file are read, whatever its size, packed or not; but see ``RANGED``.
    """
    if isinstance(path, DataFrame):
        files = path.select("path").distinct()
    elif {_scheme(p) for p in ([path] if isinstance(path, str) else path)} <= RANGED:
        files = spark.read.format("binaryFile").load(path).select("path")  # contents are not asked for, so not read
    else:
        files = None
    line = _scanned_lines(spark, path) if files is None else files.mapInArrow(_first_lines, "file string, line string").where("line is not null")
    clean = F.regexp_replace("line", "^\ufeff", "")
    cells = F.regexp_extract_all(clean, F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    bare = F.transform(cells, lambda c: F.trim(F.when(c.startswith('"'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)))
    return line.select("file", F.filter(bare, lambda c: c != "").alias("names"))
