"""A run: every target's entries are scanned, aligned, merged and committed as a whole; marks advance only for committed targets."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scratch import written
from tidemark.functions.times import NO_BOUNDS, Bounds, as_instant, earlier, micros_text, parse_iso
from tidemark.operators.schema import augment, document_fields, project, synthesised_metadata
from tidemark.operators.sinks import STATE, Store, csv_line, read_state, write_state
from tidemark.plans.keys import TableId, mark_key
from tidemark.sources import log_stream, logs
from tidemark.sources.tables import MARK, dotted, scan_table


@dataclass(frozen=True)
class Scan:
    """Rows of a scan over countable units (files), how many there are and the mark that they lead to, if they have any rows or not."""

    rows: DataFrame
    units: int
    mark: str | None = None


@dataclass(frozen=True)
class Entry:
    """One source into one target. ``scan`` gives the rows inside bounds above a mark, with the hidden date, as a DataFrame or as a
    :class:`Scan`; None means no source unit. ``source`` is what the mark is about: entries that share a mark key must share it.

    With ``overlap``, ``scan`` goes back so far behind the mark, and its rows carry the digest of their key as ``DIGEST``. ``header`` gives
    the names of the source's columns without reading rows, or None if there is no source unit yet."""

    target: str
    watermark_key: str
    scan: Callable[[Bounds, str | None], DataFrame | Scan | None]
    reader_key: tuple = ()
    constants: Mapping[str, str] = field(default_factory=dict)
    operation: str = "Append"
    override_metadata: bool = False
    kind: str = "sobject"
    source: tuple = ()
    overlap: timedelta | None = None
    header: Callable[[], Sequence[str] | None] | None = None

    def names(self) -> list[str] | None:
        """The source's column names, by ``header`` or else by the plan of a scan."""
        if self.header is not None:
            found = self.header()
            return None if found is None else list(found)
        found = self.scan(NO_BOUNDS, None)
        rows = found.rows if isinstance(found, Scan) else found
        return None if rows is None else [c for c in rows.columns if c not in (MARK, DIGEST)]


#: The hidden column that carries the digest of a row's key, where late rows are looked for.
DIGEST = "__digest"


def key_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of a SHA-256 over the columns, alike in every session's time zone."""
    texts = []
    for name in columns:
        column = dotted(df, name)
        kind = df.select(column).schema[0].dataType
        text = (F.unix_micros(column) if isinstance(kind, T.TimestampType) else column).cast("string")
        texts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.substring(F.sha2(F.concat(*texts), 256), 1, 32))


def table_entry(
    df: DataFrame, object: str, fields: Sequence[str], date_field: str, target: str, name: str | None = None, where: str | None = None, limit: int | None = None,
    with_ties: bool = False, org: str | None = None, overlap: timedelta | None = None, key: Sequence[str] = (), **more,
) -> Entry:
    """An entry over a table of an organisation; entries with equal scans of the same table share them. With ``limit``, ``with_ties`` keeps
    rows that share the last date.

    With ``overlap``, a run also takes rows that arrived late: those dated up to so long before the mark, the mark included, that the target
    does not hold yet. ``key`` names the columns that, with the date, tell a row from all others; rows that share both are one to the search,
    and are all loaded if they arrive together. A row dated before the overlap is not seen.
    """
    if overlap is not None and (not key or limit is not None or more.get("operation", "Append") != "Append" or overlap < timedelta(0)):
        raise ValueError("an overlap needs a key, the operation Append and no limit, and is not negative")

    def scan(bounds: Bounds, mark: str | None) -> DataFrame:
        if overlap is None:
            return scan_table(df, fields, date_field, where, limit, bounds, mark, with_ties)
        keyed = df.withColumn(DIGEST, key_digest(df, [*key, date_field]))
        return scan_table(keyed, [*fields, DIGEST], date_field, where, None, bounds, earlier(mark, overlap) if mark else None, with_mark=True)

    table = TableId(df)
    reader = ("sobject", org, object, table, tuple(fields), date_field, where, limit, with_ties, overlap, tuple(key))
    return Entry(target, mark_key("sobject", name, source_org=org, object=object), scan, reader, source=("sobject", org, object, table), overlap=overlap, **more)


def log_entry(
    spark: SparkSession, catalog: DataFrame, org: str, event_type: str, interval: str, target: str, name: str | None = None, strict: bool = False, **more
) -> Entry:
    """An entry over the log files that a catalog lists (see :func:`tidemark.sources.logs.read_logs`).

    Files decide, not rows: files without rows are processed and move the mark to the newest one's date; without new files it is skipped.
    """

    def scan(bounds: Bounds, mark: str | None) -> Scan | None:
        rows = logs.listed_logs(catalog, event_type, interval, bounds, mark)
        if not rows:
            return None
        return Scan(logs.read_logs(spark, rows, strict), len({r["path"] for r in rows}), micros_text(max(r["micros"] for r in rows)))

    def header() -> list[str] | None:
        rows = catalog.where((F.col("event_type") == event_type) & (F.col("interval") == interval)).select("path", "log_date")
        first = rows.orderBy(F.desc("log_date"), "path").limit(1)
        found = logs.headers(spark, first).first()
        return None if found is None else list(found["names"])

    source = ("elf", org, event_type, interval, TableId(catalog))
    more.setdefault("header", header)
    return Entry(target, mark_key("elf", name, source_org=org, event_type=event_type, interval=interval), scan, (*source, strict), kind="elf", source=source, **more)


def log_source_entry(
    spark: SparkSession, catalog: str, org: str, event_type: str, interval: str, fields: Sequence[str], target: str, name: str | None = None, files_per_task: int = 64, **more
) -> Entry:
    """An entry over ``fields`` of the log files that the Parquet folder ``catalog`` lists, by the data source (see
    :func:`tidemark.sources.log_stream.log_frame`): the list of files never reaches the driver.

    Files decide, as in :func:`log_entry`, with which it shares mark keys. Files dated after the newest one at the start of a run are left to
    the next run.
    """

    def scan(bounds: Bounds, mark: str | None) -> Scan | None:
        listed = spark.read.parquet(catalog)
        date = as_instant(F.col("log_date"), listed.schema["log_date"].dataType)
        window = logs.select_logs(listed, event_type, interval, bounds, mark)
        found = window.agg(F.count_distinct("path").alias("units"), F.unix_micros(F.max(date)).alias("newest")).first()
        if not found["units"]:
            return None
        newest = micros_text(found["newest"])
        rows = log_stream.log_frame(spark, catalog, event_type, interval, fields, Bounds(bounds.start, newest), mark, files_per_task)
        return Scan(rows, found["units"], newest)

    def header() -> list[str] | None:
        return list(fields) if logs.select_logs(spark.read.parquet(catalog), event_type, interval).limit(1).count() else None

    source = ("elf", org, event_type, interval, catalog)
    more.setdefault("header", header)
    return Entry(target, mark_key("elf", name, source_org=org, event_type=event_type, interval=interval), scan, (*source, tuple(fields)), kind="elf", source=source, **more)


def csv_entry(spark: SparkSession, path: str, names: Sequence[str], target: str, name: str | None = None, **more) -> Entry:
    """An entry over CSV files, which are read in full by every run, whatever bounds and marks."""
    scan = lambda bounds, mark: Scan(logs.read_csv(spark, path, names).withColumn(MARK, F.lit(None).cast("timestamp")), 1)

    def header() -> list[str]:
        found = [list(r["names"]) for r in logs.headers(spark, path).select("names").distinct().collect()]
        if len(found) != 1:
            raise ValueError(f"{path} has {len(found)} different headers")
        return found[0]

    more.setdefault("header", header)
    return Entry(target, mark_key("csv", name, csv_path=path), scan, ("csv", path, tuple(names)), kind="csv", source=("csv", path), **more)


def merged(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns; repeated rows stay."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def observed(df: DataFrame, measured: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """Count rows, find the newest date and, of ``measured`` columns, the bytes as quoted lines, while the rows are written, without another pass."""
    seen = Observation(f"scan-{uuid.uuid4().hex}")
    newest = F.max(F.unix_micros(as_instant(F.col(MARK), df.schema[MARK].dataType)))
    metrics = [F.count(F.lit(1)).alias("rows"), newest.alias("mark")]
    if measured:
        metrics.append(F.sum(F.octet_length(csv_line(df, measured)).cast("long") + 1).alias("bytes"))
    return df.observe(seen, *metrics), seen


def unseen(df: DataFrame, loaded: DataFrame, key: str, mark: str, overlap: timedelta) -> DataFrame:
    """Rows past the mark, and those before it that a target does not hold: no row of its own entry has their digest.

    Nothing past the mark can have been loaded, so only the overlap's rows are held against the target's, of which only these are read.
    """
    at, last = as_instant(F.col(MARK), df.schema[MARK].dataType), F.lit(parse_iso(mark))
    there = loaded.where((F.col("__entry") == key) & (F.col("__at") >= F.lit(parse_iso(earlier(mark, overlap)))) & (F.col("__at") <= last))
    late = df.where(at <= last).join(there.select(F.col("__digest").alias(DIGEST)), DIGEST, "left_anti").select(*df.columns)
    return df.where(at > last).union(late)


def _result(
    target: str, idx: int, e: Entry, status: str, rows: int = 0, units: int | None = None, mark: str | None = None, why: str | None = None, n_bytes: int | None = None, parts: int | None = None
) -> dict:
    found = {"target_key": target, "idx": idx, "status": status, "rows": rows, "units": units, "watermark_key": e.watermark_key, "mark": mark, "problem": why}
    return found | {"bytes": n_bytes, "parts": parts}


def _target(store: Store, target: str, entries: list[tuple[int, Entry, DataFrame | Scan | None]], run_id: str, since: Mapping[int, str | None], measured: bool = False) -> list[dict]:
    """Load one target; any failure leaves it as it was. Rows of tables, and units of other sources, decide whether an entry is processed.

    ``since`` are the marks that entries with an overlap go back from.
    """
    result = partial(_result, target)
    staged = None
    try:
        found = [(i, e, df) for i, e, df in entries if df is not None]
        none = [result(i, e, "skipped") for i, e, df in entries if df is None]
        units = {i: df.units for i, _, df in found if isinstance(df, Scan)}
        last = {i: df.mark for i, _, df in found if isinstance(df, Scan)}
        found = [(i, e, df.rows if isinstance(df, Scan) else df) for i, e, df in found]
        if not found:
            return none
        before = store.version(target)
        operation = found[0][1].operation
        same_schema = before is not None and not any(e.override_metadata for _, e, _ in found)
        first = augment(found[0][2].drop(MARK, DIGEST), found[0][1].constants)
        document = store.metadata(target) if same_schema else None
        if document is not None:
            columns = [f["name"] for f in document_fields(document)]
        else:
            columns = before[1]["columns"] if same_schema else [c.replace(".", "_") for c in first.columns]
            document = synthesised_metadata(first.toDF(*[c.replace(".", "_") for c in first.columns]).select(*[f"`{c}`" for c in columns]), target)
        looks_back = any(e.overlap is not None for _, e, _ in found)
        parts, seen = [], []
        for i, e, df in found:
            if e.overlap is not None and since.get(i) is not None and before is not None:
                df = unseen(df, store.hidden(target), e.watermark_key, since[i], e.overlap)
            unseen_columns = {"__entry": F.lit(e.watermark_key), "__at": as_instant(F.col(MARK), df.schema[MARK].dataType), "__digest": F.col(DIGEST) if DIGEST in df.columns else F.lit(None).cast("binary")}
            hidden = unseen_columns if looks_back else {}
            rows, observation = observed(project(augment(df.withColumns(hidden), e.constants), columns, [MARK, *hidden]), columns if measured else ())
            parts.append(rows.drop(MARK))
            seen.append(observation)
        staged = store.stage(target, merged(parts), "Overwrite" if not same_schema else operation)
        got = [o.get for o in seen]
        if any(g["rows"] and g["mark"] is None and e.kind != "csv" for (_, e, _), g in zip(found, got, strict=True)):
            raise ValueError("rows without any date cannot advance a mark")
        now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        results = []
        for (i, e, _), g in zip(found, got, strict=True):
            newest = None if g["mark"] is None else micros_text(g["mark"])
            if e.overlap is not None and since.get(i) and newest and parse_iso(newest) < parse_iso(since[i]):
                newest = since[i]  # late rows alone do not move the mark back
            processed = g["rows"] or units.get(i) or e.kind == "csv"
            size = {"n_bytes": g.get("bytes") or 0, "parts": store.parts(staged)} if measured else {}
            mark = now if e.kind == "csv" else last.get(i) or newest
            results.append(result(i, e, "processed", g["rows"], units.get(i), mark, **size) if processed else result(i, e, "skipped", units=units.get(i)))
        if any(g["rows"] for g in got) or any(e.kind == "csv" for _, e, _ in found):
            store.commit(target, staged, operation, columns, run_id, {r["watermark_key"]: r["mark"] for r in results if r["status"] == "processed"}, metadata=document)
        else:
            store.abort(staged)
        return none + results
    except Exception as problem:  # a target fails alone
        if staged is not None:
            store.abort(staged)
        return [result(i, e, "failed", why=str(problem)[:500]) for i, e, _ in entries]


RESULT = "target_key string, idx int, status string, rows long, units long, watermark_key string, mark string, problem string, bytes long, parts long"


def one_source(entries: Sequence[Entry]) -> None:
    """Refuse a mark key over several sources: the mark of one would hide rows of the other."""
    sources: dict[str, tuple] = {}
    for e in entries:
        if e.source and sources.setdefault(e.watermark_key, e.source) != e.source:
            raise ValueError(f"different sources share the mark key {e.watermark_key!r}: give each an org or a name of its own")


def run(spark: SparkSession, entries: Sequence[Entry], store: Store, bounds: Bounds = NO_BOUNDS, workers: int = 4, measured: bool = False) -> DataFrame:
    """Run all entries and return one row for each. Targets are loaded side by side and do not disturb one another.

    Entries that share a scan and a mark read their source once: its rows are written to the shared folder for all of them. ``units`` are
    the files of an entry that has such. The state is written even if nothing was loaded. With ``measured``, ``bytes`` are an entry's rows as
    quoted lines with their ends, summed as they are written, and ``parts`` the files that its target's load consists of.

    A target's rows and marks are one commit. A run that dies before it writes the state leaves marks pending in the targets that it had
    loaded, and the next one goes on from these, target by target. In the same way, where entries of several targets share a mark and one of
    these targets fails, the state keeps the old mark for it, and the others go on from their own.
    """
    one_source(entries)
    targets: dict[str, list[int]] = defaultdict(list)
    for i, e in enumerate(entries):
        targets[e.target].append(i)
    pending = {t: store.pending(t) for t in targets}
    keys = spark.createDataFrame([(k,) for k in {e.watermark_key for e in entries}], "watermark_key string")
    held = {r["watermark_key"]: r["watermark_raw"] for r in read_state(store).join(keys, "watermark_key", "left_semi").select("watermark_key", "watermark_raw").collect()}
    marks = {i: pending[e.target].get(e.watermark_key, held.get(e.watermark_key)) for i, e in enumerate(entries)}
    shared: dict[tuple, list[int]] = defaultdict(list)
    for i, e in enumerate(entries):
        shared[(e.reader_key, marks[i]) if e.reader_key else ("alone", i)].append(i)
    scans: dict[int, DataFrame | Scan | None] = {}
    broken: dict[int, Exception] = {}
    for members in shared.values():
        e = entries[members[0]]
        try:
            df = e.scan(bounds, marks[members[0]])
            if df is not None and len(members) > 1:
                df = replace(df, rows=written(df.rows)) if isinstance(df, Scan) else written(df)
            scans.update(dict.fromkeys(members, df))
        except Exception as problem:
            broken.update(dict.fromkeys(members, problem))
    run_id = uuid.uuid4().hex
    since = {} if bounds.start is not None else marks

    def load(target: str) -> list[dict]:
        own = targets[target]
        problem = next((broken[i] for i in own if i in broken), None)
        if problem is not None:
            return [_result(target, i, entries[i], "failed", why=str(problem)[:500]) for i in own]
        return _target(store, target, [(i, entries[i], scans[i]) for i in own], run_id, since, measured)

    with ThreadPoolExecutor(workers) as pool:
        results = sorted((r for rows in pool.map(load, targets) for r in rows), key=lambda r: r["idx"])
    names = [n.split(" ")[0] for n in RESULT.split(", ")]
    out = spark.createDataFrame([tuple(r[n] for n in names) for r in results], RESULT)
    failed = {r["watermark_key"] for r in results if r["status"] == "failed"}
    new = {k: m for t in targets for k, m in pending[t].items()} | {r["watermark_key"]: r["mark"] for r in results if r["status"] == "processed"}
    rows = [(k, m, parse_iso(m)) for k, m in new.items() if k not in failed]
    applied = {t: found[0] for t in targets if not failed & {*pending[t], *(entries[i].watermark_key for i in targets[t])} and (found := store.version(t))}
    write_state(store, spark.createDataFrame(rows, STATE), applied)
    return out
