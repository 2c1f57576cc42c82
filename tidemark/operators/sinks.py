"""Targets: packing rows into parts, staged commits, CSV and gzip exports, and the state of marks."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.scratch import written
from tidemark.functions.text import as_text, csv_quote, formula_guard
from tidemark.operators.schema import as_described, document_fields, plain_name

#: Fixed value: a part stays below 10 MiB once its bytes are base64, which writes three bytes as four.
PART_BYTES = 10 * 1024 * 1024 * 3 // 4
STATE = "watermark_key string, watermark_raw string, watermark_ts timestamp"
#: Columns that a target's rows may carry unseen: the mark key of the entry that loaded the row, its date and the digest of its key.
HIDDEN = "__entry string, __at timestamp, __digest binary"
#: Schemes of stores without folders: a rename there copies over what exists, while a file appears only once it is closed.
OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn", "obs"}


def pack_parts(df: DataFrame, size: Column, order: Sequence[str], budget: int = PART_BYTES, groups: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Add ``part``: consecutive rows of a group, by running size over the budget. A row is never split.

    Rows are dealt to slices by ranges of group and order, summed within a slice, and moved on by the prefix sums of the slices before, so
    no group is ordered in one task.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.withColumn("__size", size).repartitionByRange(n, *groups, *order).withColumn("__slice", F.spark_partition_id()))
    inside = Window.partitionBy(*groups, "__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*groups, "__slice").agg(F.sum("__size").alias("__sum"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    summed = dealt.withColumn("__upto", F.coalesce(F.sum("__size").over(inside), F.lit(0))).join(bases, [*groups, "__slice"])
    part = F.floor((F.col("__base") + F.col("__upto")) / F.lit(budget)).cast("long")
    return summed.select(*df.columns, part.alias("part"))


def csv_line(df: DataFrame, columns: Sequence[str]) -> Column:
    """The quoted and guarded line of a row of these columns."""
    return F.concat_ws(",", *[csv_quote(as_text(F.col(f"`{c}`"), df.schema[c].dataType)) for c in columns])


def csv_lines(df: DataFrame) -> DataFrame:
    """One quoted and guarded line for each row, as ``line``."""
    return df.select(csv_line(df, df.columns).alias("line"))


def _cut(budget: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, upto = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        starts = upto + np.cumsum(sizes) - sizes
        upto += int(sizes.sum())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base + starts // budget)], ["line", "part"])


def cut_parts(lines: DataFrame, budget: int = PART_BYTES) -> DataFrame:
    """Add ``part`` to rows of one ``line`` by their running size within the Spark partition that they are in: nothing is moved or ordered.

    Numbers ascend by partition and place, with gaps: a partition's parts start at its number times 2^32.
    """
    return lines.mapInArrow(partial(_cut, budget), "line string, part long")


def export_gzip(df: DataFrame, path: str, budget: int = PART_BYTES) -> None:
    """Numbered folders of gzip text without headers, one file each, of at most the budget and one row before compression.

    Rows are packed where they are (see :func:`cut_parts`), in one pass without a shuffle; Spark commits the files of a task or none.
    """
    cut_parts(csv_lines(df), budget).write.partitionBy("part").option("compression", "gzip").text(path)


def export_csv(df: DataFrame, path: str, operation: str = "Append", guarded: Sequence[str] | None = None, nulls: bool = False) -> None:
    """A folder of CSV files with headers; ``Append`` adds files, ``Overwrite`` replaces them once written.

    Cells of the ``guarded`` columns, by default of all, are guarded. Every cell is quoted, and null is the cell of empty text. With ``nulls``
    null is a bare empty cell, and only cells that need quotes have them: Spark's writer quotes nulls too where it quotes all. A bare cell
    alone in its line would be an empty line, so a null in a lone column then fails the job.

    Old files are moved aside and deleted only when the new ones are in place, so that a crash loses neither.
    """
    fs = _Files(df.sparkSession)
    alone = F.raise_error(F.lit("the null of a lone column would be an empty line")).cast("string")
    cells = []
    for f in df.schema:
        cell = as_text(F.col(f"`{f.name}`"), f.dataType)
        cell = formula_guard(cell) if guarded is None or f.name in guarded else cell
        if nulls:
            cell = F.when(F.col(f"`{f.name}`").isNotNull(), cell).otherwise(alone if len(df.columns) == 1 else F.lit(None))
        cells.append(cell.alias(f.name))
    writer = df.select(*cells).write.option("header", True).option("quoteAll", not nulls).option("escape", '"').option("emptyValue", '""' if nulls else "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if operation == "Append":
        writer.mode("append").csv(path)
        return
    staged = f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    writer.csv(staged)
    aside = f"{path.rstrip('/')}__{uuid.uuid4().hex}" if fs.exists(path) else None
    if aside and not fs.rename(path, aside):
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(staged, path):
        if aside:
            fs.rename(aside, path)
        raise OSError(f"{staged} cannot take the place of {path}")
    if aside:
        fs.delete(aside)


class _Files:
    """Whole files and renames in whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def rename(self, old: str, new: str) -> bool:
        fs, p = self._at(old)
        return bool(fs.rename(p, self.jvm.org.apache.hadoop.fs.Path(new)))

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """Write a new file, whole or not at all; an existing one is an error.

        Where there are folders, the text is written aside and renamed in a way that refuses to replace a file. Object stores cannot do that,
        but refuse to create over a file. What is there afterwards is read back, so that of two writers the one that lost knows it.
        """
        fs, p = self._at(path)
        if fs.exists(p):
            raise FileExistsError(path)
        direct = fs.getScheme() in OBJECT_STORES
        tried = p if direct else self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        try:
            out = fs.create(tried, False)
            out.write(text.encode())
            out.close()
            if not direct:
                refuse = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(fs.makeQualified(tried), fs.makeQualified(p), refuse)
        except Py4JJavaError as problem:
            if not direct:
                fs.delete(tried, False)
            if fs.exists(p):
                raise FileExistsError(path) from problem
            raise
        if self.read(path) != text:
            raise FileExistsError(path)


class Store:
    """Versioned targets below one folder. A version is a small file that lists the folders of rows it consists of.

    Rows are written aside and become visible by one rename of the next version's file; until then, and after a failure, readers see the
    version before. Appending lists the earlier folders too; overwriting does not, and never touches what is being read. A version holds the
    types of its columns, and rows of other types are not appended. Of two that commit to a target at once, the second fails.

    A version also holds the marks that its rows lead to, so that rows and marks become visible by the same rename; the state of marks names
    the version of each target up to which it has taken them over (``applied``). Marks of later versions are :meth:`pending`: whoever loads
    the target next goes on from these, whatever happened between the two commits. ``transactions`` are the numbers of the last batches of
    streams; a batch that was committed is not committed again.

    A version carries the target's metadata document, which names its columns and, for columns of text, the types that :meth:`described`
    reads them as. A change of columns or types is a version too: folders of rows keep the schema that they were written with (``schemas``),
    and are read in the columns of the last version, matched by name, cast to its types, and null where they lack a column.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), _Files(spark)

    def _home(self, target: str) -> str:
        """A folder of the target's own: other characters are written as their bytes in hexadecimal."""
        return f"{self.root}/{re.sub(r'[^A-Za-z0-9_.-]', lambda c: ''.join(f'~{b:02X}' for b in c[0].encode()), target)}"

    def version(self, target: str) -> tuple[int, dict] | None:
        found = [int(n.removesuffix(".json")) for n in self.files.names(f"{self._home(target)}/versions") if re.fullmatch(r"\d+\.json", n)]
        if not found:
            return None
        return max(found), json.loads(self.files.read(f"{self._home(target)}/versions/{max(found)}.json"))

    def fit(self, target: str, schema: T.StructType) -> None:
        """Refuse rows whose columns have other types than the target's."""
        before = self.version(target)
        held = {f["name"]: T.StructField.fromJson(f).dataType for f in before[1]["schema"]["fields"]} if before and before[1]["folders"] else {}
        wrong = [f"{f.name} is {f.dataType.simpleString()}, not {held[f.name].simpleString()}" for f in schema if f.name in held and held[f.name] != f.dataType]
        if wrong:
            raise ValueError(f"columns do not fit the target: {', '.join(wrong)}")

    def stage(self, target: str, df: DataFrame, operation: str = "Append") -> str:
        if operation == "Append":
            self.fit(target, df.schema)
        path = f"{self._home(target)}/rows/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def commit(
        self, target: str, staged: str, operation: str, columns: Sequence[str], run_id: str | None = None, marks: Mapping[str, str] | None = None,
        transaction: tuple[str, int] | None = None, applied: Mapping[str, int] | None = None, metadata: Mapping | None = None,
    ) -> int:
        """Make staged rows visible, with their marks, as the next version. A transaction that the target has seen changes nothing.

        ``metadata`` replaces the target's document; without it the earlier one stays."""
        before = self.version(target)
        held = before[1] if before else {}
        seen = held.get("transactions", {})
        if transaction and seen.get(transaction[0], -1) >= transaction[1]:
            self.abort(staged)
            return before[0]
        number = before[0] + 1 if before else 1
        schema = self.spark.read.parquet(staged).select(*[f"`{c}`" for c in columns]).schema
        older = held.get("folders", []) if operation == "Append" else []
        schemas = {f: held.get("schemas", {}).get(f, held["schema"]) for f in older} if held.get("schema") != schema.jsonValue() or held.get("schemas") else {}
        version = {
            "id": uuid.uuid4().hex, "run": run_id, "folders": [*older, staged], "columns": list(columns), "schemas": schemas,
            "schema": schema.jsonValue(), "metadata": metadata or held.get("metadata"), "marks": dict(marks or {}), "transactions": {**seen, **dict([transaction] if transaction else [])},
            "applied": {**held.get("applied", {}), **(applied or {})},
        }
        self.files.create(f"{self._home(target)}/versions/{number}.json", json.dumps(version))
        return number

    def pending(self, target: str) -> dict[str, str]:
        """Marks of the target's versions that the state has not taken over; later versions win."""
        latest, state = self.version(target), self.version("state")
        applied = state[1].get("applied", {}).get(target, 0) if state else 0
        marks: dict[str, str] = {}
        for number in range(applied + 1, latest[0] + 1 if latest else 0):
            held = latest[1] if number == latest[0] else json.loads(self.files.read(f"{self._home(target)}/versions/{number}.json"))
            marks |= held.get("marks", {})
        return marks

    def transaction(self, target: str, stream: str) -> int | None:
        """The number of the last batch of a stream that the target holds."""
        found = self.version(target)
        return found[1].get("transactions", {}).get(stream) if found else None

    def hidden(self, target: str) -> DataFrame | None:
        """What rows carry unseen (see ``HIDDEN``), null for those that were loaded without."""
        found = self.version(target)
        if found and not found[1]["folders"]:
            return self.spark.createDataFrame([], HIDDEN)
        return self.spark.read.schema(HIDDEN).parquet(*found[1]["folders"]) if found else None

    def parts(self, staged: str) -> int:
        """How many files staged rows consist of."""
        return sum(n.startswith("part-") for n in self.files.names(staged))

    def abort(self, staged: str) -> None:
        self.files.delete(staged)

    def read(self, target: str) -> DataFrame | None:
        found = self.version(target)
        if not found:
            return None
        last = found[1]["schema"]
        schema, groups = T.StructType.fromJson(last), {}
        for folder in found[1]["folders"]:
            own = found[1].get("schemas", {}).get(folder, last)
            groups.setdefault(json.dumps(own), (own, []))[1].append(folder)
        out = None
        for own, folders in groups.values():
            rows = self.spark.read.schema(T.StructType.fromJson(own)).parquet(*folders)
            if own != last:
                names = {plain_name(c): c for c in rows.columns}
                cells = [F.col(f"`{names[plain_name(f.name)]}`") if plain_name(f.name) in names else F.lit(None) for f in schema]
                rows = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cells, schema, strict=True)])
            out = rows if out is None else out.union(rows)
        return self.spark.createDataFrame([], schema) if out is None else out

    def metadata(self, target: str) -> dict | None:
        """The document of the target's last version."""
        found = self.version(target)
        return found[1].get("metadata") if found else None

    def declare(self, target: str, document: Mapping) -> int:
        """Give a target a document by hand: as its first version, without rows, or over the present one, whose columns it must name."""
        names = [f["name"] for f in document_fields(document)]
        found = self.version(target)
        if found:
            if [plain_name(n) for n in names] != [plain_name(c) for c in found[1]["columns"]]:
                raise ValueError("the document does not name the target's columns")
            version = {**found[1], "id": uuid.uuid4().hex, "run": None, "marks": {}, "metadata": dict(document)}
        else:
            version = {"id": uuid.uuid4().hex, "run": None, "folders": [], "columns": names, "metadata": dict(document), "marks": {}}
            version["schema"] = T.StructType([T.StructField(n, T.StringType()) for n in names]).jsonValue()
        number = found[0] + 1 if found else 1
        self.files.create(f"{self._home(target)}/versions/{number}.json", json.dumps(version))
        return number

    def described(self, target: str) -> DataFrame | None:
        """The target's rows with columns of text as the types that its document declares; a malformed cell fails the job."""
        rows, document = self.read(target), self.metadata(target)
        return rows if rows is None or not document else as_described(rows, document)


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """New marks over old ones, which may move a mark back; other keys stay."""
    o, n = old.alias("o"), new.alias("n")
    return o.join(n, F.col("o.watermark_key") == F.col("n.watermark_key"), "full").select(
        F.coalesce("n.watermark_key", "o.watermark_key").alias("watermark_key"),
        F.when(F.col("n.watermark_key").isNotNull(), F.col("n.watermark_raw")).otherwise(F.col("o.watermark_raw")).alias("watermark_raw"),
        F.when(F.col("n.watermark_key").isNotNull(), F.col("n.watermark_ts")).otherwise(F.col("o.watermark_ts")).alias("watermark_ts"),
    )


def read_state(store: Store) -> DataFrame:
    """The stored marks, none if nothing was stored; a mark that is not a timestamp with an offset fails the job."""
    from tidemark.functions.times import is_iso

    state = store.read("state")
    if state is None:
        return store.spark.createDataFrame([], STATE)
    wrong = F.raise_error(F.concat(F.lit("invalid mark: "), "watermark_raw")).cast("string")
    return state.withColumn("watermark_raw", F.when(is_iso(F.col("watermark_raw")), F.col("watermark_raw")).otherwise(wrong))


def write_state(store: Store, new: DataFrame, applied: Mapping[str, int] | None = None) -> None:
    """Merge marks into the state; ``applied`` are the versions of targets whose marks are among them."""
    merged = merge_state(read_state(store), new)
    store.commit("state", store.stage("state", merged, "Overwrite"), "Overwrite", ["watermark_key", "watermark_raw", "watermark_ts"], applied=applied)
