"""A continuous tail: each trigger loads the files that arrived since the last one into every target."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scratch import written
from tidemark.functions.times import micros_text, parse_iso
from tidemark.operators.schema import augment, project
from tidemark.operators.sinks import STATE, Store, write_state
from tidemark.sources.logs import text_schema


@dataclass(frozen=True)
class TailTarget:
    path: str
    columns: Sequence[str]
    constants: Mapping[str, str] = field(default_factory=dict)


def tail(spark: SparkSession, folder: str, names: Sequence[str], targets: Sequence[TailTarget], checkpoint: str) -> None:
    """Load all new CSV files of ``folder`` into each target, then stop. The checkpoint remembers the files, so none is loaded twice.

    A batch is written under its own number and replaced if it runs again, so a crash between targets repeats nothing.
    """
    reader = spark.readStream.schema(text_schema(names)).option("header", True).option("multiLine", True).option("escape", '"')

    def load(batch: DataFrame, number: int) -> None:
        batch.persist()
        for t in targets:
            rows = augment(batch, t.constants)
            rows = project(rows.select(*[c for c in rows.columns if c.lower() in {x.lower() for x in t.columns}]), t.columns)
            rows.write.mode("overwrite").parquet(f"{t.path.rstrip('/')}/batch={number}")
        batch.unpersist()

    query = reader.csv(folder).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_target(spark: SparkSession, target: TailTarget) -> DataFrame:
    return spark.read.parquet(target.path).select(*[F.col(f"`{c}`") for c in target.columns])


@dataclass(frozen=True)
class StoreTarget:
    """A target of a :class:`Store` and the key of its mark. ``fields`` are the columns that it takes, all by default."""

    target: str
    watermark_key: str
    fields: Sequence[str] = ()
    constants: Mapping[str, str] = field(default_factory=dict)


BATCHES = "target_key string, batch long, status string, rows long, units long, watermark_key string, mark string"


def tail_into(spark: SparkSession, folder: str, names: Sequence[str], targets: Sequence[StoreTarget], store: Store, checkpoint: str) -> DataFrame:
    """Load all CSV files of ``folder`` that arrived since the last call into each target, then stop: one row for each target and batch.

    Targets and marks are those of runs. A batch is committed with its number, under the name that the checkpoint has, so one that is replayed
    after a crash goes only into the targets that it had not reached. ``units`` are the batch's files and the mark is when the newest of them
    was written. Columns that an existing target lacks, and that are missing for it, fail the batch before anything of it reaches that target.
    A new checkpoint loads every file again.
    """
    reader = spark.readStream.schema(text_schema(names)).option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False)
    files = reader.csv(folder).withColumns({"__file": F.col("_metadata.file_path"), "__modified": F.unix_micros("_metadata.file_modification_time")})
    done: list[tuple] = []

    def load(batch: DataFrame, number: int) -> None:
        stream = json.loads(store.files.read(f"{checkpoint.rstrip('/')}/metadata"))["id"]
        last = {t.target: store.transaction(t.target, stream) for t in targets}
        waiting = [t for t in targets if last[t.target] is None or last[t.target] < number]
        own = written(batch)
        units = own.select("__file").distinct().count()
        for t in waiting:
            before = store.version(t.target)
            rows = augment(own.select(*(t.fields or names), "__modified"), t.constants)
            columns = before[1]["columns"] if before else [c.replace(".", "_") for c in rows.columns if c != "__modified"]
            seen = Observation()
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("__modified").alias("mark"))
            staged = store.stage(t.target, project(rows.drop("__modified"), columns))
            got = seen.get
            if not got["rows"]:
                store.abort(staged)
                done.append((t.target, number, "skipped", 0, units, t.watermark_key, None))
                continue
            mark = micros_text(got["mark"])
            store.commit(t.target, staged, "Append", columns, f"{stream}:{number}", {t.watermark_key: mark}, (stream, number))
            done.append((t.target, number, "processed", got["rows"], units, t.watermark_key, mark))
        pending = {k: m for t in targets for k, m in store.pending(t.target).items()}
        applied = {t.target: found[0] for t in targets if (found := store.version(t.target))}
        write_state(store, spark.createDataFrame([(k, m, parse_iso(m)) for k, m in pending.items()], STATE), applied)

    files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.createDataFrame(done, BATCHES)
