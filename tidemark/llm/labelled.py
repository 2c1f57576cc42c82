"""What the two classifiers share: a bounded sample of labelled rows, and scoring whole texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, small

#: Most bytes of labelled texts that are brought to the driver, half for each class.
SAMPLE_BYTES = 48 << 20

def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves no remainder. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def _least_hashed(own: DataFrame, per_class: int) -> DataFrame:
    """The ``per_class`` rows of each label with the least hashes of their ids, ties by id.

    A cut-off that leaves a little more than that, from the number of rows, comes before any row is sent; without it every task would
    send as many as are wanted in all.
    """
    hashed = settle(own.withColumn("h", F.xxhash64(F.col("id").cast("string"))))
    counts = {r["label"]: r["n"] for r in hashed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for label in (0, 1):
        rows, n = hashed.where(F.col("label") == label), counts.get(label, 0)
        share = (per_class + 8 * per_class**0.5 + 16) / max(1, n)
        if share < 1:
            few = rows.where(F.col("h") < F.lit(int(-(2**63) + share * 2**64)))
            rows = few if few.count() >= per_class else rows
        parts.append(rows.orderBy("h", "id").limit(per_class))
    return parts[0].union(parts[1])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, doc_id: str = "doc_id", text: str = "text", max_bytes: int = SAMPLE_BYTES
) -> tuple[list[str], np.ndarray]:
    """At most ``per_class`` texts of each label among rows that are not held out, chosen by a hash of the id, brought to the driver.

    Null labels are ignored; an id with several labels has the larger one, and an id with several texts the first in order. Of each label,
    texts in order of that hash come as long as they fit into half of ``max_bytes``; one that does not is passed over, the next may fit.
    """
    own = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    own = own.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    chosen = small(settle(_least_hashed(own, per_class)), 2 * per_class)
    found = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(chosen, F.col("doc") == F.col("id"))
    found = settle(found.groupBy("id", "label", "h").agg(F.min("text").alias("text")))
    taken, room = [], {0: max_bytes // 2, 1: max_bytes // 2}
    for r in sorted(found.select("h", "id", "label", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).collect()):
        if r["size"] <= room[r["label"]]:
            room[r["label"]] -= r["size"]
            taken.append(r["id"])
    rows = sorted(found.where(F.col("id").isin(taken)).select("id", "label", "text").collect()) if taken else []
    return [r["text"] for r in rows], np.array([r["label"] for r in rows], np.int64)


def _scored(score: Callable, model, at: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = model.value
    for batch in batches:
        found = score((t.as_py() for t in batch.column(at)), held)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])


def with_score(docs: DataFrame, score: Callable, model, text: str, name: str) -> DataFrame:
    """Add a column ``name`` with ``score(texts, model)`` for each row; the model is broadcast and has a fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    fields = ", ".join(f"c{i} {t.dataType.simpleString()}" for i, t in enumerate(docs.schema.fields))
    out = kept.mapInArrow(partial(_scored, score, sent, docs.columns.index(text)), f"{fields}, score double")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("score").alias(name))


def free_name(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
