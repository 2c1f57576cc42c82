"""Token-ID output: flat unsigned integer files with 64-bit document offsets, made to be memory-mapped.

A dataset is a folder of parts. Part k holds ``part-k.ids`` (token ids, flat, little-endian, two bytes each where the vocabulary allows,
else four), ``part-k.offsets`` (int64: where each of its documents starts in the part, then the part's length) and ``part-k.docs``
(int64 document ids; the least int64 stands for null). ``manifest.json`` lists the parts with their bases: the prefix sums of their
lengths. Parts are in ascending order of document id, so base plus offset is a document's place among all ids.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.encode import encoder

NO_ID = np.iinfo(np.int64).min
#: Bytes of ids that a writer holds before it appends them to its file.
FLUSH = 8 << 20


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def _write_part(folder: str, tokenizer: str, end_id: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write this task's documents under names of this attempt, then move them to the part's names: a lost or repeated task does no harm."""
    part, encode = TaskContext.get().partitionId(), encoder(tokenizer)
    store, top = _place(folder)
    names = {kind: f"{top}/part-{part:05d}.{kind}" for kind in ("ids", "offsets", "docs")}
    tried = {kind: f"{name}.{uuid.uuid4().hex}" for kind, name in names.items()}
    end, n_ids, n_docs = np.array([end_id], f"<u{width}").tobytes(), 0, 0
    with store.open_output_stream(tried["ids"]) as ids, store.open_output_stream(tried["offsets"]) as offsets, store.open_output_stream(tried["docs"]) as docs:
        for batch in batches:
            held, size, starts = [], 0, []
            for text in batch.column("text"):
                found = np.frombuffer(encode(text.as_py()), "<u4").astype(f"<u{width}").tobytes() + end
                starts.append(n_ids)
                n_ids += len(found) // width
                held.append(found)
                size += len(found)
                if size >= FLUSH:
                    ids.write(b"".join(held))
                    held, size = [], 0
            ids.write(b"".join(held))
            offsets.write(np.array(starts, "<i8").tobytes())
            docs.write(batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
            n_docs += batch.num_rows
        offsets.write(np.array([n_ids], "<i8").tobytes())
    for kind, name in names.items():
        store.move(tried[kind], name)
    yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_ids": [n_ids]})


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None
) -> dict:
    """Encode every whole text, append ``end_id`` to each document and write the dataset to ``folder``, which all executors can reach.

    Returns the manifest. Null texts are empty and become the end id alone; null ids come first; rows with one id are ordered by a hash
    of their text; other columns are ignored, whatever their names; no rows give parts without documents. The driver sees one row for
    each part.
    """
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    width = 2 if top <= 1 << 16 else 4
    spark = docs.sparkSession
    store, path = _place(folder)
    store.create_dir(path, recursive=True)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
    done = rows.select("doc_id", "text").mapInArrow(partial(_write_part, folder, tokenizer, end_id, width), "part long, n_docs long, n_ids long")
    parts = [r.asDict() for r in sorted(done.collect())]
    base = 0
    for p in parts:
        p["base"] = base
        base += p["n_ids"]
    manifest = {"width": width, "n_ids": base, "parts": parts}
    with store.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def open_part(folder: str, part: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets and document ids of a part: memory-mapped where the folder is a local or mounted one, else read."""
    store, top = _place(folder)
    out = []
    for kind, dtype in (("ids", f"<u{width}"), ("offsets", "<i8"), ("docs", "<i8")):
        name = f"{top}/part-{part:05d}.{kind}"
        if isinstance(store, fs.LocalFileSystem):
            out.append(np.memmap(name, dtype, "r") if os.path.getsize(name) else np.empty(0, dtype))
        else:
            with store.open_input_stream(name) as stream:
                out.append(np.frombuffer(stream.read(), dtype))
    return out[0], out[1], out[2]


def _read_parts(folder: str, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, offsets, docs = open_part(folder, row["part"], width)
            for at in range(0, len(docs), 4096):
                starts, ends = offsets[at : at + 4096], offsets[at + 1 : at + 4097]
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=False)]
                own = docs[at : at + 4096]
                columns = [pa.array(own, mask=own == NO_ID), starts[: len(own)] + row["base"], ends - starts[: len(own)], np.array(crc, "i8")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, folder: str, manifest: dict | None = None) -> DataFrame:
    """One row for each document of the dataset: ``doc_id, start, n_tokens, ids_crc32`` (crc32 of its ids as 32-bit integers)."""
    if manifest is None:
        store, path = _place(folder)
        with store.open_input_stream(f"{path}/manifest.json") as stream:
            manifest = json.loads(stream.read())
    parts = spark.createDataFrame([(p["part"], p["base"]) for p in manifest["parts"]], "part long, base long")
    parts = parts.repartition(max(1, len(manifest["parts"])), "part")
    return parts.mapInArrow(partial(_read_parts, folder, manifest["width"]), "doc_id long, start long, n_tokens long, ids_crc32 long")
