"""Best-fit packing of token sequences, planned over the histogram of lengths.

Best-fit decreasing needs only how many pieces have each length, so the plan is made from counts: at most one entry for each length up to
the sequence length, whatever the number of documents. It says, for each length, which runs of ranks go to which sequences and places.
Pieces then learn their rank within their length (two-level prefix sums, so that a common length does not meet in one task) and join the
plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import settle, small
from tidemark.llm.encode import encoder

#: Pieces of one length that are ranked in one group, about; a longer-run length is dealt to several groups.
GROUP_ROWS = 250_000
#: Rows of a plan, or of the groups' bases, that are broadcast (some 100 bytes each).
MAX_ROWS = 200_000


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots as ``(length, first rank, last rank, first sequence, pieces for a sequence, offset)`` from the number of pieces by length.

    Longest first, each piece goes to the fullest sequence that still has room, else to a new one. Sequences filled alike are one entry
    here, so the work follows the number of different fillings, not of pieces.
    """
    rooms: list[int] = []  # sorted room left
    open_by_room: dict[int, list[tuple[int, int]]] = {}  # room: runs of sequences (first, how many)
    slots, next_sequence = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in open_by_room:
                open_by_room[room] = []
                insort(rooms, room)
            open_by_room[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, next_sequence, -(-left // (capacity // length))
                next_sequence += n
            each = room // length
            full = min(n, left // each)
            for sequences, pieces in ((full, each), (1 if full < n and left - full * each else 0, left - full * each)):
                if sequences:
                    pieces = min(pieces, each)
                    slots.append((length, rank, rank + sequences * pieces - 1, first, pieces, capacity - room))
                    rank, left = rank + sequences * pieces, left - sequences * pieces
                    keep(room - pieces * length, first, sequences)
                    first, n = first + sequences, n - sequences
            keep(room, first, n)
    return slots


def _encode(tokenizer: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(tokenizer), end_id.to_bytes(4, "little")
    for batch in batches:
        piece, start, length, crc, of = [], [], [], [], []
        for i, text in enumerate(batch.column("text")):
            found = encode(text.as_py()) + end
            n = len(found) // 4
            first = n % capacity or capacity
            cuts = [0, *range(first, n + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                of.append(i)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(found[4 * a : 4 * b]))
        key = batch.column("doc_id").take(pa.array(of, pa.int64()))
        columns = [key, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, and cut what is longer than ``capacity`` so that all pieces but the first are full."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(partial(_encode, tokenizer, end_id, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces``, a written table with a ``length`` from 1 to ``capacity``; other columns stay.

    The driver sees one row for each length. Groups of a length are dealt by row, so rows that are alike spread too.
    """
    spark = pieces.sparkSession
    by_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths = spark.createDataFrame([(length, -(-n // GROUP_ROWS)) for length, n in by_length.items()], "length long, groups int")
    slots = spark.createDataFrame(best_fit_plan(by_length, capacity), "length long, lo long, hi long, first long, each long, at long")

    numbered = settle(pieces.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(lengths), "length").withColumn(  # at most capacity rows
        "group", F.pmod(F.xxhash64("row"), F.col("groups")).cast("int")
    ))
    counts = numbered.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = settle(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))

    within = Window.partitionBy("length", "group").orderBy("row")
    ranked = numbered.join(small(bases, MAX_ROWS), ["length", "group"]).withColumn("rank", F.col("base") + F.row_number().over(within) - 1)
    r, s = ranked.alias("r"), small(slots, MAX_ROWS).alias("s")
    placed = r.join(s, (F.col("r.length") == F.col("s.length")) & F.col("r.rank").between(F.col("s.lo"), F.col("s.hi")))
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        *[F.col(f"r.{c}") for c in pieces.columns],
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("each")) * F.col("r.length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens, one row for each piece:
    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are the end id alone. Rows with one id, or with none, are packed each for itself. Documents longer than the
    capacity are cut; nothing else is. Other columns are ignored, whatever their names; no rows give no rows.
    """
    return place(settle(cut(docs, tokenizer, end_id, capacity, doc_id, text)), capacity)
