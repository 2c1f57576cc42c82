"""Exact top-k search by inner product with a vector-approximation file.

The file holds, for each vector, one signed byte for each component (its cell, at the vector's own width) and, in a column that a scan of
cells does not read, the exact integers. A search scans the cells for bounds on every score. The k best lower bounds of a query, over the
whole file, rule out all vectors with lower upper bounds. Exact vectors are read for the others alone, in the order of their upper bounds: the
first few of each query, then those whose bound reaches the k-th score found; no other can be among the k best. Queries are searched in
blocks of bounded size against the whole file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, settle

#: Queries searched in one pass, vectors scanned at once, and candidates that a task holds before it hands them on.
BLOCK, STRIP, HELD = 8192, 1024, 1_000_000
#: Scores beyond 64 bits are the largest or least number of 64 bits.
LARGEST, LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _file(scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells and integers of each vector; the integers are doubles, which hold every one of them exactly."""
    for batch in batches:
        column = batch.column("v")
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        with np.errstate(over="ignore"):
            flat = np.floor(scale * flat)
        rows = np.split(flat, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))[:-1]) if len(column) else []
        fit = pa.array([bool(np.isfinite(r).all()) for r in rows], pa.bool_())
        width = [max(0, int(np.frexp(np.abs(r).max(initial=0.0))[1]) - 7) if f else 0 for r, f in zip(rows, fit.to_pylist(), strict=True)]
        cells = [np.floor(np.ldexp(r, -w)).clip(-128, 127).astype(np.int8).tobytes() if f else b"" for r, w, f in zip(rows, width, fit.to_pylist(), strict=True)]
        columns = {"width": pa.array(width, pa.int32()), "cells": pa.array(cells, pa.binary()), "exact": pa.array([r.tobytes() for r in rows], pa.binary())}
        yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("row", "vec_id", "asked")}, **columns}).filter(fit)


def approximation_file(vectors: DataFrame, queries: Column, vec_id: str, vector: str, scale: int, scratch: Scratch) -> DataFrame:
    """Write ``row, vec_id, asked, width, cells, exact, same`` of floor(scale * x); cells are integers over two to the ``width``.

    ``same`` is equal for equal vectors. A component that is not finite once scaled takes its vector out.
    """
    rows = vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("asked"), F.col(vector).alias("v")
    )
    file = rows.mapInArrow(partial(_file, scale), "row long, vec_id long, asked boolean, width int, cells binary, exact binary")
    return scratch.settle(file.withColumn("same", F.xxhash64("exact")))


def _needed(same: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows that could be among the k best of some query: of equal vectors only so many with the least ids, whatever the query's own id."""
    order = np.lexsort((ids, same))
    s, i = same[order], ids[order]
    for times, by_id in ((k, True), (2 * k, False)):
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (by_id & (i[1:] != i[:-1]))
        keep = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0)) < times
        order, s, i = order[keep], s[keep], i[keep]
    return np.sort(order)


class _Bounds:
    """Candidates for the queries of one dimension: rows whose upper bound reaches the k-th lower bound so far."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int):
        self.number, self.ids, self.q, self.k = number, ids, queries, k
        self.low = np.full((len(ids), k), -np.inf)
        self.up, self.down, self.size = np.maximum(queries, 0).sum(1), np.minimum(queries, 0).sum(1), np.abs(queries).sum(1)
        self.held, self.n = [], 0

    def scan(self, row: np.ndarray, ids: np.ndarray, width: np.ndarray, cells: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            unit = np.ldexp(1.0, width)[None, :]
            base = (self.q @ cells.astype(np.float64).T) * unit
            most = self.size[:, None] * 128 * unit  # beyond 52 bits sums are rounded, by no more than this
            error = np.where(most < 2.0**52, 0.0, most * (self.q.shape[1] + 8) * 2.0**-51)
            lower = np.nan_to_num(base + self.down[:, None] * (unit - 1) - error, nan=-np.inf, posinf=np.inf, neginf=-np.inf).clip(float(LEAST), float(LARGEST))
            upper = np.nan_to_num(base + self.up[:, None] * (unit - 1) + error, nan=np.inf, posinf=np.inf, neginf=-np.inf).clip(float(LEAST), float(LARGEST))
        own = self.ids[:, None] == ids[None, :]
        best = np.concatenate([self.low, np.where(own, -np.inf, lower)], 1)
        self.low = -np.partition(-best, self.k - 1, axis=1)[:, : self.k]
        q, r = np.nonzero((upper >= self.low.min(1)[:, None]) & ~own)
        self.held.append((q, row[r], lower[q, r], upper[q, r]))
        self.n += len(q)

    def take(self) -> pa.RecordBatch:
        q, row, lower, upper = (np.concatenate(c) for c in zip(*self.held, strict=True))
        left = upper >= self.low.min(1)[q]
        self.held, self.n = [], 0
        return pa.RecordBatch.from_pydict({"q": self.number[q[left]], "row": row[left], "lower": lower[left], "upper": upper[left]})


def _matrix(column: pa.Array, rows: np.ndarray, dtype, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.take(pa.array(rows)).to_pylist()), dtype).reshape(len(rows), d)


def _scan(queries, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bounds = {d: _Bounds(number, ids, vectors, k) for d, (number, ids, vectors) in queries.value.items()}
    for batch in batches:
        ids, width, row = (batch.column(c).to_numpy() for c in ("vec_id", "width", "row"))
        needed = _needed(batch.column("same").to_numpy(), ids, k)
        sizes = np.array([len(c) for c in batch.column("cells").to_pylist()], np.int64)[needed]
        for d, state in bounds.items():
            rows = needed[sizes == d]
            for at in range(0, len(rows), STRIP):
                strip = rows[at : at + STRIP]
                state.scan(row[strip], ids[strip], width[strip], _matrix(batch.column("cells"), strip, np.int8, d))
                if state.n > HELD:
                    yield state.take()
    for state in bounds.values():
        if state.held:
            yield state.take()


def inner_product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of ``q`` with ``v``, integers in doubles; those beyond 64 bits become the nearest number of 64 bits."""
    most = np.abs(q).max(initial=0.0) * np.abs(v).max(initial=0.0) * max(1, len(v))
    if most < 2.0**52:
        return (q @ v).astype(np.int64)
    if most < 2.0**62:
        return q.astype(np.int64) @ v.astype(np.int64)
    other = [int(x) for x in v]
    return np.array([min(LARGEST, max(LEAST, sum(int(x) * y for x, y in zip(row, other, strict=True)))) for row in q], np.int64)


def _read(queries, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact scores of the vectors read with the queries that ask for each."""
    place = {int(n): (d, i) for d, (number, _, _) in queries.value.items() for i, n in enumerate(number)}
    for batch in batches:
        q, ids, scores = [], [], []
        for vec_id, exact, asks in zip(batch.column("vec_id").to_pylist(), batch.column("exact").to_pylist(), batch.column("asks").to_pylist(), strict=True):
            v = np.frombuffer(exact, np.float64)
            at = [place[n][1] for n in asks]
            q += asks
            ids += [vec_id] * len(asks)
            scores.append(inner_product(queries.value[len(exact) // 8][2][at], v) if len(v) else np.zeros(len(asks), np.int64))
        if q:
            yield pa.RecordBatch.from_pydict({"q": np.array(q, np.int64), "vec_id": np.array(ids, np.int64), "score": np.concatenate(scores)})


def _best(scores: DataFrame, key: str, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("rank", nth).where(F.col("rank") <= k)


def _search(file: DataFrame, sent, k: int, scratch: Scratch) -> DataFrame:
    """``q, vec_id, score``: among others, the k best of each query of one block."""
    bounds = scratch.settle(file.select("row", "vec_id", "width", "cells", "same").mapInArrow(partial(_scan, sent, k), "q long, row long, lower double, upper double"))
    kth = bounds.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lower")))).where(F.col("nth") == k).select("q", F.col("lower").alias("kth"))
    left = bounds.join(kth, "q", "left").where("kth is null or upper >= kth")
    left = scratch.settle(left.select("q", "row", "upper", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("upper"), "row")).alias("nth")))

    def read(pairs: DataFrame) -> DataFrame:
        wanted = pairs.groupBy("row").agg(F.collect_list("q").alias("asks"))
        return scratch.settle(file.select("row", "vec_id", "exact").join(wanted, "row").mapInArrow(partial(_read, sent), "q long, vec_id long, score long"))

    first = read(left.where(F.col("nth") <= 2 * k))
    sure = _best(first, "q", k).where(F.col("rank") == k).select("q", F.col("score").alias("kth"))
    rest = read(left.where(F.col("nth") > 2 * k).join(sure, "q", "left").where("kth is null or upper >= kth"))
    return first.union(rest)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """The ``k`` best rows for each query by integer inner product of floor(scale * x): ``query_id, rank, vec_id, score``.

    Queries are the rows where ``queries`` holds; candidates are all rows of the same dimension but those with the query's own id. Ties
    go to smaller ids. Vectors that are null or hold null or non-finite components (also once scaled), and rows without an id, take no part;
    scores beyond 64 bits are the nearest number of 64 bits, and tie there; repeated rows count each; different vectors of one query id are
    searched each and their results ranked together; other columns are ignored, whatever their names; no rows give no rows. A block of at
    most about ``BLOCK`` queries is sent to the executors at a time.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    file = approximation_file(vectors, queries, vec_id, vector, scale, scratch)
    asked = file.where("asked").select("vec_id", "exact").distinct()
    blocks, parts = max(1, -(-asked.count() // BLOCK)), []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        of: dict[int, list] = {}
        for number, r in enumerate(rows):
            of.setdefault(len(r.exact) // 8, []).append((number, r))
        sent = spark.sparkContext.broadcast(
            {
                d: (np.array([n for n, _ in own]), np.array([r.vec_id for _, r in own]), np.frombuffer(b"".join(r.exact for _, r in own), np.float64).reshape(len(own), d))
                for d, own in of.items()
            }
        )
        names = spark.createDataFrame([(n, r.vec_id) for n, r in enumerate(rows)], "q long, query_id long")
        found = _search(file, sent, k, scratch).join(F.broadcast(names), "q")  # a block's queries
        parts.append(settle(_best(found.select("query_id", "vec_id", "score"), "query_id", k)))
        sent.destroy()
    scratch.drop()
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.union(p)
    return merged.select("query_id", "rank", "vec_id", "score")
