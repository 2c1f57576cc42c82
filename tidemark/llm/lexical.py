"""Ranked lexical search: exact maximum inner products over sparse vectors, by a forest of ball trees.

A document is the vector of its terms' integer weights, a query the terms of an item, and a score their inner product. Documents are dealt to
cells by the most alike of a few sampled ones, and cells to groups of at most about ``GROUP`` documents. Each group grows a ball tree: a node
holds its documents' centroid and a radius that reaches all of them, rounded up, so no score below it exceeds ``<q, centroid> + |q| * radius``.

1. Every group tells, for each query, the bound of its root and the scores of the one leaf that bounds and centroids lead to first. The k-th
   best of all these scores is one that the k-th best document reaches.
2. Groups whose bound falls short of it are done. The others are searched best-first, subtree by subtree, until no open bound reaches the k-th
   best score so far. Leaves are scored in 64-bit integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, settle
from tidemark.llm.textbytes import chunks, lowered, runs, trim

#: Documents of a group and of a leaf; the most cells; terms of a block of items, which are searched for together.
GROUP, LEAF, CELLS, TERMS = 2048, 32, 64, 1 << 16
#: Bounds are sums in double precision of at most some thousand numbers; this covers their rounding many times over.
SAFE = 1 + 1e-9
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _count(vocabulary: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document how many terms it has, which of the vocabulary, in order of their numbers, and how often."""
    known = pa.array(vocabulary, pa.string())
    wanted = np.ones(256, bool)
    wanted[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
    for batch in batches:
        for at, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            n = len(bounds) - 1
            low = lowered(data)
            starts, ends = runs(wanted[low])
            doc = np.searchsorted(bounds, starts, "right") - 1
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(low[wanted[low]].tobytes()))
            number = pc.fill_null(pc.index_in(terms, known), -1).to_numpy()
            met = number >= 0
            both, tf = np.unique(doc[met] * len(vocabulary) + number[met], return_counts=True)
            own, number = both // len(vocabulary), (both % len(vocabulary)).astype(np.int32)
            edge = pa.array(np.searchsorted(own, np.arange(n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").slice(at, n), "n": np.bincount(doc, minlength=n),
                "terms": pa.ListArray.from_arrays(edge, pa.array(number)), "tfs": pa.ListArray.from_arrays(edge, pa.array(tf.astype(np.int64))),
            })
    trim()


class _Vectors:
    """Rows of ``terms, xs`` as one sparse matrix."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.edge = np.cumsum([0, *(len(t) for t, _ in rows)])
        self.terms = np.concatenate([t for t, _ in rows]) if rows else np.empty(0, np.int32)
        self.xs = np.concatenate([x for _, x in rows]) if rows else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(len(rows)), np.diff(self.edge))

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of these rows, by their order: whose an entry is, its term and its value."""
        size = np.diff(self.edge)[rows]
        which = np.repeat(np.arange(len(rows)), size)
        at = np.repeat(self.edge[rows], size) + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        return which, self.terms[at], self.xs[at]


class _Node:
    __slots__ = ("below", "centre", "radius", "rows")


def _tree(v: _Vectors, rows: np.ndarray, width: int) -> _Node:
    """A ball tree: a node's documents part by which of two far ones they are nearer to, or, where that does not part them, in halves."""
    node = _Node()
    which, term, x = v.entries(rows)
    value = x.astype(np.float64)
    node.centre = np.bincount(term, value, width) / len(rows)
    squares = np.bincount(which, value * value, len(rows))
    distance = squares - 2 * np.bincount(which, value * node.centre[term], len(rows)) + (node.centre @ node.centre)
    # what cancels is known to some 1e-12 of what it was made of
    node.radius = float(np.sqrt(np.maximum(distance, 0) + 1e-9 * (squares + node.centre @ node.centre)).max()) * SAFE
    node.rows, node.below = rows, ()
    if len(rows) > LEAF:
        ends = []
        for _ in range(2):
            far = int(distance.argmax())
            pivot = np.zeros(width)
            pivot[term[which == far]] = value[which == far]
            distance = squares - 2 * np.bincount(which, value * pivot[term], len(rows)) + squares[far]
            ends.append(distance)
        nearer = ends[0] < ends[1]
        if not len(rows) // 16 <= nearer.sum() <= len(rows) - len(rows) // 16:
            nearer = np.zeros(len(rows), bool)
            nearer[np.argsort(ends[0] - ends[1], kind="stable")[: len(rows) // 2]] = True
        node.below = (_tree(v, rows[nearer], width), _tree(v, rows[~nearer], width))
    return node


def _bound(node: _Node, query: np.ndarray) -> float:
    return (float(node.centre[query].sum()) + len(query) ** 0.5 * node.radius) * SAFE + 1


def _scores(v: _Vectors, node: _Node, query: np.ndarray, width: int) -> np.ndarray:
    """Exact scores of a leaf's documents."""
    asked = np.zeros(width, bool)
    asked[query] = True
    which, term, x = v.entries(node.rows)
    met = asked[term]
    out = np.zeros(len(node.rows), np.int64)
    np.add.at(out, which[met], x[met])
    return out


def _best(v: _Vectors, root: _Node, query: np.ndarray, width: int, k: int, least: int) -> list[tuple[int, int]]:
    """Documents, as (score, row), that score ``least`` or more, at least 1: the k best and all that tie with the last of these."""
    heap, found, turn = [(-_bound(root, query), 0, root)], [], 0
    while heap and -heap[0][0] >= least:
        node = heapq.heappop(heap)[2]
        for child in node.below:
            turn += 1
            if (bound := _bound(child, query)) >= least:
                heapq.heappush(heap, (-bound, turn, child))
        if not node.below:
            found += [(int(s), int(r)) for s, r in zip(_scores(v, node, query, width), node.rows, strict=True) if s >= least]
            if len(found) >= k:
                least = max(least, heapq.nlargest(k, (s for s, _ in found))[-1])
    return [f for f in found if f[0] >= least]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each group of a partition, which come sorted by group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cut = np.flatnonzero(np.diff(batch.column("group").to_numpy())) + 1
        for lo, hi in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            part = batch.slice(lo, hi - lo)
            if held and part.num_rows and held[0].column("group")[0] != part.column("group")[0]:
                yield held[0].column("group")[0].as_py(), pa.Table.from_batches(held)
                held = []
            if part.num_rows:
                held.append(part)
    if held:
        yield held[0].column("group")[0].as_py(), pa.Table.from_batches(held)
    trim()


def _grown(rows: pa.Table, width: int) -> tuple[_Vectors, _Node]:
    terms, xs = (rows.column(c).combine_chunks() for c in ("terms", "xs"))
    v = _Vectors([(t.values.to_numpy(), x.values.to_numpy()) for t, x in zip(terms, xs, strict=True)])
    return v, _tree(v, np.arange(rows.num_rows), width)


def _probe(queries: list[np.ndarray], width: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each group's bound for each query, and the best scores of the leaf that it leads to first."""
    for group, rows in _groups(batches):
        v, root = _grown(rows, width)
        bounds, scores = [], []
        for query in queries:
            node = root
            while node.below:
                node = max(node.below, key=lambda n: _bound(n, query))
            own = _scores(v, node, query, width)
            bounds.append(_bound(root, query))
            scores.append(np.sort(own[own > 0])[::-1][:k].tolist())
        yield pa.RecordBatch.from_pydict({"group": np.full(len(queries), group), "query": np.arange(len(queries)), "bound": np.array(bounds), "scores": pa.array(scores, pa.list_(pa.int64()))})


def _search(queries: list[np.ndarray], least: list[int], width: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each group's documents that can be among the best, for the queries that asked for it."""
    for _, rows in _groups(batches):
        v, root = _grown(rows, width)
        ids, out = rows.column("doc_id"), []
        for q in rows.column("asked")[0].as_py():
            out += [(q, s, r) for s, r in _best(v, root, queries[q], width, k, least[q])]
        if out:
            q, s, r = (np.array(c, np.int64) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_pydict({"query": q, "score": s, "doc_id": ids.take(pa.array(r)).combine_chunks()})


def _cells(pivots: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the number of the pivot, of unit length, that each vector is most alike to."""
    for batch in batches:
        cells = np.zeros(batch.num_rows, np.int64)
        for i, (t, x) in enumerate(zip(batch.column("terms"), batch.column("xs"), strict=True)):
            cells[i] = (x.values.to_numpy().astype(np.float32) @ pivots[t.values.to_numpy()]).argmax()
        yield batch.append_column("cell", pa.array(cells))


def _pivots(vectors: DataFrame, width: int) -> np.ndarray:
    """A column for each of at most ``CELLS`` sampled vectors, different ones where there are such."""
    order = F.xxhash64(F.lit(11), "terms", "xs")
    found = vectors.select("terms", "xs").groupBy(F.xxhash64("terms").alias("kind")).agg(F.min_by(F.struct("terms", "xs"), order).alias("v")).orderBy(F.xxhash64(F.lit(13), "kind")).limit(CELLS).collect()
    out = np.zeros((width, max(1, len(found))), np.float32)
    for i, r in enumerate(found):
        x = np.array(r.v.xs, np.float64)
        out[np.array(r.v.terms, np.int64), i] = x / max(1.0, float(np.sqrt((x * x).sum())))
    return out


def _block(docs: DataFrame, items: list, scratch: Scratch, k: int) -> DataFrame:
    """``query, score, doc_id`` of the best documents for a block of items, with more that score no better than the last."""
    spark = docs.sparkSession
    vocabulary = sorted({t for r in items for t in r.terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    queries = [np.array(sorted(number[t] for t in r.terms), np.int64) for r in items]
    width, parts = len(vocabulary), int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = scratch.settle(docs.mapInArrow(partial(_count, vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"))
    sums = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    held = counted.where(F.size("terms") > 0)
    df = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2 * sums.docs + 2)).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = [0] * width  # one for each term of the block
    for r in df.select("term", weight.alias("w")).collect():
        weights[r.term] = r.w
    wide = "decimal(38,0)"
    m = F.lit(10) + F.expr(f"(cast(90 * n as {wide}) * {sums.docs}) div {max(1, sums.total)}")
    impact = lambda tf, i: F.element_at("ws", F.element_at("terms", i + 1) + 1) * F.call_function("div", F.lit(1_000_000_000) * tf, F.lit(1000) * tf + F.lit(8) * F.col("m"))
    vectors = held.select("doc_id", "terms", "tfs", m.alias("m"), F.lit(weights).alias("ws")).select("doc_id", "terms", F.transform("tfs", impact).alias("xs"))
    vectors = scratch.settle(vectors)
    cells = vectors.mapInArrow(partial(_cells, _pivots(vectors, width)), "doc_id long, terms array<int>, xs array<long>, cell long")
    cells = scratch.settle(cells.withColumn("own", F.xxhash64("doc_id", "terms", "xs")))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("chunks"))
    grouped = cells.join(F.broadcast(sizes), "cell").withColumn("group", F.xxhash64("cell", F.pmod("own", "chunks")))  # at most CELLS sizes
    grouped = scratch.settle(grouped.select("group", "own", "doc_id", "terms", "xs"))
    together = lambda rows: rows.repartition(parts, "group").sortWithinPartitions("group", "own")
    probed = scratch.settle(together(grouped).mapInArrow(partial(_probe, queries, width, k), "group long, query long, bound double, scores array<long>"))
    kth = probed.select("query", F.explode("scores").alias("score")).groupBy("query", "score").agg(F.count(F.lit(1)).alias("times"))
    upto = kth.withColumn("upto", F.sum("times").over(Window.partitionBy("query").orderBy(F.col("score").desc()))).where(F.col("upto") >= k)
    least = [1] * len(queries)
    for r in upto.groupBy("query").agg(F.max("score").alias("score")).collect():  # one for each query of the block
        least[r["query"]] = max(1, r.score)
    limits = spark.createDataFrame(list(enumerate(least)), "query long, least long")
    asked = probed.join(F.broadcast(limits), "query").where(F.col("bound") >= F.col("least")).groupBy("group").agg(F.sort_array(F.collect_list("query")).alias("asked"))
    found = together(grouped.join(asked, "group")).mapInArrow(partial(_search, queries, least, width, k), "query long, score long, doc_id long")
    return scratch.settle(found)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents with a score above 0 for each row of ``items``, equal scores by ``doc_id``.

    Terms are the longest runs of letters, digits and characters beyond ASCII, with A-Z in lower case; null and empty texts have none. With N
    the documents that have terms, L all their terms, n one document's, df the documents that hold a term and tf its occurrences in one, a term
    weighs floor(1000 ln((2N + 2) / (2df + 1))), and scores weight * (10^9 tf div (1000 tf + 8m)), m being 10 + 90nN div L, once for an item.
    Every row of ``docs`` is a document, whatever others share its id; null ids come last among equals, and rows alike in id and score are in
    any order. An item without terms has no rows; items that share an id are ranked each alone. Other columns are ignored, whatever their
    names; no documents or no items give no rows. Items are searched for in blocks of some ``TERMS`` terms, each over all documents.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    low = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    terms = F.array_distinct(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("terms")
    asked = settle(items.select(F.col(f"`{item_id}`").alias("item_id"), terms).where("size(terms) > 0").withColumn("item", F.monotonically_increasing_id()))
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks, out = -(-total // TERMS), []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms").collect()  # some TERMS terms
        if own:
            names = spark.createDataFrame([(q, r["item"]) for q, r in enumerate(own)], "query long, item long")
            out.append(_block(rows, own, scratch, k).join(F.broadcast(names), "query").select("item", "score", "doc_id"))
    if not out:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = settle(found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k))
    scratch.drop()
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
