"""Embedding near-dedup with a forest of random-projection trees.

Many trees cut the vectors of each label by recursive random splits. A split's threshold is the median of a bounded sample of its node,
and vectors near the threshold go to both sides (spill), so a pair is parted only where both lie clearly apart. Vectors are compared
within leaves, in double precision; a pair that shares several leaves counts in the first of them. Pairs are never emitted: a leaf
returns, for each vector, how many it links with there and the smallest vector that it reaches there.

Copies are one class throughout. All rows are indexed; only the thresholds come from samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, settle, small
from tidemark.llm.components import components
from tidemark.llm.vector_search import usable

#: Trees; vectors in a leaf that is split no more; levels split in one round; sample of a node's vectors; directions tried for a split.
TREES, LEAF, LEVELS, SAMPLE, TRIES = 4, 512, 6, 1024, 6
#: The most leaves whose sizes are broadcast (16 bytes each).
MAX_LEAVES = 200_000
#: A split is used only if this share of the sample, at most, would go to both sides.
MAX_SPILL = 0.5
#: Vectors of an unsplittable leaf are compared chunk by chunk, so that no task holds more than two chunks, and a strip of rows at a time.
CHUNK, STRIP = 4096, 512


def _direction(leaf: int, node: int, attempt: int, d: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64([leaf & (2**64 - 1), node, attempt]))
    v = rng.standard_normal(d)
    return v / np.linalg.norm(v)


def _spill(d: int, threshold: float) -> float:
    """Half the width of the band that goes to both sides: about 1.3 standard deviations of how far a just linked pair lies apart."""
    return 1.3 * float(np.sqrt((2 - 2 * threshold) / max(1, d)))


def _unit(column, kind: str) -> np.ndarray:
    """Vectors of one length as rows of norm 1, in double precision, scaled by their largest component so that no square overflows."""
    v = np.frombuffer(b"".join(column), kind).astype(np.float64)
    v = v.reshape(len(column), -1)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _packed(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the bytes of their own components."""
    for batch in batches:
        column = batch.column("v")
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)) * flat.itemsize
        held = flat.tobytes()
        v = pa.array([held[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary())
        yield pa.RecordBatch.from_pydict({c: v if c == "v" else batch.column(c) for c in batch.schema.names})


def _fit(threshold: float, kind: str, group: pd.DataFrame) -> pd.DataFrame:
    """Directions and medians of the top levels of the subtree at one leaf, from a sample of it."""
    leaf, levels = int(group.leaf.iloc[0]), int(group.levels.iloc[0])
    x = _unit(group.v, kind)
    margin = _spill(x.shape[1], threshold)
    which, median = np.full(2**LEVELS, -1, np.int8), np.zeros(2**LEVELS, np.float32)
    members = {1: np.arange(len(x))}
    for node in range(1, 2**levels):
        own = members.pop(node, None)
        if own is None or len(own) < 8:
            continue
        best = None
        for attempt in range(TRIES):
            p = x[own] @ _direction(leaf, node, attempt, x.shape[1])
            m = float(np.median(p))
            both = float((np.abs(p - m) <= margin).mean())
            if best is None or both < best[0]:
                best = (both, attempt, m, p)
        if best[0] <= MAX_SPILL:
            which[node], median[node] = best[1], best[2]
            members[2 * node], members[2 * node + 1] = own[best[3] <= median[node] + margin], own[best[3] >= median[node] - margin]
    return pd.DataFrame({"label": [group.label.iloc[0]], "leaf": [leaf], "which": [which.tobytes()], "median": [median.tobytes()]})


def _child(leaf: int, node: int) -> int:
    """The name of a subtree's leaf: a 64-bit mix of the leaf that it splits and its node."""
    h = (leaf ^ (node * 0x9E3779B97F4A7C15)) & (2**64 - 1)
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return int(np.uint64(h ^ (h >> 31)).astype(np.int64))


def _leaves(x: np.ndarray, leaf: int, which: np.ndarray, median: np.ndarray, margin: float, directions: dict) -> Iterator[tuple[np.ndarray, int]]:
    """The rows of ``x`` that each leaf of the subtree at ``leaf`` holds, and the leaf's node."""
    at = {1: np.arange(len(x))}
    for node in range(1, 2 ** (LEVELS + 1)):
        own = at.pop(node, None)
        if own is None or not len(own):
            continue
        if node < len(which) and which[node] >= 0:
            key = leaf, node
            if key not in directions:
                directions[key] = _direction(leaf, node, int(which[node]), x.shape[1])
            p = x[own] @ directions[key]
            at[2 * node], at[2 * node + 1] = own[p <= median[node] + margin], own[p >= median[node] - margin]
        else:
            yield own, node


def _route(threshold: float, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector with the leaves that it falls into, from the splits of its present leaves in ``splits``."""
    directions: dict = {}
    for batch in batches:
        rows, leaf, split = [], [], []
        lists = batch.column("splits")
        owner, flat = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten()
        present = flat.field("leaf").to_numpy()
        order = np.argsort(present, kind="stable")
        cuts = np.flatnonzero(np.diff(present[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            first, here = int(group[0]), int(present[group[0]])
            which, median = np.frombuffer(flat.field("which")[first].as_py(), np.int8), np.frombuffer(flat.field("median")[first].as_py(), np.float32)
            x = _unit(batch.column("v").take(pa.array(owner[group])).to_pylist(), kind)
            for own, node in _leaves(x, here, which, median, _spill(x.shape[1], threshold), directions):
                rows.append(owner[group[own]])
                leaf.append(np.full(len(own), _child(here, node)))
                split.append(np.full(len(own), node > 1))
        if rows:
            taken = pa.array(np.concatenate(rows))
            columns = {c: batch.column(c).take(taken) for c in ("id", "n", "label", "v")}
            yield pa.RecordBatch.from_pydict({**columns, "leaf": np.concatenate(leaf), "split": np.concatenate(split)})


def _sampled(live: DataFrame) -> DataFrame:
    """``SAMPLE`` vectors of each leaf at random: a cut-off by the leaf's size leaves about twice as many before any is sent."""
    h = F.xxhash64("id", "leaf")
    share = F.lit(2.0 * SAMPLE) / F.col("size")
    few = live.where((F.col("size") <= 2 * SAMPLE) | (F.shiftrightunsigned(h, 12) < share * F.lit(float(1 << 52))))
    nth = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("id", "leaf"), "id"))
    return few.withColumn("nth", nth).where(F.col("nth") <= SAMPLE).drop("nth")


def forest(vectors: DataFrame, threshold: float, kind: str, scratch: Scratch, trees: int = TREES) -> DataFrame:
    """``id, n, label, v, leaf, size`` for each vector and leaf that holds it. Leaves above ``LEAF`` are split again until no split helps.

    A round's splits and leaves are tables.
    """
    columns = ["id", "n", "label", "v"]
    roots = F.array(*[F.xxhash64("label", F.octet_length("v"), F.lit(t)) for t in range(trees)])
    live, done = vectors.withColumn("leaf", F.explode(roots)), []
    while True:
        sizes = scratch.settle(live.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")))
        large = sizes.where(F.col("size") > LEAF)
        done.append(live.join(small(sizes.where(F.col("size") <= LEAF), MAX_LEAVES), "leaf").select(*columns, "leaf", "size"))
        if large.isEmpty():
            break
        levels = F.least(F.lit(LEVELS), F.ceil(F.log2(F.col("size") / LEAF)) + 1).cast("int")
        sample = _sampled(live.join(small(large, MAX_LEAVES), "leaf")).withColumn("levels", levels)
        fitted = scratch.settle(sample.groupBy("leaf").applyInPandas(partial(_fit, threshold, kind), "label int, leaf long, which binary, median binary"))
        own = F.struct("leaf", "which", "median")
        if len(done) == 1:  # the first round: all trees from one reading of the vectors
            trees_of = fitted.groupBy("label").agg(F.collect_list(own).alias("all"))
            sent = vectors.join(small(trees_of, 10_000), "label").withColumn("splits", F.filter("all", lambda s: F.array_contains(roots, s["leaf"])))
        else:
            sent = live.join(small(fitted.select("leaf", F.array(own).alias("splits")), 10_000), "leaf")
        routed = sent.select(*columns, "splits").mapInArrow(partial(_route, threshold, kind), "id long, n long, label int, v binary, leaf long, split boolean")
        routed = scratch.settle(routed)
        whole = routed.where(~F.col("split")).drop("split")
        done.append(whole.join(scratch.settle(whole.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))), "leaf").select(*columns, "leaf", "size"))
        live = routed.where("split").drop("split")
    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.union(more)
    return leaves


def _compare(threshold: float, kind: str, group: pd.DataFrame) -> pd.DataFrame:
    """Links of one leaf, or between two chunks of it: how many counted here for each vector, and the smallest one reached."""
    leaf, a, b = int(group.leaf.iloc[0]), int(group.a.iloc[0]), int(group.b.iloc[0])
    group = group.sort_values("id", kind="stable")
    x, ids, n, chunk = _unit(group.v, kind), group.id.to_numpy(), group.n.to_numpy(), group.chunk.to_numpy()
    strips = [slice(i, min(i + STRIP, len(ids))) for i in range(0, len(ids), STRIP)]
    link = np.empty((len(ids), len(ids)), bool)
    for s in strips:
        link[s] = x[s] @ x.T >= threshold
        if a != b:
            link[s] &= chunk[s, None] != chunk[None, :]
    np.fill_diagonal(link, False)
    if not link.any():
        return pd.DataFrame({"id": ids[:0], "links": n[:0], "root": ids[:0]})
    root = np.arange(len(ids), dtype=np.int32)
    while True:
        new = np.minimum(root, np.concatenate([np.where(link[s], root[None, :], np.int32(len(ids))).min(1) for s in strips]))
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    earlier = [np.array([x for x in own if x < leaf], np.int64) for own in group.leaves]
    names = np.unique(np.concatenate(earlier))
    reached = link.any(1)
    if len(names):
        held = np.zeros((len(ids), len(names)), np.float32)
        for i, own in enumerate(earlier):
            held[i, np.searchsorted(names, own)] = 1
        for s in strips:
            link[s] &= held[s] @ held.T == 0
    links = np.concatenate([link[s] @ n for s in strips])
    return pd.DataFrame({"id": ids, "links": links, "root": ids[root]})[reached]


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", trees: int = TREES
) -> DataFrame:
    """Link vectors of one label whose cosine is at least ``threshold``: ``vec_id, n_links, component_id, kept``, one row for each row.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reached by links and ``kept`` marks the row
    whose id that is. Rows with a null label or a vector that is null, empty, zero or holds null or non-finite components link with
    nothing and are their own component. Copies link with each other. Rows without an id count as links of others but have a component
    only through them; rows that share an id are one vector of the component. Vectors of other dimensions never link. Other columns are
    ignored, whatever their names; no rows give no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(label).cast("int").alias("label"))
    fit = usable(F.col("v")) & F.col("label").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    plain = F.transform("v", lambda x: x.cast("double") + F.lit(0.0))
    key = F.when(fit, F.struct(F.xxhash64("label", plain).alias("k1"), F.xxhash64(F.lit("again"), plain, "label").alias("k2")))
    keyed = rows.withColumn("key", key)
    classes = keyed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.min("label").alias("label"), F.min(plain).alias("v")
    )
    spark, element = vectors.sparkSession, rows.schema["v"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    scratch = Scratch(spark)
    classes = scratch.settle(classes.select("key.k1", "key.k2", "id", "n", "label", F.transform("v", lambda x: x.cast("float" if kind == "<f4" else "double")).alias("v")))
    usable_classes = classes.where("id is not null").groupBy("id", "label", "v").agg(F.sum("n").alias("n")).select("id", "n", "label", "v")
    usable_classes = scratch.settle(usable_classes.mapInArrow(partial(_packed, kind), "id long, n long, label int, v binary"))
    leaves = forest(usable_classes, threshold, kind, scratch, trees)
    held = leaves.groupBy("id").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))  # a few for each tree
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    parts = leaves.join(held, "id").withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))
    others = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.struct(F.least(c, "chunk").alias("a"), F.greatest(c, "chunk").alias("b")))
    units = parts.withColumn("pair", F.explode(others)).select("id", "n", "v", "leaf", "leaves", "chunk", "pair.a", "pair.b")
    found = scratch.settle(units.groupBy("leaf", "a", "b").applyInPandas(partial(_compare, threshold, kind), "id long, links long, root long"))

    reached = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "id", "left").join(reached, classes.id == reached.node, "left").select(
        "k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    keyed = keyed.select("vec_id", "key.k1", "key.k2")
    out = keyed.join(settle(classes), ["k1", "k2"], "left")
    scratch.drop()
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
