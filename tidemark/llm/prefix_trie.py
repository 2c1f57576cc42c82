"""Conversation prefix trie by ROLLUP over positional columns of turn ids.

Conversations are cut into blocks of ``WIDTH`` turns, one row for each with its turns' ids in positional columns. One ROLLUP over these columns
aggregates all prefixes of all blocks together, and ``grouping_id`` tells their lengths. A block is keyed by the node that the blocks before it
lead to, so that long conversations go on in further column blocks. The key of a node is 128 bits: the exclusive or of the hashes of the
blocks on the way to it, so it needs no round for each block, and under seeds that are drawn for the run nobody can choose turns that collide.

Sums over subtrees are ROLLUPs over the nodes themselves, from the deepest block that several conversations share to the first, each block's
totals carried to the node that keys it. Below a node of one conversation they are known without: one leaf and nothing saved.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, settle

#: Turns of a block, and bits of the ranges of conversation ids that are listed together.
WIDTH, RANGE_BITS = 8, 12
BEFORE = (Window.unboundedPreceding, -1)
KEY = ["kx", "ky"]


def _before(df: DataFrame, key: str, order: str, columns: dict[str, Column], fold, join) -> DataFrame:
    """Add to each row the fold of ``columns`` over the rows of its key before it, null for the first.

    ``df`` has a ``slice``, which grows with key and order: folds run within a slice and go on from those of the slices before, so that no
    key's rows meet in one task.
    """
    inside = Window.partitionBy(key, "slice").orderBy(order).rowsBetween(*BEFORE)
    totals = df.groupBy(key, "slice").agg(*[fold(c).alias(f"{n}_all") for n, c in columns.items()])
    earlier = Window.partitionBy(key).orderBy("slice").rowsBetween(*BEFORE)
    bases = totals.select(key, "slice", *[fold(f"{n}_all").over(earlier).alias(f"{n}_base") for n in columns])
    own = df.withColumns({f"{n}_own": fold(c).over(inside) for n, c in columns.items()}).join(bases, [key, "slice"])
    zero = F.lit(0).cast("long")
    return own.select(*df.columns, *[join(F.coalesce(f"{n}_base", zero), F.coalesce(f"{n}_own", zero)).alias(n) for n in columns])


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, turn_id`` of the turns in order of ``turn``, null first, then role and text; ``pos`` counts from 1.

    A turn's id holds a digest of its role and text, null ones being empty, and the bytes of its text. Rows without a conversation are left
    out; repeated rows are turns of their own; other columns are ignored, whatever their names.
    """
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), empty(role).alias("role"), empty(text).alias("text")).where("conv_id is not null")
    digest = F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32)
    rows = rows.withColumns({"turn_id": F.concat(digest, F.lit(":"), F.octet_length("text").cast("string")), "row": F.monotonically_increasing_id()})
    order, parts = ["conv_id", "turn", "role", "text", "row"], int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "turn_id", F.monotonically_increasing_id().alias("at"))
    dealt = settle(dealt).withColumn("slice", F.shiftright("at", 33))
    out = _before(dealt, "conv_id", "at", {"n": F.lit(1).cast("long")}, F.sum, lambda a, b: a + b)
    return out.select("conv_id", (F.col("n") + 1).alias("pos"), "turn_id")


def _hash(seeds: tuple[int, int], upto: Column) -> list[Column]:
    """Two hashes of a block's number and its first turns."""
    ids = F.slice(F.array(*[f"t{i}" for i in range(WIDTH)]), 1, upto.cast("int"))
    return [F.xxhash64(F.lit(s), "block", ids) for s in seeds]


def _keyed(df: DataFrame, seeds: tuple[int, int], upto: Column, names: list[str] = KEY) -> DataFrame:
    """Add the key of the node that lies ``upto`` turns below the node ``(px, py)``; none below is that node itself."""
    below = [F.when(upto > 0, h).otherwise(F.lit(0).cast("long")) for h in _hash(seeds, upto)]
    return df.withColumns({n: F.col(p).bitwiseXOR(h) for n, p, h in zip(names, ("px", "py"), below, strict=True)})


def _blocks(turns: DataFrame, seeds: tuple[int, int]) -> DataFrame:
    """``conv_id, block, filled, t0.., px, py``: the blocks of conversations, each with the key of the node before it."""
    placed = turns.select("conv_id", F.floor((F.col("pos") - 1) / WIDTH).alias("block"), ((F.col("pos") - 1) % WIDTH).alias("slot"), "turn_id")
    columns = [F.max(F.when(F.col("slot") == i, F.col("turn_id"))).alias(f"t{i}") for i in range(WIDTH)]
    blocks = settle(placed.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("filled"), *columns))
    longer = blocks.where("block > 0").select("conv_id").distinct()
    if longer.isEmpty():
        return blocks.withColumns({p: F.lit(0).cast("long") for p in ("px", "py")})
    one, two = _hash(seeds, F.lit(WIDTH))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.join(longer, "conv_id", "left_semi").select("conv_id", "block", one.alias("hx"), two.alias("hy")).repartitionByRange(parts, "conv_id", "block")
    dealt = settle(dealt.withColumn("slice", F.spark_partition_id()))
    prior = _before(dealt, "conv_id", "block", {"px": F.col("hx"), "py": F.col("hy")}, F.bit_xor, lambda a, b: a.bitwiseXOR(b)).select("conv_id", "block", "px", "py")
    zero = F.lit(0).cast("long")
    own = blocks.join(prior, ["conv_id", "block"], "left")
    return settle(own.withColumns({p: F.coalesce(p, zero) for p in ("px", "py")}))


def _rolled(df: DataFrame, sums: str) -> DataFrame:
    """``sums`` over all prefixes of all blocks: one ROLLUP, with ``level``, the turns of the prefix, and ``last``, the last of these."""
    ids = ", ".join(f"t{i}" for i in range(WIDTH))
    level = f"{WIDTH} - bit_count(grouping_id()) AS level"
    rolled = df.sparkSession.sql(f"SELECT block, px, py, {ids}, {level}, {sums} FROM {{df}} GROUP BY block, px, py, ROLLUP ({ids})", df=df)
    last = F.get(F.array(*[f"t{i}" for i in range(WIDTH)]), F.col("level").cast("int") - 1)
    return rolled.withColumn("last", last).where("level = 0 or last is not null")  # shorter rows have no turn at greater lengths


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of each node's list, whose pieces come sorted; only the open digest is held."""
    key, digest = None, None
    for batch in batches:
        out: list[tuple] = []
        for kx, ky, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
            if key == (kx, ky):
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((*key, digest.hexdigest()))
            key, digest = (kx, ky), hashlib.sha256(ids.encode())
        yield _digests(out)
    if key is not None:
        yield _digests([(*key, digest.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kx, ky, text = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict({"kx": np.array(kx, np.int64), "ky": np.array(ky, np.int64), "ends_sha256": pa.array(text, pa.string())})


def _subtrees(nodes: DataFrame, scratch: Scratch, seeds: tuple[int, int]) -> DataFrame:
    """``kx, ky, leaves, saved`` over the subtrees of the nodes that several conversations share, the root, ``(0, 0)``, included."""
    out, carried = [], None
    last = nodes.agg(F.max("block")).first()[0]
    for block in range(-1 if last is None else last, -1, -1):
        rows = nodes.where(F.col("block") == block)
        if carried is not None:
            more = carried.select(*KEY, F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
            rows = rows.join(more, KEY, "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")})
        rolled = scratch.settle(_keyed(_rolled(rows, "sum(leaves) AS leaves, sum(saved) AS saved"), seeds, F.col("level")).select(*KEY, "level", "leaves", "saved"))
        out.append(rolled.where("level > 0"))
        carried = rolled.where("level = 0")
    if carried is None:
        return nodes.select(*KEY, "leaves", "saved")
    for more in out:
        carried = carried.union(more)
    return carried.select(*KEY, "leaves", "saved")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations ``turns(conv_id, pos, turn_id)``, as :func:`numbered` gives them, one row for each.

    A node is a distinct sequence of first turns; its members are the conversations ``members(conv_id)`` that begin with it, all of them those
    of the root, even those without turns. Returned are ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree, which includes its top), ``saved_tokens`` (over the subtree, the
    bytes of each node's last text for each member but one) and ``ends_sha256``, of the ids, joined by commas, of the members that end there.
    No conversations give no nodes. Rounds grow with the longest sequence that two conversations share, ``WIDTH`` turns to each.
    """
    spark, seeds = turns.sparkSession, (secrets.randbits(62), secrets.randbits(62))
    scratch, zero = Scratch(spark), F.lit(0).cast("long")
    turns = settle(turns)
    members = settle(members.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct())
    blocks = _blocks(turns, seeds)
    nodes = _rolled(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id").where("level > 0")
    nodes = _keyed(_keyed(nodes, seeds, F.col("level")), seeds, F.col("level") - 1, ["ax", "ay"]).withColumn("bytes", F.substring_index("last", ":", -1).cast("long")).drop("last")
    nodes = settle(nodes)

    children = settle(nodes.groupBy(F.col("ax").alias("kx"), F.col("ay").alias("ky")).agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")))
    shared = nodes.where("n_convs > 1").join(children, KEY, "left")
    leaves = F.when(F.col("n_children").isNull(), F.lit(1).cast("long")).otherwise(F.col("single"))
    sums = _subtrees(scratch.settle(shared.withColumns({"leaves": leaves, "saved": (F.col("n_convs") - 1) * F.col("bytes")})), scratch, seeds)

    ended = _keyed(blocks, seeds, F.col("filled")).groupBy("conv_id").agg(F.max(F.struct("block", *KEY)).alias("end"))
    ended = members.join(ended, "conv_id", "left").select("conv_id", *[F.coalesce(f"end.{k}", zero).alias(k) for k in KEY])
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    pieces = ended.groupBy(*KEY, F.shiftright("conv_id", RANGE_BITS).alias("range")).agg(ids)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids").mapInArrow(_ends, "kx long, ky long, ends_sha256 string")

    root = members.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(zero.alias("kx"), zero.alias("ky"), F.lit(None).cast("long").alias("ax"), F.lit(None).cast("long").alias("ay"), zero.alias("depth"), "n_convs", "conv_id")
    depth = (F.col("block") * WIDTH + F.col("level")).cast("long")
    every = settle(nodes.select(*KEY, "ax", "ay", depth.alias("depth"), "n_convs", "conv_id").union(root))
    parents = every.select(F.col("kx").alias("ax"), F.col("ky").alias("ay"), F.col("conv_id").alias("parent_conv_id"))
    out = every.join(children, KEY, "left").join(sums, KEY, "left").join(ends, KEY, "left").join(parents, ["ax", "ay"], "left")
    above = F.when(F.col("depth") == 0, F.coalesce("single", F.lit(1))).otherwise(zero)  # the root's own, which no ROLLUP has seen
    n_leaves = F.when(F.col("depth") == 0, F.coalesce("leaves", zero) + above).when(F.col("n_convs") == 1, 1).otherwise(F.col("leaves"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), n_leaves.cast("long").alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
