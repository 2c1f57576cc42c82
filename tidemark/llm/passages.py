"""Substring dedup on words by prefix-partitioned suffix trees: windows of words that also start earlier in the corpus.

A suffix is the words from some place of a document on. Its leaf stands below a node of ``WINDOW`` words or deeper with all suffixes that share
its window, and all of them but the earliest repeat it. The trees are grown in pieces that fit a task:

1. Only repeats need a tree. Each window is given to the anchor among its places, the least rank of ``GRAM`` words; the windows of one anchor
   are a stretch. Stretches whose anchor's rank occurs once are dropped. Stretches that are alike from end to end are one leaf with many
   places: all but its earliest place repeat it in all their windows. Counts are aggregated before they are shuffled.
2. Of leaves that share a rank with other leaves the earliest places go on, as the suffixes that start in them, cut at the depth that counts.
   They are split by variable-length prefixes: the first of ``PREFIXES`` words whose group has at most ``GROUP`` suffixes.
3. Each group is sorted, which is the order of its tree's leaves; the words that neighbours share are the depths of its internal nodes. Below
   a node of ``WINDOW`` words, all leaves but the earliest repeat their window. A group that is too large even at a whole window is one node:
   its earliest place is a minimum, and no task holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, settle
from tidemark.llm.textbytes import KeyedHasher, chunks, draw, mix64, runs, trim

#: Words of a window and of an anchor's rank; places of a window among which one is the anchor.
WINDOW, GRAM = 20, 6
SPREAD = WINDOW - GRAM + 1
#: Words of the prefixes that split suffixes, and the most suffixes of one subtree.
PREFIXES, GROUP = (10, 15, WINDOW), 1 << 15
_FACTOR = np.uint64(0xA0761D6478BD642F)
KEYS = ["k0", "tx"]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _FACTOR + b)


class _Words:
    """The words of a chunk of texts, each followed by one space, and where each starts and ends; equal bytes are equal words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        space = (data == 32) | ((data >= 9) & (data <= 13))
        starts, ends = runs(~space)
        kept = ~space
        kept[ends] = True  # texts end in white space of their own
        self.bytes = np.where(space, np.uint8(32), data)[kept]
        self.end = np.cumsum(ends - starts + 1) - 1
        self.start = self.end - (ends - starts)
        self.doc = np.searchsorted(bounds, starts, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(bounds)))  # of each text


def _anchors(bases: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of windows with one anchor: the anchor's rank, the name of all their words, and the place, in words, and number of windows."""
    for batch in batches:
        key0, key1 = batch.column("k0").to_numpy(), batch.column("tx").to_numpy()
        for at, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            w = _Words(data, bounds)
            n = len(w.doc) - WINDOW + 1
            if n <= 0:
                continue
            one, two = KeyedHasher(w.bytes, bases[0]), KeyedHasher(w.bytes, bases[1])
            rank = one(w.start[: n + SPREAD - 1], w.end[GRAM - 1 :])
            low = np.uint64((1 << max(20, len(rank).bit_length())) - 1)
            least = (rank & ~low) | np.arange(len(rank), dtype=np.uint64)
            for step in (1, 2, 4, SPREAD - 8):  # of the next 2, 4, 8 and all ranks
                least = np.minimum(least[:-step], least[step:])
            s = np.flatnonzero(w.doc[:n] == w.doc[WINDOW - 1 :])
            if not len(s):
                continue
            q = (least[:n][s] & low).astype(np.int64)
            new = np.ones(len(s), bool)
            new[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1] + 1)
            first = np.flatnonzero(new)
            lo, many, q = s[first], np.diff(np.append(first, len(s))), q[first]
            shape = ((q - lo) * 256 + many).astype(np.uint64)
            begin, end = w.start[lo], w.end[lo + many + WINDOW - 2]
            own = at + w.doc[lo]
            yield pa.RecordBatch.from_pydict({
                "rank": rank[q].view(np.int64), "whole": _pair(_pair(one(begin, end), shape), two(begin, end)).view(np.int64),
                "k0": key0[own], "tx": key1[own], "info": (lo - w.first[w.doc[lo]]) << 8 | many,
            })
    trim()


def _suffixes(base: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes that start in the stretches ``found`` of each text, and hashes of their prefixes."""
    for batch in batches:
        lists = batch.column("found")
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        for at, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            w, n = _Words(data, bounds), len(bounds) - 1
            info = flat[offsets[at] : offsets[at + n]]
            text = np.repeat(np.arange(n), np.diff(offsets[at : at + n + 1]))
            many = info & 255
            which = np.repeat(np.arange(len(info)), many)
            start = (info >> 8)[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            word = start + w.first[text][which]
            h = KeyedHasher(w.bytes, base)
            for lo in range(0, len(word), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                i, own = word[part], pa.array(at + text[which[part]])
                raw = w.bytes.tobytes() if lo == 0 else raw
                words = pa.array([raw[a:b] for a, b in zip(w.start[i].tolist(), w.end[i + WINDOW - 1].tolist(), strict=True)], pa.binary())
                columns = {c: batch.column(c).take(own) for c in KEYS} | {"start": start[part], "words": words}
                yield pa.RecordBatch.from_pydict(columns | {f"p{p}": h(w.start[i], w.end[i + p - 1]).view(np.int64) for p in PREFIXES})
    trim()


def _shared(a: bytes, b: bytes) -> int:
    """How many words two sequences begin with in common."""
    if a == b:
        return a.count(b" ") + 1
    n = 0
    for x, y in zip(a.split(b" "), b.split(b" "), strict=False):
        if x != y:
            break
        n += 1
    return n


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves below the deep nodes of each group's tree, but for the earliest of each. Rows come sorted by group, words and place, so a node's
    leaves follow one another, its earliest place first, and only the last leaf is held."""
    key, last = None, b""
    for batch in batches:
        out: list[tuple] = []
        for own, words, *place in zip(*[batch.column(c).to_pylist() for c in ("key", "words", *KEYS, "start")], strict=True):
            if own == key and _shared(last, words) >= WINDOW:
                out.append(tuple(place))
            key, last = own, words
        yield _ranges(out)


def _ranges(places: list[tuple]) -> pa.RecordBatch:
    k0, tx, start = (np.array(c, np.int64) for c in zip(*places, strict=True)) if places else [np.empty(0, np.int64)] * 3
    return pa.RecordBatch.from_pydict({"k0": k0, "tx": tx, "found": start << 8 | 1})


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document once the words under its windows are gone."""
    for batch in batches:
        lists = batch.column("found")
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for at, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            w, n = _Words(data, bounds), len(bounds) - 1
            info = flat[offsets[at] : offsets[at + n]]
            lo = (info >> 8) + w.first[np.repeat(np.arange(n), np.diff(offsets[at : at + n + 1]))]
            step = np.zeros(len(w.doc) + 1, np.int64)
            np.add.at(step, lo, 1)
            np.add.at(step, lo + (info & 255) + WINDOW - 1, -1)
            gone = np.cumsum(step)[:-1] > 0
            size = w.end - w.start + 1
            left = np.where(gone, 0, size)
            kept = w.bytes[np.repeat(~gone, size)].tobytes()
            edge = np.concatenate([[0], np.cumsum(left)])[w.first]
            texts = [kept[a : max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            counts = np.diff(w.first)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id").slice(at, n), "n_words": counts, "n_removed": removed,
                "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts], "kept": pa.array(texts, pa.binary()),
            })
    trim()


def _repeated(docs: DataFrame) -> tuple[DataFrame, list[Scratch]]:
    """``k0, tx, found``: windows that also start earlier, as place in words and number (8 bits), for ``docs(k0, tx, text)``.

    Tables on the way are deleted once nothing reads them; those that the result reads are returned.
    """
    bases, place = (draw(), draw()), F.struct(*KEYS, "info")
    early, middle, late = (Scratch(docs.sparkSession) for _ in range(3))
    anchors = early.settle(docs.mapInArrow(partial(_anchors, bases), "rank long, whole long, k0 long, tx long, info long"))
    ranks = early.settle(anchors.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank"))  # a join of tables splits hot ranks
    met = middle.settle(anchors.join(ranks, "rank", "left_semi"))
    early.drop()
    leaves = middle.settle(met.groupBy("rank", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one")))
    copies = late.settle(met.join(leaves.where("n > 1"), ["rank", "whole"]).where(place != F.col("one")).select(*KEYS, F.col("info").alias("found")))

    several = middle.settle(leaves.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank"))
    wanted = leaves.join(several, "rank", "left_semi").select("one.*").groupBy(*KEYS).agg(F.collect_list("info").alias("found"))
    rows = "k0 long, tx long, start long, words binary, " + ", ".join(f"p{p} long" for p in PREFIXES)
    rest = late.settle(docs.join(wanted, KEYS).select(*KEYS, "text", "found").mapInArrow(partial(_suffixes, bases[1]), rows))
    middle.drop()
    found, groups = [copies], []
    for words in PREFIXES:
        large = late.settle(rest.groupBy(f"p{words}").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select(f"p{words}"))
        keyed = lambda df: df.select(F.col(f"p{words}").alias("key"), "words", *KEYS, "start")  # noqa: B023, E731
        if large.isEmpty():
            groups.append(keyed(rest))
            break
        groups.append(keyed(rest.join(large, f"p{words}", "left_anti")))
        rest = rest.join(large, f"p{words}", "left_semi")
    else:  # nodes of a whole window with more leaves than a task takes
        leaf = F.struct(*KEYS, "start")
        least = rest.groupBy("words").agg(F.min(leaf).alias("one"))
        found.append(rest.join(least, "words").where(leaf != F.col("one")).select(*KEYS, F.shiftleft("start", 8).bitwiseOR(F.lit(1)).alias("found")))
    suffixes = groups[0]
    for more in groups[1:]:
        suffixes = suffixes.union(more)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "words", *KEYS, "start"]
    found.append(suffixes.repartition(parts, "key").sortWithinPartitions(*order).mapInArrow(_subtrees, "k0 long, tx long, found long"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out, [late]


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for each row of ``docs``; ``kept`` are the words that stay, joined by one space, as bytes.

    Words are what white space parts, unchanged. Removed is each word under a window of ``WINDOW`` words whose sequence also starts earlier:
    in a document of smaller id, or before it in the same one. Windows never cross documents, are judged on the input, and overlaps count.
    Null texts have no words; shorter texts than a window lose nothing. Null ids are the smallest; of different texts with one id the order is
    that of a hash; rows alike in id and text are one document, given once for each. Other columns are ignored, whatever their names; no
    rows give no rows. ``docs`` must give the same rows each time it is read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = rows.select("id", F.coalesce("id", F.lit(-(2**63))).alias("k0"), F.xxhash64("text").alias("tx"), "text")
    repeated, held = _repeated(rows.select(*KEYS, "text"))
    found = settle(repeated.groupBy(*KEYS).agg(F.collect_set("found").alias("found")))
    for scratch in held:
        scratch.drop()
    joined = rows.join(found, KEYS, "left").select("id", "text", F.coalesce("found", F.array().cast("array<long>")).alias("found"))
    out = joined.mapInArrow(_keep, "id long, n_words long, n_removed long, kept_sha256 string, kept binary")
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept")
