"""MinHash near-dedup with fast similarity sketching, banding and exact verification.

A sketch has a fixed number of coordinates. In each round every shingle of a document is hashed to a coordinate and a value, and a
coordinate keeps the least (round, value) that it gets; rounds go on only until all coordinates are filled. From round t on, round t + j
sends every shingle to coordinate j, so the last is filled after 2t rounds at most. Equal coordinates estimate the Jaccard similarity with
the concentration of independent samples, at a cost of about one hash for a shingle.

Documents with equal shingle sets are one class. Classes that agree on a whole band of coordinates are candidates: first each with the
smallest of its bucket, which only their sizes can rule out, then, where a bucket's members still lie in several components, all pairs
between those components that a longer sketch leaves. Every link is confirmed on the full sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, small
from tidemark.llm.components import components
from tidemark.llm.textbytes import KeyedHasher, chunks, draw, lowered, mix64, runs

#: Coordinates of a sketch. Bands of five coordinates from a similarity of 0.85 on, else of four: a pair just similar enough misses all of
#: them once in two million times at 0.85, once in twenty million at 0.8.
COORDINATES = 128
#: A pair between components is not read if its finer sketches differ in more bits than a pair just similar enough would, by so many
#: standard deviations: fewer than one such pair in a million is not read, about as many as banding misses.
DEVIATIONS = 5.0
#: Bits of the finer sketches that pairs between components are held against.
FINE = 2048
#: Members of a bucket that are held against as many others at once, and documents that are read beside one copy of another's text.
CHUNK, GROUP = 4096, 256
#: The most ids (8 bytes each) that are broadcast.
MAX_IDS = 500_000
_SEEDS = mix64(np.arange(1, 2 * FINE + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_FACTOR = np.uint64(0xA0761D6478BD642F)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int = 5, base: int = 0x9E3779B97F4A7C1) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each distinct shingle of a chunk, in order. Texts end in white space of their own.

    A text with fewer words than ``width`` has its whole sequence as its only shingle; one without words has none.
    """
    data = lowered(data)
    starts, ends = runs(~((data == 32) | ((data >= 9) & (data <= 13))))
    of = np.searchsorted(bounds, starts, "right") - 1
    words = KeyedHasher(data, base)(starts, ends)
    at = np.flatnonzero(of[width - 1 :] == of[: len(of) - width + 1]) if len(of) >= width else np.empty(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    for k in range(width):
        h = mix64(h * _FACTOR + words[at + k])
    docs, hashes = [of[at]], [h]
    n_words = np.bincount(of, minlength=len(bounds) - 1)
    first = np.cumsum(n_words) - n_words
    for n in range(1, width):
        short = np.flatnonzero(n_words == n)
        h = np.full(len(short), n, np.uint64)
        for k in range(n):
            h = mix64(h * _FACTOR + words[first[short] + k])
        docs.append(short)
        hashes.append(h)
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def sketches(doc: np.ndarray, h: np.ndarray, n: int, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches of ``n`` sets given as (set, hash); ``t`` is a power of two. Rows of empty sets stay at the largest value."""
    s = np.full(n * t, np.iinfo(np.uint64).max, np.uint64)
    shift = np.uint64(64 - (t.bit_length() - 1))
    for i in range(2 * t):
        g = mix64(h ^ _SEEDS[i])
        coordinate = (g >> shift).astype(np.int64) if i < t else np.full(len(g), i - t)
        value = (np.uint64(i) << np.uint64(48)) | (g & np.uint64((1 << 48) - 1))
        np.minimum.at(s, doc * t + coordinate, value)
        if t <= COORDINATES or i % 16 == 15:  # more rounds than needed change nothing
            live = (s.reshape(n, t) == np.iinfo(np.uint64).max).any(1)[doc]
            doc, h = doc[live], h[live]
            if not len(doc):
                break
    return s.reshape(n, t)


def _one_bit(s: np.ndarray) -> np.ndarray:
    return np.packbits((s & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)


def _band_rows(percent: int) -> int:
    return 5 if percent >= 85 else 4


def _features(width: int, rows: int, base: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document the size and two hashes of its shingle set and a key for each band."""
    for batch in batches:
        for first, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            n = len(bounds) - 1
            doc, h = shingle_sets(data, bounds, width, base)
            size = np.bincount(doc, minlength=n)
            sums = np.zeros((2, n), np.uint64)
            np.add.at(sums[0], doc, mix64(h))
            np.add.at(sums[1], doc, mix64(h * _FACTOR))
            s = sketches(doc, h, n)
            bands = COORDINATES // rows
            keys = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], n, 0)
            for k in range(rows):
                keys = mix64(keys * _FACTOR + s[:, k : bands * rows : rows])
            columns = {
                "doc_id": batch.column("doc_id").slice(first, n), "tx": batch.column("tx").slice(first, n), "n": size, "f0": sums[0].view(np.int64), "f1": sums[1].view(np.int64),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel())),
            }
            yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _confirm(width: int, percent: int, base: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of groups that come sorted, each the text of one document (``role`` 0) and then those that it is held against, by full sets."""
    head, hub = None, np.empty(0, np.uint64)
    for batch in batches:
        a, cid, role = (batch.column(c).to_numpy() for c in ("a", "cid", "role"))
        for first, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            n = len(bounds) - 1
            doc, h = shingle_sets(data, bounds, width, base)
            edge = np.searchsorted(doc, np.arange(n + 1))
            heads = np.flatnonzero(role[first : first + n] == 0)
            for lo, hi in zip([0, *heads], [*heads, n], strict=True):
                if lo < hi and role[first + lo] == 0:
                    head, hub = a[first + lo], h[edge[lo] : edge[lo + 1]]
                    lo += 1
                if lo >= hi or not len(hub):
                    continue
                own = h[edge[lo] : edge[hi]]
                met = hub[np.minimum(np.searchsorted(hub, own), len(hub) - 1)] == own
                shared = np.bincount(doc[edge[lo] : edge[hi]][met] - lo, minlength=hi - lo)
                linked = (100 * shared >= percent * (np.diff(edge[lo : hi + 1]) + len(hub) - shared)) & (shared > 0)
                if linked.any():
                    found = cid[first + lo : first + hi][linked]
                    yield pa.RecordBatch.from_pydict({"a": np.full(len(found), head), "b": found})


def _fine(width: int, base: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A longer one-bit sketch of each text."""
    for batch in batches:
        for first, data, bounds in chunks((t.as_py() for t in batch.column("text")), b"", b"\n"):
            n = len(bounds) - 1
            for at in range(0, n, 64):
                own = slice(at, min(n, at + 64))
                lo, hi = bounds[own.start], bounds[own.stop]
                doc, h = shingle_sets(data[lo:hi], bounds[own.start : own.stop + 1] - lo, width, base)
                bits = _one_bit(sketches(doc, h, own.stop - own.start, FINE))
                words = {f"f{i}": np.ascontiguousarray(bits[:, i]) for i in range(FINE // 64)}
                yield pa.RecordBatch.from_pydict({"cid": batch.column("cid").slice(first + at, own.stop - own.start), **words})


def _most_bits(percent: int, bits: int) -> int:
    """Differing bits, of so many, beyond which a link is ruled out."""
    p = (1 - percent / 100) / 2
    return int(bits * (p + DEVIATIONS * (p * (1 - p) / bits) ** 0.5))


def _fitting(x, y, percent: int):
    """Sizes leave a link possible."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


UNIT = ("key", "a", "b")


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {c: batch.column(c).to_numpy() for c in (*UNIT, "chunk", "band", "cid", "n", "comp")}
    out["fine"] = np.column_stack([batch.column(f"f{i}").to_numpy() for i in range(FINE // 64)]).view(np.uint64)
    out["bands"] = batch.column("bands").flatten().to_numpy().reshape(batch.num_rows, -1)
    return out


def _unit(percent: int, u: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
    """Pairs between components within one chunk of a bucket, or between two, that the longer sketches leave. A pair that
    met in an earlier band is left to that one."""
    comp, n, band = u["comp"], u["n"], int(u["band"][0])
    x = np.flatnonzero(u["chunk"] == u["a"][0])
    y = x if u["a"][0] == u["b"][0] else np.flatnonzero(u["chunk"] == u["b"][0])
    if not len(x) or not len(y) or (comp == comp[0]).all():
        return
    for at in range(0, len(x), 128):
        i = x[at : at + 128]
        bits = np.zeros((len(i), len(y)), np.uint16)
        for w in range(u["fine"].shape[1]):
            bits += np.bitwise_count(u["fine"][i, w][:, None] ^ u["fine"][y, w][None, :])
        near = (bits <= _most_bits(percent, FINE)) & (comp[i][:, None] != comp[y][None, :])
        near &= np.minimum(n[i][:, None], n[y][None, :]) * 100 >= np.maximum(n[i][:, None], n[y][None, :]) * percent
        if x is y:
            near &= i[:, None] < y[None, :]
        p, q = np.nonzero(near)
        p, q = i[p], y[q]
        new = ~(u["bands"][p, :band] == u["bands"][q, :band]).any(1)
        yield np.stack([u["cid"][p], u["cid"][q]])[:, new]


def _across(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All units of a partition, which come sorted; one that goes on in the next batch waits for it."""
    held: dict[str, np.ndarray] | None = None
    for batch in _and_end(batches):
        rows = None if batch is None else _arrays(batch)
        if held is not None:
            rows = held if rows is None else {c: np.concatenate([held[c], v]) for c, v in rows.items()}
        if rows is None or not len(rows["key"]):
            continue
        new = np.zeros(len(rows["key"]), bool)
        for c in UNIT:
            new[1:] |= rows[c][1:] != rows[c][:-1]
        cuts = [0, *np.flatnonzero(new), len(new)]
        if batch is not None:
            held = {c: v[cuts[-2] :] for c, v in rows.items()}
            cuts.pop()
        pairs = [found for lo, hi in zip(cuts, cuts[1:], strict=False) for found in _unit(percent, {c: v[lo:hi] for c, v in rows.items()})]
        if pairs:
            a, b = np.concatenate(pairs, 1)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _source(doc_id, tx):
    """Where a class's text is found again: by the id, or without one by the text's hash, and by that hash."""
    return F.coalesce(doc_id, tx)


def _texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``cid, text`` of the classes in ``wanted(cid)``."""
    rows = classes.select("cid", _source(F.col("rep"), F.col("tx")).alias("from"), F.col("tx").alias("hash")).join(small(settle(wanted.distinct()), MAX_IDS), "cid", "left_semi")
    tx = F.xxhash64("text")
    texts = docs.join(small(settle(rows), MAX_IDS), (_source(F.col("doc_id"), tx) == F.col("from")) & (tx == F.col("hash")))
    return settle(texts.groupBy("cid").agg(F.first("text").alias("text")))


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, base: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose full sets link.

    Pairs are read in groups of at most about ``GROUP`` with the same ``a``, whose text is sent once for each group.
    """
    pairs = settle(pairs)
    texts = _texts(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")), classes, docs)
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups"))
    heads = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.col("a").alias("cid"), F.lit(0).alias("role"))
    others = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("group"), F.col("b").alias("cid"), F.lit(1).alias("role"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = heads.union(others).join(texts, "cid").repartition(parts, "a", "group").sortWithinPartitions("a", "group", "role")
    return settle(rows.select("a", "cid", "role", "text").mapInArrow(partial(_confirm, width, percent, base), "a long, b long"))


def _judged(docs: DataFrame, percent: int, width: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, tx, n, class, component``: of each row the text's hash, the size of its set, its component of sets and that one's least id."""
    rows, base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), draw()
    schema = "doc_id long, tx long, n long, f0 long, f1 long, bands array<long>"
    known = settle(rows.withColumn("tx", F.xxhash64("text")).mapInArrow(partial(_features, width, _band_rows(percent), base), schema))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tx", "bands")).alias("r")
    classes = known.where("n > 0").groupBy("n", "f0", "f1").agg(first)
    classes = settle(classes.select("n", "f0", "f1", F.xxhash64("f0", "f1", "n").alias("cid"), F.col("r.doc_id").alias("rep"), "r.tx", "r.bands"))

    banded = classes.select(F.posexplode("bands").alias("band", "key"), F.struct(F.col("rep").isNull().alias("none"), "rep", "cid", "n").alias("m"))
    hubs = settle(banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("m").alias("hub")).where("members > 1").drop("members"))
    members = settle(banded.join(hubs, "key").select("key", "band", "m.cid", "m.n", "hub"))
    near = members.where((F.col("cid") != F.col("hub.cid")) & _fitting(F.col("n"), F.col("hub.n"), percent))
    links = _links(near.select(F.col("hub.cid").alias("a"), F.col("cid").alias("b")).distinct(), classes, rows, width, percent, base)

    reached = components(links)
    placed = members.join(reached, members.cid == reached.node, "left").select(
        "key", "band", "cid", "n", (F.col("cid") == F.col("hub.cid")).alias("is_hub"), F.coalesce("component", "cid").alias("comp")
    )
    placed = settle(placed)
    several = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    rest = settle(placed.where("not is_hub").join(settle(several.where("lo < hi").select("key", "chunks")), "key"))
    fine = settle(_texts(rest.select("cid"), classes, rows).mapInArrow(partial(_fine, width, base), "cid long, " + ", ".join(f"f{i} long" for i in range(FINE // 64))))
    fine = settle(fine.join(classes.select("cid", "bands"), "cid"))
    rest = rest.join(fine, "cid").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, "chunk").alias("a"), F.greatest(c, "chunk").alias("b")))
    units = rest.withColumn("pair", F.explode(others)).select("*", "pair.a", "pair.b").drop("pair", "is_hub", "chunks")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(parts, *UNIT).sortWithinPartitions(*UNIT)
    more = units.mapInArrow(partial(_across, percent), "a long, b long")
    found = links.union(_links(more.distinct(), classes, rows, width, percent, base))

    reached = components(found)
    linked = classes.select("cid", "rep").join(reached, F.col("cid") == F.col("node")).select("cid", "rep", "component")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    linked = settle(linked.join(least, "component").select(F.col("cid").alias("node"), "component", "least"))
    named = classes.join(linked, F.col("cid") == F.col("node"), "left")
    named = settle(named.select("n", "f0", "f1", F.coalesce("component", "cid").alias("class"), F.coalesce("least", "rep").alias("component")))
    out = known.select("doc_id", "tx", "n", "f0", "f1").join(named, ["n", "f0", "f1"], "left")
    return out.select("doc_id", "tx", "n", "class", F.coalesce("component", "doc_id").alias("component"))


def near_text(docs: DataFrame, percent: int = 80, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Words are what white space parts, A-Z in lower case; a document's set is its distinct shingles of ``width`` words. Documents link if
    the sets share ``percent`` of their union or more; a component's id is the smallest ``doc_id`` in it, and ``kept`` marks the document
    with that id. Null, empty and white-space texts have no shingles and link with nothing. Rows without an id link like others, but are not
    kept; a component of such rows alone has a null id. Rows that share an id are each judged by their own text. Other columns are ignored,
    whatever their names; no rows give no rows.
    """
    judged = _judged(docs, percent, width, doc_id, text)
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False))
    return judged.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def drop_near_text(docs: DataFrame, percent: int = 80, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each component, and those that link with nothing.

    The row with the least id stays, of equal ids the one with the least hash of its text, and rows without ids come last. Rows that share an
    id but not a component all stay; of rows alike in id and text one does, if they have any words.
    """
    judged = settle(_judged(docs, percent, width, doc_id, text).where("n > 0"))
    none = F.lit(-(2**63))
    key, row = F.coalesce("doc_id", none), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tx")
    stays = judged.groupBy("class").agg(F.min(row).alias("one"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    grouped = judged.join(stays, "class").select(key.alias("key"), "tx", (row == F.col("one")).alias("stays"))
    counted = settle(grouped.groupBy("key", "tx", "stays").agg(F.count(F.lit(1)).alias("rows")))
    gone, repeated = settle(counted.where("not stays").select("key", "tx")), settle(counted.where("stays and rows > 1").select("key", "tx"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), none).alias("key"), F.xxhash64(f"`{text}`").alias("tx"))
    left = rows.join(small(gone, MAX_IDS), ["key", "tx"], "left_anti")
    if not repeated.isEmpty():
        several = small(repeated, MAX_IDS)
        left = left.join(several, ["key", "tx"], "left_anti").unionByName(left.join(several, ["key", "tx"], "left_semi").dropDuplicates(["key", "tx"]))
    return left.select("row.*")
