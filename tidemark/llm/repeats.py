"""Suffix-array dedup: bytes covered by a string of a given length that starts anywhere else in the corpus.

Doubling over a sample of positions. A rank stands for the bytes from a position on: equal ranks, equal bytes. Within a chunk of text a rolling
hash gives ranks of ``FIRST`` bytes, half of a repeat, at once. From there on Spark sorts: it brings pairs of ranks together, of a position and
of the one at an offset, drops what is unique and passes on what is not, until it is past the threshold. What is called repeated has equal
hashes under two bases that are drawn for the run, so no text can be made to look like another's.

1. Positions are anchors: from every place, the least of the next ``SPREAD`` ranks of ``FIRST`` bytes, so that both ends of a repeat choose
   alike and every string of the full length holds one. Unique ranks are dropped. The strings with one anchor lie together as a stretch; one
   whose bytes from end to end occur twice is past the threshold in all its strings.
2. Stretches that are left, which are those around the ends of repeats, are cut into blocks of ``BLOCK`` places, alike from their anchors. A
   block's pair of ranks, at offset ``INNER - FIRST``, covers what all its strings share: unique pairs are dropped, and blocks whose bytes from
   end to end occur twice are past the threshold.
3. Every place of the blocks that are left: pairs of ranks at offset ``LENGTH - FIRST`` cover the whole string, in 122 bits.

A stretch or block that is past the threshold tells the others of its rank, which one of each kind goes on to do. Hot passages: of equal
stretches in a task's text one is sent to where they meet, marked, and the others go elsewhere; counts of pairs are aggregated before they
are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import settle
from tidemark.llm.textbytes import CHUNK_BYTES, KeyedHasher, chunks, draw, mix64, runs, trim

#: Bytes of a repeat and of a first rank; places among which one is the anchor; places of a block and the bytes that all its strings share.
LENGTH, FIRST, SPREAD, BLOCK = 200, 100, 100, 10
INNER = LENGTH - BLOCK + 1
#: Ranks known to be repeated that a task remembers from its earlier chunks (8 bytes each).
REMEMBERED = 1 << 18
#: States of a stretch: as it is; its rank is known to be repeated, and it is sent to tell others or goes elsewhere; so are all its bytes,
#: and it tells others, goes elsewhere or tells only those with the same bytes.
PLAIN, TELLS, FOUND, TELLS_PAST, FOUND_PAST, KIND_PAST = range(6)
#: Bases of hashes, where none are drawn.
BASES = (0x9E3779B97F4A7C1, 0xD6E8FEB86659FD9)
_FACTOR = np.uint64(0xA0761D6478BD642F)
KEYS = ["k0", "tx"]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _FACTOR + b)


class _Stretches:
    """Anchors of a chunk of documents, each with the stretch of strings that have it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, bases: tuple[int, int]):
        size = len(data)
        h, h2 = KeyedHasher(data, bases[0]), KeyedHasher(data, bases[1])
        rank = h.grams(FIRST) if size >= FIRST else np.empty(0, np.uint64)
        starts = np.flatnonzero(np.arange(size) + LENGTH <= np.repeat(bounds[1:], np.diff(bounds)))  # of strings of the full length
        low = np.uint64((1 << max(20, size.bit_length())) - 1)
        key = np.full(-(-max(1, size) // SPREAD) * SPREAD + SPREAD, np.iinfo(np.uint64).max)
        key[: len(rank)] = (rank & ~low) | np.arange(len(rank), dtype=np.uint64)
        blocks = key.reshape(-1, SPREAD)
        ahead = np.minimum.accumulate(blocks, 1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(behind[:size], ahead[SPREAD - 1 : SPREAD - 1 + size])
        q = (least & low).astype(np.int64)[starts]  # for each string, where its anchor is
        new = np.ones(len(q), bool)
        new[1:] = q[1:] != q[:-1]
        first = np.flatnonzero(new)
        self.lo, self.many, q = starts[first], np.diff(np.append(first, len(q))), q[first]
        self.lead, self.rank = q - self.lo, rank[q]
        end = self.lo + self.many - 1 + LENGTH
        self.whole = _pair(_pair(h(self.lo, end), (self.lead * 256 + self.many).astype(np.uint64)), h2(self.lo, end))
        self.doc = np.searchsorted(bounds, self.lo, "right") - 1


def _states(rank: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """States of a chunk's stretches: of those alike in rank and bytes, or in rank alone, one tells and the others are found."""
    _, heads, inverse, count = np.unique(rank, return_index=True, return_inverse=True, return_counts=True)
    state, heads = np.where(count[inverse] > 1, FOUND, PLAIN), heads[count > 1]
    _, index, inverse, count = np.unique(_pair(rank, whole), return_index=True, return_inverse=True, return_counts=True)
    state[count[inverse] > 1] = FOUND_PAST
    state[index[count > 1]] = KIND_PAST
    state[heads] = np.where(state[heads] == KIND_PAST, TELLS_PAST, TELLS)
    return state


def _remember(known: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.union1d(known, new[: max(0, REMEMBERED - len(known))])


def _ask(batches: Iterator[pa.RecordBatch], bases: tuple[int, int] = BASES) -> Iterator[pa.RecordBatch]:
    """Round 1, sending: each anchor's rank and, for its stretch, the name of all bytes, the places and a state."""
    ranks = wholes = np.empty(0, np.uint64)
    for batch in batches:
        key0, key1 = batch.column("k0").to_numpy(), batch.column("tx").to_numpy()
        for first, data, bounds in chunks(t.as_py() for t in batch.column("text")):
            s = _Stretches(data, bounds, bases)
            if not len(s.lo):
                continue
            state, kind = _states(s.rank, s.whole), _pair(s.rank, s.whole)
            told, past = np.isin(s.rank, ranks), np.isin(kind, wholes)
            ranks = _remember(ranks, s.rank[((state == TELLS) | (state == TELLS_PAST)) & ~told])
            wholes = _remember(wholes, kind[((state == KIND_PAST) | (state == TELLS_PAST)) & ~past])
            state[told & (state < FOUND)] = FOUND
            state[told & (state == TELLS_PAST)] = KIND_PAST
            state[past] = FOUND_PAST
            own = first + s.doc
            info = (((s.lo - bounds[s.doc]) << 8 | s.many) << 8 | s.lead) << 3 | state
            yield pa.RecordBatch.from_pydict({"rank": s.rank.view(np.int64), "whole": s.whole.view(np.int64), "k0": key0[own], "tx": key1[own], "info": info})


def _bits(column: str, at: int, width: int):
    return F.shiftright(column, at).bitwiseAND(F.lit((1 << width) - 1))


def _met(asked: DataFrame) -> DataFrame:
    """Round 1, receiving: stretches whose rank occurs more than once, as ``k0, tx, rank, info, past, one``; ``one`` of each kind is to tell."""
    state = _bits("info", 0, 3)
    salt = F.when(state.isin(FOUND, FOUND_PAST), F.xxhash64(*KEYS, "info")).when(state == KIND_PAST, F.xxhash64("whole")).otherwise(F.lit(0))
    sent = asked.withColumn("salt", salt)
    same = Window.partitionBy("rank", "salt")
    sent = sent.withColumn("several", (F.count(F.lit(1)).over(same) > 1) | (F.max((state > PLAIN).cast("int")).over(same) == 1)).where("several")
    alike = Window.partitionBy("rank", "salt", "whole").orderBy(*KEYS, "info")
    everywhere = alike.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    past = (F.count(F.lit(1)).over(everywhere) > 1) | (F.max((state >= TELLS_PAST).cast("int")).over(everywhere) == 1)
    sent = sent.withColumn("past", past).withColumn("one", (F.row_number().over(alike) == 1) & (state != FOUND_PAST))
    return sent.select(*KEYS, "rank", F.shiftright("info", 3).alias("info"), "past", F.expr("past and one").alias("one"))


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """For each entry of the column ``found``, its row; and the entries."""
    lists = batch.column("found")
    return np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches asked for."""
    for batch in batches:
        owner, flat = _lists(batch)
        info, lo, many = flat.field("info"), flat.field("info").to_numpy() >> 17, (flat.field("info").to_numpy() >> 9) & 255
        last, data, held, size, at = -1, b"", [], 0, 0
        for i, row in enumerate(owner):
            if row != last:
                last, data = row, (batch.column("text")[int(row)].as_py() or "").encode("utf-8", "surrogatepass")
            held.append(data[lo[i] : lo[i] + many[i] - 1 + LENGTH])
            size += len(held[-1])
            if size > CHUNK_BYTES or i == len(owner) - 1:
                own = pa.array(owner[at : i + 1])
                columns = {c: batch.column(c).take(own) for c in KEYS} | {"info": info.slice(at, len(held)), "rank": flat.field("rank").slice(at, len(held))}
                yield pa.RecordBatch.from_pydict({**columns, "bytes": pa.array(held, pa.binary())})
                held, size, at = [], 0, i + 1
    trim()


class _Cuts:
    """A batch of stretches: their bytes as one array, and where each begins."""

    def __init__(self, batch: pa.RecordBatch, bases: tuple[int, int]):
        info = batch.column("info").to_numpy()
        self.info, self.lo, self.many, self.lead, self.known = info, info >> 17, (info >> 9) & 255, (info >> 1) & 255, info & 1
        self.rank, self.k0, self.tx = batch.column("rank").to_numpy().view(np.uint64), batch.column("k0").to_numpy(), batch.column("tx").to_numpy()
        held = batch.column("bytes").to_pylist()
        self.at = np.cumsum([0, *map(len, held)])[:-1]
        data = np.frombuffer(b"".join(held), np.uint8)
        self.hash, self.hash2 = KeyedHasher(data, bases[0]), KeyedHasher(data, bases[1])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    trim()


def _blocks(batches: Iterator[pa.RecordBatch], bases: tuple[int, int] = BASES) -> Iterator[pa.RecordBatch]:
    """Round 2, sending: each block's pair of ranks, the name of all its bytes and which places of which stretch it is."""
    for batch in _slices(batches):
        c = _Cuts(batch, bases)
        low, high = (c.lead - c.many + 1) // BLOCK, c.lead // BLOCK  # leads of a stretch's places fall from lead to lead - many + 1
        n = high - low + 1
        which = np.repeat(np.arange(len(n)), n)
        block = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        first, last = np.minimum(c.lead[which], block * BLOCK + BLOCK - 1), np.maximum((c.lead - c.many + 1)[which], block * BLOCK)  # by lead
        anchor = c.at[which] + c.lead[which]
        inner = anchor - block * BLOCK  # the last place that the block can have
        pair = _pair(c.hash(inner, inner + FIRST), c.hash(inner + INNER - FIRST, inner + INNER))
        key = _pair(_pair(c.rank[which], block.view(np.uint64)), pair)
        ends = anchor - first, anchor - last + LENGTH
        whole = _pair(_pair(c.hash(*ends), (first * 256 + last).view(np.uint64)), c.hash2(*ends))
        place = c.lead[which] - first
        info = ((((c.lo[which] << 8 | c.lead[which]) << 8 | place) << 8 | first - last + 1) << 1) | c.known[which]
        yield pa.RecordBatch.from_pydict({"key": key.view(np.int64), "whole": whole.view(np.int64), "k0": c.k0[which], "tx": c.tx[which], "info": info})


def _judged(blocks: DataFrame) -> DataFrame:
    """Round 2, receiving: blocks whose pair occurs more than once, as ``k0, tx, info, past, tells``."""
    kinds = blocks.groupBy("key", "whole").agg(
        F.count(F.lit(1)).alias("times"), F.max(F.col("info").bitwiseAND(F.lit(1))).alias("known"), F.min(F.struct(*KEYS, "info")).alias("one")
    ).withColumn("past", F.expr("times > 1 or known = 1"))
    several = kinds.groupBy("key").agg(F.sum("times").alias("all"), F.count_if(~F.col("past")).alias("open")).where("all > 1")
    kinds = kinds.join(several, "key").select("key", "whole", "past", "one", "open")
    tells = F.col("past") & (F.col("open") > 0) & (F.struct(*KEYS, "info") == F.col("one"))
    return blocks.join(kinds, ["key", "whole"]).select(*KEYS, "info", "past", tells.alias("tells"))


def _places(batches: Iterator[pa.RecordBatch], bases: tuple[int, int] = BASES) -> Iterator[pa.RecordBatch]:
    """Round 3, sending: the pair of ranks, in 128 bits, of every place of the blocks asked for, which are in ``found`` beside their stretch."""
    told = np.empty(0, np.uint64)
    for batch in _slices(batches):
        c = _Cuts(batch, bases)
        owner, flat = _lists(batch)
        block = flat.to_numpy()
        many = (block >> 1) & 255
        which = np.repeat(np.arange(len(block)), many)
        nth = ((block >> 9) & 255)[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        owner, known = owner[which], (block & 1)[which] > 0
        at = c.at[owner] + nth
        halves = c.hash(at, at + FIRST), c.hash(at + LENGTH - FIRST, at + LENGTH)
        lead = (c.lead[owner] - nth).view(np.uint64)
        name, again = _pair(_pair(c.rank[owner], lead), _pair(*halves)), _pair(c.hash2(at, at + LENGTH), _pair(*halves[::-1]))
        state = _states(name, again)
        state[known & (state < TELLS_PAST)] = TELLS_PAST
        kind = _pair(name, again)
        before = np.isin(kind, told)
        told = _remember(told, kind[(state == TELLS_PAST) & ~before])
        state[before] = FOUND_PAST
        state[(state == TELLS) | (state == FOUND)] = PLAIN
        info = (c.lo[owner] + nth) << 3 | state
        yield pa.RecordBatch.from_pydict({"rank": name.view(np.int64), "whole": again.view(np.int64), "k0": c.k0[owner], "tx": c.tx[owner], "info": info})


def _keep(with_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document once the bytes under its ranges are gone."""
    for batch in batches:
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        lists = batch.column("found")
        ranges, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for i, text in enumerate(batch.column("text")):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            removed = spans = 0
            kept = data
            own = ranges[offsets[i] : offsets[i + 1]]
            if len(own):
                step = np.zeros(len(data) + 1, np.int64)
                np.add.at(step, own >> 32, 1)
                np.add.at(step, (own >> 32) + (own & 0xFFFFFFFF) - 1 + LENGTH, -1)
                gone = np.cumsum(step)[:-1] > 0
                removed, spans = int(gone.sum()), len(runs(gone)[0])
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            for c, v in (("n_bytes", len(data)), ("n_removed", removed), ("n_spans", spans), ("kept_sha256", hashlib.sha256(kept).hexdigest())):
                out[c].append(v)
            out["kept"].append(kept if with_text else b"")
        types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary()}
        names = [n for n in batch.schema.names if n not in ("text", "found")]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *[pa.array(out[c], t) for c, t in types.items()]], [*names, *types])


def _once(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows that share id and text are one, and all its strings are repeats: the rows without others like them, and ``k0, tx, found``."""
    counts = docs.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("times"), F.max(F.octet_length("text")).alias("size")).where("times > 1")
    repeated = settle(counts)
    if repeated.isEmpty():
        return docs, None
    single = docs.join(repeated, KEYS, "left_anti").union(docs.join(repeated, KEYS, "left_semi").dropDuplicates(KEYS))
    whole = (F.col("size") - LENGTH + 1).cast("long")
    return single, repeated.where(F.col("size") >= LENGTH).select(*KEYS, whole.alias("found"))


def _range(lo, many):
    return F.shiftleft(lo, 32).bitwiseOR(many).alias("found")


def find_repeats(docs: DataFrame) -> DataFrame:
    """``k0, tx, found``: ranges of starting places of repeated strings (place, then how many, 32 bits each), for ``docs(k0, tx, text)``."""
    single, whole = _once(docs)
    bases = (draw(), draw())
    rows = "rank long, whole long, k0 long, tx long, info long"
    met = settle(_met(single.mapInArrow(partial(_ask, bases=bases), rows)))
    past = met.where("past").select(*KEYS, _range(_bits("info", 16, 32), _bits("info", 8, 8)))
    rest = met.where("not past")
    tells = met.where("one").join(rest.select("rank").distinct(), "rank", "left_semi").select(*met.columns)
    asked = lambda df, known: df.select(*KEYS, F.struct(F.shiftleft("info", 1).bitwiseOR(F.lit(known)).alias("info"), "rank").alias("found"))
    wanted = asked(rest, 0).union(asked(tells, 1)).groupBy(*KEYS).agg(F.collect_list("found").alias("found"))
    cuts = single.join(wanted, KEYS).select(*KEYS, "text", "found").mapInArrow(_cut, "k0 long, tx long, info long, rank long, bytes binary")
    cuts = settle(cuts)

    judged = settle(_judged(cuts.mapInArrow(partial(_blocks, bases=bases), "key long, whole long, k0 long, tx long, info long")))
    lo, place, many = _bits("info", 25, 32), _bits("info", 9, 8), _bits("info", 1, 8)
    past = past.union(judged.where("past").select(*KEYS, _range(lo + place, many)))
    open_blocks = judged.where("not past or tells").select(
        *KEYS, F.shiftright("info", 17).alias("stretch"), F.shiftleft(_bits("info", 1, 16), 1).bitwiseOR(F.col("past").cast("long")).alias("found")
    ).groupBy(*KEYS, "stretch").agg(F.collect_list("found").alias("found"))
    stretch = F.shiftleft(F.shiftright("info", 17), 8).bitwiseOR(_bits("info", 1, 8))
    places = cuts.withColumn("stretch", stretch).join(open_blocks, [*KEYS, "stretch"]).select(*cuts.columns, "found").mapInArrow(partial(_places, bases=bases), rows)
    repeated = _met(places).where("past").select(*KEYS, _range(F.col("info"), F.lit(1).cast("long")))
    found = past.union(repeated)
    return found if whole is None else found.union(whole)


def _removed(docs: DataFrame, doc_id: str, text: str, with_text: bool) -> DataFrame:
    others = [c for c in docs.columns if c != text]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text}`").alias("text"))
    key = F.coalesce(F.col(f"`c{others.index(doc_id)}`").cast("long"), F.lit(-(2**63)))
    rows = rows.withColumns({"k0": key, "tx": F.xxhash64("text")})
    found = find_repeats(rows.select(*KEYS, "text")).groupBy(*KEYS).agg(F.collect_list("found").alias("found"))
    joined = rows.join(found, KEYS, "left").select(*[f"c{i}" for i in range(len(others))], "text", "found")
    fields = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(others))
    return joined.mapInArrow(partial(_keep, with_text), fields + "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``.

    Removed is each byte, of the text in UTF-8, under a string of ``LENGTH`` bytes that also starts anywhere else, in this document or
    another; strings never cross documents, and overlaps count. Null texts are empty; texts shorter than ``LENGTH`` lose nothing; repeated
    rows repeat each other, whatever their ids; null ids are ids like others; other columns are ignored, whatever their names; no rows
    give no rows. ``docs`` must give the same rows each time it is read.
    """
    out = _removed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", False)
    return out.select(F.col("c0").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all repeated bytes cut out of ``text``; all rows and columns stay. Cases are as in :func:`repeats`.

    Bytes of a character that was cut in part are replaced. A null text becomes empty.
    """
    out, others = _removed(docs, doc_id, text, True), [c for c in docs.columns if c != text]
    names = {c: F.col(f"c{i}") for i, c in enumerate(others)} | {text: F.make_valid_utf8(F.col("kept").cast("string"))}
    return out.select(*[names[c].alias(c) for c in docs.columns])
