"""Operators on texts against plain versions of what they compute."""

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tidemark.llm import near_text, packing, repeats, token_files
from tidemark.llm.common import new_path
from tidemark.llm.encode import Encoder
from tidemark.llm.near_text import sketches
from tidemark.llm.textbytes import CHUNK_BYTES, Hasher, chunks


def plain_repeats(texts, length=200):
    """Kept bytes, removed and spans of each text, by a table of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_are_those_of_a_table_of_all_strings(awkward):
    rows = awkward.collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, *w) for r, w in zip(rows, plain_repeats([r.text for r in rows]), strict=True))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeats(awkward).collect())
    assert got == want
    assert any(0 < w[3] < w[2] for w in want)


def test_repeats_of_every_overlap(spark):
    """Passages cut at many places, beside different neighbours, inside one document and periodic."""
    rng = random.Random(8)
    p = "".join(rng.choice("abcdefgh ") for _ in range(700))
    texts = [p[a:b] + "".join(rng.choice("xyz") for _ in range(40)) + p[c:d] for a, b, c, d in [[*sorted(rng.sample(range(700), 2)), *sorted(rng.sample(range(700), 2))] for _ in range(60)]]
    texts += ["ab" * 300, "ab" * 99 + "c", p, p[:199], p[:200], "é" * 250]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = [tuple(r)[1:] for r in sorted(repeats.repeats(docs).collect())]
    assert got == plain_repeats(texts)


def test_a_common_passage_costs_a_task_one_row_for_each_name(spark):
    """One passage beside different text in every document: no name is sent to where it meets others more than once, and results are exact."""
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = letters(400)
    texts = [letters(250) + passage + letters(250) for _ in range(300)]
    keys = {"k0": pa.array(range(300), pa.int64()), "tx": pa.array(range(300), pa.int64())}
    sent = pa.Table.from_batches(repeats._ask(iter([pa.RecordBatch.from_pydict({**keys, "text": pa.array(texts)})] * 2)))
    kinds = [(r, w, i & 7) for r, w, i in zip(*(sent[c].to_pylist() for c in ("rank", "whole", "info")), strict=True)]
    meeting = Counter(r for r, _, state in kinds if state in (repeats.PLAIN, repeats.TELLS, repeats.TELLS_PAST))
    assert max(meeting.values()) <= 2 and sum(state >= repeats.FOUND for *_, state in kinds) > 600
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert [tuple(r)[1:] for r in sorted(repeats.repeats(docs).collect())] == plain_repeats(texts)


def test_repeats_next_to_the_ends_of_documents(spark):
    """Ranks of copies agree where one copy ends with its document and the other goes on, and where runs make every place an anchor."""
    rng = random.Random(31)
    p = "".join(rng.choice("abcd") for _ in range(500))
    texts = [p[a:b] + rng.choice(["", "zz", "y" * 60, "ab" * 90, p[:90]]) for a, b in [sorted(rng.sample(range(500), 2)) for _ in range(120)]]
    texts += ["q" * n for n in (199, 200, 260, 400)] + ["abc" * 100 + p[100:320], p[100:320] + "abc" * 100]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)] + [(0, texts[0]), (0, texts[0])], "doc_id long, text string").repartition(3)
    rows = docs.collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, plain_repeats([r.text for r in rows]), strict=True))
    assert sorted(tuple(r) for r in repeats.repeats(docs).collect()) == want


def test_repeats_cut_out_of_texts(awkward, nothing):
    kept = repeats.remove_repeats(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    hashes = Counter(r.kept_sha256 for r in repeats.repeats(awkward).collect())
    assert Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in kept.collect()) == hashes
    assert repeats.repeats(nothing).count() == 0 and repeats.remove_repeats(nothing).columns == nothing.columns


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_whole_texts(name, awkward):
    encode, plain = Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    rng = random.Random(3)
    texts = [r.text or "" for r in awkward.collect()]
    texts += [" a", "a ", "a  b", "a \n b", "a\nb", "\na", "a\n", "a \u00a0b", "don't we'll", "É éa ΣΑΣ. İx,", "e\u0301 x", "12 3,4 ...", "a<|startoftext|> b", "\x1c a"]
    texts += ["".join(rng.choice(" \n\t.,'éAb1#") for _ in range(30)) for _ in range(300)]
    texts += ["x İ_", "o GELDİ.", "o GELDİ, dedi", "AÇIK DEĞİL Mİ?", "İ\n."]
    letters = list("İıßǅŉΐΣσÉá\u0301\u0307bAz19٣½.,'’!?-_(\n\t \x1c♥漢ﬁ") + [" "] * 12 + ["'s", "'LL", "...", "<|endoftext|>", "GELDİ"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 25))) for _ in range(5000)]
    for text in texts:
        assert encode(text) == array("I", plain.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)


def test_capitals_and_newlines_make_no_new_pieces():
    name = public_tokenizers.path("word_bpe_49k.json")
    encode, plain = Encoder(name), Tokenizer.from_file(name)
    ids = lambda t: array("I", plain.encode(t, add_special_tokens=False).ids).tobytes()
    encode("kand lost. école neme, x")
    held = len(encode.pieces) + len(encode.ends) + len(encode.alone)
    for text in ("KAND lost.\nÉcole\nNeme, X", "Neme,\nx", "Kand"):
        assert encode(text) == ids(text)
    assert len(encode.pieces) + len(encode.ends) + len(encode.alone) == held
    for text in ("A <|ENDOFTEXT|> B<|EndOfText|>", "A <|endoftext|> B", "a " + "xyZ" * 5000 + " b\n" + "q." * 5000):
        assert encode(text) == ids(text)
    assert max(map(len, encode.pieces)) < 1000


def test_token_files_round_trip(spark, awkward, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, folder = Tokenizer.from_file(path), new_path(spark, "tokens")
    manifest = token_files.write_tokens(awkward, folder, path, 1, partitions=3)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_tokens(spark, folder).collect())
    ids = lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 1]
    want = sorted(((r.doc_id if r.doc_id is not None else -1), zlib.crc32(array("I", ids(r.text)).tobytes())) for r in awkward.collect())
    assert sorted(((d if d is not None else -1), c) for _, d, _, c in got) == want
    assert [d for _, d, _, _ in got if d is not None] == sorted(d for _, d, _, _ in got if d is not None)
    assert [s for s, *_ in got] == [0, *np.cumsum([n for _, _, n, _ in got])[:-1]] and manifest["n_ids"] == sum(n for _, _, n, _ in got)
    flat = np.concatenate([token_files.open_part(folder, p["part"], manifest["width"])[0] for p in manifest["parts"]])
    assert flat.dtype == np.uint16 and len(flat) == manifest["n_ids"]
    empty = new_path(spark, "tokens")
    token_files.write_tokens(nothing, empty, path, 1, partitions=2)
    assert token_files.read_tokens(spark, empty).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_plan_over_counts_is_best_fit_over_pieces():
    rng = random.Random(1)
    for _ in range(150):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(0, 120))]
        filled, times = defaultdict(list), Counter()
        for length, lo, hi, first, each, at in packing.best_fit_plan(Counter(lengths), 40):
            for rank in range(lo, hi + 1):
                times[length] += 1
                filled[first + (rank - lo) // each].append((at + (rank - lo) % each * length, length))
        assert times == Counter(lengths) and len(filled) == plain_best_fit(lengths, 40)
        for own in filled.values():
            place = 0
            for at, length in sorted(own):
                assert at == place
                place += length
            assert place <= 40


def test_packing_places_every_piece(awkward, nothing, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, rows = Tokenizer.from_file(path), packing.pack(awkward, path, 0, 512).collect()
    ids = [[*plain.encode(r.text or "", add_special_tokens=False).ids, 0] for r in awkward.collect()]
    want = Counter()
    for own in ids:
        cuts = [0, *range(len(own) % 512 or 512, len(own) + 1, 512)]
        want.update((b - a, a, zlib.crc32(array("I", own[a:b]).tobytes())) for a, b in zip(cuts, cuts[1:], strict=False))
    assert Counter((r.length, r.start, r.ids_crc32) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for own in filled.values():
        place = 0
        for at, length in sorted(own):
            assert at == place
            place += length
        assert place <= 512
    assert len(filled) == plain_best_fit([r.length for r in rows], 512)
    assert packing.pack(nothing, path).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain_components(rows, percent):
    """The smallest id that each id reaches, by comparing all pairs of sets."""
    sets = [(r.doc_id, shingles(r.text)) for r in rows if r.doc_id is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i != j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_near_text_links_what_all_pairs_link(awkward, nothing):
    rows = awkward.collect()
    want, by_set = plain_components(rows, 85), defaultdict(set)
    for r in rows:
        by_set[shingles(r.text)].add(r.doc_id)
    for r in near_text.near_text(awkward, 85).collect():
        if r.doc_id is not None:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
            assert r.n_shingles in {len(shingles(x.text)) for x in rows if x.doc_id == r.doc_id}
        else:
            assert not r.kept and r.component_id in (None, want[0])
    assert near_text.near_text(nothing).count() == 0


def test_near_text_chains_and_families(spark):
    """A family whose members differ from its smallest by more than the limit, but link among themselves."""
    rng = random.Random(2)
    rows = []
    for family in range(6):
        words = prose(rng, 150).split()
        for _ in range(25):
            own = list(words)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((family * 100 + len(rows), " ".join(own)))
            if rng.random() < 0.3:
                words = own
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for percent in (80, 85):
        want = plain_components(docs.collect(), percent)
        assert {r.doc_id: r.component_id for r in near_text.near_text(docs, percent).collect()} == want
        assert len(set(want.values())) > 6


def test_near_text_reads_pairs_whose_short_sketches_differ(spark):
    """A pair just at the limit whose sketches of 128 bits differ in five: 4.5 standard deviations would be four."""
    words = [f"22828.{k}" for k in range(300)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:297]))], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_text.near_text(docs, 99, 1).collect()) == [(1, 1), (2, 1)]


def test_dropping_near_text_keeps_one_of_each(awkward, nothing):
    want = plain_components(awkward.collect(), 80)
    stay = near_text.drop_near_text(awkward)
    assert stay.columns == awkward.columns
    assert Counter(r.doc_id for r in stay.collect() if r.doc_id is not None) == Counter(set(want.values()))
    assert near_text.drop_near_text(nothing).columns == nothing.columns


def test_dropping_near_text_by_rows(spark):
    """Null ids, one id with unlike texts, and columns named like those of the operator."""
    rng = random.Random(9)
    a, b, c = prose(rng, 60), prose(rng, 60), prose(rng, 60)
    rows = [(1, a, 1), (1, b, 2), (2, a + " x", 3), (None, b, 4), (None, c, 5), (None, c + " y", 6), (None, c, 7), (3, None, 8), (3, None, 9), (None, "", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tx int").withColumn("key", F.lit(1)).withColumn("__gone", F.lit(2))
    stay = near_text.drop_near_text(docs)
    assert stay.columns == docs.columns
    got = sorted(r.tx for r in stay.collect())
    assert got[:2] == [1, 2] and len(set(got) & {5, 6, 7}) == 1 and got[3:] == [8, 9, 10]


def test_many_documents_beside_one(spark, monkeypatch):
    """Pairs of one document with many, in groups of two, and texts over several chunks."""
    monkeypatch.setattr(near_text, "GROUP", 2)
    rng = random.Random(7)
    words = prose(rng, 200).split()
    texts = [" ".join(words[:i] + [f"z{i}"] + words[i + 1 :]) for i in range(0, 60)] + [prose(rng, 90_000)] * 2
    texts.append(texts[-1] + " end")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_text.near_text(docs, 85).collect()} == plain_components(docs.collect(), 85)


def test_sketches_estimate_similarity_and_fill():
    rng = np.random.default_rng(0)
    for size in (1, 3, 50, 4000):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = np.concatenate([a[: size * 4 // 5], rng.integers(0, 2**63, size - size * 4 // 5, dtype=np.uint64)])
        doc, h = np.repeat([0, 1], size), np.concatenate([a, b])
        s = sketches(doc, h, 2, 1024)
        assert (s < np.iinfo(np.uint64).max).all()
        exact = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        assert abs((s[0] == s[1]).mean() - exact) < 0.07


def test_hashes_agree_wherever_a_string_stands():
    data = np.frombuffer(b"one two one two", np.uint8)
    h = Hasher(data)
    assert h(np.array([0]), np.array([3])) == h(np.array([8]), np.array([11])) != h(np.array([4]), np.array([7]))
    most = CHUNK_BYTES * 6 // 10
    parts = list(chunks(["a" * most, None, "b" * most, "c" * 2 * CHUNK_BYTES, ""], b" "))
    assert [first for first, *_ in parts] == [0, 2, 3, 4] and sum(len(b) - 1 for _, _, b in parts) == 5


def test_a_worker_that_turns_to_other_work_drops_what_it_kept():
    from tidemark.llm import encode, textbytes
    from tidemark.llm.queries import tokenizer_file

    for base in (3, 5, 7):
        assert len(textbytes.prime_powers(10, base)[0]) == 10 and len(textbytes._prime_powers) <= 2
    first = encode.encoder(tokenizer_file("byte_bpe_50k.json"))
    assert not textbytes._prime_powers and encode.encoder(tokenizer_file("byte_bpe_50k.json")) is first
    list(textbytes.chunks(["a text"]))
    assert not encode._encoders
    grams = textbytes.KeyedHasher(np.frombuffer(b"abab", np.uint8), 7).grams(2)
    assert grams[0] == grams[2] != grams[1]
