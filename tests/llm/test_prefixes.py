"""Passages, prefix tries and lexical search against plain versions of what they compute."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tests.llm.test_texts import plain_repeats
from tidemark.llm import lexical, near_text, passages, prefix_trie, repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_passages(rows, window=20):
    """``(id, n_words, n_removed, sha256)`` of rows ``(id, text)``; rows alike in both are one document."""
    texts = {(i is not None, i or 0, i, t): WORD.findall(t or "") for i, t in rows}
    seen, gone = {}, defaultdict(set)
    for key in sorted(texts, key=lambda k: k[:2]):
        words = texts[key]
        for s in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[s : s + window]), (key, s)) != (key, s):
                gone[key] |= set(range(s, s + window))
    out = []
    for i, t in rows:
        words, removed = WORD.findall(t or ""), gone[(i is not None, i or 0, i, t)]
        kept = " ".join(w for n, w in enumerate(words) if n not in removed)
        out.append((i, len(words), len(removed), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def found_passages(docs):
    return Counter(tuple(r)[:4] for r in passages.passages(docs).collect())


def test_passages_are_those_of_a_table_of_all_windows(awkward, nothing):
    want = plain_passages([(r.doc_id, r.text) for r in awkward.collect()])
    assert found_passages(awkward) == want and any(0 < w[2] < w[1] for w in want)
    assert passages.passages(nothing).count() == 0
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in passages.passages(awkward).collect())


@pytest.mark.parametrize("group", [1 << 15, 6])
def test_passages_of_every_overlap(spark, monkeypatch, group):
    """Passages cut at many places, beside different neighbours, periodic ones, and one so common that no subtree may hold it."""
    monkeypatch.setattr(passages, "GROUP", group)
    rng = random.Random(8)
    p = [rng.choice("a b c d e ff gg ñ".split()) for _ in range(150)]
    cut = lambda: p[slice(*sorted(rng.sample(range(150), 2)))]
    texts = ["  ".join([*cut(), "x", *cut(), "y\n", *cut()]) for _ in range(50)]
    texts += ["a b " * 60, "a b " * 12 + "c", " ".join(p), " ".join(p[:19]), "\t".join(p[:20]), "ab" * 600 + " " + " ".join(p[3:60]), None, " \n"]
    texts += [f"own{n} " + " ".join(p[40:75]) + f" end{n}" for n in range(30)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found_passages(docs) == plain_passages(rows)


def plain_trie(convs):
    """Nodes of ``{conv_id: [(role, text), ...]}``."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children = Counter(path[:-1] for path in members if path)
    out = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        listed = ",".join(map(str, sorted(ends[path])))
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), children[path], sum(not children[p] for p in below), saved, hashlib.sha256(listed.encode()).hexdigest()))
    return Counter(out)


def found_trie(df, members=None):
    turns = prefix_trie.numbered(df)
    return Counter(tuple(r) for r in prefix_trie.prefix_trie(turns, turns.select("conv_id") if members is None else members).collect())


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def test_tries_are_those_of_all_prefixes(spark):
    """Copies, shared starts, conversations of many blocks, ids far apart and negative, ties, nulls, and roles that run into texts."""
    rng = random.Random(3)
    turn = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["", None, "hi", "größe", "yes", prose(rng, 4)]))
    long = [turn() for _ in range(37)]
    convs = {c: [turn() for _ in range(rng.randint(1, 5))] for c in range(40)}
    convs |= {c: long[: rng.randint(1, 37)] + [turn() for _ in range(rng.randint(0, 20))] for c in range(100, 130)}
    convs |= {-7: long, 1 << 40: long, 9_000: long[:16], 9_001: long[:8], 9_002: long[:17], -(1 << 50): [("user", "hi")], 5_000: [("us", "erhi")]}
    rows = [(c, n * 3, *t) for c, turns in convs.items() for n, t in enumerate(turns)]
    rows += [(7, None, "user", "first"), (7, None, "user", None), (7, 0, "x", "tie"), (7, 0, "x", "tie"), (None, 1, "user", "nobody's"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "m") for r in rows], "conv_id long, turn long, role string, text string, pos int, block string").repartition(7)
    assert found_trie(df) == plain_trie(ordered(rows))


def test_tries_of_conversations_without_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    none, ids = spark.createDataFrame([], schema), spark.createDataFrame([(4,), (2,), (None,), (11,)], "conv_id long")
    assert found_trie(none) == Counter() and found_trie(none, ids) == plain_trie({4: [], 2: [], 11: []})
    one = spark.createDataFrame([(4, 1, "user", "hi")], schema)
    assert found_trie(one, ids) == plain_trie({4: [("user", "hi")], 2: [], 11: []})
    assert found_trie(one) == plain_trie({4: [("user", "hi")]})


def test_a_common_conversation_is_listed_whole(spark):
    """Twenty thousand copies over many ranges of ids."""
    df = spark.range(20_000).select((F.col("id") * 3 - 9_000).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text"))
    (leaf,) = [r for r in prefix_trie.prefix_trie(prefix_trie.numbered(df), df.select("conv_id")).collect() if r.depth == 1]
    assert (leaf.n_convs, leaf.saved_tokens) == (20_000, 19_999 * 2)
    assert leaf.ends_sha256 == hashlib.sha256(",".join(str(3 * i - 9_000) for i in range(20_000)).encode()).hexdigest()


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, k=10):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n_docs) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms_of(text)) if t in b)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out.update((item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores)[:k]))
    return out


@pytest.mark.parametrize(("group", "terms"), [(2048, 1 << 16), (40, 30)])
def test_lexical_ranks_are_those_of_all_scores(spark, awkward, nothing, monkeypatch, group, terms):
    """Trees of several levels, many groups, and blocks of a few items each."""
    monkeypatch.setattr(lexical, "GROUP", group)
    monkeypatch.setattr(lexical, "TERMS", terms)
    rng = random.Random(6)
    more = [(1000 + n, prose(rng, rng.randint(1, 60)) + " Ünïcode-X9 " * (n % 3)) for n in range(150)] + [(2000 + n, "same words here") for n in range(90)]
    docs = awkward.select("doc_id", "text", "bucket").union(spark.createDataFrame([(*m, 0) for m in more], "doc_id long, text string, bucket int")).repartition(4)
    items = [(0, prose(rng, 30)), (1, "SAME Words"), (1, "kand kand, lost"), (2, None), (None, "x9 ünïcode a"), (3, "nowheretobefound ..."), (4, ""), (5, " ".join(m[1] for m in more[:40]))]
    frame = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, n int")
    got = Counter(tuple(r) for r in lexical.top_documents(docs, frame).select("item_id", "rank", "doc_id", "score").collect())
    assert got == plain_ranks([(r.doc_id, r.text) for r in docs.collect()], items)
    assert lexical.top_documents(nothing, frame).count() == lexical.top_documents(docs, frame.where("false")).count() == 0


def thue_morse(n, a="a", b="b"):
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def test_texts_that_collide_under_powers_of_two_are_apart(spark):
    """A Thue-Morse string and its complement have one polynomial hash modulo 2**64, whatever its odd base."""
    one, other = thue_morse(2048), thue_morse(2048, "b", "a")
    docs = spark.createDataFrame(list(enumerate([one, other, "x" + one[:1024] + "y" + "z" * 300, "v" + other[:1024] + "w"])), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_text.near_text(docs, percent=80).collect()} == {0: 0, 1: 1, 2: 2, 3: 3}
    words = docs.select("doc_id", F.concat(F.lit("same " * 10), "text", F.lit(" same" * 9)).alias("text"))
    assert {r.n_removed for r in passages.passages(words).collect()} == {0}
    got = {r.doc_id: r.n_removed for r in repeats.repeats(docs).collect()}
    texts = [r.text for r in docs.sort("doc_id").collect()]
    assert [got[i] for i in range(4)] == [w[1] for w in plain_repeats(texts)]
