"""Operators on vectors, URLs, sources and labels."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import mixing, near_vectors, quality, toxicity, url_filter, vector_search
from tidemark.llm.components import components
from tidemark.llm.labelled import labelled_sample
from tidemark.llm.textbytes import CHUNK_BYTES, Hasher, chunks, mix64

VECTORS = "vec_id long, embedding array<float>, label int, n int, v string, leaf string"


@pytest.fixture(scope="session")
def vectors(spark):
    rng = np.random.default_rng(6)
    rows, centre = [], rng.standard_normal((4, 16))
    for i in range(260):
        v = centre[i % 4] + rng.standard_normal(16) * rng.choice([0.02, 0.1, 1.0])
        rows.append((i, [float(x) for x in v], int(i % 4 if i % 9 else 0), i, "x", "y"))
    rows += [(300, None, 1, 0, "", ""), (301, [], 1, 0, "", ""), (302, [0.0] * 16, 1, 0, "", ""), (303, [None] + [1.0] * 15, 1, 0, "", ""), (304, [float("nan")] * 16, 1, 0, "", "")]
    rows += [(305, rows[0][1], None, 0, "", ""), (306, [1.0, 2.0], 1, 0, "", ""), (307, [2.0, 4.0], 1, 0, "", ""), (None, rows[1][1], 1, 0, "", ""), rows[5], (350, rows[5][1], rows[5][2], 0, "", "")]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_near_vectors_link_what_all_pairs_link(spark, vectors):
    rows = vectors.collect()
    use = [r for r in rows if good(r.embedding) and any(r.embedding) and r.label is not None]
    count, parent = defaultdict(int), {r.vec_id: r.vec_id for r in rows if r.vec_id is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(use):
        for j, b in enumerate(use):
            if i != j and a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding), np.array(b.embedding)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98:
                    count[i] += 1
                    if a.vec_id is not None and b.vec_id is not None:
                        p, q = root(a.vec_id), root(b.vec_id)
                        parent[max(p, q)] = min(p, q)
    want = sorted((r.vec_id, count[i], root(r.vec_id)) for i, r in enumerate(use) if r.vec_id is not None)
    usable = {r.vec_id for r in use}
    got = near_vectors.near_vectors(vectors).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id in usable and r.vec_id is not None) == want
    assert len(got) == len(rows) and sum(n for _, n, _ in want) > 500
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in got if r.vec_id is not None and r.vec_id not in usable)
    assert near_vectors.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_near_vectors_split_large_labels(spark, monkeypatch):
    """With small leaves and chunks every round, spill and chunk pair is used; recall is held against all pairs."""
    monkeypatch.setattr(near_vectors, "LEAF", 32)
    monkeypatch.setattr(near_vectors, "CHUNK", 24)
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((150, 24))
    x = np.concatenate([centres + rng.standard_normal((150, 24)) * 0.08 for _ in range(5)] + [centres[:1] + rng.standard_normal((100, 24)) * 0.02])
    docs = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = (y @ y.T >= 0.98).sum(1) - 1
    got = np.array([r.n_links for r in sorted(near_vectors.near_vectors(docs).collect())])
    assert (got <= want).all() and got.sum() >= 0.97 * want.sum() > 5000


def test_top_k_is_that_of_all_scores(spark, vectors, monkeypatch):
    monkeypatch.setattr(vector_search, "STRIP", 32)
    rows = [(r.vec_id, [math.floor(256 * float(x)) for x in r.embedding]) for r in vectors.collect() if r.vec_id is not None and good(r.embedding)]
    want = []
    for q, v in sorted({(q, tuple(v)) for q, v in rows if q % 5 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:7])]
    got = sorted(tuple(r) for r in vector_search.top_k(vectors, F.col("vec_id") % 5 == 0, 7).collect())
    assert got == sorted(want)
    monkeypatch.setattr(vector_search, "BLOCK", 10)
    assert sorted(tuple(r) for r in vector_search.top_k(vectors, F.col("vec_id") % 5 == 0, 7).collect()) == sorted(want)
    assert vector_search.top_k(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_top_k_of_extreme_components_and_many_copies(spark, monkeypatch):
    """Outliers keep their own cell width, scores beyond 64 bits are the nearest number of 64 bits, and copies do not crowd out others."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(60)]
    rows += [(100, [-1e30] + [1.0] * 5), (101, [1e30, 2.0, 0.0, 0.0, 0.0, 1.0]), (102, [3e8, -2e8, 5e7, 1.0, 2.0, 3.0]), (103, [1e308] * 6), (104, [0.0] * 6)]
    rows += [(200 + i % 40, rows[7][1]) for i in range(80)] + [(5, rows[5][1])] * 12
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    exact = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if np.isfinite(256 * np.array(v)).all()]
    want = []
    for q, v in sorted({(q, tuple(v)) for q, v in exact if q % 4 == 0 or q in (5, 101)}):
        clipped = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in exact if i != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(clipped)[:5])]
    got = sorted(tuple(r) for r in vector_search.top_k(vectors, F.expr("vec_id % 4 = 0 or vec_id in (5, 101)"), 5).collect())
    assert got == sorted(want)


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("a.b", "", "block"), (None, "/", "block")]


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = rest[:end].translate({c: c + 32 for c in range(65, 91)})
    path = rest[end:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if h is not None and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


@pytest.mark.parametrize("large", [False, True])
def test_urls_are_judged_by_the_longest_rule(spark, monkeypatch, large):
    if large:  # no broadcast of filter or rules
        monkeypatch.setattr(url_filter, "MAX_BLOCKS", 0)
        monkeypatch.setattr(url_filter, "MAX_RULES", 0)
    hosts = ["example.com", "EXAMPLE.com", "x.example.com", "notexample.com", "com", "example.net", "b.example.net", "a.b", "x.a.b", "xa.b", "", "com.", "ÉX.com"]
    paths = ["", "/", "/en/", "/en/7", "/en/70?x=/de/", "/de/8#a", "/de/", "?q=/en/", "#/en/", "/EN/", "/en"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "nothing", "://", "a://b://c/en/", "http://com/en/\n7"] * 2
    pages = spark.createDataFrame([(i if i % 11 else None, u, "h", 1, "k") for i, u in enumerate(urls)], "page_id long, url string, host string, row int, key string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3] or "", r[4])
    got = sorted((tuple(r) for r in url_filter.filter_urls(pages, rules).collect()), key=key)
    assert got == sorted(((i if i % 11 else None, *plain_verdict(u, RULES)) for i, u in enumerate(urls)), key=key)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("large", [False, True])
def test_the_filter_passes_listed_keys_and_few_others(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(url_filter, "MAX_BLOCKS", 0)
        monkeypatch.setattr(url_filter, "SALTS", 3)
    listed = spark.range(2000).select(F.concat(F.lit("h"), "id").alias("key"))
    asked = spark.range(20_000).select(F.col("id").alias("row"), F.concat(F.lit("h"), "id").alias("key"))
    hits = url_filter.possible(asked, url_filter.bloom_filter(listed, "key", 125), 125)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "shiftrightunsigned(w0" in plan and ("salt" in plan) == large
    rows = [r.row for r in hits.collect()]
    assert len(rows) == len(set(rows)) and set(range(2000)) <= set(rows) and len(rows) < 2600


def plain_targets(sizes, weights=(5, 2, 1)):
    """Share, cap and share the excess again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        rest = [s for s in names if s not in full]
        share = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = 3.0 * sizes[s]
            left -= full[s]


def test_mixture_meets_its_targets(spark, awkward, nothing):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 40)), rng.choice(["a", "b", "b", "b", "c", "Z", "é", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mixture(docs).collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
    targets = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], rel_tol=1e-9, abs_tol=1e-9)
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 for s in sizes)
    again = mixing.mixture(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    assert mixing.mixture(awkward).count() == awkward.count() and mixing.mixture(nothing).count() == 0


def test_mix_takes_the_rows_of_the_mixture(awkward, nothing):
    want = sorted((r.doc_id is None, r.doc_id or 0) for r in mixing.mixture(awkward).collect() for _ in range(r.times))
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in mixed.collect()) == want
    assert mixing.mix(nothing).count() == 0


def test_heavier_documents_are_taken_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    weight = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = [r for r in mixing.mixture(docs, weight=weight).collect() if r.source == "b"]
    even, odd = (sum(r.times for r in got if r.doc_id % 2 == k) for k in (0, 1))
    assert even > 1.5 * odd > 0


@pytest.mark.parametrize("kind", ["double", "float", "decimal(38,3)"])
def test_documents_without_a_positive_weight_come_last(spark, kind):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    at = F.col("doc_id") % 5
    odd = F.when(at == 1, F.lit(None)).when(at == 2, 0.0).when(at == 3, -1.0).when((at == 0) & F.lit(kind != "decimal(38,3)"), F.lit(float("nan")))
    few = odd.when(at == 4, 0.001).cast(kind)
    times = defaultdict(list)
    for r in mixing.mixture(docs, weight=few).collect():
        if r.source == "b":
            times[r.doc_id % 5].append(r.times)
    assert set(times[4]) == {1} and all(100 < sum(times[k]) < 300 for k in range(4))
    many = F.when(at == 0, F.lit(0.0)).otherwise(1e-300 if kind == "double" else 0.5).cast(kind)
    got = [r for r in mixing.mixture(docs, weight=many).collect() if r.source == "b"]
    assert sum(r.times for r in got) > 1000 and not any(r.times for r in got if r.doc_id % 5 == 0)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(i, 300 + (i - 299) % 20) for i in range(300, 320)] + [(5, 5), (None, 3), (160, 400), (400, 160)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {i: root(i) for i in parent}


def labelled(spark, n=400):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        words, toxic, bad = prose(rng, rng.randint(5, 300)).split(), int(i % 4 == 0), int(i % 5 == 0)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zorgish", "zorgishly", "grubnak", "zorgisht"])
        if bad:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - bad, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("operator", "label", "column"), [(toxicity, "toxic", 2), (quality, "quality", 1)])
def test_classifiers_on_held_out_rows(spark, operator, label, column):
    docs, labels = labelled(spark)
    truth = {r.doc_id: r[column] for r in labels.collect()}
    got = operator.score(docs, labels).collect()
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert right > 0.9
    # labels of the held-out fold are never learnt from
    flipped = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(label)).otherwise(F.col(label)))
    assert sorted((r.doc_id, r.score) for r in operator.score(docs, flipped).collect()) == sorted((r.doc_id, r.score) for r in got)


def test_samples_are_the_least_hashed_within_bounds(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', cast(id % 40 as int))").alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    hashed = [(r.h, r.doc_id) for r in labels.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    want = {k: [i for _, i in sorted(x for x in hashed if (x[1] % 3 == 0) == k)][:50] for k in (0, 1)}
    texts, got = labelled_sample(docs, labels, "toxic", 50)
    assert sorted(zip(got, texts)) == sorted((k, "ab " * (i % 40)) for k in (0, 1) for i in want[k])
    texts, got = labelled_sample(docs, labels, "toxic", 50, max_bytes=1000)
    for k in (0, 1):
        room, kept = 500, []
        for i in want[k]:
            if 3 * (i % 40) <= room:
                room -= 3 * (i % 40)
                kept.append("ab " * (i % 40))
        assert sorted(t for t, g in zip(texts, got) if g == k) == sorted(kept)


def words_of(text):
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_toxicity_is_the_worst_segments_mean_of_subword_vectors():
    """Scores by a plain loop over segments, words and n-grams."""
    rng = random.Random(3)
    texts = ["", None, "one", "Two words", "école, größe!", prose(rng, 100), "a-b c_d 12 " + prose(rng, 30)]
    table, soft, bias = np.random.default_rng(1).normal(0, 1, (toxicity.BUCKETS, toxicity.DIMENSIONS)), np.random.default_rng(2).normal(0, 1, (toxicity.DIMENSIONS, 2)), 0.3
    got = toxicity.score_texts(texts, (toxicity.Model(table, soft, bias).gram_scores(), bias))
    name = lambda b, mixed: int((mix64(Hasher(np.frombuffer(b, np.uint8))(np.array([0]), np.array([len(b)])) + np.uint64(1)) if mixed else Hasher(np.frombuffer(b, np.uint8))(np.array([0]), np.array([len(b)])))[0] % np.uint64(toxicity.BUCKETS))
    for text, score in zip(texts, got, strict=True):
        logits, words = [], words_of(text)
        for at in range(0, len(words), toxicity.SEGMENT):
            vectors = []
            for w in words[at : at + toxicity.SEGMENT]:
                marked = b" " + w.encode() + b" "
                vectors += [table[name(marked[i : i + n], False)] for n in toxicity.GRAMS for i in range(len(marked) - n + 1)]
                vectors.append(table[name(w.encode(), True)])
            mean = np.mean(vectors, 0) @ soft
            logits.append(mean[1] - mean[0])
        assert abs(score - 1 / (1 + math.exp(-(max(logits, default=0.0) + bias)))) < 1e-4


def plain_machine(m, doc, bucket, value, z, n):
    """Weights and the inner products of all pairs, formed one by one."""
    out = []
    for d in range(n):
        x = [(b, v) for k, b, v in zip(doc, bucket, value, strict=True) if k == d] + [(quality.BUCKETS + i, v) for i, v in enumerate(z[d])]
        pairs = sum(float(m.vectors[i] @ m.vectors[j]) * a * b for k, (i, a) in enumerate(x) for j, b in x[k + 1 :])
        out.append(m.bias + sum(m.weights[i] * a for i, a in x) + pairs)
    return np.array(out)


def test_the_factorisation_machine_is_the_sum_over_all_pairs():
    rng, size = np.random.default_rng(4), quality.BUCKETS + quality.STATISTICS
    m = quality.Model(0.2, rng.normal(0, 0.3, size), rng.normal(0, 0.3, (size, quality.FACTORS)), rng.normal(0, 1, quality.STATISTICS), rng.uniform(1, 2, quality.STATISTICS))
    texts = ["", "one two two", prose(random.Random(2), 40), None, "a\nb\nb | # 3"]
    (_, data, bounds), *_ = chunks(texts, b"", b"\n")
    doc, bucket, value, stats = quality.features(data, bounds)
    z = quality._standard(m, stats)
    want = plain_machine(m, doc, bucket, value, z, len(texts))
    assert np.allclose(quality._forward(m, doc, bucket, value, z)[0], want)
    fields = (m.bias, m.weights, m.vectors, m.mean, m.scale)
    assert np.allclose(quality.score_texts(texts, fields), 1 / (1 + np.exp(-want)))


def test_long_texts_are_scored_like_short_ones():
    """A text over one chunk, between others."""
    rng = random.Random(6)
    long, short = prose(rng, 120_000), prose(rng, 50)
    assert len(long) > CHUNK_BYTES
    gram = np.random.default_rng(1).normal(0, 1, toxicity.BUCKETS).astype(np.float32)
    alone = [toxicity.score_texts([t], (gram, 0.1))[0] for t in (short, long, short)]
    assert np.allclose(toxicity.score_texts([short, long, short], (gram, 0.1)), alone)


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers_take_awkward_rows(spark, awkward, nothing, operator):
    _, labels = labelled(spark, 40)
    scored = operator.score(awkward, labels).collect()
    assert len(scored) == awkward.count() and all(0 <= r.score <= 1 for r in scored)
    none = labels.limit(0)
    assert {r.predicted for r in operator.score(awkward, none).collect()} <= {0, 1}
    assert operator.score(nothing, labels).count() == 0


def test_toxic_documents_go_and_unseen_spellings_with_them(spark):
    docs, labels = labelled(spark)
    rng = random.Random(12)
    more = spark.createDataFrame([(1000 + i, prose(rng, 80) + " zorgishness " + prose(rng, 80)) for i in range(10)] + [(2000 + i, prose(rng, 160)) for i in range(10)], "doc_id long, text string")
    stay = {r.doc_id for r in toxicity.remove_toxic(docs.union(more), labels).collect()}
    assert len(stay & set(range(1000, 1010))) <= 1 and len(stay & set(range(2000, 2010))) >= 9
