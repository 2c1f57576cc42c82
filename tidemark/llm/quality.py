"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every feature has a weight and a short vector; a document scores by the weights of its features and by the inner products of the vectors
of all pairs of them. The pairs are never formed: their sum is half of (the square of the sum less the sum of the squares), which is
linear in the number of features. Words enter by their share of the text, hashed into buckets; structure statistics are rates of kinds of
characters, repetition of words and lines, and lengths; the metadata are the length in bytes and in characters for a byte.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, labelled_sample, with_score
from tidemark.llm.textbytes import Hasher, chunks, lowered, runs

#: Hash buckets for words, length of the vectors, labelled texts of each class that the model is fitted on, at most.
BUCKETS, FACTORS, SAMPLE = 1 << 15, 8, 2000
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
STATISTICS = 18


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # words, then statistics
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different values each document has, and how often its commonest occurs."""
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, d[at], np.diff(np.append(at, len(d))))
    return np.bincount(d[at], minlength=n).astype(float), most


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, bucket and value of each word feature of a chunk, and its documents' statistics. Texts end in a newline of their own."""
    n, data = len(bounds) - 1, lowered(raw)
    length = np.maximum(np.diff(bounds) - 1, 1).astype(float)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts, ends = runs(~space)
    of = np.searchsorted(bounds, starts, "right") - 1
    h = Hasher(data)
    words = h(starts, ends)
    n_words = np.bincount(of, minlength=n).astype(float)
    some = np.maximum(n_words, 1)
    line_starts, line_ends = runs(data != 10)
    line_of = np.searchsorted(bounds, line_starts, "right") - 1
    n_lines = np.bincount(line_of, minlength=n).astype(float)
    distinct, most = _distinct(of, words, n)
    lines, most_lines = _distinct(line_of, h(line_starts, line_ends), n)
    alone = np.bincount(of[(ends - starts) == 1], minlength=n)
    symbolic = np.bincount(of[SYMBOLS[data[np.maximum(ends - 1, 0)]]], minlength=n) if len(ends) else np.zeros(n)
    rate = lambda mask: _per_doc(mask, bounds) / length
    chars = _per_doc((raw & 0xC0) != 0x80, bounds)
    stats = np.column_stack(
        [
            np.log1p(length), chars / length, np.log1p(n_words), _per_doc(~space, bounds) / some, rate(space), rate(data == 10),
            rate((raw >= 65) & (raw <= 90)), rate((raw >= 48) & (raw <= 57)), rate(SYMBOLS[raw]), rate(raw == 124), rate((raw == 46) | (raw == 33) | (raw == 63)),
            rate(raw == 44), distinct / some, most / some, lines / np.maximum(n_lines, 1), most_lines / np.maximum(n_lines, 1), alone / some, symbolic / some,
        ]
    )
    key = of * BUCKETS + (words % np.uint64(BUCKETS)).astype(np.int64)
    pair, count = np.unique(key, return_counts=True)
    doc = pair // BUCKETS
    return doc, pair % BUCKETS, np.sqrt(count / some[doc]), stats


def _forward(model: Model, doc, bucket, value, z):
    """Scores, and the sums of the factors that the gradient needs."""
    n = len(z)
    own = model.weights[BUCKETS:], model.vectors[BUCKETS:]
    linear = model.bias + np.bincount(doc, model.weights[bucket] * value, n) + z @ own[0]
    v = model.vectors[bucket]
    sums = np.column_stack([np.bincount(doc, v[:, f] * value, n) for f in range(FACTORS)]) + z @ own[1]
    squares = np.bincount(doc, np.square(v).sum(1) * np.square(value), n) + np.square(z) @ np.square(own[1]).sum(1)
    return linear + 0.5 * (np.square(sums).sum(1) - squares), sums


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _standard(model: Model, stats: np.ndarray) -> np.ndarray:
    return np.clip((stats - model.mean) / model.scale, -4, 4) / 4


def fit(texts: list[str | None], labels: np.ndarray, prior: float, steps: int = 80, rate: float = 0.05, decay: float = 2e-3, seed: int = 7) -> Model:
    """Full-batch training by Adam; texts weigh so that label 1 has the share ``prior`` that it has among all labels."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + STATISTICS
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), np.zeros(STATISTICS), np.ones(STATISTICS))
    if len(set(labels.tolist())) < 2:
        return Model(5.0 * (2 * float(labels.mean()) - 1) if len(labels) else 0.0, model.weights, model.vectors * 0, model.mean, model.scale)
    found = [[], [], [], []]
    for first, data, bounds in chunks(texts, b"", b"\n"):
        doc, bucket, value, stats = features(data, bounds)
        for held, new in zip(found, (doc + first, bucket, value, stats), strict=True):
            held.append(new)
    doc, bucket, value, stats = map(np.concatenate, found)
    model.mean, model.scale = stats.mean(0), stats.std(0) + 1e-6
    z, y = _standard(model, stats), labels.astype(float)
    weight = np.where(y == 1, prior / y.sum(), (1 - prior) / (1 - y).sum())
    first_moment = [np.zeros(size), np.zeros((size, FACTORS)), np.zeros(1)]
    second = [np.zeros(size), np.zeros((size, FACTORS)), np.zeros(1)]
    for step in range(1, steps + 1):
        logit, sums = _forward(model, doc, bucket, value, z)
        wrong = (_sigmoid(logit) - y) * weight
        slope = wrong[doc] * value
        squared = np.bincount(bucket, slope * value, BUCKETS)
        g_weights = np.concatenate([np.bincount(bucket, slope, BUCKETS), wrong @ z])
        g_vectors = np.column_stack([np.bincount(bucket, slope * sums[doc, f], BUCKETS) for f in range(FACTORS)]) - squared[:, None] * model.vectors[:BUCKETS]
        own = z.T @ (wrong[:, None] * sums) - (np.square(z).T @ wrong)[:, None] * model.vectors[BUCKETS:]
        gradients = [g_weights, np.vstack([g_vectors, own]), np.array([wrong.sum()])]
        moves = []
        for g, m, s in zip(gradients, first_moment, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (np.square(g) - s)
            moves.append(rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-5))
        model.weights = model.weights * (1 - decay) - moves[0]
        model.vectors = model.vectors * (1 - decay) - moves[1]
        model.bias -= float(moves[2][0])
    return model


def score_texts(texts: Iterable[str | None], model: tuple) -> np.ndarray:
    """The probability of label 1 for each text."""
    m, out = Model(*model), []
    for _, data, bounds in chunks(texts, b"", b"\n"):
        doc, bucket, value, stats = features(data, bounds)
        out.append(_sigmoid(_forward(m, doc, bucket, value, _standard(m, stats))[0]))
    return np.concatenate(out) if out else np.empty(0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> tuple:
    known = labels.where(~held_out(F.col(doc_id)) & F.col(label).isin(0, 1))
    prior = known.agg(F.avg(label)).first()[0]
    model = fit(*labelled_sample(docs, labels, label, per_class, doc_id, text), prior if prior is not None else 0.5)
    return tuple(getattr(model, f.name) for f in fields(Model))


def score(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, per_class: int = SAMPLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``; ``predicted`` is 1 from a score of ``threshold``.

    The model is fitted on at most ``per_class`` labelled texts of each class outside the held-out fold. Null and empty texts have no
    word features and the statistics of an empty text; rows that share an id are scored each; null ids are held out; other columns are
    ignored, whatever their names; no rows give no rows. Without labels of both classes the score is a constant: towards the only one, or
    a half.
    """
    model = train(docs, labels, label, per_class, doc_id, text)
    rows = with_score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), score_texts, model, "text", "score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
