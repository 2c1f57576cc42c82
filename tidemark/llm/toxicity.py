"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A text is cut into segments of a few words. A segment's vector is the mean of the vectors of its character n-grams (with marks at word
ends) and of its whole words, all hashed into one table, and a linear softmax scores it; a document scores as its worst segment, so that a
few words in a long text count. Training moves the table and the softmax together. A misspelt or unseen word shares n-grams, and so
vectors, with the words it resembles.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import free_name, held_out, labelled_sample, with_score
from tidemark.llm.textbytes import Hasher, chunks, lowered, mix64

#: Rows and columns of the embedding table, lengths of n-grams in bytes, words in a segment.
BUCKETS, DIMENSIONS, GRAMS, SEGMENT = 1 << 18, 8, (3, 4, 5, 6), 12
#: Labelled documents of each class, at most, that the model is fitted on.
SAMPLE = 1000


@dataclass
class Model:
    table: np.ndarray
    softmax: np.ndarray
    bias: float

    def gram_scores(self) -> np.ndarray:
        """What each row of the table adds to the difference of the two logits: a mean of vectors under a linear map is a mean of these."""
        return (self.table @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float32)


def subwords(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash buckets of all n-grams and words of a chunk, the segment of each, and the document of each segment.

    Each document begins and ends with a separator. Letters, digits and all bytes above ASCII make words.
    """
    data = lowered(data)
    letter = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    data = np.where(letter, data, np.uint8(32))
    starts = np.zeros(len(data), np.int64)
    starts[1:] = letter[1:] & ~letter[:-1]
    word = np.cumsum(starts) - 1  # of a letter: its word; of a separator: the word before it
    begins = np.flatnonzero(starts)
    of = np.searchsorted(bounds, begins, "right") - 1
    n_words = np.bincount(of, minlength=len(bounds) - 1)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    n_segments = -(-n_words // SEGMENT)
    first_segment = np.concatenate([[0], np.cumsum(n_segments)])
    segment = first_segment[of] + (np.arange(len(begins)) - first_word[of]) // SEGMENT
    h, gaps = Hasher(data), np.concatenate([[0], np.cumsum(~letter)])
    ids, where = [], []
    for n in GRAMS:
        at = np.flatnonzero(gaps[n - 1 : len(data)] == gaps[1 : len(data) - n + 2])  # all but the ends are letters
        ids.append(h(at, at + n))
        where.append(segment[word[at + 1]])
    gap_at = np.flatnonzero(~letter)
    ends = gap_at[np.searchsorted(gap_at, begins)] if len(begins) else begins
    ids.append(mix64(h(begins, ends) + np.uint64(1)))
    where.append(segment)
    of_segment = np.repeat(np.arange(len(bounds) - 1), n_segments)
    return (np.concatenate(ids) % np.uint64(BUCKETS)).astype(np.int32), np.concatenate(where).astype(np.int32), of_segment


def fit(texts: list[str | None], labels: np.ndarray, steps: int = 36, rate: float = 0.03, decay: float = 8e-3, seed: int = 5) -> Model:
    """Full-batch training; the classes weigh alike. First all segments of a text carry its label, then only its worst one does."""
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)), rng.normal(0, 0.3, (DIMENSIONS, 2)), 0.0)
    if len(set(labels.tolist())) < 2:
        return Model(model.table * 0, model.softmax, 5.0 * (2 * float(labels.mean()) - 1) if len(labels) else -5.0)
    parts, of, n_segments = [], [], 0  # of each chunk: buckets, segments counted within the chunk, the chunk's segments
    for first, data, bounds in chunks(texts, b" ", b" "):
        ids, where, own = subwords(data, bounds)
        where = where.astype(np.min_scalar_type(max(1, len(own))))
        parts.append((ids, where, slice(n_segments, n_segments + len(own))))
        of.append(own + first)
        n_segments += len(own)
    of = np.concatenate(of)
    size = np.concatenate([np.bincount(where, minlength=at.stop - at.start) for _, where, at in parts])
    docs, first = np.unique(of, return_index=True)  # documents that have words
    y = labels[docs].astype(float)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    per_doc = np.diff(np.append(first, n_segments))
    moments = [np.zeros_like(model.table), np.zeros_like(model.softmax)]
    for step in range(steps):
        scores = model.gram_scores()
        logit = np.concatenate([np.bincount(where, scores[ids], at.stop - at.start) for ids, where, at in parts]) / size + model.bias
        if step < steps // 4:
            doc_logit = np.add.reduceat(logit, first) / per_doc
            share = np.repeat(1 / per_doc, per_doc)
        else:
            doc_logit = np.maximum.reduceat(logit, first)
            share = (logit >= np.repeat(doc_logit, per_doc)).astype(float)
        wrong = (_sigmoid(doc_logit) - y) * weight
        slope = np.repeat(wrong, per_doc) * share / size
        each = sum(np.bincount(ids, slope[at][where], BUCKETS) for ids, where, at in parts)
        difference = model.softmax[:, 1] - model.softmax[:, 0]
        d_softmax = (each @ model.table)[:, None] * np.array([[-1.0, 1.0]])
        for value, moment, gradient, pace in ((model.table, moments[0], each[:, None] * difference, 0.3), (model.softmax, moments[1], d_softmax, 0.05)):
            moment *= 0.9
            moment += gradient / (np.sqrt(np.square(gradient).mean()) + 1e-12)
            value -= rate * pace * moment
        model.table *= 1 - decay
        model.bias -= rate * 20 * float(wrong.sum())
    return model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(texts: Iterable[str | None], model: tuple[np.ndarray, float]) -> np.ndarray:
    """A score for each text; those without words have the score of the bias alone."""
    scores, bias = model
    out = []
    for _, data, bounds in chunks(texts, b" ", b" "):
        ids, where, of = subwords(data, bounds)
        n = len(of)
        logit = np.bincount(where, scores[ids], n) / np.maximum(np.bincount(where, minlength=n), 1)
        worst = np.full(len(bounds) - 1, -np.inf)
        np.maximum.at(worst, of, logit)
        out.append(_sigmoid(np.where(np.isinf(worst), 0.0, worst) + bias))
    return np.concatenate(out) if out else np.empty(0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> tuple[np.ndarray, float]:
    model = fit(*labelled_sample(docs, labels, label, per_class, doc_id, text))
    return model.gram_scores(), model.bias


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``; ``predicted`` is 1 from a score of 0.5.

    The model is fitted on at most ``per_class`` labelled texts of each class outside the held-out fold. Null and empty texts are scored
    like texts without words; rows that share an id are scored each; null ids are held out; other columns are ignored, whatever their
    names; no rows give no rows. Without labels of both classes, the score is a constant on the side of the only one, or low if none.
    """
    model = train(docs, labels, label, per_class, doc_id, text)
    rows = with_score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), score_texts, model, "text", "score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below 0.5. Cases are as in :func:`score`."""
    name = free_name(docs, "toxicity")
    rows = with_score(docs, score_texts, train(docs, labels, label, per_class, doc_id, text), text, name)
    return rows.where(F.col(name) < 0.5).drop(name)
