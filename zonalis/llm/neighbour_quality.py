"""Quality by nearest-neighbour voting in a latent semantic space.

Terms of a document are its common words, the shapes of all its words and how often a word
repeats the one before it.  A bounded labelled sample gives the vocabulary, the term weights
and, by singular value decomposition, the latent space.  The sample's vectors are broadcast;
every document's vector is compared with all of them in blocked matrix products, and its
nearest neighbours vote with a weight that grows with their cosine.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 6_000  # labelled documents that are trained on, at most
VOCABULARY, SHAPES = 1_000, 256
LATENT, NEIGHBOURS, SHARPNESS = 48, 25, 6
ROWS = 256
CACHE = 200_000


def shape(word: str) -> int:
    """A number for the pattern of letter case, digits and marks of a word."""
    letters = "".join(c for c in word if c.isalpha())
    case = "A" if len(letters) > 1 and letters.isupper() else "a" if letters else ""
    rest = "".join(dict.fromkeys("0" if c.isdigit() else c for c in word if not c.isalpha()))
    text = f"{case}{rest}{min(len(word).bit_length(), 6)}".encode()
    h = 2166136261
    for b in text:
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h % SHAPES


class _Terms(dict):
    """Number of a word's term: its place in the vocabulary, or after it that of its shape."""

    def __init__(self, vocabulary: list[str]):
        super().__init__()
        self.vocabulary = vocabulary
        self.fixed = {w: i for i, w in enumerate(vocabulary)}

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        at = self.fixed.get(word)
        self[word] = at = len(self.vocabulary) + shape(word) if at is None else at
        return at


def _term_matrix(texts: list[str | None], terms: _Terms) -> np.ndarray:
    """One row a text: square roots of term shares; all zero without words."""
    v = len(terms.vocabulary)
    out = np.zeros((len(texts), v + SHAPES + 1), np.float32)
    of = np.array([shape(w) for w in terms.vocabulary], dtype=np.int64)
    for row, text in zip(out, texts, strict=True):
        words = (text or "").split()
        if not words:
            continue
        counts = np.bincount(np.fromiter(map(terms.__getitem__, words), np.int64, len(words)), minlength=v + SHAPES)
        row[: v + SHAPES] = counts
        np.add.at(row, v + of, counts[:v])
        row[-1] = 4 * sum(map(eq, words, words[1:]))
        row /= len(words)
    return np.sqrt(out)


@dataclass(frozen=True)
class QualityModel:
    vocabulary: list[str]
    weights: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _latent(terms: np.ndarray, weights: np.ndarray, space: np.ndarray) -> np.ndarray:
    x = (terms * weights) @ space
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = SAMPLE, vocabulary: int = VOCABULARY, latent: int = LATENT) -> QualityModel:
    """Fit on at most `sample` labelled documents, the first by the digest of doc_id.

    Labels of a doc_id that occur more than once count as their rounded mean; null ids and
    labels are left out.  Without any labelled text all scores are 0.5.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.round(F.avg(label)).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.length("text") > 0)
    words = some.select(F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("w")).filter(F.length("w").between(1, 20))
    often = [r[0] for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(vocabulary).collect()]

    def rows(batches):
        terms = _Terms(often)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), ROWS):
                m = _term_matrix(texts[at : at + ROWS], terms)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in m], pa.binary()), batch.column("label").slice(at, len(m))], names=["terms", "label"])

    got = some.select("text", "label").mapInArrow(rows, "terms binary, label int").toArrow()
    n = len(often) + SHAPES + 1
    terms = np.frombuffer(b"".join(got.column("terms").to_pylist()), np.float32).reshape(-1, n).astype(np.float64)
    held = (terms > 0).sum(0)
    weights = np.log((1 + len(terms)) / (1 + held)) + 1
    x = terms * weights
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    _, vectors = np.linalg.eigh(x.T @ x)
    space = vectors[:, ::-1][:, : min(latent, n)]
    return QualityModel(often, weights, space, _latent(terms, weights, space).astype(np.float32), got.column("label").to_numpy().astype(np.float64))


def score_quality(docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text", neighbours: int = NEIGHBOURS,
                  sharpness: float = SHARPNESS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, n_neighbours) and the columns in `keep` for every row of docs.

    score is the share of label 1 among the `neighbours` nearest sample vectors, each weighed
    by its cosine (none below zero) to the power `sharpness`.  A null or blank text has no
    terms and scores 0; one without neighbours of positive cosine scores 0.5.
    """
    # Bounded by the sample and the vocabulary: some megabytes.
    shared = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.weights, model.space, model.vectors, model.labels))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"), *keep)
    kept = source.select("doc_id", *keep)

    def rows(batches):
        vocabulary, weights, space, vectors, labels = shared.value
        terms = _Terms(vocabulary)
        k = min(neighbours, len(labels))
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for at in range(0, len(texts), ROWS):
                m = _term_matrix(texts[at : at + ROWS], terms)
                score, n = np.full(len(m), 0.5), np.zeros(len(m), np.int64)
                if k:
                    cosine = _latent(m, weights, space).astype(np.float32) @ vectors.T
                    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
                    vote = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** sharpness
                    total = vote.sum(1)
                    n = (vote > 0).sum(1)
                    score = np.where(total > 0, (vote * labels[near]).sum(1) / np.maximum(total, 1e-300), 0.5)
                score[~m.any(axis=1)] = 0.0
                part = batch.slice(at, len(m))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in ("doc_id", *keep)] + [pa.array(np.clip(score, 0, 1)), pa.array(n, pa.int64())],
                    names=["doc_id", *keep, "score", "n_neighbours"])

    return source.mapInArrow(rows, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("n_neighbours", T.LongType())]))
