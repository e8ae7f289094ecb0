"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A document is toxic if one of its sentences is: with sentence probabilities p_s =
sigmoid(b + sum of word weights), the document's is the noisy-or 1 - prod(1 - p_s).
Weights are trained through that from document labels, and then point at the sentences.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.words import mix

SAMPLE_PER_CLASS = 3_000  # labelled documents of either label that are trained on, at most
BEGINNINGS = (4, 5, 6)  # lengths of word beginnings that are weighed like words
TELLING = 3.0  # deviations by which a word's log odds of toxic documents must exceed zero
LEAST_ODDS = 1.6  # and what they must come to: five to one
MISLABELLED = 0.02  # share of documents without an offending sentence that are labelled toxic
OFFENDING = 0.5  # a sentence with this probability is reported

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each stretch between full stops, exclamation or question marks and
    line ends that holds a word."""
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(text, *m.span())]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(text, label) of at most per_class documents of each label, by the digest of doc_id.

    Labels of a doc_id that occur more than once count as their rounded-up mean; null ids
    and labels are left out.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.ceil(F.avg(label)).cast("int").alias("label")).withColumn("_o", F.xxhash64("doc_id")))
    some = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy("_o", "doc_id").limit(per_class)
        some = part if some is None else some.unionAll(part)
    return docs.select("doc_id", "text").join(F.broadcast(some.select("doc_id", "label")), "doc_id").select("text", "label")


def tells(words: list[str]) -> set[str]:
    """Lower-case words and, marked by a tilde, the beginnings of longer ones: insults are inflected."""
    own = set(words)
    return own.union(*({w[:n] + "~" for w in own if len(w) > n} for n in BEGINNINGS))


def _features(batches):
    """What tells in each sentence, one row a document."""
    for batch in batches:
        lists = [[sorted(tells(_WORD.findall(t[a:b].lower()))) for a, b in sentences(t)] for t in (x or "" for x in batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists, pa.list_(pa.list_(pa.string()))), batch.column("label")], names=["sentences", "label"])


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS, rounds: int = 200,
          rate: float = 0.8, shrink: float = 0.0003, resting: float = -9.0) -> ToxicityModel:
    """Fit on a sample of labelled documents whose size per_class bounds.

    Proximal gradient steps (Adagrad) on the noisy-or likelihood, classes weighted alike;
    Only words that are significantly more often in sentences of toxic documents are weighed, and
    `shrink` is the L1 price on them; `resting` bounds the log odds of
    a sentence without any, so that long clean texts stay clean.  Without documents of both
    labels the model says 0 for all texts.
    """
    rows = labelled_sample(docs, labels, label, per_class).mapInArrow(_features, "sentences array<array<string>>, label int").toArrow()
    labelled = rows.column("label").to_numpy().astype(np.float64)
    if len(set(labelled.tolist())) < 2:
        return ToxicityModel({}, -30.0)
    per_doc = rows.column("sentences").combine_chunks()
    per_doc = per_doc.chunk(0) if isinstance(per_doc, pa.ChunkedArray) else per_doc
    per_sentence = per_doc.flatten()
    encoded = per_sentence.flatten().dictionary_encode()
    words = encoded.dictionary.to_pylist()
    word = encoded.indices.to_numpy()
    sent = np.repeat(np.arange(len(per_sentence)), per_sentence.value_lengths().to_numpy())
    doc_of = np.repeat(np.arange(len(per_doc)), per_doc.value_lengths().to_numpy())
    # A sentence counts once between the same neighbours: copies of a document are no evidence,
    # but a sentence found again among others is.
    starts = np.flatnonzero(np.r_[True, sent[1:] != sent[:-1]])
    whole = np.zeros(len(per_sentence), np.uint64)
    whole[sent[starts]] = np.add.reduceat(mix(word.astype(np.uint64)), starts)
    first_of_doc = np.r_[True, doc_of[1:] != doc_of[:-1]]
    before = np.where(first_of_doc, np.uint64(0), np.r_[np.uint64(0), whole[:-1]])
    after = np.where(np.r_[first_of_doc[1:], True], np.uint64(0), np.r_[whole[1:], np.uint64(0)])
    same = mix(whole + mix(before + np.uint64(1)) + mix(mix(after + np.uint64(2))))[sent[starts]]
    toxic = labelled[doc_of[sent[starts]]] == 1
    held, left = [], []
    for side in (toxic, ~toxic):
        first = np.zeros(len(per_sentence), bool)
        first[sent[starts[np.flatnonzero(side)[np.unique(same[side], return_index=True)[1]]]]] = True
        held.append(np.bincount(word[first[sent]], minlength=len(words)) + 0.5)
        left.append(first.sum() + 1 - held[-1])
    odds = np.log(held[0] / left[0]) - np.log(held[1] / left[1])
    keep = (odds >= LEAST_ODDS) & (odds / np.sqrt(1 / held[0] + 1 / held[1]) >= TELLING)
    used = keep[word]
    word, sent = word[used], sent[used]
    price = np.where(labelled == 1, 0.5 / labelled.sum(), 0.5 / (len(labelled) - labelled.sum()))
    w, bias = np.where(keep, odds, 0.0), resting
    seen_w, seen_b = np.full(len(words), 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(sent, w[word], len(per_sentence)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        safe = np.bincount(doc_of, np.logaddexp(0, z), len(per_doc))  # -log(1 - P)
        clear = np.exp(-safe)
        # d loss / d z_s: p_s in a clean document, -p_s (1 - P) / P in a toxic one, where P
        # counts as no less than MISLABELLED: those may be toxic by mistake.
        push = np.where(labelled == 1, -clear / (MISLABELLED + (1 - MISLABELLED) * (1 - clear)), 1.0) * price
        g = p * push[doc_of]
        grad = np.bincount(word, g[sent], len(words))
        seen_w += grad * grad
        seen_b += g.sum() ** 2
        step = rate / np.sqrt(seen_w)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * shrink, 0)
        bias = min(bias - rate / np.sqrt(seen_b) * g.sum(), resting)
    return ToxicityModel({words[i]: float(w[i]) for i in np.flatnonzero(w)}, float(bias))


def _scored(model: Broadcast, offending: float):
    weights, bias = model.value
    base = float(np.logaddexp(0, bias))
    words = frozenset(weights)

    def score(text: str | None) -> tuple[float, list[dict]]:
        text = text or ""
        spans = sentences(text)
        safe, found = 0.0, []
        telling = words.intersection(tells(_WORD.findall(text.lower())))
        if not telling:
            return 1 - float(np.exp(-base * len(spans))), found
        for a, b in spans:
            own = telling.intersection(tells(_WORD.findall(text[a:b].lower())))
            z = bias + sum(weights[x] for x in own)
            safe += float(np.logaddexp(0, z)) if own else base
            p = 1 / (1 + float(np.exp(-min(max(z, -30), 30))))
            if p >= offending:
                found.append({"start": a, "end": b, "score": p})
        return 1 - float(np.exp(-safe)), found

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, doc_id: str = "doc_id", text: str = "text", offending: float = OFFENDING) -> DataFrame:
    """(doc_id, score, offending) for every row of docs.

    score is the noisy-or of the sentences of the whole text, 0 for null and empty texts.
    offending lists start, end (code points, end exclusive) and score of each sentence with
    a probability of `offending` or more.  Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # words of the bounded sample

    def rows(batches):
        score = _scored(shared, offending)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            out = [score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.list_(span))],
                names=["doc_id", "score", "offending"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        rows, "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")
