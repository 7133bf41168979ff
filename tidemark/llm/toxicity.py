"""Toxicity by a classifier chain: categories in order, each model given the earlier probabilities.

The models are logistic regressions on hashed word presence. While they are trained, the earlier
categories' probabilities are out of fold: each row's come from models that haven't seen it, so a
later model doesn't learn to trust them more than it may.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, texts
from tidemark.llm.linear import Sparse, fit, from_lists, sigmoid, telling, without_copies, word_presence
from tidemark.llm.words import blocks

BITS = 18
# Seeds of the finer categories. They mark labelled toxic documents only; the models find the rest.
INSULTS = ("idiot", "moron", "clown", "loser", "scum", "fool", "jerk", "trottel", "depp", "imbécile",
           "crétin", "imbécil", "payaso")
CONTEMPT = ("worthless", "pathetic", "stupid", "disgusting", "trash", "useless", "wertlos",
            "erbärmlich", "dumm", "inutile", "stupide", "patético", "inútil")
_INSULT = re.compile(rf"\b(?:{'|'.join(INSULTS)})\b", re.IGNORECASE)
_CONTEMPT = re.compile(rf"\b(?:{'|'.join(CONTEMPT)})\b", re.IGNORECASE)
SEVERE_HITS = 3
# The last category is the label itself.
CATEGORIES = ("insult", "contempt", "severe", "toxic")


def category_targets(text: str, toxic: int) -> list[int]:
    insults, contempts = len(_INSULT.findall(text)), len(_CONTEMPT.findall(text))
    return [int(toxic and insults > 0), int(toxic and contempts > 0),
            int(toxic and insults + contempts >= SEVERE_HITS), int(toxic)]


@dataclass(frozen=True)
class Chain:
    """weights has a column per category; earlier[c] are the weights of the categories before c."""

    weights: np.ndarray
    earlier: list[np.ndarray]
    intercepts: np.ndarray

    def probabilities(self, x: Sparse) -> np.ndarray:
        margins = x.dot(self.weights) + self.intercepts
        out = np.zeros(margins.shape)
        for c, earlier in enumerate(self.earlier):
            out[:, c] = sigmoid(margins[:, c] + out[:, :c] @ earlier)
        return out


def fit_chain(x: Sparse, targets: np.ndarray, folds: int = 4, least_rows: int = 5,
              least_z: float = 5.0, least_share: float = 0.3) -> Chain:
    rows = without_copies(x)
    x, targets = x.take(rows), targets[rows]
    x = telling(x, targets, least_rows, least_z, least_share)
    size = 1 << BITS
    used, x_index = np.unique(x.index, return_inverse=True)
    x = Sparse(x.cuts, x_index, x.value)
    categories = targets.shape[1]
    weights = np.zeros((size, categories), np.float32)
    intercepts, earlier = np.zeros(categories), []
    held_out = np.zeros((x.rows, categories))
    fold = np.arange(x.rows) % folds
    for c in range(categories):
        for k in range(folds):
            rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            w, e, b = fit(x.take(rest), targets[rest, c], len(used), held_out[rest, :c])
            held_out[own, c] = sigmoid(x.take(own).dot(w) + held_out[own, :c] @ e + b)
        w, e, b = fit(x, targets[:, c], len(used), held_out[:, :c])
        weights[used, c], intercepts[c] = w, b
        earlier.append(e)
    return Chain(weights, earlier, intercepts)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = [t or "" for t in batch.column("text").to_pylist()]
        toxic = batch.column("toxic").to_pylist()
        for lo, hi in blocks(whole):
            values = whole[lo:hi]
            x = word_presence(values, BITS)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(lo, hi - lo),
                pa.array([x.index[a:b].astype(np.int32) for a, b in zip(x.cuts[:-1], x.cuts[1:], strict=True)],
                         pa.list_(pa.int32())),
                pa.array([category_targets(t, y) for t, y in zip(values, toxic[lo:hi], strict=True)],
                         pa.list_(pa.int32())),
            ], names=["doc_id", "features", "targets"])


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> Chain:
    """The chain, from at most ``most_rows`` labelled documents, those with the lowest hashes. Labels of
    documents that aren't there, and null labels, don't count; without labels nothing is toxic."""
    # At most most_rows ids.
    sample = (
        labels.where(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull())
        .groupBy(labels["doc_id"].cast("bigint").alias("doc_id"))
        .agg(F.max(labels["toxic"].cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    )
    rows = texts(docs).join(F.broadcast(sample), "doc_id").mapInArrow(
        _training_rows, "doc_id bigint, features array<int>, targets array<int>").toArrow()
    # Repeated ids could exceed the bound; the order makes the fit repeatable.
    rows = rows.sort_by("doc_id").slice(0, most_rows)
    if not len(rows):
        return Chain(np.zeros((1 << BITS, len(CATEGORIES)), np.float32),
                     [np.zeros(c) for c in range(len(CATEGORIES))], np.full(len(CATEGORIES), -4.0))
    return fit_chain(from_lists(rows.column("features")), np.array(rows.column("targets").to_pylist(), float))


def score(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [t or "" for t in batch.column("text").to_pylist()]
        found = [chain.probabilities(word_presence(values[a:b], BITS)) for a, b in blocks(values)]
        p = np.concatenate(found) if found else np.zeros((0, len(CATEGORIES)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(p[:, c]) for c in range(len(CATEGORIES)))],
            names=["doc_id", *(f"p_{c}" for c in CATEGORIES)])


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                   most_rows: int = 20_000, rows: DataFrame | None = None) -> DataFrame:
    """Every row of docs (of ``rows`` if given, which may have other ids; docs then only train): doc_id, the probability of each category, and toxic (of the last one, at
    least ``threshold``).

    Null and empty texts have no words and get the intercept's probability. Repeated rows are scored
    each; columns other than doc_id and text are ignored; an empty table gives an empty result.
    """
    chain = train(docs, labels, most_rows)
    return texts(docs if rows is None else rows).mapInArrow(
        lambda batches: releasing(score(batches, chain)),
        "doc_id bigint, " + ", ".join(f"p_{c} double" for c in CATEGORIES),
    ).withColumn("toxic", F.col(f"p_{CATEGORIES[-1]}") >= threshold)
