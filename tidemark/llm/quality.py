"""Quality from overlapping heuristics: an EM label model, then a hashed linear scorer.

Simple labellers vote good, bad or nothing on each document. Expectation-maximisation over the counts
of vote patterns, which cover all documents, estimates how often each labeller votes what on good
and on bad documents, without any true label; that gives each pattern's probability of being good.
A linear model over hashed words and word shapes learns these soft labels and scores every text, so
that documents on which the labellers are silent or at odds are judged by their content.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, texts
from tidemark.llm.linear import Sparse, counted, fit, from_lists, owners_of, sigmoid
from tidemark.llm.words import LETTER, NUMBER, OTHER, SPACE, Words, blocks, character_classes, split_words

BITS = 16
# Words and shapes share 1 << BITS features; degrees of repetition follow.
FEATURES = (1 << BITS) + 256
# Ordinary punctuation; other characters that are neither letters, digits nor space are symbols.
PUNCTUATION = ".,;:?'\"()-’“”–—¿¡"
LABELLERS = ("symbols", "capitals", "bars", "exclamation", "repetition", "echo", "length", "letters")
GOOD, BAD, SILENT = 1, 0, 2


def _per_text(words: Words, values: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[words.cuts[1:]] - sums[words.cuts[:-1]]


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def votes(values: list[str]) -> tuple[np.ndarray, Words, np.ndarray, np.ndarray]:
    """The labellers' votes, a row per text, with the words, their shapes, and degrees of repetition."""
    words = split_words(values, spaced=False)
    codes = np.frombuffer(words.text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = character_classes()[codes]
    plain = np.isin(codes, [ord(c) for c in PUNCTUATION])
    # Upper case by Python's own rule, for the characters that occur.
    distinct, back = np.unique(codes, return_inverse=True)
    upper = np.array([chr(c).isupper() for c in distinct], bool)[back]
    length = words.ends - words.starts

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[words.ends] - sums[words.starts]

    letters, uppers = count(kinds == LETTER), count(upper)
    symbols = count((kinds == OTHER) & ~plain)
    bars, shouts = count(codes == ord("|")), count(codes == ord("!"))
    per = {name: _per_text(words, v) for name, v in (
        ("chars", length), ("letters", letters), ("uppers", uppers), ("symbols", symbols),
        ("bars", bars), ("shouts", shouts), ("words", (letters > 0).astype(np.int64)))}
    owners = owners_of(words)
    # Runs of three words, told apart by hash: how many of a text's are distinct.
    real = np.flatnonzero(letters > 0)
    own, h = owners[real], words.hashes[real]
    triple = h[:-2] * np.uint64(3) ^ h[1:-1] * np.uint64(5) ^ h[2:] * np.uint64(7) if len(h) > 2 else h[:0]
    inside = own[:-2] == own[2:] if len(h) > 2 else np.zeros(0, bool)
    runs, _ = counted(own[:-2][inside] if len(h) > 2 else own[:0],
                      (triple[inside] >> np.uint64(24)).astype(np.int64), len(values), 40)
    total = np.bincount(own[:-2][inside] if len(h) > 2 else own[:0], minlength=len(values))
    fresh = _ratio(np.diff(runs.cuts), total)
    # Words that are the word before again.
    again = np.zeros(len(own), np.int64)
    again[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    echo = _ratio(np.bincount(own, again, minlength=len(values)), per["words"])

    def vote(measure: np.ndarray, bad: np.ndarray, good: np.ndarray, on: np.ndarray) -> np.ndarray:
        return np.where(on & bad, BAD, np.where(on & good, GOOD, SILENT))

    some = per["words"] > 0
    symbol, capital = _ratio(per["symbols"], per["chars"]), _ratio(per["uppers"], per["letters"])
    bar, shout = _ratio(per["bars"], per["words"]), _ratio(per["shouts"], per["words"])
    letter = _ratio(per["letters"], per["chars"])
    table = np.stack([
        vote(symbol, symbol > 0.1, symbol < 0.03, per["chars"] >= 40),
        vote(capital, capital > 0.4, capital < 0.15, per["letters"] >= 20),
        vote(bar, bar > 0.2, bar < 0.02, some),
        vote(shout, shout > 0.3, shout < 0.05, some),
        vote(fresh, fresh < 0.6, fresh > 0.9, total >= 20),
        vote(echo, echo > 0.3, echo < 0.05, per["words"] >= 5),
        vote(letter, per["words"] < 1, per["words"] >= 20, np.ones(len(values), bool)),
        vote(letter, letter < 0.75, letter > 0.9, per["chars"] >= 120),
    ], axis=1).astype(np.int8) if values else np.zeros((0, len(LABELLERS)), np.int8)
    # A word's shape: what it begins with, whether it shouts, how long it is.
    first = codes[words.starts]
    shape = np.where(letters > 0,
                     (uppers == letters) * 2 + upper[words.starts] + 4 * np.minimum(length, 12),
                     64 + np.where(kinds[words.starts] == NUMBER, 0, 1 + first % 4093))
    # What single words don't show: repetition in tenths, from 20 words on.
    repeats = np.where(total >= 20, 1 + np.minimum(fresh * 10, 9).astype(np.int64)
                       + 16 * np.minimum(echo * 10, 9).astype(np.int64), 0)
    return table, words, shape, repeats


def features(words: Words, shape: np.ndarray, repeats: np.ndarray) -> Sparse:
    """Square roots of the shares that each hashed word and each shape has of a text's words, and the
    text's degree of repetition."""
    rows = len(repeats)
    owners = owners_of(words)
    size = np.uint64(64 - BITS + 1)
    word = (words.hashes >> size).astype(np.int64)
    mixed = (shape.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    shapes = (mixed >> size).astype(np.int64) + (1 << BITS - 1)
    sizes = np.maximum(np.diff(words.cuts), 1)
    x, counts = counted(
        np.concatenate([owners, owners, np.arange(rows)]),
        np.concatenate([word, shapes, repeats + (1 << BITS)]), rows, BITS + 1)
    value = np.where(x.index >> BITS, 1.0, np.sqrt(counts / sizes[x.owners()]))
    return Sparse(x.cuts, x.index, value)


@dataclass(frozen=True)
class LabelModel:
    """good: share of good documents; rates[labeller, class, vote], 1 for silence."""

    good: float
    rates: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        log = np.log(np.array([1 - self.good, self.good]))[None, :].repeat(len(patterns), 0)
        for k in range(patterns.shape[1]):
            log += np.log(self.rates[k][:, patterns[:, k]]).T
        return sigmoid(log[:, 1] - log[:, 0])


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM from the view that a bad vote is seldom wrong: documents are bad in different ways, each of
    which only some labellers see, so the majority would outvote them."""
    q = 0.95 * 0.2 ** (patterns == BAD).sum(1)
    model = LabelModel(0.5, np.full((patterns.shape[1], 2, 3), 1 / 3))
    for _ in range(rounds):
        share = float((counts * q).sum() / max(1, counts.sum()))
        rates = np.ones_like(model.rates)
        for k in range(patterns.shape[1]):
            # A silent labeller says nothing about the class: it is silent on short texts.
            for v in (BAD, GOOD):
                hit = patterns[:, k] == v
                rates[k, GOOD, v] += (counts * q)[hit].sum()
                rates[k, BAD, v] += (counts * (1 - q))[hit].sum()
        rates[:, :, :SILENT] /= rates[:, :, :SILENT].sum(2, keepdims=True)
        model = LabelModel(min(max(share, 0.01), 0.99), rates)
        q = model.posterior(patterns)
    return model


def _codes(table: np.ndarray) -> np.ndarray:
    return (table.astype(np.int64) * 3 ** np.arange(len(LABELLERS))).sum(1)


def _patterns(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def vote_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [t or "" for t in batch.column("text").to_pylist()]
        codes = [_codes(votes(values[a:b])[0]) for a, b in blocks(values)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(codes) if codes else [], pa.int64())],
            names=["doc_id", "pattern"])


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [t or "" for t in batch.column("text").to_pylist()]
        for begin, end in blocks(values):
            table, words, shape, repeats = votes(values[begin:end])
            x = features(words, shape, repeats)
            ranges = list(zip(x.cuts[:-1], x.cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(_codes(table)),
                pa.array([x.index[a:b] for a, b in ranges], pa.list_(pa.int64())),
                pa.array([x.value[a:b] for a, b in ranges], pa.list_(pa.float64())),
            ], names=["pattern", "index", "value"])


@dataclass(frozen=True)
class Scorer:
    labels: LabelModel
    weights: np.ndarray
    intercept: float


def train(docs: DataFrame, most_rows: int = 6000) -> Scorer:
    """The label model from all documents' votes, the scorer from at most ``most_rows`` documents."""
    own = texts(docs)
    patterns = own.mapInArrow(lambda batches: releasing(vote_patterns(batches)), "doc_id bigint, pattern bigint")
    # At most 3 ** labellers rows, whatever the corpus.
    counted_patterns = patterns.groupBy("pattern").count().collect()
    codes = np.array([r[0] for r in counted_patterns], np.int64)
    labels = fit_label_model(_patterns(codes), np.array([r[1] for r in counted_patterns], float))
    # The ids alone are ordered; the texts of at most most_rows of them are read.
    chosen = own.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    rows = own.join(F.broadcast(chosen), "doc_id").mapInArrow(
        _training_rows, "pattern bigint, index array<bigint>, value array<double>").toArrow()
    # Repeated ids could exceed the bound.
    rows = rows.slice(0, most_rows)
    if not len(rows):
        return Scorer(labels, np.zeros(FEATURES, np.float32), 4.0)
    x = from_lists(rows.column("index"), rows.column("value"))
    target = labels.posterior(_patterns(rows.column("pattern").to_numpy()))
    weights, _, intercept = fit(x, target, FEATURES, penalty=1e-6, rate=0.5)
    return Scorer(labels, weights.astype(np.float32), float(intercept))


def score(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [t or "" for t in batch.column("text").to_pylist()]
        posterior, scores = [], []
        for a, b in blocks(values):
            table, words, shape, repeats = votes(values[a:b])
            posterior.append(scorer.labels.posterior(table))
            x = features(words, shape, repeats)
            scores.append(sigmoid(x.dot(scorer.weights) + scorer.intercept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(np.concatenate(v) if v else [], pa.float64())
                                       for v in (posterior, scores))],
            names=["doc_id", "posterior", "score"])


def score_quality(docs: DataFrame, threshold: float = 0.5, most_rows: int = 6000) -> DataFrame:
    """Every row of docs: doc_id, posterior (the label model's), score (the scorer's, from 0 to 1) and
    kept (score of at least ``threshold``).

    Null and empty texts have no words: the length labeller calls them bad, and they get the
    intercept's score. Repeated rows are scored each; columns other than doc_id and text are ignored;
    an empty table gives an empty result.
    """
    scorer = train(docs, most_rows)
    return texts(docs).mapInArrow(
        lambda batches: releasing(score(batches, scorer)), "doc_id bigint, posterior double, score double",
    ).withColumn("kept", F.col("score") >= threshold)
