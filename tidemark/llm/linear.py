"""Hashed linear models: sparse features of whole texts, logistic regression on bounded samples."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.words import Words, split_words


# Entries of a sample that are worked on at once.
RUN = 1 << 19


@dataclass(frozen=True)
class Sparse:
    """Rows of features: row r has index[cuts[r]:cuts[r + 1]] with the values beside them."""

    cuts: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.cuts) - 1

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.cuts))

    def runs(self, entries: int = RUN) -> Iterator[tuple[int, int]]:
        """Runs of consecutive rows of together about so many entries."""
        begin = 0
        while begin < self.rows:
            end = int(np.searchsorted(self.cuts, self.cuts[begin] + entries, side="right")) - 1
            yield begin, (end := min(max(end, begin + 1), self.rows))
            begin = end

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """Each row times weights, which has a row per feature and may have several columns."""
        parts = weights[self.index] * (self.value if weights.ndim == 1 else self.value[:, None])
        sums = np.zeros((len(parts) + 1, *parts.shape[1:]))
        np.cumsum(parts, axis=0, out=sums[1:])
        return sums[self.cuts[1:]] - sums[self.cuts[:-1]]

    def take(self, rows: np.ndarray) -> Sparse:
        lengths = np.diff(self.cuts)[rows]
        cuts = np.concatenate([[0], lengths.cumsum()])
        if (np.diff(rows) > 0).all():
            keep = np.zeros(self.rows, bool)
            keep[rows] = True
            keep = np.repeat(keep, np.diff(self.cuts))
            return Sparse(cuts, self.index[keep], self.value[keep])
        at = np.arange(cuts[-1]) + np.repeat(self.cuts[rows] - cuts[:-1], lengths)
        return Sparse(cuts, self.index[at], self.value[at])


def from_lists(index: pa.ChunkedArray, value: pa.ChunkedArray | None = None) -> Sparse:
    """One row per list of features; without values, each feature counts as 1. No entry becomes a Python object."""
    def flat(lists: pa.ChunkedArray) -> np.ndarray:
        parts = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in lists.chunks]
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    lengths = pc.list_value_length(index).to_numpy()
    own = flat(index)
    return Sparse(np.concatenate([[0], lengths.astype(np.int64).cumsum()]), own,
                  np.ones(len(own), np.int8) if value is None else flat(value))


def counted(owner: np.ndarray, feature: np.ndarray, rows: int, bits: int) -> tuple[Sparse, np.ndarray]:
    """Distinct features of each row, and how often each occurs."""
    keys, counts = np.unique(owner.astype(np.int64) << bits | feature, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(rows + 1, dtype=np.int64) << bits)
    return Sparse(cuts, keys & ((1 << bits) - 1), np.ones(len(keys))), counts


def owners_of(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.cuts) - 1), np.diff(words.cuts))


def word_presence(texts: list[str], bits: int) -> Sparse:
    """Which lower-case words a text has, by hash."""
    words = split_words([t.lower() for t in texts], spaced=False)
    feature = (words.hashes >> np.uint64(64 - bits)).astype(np.int64)
    return counted(owners_of(words), feature, len(texts), bits)[0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: Sparse, target: np.ndarray, features: int, dense: np.ndarray | None = None,
        penalty: float = 1e-4, rounds: int = 120, rate: float = 0.2):
    """Logistic regression of targets in [0, 1] by Adam on the whole sample. Returns the weights of the
    sparse features, those of the dense columns, and the intercept. Without rows: all zero but an
    intercept that rejects nothing."""
    dense = np.zeros((x.rows, 0)) if dense is None else dense
    columns = dense.shape[1]
    theta = np.zeros(features + columns + 1)
    if not x.rows:
        theta[-1] = -4
        return theta[:features], theta[features:-1], theta[-1]
    prior = (target.sum() + 0.5) / (len(target) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    lengths = np.diff(x.cuts)
    for k in range(1, rounds + 1):
        error = sigmoid(x.dot(theta[:features]) + dense @ theta[features:-1] + theta[-1]) - target
        slope = np.concatenate([
            np.bincount(x.index, np.repeat(error, lengths) * x.value, minlength=features),
            dense.T @ error, [error.sum()]]) / x.rows
        slope[:-1] += penalty * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        theta -= rate * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-8)
    return theta[:features], theta[features:-1], theta[-1]


def without_copies(x: Sparse, bands: int = 6, width: int = 4) -> np.ndarray:
    """The rows of a sample without those that are near copies of an earlier one, by min-hash bands:
    else what a group of copies shares would count as many times as there are copies."""
    filled = np.flatnonzero(np.diff(x.cuts) > 0)
    keep = np.ones(x.rows, bool)
    if not len(filled):
        return np.flatnonzero(keep)
    signatures = np.zeros((bands, x.rows), np.uint64)
    for a, b in x.runs():
        own = np.flatnonzero(np.diff(x.cuts[a:b + 1])) + a
        if not len(own):
            continue
        index, starts = x.index[x.cuts[a]:x.cuts[b]].astype(np.uint64), x.cuts[own] - x.cuts[a]
        for band in range(bands):
            signature = np.zeros(len(own), np.uint64)
            for k in range(width):
                seed = np.uint64(0x9E3779B97F4A7C15 * (band * width + k + 1) & (1 << 64) - 1)
                mixed = (index + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9) ^ seed
                mixed *= np.uint64(0x94D049BB133111EB)
                mixed ^= mixed >> np.uint64(31)
                signature = signature * np.uint64(0x100000001B3) ^ np.minimum.reduceat(mixed, starts)
            signatures[band, own] = signature
    for signature in signatures[:, filled]:
        _, first, same = np.unique(signature, return_index=True, return_inverse=True)
        keep[filled[first[same] != np.arange(len(filled))]] = False
    return np.flatnonzero(keep)


def telling(x: Sparse, targets: np.ndarray, least_rows: int, least_z: float,
            least_share: float) -> Sparse:
    """x without the features that fewer than ``least_rows`` rows have or whose rows don't differ from
    all rows, in any column of targets, by ``least_z`` standard errors, or of whose rows less than
    ``least_share`` have the target: labels are noisy, and such features would only learn by heart
    which labels are wrong."""
    size = int(x.index.max(initial=0)) + 1
    rows, having = np.zeros(size, np.int64), np.zeros((targets.shape[1], size))
    for a, b in x.runs():
        index, lengths = x.index[x.cuts[a]:x.cuts[b]], np.diff(x.cuts[a:b + 1])
        rows += np.bincount(index, minlength=size)
        for have, column in zip(having, targets.T, strict=True):
            have += np.bincount(index, np.repeat(column[a:b], lengths), minlength=size)
    best = np.zeros(size)
    for have, column in zip(having, targets.T, strict=True):
        prior = (column.sum() + 0.5) / (len(column) + 1)
        z = (have - rows * prior) / np.sqrt(np.maximum(rows, 1) * prior * (1 - prior))
        best = np.maximum(best, np.where(have >= least_share * rows, z, 0))
    keep = ((rows >= least_rows) & (best >= least_z))[x.index]
    return Sparse(np.searchsorted(np.flatnonzero(keep), x.cuts), x.index[keep], x.value[keep])
