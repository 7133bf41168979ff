"""Cuckoo filters as bytes: sets of 16-byte digests that may answer yes wrongly, but never no, and that
forget what is deleted.

A digest has two buckets of four cells; a cell holds 16 bits of the digest, 0 if empty. The second
bucket follows from the first one and those bits alone, so a cell can be moved to its other bucket without
knowing the digest it came from. Every digest has a cell of its own, also where another one has the
same bits: deleting a digest that was inserted never takes another's.
"""

from __future__ import annotations

import numpy as np

CELLS = 4
KICKS = 500
_SPREAD = np.uint64(0x5BD1E9955BD1E995)


def bucket_count(digests: int) -> int:
    """Buckets, a power of two, for so many digests at three quarters full or less."""
    return 1 << max(1, (-(-digests * 4 // (3 * CELLS)) - 1).bit_length())


def empty(digests: int) -> np.ndarray:
    return np.zeros((bucket_count(digests), CELLS), np.uint16)


def load(cells: bytes) -> np.ndarray:
    return np.frombuffer(cells, np.uint16).reshape(-1, CELLS).copy()


def _marks(digests: np.ndarray) -> np.ndarray:
    """The 16 bits of each digest (of two uint64), 1 to 65,535."""
    return (digests[:, 1] % np.uint64(65_535) + np.uint64(1)).astype(np.uint16)


def _first(digests: np.ndarray, mask: np.uint64) -> np.ndarray:
    """By the second four bytes: shards go by the first four."""
    return (digests[:, 0] >> np.uint64(32)) & mask


def _other(bucket, mark, mask):
    return bucket ^ (np.uint64(mark) * _SPREAD >> np.uint64(20)) & mask


def words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def contains(cells: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Whether each digest may be in the filter: False is certain."""
    mask, marks = np.uint64(len(cells) - 1), _marks(digests)
    first = _first(digests, mask)
    with np.errstate(over="ignore"):
        second = first ^ (marks.astype(np.uint64) * _SPREAD >> np.uint64(20)) & mask
    wanted = marks[:, None]
    return (cells[first] == wanted).any(1) | (cells[second] == wanted).any(1)


def insert(cells: np.ndarray, digests: np.ndarray) -> bool:
    """Put the digests in, each once. False if a place can't be found: the filter is then spoilt and has to be
    built anew, larger, from the digests themselves."""
    mask = np.uint64(len(cells) - 1)
    firsts, marks = _first(digests, mask), _marks(digests)
    turn = 0
    with np.errstate(over="ignore"):
        for bucket, mark in zip(firsts, marks, strict=True):
            for kick in range(KICKS):
                row = cells[bucket]
                free = np.flatnonzero(row == 0)
                if not len(free) and not kick:
                    bucket = _other(bucket, mark, mask)
                    row = cells[bucket]
                    free = np.flatnonzero(row == 0)
                if len(free):
                    row[free[0]] = mark
                    break
                turn = (turn + 1) % CELLS
                mark, row[turn] = row[turn], mark
                bucket = _other(bucket, mark, mask)
            else:
                return False
    return True


def delete(cells: np.ndarray, digests: np.ndarray) -> None:
    """Take out digests that were put in."""
    mask = np.uint64(len(cells) - 1)
    with np.errstate(over="ignore"):
        for first, mark in zip(_first(digests, mask), _marks(digests), strict=True):
            for bucket in (first, _other(first, mark, mask)):
                held = np.flatnonzero(cells[bucket] == mark)
                if len(held):
                    cells[bucket, held[0]] = 0
                    break
            else:
                raise ValueError("a digest to delete is not in the filter")


def build(digests: np.ndarray) -> np.ndarray:
    size = len(digests)
    while True:
        cells = empty(size)
        if insert(cells, digests):
            return cells
        size = len(cells) * CELLS
