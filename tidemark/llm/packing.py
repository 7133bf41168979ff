"""Packing tokenized documents into sequences of fixed length by minimum bin slack.

A bin takes the longest piece left; a subset-sum bitset over the lengths still available then finds
the fullest combination that fits beside it, which is removed. Bins depend on lengths alone, and
there are at most ``capacity`` lengths. So the plan is made from a histogram of lengths, and each
combination is used as often as its pieces last: the plan's size follows from the capacity, not from
the corpus. Pieces find their places by their rank among pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, texts, written
from tidemark.llm.wordbpe import WordEncoder

PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int")


@dataclass(frozen=True)
class Slots:
    """A run of pieces of one length: ranks from ``rank``, ``per_bin`` of them in each sequence from
    ``sequence`` on, the first at ``offset``."""

    length: int
    rank: int
    per_bin: int
    sequence: int
    offset: int


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, copies) of a fullest combination of at most ``room`` tokens from the lengths that
    counts[length] pieces are left of. Long lengths are tried first and kept in doubt."""
    reach, stages = 1, []
    for length in np.flatnonzero(counts[1:room + 1])[::-1] + 1:
        left = min(int(counts[length]), room // int(length))
        copies = 1
        while left:
            take = min(copies, left)
            stages.append((int(length), take, reach))
            reach |= (reach << (take * int(length))) & ((2 << room) - 1)
            if reach >> room & 1:
                break
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(stages):
        # Left out if the sum was in reach without it.
        if not before >> total & 1:
            total -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return list(chosen.items())


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Slots], int]:
    """Where the pieces of each length go, and the number of sequences."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used = np.zeros(capacity + 1, np.int64)
    slots, sequence = [], 0
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        beside = dict(fullest(counts, capacity - longest))
        counts[longest] += 1
        beside[longest] = beside.get(longest, 0) + 1
        repeats = min(int(counts[length]) // n for length, n in beside.items())
        offset = 0
        for length, n in sorted(beside.items(), reverse=True):
            slots.append(Slots(length, int(used[length]), n, sequence, offset))
            offset += n * length
            used[length] += n * repeats
            counts[length] -= n * repeats
        sequence += repeats
    return slots, sequence


def cut_pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, end_id: int,
               ) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    encoder = WordEncoder.shared(tokenizer)
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for doc_id, ids in zip(
                batch.column(0).to_pylist(), encoder.encode_column(batch.column(1)), strict=True):
            ids = np.append(ids, end_id).astype("<u4")
            for piece, start in enumerate(range(0, len(ids), capacity)):
                own = ids[start:start + capacity]
                for column, value in zip(
                        columns, (doc_id, piece, start, len(own), zlib.crc32(own.tobytes())),
                        strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
             pa.array(np.full(len(columns[0]), part, np.int32))],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "part"])


def place(batches: Iterator[pa.RecordBatch], slots: list[Slots]) -> Iterator[pa.RecordBatch]:
    by_length: dict[int, list[Slots]] = {}
    for s in slots:
        by_length.setdefault(s.length, []).append(s)
    # Slots of a length were made in order of rank.
    tables = {
        length: np.array([(s.rank, s.per_bin, s.sequence, s.offset) for s in own], np.int64).T
        for length, own in by_length.items()}
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("rank").to_numpy()
        sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            first, per_bin, first_sequence, first_offset = tables[int(length)]
            at = np.searchsorted(first, ranks[rows], side="right") - 1
            inside = ranks[rows] - first[at]
            sequence[rows] = first_sequence[at] + inside // per_bin[at]
            offset[rows] = first_offset[at] + inside % per_bin[at] * length
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    Each document's ids end with ``end_id``; a document of more than ``capacity`` ids is cut into
    pieces of that many, the last of which may be shorter. Null and empty texts are the end id
    alone. Repeated rows are packed each. Columns other than doc_id and text are ignored. An empty
    table gives an empty result.
    """
    pieces = written(
        texts(docs).mapInArrow(
            lambda batches: releasing(cut_pieces(batches, tokenizer, capacity, end_id)), PIECES),
        "pack-pieces",
    )
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # At most `capacity` rows, whatever the corpus.
    histogram = dict(counts.groupBy("length").agg(F.sum("n")).collect())
    slots, _ = plan(histogram, capacity)
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # A group is one length within what one task wrote, so a common length is not one group.
    inside = W.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("at", F.row_number().over(inside) - 1).join(bases, ["length", "part"])
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("at") + F.col("base")).alias("rank"),
    ).mapInArrow(
        lambda batches: place(batches, slots),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint")
