"""Byte-level BPE of whole documents: the merges run once per distinct word.

Distinct words are counted over all documents. Those that occur often, as many as fit a stated
bound, are merged once and their ids sent to every task; a word beyond the bound is merged
where it stands, by the same expressions, once per block of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Merges, read_ranks
from tidemark.llm.common import release_memory, releasing, texts, written
from tidemark.llm.words import Words, blocks, gather, split_words

# Words of up to so many bytes may be sent to every task.
SENT_BYTES = 64
HELD = 300_000
IDS = "doc_id bigint, ids array<int>"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_digest string, decoded_digest string"
BLOCK = "doc_ids array<bigint>, cuts binary, codes binary, rare array<string>"


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes, an example of each, each one's count, and every word's place among them."""
    coded = pa.array(words.hashes).dictionary_encode()
    codes, hashes = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    example = np.zeros(len(hashes), np.int64)
    example[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return hashes, example, np.bincount(codes, minlength=len(hashes)), codes


def _values(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a task's texts with their counts, summed up as far as HELD words go."""
    hashes, counts, held = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.tolist(), pa.string()), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        values = _values(batch)
        for a, b in blocks(values):
            words = split_words(values[a:b], spaced=True)
            found, example, n, _ = _distinct(words)
            keep = found != 0
            found, example, n = found[keep], example[keep], n[keep]
            at = np.minimum(np.searchsorted(hashes, found), max(0, len(hashes) - 1))
            known = hashes[at] == found if len(hashes) else np.zeros(len(found), bool)
            counts[at[known]] += n[known]
            fresh = np.flatnonzero(~known)
            fresh = fresh[np.argsort(found[fresh])]
            # What is held stays in order: only the block's own words are sorted.
            place = np.searchsorted(hashes, found[fresh])
            spelled = np.array([words.word(w) for w in example[fresh]], object)
            hashes, counts, held = (np.insert(old, place, new) for old, new in (
                (hashes, found[fresh]), (counts, n[fresh]), (held, spelled)))
            if len(hashes) > HELD:
                yield out()
                hashes, counts, held = hashes[:0], counts[:0], held[:0]
    if len(hashes):
        yield out()


@dataclass(frozen=True)
class Known:
    """Ids of the words sent to every task, in the order of their hashes: word w has lengths[w] ids of the pool
    from begins[w]. Numbers are as narrow as they may be, since each worker holds them twice."""

    begins: np.ndarray
    lengths: np.ndarray
    pool: np.ndarray


def known_words(own: DataFrame, merges: Merges, most_words: int) -> tuple[np.ndarray, Known]:
    """The hashes of the words sent to every task, in order, and their ids."""
    counted = written(
        own.mapInArrow(lambda batches: releasing(count_words(batches)), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "bpe-words")
    short = counted.where(F.octet_length("word") <= SENT_BYTES).withColumn(
        "level", F.floor(F.log2("n") * 8).cast("int"))
    # A row per eighth of a power of two.
    levels = sorted(short.groupBy("level").count().collect(), reverse=True)
    least, total = None, 0
    for level, n in levels:
        total += n
        if total > most_words:
            break
        least = level
    if least is None:
        return np.zeros(0, np.uint64), Known(np.zeros(0, np.int32), np.zeros(0, np.uint8), np.zeros(0, np.int32))
    narrow = np.min_scalar_type(max(merges.ranks.values()))
    # Hashes and ids come to the driver, 20 bytes a word or so, but no word.
    table = short.where(F.col("level") >= least).select(
        "word", F.get(merges.encode_words(F.array("word")), F.lit(0)).alias("ids")
    ).mapInArrow(lambda batches: hash_words(batches, narrow), "hash binary, ids binary, lengths binary").toArrow()
    held = [[np.frombuffer(v.as_buffer(), kind) for v in table.column(name)] or [np.zeros(0, kind)]
            for name, kind in (("hash", np.uint64), ("ids", narrow), ("lengths", np.uint8))]
    del table
    hashes, pool, lengths = (np.concatenate(parts) for parts in held)
    del held
    order = np.argsort(hashes)
    begins = np.cumsum(lengths, dtype=np.int32) - lengths
    release_memory()
    return hashes[order], Known(begins[order], lengths[order], pool)


def hash_words(batches: Iterator[pa.RecordBatch], narrow: np.dtype) -> Iterator[pa.RecordBatch]:
    """Per batch: each word's hash, all ids one after the other, and how many each word has."""
    for batch in batches:
        # Split on its own, a word stays whole.
        hashes = split_words(batch.column("word").to_pylist(), spaced=True).hashes
        ids = batch.column("ids")
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()]) for x in (
                hashes, ids.flatten().to_numpy(zero_copy_only=False).astype(narrow),
                # No more ids than bytes, at most SENT_BYTES.
                pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.uint8))],
            names=["hash", "ids", "lengths"])


def to_blocks(batches: Iterator[pa.RecordBatch], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per block of documents: each word's place among the known ones or, below zero, among
    the block's rare ones."""
    for batch in batches:
        ids, values = batch.column("doc_id").to_pylist(), _values(batch)
        for a, b in blocks(values):
            words = split_words(values[a:b], spaced=True)
            found, example, _, codes = _distinct(words)
            at = np.minimum(np.searchsorted(hashes, found), max(0, len(hashes) - 1))
            known = (hashes[at] == found) & (found != 0) if len(hashes) else np.zeros(len(found), bool)
            place = np.where(known, at, -1)
            rare = np.flatnonzero(~known & (found != 0))
            place[rare] = -1 - np.arange(len(rare))
            spelled = [words.word(w) for w in example[rare]]
            place = place[codes]
            long = np.flatnonzero(words.hashes == 0)
            place[long] = -1 - len(spelled) - np.arange(len(long))
            spelled += [words.word(w) for w in long]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[a:b]], pa.list_(pa.int64())),
                 pa.array([words.cuts.astype(np.int64).tobytes()], pa.binary()),
                 pa.array([place.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([spelled], pa.list_(pa.string()))],
                names=["doc_ids", "cuts", "codes", "rare"])


def to_ids(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            cuts = np.frombuffer(batch.column("cuts")[row].as_py(), np.int64)
            place = np.frombuffer(batch.column("codes")[row].as_py(), np.int32)
            rare = batch.column("rare_ids")[row].values
            sizes = pc.list_value_length(rare).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = rare.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            own, other = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
            at, rare_at = place[own], -1 - place[other]
            lengths = np.zeros(len(place), np.int64)
            lengths[own], lengths[other] = known.lengths[at], sizes[rare_at]
            ends = np.concatenate([[0], lengths.cumsum()])
            ids = np.zeros(ends[-1], np.int32)
            # Of what is known only the block's own words are touched, nothing is copied whole.
            for which, pool, begins in ((own, known.pool, known.begins[at]),
                                        (other, flat, (sizes.cumsum() - sizes)[rare_at])):
                found, inner = gather(pool, begins.astype(np.int64), lengths[which])
                ids[np.arange(len(found)) + np.repeat(ends[which] - inner[:-1], lengths[which])] = found
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[row].values,
                 pa.ListArray.from_arrays(pa.array(ends[cuts], pa.int32()), pa.array(ids, pa.int32()))],
                names=["doc_id", "ids"])


class Digests:
    """Of rows with ids: how many there are, and digests of the ids and of what they decode to. A row without
    a list of ids has none of them. ``by_method`` names the digests for good."""

    schema = DIGESTS

    def __init__(self, ranks: dict[bytes, int]):
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.pieces = pa.array(pieces, pa.large_binary())
        self.numerals = pa.array([b"%d," % i for i in range(len(pieces))], pa.large_binary())

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            flat, cuts = ids.flatten(), np.concatenate([[0], sizes.cumsum(dtype=np.int64)])
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64(), mask=missing),
                 # Without the comma behind the last id.
                 pa.array(_sha256(self.numerals.take(flat), cuts, 1), pa.string(), mask=missing),
                 pa.array(_sha256(self.pieces.take(flat), cuts, 0), pa.string(), mask=missing)],
                names=["doc_id", "n_tokens", "ids_digest", "decoded_digest"])


def _sha256(parts: pa.Array, cuts: np.ndarray, less: int) -> np.ndarray:
    """The digest of each run of parts, without its last ``less`` bytes."""
    _, begins, data = parts.buffers()
    at = np.frombuffer(begins, np.int64)[cuts] if len(parts) else np.zeros(len(cuts), np.int64)
    data = memoryview(data or b"")
    return np.array([hashlib.sha256(data[a:max(a, b - less)]).hexdigest()
                     for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], object)


def encode_documents(
    docs: DataFrame, ranks_path: str, most_words: int = 1_500_000,
    then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """doc_id and ids (array<int>) of every row of docs.

    Null and empty texts have no ids. ``most_words``: words sent to every task, of up to 64 bytes
    each and their ids; all others are merged where they stand. Repeated rows are encoded each;
    columns other than doc_id and text are ignored; an empty table gives an empty result.
    ``then`` gets the batches of doc_id and ids in the worker that made them, and what it makes of them
    (by its ``schema``) is returned in their place: so long lists needn't go to the JVM and back.
    """
    merges = Merges(read_ranks(ranks_path))
    own = texts(docs)
    hashes, known = known_words(own, merges, most_words)
    finish = then or iter
    return (
        own.mapInArrow(lambda batches: releasing(to_blocks(batches, hashes)), BLOCK)
        .select("doc_ids", "cuts", "codes", merges.encode_words(F.col("rare")).alias("rare_ids"))
        .mapInArrow(lambda batches: releasing(finish(to_ids(batches, known))), then.schema if then else IDS)
    )


def digest_encoding(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Digests of the ids and of what they decode to."""
    return by_method(encoded.select("doc_id", "ids").mapInArrow(Digests(read_ranks(ranks_path)), DIGESTS))


def by_method(digests: DataFrame) -> DataFrame:
    """Digests named by how they are made."""
    return digests.withColumnsRenamed({"ids_digest": "ids_sha256", "decoded_digest": "decoded_sha256"})
