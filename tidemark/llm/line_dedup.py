"""Line dedup that can be undone: sharded cuckoo filters over exact reference-count tables.

A ``LineIndex`` knows which documents hold which lines. Its exact tables are

* ``references``: a log of (digest of the line's key, doc_id, how many rows more or less hold it);
* ``counts``: each key's number of documents and the largest of them.

A key found in enough documents is *repeated*. Repeated keys are also in the cuckoo filter of their shard: an
insertion of documents adds the keys that it brings over the limit, a deletion takes out those that it
brings below. A pass over documents asks the filters first. What they deny, nearly all lines, is kept without
a further look; what they don't deny is looked up in the exact table, so a filter's wrong yes changes
nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import cuckoo
from tidemark.llm.common import texts, written

BLANKS = b" \t\n\x0b\x0c\r"
# Rows that a task hands on at once.
FLUSH = 20_000


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The key of a line: stripped, A-Z in lower case; None if it is too short to be compared."""
    key = line.strip(BLANKS).lower()
    # A code point has one to four bytes, so most lengths need no count.
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode("utf-8", "surrogatepass")) < least_chars:
        return None
    return key


def digest_of(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def distinct_keys(text: str | None, least_chars: int) -> set[bytes]:
    return {key for line in set(_lines(text)) if (key := line_key(line, least_chars)) is not None}


def held_lines(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """(digest, doc_id) of each distinct key of each document."""
    names = ["digest", "doc_id"]
    digests, owners = [], []
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        column = batch.column("text")
        for i, doc_id in enumerate(ids):
            keys = distinct_keys(column[i].as_py(), least_chars)
            digests += map(digest_of, keys)
            owners += [doc_id] * len(keys)
            if len(digests) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(owners, pa.int64())], names)
                digests, owners = [], []
    if digests:
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(owners, pa.int64())], names)


def shards_of(digests: list[bytes], shards: int) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u4")[::4] % shards


def shard_of(digest: str, shards: int) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint") % shards


def allowed(digests: list[bytes], filters: dict[int, np.ndarray], shards: int) -> np.ndarray:
    """Which of the digests their shard's filter doesn't deny."""
    shard, words, yes = shards_of(digests, shards), cuckoo.words(digests), np.zeros(len(digests), bool)
    order = np.argsort(shard, kind="stable")
    bounds = np.flatnonzero(np.diff(shard[order].astype(np.int64), prepend=-1, append=-1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = order[a:b]
        if (cells := filters.get(int(shard[own[0]]))) is not None:
            yes[own] = cuckoo.contains(cells, words[own])
    return yes


def candidates(batches: Iterator[pa.RecordBatch], filters: dict[int, np.ndarray] | None, shards: int,
               least_chars: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_id, digest) of the lines that the filters don't deny; of all lines without filters."""
    names = ["doc_id", "text_id", "digest"]

    def out(digests: list[bytes], rows: list[tuple]) -> pa.RecordBatch:
        yes = np.arange(len(rows)) if filters is None else np.flatnonzero(allowed(digests, filters, shards))
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in yes], pa.int64()), pa.array([rows[i][1] for i in yes], pa.int64()),
             pa.array([digests[i] for i in yes], pa.binary())], names)

    for batch in batches:
        ids, text_ids = batch.column("doc_id").to_pylist(), batch.column("text_id").to_pylist()
        column = batch.column("text")
        digests: list[bytes] = []
        rows: list[tuple] = []
        for i, row in enumerate(zip(ids, text_ids, strict=True)):
            keys = distinct_keys(column[i].as_py(), least_chars)
            digests += map(digest_of, keys)
            rows += [row] * len(keys)
            if len(rows) >= FLUSH:
                yield out(digests, rows)
                digests, rows = [], []
        if rows:
            yield out(digests, rows)


def without_lines(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """doc_id, n_lines, n_dropped and the text without the lines whose digest is in ``dropped``."""
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        column, dropped = batch.column("text"), batch.column("dropped")
        for i in range(batch.num_rows):
            text, gone = column[i].as_py() or "", dropped[i].as_py()
            if not gone:
                n_lines.append(text.count("\n") + 1)
                n_dropped.append(0)
                kept.append(text)
                continue
            gone, lines = set(gone), _lines(text)
            stay = [line for line in lines
                    if (key := line_key(line, least_chars)) is None or digest_of(key) not in gone]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
             pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])


FILTERS = "shard int, cells binary"


def _changed_filter(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after keys went over or fell below the limit; ``keys`` are all of the shard's keys that
    are or were repeated, with ``was`` and ``now``."""
    def of(rows: pd.DataFrame) -> np.ndarray:
        return cuckoo.words(rows["digest"].tolist())

    now = keys[keys["now"]]
    cells = None
    if len(old) and len(now):
        cells = cuckoo.load(old["cells"].iloc[0])
        cuckoo.delete(cells, of(keys[keys["was"] & ~keys["now"]]))
        # A full filter is built anew from the exact table.
        if len(cells) < cuckoo.bucket_count(len(now)) or not cuckoo.insert(cells, of(now[~now["was"]])):
            cells = None
    if cells is None and len(now):
        cells = cuckoo.build(of(now))
    shard = int((keys if len(keys) else old)["shard"].iloc[0])
    return pd.DataFrame({"shard": [shard], "cells": [cells.tobytes()]} if cells is not None else {"shard": [], "cells": []})


@dataclass(frozen=True)
class LineIndex:
    """One state of the index. ``insert`` and ``delete`` give the next one and leave this one as it is; the tables
    lie in the shared checkpoint folder.

    ``shards`` is fixed for the index's life. ``filter_bytes``: the filters go to every task while they take
    no more than that together (some 2.7 bytes a repeated key); beyond, every line meets the exact table.
    """

    spark: SparkSession
    least_chars: int = 20
    least_docs: int = 3
    shards: int = 64
    filter_bytes: int = 32 << 20
    references: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None

    def insert(self, docs: DataFrame) -> LineIndex:
        """With the rows of docs (doc_id, text) added. A key counts once per doc_id, however many rows have it;
        rows without an id are one document, before all others. Other columns are ignored."""
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """With rows taken out that were inserted, same id and same text: as if they never had been."""
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        least_chars, first = self.least_chars, self.references is None
        fresh = written(
            texts(docs).mapInArrow(lambda b: held_lines(b, least_chars), "digest binary, doc_id bigint")
            .withColumn("n", F.lit(sign).cast("bigint")), "line-references")
        log = fresh if first else self.references.unionByName(fresh)
        touched = fresh.select("digest").distinct()
        # Rows per document and key first, so that a line in very many documents is spread over the tasks.
        held = (log if first else log.join(touched, "digest", "left_semi")).groupBy("digest", "doc_id").agg(
            F.sum("n").alias("n")).where("n > 0")
        now = held.groupBy("digest").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("largest"))
        if not first:
            now = self.counts.join(touched, "digest", "left_anti").unionByName(now)
        counts = written(now, "line-counts")
        return replace(self, references=log, counts=counts, filters=self._new_filters(counts))

    def _new_filters(self, counts: DataFrame) -> DataFrame:
        """One row per shard with repeated keys. A shard's group has a row per key that is or was repeated."""
        def repeated(table: DataFrame, flag: str) -> DataFrame:
            return table.where(F.col("docs") >= self.least_docs).select("digest", F.lit(True).alias(flag))

        now = repeated(counts, "now")
        both = now.withColumn("was", F.lit(False)) if self.counts is None else now.join(
            repeated(self.counts, "was"), "digest", "full")
        keys = both.select(
            shard_of("digest", self.shards).alias("shard"), "digest",
            F.coalesce("was", F.lit(False)).alias("was"), F.coalesce("now", F.lit(False)).alias("now"))
        old = self.spark.createDataFrame([], FILTERS) if self.filters is None else self.filters
        return written(
            old.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(_changed_filter, FILTERS),
            "line-filters")

    def repeated(self) -> DataFrame:
        """digest, largest: the keys found in enough documents, exactly."""
        return self.counts.where(F.col("docs") >= self.least_docs).select("digest", "largest")

    def _held_filters(self) -> dict[int, np.ndarray] | None:
        """The filters by shard, if they fit their bound."""
        size = self.filters.agg(F.coalesce(F.sum(F.octet_length("cells")), F.lit(0))).first()[0]
        if size > self.filter_bytes:
            return None
        return {r["shard"]: cuckoo.load(r["cells"]) for r in self.filters.collect()}

    def drop_lines(self, docs: DataFrame) -> DataFrame:
        """Every row of docs, which the index has to hold: doc_id, n_lines, n_dropped, kept.

        A line whose key is repeated goes unless the row's doc_id is the largest that holds it; the other lines
        stay, in order. Null and empty texts are one empty line. Repeated rows are treated alike, and of rows
        that share the largest id all keep theirs. Rows without an id keep a repeated line only if no
        document with an id has it. A task holds one text at a time beside its batch, and of very long texts the
        distinct lines. Columns other than doc_id and text are ignored; an empty table gives an empty result.
        """
        least_chars, shards, filters = self.least_chars, self.shards, self._held_filters()
        # Rows that share an id are told apart by their texts, so a group below is one text's lines.
        own = texts(docs).withColumn("text_id", F.xxhash64("text"))
        gone = (
            own.mapInArrow(lambda b: candidates(b, filters, shards, least_chars),
                           "doc_id bigint, text_id bigint, digest binary")
            .join(self.repeated(), "digest").where(~F.col("doc_id").eqNullSafe(F.col("largest")))
            .groupBy(F.col("doc_id").alias("gone_id"), F.col("text_id").alias("gone_text_id"))
            .agg(F.collect_set("digest").alias("dropped"))
        )
        same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_id") == F.col("gone_text_id"))
        return own.join(gone, same, "left").select("doc_id", "text", "dropped").mapInArrow(
            lambda b: without_lines(b, least_chars), "doc_id bigint, n_lines bigint, n_dropped bigint, kept string")


def digest_kept(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
