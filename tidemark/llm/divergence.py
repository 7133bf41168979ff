"""How the sources of a language differ in their use of words, by run-length columns.

Each language has a vocabulary, each source of it a column: how often each term occurs there. The
vocabulary is put in an order that brings terms of equal counts together, and every column is
run-length encoded in blocks of that order. For two sources the boundaries of their runs are
intersected: between two boundaries both have one count each, so the divergence of a single term
is computed once and multiplied by the length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import running_totals, ship_code, written

SCALE = 1_000_000_000
# A task counts up to so many (language, source, term) before it hands them on.
HELD = 300_000
# A text is split in pieces of about so many bytes.
PIECE = 1 << 20
# The columns that lead the vocabulary's order: those of the smallest sources, whose counts are few and low.
LEADING = 24
# Terms in a block, and columns that meet the columns of another such set in one task.
BLOCK, TILE = 16_384, 64

# A-Z in lower case, other ASCII characters but letters blank: what is left are the terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(text: str | None, piece: int = PIECE) -> Counter[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    if len(data) <= piece:
        return Counter(data.split())
    counts, at = Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n (occurrences) and docs (documents with it), summed up within the task. A
    document also counts as one row without a term, so that a group without terms is there too."""
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in counts.items():
            terms = list(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array([t if t is None else t.decode("utf-8", "surrogatepass") for t in terms], pa.string()),
                 pa.array([own[t] for t in terms], pa.int64()),
                 pa.array([docs[lang, source][t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        column = batch.column("text")
        for i, group in enumerate(zip(langs, sources, strict=True)):
            own = term_counts(column[i].as_py())
            own[None] = 1
            counts[group].update(own)
            docs[group].update(own.keys())
        if sum(map(len, counts.values())) > HELD:
            yield from out()
    yield from out()


def scaled_share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """p = 1 + floor(1,000,000,000 (n + 2) / (total + 2 terms)), exactly."""
    n, total, terms = (F.col(c) if isinstance(c, str) else c for c in (n, total, terms))
    whole = F.call_function("div", (n + 2).cast("decimal(19,0)") * F.lit(SCALE), (total + terms * 2).cast("decimal(19,0)"))
    return (whole + 1).cast("bigint")


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); both are at most SCALE + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q).cast("bigint")


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array of counts; each distinct count once, in whole numbers of any size."""
    distinct, at = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (int(c) + 2) // (total + 2 * terms) for c in distinct], np.int64)[at]


def full_runs(runs: list, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of a column begins within its block, and its count: the runs given, and between
    them those of count 0."""
    begins, counts, at = [], [], 0
    for begin, run, n in runs:
        if begin > at:
            begins.append(at)
            counts.append(0)
        begins.append(begin)
        counts.append(n)
        at = begin + run
    if at < length:
        begins.append(at)
        counts.append(0)
    return np.array(begins, np.int64), np.array(counts, np.int64)


def intersect(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """The sum of f over a block, from two columns of (begin, p) runs."""
    begins = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], begins, side="right") - 1]
    q = b[1][np.searchsorted(b[0], begins, side="right") - 1]
    lengths = np.diff(begins, append=length)
    return int(((p - q) ** 2 // (p + q) * lengths).sum())


def _tile_sums(columns: pd.DataFrame, tile: int) -> pd.DataFrame:
    """One block's columns of two tiles: the sums of all pairs of a column of the first and a later one of the
    second. At most two tiles of columns, and a block of terms."""
    length = int(columns["length"].iloc[0])
    held = {}
    for row in columns.itertuples(index=False):
        begins, counts = full_runs([(r["begin"], r["run"], r["n"]) for r in row.runs] if row.runs is not None else [], length)
        held[row.idx] = begins, _shares(counts, int(row.total), int(row.terms))
    first, second = int(columns["tile"].iloc[0]), int(columns["other_tile"].iloc[0])
    found = [(i, j, intersect(held[i], held[j], length)) for i in sorted(held) if i // tile == first
             for j in sorted(held) if j // tile == second and i < j]
    lang = columns["lang"].iloc[0]
    return pd.DataFrame([(lang, i, j, v) for i, j, v in found], columns=["lang", "idx", "other_idx", "value"])


def _ordered(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, term and its place in an order of all languages' vocabularies one after the other: within a language
    by the counts in the leading columns, then by a digest of all counts, so that terms of equal columns
    stand together. Any order gives the same result, this one shorter runs."""
    indexed = kept.join(groups.select("lang", "source", "idx"), ["lang", "source"])
    leading = indexed.groupBy("lang", "term").agg(
        F.bit_xor(F.xxhash64("idx", "n")).alias("digest"),
        *(F.coalesce(F.sum(F.when(F.col("idx") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(LEADING)))
    key = F.struct(*(f"c{k}" for k in range(LEADING)), "digest")
    return running_totals(
        leading.select("lang", "term", key.alias("like")), ["lang", "like", "term"],
        {"place": F.lit(1).cast("bigint")}, "part", "divergence-order").select("lang", "term", "place")


def _pair_sums(kept: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """lang, idx, other_idx (the larger), value."""
    places = written(_ordered(kept, groups).withColumn(
        "block", F.floor(F.col("place") / block).cast("bigint")), "divergence-places")
    blocks = places.groupBy("lang", "block").agg(
        F.min("place").alias("from"), F.count(F.lit(1)).cast("int").alias("length"))
    entries = kept.join(places, ["lang", "term"]).join(groups.select("lang", "source", "idx"), ["lang", "source"])
    # Places one after the other with one count keep their distance to their rank among that count's.
    alike = W.partitionBy("lang", "block", "idx", "n").orderBy("place")
    runs = entries.withColumn("island", F.col("place") - F.row_number().over(alike)).groupBy(
        "lang", "block", "idx", "n", "island").agg(
        F.min("place").alias("begin"), F.count(F.lit(1)).cast("int").alias("run"))
    columns = runs.join(blocks, ["lang", "block"]).groupBy("lang", "block", "idx").agg(F.sort_array(F.collect_list(
        F.struct((F.col("begin") - F.col("from")).cast("int").alias("begin"), "run", "n"))).alias("runs"))
    # A column is there in each block of its language, also without a run in it.
    sized = groups.select("lang", "idx", "total", "terms").withColumn("own", F.floor(F.col("idx") / tile).cast("int"))
    tiles = sized.groupBy("lang").agg(F.max("own").alias("last"))
    tiled = (
        blocks.select("lang", "block", "length").join(sized, "lang").join(columns, ["lang", "block", "idx"], "left")
        .join(tiles, "lang")
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("tile", F.least("own", "with")).withColumn("other_tile", F.greatest("own", "with"))
        .select("lang", "block", "tile", "other_tile", "length", "idx", "total", "terms", "runs")
    )
    sums = tiled.groupBy("lang", "block", "tile", "other_tile").applyInPandas(
        lambda columns: _tile_sums(columns, tile), "lang string, idx int, other_idx int, value bigint")
    return sums.groupBy("lang", "idx", "other_idx").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, least_docs: int = 10, top: int = 10, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language, all its other sources by how far
    they differ (part ``pair``) and the ``top`` terms that it has more of than the language (part ``term``).

    Terms are runs of ASCII letters, A-Z in lower case, and of all other characters beyond ASCII; those in at
    least ``least_docs`` rows of a language are kept. Null text, lang and source are empty strings; empty and
    null texts have no terms, but their group is there. Repeated rows count each. Very long texts are
    split in pieces. A language without kept terms has pairs of value 0 and no terms. Equal values rank by
    item. ``block`` and ``tile`` bound what one task holds. Columns other than text, lang and source are ignored; an empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    named = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts = written(
        named.mapInArrow(count_terms, "lang string, source string, term string, n bigint, docs bigint")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    terms = counts.where("term is not null")
    vocabulary = written(
        terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs).drop("docs"), "divergence-vocabulary")
    kept = written(terms.drop("docs").join(vocabulary, ["lang", "term"]), "divergence-kept")
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = written(
        counts.where("term is null").select("lang", "source").join(sizes, "lang", "left")
        .join(totals, ["lang", "source"], "left").fillna(0, ["terms", "lang_total", "total"])
        # One row per source.
        .withColumn("idx", F.row_number().over(W.partitionBy("lang").orderBy("total", "source")) - 1),
        "divergence-groups")
    sums = written(_pair_sums(kept, groups, block, tile), "divergence-sums")
    both = sums.union(sums.select("lang", F.col("other_idx").alias("idx"), F.col("idx").alias("other_idx"), "value"))
    names = groups.select("lang", "source", "idx")
    pairs = (
        names.join(names.select("lang", F.col("source").alias("item"), F.col("idx").alias("other_idx")), "lang")
        .where("idx <> other_idx").join(both, ["lang", "idx", "other_idx"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
    )
    p, q = scaled_share("n", "total", "terms"), scaled_share("lang_n", "lang_total", "terms")
    raised = (
        kept.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q"))
        .where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                               divergence(F.col("p"), F.col("q")).alias("value"))
    )
    rank = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(raised.withColumn("rank", rank).where(F.col("rank") <= top))
