"""Near-duplicate documents by a prefix-tree join of their word n-gram sets.

Sets are ordered by one global order of n-grams, rare ones first, and two similar sets share one of
their first ones: a cell is an n-gram's sets of two neighbouring classes of size. A set lives in one
home, its cells' smallest set, and visits the homes of those it shares a cell with, and no others: what
leads from cell to cell does not bring sets together. A home's sets go into a prefix tree, which is searched
with each of them and each visitor (``trie``). Homes too large for one task are dealt out by hash, and
every two parts that could hold a pair are joined.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, texts, written_alone
from tidemark.llm.components import components
from tidemark.llm.trie import linked
from tidemark.llm.words import CHUNK, blocks, power_tables

SETS = "doc_id bigint, n bigint, set_id binary, eligible int, tokens array<bigint>"
# Sets in one task's tree; larger groups are dealt out to several.
UNIT = 400


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(values: list[str], chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """64 bits of every word of the texts, A-Z in lower case, and where each text's words begin."""
    raw = np.frombuffer(("\n".join(values) + "\n").encode("utf-8"), np.uint8).copy()
    raw[(raw >= 65) & (raw <= 90)] += 32
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    hashes, done = np.zeros(len(starts), np.uint64), 0
    while done < len(starts):
        # As many words as lie in a chunk, or one.
        first, upto = starts[done], max(done + 1, int(np.searchsorted(ends, starts[done] + chunk)))
        own = raw[first:ends[upto - 1]]
        powers, inverses = power_tables(1 << max(16, len(own).bit_length()))
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(_mix(own.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * powers[:len(own)], out=sums[1:])
        a, b = starts[done:upto] - first, ends[done:upto] - first
        hashes[done:upto] = _mix((sums[b] - sums[a]) * inverses[a] + (b - a).astype(np.uint64))
        done = upto
    texts_end = np.cumsum(np.fromiter((len(v.encode("utf-8")) + 1 for v in values), np.int64, len(values)))
    return hashes, np.concatenate([[0], np.searchsorted(starts, texts_end)])


def ngram_sets(values: list[str], width: int) -> list[np.ndarray]:
    """The distinct n-grams of each text, as sorted hashes; a shorter text is one n-gram."""
    out: list[np.ndarray] = []
    for a, b in blocks(values):
        words, cuts = word_hashes(values[a:b])
        grams = np.zeros(len(words), np.uint64)
        for k in range(width):
            whole = max(0, len(words) - k)
            grams[:whole] = _mix(grams[:whole] * np.uint64(3) + words[k:])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo >= width:
                out.append(np.unique(grams[lo:hi - width + 1]))
            elif hi > lo:
                whole = np.uint64([hi - lo])
                for w in words[lo:hi]:
                    whole = _mix(whole * np.uint64(3) + w)
                out.append(whole)
            else:
                out.append(grams[:0])
    return out


def prefix_length(n: int, percent: int) -> int:
    """Of two sets similar enough, each has one of the other's n-grams among its first so many."""
    return n + 1 + (-percent * n) // 100


def _cut(percent: int) -> int:
    """N-grams below this hash are counted: somewhat more of each set than its first ones."""
    return int((1.4 * (100 - percent) / 100) * 2 ** 64)


def _signed(hashes: np.ndarray) -> np.ndarray:
    """As longs in the same order."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def set_id(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def summarize(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    cut = np.uint64(min(_cut(percent), 2 ** 64 - 1))
    for batch in batches:
        sets = ngram_sets([t or "" for t in batch.column("text").to_pylist()], width)
        eligible = [int(np.searchsorted(s, cut)) for s in sets]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
            pa.array(eligible, pa.int32()),
            pa.array([_signed(s[:max(e, prefix_length(len(s), percent))]) if len(s) else [] for s, e in
                      zip(sets, eligible, strict=True)], pa.list_(pa.int64())),
        ], names=["doc_id", "n", "set_id", "eligible", "tokens"])


def candidate_cells(summary: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """rep, size_class, token and band: the first n-grams of each distinct set, in the order rare before
    frequent, that another set may be similar by. N-grams above the cut aren't counted and come last.

    Similar sets have sizes in one class or two neighbouring ones. A band is a class with the class below
    it, so each set is in two bands, and two similar sets meet in the band of the larger one.
    If two sets' first common n-gram has i and j others before it, i + j are not common; so a set
    leaves an n-gram's cell if its place and the cell's earliest make up more than it may lack.
    """
    rows = summary.select("doc_id", F.explode("tokens").alias("token"))
    shared = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    low = F.col("token") < F.lit(min(_cut(percent), 2 ** 64 - 1) - 2 ** 63)
    per_document = rows.join(shared, "token").groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.when(low, F.struct("df", "token")))).alias("counted"),
        F.collect_set(F.when(~low, F.col("token"))).alias("rest"))
    prefix = F.col("n") + 1 - F.ceil(F.col("n") * percent / 100)
    # N-grams of one document alone come before all of these.
    alone = F.col("eligible") - F.size("counted")
    first = F.slice("counted", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))
    placed = F.concat(
        F.transform(first, lambda s, i: F.struct(
            s["token"].alias("token"), (F.greatest(alone, F.lit(0)) + i).alias("place"))),
        F.transform(F.array_sort("rest"), lambda t, i: F.struct(
            t.alias("token"), (F.col("eligible") + i).alias("place"))))
    cells = written_alone(per_document.withColumnRenamed("doc_id", "rep").join(reps, "rep").select(
        "rep", _size_class(percent).alias("size_class"), (F.col("n") * (100 - percent) / percent).alias("spare"),
        F.explode(placed).alias("p")).select("rep", "size_class", "spare", "p.token", "p.place"), "ngram-cells")
    cells = cells.withColumn("band", F.explode(F.array("size_class", F.col("size_class") + 1)))
    earliest = cells.groupBy("token", "band").agg(F.min("place").alias("earliest"))
    return cells.join(earliest, ["token", "band"]).where("place + earliest <= spare + 0.000001").select(
        "rep", "size_class", "token", "band")


def _size_class(percent: int) -> Column:
    # Sizes that are powers of the step are kept off the classes' edges, where rounding would decide.
    return F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("int")


def _visits(cells: DataFrame) -> DataFrame:
    """rep, size_class, band, home and resident: which sets are searched for in which band's homes, and which
    of them live there. Any two sets of a cell of which one is of the band's own class meet in one home.

    A set's home is the smallest of the sets of its class in any of its cells: large cells have small
    ones, so a cell's sets have few homes. Of two sets of a class the one with the smaller home visits the other.
    """
    own = F.col("size_class") == F.col("band")
    hubs = cells.groupBy("token", "band").agg(F.min(F.when(own, F.col("rep"))).alias("hub"), F.count("*").alias("m"))
    held = written_alone(cells.join(hubs.where("hub is not null and m > 1"), ["token", "band"]).drop("m"), "ngram-cells")
    homes = written_alone(held.where(own).groupBy("rep", "size_class").agg(F.min("hub").alias("home")), "ngram-homes")
    cell_homes = held.where(own).join(homes, ["rep", "size_class"]).select("token", "band", "home").distinct()
    visits = held.select("rep", "size_class", "token", "band").join(cell_homes, ["token", "band"]).select(
        "rep", "size_class", "band", "home").distinct()
    lives = homes.withColumnRenamed("home", "lives")
    return visits.join(lives, ["rep", "size_class"], "left").where(~own | (F.col("home") >= F.col("lives"))).select(
        "rep", "size_class", "band", "home", (own & (F.col("home") == F.col("lives"))).alias("resident"))


def _units(members: DataFrame) -> DataFrame:
    """Adds part (with the home: a task's work) and role: 0 both searched and indexed, 1 indexed, 2 searched.

    A large home's residents and its visitors are split by hash, and each two parts of residents, and each
    part of visitors with each of residents, are a unit.
    """
    home = ["band", "home"]
    parts = members.groupBy(*home).agg(
        F.count("*").alias("members"),
        F.ceil(F.sum(F.col("resident").cast("int")) / UNIT).cast("int").alias("lived"),
        F.ceil(F.sum((~F.col("resident")).cast("int")) / UNIT).cast("int").alias("visited"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("resident"), F.col("lived")).otherwise(F.col("visited"))).cast("int")
    each = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def unit(kind: str, i: Column, j: Column, role: Column) -> Column:
        return F.struct(F.concat_ws("/", F.lit(kind), i.cast("string"), j.cast("string")).alias("part"),
                        role.cast("int").alias("role"))

    p = F.col("own")
    resident = F.concat(
        F.transform(each("lived"), lambda j: unit(
            "", F.least(p, j), F.greatest(p, j), F.when(p == j, 0).when(p < j, 1).otherwise(2))),
        F.transform(each("visited"), lambda j: unit("v", j, p, F.lit(1))))
    visitor = F.transform(each("lived"), lambda j: unit("v", p, j, F.lit(2)))
    small = F.array(F.struct(F.lit("").alias("part"), F.when(F.col("resident"), 0).otherwise(2).alias("role")))
    return members.join(parts, home).withColumn("own", own).select("rep", "set_id", *home, F.explode(
        F.when(F.col("members") <= UNIT, small).when(F.col("resident"), resident).otherwise(visitor)).alias("u")
        ).select("rep", "set_id", *home, "u.part", "u.role")


def _whole_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = ngram_sets([t or "" for t in batch.column("text").to_pylist()], width)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([set_id(s) for s in sets], pa.binary()),
             pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["doc_id", "set_id", "grams"])


def _search(unit: pa.Table, percent: int) -> pa.Table:
    roles = unit.column("role").to_numpy()
    reps = unit.column("rep").to_numpy()
    sets = [np.frombuffer(g, np.uint64) for g in unit.column("grams").to_pylist()]
    indexed, searched = np.flatnonzero(roles < 2), np.flatnonzero(roles != 1)
    found = linked(sets, indexed, searched, percent) if len(indexed) and len(searched) else []
    return pa.table({"a": pa.array([reps[i] for i, _ in found], pa.int64()),
                     "b": pa.array([reps[j] for _, j in found], pa.int64())})


def link_documents(docs: DataFrame, width: int = 5, percent: int = 80, few: int = 500_000) -> DataFrame:
    """Every row of docs: doc_id, n_shingles and component_id, the smallest id that links lead to.

    Two documents link when 100 * intersection >= percent * union of their n-gram sets. Documents
    with equal sets are one set with the smallest of their ids. Null, empty and blank texts have no
    n-grams and link with nothing. Rows without an id stay alone, with a null component. Rows that
    share an id are taken for copies of one text. Other columns are ignored; an empty table
    gives an empty result. ``few``: up to so many candidates, their ids (16 bytes each) are broadcast
    to the scan that makes their sets; beyond it both sides are shuffled.
    """
    summary = written_alone(
        texts(docs).mapInArrow(lambda batches: releasing(summarize(batches, width, percent)), SETS), "ngram-sets")
    known = written_alone(summary.where("n > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("eligible").alias("eligible")),
        "ngram-classes")
    cells = candidate_cells(summary, known.select("rep", "n", "eligible"), percent)
    members = written_alone(known.select("rep", "set_id", _size_class(percent).alias("size_class")).join(
        _visits(cells), ["rep", "size_class"]), "ngram-members")
    units = _units(members)
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    if ids.count() <= few:
        ids = F.broadcast(ids)
    grams = texts(docs).join(ids, "doc_id", "left_semi").mapInArrow(
        lambda batches: releasing(_whole_sets(batches, width)), "doc_id bigint, set_id binary, grams binary")
    # Copies have gone, but for rows repeated with their id.
    grams = grams.withColumnRenamed("doc_id", "rep").join(units, ["rep", "set_id"]).dropDuplicates(
        ["rep", "set_id", "band", "home", "part"])
    links = grams.select("band", "home", "part", "role", "rep", "grams").groupBy("band", "home", "part").applyInArrow(
        lambda unit: _search(unit, percent), "a bigint, b bigint")
    found = components(links, "ngram-links").withColumnsRenamed({"node": "rep"})
    classes = known.join(found, "rep", "left").select(
        "set_id", F.coalesce("component", "rep").alias("component_id"))
    return summary.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(
        classes, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
