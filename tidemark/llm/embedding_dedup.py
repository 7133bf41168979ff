"""Near-duplicate vectors by NN-descent.

Every vector keeps a short list of its nearest ones so far. Lists start from neighbours in the order
of random sign codes; then, round after round, the members of each list and of the lists it stands in
are compared with each other, and better neighbours replace worse ones, until few lists change. Links
are kept apart from the lists: one that was met once stays. A list that holds nothing but links is
saturated: it is made twice as long and the search goes on, until the list holds something else or has the
length at which longer ones would cost more than they find. The vectors whose lists are full even then are
members of large groups: their links to each other are counted in blocks, each with all blocks that are near
enough for a link. An audit compares some vectors with all others. It adds nothing to the result; while
too few links were found, all lists get longer and the search goes on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, written
from tidemark.llm.components import components

# Half-precision vectors are compared in the search; links are decided in double precision.
SLACK = 0.01
# Vectors in one block of the comparison within saturated groups.
BLOCK = 1024
# Rows that a task takes before there are more tasks.
TASK_ROWS = 20_000
# Hashes are taken modulo this to choose the vectors of the audit.
AUDIT_STEPS = 1 << 40


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    return np.stack([np.frombuffer(v, kind) for v in column.to_pylist()])


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """df in as many partitions as ``rows`` rows ask for, if the shuffle's are more: a round makes several tables,
    and each partition of them costs a task and a file, which the executor makes by starting a process."""
    return df.coalesce(1 + rows // TASK_ROWS)


def unit_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units, halves = [], []
        for v in batch.column("embedding").to_pylist():
            unit = None
            if v and all(x is not None and math.isfinite(x) for x in v):
                x = np.array(v, np.float64)
                if np.any(x):
                    x /= np.abs(x).max()
                    unit = x / math.sqrt(float(x @ x)) + 0.0
            units.append(None if unit is None else unit.tobytes())
            halves.append(None if unit is None else unit.astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(units, pa.binary()), pa.array(halves, pa.binary())],
            names=["vec_id", "unit", "half"])


def sign_codes(batches: Iterator[pa.RecordBatch], tables: range) -> Iterator[pa.RecordBatch]:
    """Each vector with the signs of 64 random projections, for each of several sets of them. A code
    begins with the vector's length, so that only comparable ones stand together."""
    for batch in batches:
        for row in range(0, batch.num_rows, 4096):
            part = batch.slice(row, 4096)
            ids = part.column("id").to_numpy()
            halves = part.column("half").to_pylist()
            lengths = np.array([len(h) // 2 for h in halves])
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                x = np.stack([np.frombuffer(halves[i], np.float16) for i in own]).astype(np.float32)
                for t in tables:
                    planes = np.random.default_rng([17, t, int(size)]).standard_normal((int(size), 64))
                    bits = np.packbits(x @ planes > 0, axis=1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(own), t, np.int32)),
                        pa.array([int(size).to_bytes(4, "big") + b.tobytes() for b in bits], pa.binary()),
                        pa.array(ids[own]), pa.array([halves[i] for i in own], pa.binary()),
                    ], names=["t", "code", "id", "half"])


def neighbours_in_order(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Pairs of rows that stand at most ``reach`` apart, with their cosine."""
    held: list[tuple] = []
    for batch in batches:
        rows = held + list(zip(*(batch.column(c).to_pylist() for c in ("t", "id", "half")), strict=True))
        fresh = len(held)
        u, v, sims = [], [], []
        vectors = [np.frombuffer(h, np.float16).astype(np.float32) for _, _, h in rows]
        for i in range(fresh, len(rows)):
            for j in range(max(0, i - reach), i):
                if rows[i][0] == rows[j][0] and len(vectors[i]) == len(vectors[j]):
                    sim = float(vectors[i] @ vectors[j])
                    u += [rows[i][1], rows[j][1]]
                    v += [rows[j][1], rows[i][1]]
                    sims += [sim, sim]
        held = rows[-reach:]
        yield _edges(u, v, sims)


def _edges(u, v, sims) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sims, pa.float32())],
        names=["u", "v", "sim"])


EDGES = "u bigint, v bigint, sim float"


def compare_lists(rows: pa.Table) -> pa.Table:
    """For the lists of several vectors w: pairs of members, at least one of them new in the list, that
    are above the bar of one of them."""
    w = rows.column("w").to_numpy()
    order = np.argsort(w, kind="stable")
    cuts = np.flatnonzero(np.diff(w[order], prepend=w[order[0]] - 1)) if len(w) else np.zeros(0, int)
    members = rows.column("m").to_numpy()
    new = rows.column("fresh").to_numpy(zero_copy_only=False)
    bar = rows.column("bar").to_numpy()
    halves = rows.column("half").to_pylist()
    out_u, out_v, out_s = [], [], []
    for a, b in zip(cuts, [*cuts[1:], len(w)], strict=True):
        own = order[a:b]
        if len(own) < 2 or not new[own].any() or len({len(halves[i]) for i in own}) > 1:
            continue
        x = np.stack([np.frombuffer(halves[i], np.float16) for i in own]).astype(np.float32)
        sims = x @ x.T
        ok = (new[own][:, None] | new[own][None, :]) & (members[own][:, None] != members[own][None, :])
        i, j = np.nonzero(ok & (sims > bar[own][:, None]))
        out_u.append(members[own[i]])
        out_v.append(members[own[j]])
        out_s.append(sims[i, j])
    if not out_u:
        return pa.Table.from_batches([_edges([], [], [])])
    return pa.Table.from_batches([_edges(*map(np.concatenate, (out_u, out_v, out_s)))])


def _best(edges: DataFrame, caps: DataFrame | None, k: int, rows: int) -> DataFrame:
    """The best of each list, as many as it may hold. An old edge that is found again stays old."""
    once = in_tasks(edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh")), rows)
    place = W.partitionBy("u").orderBy(F.desc("sim"), "v")
    return _cap(once.withColumn("place", F.row_number().over(place)), "u", caps, k).where("place <= cap").drop("cap")


def _cap(lists: DataFrame, node: str, caps: DataFrame | None, k: int) -> DataFrame:
    """Adds how long the list of ``node`` may be: as ``caps`` (id, cap) has it, if any, else ``k``."""
    if caps is None:
        return lists.withColumn("cap", F.lit(k))
    return lists.join(caps.select(F.col("id").alias(node), F.col("cap").alias("own_cap")), node, "left").withColumn(
        "cap", F.coalesce("own_cap", F.lit(k))).drop("own_cap")


def _states(graph: DataFrame, caps: DataFrame | None, k: int, near: float) -> DataFrame:
    """Per list u: its cap, the worst similarity in it, and whether it holds nothing but links (``saturated``)."""
    return _cap(graph.groupBy("u").agg(F.count("*").alias("held"), F.min("sim").alias("worst")), "u", caps, k).withColumn(
        "saturated", (F.col("held") >= F.col("cap")) & (F.col("worst") >= near))


def descend(graph: DataFrame, halves: DataFrame, caps: DataFrame | None, k: int, longest: int, near: float,
            rows: int) -> DataFrame:
    """One round over the lists (u, v, sim, fresh, place), about ``rows`` in all: the pairs that it meets. They are
    better than the worst that a list holds, or may be links, but for lists that hold only links at their greatest
    length."""
    # A worker is handed the lists of one bucket at once: its own lists' rows and about as many reverse ones.
    buckets = 1 + 4 * rows // TASK_ROWS
    back = W.partitionBy("v").orderBy(F.desc("sim"), "u")
    # Of the lists that a vector stands in, the nearest are its own list's other half.
    reverse = in_tasks(_cap(graph.withColumn("r", F.row_number().over(back)), "v", caps, k).where("r <= cap"), rows)
    both = graph.select(F.col("u").alias("w"), F.col("v").alias("m"), "fresh").union(
        reverse.select(F.col("v").alias("w"), F.col("u").alias("m"), "fresh"))
    lists = in_tasks(both.groupBy("w", "m").agg(F.max("fresh").alias("fresh")), rows)
    bars = _states(graph, caps, k, near).select("u", F.when(
        F.col("saturated") & (F.col("cap") >= longest), F.col("worst")).when(
        F.col("held") >= F.col("cap"), F.least("worst", F.lit(near))).otherwise(F.lit(-2.0)).cast("float").alias("bar"))
    vectors = in_tasks(halves.join(bars, halves["id"] == bars["u"], "left").select(
        F.col("id").alias("m"), "half", F.coalesce("bar", F.lit(-2.0).cast("float")).alias("bar")), rows)
    members = in_tasks(lists.join(vectors, "m"), rows).withColumn("bucket", F.pmod(F.xxhash64("w"), F.lit(buckets)))
    return in_tasks(members.groupBy("bucket").applyInArrow(compare_lists, EDGES), rows)


def _merged(graph: DataFrame | None, found: DataFrame, caps: DataFrame | None, k: int, rows: int) -> DataFrame:
    """The lists with the found pairs."""
    edges = found.select("u", "v", "sim", F.lit(True).alias("fresh"))
    if graph is not None:
        edges = graph.select("u", "v", "sim", "fresh").union(edges)
    return written(in_tasks(_best(edges, caps, k, rows), rows), "neighbour-lists")


def exact_cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cosines = [float(np.frombuffer(a, np.float64) @ np.frombuffer(b, np.float64)) for a, b in zip(
            batch.column("unit_a").to_pylist(), batch.column("unit_b").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(cosines, pa.float64())], names=["a", "b", "cosine"])


def _near_pairs(found: DataFrame, threshold: float) -> DataFrame:
    """The pairs that may be links, each as often as it was found: a, b."""
    return found.where(F.col("sim") >= threshold - SLACK).select(
        F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))


def _links(close: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The pairs of at least the threshold, each once: a, b. ``close`` holds each pair once."""
    rows = close.count()
    a = units.select(F.col("id").alias("a"), F.col("unit").alias("unit_a"))
    b = units.select(F.col("id").alias("b"), F.col("unit").alias("unit_b"))
    pairs = in_tasks(in_tasks(close.join(a, "a"), rows).join(b, "b"), rows).select("a", "b", "unit_a", "unit_b")
    return in_tasks(pairs.mapInArrow(exact_cosines, "a bigint, b bigint, cosine double").where(
        F.col("cosine") >= threshold).select("a", "b").distinct(), rows)


def audit(units: DataFrame, counted: DataFrame, threshold: float, about: int) -> float:
    """The share of the links of about ``about`` vectors that ``counted`` (id, others) holds.

    Which ones follows from their content. Their true links come from comparing them with all vectors;
    counts are never too high, as every counted link was decided in double precision. Vectors that share an id
    with others are left out.
    """
    distinct = units.count()
    limit = int(AUDIT_STEPS * min(1.0, about / max(1, distinct)))
    chosen = units.join(units.groupBy("id").count().where("count = 1"), "id").where(
        F.pmod(F.xxhash64("unit"), F.lit(AUDIT_STEPS)) < limit).select("id", "unit").toArrow()
    if not len(chosen):
        return 1.0
    ids = chosen.column("id").to_numpy()
    raw = chosen.column("unit").to_pylist()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own_ids, own = batch.column("id").to_numpy(), batch.column("unit").to_pylist()
            copies, sums = batch.column("copies").to_numpy(), np.zeros(len(raw), np.int64)
            for size in {len(r) for r in raw}:
                asked = np.array([i for i, r in enumerate(raw) if len(r) == size])
                there = np.array([i for i, r in enumerate(own) if len(r) == size], int)
                if len(there):
                    x = np.stack([np.frombuffer(raw[i], np.float64) for i in asked])
                    y = np.stack([np.frombuffer(own[i], np.float64) for i in there])
                    link = (x @ y.T >= threshold) & (ids[asked][:, None] != own_ids[there][None, :])
                    sums[asked] += link @ copies[there]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums)], names=["id", "true"])

    true = units.select("id", "unit", "copies").mapInArrow(compare, "id bigint, true bigint").groupBy("id").agg(
        F.sum("true").alias("true"))
    n, hit = true.join(counted, "id", "left").agg(
        F.sum("true"), F.sum(F.least("true", F.coalesce("others", F.lit(0))))).first()
    return hit / n if n else 1.0


def block_ball(rows: pa.Table) -> pa.Table:
    """The middle of a block's vectors and the largest angle between it and one of them."""
    x = _rows(rows.column("unit"), np.float64)
    middle = x.sum(0)
    length = math.sqrt(float(middle @ middle))
    middle = middle / length if length > 1e-9 else x[0]
    radius = float(np.arccos(np.clip(x @ middle, -1, 1)).max())
    return pa.table({"block": rows.column("block").slice(0, 1), "middle": pa.array([middle.tobytes()], pa.binary()),
                     "radius": pa.array([radius], pa.float64())})


def near_blocks(rows: pa.Table, threshold: float) -> pa.Table:
    """Pairs of blocks (x >= y) that may hold a link: by the triangle inequality of angles, the others
    cannot."""
    asked = rows.column("asked").to_numpy(zero_copy_only=False)
    x, y = rows.filter(pa.array(asked)), rows.filter(pa.array(~asked))
    out_x, out_y = [], []
    sizes = [np.array([len(m) for m in t.column("middle").to_pylist()]) for t in (x, y)]
    for size in np.intersect1d(*sizes):
        p, q = (t.filter(pa.array(n == size)) for t, n in zip((x, y), sizes, strict=True))
        angles = np.arccos(np.clip(_rows(p.column("middle"), np.float64) @ _rows(
            q.column("middle"), np.float64).T, -1, 1))
        reach = p.column("radius").to_numpy()[:, None] + q.column("radius").to_numpy()[None, :]
        # Angles near 0 are exact to about 1e-8.
        i, j = np.nonzero(angles <= reach + math.acos(max(-1.0, min(1.0, threshold))) + 1e-6)
        names = p.column("block").to_pylist(), q.column("block").to_pylist()
        for a, b in zip(i, j, strict=True):
            if names[0][a] >= names[1][b]:
                out_x.append(names[0][a])
                out_y.append(names[1][b])
    return pa.table({"x": pa.array(out_x, pa.string()), "y": pa.array(out_y, pa.string())})


def count_between(rows: pa.Table, threshold: float) -> pa.Table:
    """For the vectors of two blocks, or of one block twice: the weight of those that they link to, and
    the least vector that links within the two lead to."""
    first = rows.column("first").to_numpy(zero_copy_only=False)
    same = rows.column("x")[0].as_py() == rows.column("y")[0].as_py()
    x = rows.filter(pa.array(first))
    y = x if same else rows.filter(pa.array(~first))
    ids, others = x.column("id").to_numpy(), y.column("id").to_numpy()
    link = _rows(x.column("unit"), np.float64) @ _rows(y.column("unit"), np.float64).T >= threshold
    link &= ids[:, None] != others[None, :]
    label, other_label = ids.copy(), others.copy()
    none = np.iinfo(np.int64).max
    while True:
        fresh = np.minimum(label, np.where(link, other_label[None, :], none).min(1))
        other_fresh = np.minimum(other_label, np.where(link, fresh[:, None], none).min(0))
        if (fresh == label).all() and (other_fresh == other_label).all():
            break
        label, other_label = fresh, other_fresh
    out = [ids], [link @ y.column("copies").to_numpy()], [label]
    if not same:
        for column, more in zip(out, (others, link.T @ x.column("copies").to_numpy(), other_label), strict=True):
            column.append(more)
    return pa.table(dict(zip(("id", "weight", "label"), map(np.concatenate, out), strict=True)))


def link_saturated(full: DataFrame, groups: DataFrame, units: DataFrame, threshold: float, k: int) -> DataFrame:
    """All links among the vectors of ``full``, counted without writing pairs: id, weight, label, in rows
    per vector and pair of blocks."""
    rows = full.count()
    spark = units.sparkSession
    own = units.join(full, "id").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "unit", "copies", "component", F.length("unit").alias("length"))
    # A block's vectors come from one group, so that its ball is small; what is in no large group is mixed.
    large = own.where("component is not null").groupBy("component").count().where(F.col("count") > k).select("component")
    dealt = own.join(large.withColumn("large", F.lit(True)), "component", "left").withColumn(
        "of", F.when(F.col("large"), F.col("component")))
    sizes = dealt.groupBy("of", "length").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).select(
        F.col("of").alias("s_of"), F.col("length").alias("s_length"), "parts")
    part = F.pmod(F.xxhash64("id", "unit"), F.col("parts"))
    members = written(in_tasks(dealt.join(
        sizes, dealt["of"].eqNullSafe(sizes["s_of"]) & (dealt["length"] == sizes["s_length"])).select(
        F.concat_ws("/", F.coalesce(F.col("of").cast("string"), F.lit("-")), "length", part.cast("string")).alias("block"),
        "id", "unit", "copies"), rows * k), "saturated-vectors")
    balls = written(members.groupBy("block").applyInArrow(
        block_ball, "block string, middle binary, radius double"), "vector-blocks")
    chunks = max(1, math.ceil(balls.count() / BLOCK))
    chunk, every = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    columns = ("block", "middle", "radius")
    pairs = written(
        balls.select(*columns, chunk.alias("i"), every.alias("j"), F.lit(True).alias("asked")).union(
            balls.select(*columns, every.alias("i"), chunk.alias("j"), F.lit(False).alias("asked")))
        .groupBy("i", "j").applyInArrow(lambda rows: near_blocks(rows, threshold), "x string, y string"), "block-pairs")
    sides = pairs.join(members, pairs["x"] == members["block"]).withColumn("first", F.lit(True)).union(
        pairs.where("x <> y").join(members, F.col("y") == F.col("block")).withColumn("first", F.lit(False))).drop("block")
    return written(sides.groupBy("x", "y").applyInArrow(
        lambda rows: count_between(rows, threshold), "id bigint, weight bigint, label bigint"), "block-links")


def _counts(links: DataFrame, full: DataFrame, within: DataFrame, copies: DataFrame) -> DataFrame:
    """id and others: how many rows of other ids it links to. Links between two vectors of ``full`` are counted
    in ``within``, all others in ``links``."""
    both = links.union(links.select("b", "a")).toDF("id", "other")
    flag = lambda node: full.select(F.col("id").alias(node), F.lit(True).alias(f"{node}_full"))
    listed = both.join(flag("id"), "id", "left").join(flag("other"), "other", "left").where(
        "id_full is null or other_full is null").join(
        copies.toDF("other", "weight"), "other").select("id", "weight")
    return listed.union(within.select("id", "weight")).groupBy("id").agg(F.sum("weight").alias("others"))


def link_vectors(vectors: DataFrame, threshold: float = 0.9, k: int = 10, tables: int = 6, rounds: int = 8,
                 settled: float = 0.02, growth: int = 4, audited: int = 1000, least_recall: float = 0.98) -> DataFrame:
    """Every row of vectors: vec_id, n_links, component_id, kept and recall (the audit's).

    Rounds pause once less than a share ``settled`` of the lists' places change, or after ``rounds``. Then
    saturated lists become twice as long, up to ``growth`` times the length of the others, and rounds go on;
    vectors that are saturated at that length are compared in blocks of large groups. Where the audit of about
    ``audited`` vectors then finds less than ``least_recall`` of their links, lists twice as long and fresh sign
    codes widen the search, again and again if need be, until a list could hold every vector; ``recall`` says
    how it ended. The audit's vectors are compared with all, in blocks, and gain no link by it. Rows with the same
    direction are one vector in the search and count one by one in n_links. Vectors that are null, empty, zero, or
    hold null or non-finite components, and rows without an id, link with nothing; so do vectors of
    different lengths. Different vectors under one id count as one with all their links. Other columns are
    ignored; an empty table gives an empty result.
    """
    ship_code(vectors.sparkSession)
    own = written(vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), "embedding").mapInArrow(
        unit_vectors, "vec_id bigint, unit binary, half binary"), "unit-vectors")
    units = written(in_tasks(own.where("unit is not null and vec_id is not null").groupBy("unit").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("half").alias("half")), own.count() * k),
        "distinct-vectors")
    halves = units.select("id", "half")
    copies = units.groupBy("id").agg(F.sum("copies").alias("copies"))
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def in_code_order(some: range, reach: int) -> DataFrame:
        start = halves.mapInArrow(lambda b: sign_codes(b, some), "t int, code binary, id bigint, half binary")
        ordered = start.repartitionByRange(n, "t", "code", "id").sortWithinPartitions("t", "code", "id")
        return written(in_tasks(ordered, vectors_in_all * k).mapInArrow(
            lambda b: neighbours_in_order(b, reach), EDGES).where("u <> v"), "neighbour-pairs")

    near, used, longest, vectors_in_all = threshold - SLACK, tables, growth * k, units.count()
    # Lists that may be longer than k.
    caps = None
    found = in_code_order(range(tables), k // 2)
    graph, met = _merged(None, found, caps, k, vectors_in_all * k), _near_pairs(found, threshold)
    done = 0
    while True:
        changed, places = graph.agg(F.count(F.when(F.col("fresh"), 1)), F.count("*")).first()
        rows = max(places, vectors_in_all * k)
        if not (done and changed <= settled * places or not places or done == rounds):
            found = written(descend(graph, halves, caps, k, longest, near, rows), "neighbour-pairs")
            graph = graph.withColumn("fresh", F.lit(False))
            done += 1
        else:
            states = _states(graph, caps, k, near)
            grown = states.where(F.col("saturated") & (F.col("cap") < longest)).select(
                F.col("u").alias("id"), F.least(F.col("cap") * 2, F.lit(longest)).cast("int").alias("cap"))
            grown = written(in_tasks(grown, rows), "grown-lists")
            if rounds and not grown.isEmpty():
                # Once more through the lists of these: what they had no place for is met again.
                caps = grown if caps is None else written(
                    in_tasks(caps.join(grown, "id", "left_anti"), rows).union(grown), "list-lengths")
                graph = graph.drop("fresh").join(
                    grown.select(F.col("id").alias("u"), F.lit(True).alias("fresh")), "u", "left").withColumn(
                    "fresh", F.coalesce("fresh", F.lit(False)))
                graph = written(in_tasks(graph, rows), "neighbour-lists")
                found = written(descend(graph, halves, caps, k, longest, near, rows), "neighbour-pairs")
                graph, done = graph.withColumn("fresh", F.lit(False)), 1
            else:
                met = written(in_tasks(met.distinct(), rows), "near-pairs")
                links = written(_links(met, units, threshold), "vector-links")
                full = written(in_tasks(states.where("saturated").select(F.col("u").alias("id")), rows), "saturated-ids")
                groups = written(in_tasks(
                    components(links, "vector-groups", links.count()), vectors_in_all), "vector-groups")
                within = link_saturated(full, groups, units, threshold, k)
                counted = written(in_tasks(_counts(links, full, within, copies), rows), "link-counts")
                recall = audit(units, counted, threshold, audited)
                if recall >= least_recall or k >= vectors_in_all:
                    break
                k, longest, done = 2 * k, 2 * longest, 0
                found = in_code_order(range(used, used + tables), k // 2)
                used += tables
                caps = None if caps is None else caps.where(F.col("cap") > k)
                graph = graph.withColumn("fresh", F.lit(False))
        graph = _merged(graph, found, caps, k, rows)
        met = met.union(_near_pairs(found, threshold))
    # Groups that saturated vectors join.
    of = lambda node: groups.select(F.col("node").alias(node), F.col("component").alias(f"{node}_group"))
    joined = within.where("id <> label").select("id", "label").distinct().join(of("id"), "id", "left").join(
        of("label"), "label", "left").select(
        F.coalesce("id_group", "id").alias("a"), F.coalesce("label_group", "label").alias("b")).where("a <> b").distinct()
    larger = components(joined, "joined-groups", within.count()).toDF("group", "joined")
    nodes = copies.join(counted, "id", "left").join(groups.toDF("id", "component"), "id", "left").withColumn(
        "group", F.coalesce("component", "id")).join(larger, "group", "left").select(
        "id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("joined", "group").alias("component_id"))
    placed = units.select("unit", "id").join(nodes, "id").select("unit", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    result = own.withColumn("unit", F.when(F.col("vec_id").isNotNull(), F.col("unit"))).join(
        placed, "unit", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.lit(recall).alias("recall"))
    return in_tasks(result, rows)
