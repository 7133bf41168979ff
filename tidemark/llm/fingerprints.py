"""Document fingerprints from closed syncmers, in Spark's own expressions.

A run of K characters is an anchor if, of the runs of S characters inside it, the one of least hash
stands at its beginning or its end. That depends on the run alone, not on what surrounds it: a
passage has the same anchors wherever it stands, at places shifted by one distance. So the anchors
of a text put together from two others are theirs and those across the seam.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import texts

K, S = 12, 4
# A text is worked through in pieces of so many characters: bounded memory for very long ones.
PIECE = 8192
# Anchors that one part of a printed fingerprint stands for.
RUN = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, computed once: an expression used twice would be computed twice."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _let2(a: Column, b: Column, body: Callable[[Column, Column], Column]) -> Column:
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda s: body(s["a"], s["b"]))


def _piece_anchors(text: Column, shift: Column) -> Column:
    last = K - S

    def of(chars: Column) -> Column:
        inner = F.transform(F.slice(chars, F.lit(1), F.size(chars) - (S - 1)), lambda c, i: F.hash(
            c, *(F.get(chars, i + k) for k in range(1, S))))

        def closed(h: Column) -> Column:
            ends = F.zip_with(F.slice(h, F.lit(1), F.size(h) - last), F.slice(h, F.lit(1 + last), F.size(h)),
                              lambda a, z: F.least(a, z))

            def anchor(end: Column, i: Column) -> Column:
                # Most places fail at the first comparisons.
                least = end <= F.get(h, i + 1)
                for k in range(2, last):
                    least = least & (end <= F.get(h, i + k))
                # Inner runs a width apart make up the whole run.
                own = F.hash(*(F.get(h, i + k) for k in range(0, K, S))).cast("bigint")
                return F.when(least, (i + shift).cast("bigint") * F.lit(1 << 32) + own + F.lit(1 << 31))

            return F.array_compact(F.transform(ends, anchor))

        return F.when(F.size(chars) >= K, _let(inner, closed)).otherwise(F.array().cast("array<bigint>"))

    return _let(F.split(text, ""), of)


def anchors(text: Column) -> Column:
    """The anchors of a text, in order: its place, in characters from 0, times 2 ** 32, plus its hash.
    None if the text is shorter than K characters."""
    n = F.length(text)
    pieces = F.when(n <= 2 * PIECE, F.array(text)).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(n - K, F.lit(0)), F.lit(PIECE)),
        lambda at: F.substring(text, at + 1, F.lit(PIECE + K - 1))))
    return F.flatten(F.transform(pieces, lambda piece, j: _piece_anchors(piece, j * PIECE)))


def place_of(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def hash_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << 32) - 1))


def moved(found: Column, by: Column) -> Column:
    """The same anchors, so many places further on."""
    return F.transform(found, lambda a: a + by.cast("bigint") * F.lit(1 << 32))


def or_whole(found: Column, text: Column) -> Column:
    """The anchors, or for a text without any, if it isn't empty, one made of the whole of it at place 0."""
    return F.when(F.size(found) > 0, found).when(F.length(text) > 0, F.array(
        F.hash(text).cast("bigint") + F.lit(1 << 31))).otherwise(no_anchors())


def no_anchors() -> Column:
    return F.array().cast("array<bigint>")


def common_shift(a: Column, b: Column) -> Column:
    """By how many places anchors of b stand before their equals in a: the distance that most of the hashes
    give that both texts have once; of several the least. 0 if there is no such hash."""
    def tagged(found: Column, tag: int) -> Column:
        return F.transform(found, lambda x: F.shiftleft(hash_of(x), 32) + place_of(x) * 2 + tag)

    def distances(both: Column) -> Column:
        def distance(v: Column, i: Column) -> Column:
            following = F.get(both, i + 1)
            h = F.shiftright(v, 32)
            once = (F.shiftright(following, 32) == h) & (v.bitwiseXOR(following).bitwiseAND(F.lit(1)) == 1)
            alone = (F.coalesce(F.shiftright(F.get(both, i + 2), 32) != h, F.lit(True))
                     & F.when(i == 0, True).otherwise(F.shiftright(F.get(both, i - 1), 32) != h))
            apart = F.shiftright(hash_of(following), 1) - F.shiftright(hash_of(v), 1)
            return F.when(once & alone, F.when(v.bitwiseAND(F.lit(1)) == 1, apart).otherwise(-apart))

        return F.sort_array(F.array_compact(F.transform(both, distance)))

    def count(state: Column, d: Column) -> Column:
        run = F.when(d == state["last"], state["run"] + 1).otherwise(F.lit(1))
        return F.struct(d.alias("last"), run.alias("run"), F.greatest(run, state["most"]).alias("most"),
                        F.when(run > state["most"], d).otherwise(state["best"]).alias("best"))

    nothing = F.lit(0).cast("bigint")
    start = F.struct(nothing.alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"), nothing.alias("best"))
    both = F.sort_array(F.concat(tagged(a, 0), tagged(b, 1)))
    return _let(both, lambda x: F.aggregate(distances(x), start, count, lambda state: state["best"]))


def likeness(a: Column, b: Column, in_place: bool = False) -> Column:
    """How alike two texts are by their anchors, from 0 to 1: the anchors that match in hash and, shifted by one
    distance for all of them, in place, over all anchors of either. The distance is the common one, or none if
    that matches more; always none if ``in_place``. Two texts without anchors are alike."""
    def matched(shift: Column) -> Column:
        still = F.size(F.array_intersect(a, b))
        return F.when(shift == 0, still).otherwise(F.greatest(still, F.size(F.array_intersect(a, moved(b, shift)))))

    if in_place:
        found = F.size(F.array_intersect(a, b))
    else:
        shared = F.arrays_overlap(F.transform(a, hash_of), F.transform(b, hash_of))
        found = F.when(shared, _let(common_shift(a, b), matched)).otherwise(F.lit(0))
    share = _let(found, lambda m: m / (F.size(a) + F.size(b) - m))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(share)


def printed(found: Column) -> Column:
    """All anchors as text: 16 hexadecimal digits for every RUN of them, so texts that begin alike have prints that
    begin alike."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1)), F.lit(RUN))
    return F.when(F.size(found) == 0, "").otherwise(F.array_join(F.transform(starts, lambda at: F.lpad(
        F.lower(F.hex(F.xxhash64(F.slice(found, at, F.lit(RUN))))), 16, "0")), ""))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of (doc_id, text) dealt into runs of ascending ids, each run with the row that follows it:
    columns run, doc_id, text, late (the row belongs to a later run, or comes round from the start).

    Runs begin at ids that percentiles of all ids name; the row that begins a run is copied to the one
    before it, and the first row of all to the last run.
    """
    key = F.coalesce("doc_id", F.lit(-2 ** 63))
    shares = [i / parts for i in range(1, parts)]
    named = docs.agg(F.min(key).alias("least"), F.percentile_approx(key, shares or [0.5]).alias("cuts")).first()
    if named["least"] is None:
        return docs.select(F.lit(0).alias("run"), "doc_id", "text", F.lit(0).alias("late"))
    # One number per run.
    begins = sorted({*named["cuts"], named["least"]})
    run = F.aggregate(F.array(*map(F.lit, begins)), F.lit(0), lambda n, b: n + (key >= b).cast("int")) - 1
    copies = F.array(F.struct(F.col("run"), F.lit(0).alias("late")))
    guest = F.struct((F.col("run") - 1).alias("run"), F.lit(1).alias("late"))
    round_ = F.struct(F.lit(len(begins) - 1).alias("run"), F.lit(2).alias("late"))
    return docs.withColumn("run", run).select("doc_id", "text", F.explode(
        F.when(key == begins[0], F.concat(copies, F.array(round_)))
        .when(key.isin(begins), F.concat(copies, F.array(guest))).otherwise(copies)).alias("r")
    ).select("r.run", "doc_id", "text", "r.late")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Every row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_anchors.

    The edited text is the text with its last half replaced by as much of the next document's
    beginning, or all of it, next by doc_id, and by text among equal ids; the last is followed by
    the first. Characters give way to as many at most, so what the edit leaves is compared in its place, while
    the next document is compared by the distance that both share. The edited text's anchors are put
    together from those of both parts and of the seam. A fingerprint stands for all anchors of a text with
    their places. Null texts are empty; an empty text has an
    empty fingerprint, one without anchors that of the whole text. Null ids come first. Very long texts are
    worked through in pieces, and every step is in proportion to a text's length. Other columns are
    ignored; an empty table gives an empty result.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    own = texts(docs).withColumn("text", text)
    order = W.partitionBy("run").orderBy("late", "doc_id", "text")
    # Only texts are shuffled: anchors are made where the runs are, once per text.
    rows = with_next(own, parts).repartition("run").select(
        "*", F.length("text").alias("n"), anchors(F.col("text")).alias("own"))
    # The window stands between the lengths and their use, so that they are numbers there and not computed again
    # for every anchor.
    rows = rows.select(
        "run", "late", "doc_id", "text", "n", "own",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next"),
        F.coalesce(F.lead("n").over(order), F.lit(0)).alias("next_n"),
        F.coalesce(F.lead("own").over(order), no_anchors()).alias("next_own")).where("late = 0")
    half = F.floor(F.col("n") / 2).cast("int")
    head_n, tail_n = F.col("n") - half, F.least(half, F.col("next_n"))
    edited = F.concat(F.left("text", head_n), F.left("next", tail_n))
    # Of the seam as much as an anchor across it can hold.
    before, after = F.least(head_n, F.lit(K - 1)), F.least(tail_n, F.lit(K - 1))
    seam = anchors(F.concat(F.substring("text", head_n - before + 1, before), F.left("next", after)))

    def up_to(column: str, end: Column) -> Column:
        return F.filter(column, lambda a: place_of(a) + K <= end)

    together = F.concat(up_to("own", head_n), moved(seam, head_n - before), moved(up_to("next_own", tail_n), head_n))
    mine, following = or_whole(F.col("own"), F.col("text")), or_whole(F.col("next_own"), F.col("next"))
    return rows.withColumns({"edited": edited, "mine": mine, "following": following, "together": together}).select(
        "doc_id", "n", "edited", "mine", "following", "own", or_whole(F.col("together"), F.col("edited")).alias("theirs")
    ).select(
        "doc_id", F.col("n").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        _let(F.col("mine"), printed).alias("fingerprint"),
        _let(F.col("theirs"), printed).alias("edited_fingerprint"),
        _let2(F.col("mine"), F.col("theirs"), lambda a, b: likeness(a, b, in_place=True)).alias("near_edited"),
        _let2(F.col("mine"), F.col("following"), likeness).alias("near_next"),
        F.size("own").cast("bigint").alias("n_anchors"))
