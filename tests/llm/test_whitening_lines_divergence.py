"""Whitening, line dedup and the divergence audit against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cuckoo, divergence, line_dedup, whitening


# --- whitening ---------------------------------------------------------------------------------


@pytest.mark.parametrize("spectrum", [
    np.arange(64, 0, -1.0), np.full(64, 5.0), 1 - 1e-4 * np.arange(64), np.array([9.0, 4, 4, 1, 0.5, 0.1, 0.01, 1e-3]),
    np.concatenate([[1e6], np.ones(40), np.zeros(20)])])
def test_leading_eigenpairs(spectrum):
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((len(spectrum),) * 2))[0]
    v = (turn * spectrum) @ turn.T
    passes = []

    def product(q):
        passes.append(q.shape)
        return v @ q

    found = whitening.leading(product, len(v), min(8, len(v)))
    assert np.allclose(found.values[:8], np.sort(spectrum)[::-1][:8], rtol=1e-12, atol=1e-12 * spectrum.max())
    assert (found.residuals[:8] <= 1e-10 * spectrum.max()).all()
    q = found.vectors[:, :8]
    assert np.abs(q.T @ q - np.eye(q.shape[1])).max() < 1e-13
    assert len(passes) < 60


def test_one_value_far_above_an_even_spectrum():
    """Copies of one vector make one value large; the filter then must not bury the others under its rounding."""
    spectrum = np.concatenate([[1_000_000, 34_000, 17_600], np.linspace(16_900, 12_200, 61)])
    turn = np.linalg.qr(np.random.default_rng(4).standard_normal((64, 64)))[0]
    v, passes = (turn * spectrum) @ turn.T, []

    def product(q):
        passes.append(1)
        assert len(passes) <= 120
        return v @ q

    found = whitening.leading(product, 64, 8)
    assert (found.residuals[:8] <= 1e-14 * spectrum[0]).all()
    assert np.allclose(found.values[:8], spectrum[:8], rtol=1e-12)


def vectors(n=300, d=12, seed=0):
    draw = np.random.default_rng(seed)
    turn = np.linalg.qr(draw.standard_normal((d, d)))[0]
    return (draw.standard_normal((n, d)) * np.linspace(2, 0.2, d)) @ turn.T + 1


def embedded(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [c if c is None else float(c) for c in v], 7, "x", 1, 2.0) for i, v in rows],
        "vec_id long, embedding array<double>, label int, x string, n int, whitened double").repartition(3)


def test_whitening(spark):
    x = vectors()
    rows = list(enumerate(x)) + [(None, x[0]), (5, x[5])]
    odd = [(900, None), (901, [math.nan] * 12), (902, [math.inf] + [0.0] * 11), (903, [None] + [0.0] * 11), (904, []), (905, [1.0])]
    found = whitening.whiten(embedded(spark, rows + odd)).collect()
    ids = [i for i, _ in rows]
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in found if r.component == 1) == sorted(
        (i is None, i or 0) for i in ids)
    whole = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n = len(whole)
    z = (n * whole - whole.sum(0)) / n
    values, turn = np.linalg.eigh(z.T @ z / n)
    values, turn = values[::-1][:8], turn[:, ::-1][:, :8]
    want = z @ turn / np.sqrt(values)
    by_id = {r: i for i, r in enumerate(ids)}
    got, deviation = np.zeros((n, 8)), {}
    for r in found:
        assert r.n == n and r.identity_error < 1e-10 and r.residual < 1e-10
        assert abs(r.explained - values[r.component - 1] / np.trace(z.T @ z / n)) < 1e-10
        got[by_id[r.vec_id], r.component - 1] = r.whitened
        deviation[by_id[r.vec_id]] = r.deviation
    signs = np.sign((got[:5] * want[:5]).sum(0))
    last = by_id[5]
    assert np.allclose(got[:5] * signs, want[:5], atol=1e-9) and np.allclose(got[last] * signs, want[last], atol=1e-9)
    for at, value in deviation.items():
        assert value == sum((n * int(c) - int(s)) ** 2 for c, s in zip(whole[at], whole.sum(0), strict=True))


def test_whitening_of_little(spark):
    empty = embedded(spark, [(1, None)])
    assert whitening.whiten(empty).count() == 0
    assert whitening.whiten(embedded(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(embedded(spark, [(i, [1.0, 2.0]) for i in range(4)])).count() == 0
    line = whitening.whiten(embedded(spark, [(i, [float(i), 2.0 * i]) for i in range(4)])).collect()
    assert {r.component for r in line} == {1} and abs(sum(r.whitened ** 2 for r in line) / 4 - 1) < 1e-12
    assert {round(r.explained, 12) for r in line} == {1}
    with pytest.raises(Exception, match="fit a long"):
        whitening.whiten(embedded(spark, [(1, [1e30]), (2, [2.0])])).collect()


# --- line dedup --------------------------------------------------------------------------------


def some_digests(n, seed=0):
    return [hashlib.blake2b(f"{seed}-{i}".encode(), digest_size=16).digest() for i in range(n)]


def test_cuckoo_filter_never_denies_and_forgets():
    held, others = cuckoo.words(some_digests(5000)), cuckoo.words(some_digests(20_000, 1))
    cells = cuckoo.build(held)
    assert cuckoo.contains(cells, held).all()
    assert cuckoo.contains(cells, others).mean() < 0.002
    cuckoo.delete(cells, held[:2000])
    assert cuckoo.contains(cells, held[2000:]).all() and cuckoo.contains(cells, held[:2000]).mean() < 0.01
    assert cuckoo.insert(cells, held[:2000]) and cuckoo.contains(cells, held).all()
    cuckoo.delete(cells, held)
    assert not cells.any()
    with pytest.raises(ValueError, match="not in the filter"):
        cuckoo.delete(cells, held[:1])
    assert not cuckoo.insert(cuckoo.empty(10), held)


def plain_kept(rows, least_chars=20, least_docs=3):
    """Of each row its lines, those dropped, and the text that stays."""
    def key(line):
        own = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in own)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(holders[key(x)]) < least_docs
                or i == max(holders[key(x)], key=lambda d: (d is not None, d or 0))]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def line_rows(seed=0, n=60):
    draw = random.Random(seed)
    shared = [f"A line that Many documents share, no. {i}" for i in range(8)] + ["short", "", "é" * 19, "é" * 20, "É" * 25]
    rows = []
    for i in range(n):
        lines = [draw.choice(shared).swapcase() if draw.random() < 0.3 else draw.choice(shared) for _ in range(draw.randint(0, 6))]
        lines += [f" \t own line of {i}, number {k}\r" for k in range(draw.randint(0, 3))]
        draw.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(None, None), (None, shared[0] + "\n" + shared[1]), (None, shared[0]), (7, ""), (8, rows[8][1]), (9, shared[2]),
             (500, "x" * 300_000 + "\n" + shared[3] + "\n" + "y z" * 20_000)]
    return rows


def line_table(spark, rows):
    extra = "x", 1, 2, "z", 3
    return spark.createDataFrame([(*r, *extra) for r in rows],
                                 "doc_id long, text string, digest string, docs long, n long, dropped string, shard int").repartition(3)


def kept_rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


@pytest.mark.parametrize("filter_bytes", [0, 1 << 20])
def test_lines_against_plain(spark, filter_bytes):
    rows = line_rows()
    index = line_dedup.LineIndex(spark, shards=3, filter_bytes=filter_bytes).insert(line_table(spark, rows))
    want = plain_kept(rows)
    assert sum(r[2] for r in want) > 50
    assert kept_rows(index.drop_lines(line_table(spark, rows))) == want
    digests = line_dedup.digest_kept(index.drop_lines(line_table(spark, rows))).collect()
    assert Counter(r.kept_sha256 for r in digests) == Counter(hashlib.sha256(w[3].encode()).hexdigest() for w in want)


def test_increments_and_deletions_undo_each_other(spark):
    rows = line_rows()
    first, second, third = rows[:25], rows[25:50], rows[50:]
    tables = [line_table(spark, r) for r in (first, second, third)]
    index = line_dedup.LineIndex(spark, shards=3)
    one = index.insert(tables[0])
    both = one.insert(tables[1])
    all_three = both.insert(tables[2])
    assert kept_rows(all_three.drop_lines(line_table(spark, rows))) == plain_kept(rows)
    back = all_three.delete(tables[1])
    assert kept_rows(back.drop_lines(line_table(spark, first + third))) == plain_kept(first + third)
    # Taking the largest holders away names the next ones.
    again = all_three.delete(tables[2])
    assert kept_rows(again.drop_lines(line_table(spark, first + second))) == plain_kept(first + second)
    for a, b in ((again, both), (both.delete(tables[1]), one)):
        assert sorted(map(tuple, a.counts.collect()), key=str) == sorted(map(tuple, b.counts.collect()), key=str)
        cells = [{r["shard"]: sum(map(bool, cuckoo.load(r["cells"]).ravel())) for r in x.filters.collect()} for x in (a, b)]
        assert cells[0] == cells[1]
    gone = one.delete(tables[0])
    assert gone.counts.count() == 0 and gone.filters.count() == 0
    # The earlier states are as they were.
    assert kept_rows(one.drop_lines(tables[0])) == plain_kept(first)


def test_the_filters_are_asked(spark):
    """What they deny stays; what they wrongly allow changes nothing."""
    rows = line_rows()
    docs = line_table(spark, rows)
    index = line_dedup.LineIndex(spark, shards=3).insert(docs)
    from dataclasses import replace
    deny = replace(index, filters=index.filters.where("false"))
    assert {r[2] for r in kept_rows(deny.drop_lines(docs))} == {0}
    strangers = spark.createDataFrame([(s, cuckoo.build(cuckoo.words(some_digests(100, s))).tobytes()) for s in range(3)],
                                      line_dedup.FILTERS)
    assert {r[2] for r in kept_rows(replace(index, filters=strangers).drop_lines(docs))} == {0}
    shards = {r[0] for r in index.counts.where("docs >= 3").select(line_dedup.shard_of("digest", 3)).collect()}
    assert shards == {r["shard"] for r in index.filters.collect()}


def test_lines_of_empty_tables(spark):
    docs = line_table(spark, line_rows())
    index = line_dedup.LineIndex(spark).insert(docs.where("false"))
    assert index.drop_lines(docs.where("false")).count() == 0
    assert kept_rows(index.insert(docs).drop_lines(docs)) == plain_kept(line_rows())


# --- divergence --------------------------------------------------------------------------------


def plain_audit(rows, least_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        terms = [t for t, n in seen.items() if n >= least_docs]
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in set(terms)) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def share(c, t, v=len(terms)):
            return 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * v)

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in counts.items():
            pairs = [(sum(f(share(c, t), share(e, t)) for t in terms), o) for o, e in counts.items() if o != s]
            raised = [(f(share(c, t), share(whole, t)), t) for t in terms if c[t] and share(c, t) > share(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", raised, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


@pytest.fixture(scope="module")
def spoken():
    draw = random.Random(5)
    words = ["the", "The", "a1b", "über", "ÜBER", "日本", "x_y", "co-op", "zebra", "Ångström"] + [f"w{c}" for c in "abcdefghijklmnop"]
    rows = []
    for _ in range(150):
        source = draw.choice(["s1", "s1", "s1", "s2", "s3", "S4", "é", None])
        rows.append((" ".join(draw.choices(words, k=draw.randint(0, 12))), draw.choice(["en", "de", None]), source))
    rows += [("rare words only", "fr", "s1"), ("nothing here", "fr", "s2"), (None, "fr", "s3"), ("", "en", "without terms"),
             ("... 123", "de", None), ("the " * 20_000, "en", "s2"), ("q" * 50_000, "en", "s3")]
    return rows + rows[:3]


@pytest.mark.parametrize("block,tile", [(3, 2), (divergence.BLOCK, divergence.TILE)])
def test_divergence(spark, spoken, block, tile):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in spoken],
                                 "text string, lang string, source string, n int, term string, idx int, block int").repartition(3)
    found = divergence.audit_sources(docs, 5, 4, block, tile)
    rows = [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_audit(spoken, 5, 4)
    assert {r[0] for r in rows} == {"en", "de", "", "fr"}
    assert divergence.audit_sources(docs.where("false")).count() == 0


def test_pieces_and_runs():
    text = "Ab cd ab " * 1000
    assert divergence.term_counts(text, 100) == divergence.term_counts(text) == Counter({b"ab": 2000, b"cd": 1000})
    begins, counts = divergence.full_runs([(2, 3, 7), (5, 1, 1)], 10)
    assert begins.tolist() == [0, 2, 5, 6] and counts.tolist() == [0, 7, 1, 0]
    draw = np.random.default_rng(0)
    a, b = draw.integers(1, 4, 50) * 10 ** 8, draw.integers(1, 4, 50) * 10 ** 8

    def runs(p):
        at = np.flatnonzero(np.diff(p, prepend=-1))
        return at, p[at]

    want = sum((int(p) - int(q)) ** 2 // (int(p) + int(q)) for p, q in zip(a, b, strict=True))
    assert divergence.intersect(runs(a), runs(b), 50) == want


def test_shares_are_exact_for_large_counts(spark):
    big = 6_000_000_000_000_000
    rows = spark.createDataFrame([(big, big + 7, 5)], "n long, total long, terms long")
    got = rows.select(divergence.scaled_share("n", "total", "terms")).first()[0]
    assert got == 1 + 10 ** 9 * (big + 2) // (big + 7 + 10) == divergence._shares(np.array([big]), big + 7, 5)[0]
    assert rows.select(divergence.divergence(F.lit(10 ** 9 + 1).cast("long"), F.lit(1).cast("long"))).first()[0] == 10 ** 18 // (10 ** 9 + 2)
