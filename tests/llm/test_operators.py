"""Each text operator against a plain version on small tables, with the odd rows that tables hold."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import GroupedData
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import (
    bpe, bpe_documents, embedding_dedup, fingerprints, licenses, ngram_join, packing, quality, secret_scan,
    sharding, toxicity,
)
from tidemark.llm import components as components_module
from tidemark.llm.common import releasing, written
from tidemark.llm.components import components
from tidemark.llm.trie import linked
from tidemark.llm.words import split_words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
# Columns that the operators use inside themselves, as a table might have them too.
CLASHES = ", shard string, token string, n long, part int, text_crc32 string, row int, u int, size int"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeioustrnl") for _ in range(draw.randint(1, 9))) for _ in range(n))


BASE = prose(1, 300)
NEAR = " ".join("other" if i == 150 else w for i, w in enumerate(BASE.split()))
TEXTS = [
    (0, BASE), (1, BASE), (2, NEAR), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "two words"),
    (8, "日本語テキスト 한국어 𐐀 é é Straße's ½ 12"), (9, "x" * 3000), (10, prose(2, 4000)), (11, "one"),
    (12, prose(3, 60)), (12, prose(3, 60)), (13, "A'S don't  \n\n ΑΣ İ x's")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", 1, 2, "z", 3, 4, 5) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string" + CLASHES).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_sharding(docs, empty):
    rows = sharding.shard_documents(docs, 3).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in TEXTS)
    text = defaultdict(set)
    for i, t in TEXTS:
        text[i].add(t or "")
    for r in rows:
        t = next(iter(text[r.doc_id])).encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None)
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own))) and 0 <= shard < 3
    assert sharding.shard_documents(empty).count() == 0


def test_shards_are_even_and_keep_copies_together(spark):
    rows = [(i, prose(i // 3 if i % 3 < 2 else i, 20)) for i in range(900)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    groups = got.assign(t=got.doc_id.map(dict(rows))).groupby("t")
    # A cut moves by half a group of copies at most.
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * groups["size"].sum().max()
    assert groups["shard"].nunique().max() == 1


def test_packing(docs, empty):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    rows = packing.pack_documents(docs, WORDS, capacity=256).collect()
    expected = []
    for i, t in TEXTS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 256)):
            own = ids[start:start + 256]
            expected.append((i, piece, start, len(own), zlib.crc32(own.tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 256
    assert len(bins) <= math.ceil(sum(e[3] for e in expected) / 256) + 1
    assert packing.pack_documents(empty, WORDS).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_fullest_bin(seed):
    draw = random.Random(seed)
    counts = np.zeros(65, np.int64)
    for _ in range(9):
        counts[draw.randint(1, 60)] += draw.randint(1, 3)
    sums = {0}
    for length in range(1, 65):
        for _ in range(counts[length]):
            sums |= {s + length for s in sums}
    chosen = packing.fullest(counts, 64)
    assert sum(n * k for n, k in chosen) == max(s for s in sums if s <= 64)
    assert all(k <= counts[n] for n, k in chosen)


def brute_links(texts, width, percent):
    sets = {}
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}
        sets[i] = grams or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(docs, empty, width, percent):
    rows = ngram_join.link_documents(docs, width, percent).collect()
    want = brute_links(TEXTS, width, percent)
    assert len(rows) == len(TEXTS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert ngram_join.link_documents(empty, width, percent).count() == 0


def test_ngram_join_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "UNIT", 20)
    words = prose(5, 120).split()
    texts = [(i, " ".join(f"w{i}" if k == i % 110 else w for k, w in enumerate(words[:120 - i % 3])))
             for i in range(90)] + [(i, prose(i, 80)) for i in range(100, 130)]
    rows = ngram_join.link_documents(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_links(texts, 3, 90)


def test_ngram_join_sends_a_set_to_few_units(spark, monkeypatch):
    """Sets that only a chain of candidates leads between aren't brought together: each is sent to few units."""
    monkeypatch.setattr(ngram_join, "UNIT", 20)
    sent, apply = [], GroupedData.applyInArrow
    monkeypatch.setattr(GroupedData, "applyInArrow", lambda self, *a: sent.append(self._df.count()) or apply(self, *a))
    halves = [prose(1000 + i, 50) for i in range(201)]
    texts = [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(halves[:-1], halves[1:], strict=True))]
    rows = ngram_join.link_documents(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_links(texts, 3, 90)
    assert sent and 200 <= sent[0] <= 3 * 200


@pytest.mark.parametrize(("unit", "percent"), [(400, 80), (3, 80), (3, 50)])
def test_ngram_join_of_sizes_in_several_classes(spark, monkeypatch, unit, percent):
    """Copies shortened step by step, and such that others lie between, in homes that are dealt out or not."""
    monkeypatch.setattr(ngram_join, "UNIT", unit)
    draw, texts = random.Random(7), []
    for k in range(5):
        words = prose(2000 + k, 70).split()
        for cut in range(0, 40, 2):
            texts.append((len(texts) * 7 % 1000, " ".join(
                w if draw.random() > 0.01 else f"w{draw.random()}" for w in words[:70 - cut])))
    rows = ngram_join.link_documents(spark.createDataFrame(texts, "doc_id long, text string"), 2, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_links(texts, 2, percent)


@pytest.mark.parametrize("seed", range(6))
def test_trie_search(seed):
    draw = random.Random(seed)
    base = [draw.randrange(10 ** 6) for _ in range(40)]
    sets = [np.unique(np.array([x if draw.random() > 0.08 else draw.randrange(10 ** 6) for x in base[:draw.randint(2, 40)]],
                               np.uint64)) for _ in range(30)]
    found = linked(sets, np.arange(30), np.arange(30), 80)
    parent = list(range(30))

    def root(p, i):
        while p[i] != i:
            i = p[i]
        return i

    got = list(range(30))
    for a, b in found:
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
        got[max(root(got, a), root(got, b))] = min(root(got, a), root(got, b))
    for a in range(30):
        for b in range(a):
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                x, y = root(parent, a), root(parent, b)
                parent[max(x, y)] = min(x, y)
    assert [root(got, i) for i in range(30)] == [root(parent, i) for i in range(30)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_secret_scan(spark, docs, empty):
    assert secret_scan.scan_secrets(empty).count() == 0
    assert secret_scan.scan_secrets(docs).count() == len(TEXTS)
    draw = random.Random(4)
    hexes = "".join(draw.choice("0123456789abcdef") for _ in range(40))
    text = f'é Token = "{hexes}" password: short1 passwd=abc AKIA{"A" * 16} AKIA123 ſecret=abcdefg {hexes[:23]}'
    row = secret_scan.digest_secrets(secret_scan.scan_secrets(
        spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    begin, key = text.index(hexes), text.index("AKIA")
    spans = [f"assign:2:{begin + 40}", f"hex:{begin}:{begin + 40}",
             f"assign:{text.index('password')}:{text.index(' passwd')}", f"access:{key}:{key + 20}"]
    assert (row.n_assign, row.n_access, row.n_hex) == (2, 1, 1)
    assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert set(spans) <= set(row.spans.split(","))


def test_randomness_battery_adds_spans(spark):
    draw = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [(i, prose(i, 200) + (" " + "".join(draw.choice(alphabet) for _ in range(48)) if i % 20 == 0 else "")
              + (" " + "wordafterwordafterwordafterwordafterwordafterword" if i % 20 == 1 else ""))
             for i in range(2000)]
    rows = secret_scan.scan_secrets(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    random_rows = {r.doc_id for r in rows if any(s.kind == "random" for s in r.spans)}
    assert len({i for i in random_rows if i % 20 == 0}) >= 80
    assert len({i for i in random_rows if i % 20}) <= 5


def test_bpe_documents(docs, empty):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                                 special_tokens={})
    want = sorted((i, encoding.encode_ordinary(t or "")) for i, t in TEXTS)
    for known in (0, 5, 1000):
        got = bpe_documents.encode_documents(docs, RANKS, known)
        assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == want
    decoded = {r.doc_id: r.decoded_sha256 for r in bpe_documents.digest_encoding(got, RANKS).collect()}
    assert decoded == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in TEXTS}
    assert bpe_documents.encode_documents(empty, RANKS).count() == 0


def test_bpe_blocks_come_to_workers_a_few_at_a_time(spark):
    """A task's blocks of texts are not all in one batch, and what a worker knows is not copied for each block."""
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words of it "), 30_000).alias("text"))
    bpe_documents.encode_documents(docs, RANKS, 1000)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    rows = docs.select(F.col("text").cast("binary").alias("codes")).mapInArrow(sizes, "n long").collect()
    assert sum(r.n for r in rows) > 30e6 and max(r.n for r in rows) < 12e6
    pool = np.arange(2_000_000, dtype=np.uint16)
    known = bpe_documents.Known(np.arange(2_000_000, dtype=np.int32), np.ones(2_000_000, np.uint8), pool)
    block = pa.RecordBatch.from_arrays([
        pa.array([[7, 8]], pa.list_(pa.int64())), pa.array([np.array([0, 2, 3]).tobytes()]),
        pa.array([np.array([5, -1, 70_000], np.int32).tobytes()]), pa.array([[[3, 4]]], pa.list_(pa.list_(pa.int32())))],
        names=["doc_ids", "cuts", "codes", "rare_ids"])
    tracemalloc.start()
    try:
        out = list(bpe_documents.to_ids(iter([block]), known))
        assert tracemalloc.get_traced_memory()[1] < 1e6
    finally:
        tracemalloc.stop()
    assert out[0].column("ids").to_pylist() == [[5, 3, 4], [70_000 % 65_536]]


def test_bpe_digests_are_made_where_the_ids_are(spark, docs):
    """Ids don't go through the JVM to be digested: the query's plan ends with the worker that made them."""
    ranks = bpe.read_ranks(RANKS)
    digests = bpe_documents.Digests(ranks)
    spelled = {rank: token for token, rank in ranks.items()}
    lists = [[5, 3, 50], [], None, [max(spelled)] * 3]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, None, 3, 4], pa.int64()), pa.array(lists, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, None, None, None) if own is None else
            (i, len(own), sha(",".join(map(str, own)).encode()), sha(b"".join(spelled[x] for x in own)))
            for i, own in zip([1, None, 3, 4], lists, strict=True)]
    for rows, expected in ((batch, want), (batch.slice(1, 3), want[1:]), (batch.slice(1, 1), want[1:2])):
        got = pa.Table.from_batches(list(digests(iter([rows])))).to_pylist()
        assert [tuple(r.values()) for r in got] == expected
    fused = bpe_documents.encode_documents(docs, RANKS, 5, then=digests)
    apart = bpe_documents.digest_encoding(bpe_documents.encode_documents(docs, RANKS, 5), RANKS)
    assert sorted(map(tuple, fused.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)
    plan = fused._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan


def test_workers_give_memory_back():
    """What a task's batches took isn't held by the idle worker, and splitting takes little at a time."""
    def anonymous():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1])

    taken = [bytearray(3000) for _ in range(60_000)]
    # Something small stays behind what was taken.
    kept = bytearray(3000)
    full = anonymous()
    del taken
    assert list(releasing(iter([1, 2]))) == [1, 2]
    assert full - anonymous() > 100_000 and kept
    split_words(["a word " * 1000], True)
    tracemalloc.start()
    try:
        split_words(["a word " * 200_000], True)
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_rounds_of_components_write_few_files(spark, monkeypatch):
    """The number of files follows from the edges, not from the shuffle's partitions."""
    files = []
    monkeypatch.setattr(components_module, "written", lambda df, name: files.append(
        (name, len((done := written(df, name)).inputFiles()))) or done)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chain = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        found = components_module.components(chain, "few-files").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, found)) == [(i, 1) for i in range(1, 401)]
    assert max(n for name, n in files if name.endswith("stars")) == 1


@pytest.mark.parametrize("spaced", [False, True])
@pytest.mark.parametrize("chunk", [1, 7, 64, 1000])
def test_words_of_texts_cut_in_chunks(spaced, chunk):
    """A text that is worked on in parts has the words of the whole, with the same hashes."""
    texts = [t or "" for _, t in TEXTS] + ["it's 'll we'd", "don't ", "'s", "a  b\n\n c' d", "x" * 90, "", "l'll 're'd" * 9]
    whole, cut = split_words(texts, spaced), split_words(texts, spaced, chunk)
    for name in ("starts", "ends", "cuts", "hashes"):
        assert getattr(whole, name).tolist() == getattr(cut, name).tolist()


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8])
@pytest.mark.parametrize("words", range(9))
def test_sets_of_a_block_of_few_words(width, words):
    text = " ".join(f"w{i}" for i in range(words))
    sets = ngram_join.ngram_sets([text, ""], width)
    assert [len(s) for s in sets] == [max(words - width + 1, int(words > 0)), 0]
    together = ngram_join.ngram_sets([text, BASE], width)
    assert together[0].tolist() == sets[0].tolist()


@pytest.mark.parametrize("chunk", [1, 50, 4000])
def test_word_hashes_in_chunks(chunk):
    values = [t or "" for _, t in TEXTS]
    for a, b in zip(ngram_join.word_hashes(values), ngram_join.word_hashes(values, chunk), strict=True):
        assert a.tolist() == b.tolist()


def test_spaced_split():
    import regex

    texts = [t for _, t in TEXTS if t] + [" 's 't", "it's's", "a \n b", "  'll", "\t'd x'", "!'s", "x ", "''s"]
    words = split_words(texts, spaced=True)
    for d, text in enumerate(texts):
        assert [words.word(w) for w in range(words.cuts[d], words.cuts[d + 1])] == regex.findall(
            public_tokenizers.PATTERN, text)


def plain_likeness(a, b, in_place=False):
    """By the places of the hashes that either text has once."""
    if not a or not b:
        return float(not a and not b)
    places = [defaultdict(list), defaultdict(list)]
    for held, found in zip(places, (a, b), strict=True):
        for x in found:
            held[x & 0xFFFFFFFF].append(x >> 32)
    votes = defaultdict(int)
    for h, (at, *more) in places[0].items():
        if not more and len(places[1].get(h, ())) == 1:
            votes[at - places[1][h][0]] += 1
    best = 0 if in_place else min(votes, key=lambda d: (-votes[d], d), default=0)
    matched = max(len(set(a) & {x + (d << 32) for x in b}) for d in (0, best))
    return matched / (len(a) + len(b) - matched)


@pytest.mark.parametrize("seed", range(6))
def test_likeness_against_plain(spark, seed):
    draw = random.Random(seed)
    pairs = []
    for _ in range(40):
        a = sorted({draw.randrange(60) << 32 | draw.randrange(draw.choice([5, 40, 2 ** 32])) for _ in range(draw.randint(0, 30))})
        b = sorted({(x >> 32) + 7 << 32 | x & 0xFFFFFFFF for x in a if draw.random() < 0.7}
                   | {draw.randrange(90) << 32 | draw.randrange(2 ** 32) for _ in range(draw.randint(0, 9))})
        pairs.append((a, b))
    table = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    for r in table.select("a", "b", fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).collect():
        assert abs(r.x - plain_likeness(r.a, r.b)) < 1e-12


def test_likeness_is_by_position(spark):
    """A text moved as a whole is like itself; the same paragraphs in another order are not."""
    paragraphs = [prose(100 + i, 60) for i in range(10)]
    text, shuffled = "\n".join(paragraphs), "\n".join(paragraphs[::-1])
    shifted, half = prose(7, 12) + "\n" + text, "\n".join(paragraphs[:5])
    table = spark.createDataFrame([(text, text), (text, shifted), (text, shuffled), (text, half), (text, prose(8, 600))],
                                  "a string, b string")
    same, moved, mixed, part, other = (r[0] for r in table.select(fingerprints.likeness(
        fingerprints.anchors(F.col("a")), fingerprints.anchors(F.col("b")))).collect())
    assert same == 1 and moved > 0.9 and mixed < 0.3 and 0.4 < part < 0.6 and other < 0.05


def test_long_texts_take_time_in_proportion(spark):
    """Half a million characters beside short ones: no step looks at the whole text once per anchor."""
    long = prose(3, 90_000)
    rows = [(1, long), (2, "short"), (3, long[100:]), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    begin = time.monotonic()
    by = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}
    assert time.monotonic() - begin < 60
    assert by[1].n_chars == len(long) and by[1].n_anchors > 90_000 and 0.45 < by[1].near_edited < 0.55
    lead = spark.createDataFrame([(long, long[100:])], "a string, b string").select(fingerprints.likeness(
        fingerprints.anchors(F.col("a")), fingerprints.anchors(F.col("b")))).first()[0]
    assert lead > 0.99


def test_fingerprints(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(fingerprints, "PIECE", 500)
    rows = fingerprints.fingerprint_documents(docs).collect()
    ordered = sorted(((i, t or "") for i, t in TEXTS))
    want = []
    for at, (i, t) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[:len(t) - half] + following[:half]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(want)
    by = {r.doc_id: r for r in rows}
    assert by[0].fingerprint == by[1].fingerprint != by[10].fingerprint and by[0].near_next == 1.0
    assert by[3].fingerprint == by[4].fingerprint == ""
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    edited = {i: t[:len(t) - len(t) // 2] + ordered[(at + 1) % len(ordered)][1][:len(t) // 2]
              for at, (i, t) in enumerate(ordered)}
    again = spark.createDataFrame(list(edited.items()), "i long, t string").select(
        "i", fingerprints.or_whole(fingerprints.anchors(F.col("t")), F.col("t")).alias("a")).select(
        "i", "a", fingerprints.printed(F.col("a")).alias("f")).collect()
    assert {r.i: r.f for r in again} == {i: r.edited_fingerprint for i, r in by.items()}
    theirs = {r.i: r.a for r in again}
    table = spark.createDataFrame(ordered, "i long, t string")
    own = {(r.i, r.t): r.a for r in table.select("i", "t", fingerprints.or_whole(
        fingerprints.anchors(F.col("t")), F.col("t")).alias("a")).collect()}
    for at, (i, t) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)]
        assert abs(by[i].near_edited - plain_likeness(own[i, t], theirs[i], in_place=True)) < 1e-12
        assert abs(by[i].near_next - plain_likeness(own[i, t], own[following])) < 1e-12 or i == 12
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_anchors_are_closed_syncmers(spark):
    text = prose(9, 120) + " 𐐀é"
    k, s = fingerprints.K, fingerprints.S
    inner = [tuple(text[i:i + s]) for i in range(len(text) - s + 1)]
    table = spark.createDataFrame([(i, *c) for i, c in enumerate(inner)], "i int, a string, b string, c string, d string")
    h = {r.i: r.h for r in table.select("i", F.hash("a", "b", "c", "d").alias("h")).collect()}
    want = [i for i in range(len(text) - k + 1)
            if min(h[i], h[i + k - s]) <= min(h[j] for j in range(i, i + k - s + 1))]
    got = spark.createDataFrame([(text,)], "t string").select(fingerprints.anchors(F.col("t")).alias("a")).first().a
    assert [a >> 32 for a in got] == want and len(want) > 50


def test_licenses(spark, docs, empty):
    texts = [(1, "Some words.\nReleased under the MIT License.\nmore"), (2, prose(1, 50)), (3, None), (4, ""),
             (5, "this project is licensed under the apache license, version 2.0. see the file"),
             (6, "This work is licensed under the GNU General Public License, version 3."), (7, "Licensed under CC BY-NC 4.0."),
             (8, "All software is distributed on a driving license."), (8, "MIT license plates")]
    rows = licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {r.doc_id: r.families for r in rows}
    assert len(rows) == len(texts)
    assert got == {1: "mit", 2: "", 3: "", 4: "", 5: "apache-2.0", 6: "gpl", 7: "cc-by-nc", 8: ""}
    assert licenses.scan_licenses(docs).count() == len(TEXTS)
    assert licenses.scan_licenses(empty).count() == 0
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


WRAPPED = {
    "mit": """// Permission is hereby granted, free of charge, to any
// person obtaining a copy of this software and associated
// documentation files (the "Software"), to deal in the
// Software without restriction, including without limitation""",
    "gpl": """ * This program is free software: you can redistribute it and/or
 * modify it under the terms of the GNU General Public License as
 * published by the Free Software Foundation, either version 3 of
 * the License, or (at your option) any later version.""",
    "apache-2.0": """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the
# License. You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0""",
}


def plain_passages(text):
    """(paragraph, whole, passage, words) of a text, by loops."""
    lines = [line if re.search(r"[^\W_]", line) else "" for line in (text or "").split("\n")]
    for k, par in enumerate(re.split(r"\n\n+", "\n".join(lines))):
        words = licenses.words_of(par)
        for i, line in enumerate(par.split("\n")):
            yield k, False, i, licenses.words_of(line)
        if "\n" in par or len(words) > licenses.WINDOW:
            for i, at in enumerate(range(0, max(1, len(words) - licenses.WINDOW // 2), licenses.WINDOW // 2)):
                yield k, True, i, words[at:at + licenses.WINDOW]


def plain_findings(text, model):
    known = {g for own in model.weights.values() for g in own}
    templates = {f: [licenses.grams_of(licenses.words_of(t)) for t in ts] for f, ts in licenses.TEMPLATES.items()}
    known = known.union(*(t for ts in templates.values() for t in ts))
    found = {}
    for k, whole, _, words in plain_passages(text):
        grams = licenses.grams_of(words)
        if grams & known:
            family = max(sorted(model.weights, reverse=True), key=lambda f: (model.margin(words, f), f))
            p = licenses._sigmoid(model.scale[0] * model.margin(words, family) + model.scale[1])
            share = max(len(grams & t) / len(t) for t in templates[family])
            found.setdefault(k, []).append((whole, family, p, p >= 0.5 and share >= 0.7))
    families, n_confirmed, n_unknown = set(), 0, 0
    for rows in found.values():
        own = {f for whole, f, _, ok in rows if ok and not whole}
        wrapped = {f for whole, f, _, ok in rows if ok and whole} - own
        families |= own | wrapped
        n_confirmed += sum(ok and not whole for whole, _, _, ok in rows) + len(wrapped)
        n_unknown += 0 if wrapped else sum(not ok and not whole for whole, _, _, ok in rows)
    best = max((p for rows in found.values() for _, _, p, _ in rows), default=None)
    return ",".join(sorted(families)), n_confirmed, n_unknown, best


def license_rows():
    long = " ".join(prose(40, 30_000).split("\n"))
    notice = WRAPPED["gpl"].replace("\n", " ")
    texts = [(k, w) for k, w in enumerate(WRAPPED.values())]
    texts += [(10, prose(2, 40) + "\n\n" + WRAPPED["mit"] + "\n//\n" + prose(3, 40)),
              (11, prose(2, 40) + "\r\n\r\n" + WRAPPED["gpl"].replace("\n", "\r\n")),
              (12, long + " " + notice + " " + long), (13, "\n".join([WRAPPED["mit"], prose(5, 300), "Licensed under CC BY 4.0."])),
              (14, "Released under the MIT License.\nLicensed under CC BY-SA 4.0."),
              (None, "Released under the MIT License."), (None, prose(6, 30)), (None, None),
              (15, "Licensed under CC BY 4.0."), (15, prose(7, 20)), (15, "Licensed under CC BY 4.0."),
              (16, "the license of software is distributed\nsoftware foundation\n" * 3), (17, "\n" * 50_000), (18, "")]
    texts += [(100 + i, prose(i, 60) + f"\nsoftware {prose(i, 3)} commons {i} was permitted in the restriction {i}")
              for i in range(60)]
    return texts


def test_licenses_equal_a_plain_version(spark):
    texts = license_rows()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    passages = licenses.speaking_passages(docs).cache()
    model = licenses.fit(licenses.ordinary_paragraphs(docs, passages, 400))
    assert all(set(r.grams) == licenses.grams_of(r.words) for r in passages.collect())
    got = Counter((r.doc_id, r.families, r.n_confirmed, r.n_unknown, r.best_probability and round(r.best_probability, 9))
                  for r in licenses.scan_licenses(docs).collect())
    want = Counter()
    for doc_id, text in texts:
        *rest, best = plain_findings(text, model)
        want[(doc_id, *rest, best and round(best, 9))] += 1
    assert got == want
    families = {}
    for (doc_id, found, *_), n in got.items():
        families.setdefault(doc_id, []).extend([found] * n)
    assert [families[k] for k in range(3)] == [[f] for f in WRAPPED]
    assert (families[10], families[11], families[12]) == (["mit"], ["gpl"], ["gpl"])
    assert families[13] == ["cc-by,mit"] and families[14] == ["cc-by-sa,mit"]
    assert sorted(families[None]) == ["", "", "mit"] and sorted(families[15]) == ["", "cc-by", "cc-by"]
    assert not any(f for k in [16, 17, 18, *range(100, 160)] for f in families[k])


def test_license_windows_hold_every_template_and_the_sample_is_bounded(spark):
    assert all(2 * len(licenses.words_of(t)) <= licenses.WINDOW for ts in licenses.TEMPLATES.values() for t in ts)
    rows = [(i, f"software {prose(i, 200)}\nother {prose(i, 4)} license") for i in range(400)] + [(7, "software")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    found = licenses.ordinary_paragraphs(docs, licenses.speaking_passages(docs), 20)
    assert 20 < len(found) <= 40 and all(len(words) <= licenses.WINDOW for words in found)
    assert any("license" in words for words in found)


def labelled(spark):
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 9 == 0
        words = prose(i, 80).split()
        if toxic:
            words[5:5] = random.Random(i).sample(["grobian", "idiot", "stupid", "worthless", "moron"], 2)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")


def test_toxicity_training_keeps_its_sample_as_arrays(spark):
    """The driver holds some 30 bytes for each word of a sample's texts, no Python object."""
    texts = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(1), F.lit(1000)), lambda k: F.translate(F.xxhash64("id", k).cast("string"), "0123456789-", "abcdefghijk"))).alias("text"))
    labels = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    toxicity.train(texts.limit(5), labels)
    tracemalloc.start()
    try:
        toxicity.train(texts, labels)
        assert tracemalloc.get_traced_memory()[1] < 30 * 2000 * 1000
    finally:
        tracemalloc.stop()


def test_toxicity(spark, docs, empty):
    texts, labels = labelled(spark)
    # Trained on the even ids, held against the odd ones.
    got = toxicity.score_toxicity(texts, labels.where("doc_id % 2 = 0")).where("doc_id % 2 = 1").collect()
    wrong = [r for r in got if r.toxic != (r.doc_id % 9 == 0)]
    assert not [r for r in wrong if r.toxic] and len(wrong) <= 4
    none = labels.where("false")
    assert toxicity.score_toxicity(docs, none).where("toxic").count() == 0
    assert toxicity.score_toxicity(docs, labels).count() == len(TEXTS)
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_quality(spark, docs, empty):
    rows = []
    for i in range(1200):
        text = prose(i, 90)
        spoil = (None, None, None, None, None, None, lambda t: t.upper().replace(" ", "!! "), lambda t: " ".join(w + "$$$" for w in t.split()),
                 lambda t: (t.split()[0] + " ") * 90)[i % 9]
        rows.append((i, (spoil or str)(text)))
    got = quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wrong = [r.doc_id for r in got if r.kept != (r.doc_id % 9 < 6)]
    assert len(wrong) <= 12
    assert quality.score_quality(docs).count() == len(TEXTS)
    assert quality.score_quality(empty).count() == 0


def test_label_model_finds_the_better_labeller():
    draw = np.random.default_rng(3)
    truth = draw.random(5000) < 0.7
    flips = [0.05, 0.1, 0.4]
    votes = np.stack([np.where(draw.random(5000) < f, ~truth, truth) for f in flips], 1).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    right = [(model.rates[k, 1, 1] + model.rates[k, 0, 0]) / 2 for k in range(3)]
    assert right == sorted(right, reverse=True) and abs(right[0] - 0.95) < 0.03 and abs(model.good - 0.7) < 0.03


def test_vectors(spark):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((600, 32))
    x[100:200] = x[0] + 0.15 * draw.standard_normal((100, 32))
    x[300] = x[301] * 3
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [
        (900, None, 1), (901, [0.0] * 32, 1), (902, [math.nan] * 32, 1), (903, [None] + [1.0] * 31, 1), (904, [], 1),
        (None, x[0].tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, unit int")
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(table).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    assert len(got) == len(rows)
    assert [got[i].n_links for i in range(600)] == link.sum(1).tolist()
    assert all(got[i].component_id == 0 for i in range(100, 200) if link[i].any())
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(900, 905))
    assert got[301].component_id == 300 and not got[301].kept
    assert embedding_dedup.link_vectors(table.where("false")).count() == 0


def plain_links(x):
    """Links at 0.9 and the least vector of each one's component."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        fresh = np.minimum(label, np.where(link, label, len(x)).min(1))
        if (fresh == label).all():
            return link.sum(1).tolist(), label.tolist()
        label = fresh


def vector_table(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_links_between_saturated_groups(spark):
    draw = np.random.default_rng(5)
    x = draw.standard_normal((300, 64))
    # Groups of 40 with cosines of about 0.98 inside, whose middles are at about 0.93.
    middle = draw.standard_normal(64)
    for at in (0, 40, 80):
        own = middle + 0.27 * draw.standard_normal(64)
        x[at:at + 40] = own + 0.14 * draw.standard_normal((40, 64))
    n_links, component = plain_links(x)
    assert min(n_links[:120]) > 40
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(vector_table(spark, x)).collect()}
    assert [got[i].n_links for i in range(300)] == n_links
    assert [got[i].component_id for i in range(300)] == component


def test_search_goes_on_while_links_are_missing(spark):
    draw = np.random.default_rng(6)
    x = draw.standard_normal((800, 64))
    x[400:] = x[:400] + 0.4 * draw.standard_normal((400, 64))
    n_links, component = plain_links(x)
    rows = embedding_dedup.link_vectors(vector_table(spark, x), k=2, tables=1, rounds=0).collect()
    got = {r.vec_id: r for r in rows}
    assert sum(r.n_links for r in rows) >= 0.98 * sum(n_links) and rows[0].recall >= 0.98
    assert sum(got[i].component_id == component[i] for i in range(800)) >= 780


def grouped_vectors(n, groups, size):
    """n vectors of which the first ones form groups, with cosines of about 0.93 inside."""
    draw = np.random.default_rng(7)
    x = draw.standard_normal((n, 64))
    for at in range(0, groups * size, size):
        x[at:at + size] = draw.standard_normal(64) + 0.27 * draw.standard_normal((size, 64))
    return x


def test_links_come_from_the_search_and_the_audit_adds_none(spark):
    x = grouped_vectors(1500, 60, 12)
    n_links, component = plain_links(x)
    rows = embedding_dedup.link_vectors(vector_table(spark, x), audited=50).collect()
    got = {r.vec_id: r for r in rows}
    assert all(got[i].n_links <= n_links[i] for i in range(1500))
    assert sum(r.n_links for r in rows) >= 0.98 * sum(n_links) > 0 and rows[0].recall >= 0.98
    assert sum(got[i].component_id == component[i] for i in range(1500)) >= 1490


def test_nothing_is_linked_and_no_recall_claimed_if_the_search_finds_nothing(spark, monkeypatch):
    def nothing(batches, reach):
        for _ in batches:
            yield embedding_dedup._edges([], [], [])

    monkeypatch.setattr(embedding_dedup, "neighbours_in_order", nothing)
    rows = embedding_dedup.link_vectors(vector_table(spark, grouped_vectors(80, 4, 12)), k=25).collect()
    assert {(r.n_links, r.kept, r.recall) for r in rows} == {(0, True, 0.0)}


def test_saturated_lists_grow(spark, monkeypatch):
    """Groups larger than a list, but not than a grown one, need no blocks."""
    def no_blocks(full, groups, units, threshold, k):
        assert full.isEmpty()
        return units.sparkSession.createDataFrame([], "id bigint, weight bigint, label bigint")

    monkeypatch.setattr(embedding_dedup, "link_saturated", no_blocks)
    x = grouped_vectors(400, 6, 30)
    n_links, component = plain_links(x)
    assert max(n_links) > 20
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(vector_table(spark, x)).collect()}
    assert [got[i].n_links for i in range(400)] == n_links
    assert [got[i].component_id for i in range(400)] == component


def test_small_tables_take_few_files_whatever_the_shuffle(spark, monkeypatch):
    """Each round's tables are dealt out by their rows: a file costs the executor a process that it starts."""
    files = {}

    def counted(df, name, plain=embedding_dedup.written):
        table = plain(df, name)
        files[name] = max(files.get(name, 0), len(table.inputFiles()))
        return table

    for module in (embedding_dedup, components_module):
        monkeypatch.setattr(module, "written", counted)
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    x = grouped_vectors(300, 6, 15)
    n_links, component = plain_links(x)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = embedding_dedup.link_vectors(vector_table(spark, x))
        got = {r.vec_id: r for r in found.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert [got[i].n_links for i in range(300)] == n_links
    assert [got[i].component_id for i in range(300)] == component
    assert files["neighbour-lists"] == files["neighbour-pairs"] == files["distinct-vectors"] == 1
    del files["unit-vectors"]
    assert max(files.values()) <= 2, files


def test_secrets_inside_runs(spark):
    draw = random.Random(18)
    some = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    before = ("AWS_SECRET_ACCESS_KEY=", "/v1/sk_live_", "SIGNATURE=", "a-b/")
    texts, want = [], {}
    for i in range(2000):
        text = prose(i, 200)
        if i % 20 == 0:
            key = "".join(draw.choice(some) for _ in range(48))
            text += " " + before[i // 20 % 4] + key
            want[i] = (len(text) - 48, len(text))
        texts.append((i, text))
    rows = secret_scan.scan_secrets(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {r.doc_id: {(s.start, s.stop) for s in r.spans if s.kind == "random"} for r in rows}
    for k in range(4):
        own = [i for i in want if i // 20 % 4 == k]
        assert sum(want[i] in got[i] for i in own) >= 0.8 * len(own)


def test_ordinary_text_counts_whole(spark):
    text = prose(21, 900) + " Aa9 " + prose(22, 30).upper()
    letters = secret_scan.ordinary_letters(text).tobytes().decode()
    want = defaultdict(int)
    for c, n in enumerate(secret_scan.LENGTHS):
        for at in range(0, len(letters) - n + 1, n):
            _, values, size = secret_scan.infer_encoding(letters[at:at + n])
            want[c, secret_scan.step_of(secret_scan.battery(values, size))] += 1
    got = {divmod(v >> 32, secret_scan.STEPS + 1): v & 0xffffffff
           for v in secret_scan.ordinary_column(["", text]).to_pylist()[1]}
    assert got == want
    # Few documents, much text: there is enough to compare with.
    draw = random.Random(23)
    keys = ["".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(48))
            for _ in range(20)]
    rows = [(i, f"{prose(i, 6000)} {keys[i]}") for i in range(20)]
    found = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(any(s.kind == "random" for s in r.spans) for r in found) >= 15
