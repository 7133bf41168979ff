"""Secrets in text: fixed patterns, and a battery of randomness tests with false-discovery control.

Any long run of token characters is a candidate, cut at inner "="; if no alphabet holds all of a part
it is cut at "/", "_" and "-" too. A candidate's encoding is inferred from the characters it
uses; three tests then ask whether its symbols could be uniform draws from that alphabet: chi-squared
uniformity, runs above and below the middle, and serial correlation. Ordinary text fails the tests,
but short text fails them less reliably, so the evidence is judged per class of length: stretches
of ordinary text (the whole document's letters and digits without what lies between, cut one after
the other for every class) are scored the same way, a candidate's p-value is the share of ordinary stretches that look at least as random, and
Benjamini-Hochberg bounds the false discoveries among the candidates of the class. Both counts are
over all documents; the ordinary text of equal documents counts once.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import releasing, texts, written

# Fixed patterns of the contract. ASCII letters only, in either case.
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED, MIN_ACCESS = 6, 20

TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 20
LONG_RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
# Trailing padding belongs to its part; a separator belongs to none.
_ASSIGNED = re.compile(r"[^=]+(?:=+\Z)?")
_PART = re.compile(r"[^=/_-]+(?:=+\Z)?")
_BLANKED = bytes(b if chr(b) in TOKEN else 32 for b in range(256))
_WORDY = re.compile(r"[A-Za-z0-9]+")

# Inferred encodings, smallest alphabet first: name, symbols in value order.
ALPHABETS = [
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
_CODES = []
for _name, _symbols in ALPHABETS:
    _codes = np.full(128, -1, np.int16)
    _codes[[ord(c) for c in _symbols]] = np.arange(len(_symbols))
    _CODES.append((_name, len(_symbols), _codes))

# Classes of length: a candidate belongs to the last one that it reaches.
LENGTHS = (20, 24, 28, 32, 40, 48, 64, 96)
# Randomness is kept in steps, so that counts per class and step are a small table.
STEPS = 400

FOUND = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
         "base array<struct<kind:string,start:int,stop:int>>, "
         "runs array<struct<start:int,stop:int,encoding:string,length_class:int,step:int>>, "
         "text_digest binary, plain array<bigint>")
_FITS = sum(((codes >= 0).astype(np.int16) << a) for a, (_, _, codes) in enumerate(_CODES))
# Stretches scored at a time, and letters held for it.
ROWS, HELD = 8192, 1 << 20


def infer_encoding(run: str) -> tuple[str, np.ndarray, int] | None:
    """Name, symbol values and alphabet size of the smallest alphabet that holds the run; padding is
    left out. None if no alphabet does."""
    raw = np.frombuffer(run.rstrip("=").encode("ascii"), np.uint8)
    for name, size, codes in _CODES:
        values = codes[raw]
        if len(values) and values.min() >= 0:
            return name, values, size
    return None


def candidates(run: str, at: int) -> Iterator[tuple[int, int, tuple[str, np.ndarray, int]]]:
    """Start, stop and encoding of the parts of a run (which begins at ``at``) that are long enough to
    be tested."""
    for m in _ASSIGNED.finditer(run):
        known = infer_encoding(m.group())
        if known:
            found = [(m.start(), m.end(), known)]
        else:
            found = [(m.start() + p.start(), m.start() + p.end(), infer_encoding(p.group()))
                     for p in _PART.finditer(m.group())]
        for start, stop, known in found:
            if known and len(known[1]) >= MIN_RUN:
                yield at + start, at + stop, known


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(values: np.ndarray, size: int) -> float:
    """Fisher's combination of the three tests: the probability that uniform draws would look less
    uniform than these. Near 0 for text, anywhere in (0, 1] for random symbols."""
    n = len(values)
    counts = np.bincount(values, minlength=size)
    chi = float((counts.astype(float) ** 2).sum()) * size / n - n
    freedom = size - 1
    # Exact variance for small expectations; a too even run counts as well as a too uneven one.
    p_chi = _two_sided((chi - freedom) / math.sqrt(2 * freedom * (n - 1) / n)) if n > 1 else 1.0
    high = values >= size / 2
    above = int(high.sum())
    below = n - above
    p_runs = 1e-12
    if above and below:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * above * below / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    centred = values - (size - 1) / 2
    # Draws are centred on the alphabet's middle, so letters of one half show as correlation.
    serial = float((centred[1:] * centred[:-1]).sum()) / (math.sqrt(n - 1) * (size * size - 1) / 12)
    joint = 1.0
    for p in (p_chi, p_runs, _two_sided(serial)):
        joint *= max(p, 1e-12)
    half = -math.log(joint)
    return math.exp(-half) * (1 + half + half * half / 2)


def step_of(p: float) -> int:
    return min(STEPS, int(-20 * math.log10(max(p, 1e-30))))


def length_class(n: int) -> int:
    return max((i for i, least in enumerate(LENGTHS) if n >= least), default=-1)


def base_spans(text: str, long_run: bool) -> list[tuple[str, int, int]]:
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text)
                  if len(m.group(1)) >= MIN_ASSIGNED]
    if long_run:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
        spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    order = ("assign", "access", "hex")
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def _erfc(z: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, np.abs(z) / math.sqrt(2)), float, len(z))


def battery_rows(values: np.ndarray, size: int) -> np.ndarray:
    """battery() of each row, as steps."""
    rows, n = values.shape
    counts = np.bincount((values + np.arange(rows)[:, None] * size).ravel(), minlength=rows * size)
    chi = (counts.reshape(rows, size) ** 2).sum(1) * size / n - n
    p_chi = _erfc((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = values >= size / 2
    above = high.sum(1)
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    mean = 1 + 2 * above * (n - above) / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = np.where(spread > 0, _erfc((runs - mean) / np.sqrt(np.where(spread > 0, spread, 1.0))), 1.0)
    p_runs = np.where((above > 0) & (above < n), p_runs, 1e-12)
    centred = values - (size - 1) / 2
    serial = (centred[:, 1:] * centred[:, :-1]).sum(1) / (math.sqrt(n - 1) * (size * size - 1) / 12)
    joint = np.ones(rows)
    for p in (p_chi, p_runs, _erfc(serial)):
        joint *= np.maximum(p, 1e-12)
    half = -np.log(joint)
    p = np.exp(-half) * (1 + half + half * half / 2)
    return np.minimum(STEPS, (-20 * np.log10(np.maximum(p, 1e-30))).astype(np.int64))


def ordinary_letters(text: str) -> np.ndarray:
    # Tokens of an alphabet's full range would be secrets themselves, so words alone are taken.
    return np.frombuffer("".join(w for w in _WORDY.findall(text) if len(w) < MIN_RUN).encode("ascii"), np.uint8)


def ordinary_counts(letters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each text's letters, the counts of the steps of all its stretches: a list per text, given by
    its length and its values, (class * (STEPS + 1) + step) * 2 ** 32 + count."""
    width = len(LENGTHS) * (STEPS + 1)
    keys = []
    for c, want in enumerate(LENGTHS):
        own = np.array([len(x) // want for x in letters])
        stretches = np.concatenate([x[:k * want] for x, k in zip(letters, own, strict=True)]).reshape(-1, want)
        owner = np.repeat(np.arange(len(letters)), own)
        for at in range(0, len(stretches), ROWS):
            part, whose = stretches[at:at + ROWS], owner[at:at + ROWS]
            fits = np.bitwise_and.reduce(_FITS[part], axis=1)
            for a, (_, size, codes) in enumerate(_CODES):
                # The smallest alphabet is the lowest bit.
                chosen = (fits & -fits) == 1 << a
                if chosen.any():
                    step = battery_rows(codes[part[chosen]].astype(np.int64), size)
                    keys.append(whose[chosen] * width + c * (STEPS + 1) + step)
    found, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    return np.bincount(found // width, minlength=len(letters)), (found % width << 32) + n


def ordinary_column(texts: list[str]) -> pa.ListArray:
    sizes, values, held, total = [], [], [], 0
    for i, text in enumerate(texts):
        held.append(ordinary_letters(text))
        total += len(held[-1])
        if total >= HELD or i == len(texts) - 1:
            for out, more in zip((sizes, values), ordinary_counts(held), strict=True):
                out.append(more)
            held, total = [], 0
    offsets = np.concatenate([[0], *sizes]).cumsum().astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int64)))


def find_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                     ("stop", pa.int32())]))),
        ("runs", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()),
                                     ("encoding", pa.string()), ("length_class", pa.int32()),
                                     ("step", pa.int32())]))),
    ])
    for batch in batches:
        rows, own = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            pieces = text.encode("utf-8").translate(_BLANKED).split()
            long_run = max(map(len, pieces), default=0) >= MIN_RUN
            base = base_spans(text, long_run)
            runs = []
            for m in LONG_RUN.finditer(text) if long_run else ():
                for start, stop, known in candidates(m.group(), m.start()):
                    runs.append({
                        "start": start, "stop": stop, "encoding": known[0],
                        "length_class": length_class(len(known[1])),
                        "step": step_of(battery(known[1], known[2]))})
            kinds = [s[0] for s in base]
            rows.append({
                "doc_id": doc_id, "n_assign": kinds.count("assign"),
                "n_access": kinds.count("access"), "n_hex": kinds.count("hex"),
                "base": [{"kind": k, "start": a, "stop": b} for k, a, b in base],
                "runs": runs})
            own.append(text)
        spans = pa.RecordBatch.from_pylist(rows, schema=schema)
        digests = pa.array([hashlib.blake2b(t.encode("utf-8"), digest_size=16).digest() for t in own], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*spans.columns, digests, ordinary_column(own)], names=[*schema.names, "text_digest", "plain"])


def thresholds(found: DataFrame, rate: float) -> dict[int, int]:
    """Per class of length, the largest step (least random) at which Benjamini-Hochberg still rejects
    "ordinary text". The two count tables have a row per class and step, whatever the data."""
    def counted(rows: DataFrame) -> dict[int, np.ndarray]:
        out = {c: np.zeros(STEPS + 1, np.int64) for c in range(len(LENGTHS))}
        for c, step, n in rows.groupBy("length_class", "step").agg(F.sum("n")).collect():
            out[c][step] = n
        return out

    runs = counted(found.select(F.explode("runs").alias("x")).select("x.length_class", "x.step", F.lit(1).alias("n")))
    code = F.shiftright("x", 32).cast("int")
    plain = counted(found.where(F.size("plain") > 0).select("text_digest", "plain").dropDuplicates(["text_digest"])
                    .select(F.explode("plain").alias("x")).select(
        F.floor(code / (STEPS + 1)).cast("int").alias("length_class"), (code % (STEPS + 1)).alias("step"),
        F.col("x").bitwiseAND(F.lit((1 << 32) - 1)).alias("n")))
    cuts = {}
    for c in runs:
        # A low step is a high probability of uniform draws: both sums run from random to text.
        chance = (1 + plain[c].cumsum()) / (1 + plain[c].sum())
        picked = runs[c].cumsum()
        passed = np.flatnonzero((runs[c] > 0) & (chance * runs[c].sum() <= rate * picked))
        if len(passed):
            cuts[c] = int(passed[-1])
    return cuts


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                 s["stop"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """Every row of docs with its spans: doc_id, n_assign, n_access, n_hex, base and spans (arrays of
    kind, start, stop in code points).

    Spans of kind ``random`` are those that the battery adds, with expected share ``rate`` of false
    ones; a run that a fixed pattern covers already isn't added. Null text is empty. With few
    documents there is too little ordinary text to compare with, and nothing is added. Repeated rows
    are scanned each; columns other than doc_id and text are ignored; an empty table gives an empty
    result.
    """
    found = written(
        texts(docs)
        .mapInArrow(lambda batches: releasing(find_spans(batches)), FOUND),
        "secret-spans",
    )
    cuts = thresholds(found, rate)
    cut = F.array(*(F.lit(cuts.get(c, -1)) for c in range(len(LENGTHS))))
    random = F.transform(
        F.filter("runs", lambda r: (r["step"] <= F.get(cut, r["length_class"])) & ~F.exists(
            "base", lambda b: (b["start"] <= r["start"]) & (b["stop"] >= r["stop"]))),
        lambda r: F.struct(F.lit("random").alias("kind"), r["start"].alias("start"),
                           r["stop"].alias("stop")))
    rank = F.create_map(*(F.lit(x) for p in
                          (("assign", 0), ("access", 1), ("hex", 2), ("random", 3)) for x in p))
    ordered = F.transform(
        F.array_sort(F.transform(
            F.concat("base", random),
            lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"),
                               s["stop"].alias("stop"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                           s["stop"].alias("stop")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base", ordered.alias("spans"))


def digest_secrets(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"))
