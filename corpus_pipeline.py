"""From raw documents to packed training sequences, stage by stage.

Each stage works on all that the one before it kept, and is written before the next one reads it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ngram_join, packing, quality, secret_scan, toxicity
from tidemark.llm.common import table, written

REDACTED = "[SECRET]"
# Up to so many rows of ids (and spans) are sent to every task; beyond it both sides are shuffled.
FEW = 500_000


def _sized(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= FEW else rows


def _key(docs: DataFrame) -> Column:
    """What a row is known by within a stage: a number from its id and text. Rows that share it are copies of one
    row as far as any stage can tell, and get the same decision."""
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows as the operators take them, with the key for an id: so no row lacks one."""
    return docs.select(_key(docs).alias("doc_id"), docs["text"])


def _own_name() -> str:
    """A column name that no table has."""
    return f"_{uuid.uuid4().hex}"


def _without(docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """docs but for the rows of these keys (column doc_id)."""
    own = _own_name()
    keys = written(keys.select(F.col("doc_id").alias(own)).distinct(), name)
    return docs.join(_sized(keys), _key(docs) == F.col(own), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier chain, trained on the labelled ones among docs, doesn't call toxic.

    Nulls: a row without a text is scored as an empty one, a row without an id is scored but trains nothing.
    Repeated rows get one decision. Long texts, empty tables and further columns as in ``toxicity``;
    all columns come through, whatever their names.
    """
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), rows=_keyed(docs))
    return _without(docs, scored.where("toxic"), "toxic-keys")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the quality scorer keeps. Nulls, repeated rows, long texts, empty tables and further
    columns as in ``drop_toxic``."""
    return _without(docs, quality.score_quality(_keyed(docs)).where(~F.col("kept")), "poor-keys")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, 0.8): the one of the least key.

    Rows without an id take part like others. Null, empty and blank texts are like nothing and stay, each of
    them. Of repeated rows (same id, same text) one stays, with the columns of any of them. Empty tables
    and columns of any name are fine.
    """
    linked = written(ngram_join.link_documents(_keyed(docs), width=5, percent=80), "copy-links")
    single = _without(docs, linked.where("component_id <> doc_id"), "copy-keys")
    own = _own_name()
    repeated = written(
        linked.where("n_shingles > 0 and component_id = doc_id").groupBy("doc_id").count().where("count > 1")
        .select(F.col("doc_id").alias(own)), "repeated-keys")
    if repeated.isEmpty():
        return single
    repeated, same = _sized(repeated), _key(single) == F.col(own)
    return single.join(repeated, same, "left_anti").union(
        single.join(repeated, same).dropDuplicates([own]).drop(own))


def _merged(spans: Column) -> Column:
    """Overlapping and touching spans joined; spans come in order of their starts."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        own = F.struct(s["start"].alias("start"), s["stop"].alias("stop"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        return F.when(last.isNotNull() & (last["stop"] >= s["start"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(own)))

    return F.aggregate(spans, empty, add)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with what was found replaced by a mark and n_chars, if there is one, brought up to date.

    Rows without an id are redacted like others, a null text stays null. Repeated rows are redacted each.
    Empty tables and columns of any name are fine.
    """
    key, spans = _own_name(), _own_name()
    found = written(
        secret_scan.scan_secrets(_keyed(docs)).where(F.size("spans") > 0)
        .select(F.col("doc_id").alias(key), _merged(F.col("spans")).alias(spans)).dropDuplicates([key]), "found-spans")
    joined = docs.join(_sized(found), _key(docs) == F.col(key), "left")
    # From the last span to the first, so that places before it stay right.
    clean = F.aggregate(F.reverse(spans), docs["text"], lambda text, s: F.concat(
        F.substring(text, F.lit(1), s["start"]), F.lit(REDACTED),
        F.substring(text, s["stop"] + 1, F.length(text))))
    text = F.when(F.col(key).isNotNull(), clean).otherwise(docs["text"])
    changed = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(key).isNotNull(), F.length(clean).cast("bigint")).otherwise(
            docs["n_chars"]).alias("n_chars")
    return joined.select(*(changed.get(c, docs[c]) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row in their sequences, by doc_id; see ``packing`` for nulls, empty tables and the rest."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# The first stages train models and the last calls a tokenizer, which SQL cannot express: the tests
# hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
