"""The pipeline: each stage's decisions take effect, and clean documents come through."""

from __future__ import annotations

import corpus_pipeline
import pytest

from tests.llm.test_operators import prose
from tidemark.llm.common import written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF_DIR), name))
    return docs


def test_columns_and_kept_rows(steps):
    for before, after in zip(steps[:4], steps[1:5], strict=True):
        assert before.columns == after.columns
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
    assert steps[4].count() == steps[3].count()
    assert {r[0] for r in steps[5].select("doc_id").distinct().collect()} == {
        r[0] for r in steps[4].select("doc_id").collect()}


COLUMNS = ("doc_id long, text string, n_chars long, rejected_id int, found_id string, found_spans int, repeated_id int, "
           "toxic int, kept string, component_id long, spans string, n long")
REST = (1, "f", 2, 3, 4, "k", 5, "s", 6)


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, *REST) for r in rows], COLUMNS).repartition(3)


def test_near_copies_and_secrets(spark):
    base = prose(1, 200)
    near = base.replace(base.split()[100], "other", 1)
    key = "0123456789abcdef0123456789abcdef"
    rows = [(1, base, None), (2, near, None), (2, near, None), (3, f"é token = '{key}' end", 7), (4, None, 0), (4, None, 0),
            (None, base, 0), (None, prose(2, 90), 0), (None, f"{prose(3, 50)} token={key}", 1), (None, "", 0), (5, prose(4, 80), 0),
            (5, prose(5, 80), 0), (6, prose(6, 80), 0), (6, prose(6, 80), 0)]
    docs = rows_of(spark, rows)
    single = written(corpus_pipeline.drop_near_copies(spark, docs, ""), "t1")
    assert single.columns == docs.columns
    left = [(r.doc_id, r.text) for r in single.collect()]
    assert sum(t in (base, near) for _, t in left) == 1
    rest = sorted((str(i), t or "") for i, t in left if t not in (base, near))
    assert rest == sorted([(str(i), t or "") for i, t, _ in rows if t not in (base, near)][:-1])
    clean = corpus_pipeline.redact_secrets(spark, single, "")
    assert clean.columns == docs.columns and clean.count() == len(left)
    texts = {(r.doc_id, r.text): r.n_chars for r in clean.collect()}
    assert texts[3, "é [SECRET]' end"] == len("é [SECRET]' end")
    assert (None, f"{prose(3, 50)} [SECRET]") in texts and (4, None) in texts


def test_stages_keep_rows_of_every_kind(spark, tmp_path):
    """Null ids and texts, repeated rows, clashing names, a very long text and an empty table, stage by stage."""
    spark.createDataFrame([(i, 1, 0) for i in range(10, 14)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    long = " ".join(prose(30 + i % 7, 4000) for i in range(40))
    rows = [(10, prose(1, 100), 0), (11, prose(2, 100), 0), (None, prose(3, 100), 0), (None, None, 0), (11, prose(2, 100), 0),
            (12, long, len(long)), (13, "", 0)]
    docs = rows_of(spark, rows)
    assert len(long) > 900_000
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, str(tmp_path)), name)
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
        if name != "packing":
            assert out.columns == docs.columns
        if name == "toxicity":
            assert out.count() == 7
        if name == "near_copies":
            assert out.count() == 6
        if name == "secrets":
            assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
        if name == "packing":
            assert out.where("doc_id = 12").agg({"length": "sum"}).first()[0] > 200_000


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF_DIR).count() == steps[5].count()
