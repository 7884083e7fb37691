"""The pipeline's stages against what they promise, and the queries against SQL."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

import corpus_pipeline as P
from tests.llm.odd_tables import frame, odd_rows  # noqa: F401
from tests.llm.test_operators import brute_components
from thermograph.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in P.STAGES:
        docs.append(P.written(spark, stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def _ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality_stage_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    long = {r.doc_id for r in stages[0].collect() if len(r.text.split()) >= 50}
    left = _ids(stages[1])
    assert all(d in left for d, q in labels.items() if q == 1 and d in long)
    assert not any(d in left for d, q in labels.items() if q == 0)


def test_lines_stay_once(stages):
    seen: dict[str, int] = {}
    for r in stages[2].collect():
        for line in {x for x in r.text.split("\n") if len(x.split()) >= 20}:
            assert seen.setdefault(line, r.doc_id) == r.doc_id
    assert {r.text for r in stages[2].collect()} != {r.text for r in stages[1].collect()}


def test_one_document_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert _ids(stages[3]) == {c for _, _, c in brute_components(before)}


def test_no_benchmark_item_stays(spark, stages):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in " ".join(r.text.lower().split()) for r in stages[4].collect() for i in items)
    assert stages[4].count() >= 0.5 * stages[3].count()


def test_tokens_decode_to_the_texts(stages):
    want = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in stages[4].collect()}
    assert {r.doc_id: r.decoded_sha256 for r in stages[5].collect()} == want


def test_odd_and_empty_tables(spark, odd_rows):
    for docs in (frame(spark, odd_rows), frame(spark, odd_rows).limit(0)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.count()
        assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    a = want[cols].sort_values(cols).reset_index(drop=True)
    b = got[cols].sort_values(cols).reset_index(drop=True)
    # A column with nulls is floating in one engine's frame and not in the other's.
    assert a.convert_dtypes().equals(b.convert_dtypes())
