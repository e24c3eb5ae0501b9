"""The registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from docketlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    numbers = {int(k[2:].split("_")[0]) for k in QUERIES}
    assert numbers == set(range(1, 14)) and set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


def test_queries_give_a_row_per_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for key, run in QUERIES.items():
        rows = run(spark, SF).collect()
        assert len(rows) == n or key.startswith(("op1_", "op6_", "op11_")), key
        assert {"doc_id", "conv_id"} & set(rows[0].asDict())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_queries_with_sql(spark, key):
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    df, want = QUERIES[key](spark, SF), con.sql(ORACLES[key])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(repr, map(tuple, df.select(want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline_against_its_stages_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = set(docs.columns)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept.count(), stage(spark, kept, SF)
        assert set(kept.columns) == names and 0 < kept.count() <= before
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept.collect()}
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in rows)


def test_pipeline_stages_on_empty_and_null_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", "s", None), (7, "", "en", "s", 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        assert stage(spark, odd, SF).count() <= 3, name


def test_stages_judge_rows_by_their_own_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    one = " ".join(f"one{i} word{i * i}" for i in range(40))
    two = " ".join(f"two{i} other{i * 7}" for i in range(40))
    rows = [(5, one), (5, two), (6, None), (6, "a real text"), (None, two + " tail"), (None, "alone"), (7, one), (7, one)]
    odd = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], docs.schema)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, odd, SF).collect()]
    # A further text of an id gives way to a copy whose id names it alone.
    assert [t for _, t in kept].count(one) == 1 and {i for i, t in kept if t == one} <= {5, 7}
    assert set(kept) - {(5, one), (7, one)} == {(5, two), (6, None), (6, "a real text"), (None, "alone")} and len(kept) == 5
    rows = [(None, f"so {item} there"), (8, f"so {item} there"), (8, two), (None, two), (9, None)]
    odd = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], docs.schema)
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, odd, SF).collect()), key=str)
    assert kept == sorted([(8, two), (None, two), (9, None)], key=str)


def test_the_package_is_optional():
    assert os.path.exists(entry.__file__) and entry.QUERIES.keys() < entry.queries().keys()
