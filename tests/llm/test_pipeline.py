"""The pipeline's stages on awkward rows, each against a brute-force version, and every registered query."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from tests.llm.helpers import brute_components, corpus, documents, jaccard_at_least, shingles
from tests.oracle_check import compare, duck
from velotide.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_stages_keep_the_columns_and_handle_awkward_rows(spark):
    docs = documents(spark, corpus(), clash=True)
    for name, stage in CP.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert not stage(spark, docs.limit(0), SF).collect()
    packed = CP.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_near_duplicate_stage_matches_brute_force(spark):
    rows = corpus(4)
    kept = CP.near_duplicates(spark, documents(spark, rows), SF).collect()
    sets = {i: shingles(t, 5) for i, t in rows if i is not None}
    comp = brute_components(sets, lambda a, b: jaccard_at_least(a, b, 80))
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i, c in comp.items() if i == c}
    assert sum(r.doc_id is None for r in kept) == sum(i is None for i, _ in rows)


def test_pipeline_places_every_piece_once(spark):
    out = CP.run(spark, "/root/testdata/sf0.001").cache()
    assert out.count() > 100
    assert out.groupBy("doc_id", "piece").count().filter("count > 1").isEmpty()
    bad = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert bad.filter("n > 2048 OR n <> end").isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], "/root/testdata/sf0.001", duck("/root/testdata/sf0.001"))
    assert r["ok"], r


def test_every_operator_has_its_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
