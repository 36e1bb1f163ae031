"""The registered queries against their SQL on the smallest tables, and the shape of those that must stay native."""

from __future__ import annotations

import pytest

from tests.check_oracle import duck, rows_of
from tidewater.llm.queries import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = queries()[name](spark, FOLDER)
    cursor = duck(FOLDER).execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["op3_url_filters", "op4_quality_rules"])
def test_native_plans_run_no_python(spark, name):
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


@pytest.mark.parametrize("name,columns", [
    ("op2_byte_bpe", "doc_id n_tokens ids_sha256 decoded_sha256"), ("op5_lm_scoring", "doc_id held_out n_tokens n_known train_tokens base_score score"),
    ("op7_packing", "doc_id start length ids_crc32 doc_tokens sequence_id offset"), ("op9_toxicity", "doc_id held_out score predicted"),
    ("op10_nearest_neighbours", "query_id rank vec_id score")])
def test_columns_of_the_contracts(spark, name, columns):
    got = queries()[name](spark, FOLDER)
    assert got.columns == columns.split() and got.count() > 0
