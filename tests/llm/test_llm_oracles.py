"""The queries that have SQL give its rows on the given tables; all others at least one row for each of their table's."""

import pytest

from colonnade.llm.queries import ORACLES, QUERIES
from workload.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, sf_dir, name):
    same, note = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    assert same, note


@pytest.mark.parametrize("name,table,key", [("op2_url_filter", "pages", "page_id"), *((n, "documents", "doc_id") for n in ("op4_mixing", "op7_quality_crf", "op8_pii", "op10_bpe"))])
def test_every_row_has_a_result(spark, sf_dir, name, table, key):
    got = QUERIES[name](spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    assert got.count() == rows.count() and got.select(key).exceptAll(rows).count() == 0
