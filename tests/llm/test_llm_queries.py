"""Registered queries against SQL, and the others' shapes, on the smallest tables."""

import pytest
from compare import difference, duck

from demandloom.llm.oracles import ORACLES
from demandloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    assert difference(QUERIES[name](spark, SF_DIR), sql, ORACLES[name]) is None


@pytest.mark.parametrize(
    ("name", "columns", "table"),
    [
        ("op6_toxicity", ["doc_id", "held_out", "score", "predicted"], "documents"),
        ("op7_entropy_mixing", ["doc_id", "size", "source_size", "target"], "documents"),
        ("op8_html_text", ["page_id", "url", "text", "n_chars"], "pages"),
    ],
)
def test_one_row_per_row_of_the_table(spark, name, columns, table):
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns[: len(columns)] == columns
    assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
