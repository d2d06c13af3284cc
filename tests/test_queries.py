"""Every registered query against its SQL, on the smallest generated tables."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as contract
import pytest
from compare import difference, duck
from helpers import values

from demandloom.models import roster

SF_DIR = "/root/testdata/sf0.001"
# the optional operators have tests of their own
QUERIES = {name: q for name, q in contract.queries().items() if name not in contract.LLM_QUERIES}
ORACLES = {name: q for name, q in contract.oracle_sql().items() if name not in contract.LLM_ORACLES}
# learners whose trees no SQL reproduces
LEARNED = {"forecast_random_forest", "forecast_gbt", "published_demand", "forecast_holt_winters_fitted", "forecast_changepoint_trend"}
# the forms over all models of queries whose closed forms have SQL
ALL_MODELS = {name.removesuffix("_closed_form") for name in ORACLES if name.endswith("_closed_form")} - set(ORACLES)
ROWS_ONLY = LEARNED | ALL_MODELS

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables not present")


@pytest.fixture(scope="module", autouse=True)
def few_trees():
    """The learners' rounds are tested elsewhere; here a few of them do."""
    params = [e["params"] for e in roster.FULL_ROSTER.values() if e["model"] in roster.POOLED]
    before = [dict(p) for p in params]
    for p in params:
        p |= {"trees": 3, "depth": 3}
    yield
    for p, old in zip(params, before):
        p.clear()
        p |= old


@pytest.fixture(scope="module")
def sql():
    return duck(SF_DIR)


def test_every_query_but_the_learners_has_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    assert difference(QUERIES[name](spark, SF_DIR), sql, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(LEARNED - {"published_demand", "forecast_holt_winters_fitted"}))
def test_learner_covers_every_series(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert found.count() == QUERIES["forecast_mean"](spark, SF_DIR).count()
    assert found.filter("sales is null or isnan(sales)").count() == 0


@pytest.mark.parametrize("name", sorted(ALL_MODELS - {"published_demand"}))
def test_all_models_give_the_columns_of_the_closed_forms(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns == QUERIES[f"{name}_closed_form"](spark, SF_DIR).columns
    assert not found.isEmpty()
    if name == "forecast_metrics":
        assert found.select("model").distinct().count() == 7


def test_without_the_optional_folders_the_rest_imports(tmp_path):
    root = os.path.dirname(os.path.abspath(contract.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "llm", "__pycache__")])
    told = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.LLM_QUERIES))"
    run = subprocess.run([sys.executable, "-c", told], cwd=copy, capture_output=True, text=True)
    assert run.stdout.split() == [str(len(QUERIES)), "False", "0"], run.stderr


def test_entry(spark):
    output = contract.entry(spark)
    assert output.columns == ["city", "product_id", "date", "sales"]
    assert len(values(output)) == 30 * 3


def test_no_data_in_the_repository():
    root = os.path.dirname(os.path.abspath(contract.__file__))
    listed = subprocess.run(["git", "ls-files"], cwd=root, capture_output=True, text=True)
    assert not [f for f in listed.stdout.split() if f.endswith((".parquet", ".csv"))]
