import uuid
from dataclasses import replace

import pytest
from helpers import CFG, P1, days, dense, inputs, values
from pyspark.sql import functions as F

from demandloom import schemas
from demandloom.durable import checkpoint_dir, durable
from demandloom.models import plugin, roster
from demandloom.operators import series
from demandloom.plans import workflow
from demandloom.sources.tables import TableSpec, read_table, replace_partitions

SMALL = {
    **roster.DEFAULT_ROSTER,
    "RandomForest": {"model": "random_forest", "params": {"trees": 3, "depth": 3}},
    "Picky": {"model": "picky_workflow", "params": {}},
}


@pytest.fixture
def cfg(spark, tmp_path):
    carry_on = plugin.last_value

    def picky(pdf, steps):
        if len(pdf) < 20:
            raise ValueError("too short")
        return carry_on(pdf, steps)

    plugin.register_model("picky_workflow", picky)
    (tmp_path / "geo.csv").write_text(
        "country,s_zipcode,e_zipcode,city\nB,0,10,North\nB,10,20,South\nM,0,50,Mid\n"
    )
    lines = ["country,product_id,date,zipcode,sales"]
    for i, d in enumerate(days("2024-07-04", 35)):
        lines.append(f"B,long,{d},{i % 10},{3 + i % 7}")
        lines.append(f"M,mid,{d},{i},{i % 3}.0")
    for i, d in enumerate(days("2024-07-25", 14)):
        lines.append(f"B,short,{d},12,{i}")
    for d in days("2024-08-05", 3):
        lines.append(f"B,new,{d},12.0,4")
    lines += ["B,long,2024-08-01,1,xfffx", "C,long,2024-08-01,1,7", "B,long,2024-08-01,,7"]
    (tmp_path / "product_sales.csv").write_text("\n".join(lines) + "\n")
    name = f"wf_{uuid.uuid4().hex[:8]}"
    yield replace(CFG, dir=str(tmp_path), database=name, models=SMALL, cities=("North", "South"))
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_workflow_end_to_end(spark, cfg):
    output = workflow.run_workflow(spark, cfg)
    tables = {name: read_table(spark, cfg.database, name) for name in schemas.TABLES}

    assert tables["sales"].count() == 35 * 2 + 14 + 3 + 3 and tables["geo"].count() == 2
    assert {c for (c,) in values(tables["input"].select("city").distinct())} == {"North", "South"}
    # gapless from the first day seen to the day before execution
    lengths = {p: n for p, n in values(tables["split"].groupBy("product_id").count())}
    assert lengths == {"long": 35, "short": 14, "new": 3}
    assert tables["split"].filter("split = 'test'").count() == 7 + 7 + 3

    on_test = tables["forecast_on_test"]
    assert values(on_test.filter("product_id = 'long'").groupBy("model").count()) == sorted(
        (label, 7) for label in SMALL
    )
    # no training days: no test forecast, no metric, no champion, so the fallback
    assert on_test.filter("product_id = 'new'").count() == 0
    metrics = tables["metrics"]
    assert metrics.filter("value < 0").count() == 0
    assert values(tables["best_models"].groupBy("product_id").count()) == [("long", 1), ("short", 1)]
    joined = metrics.filter("metric = 'mae'").groupBy("product_id").agg(F.min("value").alias("value"))
    assert values(tables["best_models"], "product_id", "value") == values(joined)
    assert tables["forecast"].count() == 2 * 9
    errors = values(tables["model_errors"], "model", "product_id", "error")
    assert errors == [(("Picky"), p, "ValueError: too short") for p in ("new", "short")]

    assert output.count() == 3 * 3
    assert values(output.filter("product_id = 'new'"), "sales") == [(4.0,)] * 3
    assert output.filter("sales < 0").count() == 0
    log = tables["run_log"]
    assert log.filter("metric = 'mae' and value is not null").count() == 1
    assert log.count() == 6


def test_one_model_replaces_only_its_partition(spark, cfg):
    workflow.run_workflow(spark, replace(cfg, models=roster.DEFAULT_ROSTER))
    before = values(read_table(spark, cfg.database, "all_models_forecast").filter("model != 'NaiveMean'"))
    errors = [("Picky", "B1", P1, "old"), ("NaiveMean", "B1", P1, "old")]
    old = spark.createDataFrame(errors, schemas.MODEL_ERRORS)
    replace_partitions(old, cfg.database, TableSpec.of("model_errors"), ["Picky", "NaiveMean"])
    changed = {**roster.DEFAULT_ROSTER, "NaiveMean": {"model": "croston", "params": {}}}
    workflow.build_forecasts(spark, replace(cfg, models=changed), labels=["NaiveMean"])
    assert values(read_table(spark, cfg.database, "model_errors"), "model") == [("Picky",)]
    table = read_table(spark, cfg.database, "all_models_forecast")
    assert values(table.filter("model != 'NaiveMean'")) == before
    columns = ("product_id", "date", "sales")
    assert values(table.filter("model = 'NaiveMean'"), *columns) == values(
        table.filter("model = 'Croston'"), *columns
    )


def test_published_demand_equals_the_tables(spark, cfg):
    cfg = replace(cfg, models=roster.DEFAULT_ROSTER)
    output = workflow.run_workflow(spark, cfg)
    direct = workflow.published_demand(read_table(spark, cfg.database, "input"), cfg)
    columns = ("city", "product_id", "date", "sales")
    assert values(direct, *columns) == values(output, *columns)


def test_test_rows_are_the_test_part_of_the_split(spark):
    split = series.prepare_series(inputs(spark, dense("2024-07-04", 35) + dense("2024-08-05", 3, city="n")), CFG)
    rows = workflow.test_rows(series.series_arrays(split, CFG), CFG)
    assert values(rows) == values(split.filter("split = 'test'").drop("split"))


def test_durable_cuts_the_lineage(spark):
    df = durable(inputs(spark, [("c", P1, days("2024-08-01", 1)[0], 1.0)]).selectExpr("sales + 1 AS x"))
    assert values(df) == [(2.0,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("ExistingRDD" if checkpoint_dir(spark) else "InMemory") in plan


def test_retired_and_silent_models_are_not_chosen(spark, cfg):
    def silent(pdf, steps):
        raise ValueError("nothing today")

    two = {label: roster.DEFAULT_ROSTER[label] for label in ("NaiveMean", "Croston")}
    workflow.run_workflow(spark, replace(cfg, models=two))
    plugin.register_model("silent", silent)
    models = {"NaiveMean": two["NaiveMean"], "Croston": {"model": "silent"}}
    for kept in (models, {"NaiveMean": two["NaiveMean"]}):
        workflow.build_forecasts(spark, replace(cfg, models=kept))
        workflow.build_evaluation(spark, replace(cfg, models=kept))
        for table in ("best_models", "forecast_on_test", "all_models_forecast"):
            found = read_table(spark, cfg.database, table).select("model").distinct()
            assert values(found) == [("NaiveMean",)], table
