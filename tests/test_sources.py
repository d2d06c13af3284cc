import uuid
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pytest
from helpers import day, dense, inputs, values
from pyspark.sql import types as T

from demandloom import schemas
from demandloom.sources import files, tables


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    tables.create_database(spark, name)
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


SALES_CSV = """country,product_id,date,zipcode,sales
B,p,2024-08-01,86400000.0,1.0
B,p,2024-08-01,3121020,xfff
B,p,2024-08-07,,NaN
B,p,not a date,bad,9999
"""


def test_csv_is_read_as_text_and_cast_late(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(SALES_CSV)
    df = files.read_csv_cast(spark, str(path), schemas.SALES)
    assert dict(df.dtypes) == {f.name: f.dataType.simpleString() for f in schemas.SALES.fields}
    assert values(df, "date", "zipcode", "sales") == sorted(
        [
            (day("2024-08-01"), 86400000, "1.0"),
            (day("2024-08-01"), 3121020, "xfff"),
            (day("2024-08-07"), None, "NaN"),
            (None, None, "9999"),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_csv_base_path_and_separator(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "geo.csv").write_text("country;s_zipcode;e_zipcode;city\nB;1;5;X\n")
    monkeypatch.setenv(files.BASE_PATH_VARIABLE, str(tmp_path))
    df = files.read_csv_cast(spark, "in/geo.csv", schemas.GEO, sep=";")
    assert values(df) == [("B", 1, 5, "X")]


def test_csv_with_enforced_schema(spark, tmp_path):
    path = tmp_path / "geo.csv"
    path.write_text("country,s_zipcode,e_zipcode,city\nB,1,5,X\n")
    df = files.read_csv(spark, str(path), schemas.GEO)
    assert values(df) == [("B", 1, 5, "X")]


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("partitions", [(), ("city",)])
def test_table_round_trip(spark, database, tmp_path, external, partitions):
    spec = tables.TableSpec("t", schemas.INPUT, partitions, str(tmp_path / "table") if external else None)
    df = inputs(spark, dense("2024-07-09", 30))
    for _ in range(2):
        if partitions:
            tables.replace_partitions(df, database, spec, ["B1"])
        else:
            tables.replace_table(df, database, spec)
    found = tables.read_table(spark, database, "t").select(*schemas.INPUT.fieldNames())
    assert values(found) == values(df)
    info = tables.table_info(spark, database, "t")
    assert info["Type"] == ("EXTERNAL" if external else "MANAGED")
    assert info["sales"] == "double"


FORECAST = tables.TableSpec("f", schemas.FORECAST, ("model",))


def forecasts(spark, *rows):
    return spark.createDataFrame([(m, "c", p, day("2024-08-01"), v) for m, p, v in rows], schemas.FORECAST)


def test_only_named_partitions_are_replaced(spark, database):
    tables.replace_partitions(forecasts(spark, ("A", "p", 1.0), ("B", "p", 2.0)), database, FORECAST, ["A", "B"])
    tables.replace_partitions(forecasts(spark, ("A", "x", 5.0), ("B", "q", 9.0)), database, FORECAST, ["B"])
    found = tables.read_table(spark, database, "f")
    assert values(found, "model", "product_id", "sales") == [("A", "p", 1.0), ("B", "q", 9.0)]


def test_a_value_without_rows_leaves_nothing_behind(spark, database):
    tables.replace_partitions(forecasts(spark, ("A", "p", 1.0), ("B", "p", 2.0)), database, FORECAST, ["A", "B"])
    tables.replace_partitions(forecasts(spark, ("A", "p", 3.0)), database, FORECAST, ["A", "B"])
    assert values(tables.read_table(spark, database, "f"), "model", "sales") == [("A", 3.0)]
    tables.replace_partitions(forecasts(spark, ("C", "p", 4.0)), database, FORECAST, ["C"], drop_others=True)
    assert values(tables.read_table(spark, database, "f"), "model", "sales") == [("C", 4.0)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_writers_of_two_partitions_share_a_session(spark, database, mode):
    tables.create_table(spark, database, FORECAST)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        with ThreadPoolExecutor(2) as pool:
            list(
                pool.map(
                    lambda m: tables.replace_partitions(forecasts(spark, (m, "p", 1.0)), database, FORECAST, [m]),
                    ["A", "B"],
                )
            )
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert values(tables.read_table(spark, database, "f"), "model") == [("A",), ("B",)]


def test_overwriting_an_unpartitioned_table_replaces_it(spark, database):
    spec = tables.TableSpec("t", schemas.INPUT)
    for start, n in (("2024-07-01", 5), ("2024-08-01", 2)):
        tables.replace_table(inputs(spark, dense(start, n)), database, spec)
    assert tables.read_table(spark, database, "t").count() == 2


def test_all_tables_are_created_and_listed(spark, database):
    tables.create_tables(spark, database)
    tables.create_tables(spark, database)
    assert tables.list_tables(spark, database) == sorted(schemas.TABLES)
    partitions = {name: cols for name, (_, cols) in schemas.TABLES.items() if cols}
    assert set(partitions) == {"forecast_on_test", "all_models_forecast", "model_errors"}


def test_run_log_is_appended(spark, database):
    tables.append_run_log(spark, database, "one", {"a": 1})
    tables.append_run_log(spark, database, "two", {"b": day("2024-01-01")}, "mae", 0.5)
    log = tables.read_table(spark, database, "run_log")
    assert values(log, "stage", "params", "metric", "value") == [
        ("one", '{"a": 1}', None, None),
        ("two", '{"b": "2024-01-01"}', "mae", 0.5),
    ]


def test_local_frame_catalog_and_schema_helpers(spark, database):
    pdf = pd.DataFrame(dense("2024-08-01", 2), columns=schemas.INPUT.fieldNames())
    tables.write_local(pdf, spark, database, tables.TableSpec("t", schemas.INPUT))
    assert tables.read_table(spark, database, "t").count() == 2
    tables.use_catalog(spark, "spark_catalog")
    assert spark.catalog.currentCatalog() == "spark_catalog"


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, database):
    from pyspark.sql import functions as F

    old = forecasts(spark, ("A", "p", 1.0), ("B", "p", 2.0))
    tables.replace_partitions(old, database, FORECAST, ["A", "B"])
    before = values(tables.read_table(spark, database, "f"))
    bad = forecasts(spark, ("A", "x", 5.0), ("B", "x", 6.0)).withColumn(
        "sales", F.when(F.col("model") == "B", F.raise_error(F.lit("lost"))).otherwise(F.col("sales"))
    )
    with pytest.raises(Exception, match="lost"):
        tables.replace_partitions(bad, database, FORECAST, ["A", "B"])
    assert values(tables.read_table(spark, database, "f")) == before


def test_readers_that_have_begun_keep_their_rows(spark, database):
    tables.replace_partitions(forecasts(spark, ("A", "p", 1.0)), database, FORECAST, ["A"])
    begun = tables.read_table(spark, database, "f")
    begun.queryExecution = begun._jdf.queryExecution().executedPlan()
    tables.replace_partitions(forecasts(spark, ("A", "p", 2.0)), database, FORECAST, ["A"])
    assert values(tables.read_table(spark, database, "f"), "sales") == [(2.0,)]
    assert begun.select("sales").count() == 1


def test_values_with_special_characters(spark, database):
    names = ["a b", "x/y=z", "100%", "it's", "\u00e9"]
    for v in (1.0, 2.0):
        tables.replace_partitions(forecasts(spark, *((n, "p", v) for n in names)), database, FORECAST, names)
    assert values(tables.read_table(spark, database, "f"), "model", "sales") == sorted((n, 2.0) for n in names)
    assert sorted(tables.partition_values(spark, database, "f")) == sorted(names)
    tables.replace_partitions(forecasts(spark, ("k", "p", 3.0)), database, FORECAST, ["k"], drop_others=True)
    assert tables.partition_values(spark, database, "f") == ["k"]
