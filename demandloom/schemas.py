"""Table layouts, shared by the sources, the stages and the tests.

Names, types, order and nullability are fixed values: downstream queries use them.
"""

from pyspark.sql import types as T


def _layout(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in fields])


SALES = _layout(
    ("country", T.StringType(), False),
    ("product_id", T.StringType(), False),
    ("date", T.DateType(), False),
    ("zipcode", T.LongType(), True),
    # text at rest: the feed carries junk that only the demand stage resolves
    ("sales", T.StringType(), True),
)

GEO = _layout(
    ("country", T.StringType(), False),
    ("s_zipcode", T.LongType(), False),
    ("e_zipcode", T.LongType(), False),
    ("city", T.StringType(), False),
)

INPUT = _layout(
    ("city", T.StringType(), False),
    ("product_id", T.StringType(), False),
    ("date", T.DateType(), False),
    ("sales", T.DoubleType(), False),
)

SPLIT = T.StructType([*INPUT.fields, T.StructField("split", T.StringType(), False)])

FORECAST = T.StructType([T.StructField("model", T.StringType(), False), *INPUT.fields])

METRICS = _layout(
    ("model", T.StringType(), False),
    ("city", T.StringType(), False),
    ("product_id", T.StringType(), False),
    ("metric", T.StringType(), False),
    ("value", T.DoubleType(), False),
)

OUTPUT = _layout(
    ("product_id", T.StringType(), False),
    ("date", T.DateType(), False),
    ("city", T.StringType(), False),
    ("sales", T.DoubleType(), False),
)

# Additions of this engine: what failed, and what was run.
MODEL_ERRORS = _layout(
    ("model", T.StringType(), False),
    ("city", T.StringType(), False),
    ("product_id", T.StringType(), False),
    ("error", T.StringType(), False),
)

RUN_LOG = _layout(
    ("run_ts", T.TimestampType(), False),
    ("stage", T.StringType(), False),
    ("params", T.StringType(), True),
    ("metric", T.StringType(), True),
    ("value", T.DoubleType(), True),
)

# table name -> (layout, partition columns)
TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "sales": (SALES, []),
    "geo": (GEO, []),
    "input": (INPUT, []),
    "split": (SPLIT, []),
    "forecast_on_test": (FORECAST, ["model"]),
    "all_models_forecast": (FORECAST, ["model"]),
    "forecast": (FORECAST, []),
    "metrics": (METRICS, []),
    "best_models": (METRICS, []),
    "output": (OUTPUT, []),
    "model_errors": (MODEL_ERRORS, ["model"]),
    "run_log": (RUN_LOG, []),
}

