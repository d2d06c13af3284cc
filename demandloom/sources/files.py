"""CSV sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.casts import lenient

BASE_PATH_VARIABLE = "WORKSPACE_FILE_PATH"


def read_csv_cast(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", base_path: str | None = None
) -> DataFrame:
    """CSV with a header, read as text and cast per declared field.

    Text that does not fit its type becomes null. Columns outside the schema are kept
    as text. A base path, given or from the environment, makes the path a local file.
    """
    base_path = base_path or os.getenv(BASE_PATH_VARIABLE)
    if base_path:
        path = f"file:{base_path}/{path}"
    raw = spark.read.csv(path, sep=sep, header=True)
    casts = {f.name: lenient(F.col(f.name), f.dataType) for f in schema.fields}
    return raw.withColumns(casts)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with a header, parsed with the schema by the source itself."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema)
