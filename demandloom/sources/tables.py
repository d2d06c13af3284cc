"""Catalog tables: creation, scans, and sinks that replace a table or its partitions."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import schemas
from demandloom.durable import durable, release


@dataclass(frozen=True)
class TableSpec:
    """What a table looks like and where it lies; with a location it is external."""

    name: str
    layout: T.StructType
    partitions: tuple[str, ...] = ()
    location: str | None = None

    @property
    def columns(self) -> list[str]:
        """Column names in the order of the table, partition columns last."""
        inner = [n for n in self.layout.fieldNames() if n not in self.partitions]
        return [*inner, *self.partitions]

    @staticmethod
    def of(table: str) -> TableSpec:
        """The description of a table of the workflow."""
        layout, partitions = schemas.TABLES[table]
        return TableSpec(table, layout, tuple(partitions))


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")


def create_table(spark: SparkSession, database: str, spec: TableSpec) -> None:
    """Create a parquet table unless there is one."""
    fields = ", ".join(
        f"{_quoted(f.name)} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        for f in spec.layout.fields
    )
    clauses = [f"CREATE TABLE IF NOT EXISTS {_quoted(database, spec.name)} ({fields}) USING parquet"]
    if spec.partitions:
        clauses.append(f"PARTITIONED BY ({', '.join(map(_quoted, spec.partitions))})")
    if spec.location:
        clauses.append(f"LOCATION {_literal(spec.location)}")
    spark.sql(" ".join(clauses))


def create_tables(spark: SparkSession, database: str) -> None:
    """Every table of the workflow."""
    for table in schemas.TABLES:
        create_table(spark, database, TableSpec.of(table))


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.read.table(_quoted(database, table))


def append_to(df: DataFrame, database: str, spec: TableSpec) -> None:
    create_table(df.sparkSession, database, spec)
    # insertInto goes by position
    df.select(*spec.columns).write.insertInto(_quoted(database, spec.name))


def replace_table(df: DataFrame, database: str, spec: TableSpec) -> None:
    """Replace all rows of a table without partitions."""
    if spec.partitions:
        raise ValueError(f"{spec.name} is partitioned: use replace_partitions")
    create_table(df.sparkSession, database, spec)
    df.select(*spec.columns).write.insertInto(_quoted(database, spec.name), overwrite=True)


def replace_partitions(
    df: DataFrame, database: str, spec: TableSpec, values: Iterable[str], drop_others: bool = False
) -> None:
    """Replace the partitions of the given values of the one partition column.

    All partitions are first written to fresh folders; only when the last one is complete do
    their locations change, each in one step of the catalog. Readers see a partition's old rows
    or its new ones, and a job that fails leaves every old partition as it was. A value without
    rows leaves its partition empty, so nothing of an earlier run stays behind. With
    ``drop_others`` all other partitions go. No session setting matters, and writers of
    different values do not meet. The files that were replaced before last are deleted; those
    just replaced stay for readers that have begun.
    """
    spark = df.sparkSession
    (column,) = spec.partitions
    create_table(spark, database, spec)
    name, values = _quoted(database, spec.name), list(values)
    # read once for each value
    rows = durable(df.select(*spec.columns))
    versions = f"{_location(spark, name)}/{VERSIONS}"
    before = {value: _partition_folder(spark, name, column, value) for value in values}
    run = uuid.uuid4().hex
    written = {value: f"{versions}/{quote(value, safe='')}/{run}" for value in values}
    for value, path in written.items():
        rows.where(F.col(column) == value).drop(column).write.parquet(path)
    for value, path in written.items():
        partition = f"PARTITION ({_quoted(column)} = {_literal(value)})"
        if before[value] is None:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {partition} LOCATION {_literal(path)}")
        else:
            spark.sql(f"ALTER TABLE {name} {partition} SET LOCATION {_literal(path)}")
    spark.catalog.refreshTable(name)
    for value, path in written.items():
        _delete_others(spark, os.path.dirname(path), {path, before[value] or path})
    release(rows)
    if drop_others:
        for value in sorted(set(partition_values(spark, database, spec.name)) - set(values)):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_quoted(column)} = {_literal(value)})")
            _delete_others(spark, f"{versions}/{quote(value, safe='')}", set())


# readers of the table's folder pass over folders with such names
VERSIONS = ".versions"


def partition_values(spark: SparkSession, database: str, table: str) -> list[str]:
    """Values of the one partition column, from the catalog alone."""
    shown = spark.sql(f"SHOW PARTITIONS {_quoted(database, table)}").collect()
    return [unquote(row["partition"].split("=", 1)[1]) for row in shown]


def _partition_folder(spark: SparkSession, name: str, column: str, value: str) -> str | None:
    """Where a partition's files lie, or None where there is no such partition."""
    try:
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({_quoted(column)} = {_literal(value)})")
        return told.where("col_name = 'Location'").first()["data_type"].rstrip("/")
    except AnalysisException as e:
        if e.getCondition() not in ("PARTITIONS_NOT_FOUND", "_LEGACY_ERROR_TEMP_1231"):
            raise
        return None


def _delete_others(spark: SparkSession, folder: str, kept: set[str]) -> None:
    """Delete what lies in a folder, but for the paths to keep."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return
    names = {k.rsplit("/", 1)[1] for k in kept}
    for status in files.listStatus(path):
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def write_local(pdf: pd.DataFrame, spark: SparkSession, database: str, spec: TableSpec) -> None:
    """Write a small local frame; results of the engine itself never take this way."""
    replace_table(spark.createDataFrame(pdf, schema=spec.layout), database, spec)


def table_info(spark: SparkSession, database: str, table: str) -> dict[str, str]:
    """Kind of the table, and its columns' types by name."""
    found = spark.catalog.getTable(_quoted(database, table))
    columns = spark.catalog.listColumns(_quoted(database, table))
    return {"Type": found.tableType} | {column.name: column.dataType for column in columns}


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def use_catalog(spark: SparkSession, catalog: str) -> None:
    spark.catalog.setCurrentCatalog(catalog)


def append_run_log(
    spark: SparkSession,
    database: str,
    stage: str,
    params: dict,
    metric: str | None = None,
    value: float | None = None,
) -> None:
    """One row per stage run: its settings and, where it has one, a summary value."""
    row = (
        datetime.now(timezone.utc).replace(tzinfo=None),
        stage,
        json.dumps(params, default=str, sort_keys=True),
        metric,
        value,
    )
    append_to(spark.createDataFrame([row], schema=schemas.RUN_LOG), database, TableSpec.of("run_log"))
