"""Tables in Spark's catalog: create, append, evolve, replace, export."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart.config import exists, remove

logger = logging.getLogger(__name__)


def table_name(
    layer: str, domain: str, key: str, time: str, *, prod: bool = True, contributor: str = ""
) -> str:
    """`layer.layer_domain_key_time`; trial loads go to the test layer under the contributor."""
    if not prod:
        layer, domain = "test", f"{contributor}_{domain}"
    return f"{layer}.{layer}_{domain}_{key}_{time}"


def quoted(name: str) -> str:
    """A name as it is written in SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Creates the table, and its database, unless it exists."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(table.split('.')[0])}")
    columns = ", ".join(
        f"{quoted(field.name)} {field.dataType.simpleString()}"
        + ("" if field.nullable else " NOT NULL")
        for field in schema
    )
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})"
    if location:
        statement += f" LOCATION {_literal(location)}"
    spark.sql(statement)


def missing_required(schema: T.StructType) -> F.Column:
    """True for a row that lacks a required value."""
    missing = F.lit(False)
    for field in schema:
        if not field.nullable:
            missing = missing | F.col(field.name).isNull()
    return missing


def split_required(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that can be loaded, and those to put aside for lack of a required value."""
    missing = missing_required(schema)
    return rows.where(~missing), rows.where(missing)


def enforce(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the table's columns and types; a missing required value fails the job."""
    columns = []
    for field in schema:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            refuse = F.raise_error(F.lit(f"required value {field.name} is missing"))
            value = F.coalesce(value, refuse.cast(field.dataType))
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def _insert(rows: DataFrame, table: str) -> int:
    """Appends and returns the number of rows, counted by the write itself."""
    loaded = Observation()
    rows.observe(loaded, F.count(F.lit(1)).alias("rows")).write.mode("append").insertInto(table)
    count = loaded.get["rows"]
    logger.info("Loaded %s rows and %s columns into %s", count, len(rows.columns), table)
    return count


def append(rows: DataFrame, table: str, schema: T.StructType) -> int:
    """Appends under a fixed schema, in one pass; without rows the table stays as it is."""
    columns = rows.sparkSession.table(table).columns
    return _insert(enforce(rows, schema).select(*columns), table)


def add_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Adds the columns that the table lacks."""
    known = set(spark.table(table).columns)
    added = [field for field in schema if field.name not in known]
    if added:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def in_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows by name in the columns and types of a table; columns they lack are missing."""
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(quoted(field.name)) if field.name in present else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in schema
        ]
    )


def append_evolving(rows: DataFrame, table: str, location: str | None = None) -> int:
    """Appends by name, in one pass; columns the table lacks are added to it."""
    spark = rows.sparkSession
    if "vat_number" in rows.columns:
        rows = rows.withColumn("vat_number", F.col("vat_number").cast("string"))
    create_table(spark, table, T.StructType([_nullable(f) for f in rows.schema]), location)
    add_columns(spark, table, rows.schema)
    return _insert(in_schema(rows, spark.table(table).schema), table)


def _nullable(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, field.dataType, True)


def replace_table(spark: SparkSession, table: str, rows: DataFrame, folder: str) -> None:
    """Replaces the rows of an unpartitioned table, also by rows made from itself.

    The new rows are written whole beside the old ones before the table is
    pointed to them, so a job that fails midway leaves the table as it was.
    """
    location = f"{folder}/{uuid.uuid4().hex}"
    columns = [quoted(name) for name in spark.table(table).columns]
    rows.select(*columns).write.parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(location)}")
    spark.catalog.refreshTable(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _location(spark: SparkSession, table: str, spec: str = "") -> str:
    """Folder of a table, or of one of its partitions."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect()
    names = [row.col_name for row in rows]
    start = names.index("# Detailed Partition Information" if spec else "# Detailed Table Information")
    return next(row.data_type for row in rows[start:] if row.col_name == "Location")


def _value(value: object) -> str:
    if value is None:
        return "null"
    return _literal(value) if isinstance(value, str) else str(value)


def _spec(names: Sequence[str], values: Sequence[object]) -> str:
    """PARTITION clause of one partition."""
    parts = [f"{quoted(n)} = {_value(v)}" for n, v in zip(names, values, strict=True)]
    return f"PARTITION ({', '.join(parts)})"


def _folder(spark: SparkSession, names: Sequence[str], values: Sequence[object]) -> str:
    """Folder that a write gives to a partition."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = lambda value: None if value is None else str(value)
    return "/".join(
        utils.getPartitionPathString(n, text(v)) for n, v in zip(names, values, strict=True)
    )


def _has_partition(spark: SparkSession, table: str, spec: str) -> bool:
    return bool(spark.sql(f"SHOW PARTITIONS {table} {spec}").head(1))


def point_partition(spark: SparkSession, table: str, spec: str, folder: str, known: bool) -> None:
    """Makes a folder the content of a partition: one change of the catalog."""
    if known:
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {_literal(folder)}")
    else:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {_literal(folder)}")


def replace_partitions(spark: SparkSession, table: str, rows: DataFrame) -> list[str]:
    """Replaces the partitions that the rows are in; all others keep their files.

    The rows may be made from the table itself. They are written whole, as a new
    version beside the old ones, before the catalog points one partition after the
    other to it. A job that fails in between leaves every partition readable, with
    its old rows or with its new ones. Gives the folders that are no longer read:
    they are listed as retired, and stay for readers that have begun, until
    `remove_retired`.
    """
    names = partition_columns(spark, table)
    top = _location(spark, table)
    version = uuid.uuid4().hex
    fresh = rows.select(*[quoted(name) for name in spark.table(table).columns])
    where = f"{top}/_versions/{version}"
    fresh.write.partitionBy(*names).parquet(where)
    written = spark.read.schema(fresh.schema).parquet(where)
    touched = [tuple(row) for row in written.select(*names).distinct().collect()]  # a few folders
    specs = [(_spec(names, values), _folder(spark, names, values)) for values in touched]
    known = [_has_partition(spark, table, spec) for spec, _ in specs]
    old = [
        _location(spark, table, spec)
        for (spec, _), there in zip(specs, known, strict=True)
        if there
    ]
    if old:
        listed = spark.createDataFrame([(path,) for path in old], "path string")
        listed.withColumn("at", F.current_timestamp()).coalesce(1).write.json(f"{top}/_retired/{version}")
    try:
        for (spec, folder), there in zip(specs, known, strict=True):
            point_partition(spark, table, spec, f"{where}/{folder}", there)
    finally:
        spark.catalog.refreshTable(table)
    return old


def retired(spark: SparkSession, table: str) -> DataFrame:
    """(path, at): folders that replaced partitions have left, and since when."""
    top = f"{_location(spark, table)}/_retired"
    schema = "path string, at timestamp"
    if not exists(spark, top):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(top)


def remove_retired(spark: SparkSession, table: str, before: datetime | str) -> list[str]:
    """Removes folders that were retired before a time and that no partition points to."""
    gone = retired(spark, table).where(F.col("at") < F.lit(before).cast("timestamp"))
    paths = [row.path for row in gone.select("path").distinct().collect()]  # a few folders a job
    names = partition_columns(spark, table)
    used = {
        _location(spark, table, _spec(names, tuple(row)))
        for row in spark.table(table).select(*names).distinct().collect()
    }
    removed = [path for path in paths if path not in used and exists(spark, path)]
    for path in removed:
        remove(spark, path)
    return removed


def export_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header row; blanks and line ends at the ends of cells are kept."""
    (
        rows.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def preview(rows: DataFrame, path: str, count: int = 5) -> DataFrame:
    """Dry run: the whole payload as JSON files, and the first records to look at."""
    rows.write.json(path, ignoreNullFields=False)
    return rows.limit(count)


def column_changes(before: Sequence[str], after: Sequence[str]) -> dict[str, list[str]]:
    """Columns of a dry run as they are and as they will be."""
    return {"as_is": list(before), "to_be": list(after)}
