"""Scans and sinks over catalog tables."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = "day"

# Conditions by which a catalog says that a table, or what should hold it, is not there.
NOT_FOUND = ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "CATALOG_NOT_FOUND")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_table_with_filter(spark: SparkSession, name: str, condition: str) -> DataFrame:
    return spark.table(name).where(condition)


def table_exists(spark: SparkSession, name: str) -> bool:
    """One- to three-part name. Only "not found" is an answer; any other error is raised."""
    try:
        return spark.catalog.tableExists(name)
    except AnalysisException as error:
        if error.getCondition() in NOT_FOUND:
            return False
        raise


def read_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    if table_exists(spark, name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def on_day(column: str, day: date):
    """Rows whose timestamp falls on ``day``; a plain date comparison, so it is pushed to the scan."""
    return F.to_date(column) == F.lit(day)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    partition_by: str | None = None,
    path: str | None = None,
) -> None:
    """Append to or replace a table; a new one gets the catalog's own format."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_day(df: DataFrame, name: str, day: date, path: str | None = None) -> None:
    """Make ``df`` the whole content of the table's partition for ``day``.

    Running it again for the same day gives the same table, also when ``df`` is empty.
    """
    replace_part(df, name, {DAY: day}, path)


def replace_part(df: DataFrame, name: str, part: dict[str, date | int | str], path: str | None = None) -> None:
    """Make ``df`` the whole content of the table's partition with these values."""
    spark = df.sparkSession
    rows = df.drop(*part)
    if not table_exists(spark, name):
        empty = spark.createDataFrame([], rows.schema).withColumns({c: F.lit(v) for c, v in part.items()})
        writer = empty.write.mode("append").partitionBy(*part)
        (writer.option("path", path) if path else writer).saveAsTable(name)

    def literal(value: date | int | str) -> str:
        if isinstance(value, date):
            return f"DATE'{value.isoformat()}'"
        return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join(f"{column} = {literal(value)}" for column, value in part.items())
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({values}) SELECT * FROM {{rows}}", rows=rows)
