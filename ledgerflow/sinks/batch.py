"""Batch writers: appends, replaced days, month folders, bronze files, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.profile import dataset_profile
from ledgerflow.operators.quality import add_partitions
from ledgerflow.schemas import TABLES, TableSpec


def replace_date(df: DataFrame, path: str, date_col: str = "date") -> None:
    """Replace exactly the days present in `df`; other days stay. Running it twice changes nothing.

    `df` must not read the days it replaces. Rows are brought together by day to write few
    files; the rebalance splits a day that is too large for one task.
    """
    (
        df.hint("rebalance", F.col(date_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )


def arrange(df: DataFrame, spec: TableSpec, created_at: Column) -> DataFrame:
    """Columns of the table in order, with its month folder, sorted for row-group skipping.

    The shuffle is by ranges of the sort key, not by month: a month that holds most of the
    rows is still written by many tasks.
    """
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in spec.schema.fields
        if f.name != "created_at"
    ]
    out = df.select(*cols, created_at.cast("timestamp").alias("created_at"))
    if spec.month_of:
        out = out.withColumn("month", F.date_format(spec.month_of, "yyyyMM"))
        return out.repartitionByRange("month", *spec.sort_by).sortWithinPartitions("month", *spec.sort_by)
    return out.repartitionByRange(*spec.sort_by).sortWithinPartitions(*spec.sort_by)


def append_table(df: DataFrame, path: str, name: str, created_at: Column) -> None:
    """Append rows to a declared table; the commit takes all of them or none."""
    spec = TABLES[name]
    writer = arrange(df, spec, created_at).write.mode("append")
    if spec.month_of:
        writer = writer.partitionBy("month")
    writer.parquet(path)


def write_candles(df: DataFrame, path: str, by: Sequence[str] = ("market", "symbol", "date")) -> None:
    """Replace the candle files of the markets, symbols and days in `df`."""
    (
        df.hint("rebalance", *map(F.col, by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_bronze_batch(events: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Nested events as snappy parquet by year, month and sender country."""
    parts = add_partitions(events, ts).withColumn("sender_country", F.col("sender.country"))
    (
        parts.drop("date_partition", "hour_partition", "day", "hour", "date")
        .hint("rebalance", F.col("year"), F.col("month"), F.col("sender_country"))
        .write.mode("append")
        .option("compression", "snappy")
        .partitionBy("year", "month", "sender_country")
        .parquet(path)
    )


def write_profile(df: DataFrame, path: str, **columns: str) -> None:
    """The dataset profile as one JSON line."""
    dataset_profile(df, **columns).coalesce(1).write.mode("overwrite").json(path)


def ensure_database(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{path}'")


def describe(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with their columns."""
    rows = [
        (t.name, col.name, col.dataType)
        for t in spark.catalog.listTables(database)
        for col in spark.catalog.listColumns(t.name, database)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
