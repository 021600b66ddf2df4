"""Layer, table and record files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.sources.json_array import read_array


def read_layer_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of a layer's parquet files; `path` may hold a `*` over topics."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in store.listStatus(hadoop) if x.isDirectory()] if store.exists(hadoop) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all that is in it; it need not be there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def read_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """One frame over the paths that exist, or None; missing ones are skipped."""
    found = [p for p in paths if exists(spark, p)]
    return spark.read.parquet(*found) if found else None


# File name of one market, symbol and, in the daily job, day.
_CANDLE_FILE = r"(?:raw_)?(global|th)_([A-Z0-9_]+?)(?:_\d{8})?\.parquet"


def read_candles(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Candle files of several symbols with `market` and `symbol` taken from the file name."""
    rows = read_existing(spark, paths)
    if rows is None:
        return None
    name = F.input_file_name()
    casts = {"volume": "double", "quote_volume": "double", "close": "double", "num_trades": "int"}
    return rows.withColumns(
        {
            "market": F.regexp_extract(name, _CANDLE_FILE, 1),
            "symbol": F.regexp_extract(name, _CANDLE_FILE, 2),
            **{x: F.col(x).cast(t) for x, t in casts.items() if x in rows.columns},
        }
    )


def candle_path(root: str, market: str, symbol: str, day: str | None = None) -> str:
    if day is None:
        return f"{root}/raw_{market}_{symbol}.parquet"
    return f"{root}/{market}_{symbol}_{re.sub('-', '', day)}.parquet"


def read_json_array(
    spark: SparkSession, path: str, schema: StructType, lines: bool = False
) -> DataFrame:
    """Records of JSON array files, or of JSON Lines files. Many tasks share one file of either kind."""
    return spark.read.schema(schema).json(path) if lines else read_array(spark, path, schema)


def read_table(
    spark: SparkSession, path: str, date: str | None = None, date_col: str = "date"
) -> DataFrame:
    """A table, whole or one day; the day becomes a partition or row-group filter."""
    rows = spark.read.parquet(path)
    if date is None:
        return rows
    day = F.lit(date).cast(rows.schema[date_col].dataType)
    return rows.where(F.col(date_col) == day)
