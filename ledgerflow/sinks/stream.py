"""Streaming writers. Each query has its own checkpoint folder and name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerflow.sources.events import to_topic

# Seconds between micro-batches.
INTERVALS = {"bronze": 30, "silver": 60, "gold": 120, "console": 10, "alerts": 60}
ONCE = "once"

# Folder columns of each layer. The sender country is a flat column, as a nested
# one cannot name a folder; days come first so that readers of one day skip the rest.
BRONZE_PARTS = ("date_partition", "hour_partition")
CONSUMER_PARTS = ("year", "month", "sender_country")
SILVER_PARTS = ("event_date",)
ALERT_PARTS = ("processing_date", "alert_type")


def triggered(writer: DataStreamWriter, trigger: int | str) -> DataStreamWriter:
    """Every `trigger` seconds, or everything available and then stop."""
    if trigger == ONCE:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{trigger} seconds")


def write_layer(
    df: DataFrame,
    path: str,
    checkpoint: str,
    parts: Sequence[str],
    trigger: int | str,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to parquet. Files are committed once per batch, also after a restart."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .partitionBy(*parts)
    )
    if name:
        writer = writer.queryName(name)
    return triggered(writer, trigger).start()


CONSOLE_COLUMNS = (
    "transaction_id",
    "timestamp",
    "sender_country",
    "crypto_symbol",
    "usd_equivalent",
    "fraud_score",
    "alert_type",
    "aml_score",
)


def console_view(alerts: DataFrame) -> DataFrame:
    c = F.col
    return alerts.select(
        "transaction_id",
        "timestamp",
        c("sender.country").alias("sender_country"),
        c("transfer.crypto_symbol").alias("crypto_symbol"),
        c("transfer.usd_equivalent").alias("usd_equivalent"),
        "fraud_score",
        "alert_type",
        c("compliance.aml_score").alias("aml_score"),
    )


def write_console(
    alerts: DataFrame, trigger: int | str, name: str = "fraud-alerts-console", sink: str = "console"
) -> StreamingQuery:
    """The eight columns of an alert, 20 rows per batch, on the console (tests: `memory`)."""
    writer = console_view(alerts).writeStream.format(sink).outputMode("append").queryName(name)
    if sink == "console":
        writer = writer.option("truncate", "false").option("numRows", 20)
    return triggered(writer, trigger).start()


def write_each(
    df: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: int | str,
    name: str,
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return triggered(writer.queryName(name), trigger).start()


def write_topic(
    df: DataFrame, servers: str, checkpoint: str, trigger: int | str, name: str
) -> StreamingQuery:
    """Routed rows (with `topic` and `key`) to Kafka. Needs the connector on the class path."""
    writer = (
        to_topic(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    return triggered(writer, trigger).start()
