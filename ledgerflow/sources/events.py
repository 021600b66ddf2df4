"""Topic messages: live, bounded, and their JSON payload."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerflow import schemas
from ledgerflow.operators.quality import add_partitions

c = F.col


def topic_options(servers: str, topic: str, starting: str = "latest", group: str | None = None) -> dict[str, str]:
    """Reader options of a live topic."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "false"}
    return options | ({"kafka.group.id": group} if group else {})


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", group: str | None = None
) -> DataFrame:
    """Stream of one topic. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, group)).load()


def bounded_offsets(ends: Mapping[int, tuple[int, int]], limit: int) -> dict[int, tuple[int, int]]:
    """The offsets (from, up to but not including) of each partition that hold the first `limit` messages by
    partition and offset; `ends` are the first offset and the one after the last of each partition."""
    out, left = {}, max(0, limit)
    for partition in sorted(ends):
        first, after = ends[partition]
        take = min(left, max(0, after - first))
        out[partition] = (first, first + take)
        left -= take
    return out


def topic_batch_options(servers: str, topic: str, limit: int, ends: Mapping[int, tuple[int, int]] | None = None) -> dict[str, str]:
    """Reader options of a bounded read. With the partitions' `ends` only the wanted offsets are read."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if ends:
        ranges = bounded_offsets(ends, limit)
        for name, at in (("startingOffsets", 0), ("endingOffsets", 1)):
            options[name] = json.dumps({topic: {str(p): r[at] for p, r in ranges.items()}})
    return options


def read_topic_batch(
    spark: SparkSession, servers: str, topic: str, limit: int = 10, ends: Mapping[int, tuple[int, int]] | None = None
) -> DataFrame:
    """The first `limit` messages by partition and offset, as a batch. Without `ends` (see
    `bounded_offsets`) the topic is read whole, and the limit keeps as many rows of each task."""
    raw = spark.read.format("kafka").options(**topic_batch_options(servers, topic, limit, ends)).load()
    return raw.orderBy("partition", "offset").limit(limit)


def read_topic_files(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of parquet files with the columns of a topic; stands in for the broker."""
    return (
        spark.readStream.schema(schemas.TOPIC)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def parse_json(raw: DataFrame, schema: StructType) -> DataFrame:
    """Topic columns plus `data`, the parsed value; unreadable text lands in `_corrupt`."""
    wanted = StructType(schema.fields)
    if "_corrupt" not in wanted.names:
        wanted = StructType([*schema.fields, StructField("_corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    text = c("value").cast("string")
    return raw.select("*", F.from_json(text, wanted, options).alias("data"))


def parse_events(
    raw: DataFrame,
    arrived: Column | None = None,
    schema: StructType = schemas.EVENT,
    ts: str | None = "timestamp",
) -> DataFrame:
    """Raw layer rows: event fields, topic columns, arrival time and folder columns."""
    parsed = parse_json(raw, schema).select(
        "data.*",
        c("key").cast("string").alias("partition_key"),
        c("topic").alias("kafka_topic"),
        c("partition").alias("kafka_partition"),
        c("offset").alias("kafka_offset"),
        c("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if arrived is None else arrived).alias("ingestion_timestamp"),
    )
    if ts is None:
        return parsed
    out = add_partitions(parsed, ts)
    return out.drop("year", "month", "day", "hour", "date")


def _readable(events: DataFrame) -> Column:
    """Whether the payload gave any event field (blank or broken text gives none)."""
    fields = [c(x).isNotNull() for x in schemas.EVENT.names if x in events.columns]
    return reduce(lambda a, b: a | b, fields)


def valid_events(events: DataFrame) -> DataFrame:
    """Rows whose payload could be read, with or without an id: quality checks flag a missing one."""
    return events.where(_readable(events))


def unreadable_events(events: DataFrame) -> DataFrame:
    """The other rows; `_corrupt` holds the text."""
    return events.where(~_readable(events))


def to_topic(df: DataFrame) -> DataFrame:
    """Rows with `topic` and `key` as messages; the other columns become the JSON value."""
    body = [c(f"`{x}`") for x in df.columns if x not in ("topic", "key")]
    return df.select("topic", c("key").cast("string"), F.to_json(F.struct(*body)).alias("value"))
