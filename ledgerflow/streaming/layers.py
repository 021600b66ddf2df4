"""The layered stream: topics -> raw -> cleaned -> aggregates, and the alert stream.

Every layer is its own query on the previous layer's files, with its own checkpoint, so each
one restarts alone. One query serves all topics: the topic is a column, and a hot topic is
read by as many tasks as it has partitions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow import fixed, schemas
from ledgerflow.operators import gold
from ledgerflow.operators.flat import route, to_alert_record, to_flat_transaction
from ledgerflow.operators.fraud import score_alerts
from ledgerflow.operators.quality import QualityRules, add_partitions
from ledgerflow.operators.silver import to_silver
from ledgerflow.sinks import stream as sink
from ledgerflow.sinks.batch import replace_date
from ledgerflow.sources.events import parse_events, valid_events
from ledgerflow.sources.files import read_layer_stream
from ledgerflow.streaming import incremental


@dataclass(frozen=True)
class Paths:
    """Folders of the layers and their checkpoints under one root."""

    root: str

    def layer(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def start_bronze(
    raw: DataFrame,
    paths: Paths,
    trigger: int | str = sink.INTERVALS["bronze"],
    arrived: Column | None = None,
) -> StreamingQuery:
    """Topic messages to the raw layer; unreadable messages are kept with their text."""
    return sink.write_layer(
        parse_events(raw, arrived),
        paths.layer("bronze"),
        paths.checkpoint("bronze"),
        sink.BRONZE_PARTS,
        trigger,
        "bronze",
    )


def read_bronze(spark: SparkSession, paths: Paths, files_per_batch: int | None = None) -> DataFrame:
    return read_layer_stream(spark, paths.layer("bronze"), schemas.RAW_LAYER, files_per_batch)


def read_bronze_batch(spark: SparkSession, paths: Paths) -> DataFrame:
    """The committed raw rows as a batch; `unreadable_events` of them is the reject table."""
    return spark.read.schema(schemas.RAW_LAYER).parquet(paths.layer("bronze"))


def start_silver(
    spark: SparkSession,
    paths: Paths,
    trigger: int | str = sink.INTERVALS["silver"],
    as_of: Column | None = None,
    rules: QualityRules = QualityRules(),
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Raw layer to cleaned layer, with the batch functions."""
    rows = valid_events(read_bronze(spark, paths, files_per_batch))
    cleaned = to_silver(rows, F.current_timestamp() if as_of is None else as_of, rules)
    return sink.write_layer(
        cleaned,
        paths.layer("silver"),
        paths.checkpoint("silver"),
        sink.SILVER_PARTS,
        trigger,
        "silver",
    )


def read_silver_stream(
    spark: SparkSession, paths: Paths, files_per_batch: int | None = None
) -> DataFrame:
    return read_layer_stream(spark, paths.layer("silver"), schemas.SILVER_LAYER, files_per_batch)


def read_silver(spark: SparkSession, paths: Paths) -> DataFrame:
    """The committed cleaned rows as a batch."""
    return spark.read.schema(schemas.SILVER_LAYER).parquet(paths.layer("silver"))


def refresh_days(
    spark: SparkSession,
    paths: Paths,
    touched: DataFrame,
    tables: Mapping[str, object] = gold.GOLD_TABLES,
    date_col: str = "event_date",
) -> None:
    """Recompute the touched days from the cleaned layer and replace them, table by table.

    Only the list of days comes to the driver, at most one value per calendar day, so that the
    scan reads just those folders. A whole day always comes out: retries and late rows are
    harmless.
    """
    days = [r[0] for r in touched.select(date_col).distinct().collect()]
    if not days:
        return
    known = [d for d in days if d is not None]
    wanted = F.col(date_col).isin(known)
    if len(known) < len(days):  # events without a readable time have a folder of their own
        wanted = F.coalesce(wanted, F.lit(True))
    rows = read_silver(spark, paths).where(wanted)
    for name, build in tables.items():
        replace_date(build(rows, date_col=date_col), paths.layer(f"gold/{name}"), date_col)


def start_gold(
    spark: SparkSession,
    paths: Paths,
    trigger: int | str = sink.INTERVALS["gold"],
    files_per_batch: int | None = None,
    tables: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Cleaned layer to the aggregate tables. A batch adds its states to those of its days and never
    opens cleaned files of other batches (`streaming.incremental`). With `tables` of one's own, whose
    states are not known, a batch only says which days are computed again (`refresh_days`)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if tables is None:
            incremental.add_batch(batch, batch_id, paths.layer("gold_state"), paths.layer("gold"))
        else:
            refresh_days(batch.sparkSession, paths, batch.select("event_date"), tables)

    return sink.write_each(
        read_silver_stream(spark, paths, files_per_batch),
        step,
        paths.checkpoint("gold"),
        trigger,
        "gold",
    )


def read_gold(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    """An aggregate table; the daily indicators come with their trends."""
    rows = spark.read.parquet(paths.layer(f"gold/{name}"))
    return gold.with_trends(rows) if name == "business_kpis" else rows


def alert_stream(raw: DataFrame, arrived: Column | None = None) -> DataFrame:
    """Scored alerts of the suspicious topic."""
    events = valid_events(parse_events(raw, arrived))
    alerts = score_alerts(events.where(F.col("kafka_topic") == fixed.TOPIC_SUSPICIOUS))
    return alerts.withColumn("processing_date", F.to_date("ingestion_timestamp"))


def start_alerts(
    raw: DataFrame,
    paths: Paths,
    console_trigger: int | str = sink.INTERVALS["console"],
    trigger: int | str = sink.INTERVALS["alerts"],
    console: str = "console",
    arrived: Column | None = None,
) -> list[StreamingQuery]:
    """Two queries over the same alerts: a console view and the alert table."""
    alerts = alert_stream(raw, arrived)
    return [
        sink.write_console(alerts, console_trigger, "fraud_alerts_console", console),
        sink.write_layer(
            alerts.drop("_corrupt"),
            paths.layer("gold/fraud_alerts"),
            paths.checkpoint("fraud_alerts"),
            sink.ALERT_PARTS,
            trigger,
            "fraud_alerts",
        ),
    ]


def start_consumer_bronze(
    raw: DataFrame,
    paths: Paths,
    name: str,
    trigger: int | str = sink.INTERVALS["bronze"],
    arrived: Column | None = None,
) -> StreamingQuery:
    """Raw layer of the alert consumer, by year, month and sender country."""
    events = parse_events(raw, arrived).drop("date_partition", "hour_partition")
    parts = add_partitions(events).drop("date_partition", "hour_partition", "date")
    parts = parts.withColumn("sender_country", F.col("sender.country"))
    return sink.write_layer(
        parts,
        paths.layer(f"consumer/{name}"),
        paths.checkpoint(f"consumer_{name}"),
        sink.CONSUMER_PARTS,
        trigger,
        f"bronze_{name}",
    )


def start_flat_tables(
    raw: DataFrame,
    paths: Paths,
    trigger: int | str = sink.INTERVALS["bronze"],
    arrived: Column | None = None,
) -> list[StreamingQuery]:
    """Topic messages as flat transaction rows and alert records, in month folders."""
    events = valid_events(parse_events(raw, arrived)).drop("_corrupt")
    topic, at = F.col("kafka_topic"), F.col("ingestion_timestamp")

    def start(rows: DataFrame, name: str) -> StreamingQuery:
        rows = rows.withColumn("month", F.date_format("timestamp", "yyyyMM"))
        return sink.write_layer(
            rows, paths.layer(f"flat/{name}"), paths.checkpoint(name), ("month",), trigger, name
        )

    return [
        start(to_flat_transaction(events, topic, at), "flat_transactions"),
        start(to_alert_record(events, topic, at), "flat_alerts"),
    ]


def start_routing(
    raw: DataFrame, servers: str, paths: Paths, trigger: int | str = sink.INTERVALS["bronze"]
) -> StreamingQuery:
    """Messages back to the topic their risk calls for; alerts go to the alert topic."""
    return sink.write_topic(
        routed(raw), servers, paths.checkpoint("routing"), trigger, "routing"
    )


def routed(raw: DataFrame) -> DataFrame:
    """Parsed events with target topic and key; only the event fields remain in the value."""
    scored = score_alerts(valid_events(parse_events(raw)), keep_all=True)
    risk = F.col("compliance.risk_level")
    alert = F.col("is_fraud_alert") & risk.isin("medium", "high")
    sent = route(scored, risk, F.col("sender.country"), F.coalesce(alert, F.lit(False)))
    return sent.select("topic", "key", *schemas.EVENT.names)
