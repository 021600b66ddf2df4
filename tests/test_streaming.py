"""Streams driven from files; a stream's result must equal the batch result."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import fraud, gold
from ledgerflow.operators.silver import to_silver
from ledgerflow.sinks import stream as sink
from ledgerflow.sources import events, files
from ledgerflow.streaming import layers, progress

AS_OF = "2024-02-01 00:00:00"
T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def moment():
    return F.lit(AS_OF).cast("timestamp")


def event(i, day, usd=100.0, aml=0.2, risk="low", country="TH", flags=None):
    return {
        "transaction_id": f"t{i}",
        "timestamp": f"2024-01-{day:02d}T{i % 24:02d}:00:00",
        "status": "completed",
        "sender": {"user_id": f"u{i % 3}", "country": country, "kyc_level": 1 + i % 3},
        "receiver": {"user_id": f"r{i % 4}", "country": "Thailand", "kyc_level": 2},
        "transfer": {"crypto_symbol": "btc", "usd_equivalent": usd},
        "fees": {"fee_usd": usd / 1000, "fee_rate": 0.001},
        "compliance": {"aml_score": aml, "risk_level": risk, "flags": flags},
    }


def write_topic_file(spark, path, texts, topic="transactions-normal", offset=0):
    rows = [("TH", t, topic, 0, offset + n) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")
    df.select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), "topic", "partition", "offset",
        moment().alias("timestamp"),
    ).coalesce(1).write.mode("append").parquet(path)


def finish(*queries):
    for q in queries:
        q.awaitTermination(300)
        assert not q.isActive and q.exception() is None


def run_layers(spark, topic, paths):
    raw = events.read_topic_files(spark, topic)
    finish(layers.start_bronze(raw, paths, sink.ONCE, moment()))
    finish(layers.start_silver(spark, paths, sink.ONCE, moment(), files_per_batch=15))
    finish(layers.start_gold(spark, paths, sink.ONCE, files_per_batch=3))


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))


def test_layers_equal_batch_and_survive_restart(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    first = [json.dumps(event(i, 1 + i % 3, usd=900.0 * (i + 1))) for i in range(20)]
    write_topic_file(spark, topic, [*first, "{broken", ""])
    run_layers(spark, topic, paths)
    # A later file holds rows of an old day; the queries go on from their checkpoints.
    late = [json.dumps(event(i, 1, usd=70000.0, aml=0.8, country="RU")) for i in range(20, 26)]
    write_topic_file(spark, topic, late, "transactions-suspicious", 100)
    run_layers(spark, topic, paths)
    run_layers(spark, topic, paths)

    bronze = spark.read.parquet(paths.layer("bronze"))
    assert bronze.count() == 28 and bronze.where("_corrupt = '{broken'").count() == 1
    silver = layers.read_silver(spark, paths)
    assert silver.count() == 26 and silver.select("transaction_id").distinct().count() == 26
    raw = events.parse_events(spark.read.parquet(topic), moment())
    expected = to_silver(events.valid_events(raw), moment())
    assert rows_of(silver.select(*expected.columns)) == rows_of(expected)
    for name, build in gold.GOLD_TABLES.items():
        got = spark.read.parquet(paths.layer(f"gold/{name}"))
        assert rows_of(got) == rows_of(build(expected)), name
    kpis = layers.read_gold(spark, paths, "business_kpis")
    assert rows_of(kpis) == rows_of(gold.business_kpis(expected))
    # All topics at once by a glob, and folders as declared.
    assert files.exists(spark, paths.layer("silver/event_date=2024-01-01"))
    assert files.exists(spark, paths.layer("bronze/date_partition=2024-01-01/hour_partition=0"))
    globbed = files.read_layer_stream(spark, f"{paths.root}/silv*", silver.schema)
    assert globbed.isStreaming


def test_refresh_reads_only_touched_days(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    write_topic_file(spark, topic, [json.dumps(event(i, 1 + i % 5)) for i in range(10)])
    run_layers(spark, topic, paths)
    rows = layers.read_silver(spark, paths).where(F.col("event_date").isin([dt.date(2024, 1, 2)]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [(event_date" in plan


def test_alert_stream(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    bad = [event(1, 1, usd=200000.0), event(2, 1, aml=0.95), event(3, 1, flags=["high_amount"]), event(4, 1)]
    write_topic_file(spark, topic, [json.dumps(e) for e in bad], "transactions-suspicious")
    write_topic_file(spark, topic, [json.dumps(event(9, 1, usd=200000.0))])
    raw = events.read_topic_files(spark, topic, files_per_batch=10)
    finish(*layers.start_alerts(raw, paths, sink.ONCE, sink.ONCE, "memory", moment()))
    seen = {r.transaction_id: r for r in spark.table("fraud_alerts_console").collect()}
    assert set(seen) == {"t1", "t2", "t3"} and tuple(seen["t1"].asDict()) == sink.CONSOLE_COLUMNS
    stored = spark.read.parquet(paths.layer("gold/fraud_alerts"))
    assert {r.transaction_id: r.alert_type for r in stored.collect()} == {
        "t1": "high_amount", "t2": "high_aml_score", "t3": "low_kyc",
    }
    assert files.exists(spark, paths.layer("gold/fraud_alerts/processing_date=2024-02-01/alert_type=high_amount"))


def test_consumer_bronze_folders(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    write_topic_file(spark, topic, [json.dumps(event(1, 1, country="RU"))])
    raw = events.read_topic_files(spark, topic)
    finish(layers.start_consumer_bronze(raw, paths, "normal", sink.ONCE, moment()))
    assert files.exists(spark, paths.layer("consumer/normal/year=2024/month=1/sender_country=RU"))


def test_flat_tables_and_routing(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    rows = [
        event(1, 1),
        event(2, 2, aml=0.75, risk="medium"),
        event(3, 3, aml=0.95, risk="high"),
        event(4, 4, usd=200000.0),
    ]
    write_topic_file(spark, topic, [*map(json.dumps, rows), "nonsense"])
    raw = events.read_topic_files(spark, topic)
    finish(*layers.start_flat_tables(raw, paths, sink.ONCE, moment()))
    flat = spark.read.parquet(paths.layer("flat/flat_transactions"))
    assert {r.transaction_id: r.is_suspicious for r in flat.collect()} == {
        "t1": False, "t2": True, "t3": True, "t4": False,
    }
    alerts = spark.read.parquet(paths.layer("flat/flat_alerts"))
    assert {r.alert_id: r.severity for r in alerts.collect()} == {"alert_t2": "MEDIUM", "alert_t3": "HIGH"}
    sent = events.to_topic(layers.routed(spark.read.parquet(topic))).collect()
    assert {json.loads(r.value)["transaction_id"]: r.topic for r in sent} == {
        "t1": "transactions-normal",
        "t2": "transactions-suspicious",
        "t3": "transactions-fraud-alerts",
        "t4": "transactions-normal",
    }
    assert {r.key for r in sent} == {"TH"}


TX = "transaction_id string, event_ts timestamp, sender_user_id string, receiver_user_id string, usd_amount double, risk_score bigint"


def tx_row(n, at, sender="s", receiver=None, usd=10.0):
    return (f"t{n}", at, sender, receiver or f"r{n}", usd, 10)


def stream_of(spark, path, *batches):
    for rows in batches:
        spark.createDataFrame(rows, TX).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def collect_stream(spark, df, name, checkpoint):
    finish(
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    return spark.table(name).collect()


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_velocity_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    on_time = [tx_row(i, T0 + dt.timedelta(seconds=i), usd=31000.0) for i in range(7)]
    # The watermark filters late rows one batch after it has moved.
    later, again = [tx_row(50, minutes(60), "z")], [tx_row(51, minutes(61), "z")]
    late = [tx_row(90, T0 + dt.timedelta(seconds=30), usd=99999.0)]
    last = [tx_row(99, minutes(300), "z")]
    stream = stream_of(spark, path, on_time, later, again, late, last)
    got = collect_stream(
        spark, fraud.velocity_fraud(stream, watermark="10 minutes"), "velocity", str(tmp_path / "ck")
    )
    want = fraud.velocity_fraud(spark.createDataFrame(on_time, TX)).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and len(got) == 1
    assert got[0].unique_receivers == 7 and got[0].max_single_transaction == 31000.0


def test_sliding_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [tx_row(i, T0 + dt.timedelta(seconds=20 * i), usd=9000.0) for i in range(9)]
    # Only transfers that pass the size filter move the watermark.
    stream = stream_of(
        spark, path, rows, *[[tx_row(99 + i, minutes(300 + i), "z", usd=9000.0)] for i in range(2)]
    )
    got = collect_stream(
        spark, fraud.rapid_fire(stream, watermark="1 minute"), "rapid", str(tmp_path / "ck")
    )
    want = fraud.rapid_fire(spark.createDataFrame(rows, TX)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 1


def test_stream_dedup(spark, tmp_path):
    path = str(tmp_path / "in")
    stream = stream_of(
        spark, path,
        [tx_row(1, minutes(0)), tx_row(2, minutes(1))],
        [tx_row(1, minutes(2))],  # inside the watermark: dropped
        [tx_row(3, minutes(500))],
        [tx_row(4, minutes(501))],
        [tx_row(1, minutes(502))],  # state is gone: kept
    )
    got = collect_stream(
        spark, fraud.dedup(stream, watermark="10 minutes"), "dedup", str(tmp_path / "ck")
    )
    assert sorted(r.transaction_id for r in got) == ["t1", "t1", "t2", "t3", "t4"]
    with pytest.raises(ValueError, match="watermark"):
        fraud.dedup(stream)


def test_progress_and_stop(spark, tmp_path):
    log = progress.ProgressLog(keep=5)
    spark.streams.addListener(log)
    path = str(tmp_path / "in")
    stream = stream_of(spark, path, [tx_row(1, minutes(0))])
    q = sink.triggered(stream.writeStream.format("memory").queryName("watched"), 10).start()
    q.processAllAvailable()
    (row,) = progress.report([q])
    assert row["name"] == "watched" and row["active"] and row["batch_id"] == 0
    assert progress.stop_all(spark) == ["watched"] and not progress.report([q])[0]["active"]
    spark.streams.removeListener(log)
    assert all(r["name"] == "watched" for r in log.rows)


def test_no_event_is_lost_between_the_layers(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    no_id, no_time = event(1, 1), event(2, 2)
    no_id["transaction_id"], no_time["timestamp"] = None, "yesterday"
    write_topic_file(spark, topic, [json.dumps(e) for e in (event(0, 1), no_id, no_time)] + ["{broken", ""])
    run_layers(spark, topic, paths)
    bronze = layers.read_bronze_batch(spark, paths)
    silver = layers.read_silver(spark, paths)
    assert silver.count() == 3 and events.unreadable_events(bronze).count() == 2 and bronze.count() == 5
    assert silver.where("transaction_id is null and not dq_transaction_id_valid").count() == 1
    expected = to_silver(events.valid_events(events.parse_events(spark.read.parquet(topic), moment())), moment())
    for name, build in gold.GOLD_TABLES.items():
        assert rows_of(spark.read.parquet(paths.layer(f"gold/{name}"))) == rows_of(build(expected)), name
