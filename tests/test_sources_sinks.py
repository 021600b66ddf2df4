import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerflow import schemas
from ledgerflow.operators import profile
from ledgerflow.plans import bi
from ledgerflow.sinks import batch
from ledgerflow.sources import events, files, market

NOW = "2024-01-09 00:00:00"


def messages(spark, *texts):
    rows = [("k", t, "transactions-normal", 0, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")
    return df.select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), "topic", "partition", "offset",
        F.lit(NOW).cast("timestamp").alias("timestamp"),
    )


def test_parse_events(spark):
    good = {
        "transaction_id": "t1",
        "timestamp": "2024-01-05T06:07:08.123456",
        "sender": {"user_id": "u", "kyc_level": 2, "unknown": 1},
        "compliance": {"flags": ["high_amount"], "aml_score": 0.5},
        "stream_metadata": {"sequence_id": 5000000000},
    }
    zulu = {"transaction_id": "t2", "timestamp": "2024-01-05T06:07:08Z"}
    wrong = {"transaction_id": "t3", "transfer": {"usd_equivalent": "abc"}}
    raw = messages(spark, json.dumps(good), json.dumps(zulu), json.dumps(wrong), "{broken", "", "{}")
    out = events.parse_events(raw, F.lit(NOW).cast("timestamp"))
    rows = {r.kafka_offset: r for r in out.collect()}
    a = rows[0]
    assert (a.timestamp, a.date_partition, a.hour_partition) == (
        dt.datetime(2024, 1, 5, 6, 7, 8, 123456), "2024-01-05", 6,
    )
    assert a.compliance.flags == ["high_amount"] and a.stream_metadata.sequence_id == 5000000000
    assert (a.partition_key, a.kafka_topic, a.sender.kyc_level) == ("k", "transactions-normal", 2)
    assert rows[1].timestamp == dt.datetime(2024, 1, 5, 6, 7, 8)
    assert rows[2].transaction_id == "t3" and rows[2]._corrupt is not None
    assert rows[3].transaction_id is None and rows[3]._corrupt == "{broken"
    assert sorted(r.kafka_offset for r in events.valid_events(out).collect()) == [0, 1, 2]
    assert sorted(r.kafka_offset for r in events.unreadable_events(out).collect()) == [3, 4, 5]
    assert {f.name for f in out.schema.fields} == {f.name for f in schemas.RAW_LAYER.fields}


def test_to_topic(spark):
    df = spark.sql("SELECT 'x' AS topic, 'TH' AS key, 1 AS a, named_struct('c', 2) AS b")
    r = events.to_topic(df).first()
    assert (r.topic, r.key, json.loads(r.value)) == ("x", "TH", {"a": 1, "b": {"c": 2}})


def test_klines(spark):
    good = [1704067200000, "1", "2", "0.5", "1.5", "10", 1704070799999, "15", 3, "4", "5", "0"]
    short = good[:5]
    bad = [*good[:4], "x", *good[5:]]
    df = spark.createDataFrame([("BTCUSDT", json.dumps([good, short, bad]))], "symbol string, value string")
    ok, rejects = market.parse_klines(df)
    (r,) = ok.collect()
    assert r.open_time == dt.datetime(2024, 1, 1) and r.close == 1.5 and r.num_trades == 3
    assert r.symbol == "BTCUSDT" and "cells" not in ok.columns
    assert {len(json.loads(x.raw)) for x in rejects.collect()} == {5, 12}


def test_array_candles(spark):
    df = spark.sql(
        """SELECT 'A' AS symbol, 'ok' AS s, array(10, 20) AS t, array(1D, 2D) AS o, array(1D, 2D) AS h,
        array(1D, 2D) AS l, array(1D, 2D) AS c, array(5D, 6D) AS v
        UNION ALL SELECT 'B', 'no_data', array(1), array(1D), array(1D), array(1D), array(1D), array(1D)
        UNION ALL SELECT 'C', 'ok', array(), array(), array(), array(), array(), array()
        UNION ALL SELECT 'D', 'ok', NULL, NULL, NULL, NULL, NULL, NULL"""
    )
    (r,) = market.parse_array_candles(df).collect()
    assert (r.symbol, r.timestamp, r.close, r.volume) == ("A", 20000, 2.0, 6.0)
    assert [x.timestamp for x in market.parse_array_candles(df, last_only=False).collect()] == [10000, 20000]


def test_prices_and_volumes(spark):
    snap = spark.sql("SELECT map('BTCUSDT', 2D, 'ETHUSDT', 1D) AS prices, map('BTCTHB', 70D) AS thb_pairs")
    got = {r.symbol: (r.price, r.source) for r in market.explode_prices(snap, F.lit(NOW)).collect()}
    assert got == {
        "BTCUSDT": (2.0, "binance_global"),
        "ETHUSDT": (1.0, "binance_global"),
        "BTCTHB": (70.0, "binance_th"),
    }
    tickers = spark.createDataFrame(
        [("ETHBTC", 169034, 35881.1558, -2.995)], "symbol string, count bigint, volume double, price_change double"
    )
    stats = market.compare_volumes(tickers)
    maps = stats.select(F.create_map("symbol", "stats").alias("volume_comparison"))
    rows = {r.exchange: r for r in market.unpivot_volumes(maps, F.lit(NOW)).collect()}
    assert (rows["Binance_TH"].daily_trades, rows["Binance_TH"].daily_volume) == (16903, 3588.11558)
    assert rows["Binance_Global"].daily_trades == 169034
    assert {r.price_change_pct for r in rows.values()} == {-2.995}


def test_ticker(spark):
    items = [
        {"symbol": f"S{i}", "volume": "1.5", "quoteVolume": "2", "count": 7, "priceChangePercent": "-0.1"}
        for i in range(60)
    ] + [{"symbol": "late", "volume": "x"}]
    df = spark.createDataFrame([(json.dumps(items),)], "value string")
    rows = market.parse_ticker(df).collect()
    assert len(rows) == 50
    assert {r.symbol for r in rows} == {f"S{i}" for i in range(50)}
    assert rows[0]["count"] == 7 and rows[0]["price_change"] == -0.1
    pairs = spark.createDataFrame([("BTCTHB",), ("XTHB",)], "symbol string")
    assert [r.symbol for r in market.listed_pairs(pairs).collect()] == ["BTCTHB"]


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    schema = schemas.row(a=schemas.LONG)
    for name, lines in (("a.json", False), ("b.jsonl", True)):
        got = files.read_json_array(spark, str(tmp_path / name), schema, lines)
        assert sorted(r.a for r in got.collect()) == [1, 2]


def test_candle_files_skip_missing(spark, tmp_path):
    root = str(tmp_path)
    one = spark.sql("SELECT '1.5' AS close, '2' AS volume, '3' AS quote_volume, '4' AS num_trades")
    one.write.parquet(files.candle_path(root, "global", "BTCUSDT"))
    one.write.parquet(files.candle_path(root, "th", "THB_BTC", "2024-01-05"))
    paths = [
        files.candle_path(root, "global", "BTCUSDT"),
        files.candle_path(root, "global", "MISSING"),
        files.candle_path(root, "th", "THB_BTC", "2024-01-05"),
    ]
    rows = files.read_candles(spark, paths)
    assert {(r.market, r.symbol, r.close, r.num_trades) for r in rows.collect()} == {
        ("global", "BTCUSDT", 1.5, 4),
        ("th", "THB_BTC", 1.5, 4),
    }
    assert files.read_candles(spark, [f"{root}/none.parquet"]) is None


def days(spark, *rows):
    df = spark.createDataFrame(list(rows), "date string, coin string, total_trades bigint")
    return df.withColumn("date", F.to_date("date"))


def test_replace_date_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    batch.replace_date(days(spark, ("2024-01-01", "BTC", 1), ("2024-01-02", "BTC", 2)), path)
    for _ in range(2):
        batch.replace_date(days(spark, ("2024-01-02", "BTC", 5), ("2024-01-02", "ETH", 6)), path)
        got = sorted((str(r.date), r.coin, r.total_trades) for r in spark.read.parquet(path).collect())
        assert got == [("2024-01-01", "BTC", 1), ("2024-01-02", "BTC", 5), ("2024-01-02", "ETH", 6)]
    assert files.read_table(spark, path, "2024-01-02").count() == 2
    plan = files.read_table(spark, path, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_append_table_layout(spark, tmp_path):
    path = str(tmp_path / "tx")
    rows = spark.sql(
        """SELECT concat('t', id) AS transaction_id, timestamp'2024-01-31 00:00:00' + make_interval(0,0,0,id) AS timestamp,
        CAST(1 AS INT) AS is_suspicious FROM range(4)"""
    )
    now = F.lit(NOW).cast("timestamp")
    for _ in range(2):
        batch.append_table(rows, path, "transactions", now)
    out = spark.read.parquet(path)
    assert out.count() == 8 and {str(r.month) for r in out.select("month").collect()} == {"202401", "202402"}
    assert set(out.columns) == {*schemas.TRANSACTIONS.names, "month"}
    assert out.where("created_at IS NULL").count() == 0
    with pytest.raises(KeyError):
        batch.append_table(rows, path, "no_table", now)


def test_prices_table_has_no_month(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.sql("SELECT 'B' AS symbol, 1D AS price UNION ALL SELECT 'A', 2D")
    batch.append_table(rows, path, "crypto_prices", F.lit(NOW))
    assert "month" not in spark.read.parquet(path).columns


def test_candles_and_bronze(spark, tmp_path):
    path = str(tmp_path / "c")
    first = spark.sql("SELECT 'global' AS market, 'A' AS symbol, DATE'2024-01-01' AS date, 1D AS close")
    other = spark.sql("SELECT 'global' AS market, 'B' AS symbol, DATE'2024-01-01' AS date, 9D AS close")
    for df in (first, other, first):
        batch.write_candles(df, path)
    assert sorted(r.close for r in spark.read.parquet(path).collect()) == [1.0, 9.0]
    bronze = str(tmp_path / "b")
    rows = spark.sql(
        "SELECT 't' AS transaction_id, TIMESTAMP'2024-03-05 00:00:00' AS timestamp, named_struct('country','TH') AS sender"
    )
    batch.write_bronze_batch(rows, bronze)
    r = spark.read.parquet(bronze).first()
    assert (r.year, r.month, r.sender_country, r.sender.country) == (2024, 3, "TH", "TH")
    assert list((tmp_path / "b" / "year=2024" / "month=3" / "sender_country=TH").glob("*.snappy.parquet"))


def test_profile_document(spark, tmp_path):
    df = spark.sql(
        """SELECT * FROM VALUES ('TH', 1.5D, TIMESTAMP'2024-01-01 00:00:00', 'low'),
        (NULL, 2D, TIMESTAMP'2024-01-02 00:00:00', 'high') AS t(country, usd, ts, risk)"""
    )
    path = str(tmp_path / "meta")
    batch.write_profile(df, path, usd="usd", country="country", ts="ts", risk="risk")
    (text,) = [p.read_text() for p in (tmp_path / "meta").glob("part-*.json")]
    doc = json.loads(text)
    assert doc["row_count"] == 2 and doc["null_counts"]["country"] == 1
    assert doc["column_types"]["usd"] == "double" and doc["total_volume_usd"] == 3.5
    assert doc["fraud_transactions"] == 1 and doc["unique_countries"] == 1


def test_database_and_row_counts(spark, tmp_path):
    batch.ensure_database(spark, "ledger_test", str(tmp_path / "db"))
    batch.ensure_database(spark, "ledger_test", str(tmp_path / "db"))
    spark.sql("CREATE TABLE IF NOT EXISTS ledger_test.t (a INT, b STRING) USING parquet")
    cols = {(r.table_name, r.column_name, r.data_type) for r in batch.describe(spark, "ledger_test").collect()}
    assert cols == {("t", "a", "int"), ("t", "b", "string")}
    counts = bi.row_counts({"t": spark.table("ledger_test.t"), "r": spark.range(3)})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"t": 0, "r": 3}
    spark.sql("DROP DATABASE ledger_test CASCADE")


def test_summary_document(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('BTC','US',10D,355D,'low',TIMESTAMP'2024-01-01 00:00:00'),
        ('ETH','US',20.5D,1D,'high',TIMESTAMP'2024-01-02 00:00:00')
        AS t(crypto_currency, sender_country, usd_amount, thb_amount, risk_level, event_ts)"""
    )
    doc = json.loads(profile.summary_document(df).first().summary)
    assert doc["total_transactions"] == 2 and doc["total_volume_usd"] == 30.5
    assert doc["crypto_distribution"] == {"BTC": 1, "ETH": 1}
    assert doc["country_distribution"] == {"US": 2}
    assert doc["fraud_rate"] == 50.0 and doc["average_transaction_usd"] == 15.25
    assert sum(doc["crypto_distribution"].values()) == doc["total_transactions"]


def test_no_answer_of_a_market_vanishes(spark):
    good = json.dumps([[1704067200000, "1", "2", "0.5", "1.5", "10", 1704070799999, "15", 3, "4", "5", "0"]])
    answers = [good, "not json", None, "[]", '{"code": -1121}']
    df = spark.createDataFrame(list(enumerate(answers)), "k int, value string")
    ok, rejects = market.parse_klines(df)
    assert [r.k for r in ok.collect()] == [0]
    assert {r.k: r.raw for r in rejects.collect()} == {1: "not json", 2: None, 3: "[]", 4: '{"code": -1121}'}
    ticker = spark.createDataFrame([('[{"symbol": "A"}]',), ("[]",), ("x",), (None,)], "value string")
    assert market.parse_ticker(ticker).count() == 1 and market.ticker_rejects(ticker).count() == 3


def test_symbols_with_digits(spark, tmp_path):
    path = f"{tmp_path}/raw_global_1INCHUSDT.parquet"
    spark.createDataFrame([(1.0,)], "close double").write.parquet(path)
    assert files.read_candles(spark, [path]).first().symbol == "1INCHUSDT"
