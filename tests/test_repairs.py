"""Not-a-number prices, keys that are NULL, many progress reports, and the library without its text operators."""

import json
import math
import random
import shutil
import subprocess
import sys
from fractions import Fraction
from pathlib import Path

from pyspark.sql import functions as F

from ledgerflow.functions.numbers import decimal_avg, decimal_sum
from ledgerflow.operators import joins, market
from ledgerflow.plans import bi
from ledgerflow.sources import events
from ledgerflow.streaming import progress

ROOT = Path(__file__).resolve().parents[1]


def test_coin_sums_are_exact_whatever_the_order(spark):
    rnd = random.Random(3)
    values = [round(rnd.choice([1e-6, 1.0, 1e5]) * rnd.random(), 8) for _ in range(500)] + [-0.00000001, -7.25, 3e7]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = float(sum(Fraction(f"{v:.8f}") for v in values))
    for parts in (1, 3, 8):
        got = df.repartition(parts).agg(decimal_sum(F.col("v")).alias("s"), decimal_avg(F.col("v")).alias("a")).first()
        assert got.s == want and got.a == want / len(values)


def test_a_value_that_is_no_number_decides_sum_and_average(spark):
    rows = [("nan", 1.0), ("nan", float("nan")), ("inf", 2.0), ("inf", float("inf")), ("both", float("inf")), ("both", float("-inf")), ("none", None), ("ok", 1.5), ("ok", None)]
    got = {r.k: r for r in spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(decimal_sum(F.col("v")).alias("s"), decimal_avg(F.col("v")).alias("a")).collect()}
    assert math.isnan(got["nan"].s) and math.isnan(got["nan"].a)
    assert got["inf"].s == float("inf") and math.isnan(got["both"].s)
    assert got["none"].s is None and got["none"].a is None
    assert (got["ok"].s, got["ok"].a) == (1.5, 1.5)


def test_market_daily_with_a_close_that_is_no_number(spark):
    schema = "open_time timestamp, symbol string, market string, close double, volume double, quote_volume double, num_trades int"
    rows = [("BTCUSDT", "global", 1.0), ("BTCUSDT", "global", float("nan")), ("ETHUSDT", "global", 5.0)]
    df = spark.createDataFrame([(s, m, x) for s, m, x in rows], "symbol string, market string, close double")
    df = df.select(F.lit("2024-01-01 10:00:00").cast("timestamp").alias("open_time"), "symbol", "market", "close", F.lit(1.0).alias("volume"), F.lit(2.0).alias("quote_volume"), F.lit(3).alias("num_trades"))
    assert set(df.columns) == {x.split()[0] for x in schema.split(", ")}
    got = {r.coin: r.avg_price_usd for r in market.market_daily(df).collect()}
    assert len(got) == 2 and sorted(math.isnan(x) for x in got.values()) == [False, True]


def test_latest_row_of_a_null_key(spark):
    rows = [(None, 1, "a"), (None, 3, "b"), ("x", 2, "c"), ("x", 2, "d"), ("y", None, "e"), (None, None, "f")]
    df = spark.createDataFrame(rows, "symbol string, ts int, v string")
    got = {(r.symbol, r.ts, r.v) for r in joins.one_latest_by(df, ["symbol"], ["ts"]).collect()}
    assert got == {(None, 3, "b"), ("x", 2, "d"), ("y", None, "e")}
    assert {r.v for r in joins.latest_by(df, ["symbol"], "ts").collect()} == {"c", "d"}


def test_all_progress_reports_are_there(spark, tmp_path):
    path = str(tmp_path / "progress")
    log = progress.ProgressLog(keep=400, spark=spark, path=path)
    row = {"id": "q", "name": "n", "input_rows": 5, "input_rows_per_second": 1.0}
    for k in range(1500):
        log.add({**row, "batch_id": k})
    log.add({**row, "batch_id": 7, "input_rows": 9})  # the batch ran again
    assert len(log.rows) < 400
    log.flush()
    log.flush()
    rows = {r.batch_id: r.input_rows for r in progress.history(spark, path).collect()}
    assert len(rows) == 1500 and rows[7] == 9 and rows[8] == 5
    short = progress.ProgressLog(keep=3)
    for k in range(10):
        short.add({**row, "batch_id": k})
    assert [r["batch_id"] for r in short.rows] == [7, 8, 9]


def test_offsets_of_a_bounded_read():
    ends = {2: (5, 9), 0: (10, 13), 1: (7, 7)}
    assert events.bounded_offsets(ends, 5) == {0: (10, 13), 1: (7, 7), 2: (5, 7)}
    assert events.bounded_offsets(ends, 0) == {0: (10, 10), 1: (7, 7), 2: (5, 5)}
    assert events.bounded_offsets(ends, 99) == {0: (10, 13), 1: (7, 7), 2: (5, 9)}
    rnd = random.Random(2)
    for _ in range(50):
        ends = {p: (a := rnd.randrange(9), a + rnd.randrange(4)) for p in range(rnd.randrange(5))}
        limit = rnd.randrange(12)
        first = sorted((p, k) for p, (a, b) in ends.items() for k in range(a, b))[:limit]
        assert [(p, k) for p, (a, b) in events.bounded_offsets(ends, limit).items() for k in range(a, b)] == first


def test_options_of_topic_readers():
    options = events.topic_batch_options("broker:1", "t", 3, {0: (4, 6), 1: (0, 9)})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 4, "1": 0}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 6, "1": 1}}
    assert events.topic_batch_options("b", "t", 3) == {"kafka.bootstrap.servers": "b", "subscribe": "t", "startingOffsets": "earliest"}
    live = events.topic_options("b", "t", "earliest", "g")
    assert live["kafka.group.id"] == "g" and live["failOnDataLoss"] == "false" and "kafka.group.id" not in events.topic_options("b", "t")


def test_no_copies_for_distinct_counts(spark):
    tx = spark.createDataFrame([("TH", "US", 1.0, 1, 5), ("TH", None, 2.0, 0, None), (None, "US", None, 1, 7)], "sender_country string, receiver_country string, usd_amount double, is_suspicious int, risk_score int")
    for frame in (bi.stats(tx), bi.daily_report(tx, "2024-01-01", "x")):
        assert "Expand" not in (plan := frame._jdf.queryExecution().executedPlan().toString()) and plan.count("ExistingRDD") <= 1
    assert tuple(bi.stats(tx).first()) == (3, 3.0, 1.5, 1, 1)
    report = json.loads(bi.daily_report(tx, "2024-01-01", "x").first().report)
    assert report["transaction_summary"] == {"total_transactions": 3, "total_volume": 3.0, "avg_amount": 1.5, "sender_countries": 1, "receiver_countries": 1}
    assert [r["count"] for r in report["fraud_analysis"]] == [1, 2]
    assert json.loads(bi.daily_report(tx.where("1 = 0"), "d", "x").first().report)["transaction_summary"]["total_transactions"] == 0


def test_the_rest_imports_without_the_text_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') or k == 'pipeline' for k in e.queries()))"
    for gone in ("none", "corpus_pipeline.py"):
        if gone != "none":
            (copy / gone).unlink(missing_ok=True)
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
        assert done.stdout.split() == ["116", "116", "False"], done.stderr
