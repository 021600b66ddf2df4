import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import flat, fraud, gold
from ledgerflow.plans import bi

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
TX = (
    "transaction_id string, event_ts timestamp, sender_user_id string, receiver_user_id string, "
    "usd_amount double, risk_score bigint"
)


def burst(start, sender, amounts, risk=10, step=5):
    return [
        (f"{sender}-{i}", start + dt.timedelta(seconds=step * i), sender, f"r{i}", float(a), risk)
        for i, a in enumerate(amounts)
    ]


def test_velocity_thresholds(spark):
    rows = (
        burst(T0, "six", [30001, 1, 1, 1, 1, 1])  # 6 receivers: high
        + burst(T0, "five", [30001, 1, 1, 1, 1])  # only 5 receivers
        + burst(T0, "exact", [30000, 1, 1, 1, 1, 1])  # largest exactly 30000
        + burst(T0, "risky", [5000, 5001], risk=71)
        + burst(T0, "small", [5000, 5000], risk=99)  # total exactly 10000: dropped
    )
    got = {
        r.sender_user_id: r.fraud_classification
        for r in bi.window_fraud(spark.createDataFrame(rows, TX)).collect()
    }
    assert got == {
        "six": "HIGH_FRAUD_RISK",
        "five": "LOW_RISK",
        "exact": "LOW_RISK",
        "risky": "MEDIUM_FRAUD_RISK",
    }


def test_sliding_window_catches_what_tumbling_misses(spark):
    rows = burst(T0 + dt.timedelta(seconds=45), "s", [30001, 1, 1, 1, 1, 1])
    df = spark.createDataFrame(rows, TX)
    assert fraud.velocity_fraud(df).count() == 0
    slid = fraud.velocity_fraud(df, "1 minute", "30 seconds").collect()
    assert [r.window_start for r in slid] == [T0 + dt.timedelta(seconds=30)]
    assert slid[0].unique_receivers == 6


def test_window_edge_belongs_to_the_next_window(spark):
    df = spark.createDataFrame(burst(T0 + dt.timedelta(seconds=60), "s", [1.0]), TX)
    (r,) = fraud.window_totals(df).collect()
    assert (r.window_start, r.window_end) == (
        T0 + dt.timedelta(minutes=1),
        T0 + dt.timedelta(minutes=2),
    )


def test_repeated_receiver_counts_once(spark):
    rows = burst(T0, "s", [1, 2]) + [("x", T0, "s", "r0", 3.0, 10), ("y", T0, "s", None, 4.0, None)]
    (r,) = fraud.window_totals(spark.createDataFrame(rows, TX)).collect()
    assert (r.transactions, r.unique_receivers, r.total_amount) == (4, 2, 10.0)
    assert (r.avg_risk_score, r.max_single_transaction) == (10.0, 4.0)


def test_rapid_fire(spark):
    many = burst(T0, "split", [9000] * 8, step=30)
    few = burst(T0, "few", [9000] * 7, step=30)
    low = burst(T0, "low", [8999] * 9, step=20)
    got = fraud.rapid_fire(spark.createDataFrame(many + few + low, TX)).collect()
    assert {r.sender_user_id for r in got} == {"split"}


def test_round_amounts(spark):
    rows = burst(T0, "s", [10000, 10000.01, 25000, 30000, 0])
    df = spark.createDataFrame(rows, TX)
    assert sorted(r.usd_amount for r in fraud.round_amounts(df).collect()) == [10000.0, 25000.0]
    assert fraud.round_amounts(df, multiple_of=5000).count() == 3


def test_dedup_keeps_the_first(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")],
        "transaction_id string, event_ts int, v string",
    )
    assert sorted(r.v for r in fraud.dedup(df).collect()) == ["early", "only"]
    assert fraud.dedup(df).columns == df.columns


@pytest.mark.parametrize(
    ("ends", "status", "colors"),
    [
        ([99, 400], "HEALTHY", {"t0": "green", "t1": "yellow"}),
        ([100, 400], "WARNING", {"t0": "yellow", "t1": "yellow"}),
        ([1000, 1000], "CRITICAL", {"t0": "red", "t1": "red"}),
    ],
)
def test_lag(spark, ends, status, colors):
    rows = [(f"t{i}", 0, e + 7, 7) for i, e in enumerate(ends)] + [("t0", 1, 5, 9)]
    df = spark.createDataFrame(rows, "topic string, partition int, end_offset bigint, committed_offset bigint")
    got = fraud.lag_health(df).collect()
    assert {r.topic: r.color for r in got} == colors
    assert {r.status for r in got} == {status} and {r.total_lag for r in got} == {sum(ends)}


def test_lag_without_commit_counts_everything(spark):
    df = spark.createDataFrame(
        [("t", 0, 12, None)], "topic string, partition int, end_offset bigint, committed_offset bigint"
    )
    assert fraud.lag_health(df).first().lag == 12


def events(spark):
    return spark.sql(
        """SELECT id AS transaction_id, CAST('2024-01-01 00:00:00' AS timestamp) AS timestamp,
        'completed' AS status, struct('u' AS user_id, 'RU' AS country, kyc AS kyc_level) AS sender,
        struct('v' AS user_id, 'TH' AS country) AS receiver,
        struct(usd AS usd_equivalent, 'BTC' AS crypto_symbol) AS transfer,
        struct(aml AS aml_score, risk AS risk_level, flags AS flags) AS compliance
        FROM VALUES ('a', 1, 100001D, 0.1D, 'low', CAST(NULL AS ARRAY<STRING>)),
        ('b', 2, 10D, 0.1D, 'low', NULL), ('c', 1, 10D, 0.1D, 'low', array('high_amount')),
        ('d', 1, 10D, 0.1D, 'high', array()), ('e', 2, NULL, 0.81D, NULL, NULL)
        AS t(id, kyc, usd, aml, risk, flags)"""
    )


def test_alerts_drop_unknown(spark):
    got = {r.transaction_id: r.alert_type for r in fraud.score_alerts(events(spark)).collect()}
    assert got == {"a": "high_amount", "c": "low_kyc"}


def test_alert_records(spark):
    topic, now = F.lit("transactions-normal"), F.lit("2024-01-02").cast("timestamp")
    (r,) = flat.to_alert_record(events(spark), topic, now).collect()
    assert (r.alert_id, r.severity, r.alert_type) == ("alert_e", "HIGH", "fraud_detection")
    assert '"aml_score":0.81' in r.details
    everything = flat.to_alert_record(events(spark), F.lit("transactions-fraud-alerts"), now)
    assert everything.count() == 5


def test_flat_row_defaults(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    rows = events(spark).withColumn(
        "timestamp", F.when(F.col("transaction_id") == "a", "2024-01-01T00:00:00Z").otherwise("soon")
    )
    got = {r.transaction_id: r for r in flat.to_flat_transaction(rows, F.lit("t"), now).collect()}
    assert got["a"].timestamp == dt.datetime(2024, 1, 1) and got["b"].timestamp == dt.datetime(2024, 1, 2)
    assert got["e"].amount == 0.0 and got["e"].is_suspicious is False
    assert got["d"].is_suspicious is True


def test_route(spark):
    got = flat.route(events(spark), F.col("compliance.risk_level"), F.col("sender.country"))
    topics = {r.transaction_id: r.topic for r in got.collect()}
    assert topics["d"] == "transactions-suspicious" and topics["e"] == "transactions-normal"


def test_rename_drift(spark):
    row = spark.sql(
        "SELECT 'a' AS sender_id, 'b' AS recipient_id, 'US' AS country, 'TH' AS recipient_country, "
        "TIMESTAMP'2024-01-05 01:00:00' AS transaction_timestamp, 5D AS amount, 'BTC' AS currency"
    )
    out = flat.rename_drift(row).first()
    assert (out.sender_user_id, out.receiver_user_id, out.sender_country) == ("a", "b", "US")
    assert (out.receiver_country, out.usd_amount, str(out.event_date)) == ("TH", 5.0, "2024-01-05")
    price = spark.sql("SELECT 1D AS price, 2D AS price_change_24h")
    out = flat.rename_drift(price, flat.PRICE_ALIASES).first()
    assert (out.price_usd, out.change_24h) == (1.0, 2.0)
    volume = spark.sql("SELECT DATE'2024-01-01' AS timestamp, 3D AS daily_volume")
    assert flat.rename_drift(volume, flat.VOLUME_ALIASES).first().volume_usd == 3.0


def test_gold_members_and_examples_agree(spark, sf):
    from ledgerflow.plans.catalog import silver_tx

    silver = silver_tx(spark, sf)
    groups = gold.fraud_analytics(silver, max_ids=2)
    assert gold.fraud_members(silver).count() == silver.count()
    shares = groups.groupBy("event_date").agg(F.sum("risk_concentration").alias("s"))
    assert shares.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    sizes = groups.where(
        F.size("sample_transaction_ids") != F.least(F.lit(2), F.col("risk_transaction_count"))
    )
    assert sizes.count() == 0
    assert "sample_transaction_ids" not in gold.fraud_analytics(silver).columns
