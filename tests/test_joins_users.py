from pyspark.sql import functions as F

from ledgerflow.operators import joins, users
from ledgerflow.plans import bi

TX = (
    "transaction_id string, event_ts int, sender_user_id string, receiver_user_id string, "
    "usd_amount double, risk_score bigint, is_suspicious int, crypto_currency string, "
    "account_type string, sender_country string, receiver_country string, sender_kyc_level int, "
    "receiver_kyc_level int, from_exchange string, to_exchange string"
)


def tx(spark, *rows):
    base = ("BTC", "regular", "US", "TH", 2, 3, "G", "T")
    return spark.createDataFrame([tuple(r) + base[len(r) - 7 :] for r in rows], TX)


def sample(spark):
    return tx(
        spark,
        ("t1", 1, "u_1", "u_2", 10.0, 80, 1),
        ("t2", 2, "u_2", "u_2", 5.5, 10, 0),
        ("t3", 3, "u_1", "u_3", 2.25, None, 0),
        ("t4", 4, None, "u_3", 1.0, 60, 0),
    )


def test_or_join_counts_self_transfer_once_and_keeps_idle(spark):
    people = spark.createDataFrame([("u_1",), ("u_2",), ("u_3",), ("idle",)], "user_id string")
    rows = {r.user_id: r for r in joins.users_tx_join(people, sample(spark)).collect()}
    assert (rows["u_1"].transaction_count, rows["u_1"].total_volume) == (2, 12.25)
    assert (rows["u_2"].transaction_count, rows["u_2"].total_volume) == (2, 15.5)
    assert (rows["u_3"].transaction_count, rows["u_3"].avg_risk_score) == (2, 60.0)
    assert (rows["idle"].transaction_count, rows["idle"].total_volume) == (0, None)
    assert rows["idle"].suspicious_count == 0


def test_or_join_has_no_nested_loop(spark):
    people = spark.createDataFrame([("u_1",)], "user_id string")
    plan = joins.users_tx_join(people, sample(spark))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_price_join_multiplies_equal_quotes(spark):
    quotes = spark.createDataFrame(
        [("BTC", 1.0, 0.0, 9.0), ("BTC", 1.0, 0.0, 9.0), ("X", 2.0, 0.0, 9.0)],
        "symbol string, price_usd double, change_24h double, volume_24h double",
    )
    rows = {r.symbol: r for r in joins.price_tx_join(quotes, sample(spark)).collect()}
    assert (rows["BTC"].platform_transactions, rows["BTC"].platform_volume) == (8, 37.5)
    assert rows["BTC"].avg_amount == 18.75 / 4
    assert (rows["X"].platform_transactions, rows["X"].platform_volume) == (0, None)


def test_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, t int, v string"
    )
    assert sorted(r.v for r in joins.latest_by(df, ["k"], "t").collect()) == ["w", "y", "z"]
    assert sorted(r.v for r in joins.one_latest_by(df, ["k"], ["t"]).collect()) == ["w", "z"]


def test_user_activity(spark):
    rows = {r.user_id: (r[1], r[2]) for r in joins.user_activity(sample(spark)).collect()}
    assert rows == {"u_1": (12.25, 2), "u_2": (5.5, 1), "u_3": (0.0, 0)}


def test_share_sums_to_hundred(spark):
    parts = spark.createDataFrame([("a", 25.0), ("b", 75.0)], "k string, x double")
    out = joins.with_share(parts, "x", parts.agg(F.sum("x").alias("s")), "share")
    assert {r.k: r.share for r in out.collect()} == {"a": 25.0, "b": 75.0}


def test_extract_users_first_occurrence(spark):
    rows = tx(
        spark,
        # u_1 is a receiver first and a sender later; the earlier row wins.
        ("t2", 2, "u_1", "plainuserid", 10.0, 0, 1, "ETH", "whale", "SG", "JP", 1, 1, "G", "T"),
        ("t1", 1, "u_abcdefghijk_9", "u_1", 4.0, 51, 0, "BTC", "regular", "US", None, 2, None, None, "T"),
        # both roles in one row: the sender side counts as first.
        ("t3", 3, "u_4", "u_4", 2.0, 50, 0, "XRP", "regular", None, "TH", 3, 1, "G", "T"),
        ("t4", 4, "", None, 2.0, 50, 0, "XRP", "regular", None, "TH", 3, 1, "G", "T"),
        ("t5", 5, "u_4", "u_5", None, 50, 0, None, "regular", None, "TH", 3, 1, "G", "T"),
    )
    got = users.extract_users(rows, F.lit("2024-01-01").cast("date"), "mail.test").collect()
    by = {r.user_id: r for r in got}
    assert set(by) == {"u_1", "plainuserid", "u_abcdefghijk_9", "u_4", "u_5"}
    u1 = by["u_1"]
    assert (u1.country, u1.kyc_level, u1.exchange, u1.risk_profile) == ("TH", 2, "T", "medium")
    assert (u1.account_type, u1.monthly_volume_usd) == ("regular", 2.0 + 10.0)
    assert u1.preferred_cryptos == ["ETH", "BTC"]  # by volume
    assert by["u_abcdefghijk_9"].email == "abcdefgh@mail.test"
    assert by["u_abcdefghijk_9"].exchange == "Unknown"
    assert by["plainuserid"].email == "plainuse@mail.test"
    assert by["plainuserid"].risk_profile == "high"
    u4 = by["u_4"]
    assert (u4.country, u4.kyc_level, u4.monthly_volume_usd) == ("US", 3, 3.0)
    assert u4.preferred_cryptos == ["XRP", "BTC"]  # by volume
    assert by["u_5"].monthly_volume_usd == 0.0


def test_distribution_ties(spark):
    rows = spark.createDataFrame([("x", "B"), ("x", "A"), ("y", "A")], "account_type string, country string")
    got = [tuple(r) for r in users.account_distribution(rows, 2).collect()]
    assert got == [("x", "A", 1), ("x", "B", 1)]


def test_random_sample_is_seeded_and_bounded(spark, sf):
    from ledgerflow.sources import sample as views

    cols = ["transaction_id", "usd_amount", "risk_score", "account_type", "sender_country", "crypto_currency"]
    rows = views.tx(spark, sf, cols)
    first = bi.scatter_sample(rows, k=50, seed=7).collect()
    assert len(first) == 50 and all(r.volume_usd > 1000 for r in first)


def test_products_of_large_totals_and_many_quotes(spark):
    prices = spark.createDataFrame([("BTC", 1.0, 0.0, 0.0)] * 10, "symbol string, price_usd double, change_24h double, volume_24h double")
    tx = spark.createDataFrame([(f"t{k}", "BTC", 2e14) for k in range(100)], "transaction_id string, crypto_currency string, usd_amount double")
    row = joins.price_tx_join(prices, tx).first()
    assert (row.platform_transactions, row.platform_volume, row.avg_amount) == (1000, 2e17, 2e14)


def test_country_falls_back_to_the_row(spark):
    cols = (
        "transaction_id string, event_ts int, sender_user_id string, receiver_user_id string, usd_amount double, risk_score int, "
        "is_suspicious int, crypto_currency string, account_type string, sender_country string, receiver_country string, "
        "sender_kyc_level int, receiver_kyc_level int, from_exchange string, to_exchange string, country string"
    )
    rows = [("t1", 1, "a", "b", 1.0, 1, 0, "BTC", None, None, None, 1, 1, None, None, "SG"), ("t2", 2, "c", "d", 1.0, 1, 0, "BTC", None, None, "TH", 1, 1, None, None, None)]
    got = {r.user_id: r.country for r in users.extract_users(spark.createDataFrame(rows, cols), F.lit("2024-01-01").cast("date")).collect()}
    assert got == {"a": "SG", "b": "SG", "c": "US", "d": "TH"}


def test_no_whole_row_sort_for_latest_and_first(spark, sf):
    import __spark_entry__ as contract

    for key in ("m3_latest_prices", "user_accounts"):
        assert "SortAggregate" not in contract.queries()[key](spark, sf)._jdf.queryExecution().executedPlan().toString()
