import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.operators import market

DAILY = (
    "date date, coin string, market string, avg_price_thb double, avg_price_usd double, "
    "total_volume double, total_quote_volume double, total_trades bigint"
)
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def day(date, coin, mkt, quote=0.0, trades=0, volume=1.0, thb=None, usd=None):
    return (date, coin, mkt, thb, usd, volume, quote, trades)


def test_daily_prices_by_market(spark):
    rows = [
        ("2024-01-01 01:00:00", "BTCUSDT", "global", 10.0, 1.0, 5.0, 2),
        ("2024-01-01 09:00:00", "BTCUSDT", "global", 20.0, 2.0, None, 3),
        ("2024-01-01 09:00:00", "BTCTHB", "th", 700.0, 1.0, 1.0, 1),
        ("2024-01-01 09:00:00", "DOGEUSDT", "global", 1.0, 1.0, 1.0, 1),
    ]
    df = spark.createDataFrame(
        rows,
        "open_time string, symbol string, market string, close double, volume double, "
        "quote_volume double, num_trades int",
    ).withColumn("open_time", F.to_timestamp("open_time"))
    got = {(r.coin, r.market): r for r in market.market_daily(df).collect()}
    assert set(got) == {("BTC", "global"), ("BTC", "th"), ("UNKNOWN", "global")}
    g = got["BTC", "global"]
    assert (g.avg_price_usd, g.avg_price_thb, g.total_volume, g.total_trades) == (15.0, None, 3.0, 5)
    assert g.total_quote_volume == 5.0 and got["BTC", "th"].avg_price_thb == 700.0


def test_cap(spark):
    rows = [(float(i % 3),) for i in range(100)] + [(1000.0,), (None,)]
    df = spark.createDataFrame(rows, "total_volume double")
    s = df.agg(F.avg("total_volume").alias("m"), F.stddev("total_volume").alias("d")).first()
    got = [r[0] for r in market.cap_outliers(df, ["total_volume"]).collect()]
    assert max(x for x in got if x is not None) == s.m + 3.0 * s.d
    assert sum(x is None for x in got) == 1
    single = spark.createDataFrame([(5.0,)], "total_volume double")
    assert market.cap_outliers(single, ["total_volume"]).first()[0] == 5.0


def test_pivot_and_dominance(spark):
    df = spark.createDataFrame(
        [
            day(D1, "BTC", "global", 30.0, 3, usd=1.0),
            day(D1, "BTC", "th", 99.0, 9, thb=35.0),
            day(D1, "ETH", "global", 10.0, 1),
            day(D1, "UNKNOWN", "global", 500.0, 50),
            day(D2, "USDC", "th", 4.0, 4, thb=35.1),
        ],
        DAILY,
    )
    pivot = market.coin_pivot(df)
    assert "BTC_volume_global" in pivot.columns and "UNKNOWN_volume_global" not in pivot.columns
    rows = {r.date: r for r in market.dominance(pivot).collect()}
    a, b = rows[D1], rows[D2]
    assert (a.total_trading_volume_usd, a.total_trades) == (40.0, 4)
    assert (a.btc_dominance, a.eth_dominance) == (75.0, 25.0)
    assert (a.BTC_price_usd, a.BTC_price_thb, a.USDC_price_usd) == (1.0, 35.0, None)
    assert (b.total_trading_volume_usd, b.btc_dominance, b.total_trades) == (0.0, 0.0, 0)
    assert b.USDC_price_thb == 35.1 and b.BTC_trades_global == 0
    from ledgerflow.schemas import MARKET_SUMMARY

    types = {(f.name, f.dataType) for f in market.dominance(pivot).schema.fields}
    assert types == {(f.name, f.dataType) for f in MARKET_SUMMARY.fields}
    zero = {r.date: r for r in market.dominance(pivot, zero_prices=True).collect()}
    assert zero[D1].USDC_price_usd == 0.0


def test_clean_drops_future_and_missing_dates(spark):
    df = spark.createDataFrame(
        [day(D1, "BTC", "global", None), day(D2, "BTC", "global"), day(None, "BTC", "global")], DAILY
    )
    got = market.clean_market(df, F.lit("2024-01-01").cast("date")).collect()
    assert [r.date for r in got] == [D1] and got[0].total_quote_volume == 0.0


def test_combine_matches_by_name(spark):
    a = spark.sql("SELECT 1D AS close, 'A' AS symbol")
    b = spark.sql("SELECT 'B' AS symbol, 2D AS close, 7 AS extra")
    out = market.combine_markets([a, b], "2024-01-01", F.lit("x"))
    assert {(r.symbol, r.close, r.extra, r.date) for r in out.collect()} == {
        ("A", 1.0, None, D1),
        ("B", 2.0, 7, D1),
    }


def test_daily_variant_leaves_empty_days_without_share(spark):
    df = spark.createDataFrame([day(D2, "USDC", "th", 4.0)], DAILY)
    r = market.daily_dominance(market.coin_pivot(df)).first()
    assert (r.total_trading_volume_usd, r.btc_dominance, r.BTC_volume_global) == (0.0, None, None)


def test_day_job_is_repeatable(spark, tmp_path):
    from ledgerflow.plans import daily
    from ledgerflow.sources.files import candle_path

    raw, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    assert daily.run_day(spark, raw, lake, "2024-01-01") is False
    for d in ("2024-01-01", "2024-01-02"):
        spark.sql(
            "SELECT 1L AS open_time, 40000D AS close, 2D AS volume, 30D AS quote_volume, 3 AS trades"
        ).write.parquet(candle_path(raw, "global", "BTCUSDT", d))
        spark.sql("SELECT 1L AS timestamp, 1400000D AS close, 1D AS volume").write.parquet(
            candle_path(raw, "th", "THB_BTC", d)
        )
    spark.sql("SELECT 1L AS open_time, 2D AS close, 2D AS volume, 10D AS quote_volume, 1 AS trades").write.parquet(
        candle_path(raw, "global", "ETHUSDT", "2024-01-02")
    )
    for d in ("2024-01-01", "2024-01-02", "2024-01-02"):
        assert daily.run_day(spark, raw, lake, d)
    rows = {r.date: r for r in spark.read.parquet(f"{lake}/crypto_daily_summary").collect()}
    assert set(rows) == {D1, D2}
    assert (rows[D1].btc_dominance, rows[D2].btc_dominance, rows[D2].eth_dominance) == (100.0, 75.0, 25.0)
    assert rows[D1].BTC_price_thb == 1400000.0 and rows[D1].BTC_trades_global == 3
    daily.rebuild(spark, lake, "2024-01-01")
    full = spark.read.parquet(f"{lake}/crypto_daily_full").collect()
    assert [r.date for r in full] == [D1] and full[0].total_trades == 3


def test_prices_keep_eight_decimals(spark):
    rows = [("2024-01-01 01:00:00", "USDCUSDT", "global", 0.99985, 0.00431, 1e-8, 1), ("2024-01-01 02:00:00", "USDCUSDT", "global", 0.99982, 0.00372, 2e-8, 1)]
    schema = "open_time string, symbol string, market string, close double, volume double, quote_volume double, num_trades int"
    row = market.market_daily(spark.createDataFrame(rows, schema).withColumn("open_time", F.to_timestamp("open_time"))).first()
    assert (row.avg_price_usd, row.total_volume, row.total_quote_volume) == (0.999835, 0.00803, 3e-8)
