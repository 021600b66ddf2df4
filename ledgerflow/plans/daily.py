"""The market job of one day: candles -> daily aggregates -> daily summary.

Both steps replace their day, so a day can be run again at any time. A scheduler only has to
pass the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.labels import coin_of_pair
from ledgerflow.functions.numbers import decimal_avg, decimal_sum
from ledgerflow.operators import market
from ledgerflow.sinks.batch import replace_date
from ledgerflow.sources.files import candle_path, read_candles, read_table

c = F.col

# The pairs the daily job reads.
GLOBAL_PAIRS = ("BTCUSDT", "ETHUSDT", "USDCUSDT")
TH_PAIRS = ("THB_BTC", "THB_ETH", "THB_USDT")


def day_candles(spark: SparkSession, raw: str, day: str) -> DataFrame | None:
    """The day's candle files of all pairs as one frame; pairs without a file are skipped."""
    frames = []
    for mkt, pairs in (("global", GLOBAL_PAIRS), ("th", TH_PAIRS)):
        rows = read_candles(spark, [candle_path(raw, mkt, p, day) for p in pairs])
        if rows is not None:
            frames.append(rows.withColumn("coin", coin_of_pair(c("symbol"), c("market"))))
    if not frames:
        return None
    return market.combine_markets(frames, day, F.current_timestamp())


def day_aggregates(candles: DataFrame) -> DataFrame:
    """The day's candles per coin and market."""
    have = set(candles.columns)
    quote = c("quote_volume") if "quote_volume" in have else F.lit(None).cast("double")
    trades = next((c(x) for x in ("num_trades", "trades") if x in have), F.lit(None))
    return candles.groupBy("date", "coin", "market").agg(
        decimal_avg(F.when(c("market") == "th", c("close"))).alias("avg_price_thb"),
        decimal_avg(F.when(c("market") == "global", c("close"))).alias("avg_price_usd"),
        decimal_sum(c("volume")).alias("total_volume"),
        decimal_sum(quote).alias("total_quote_volume"),
        F.sum(trades.cast("bigint")).alias("total_trades"),
    )


def run_day(spark: SparkSession, raw: str, lake: str, day: str) -> bool:
    """Replace the day in both market tables; False when no candle file exists."""
    candles = day_candles(spark, raw, day)
    if candles is None:
        return False
    aggregates = f"{lake}/crypto_aggregates"
    replace_date(day_aggregates(candles), aggregates)
    rows = read_table(spark, aggregates, day)
    replace_date(
        market.daily_dominance(market.coin_pivot(rows)), f"{lake}/crypto_daily_summary"
    )
    return True


def rebuild(spark: SparkSession, lake: str, as_of: str) -> None:
    """Recompute the whole daily summary from all stored aggregates, with the outlier cap."""
    daily = read_table(spark, f"{lake}/crypto_aggregates")
    cleaned = market.clean_market(daily, F.lit(as_of).cast("date"))
    replace_date(market.dominance(market.coin_pivot(cleaned)), f"{lake}/crypto_daily_full")
