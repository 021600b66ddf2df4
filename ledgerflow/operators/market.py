"""Market batch: candles to daily aggregates, outlier cap, coin pivot, dominance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import fixed
from ledgerflow.functions.labels import map_coin
from ledgerflow.functions.numbers import decimal_avg, decimal_sum
from ledgerflow.operators.quality import fill_zero, valid_dates

c = F.col


def combine_markets(frames: Sequence[DataFrame], date: str, processed_at: Column) -> DataFrame:
    """One frame from the per-symbol frames of a day; columns are matched by name."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.withColumns({"date": F.lit(date).cast("date"), "processed_at": processed_at})


def market_daily(candles: DataFrame) -> DataFrame:
    """Per day, coin and market. Closing prices are baht on `th`, dollars on `global`.

    Prices and volumes are added at the exchanges' precision of 8 decimals.
    """

    def close_in(market: str) -> Column:
        return decimal_avg(F.when(c("market") == market, c("close")))

    return (
        candles.withColumns({"date": F.to_date("open_time"), "coin": map_coin(c("symbol"))})
        .groupBy("date", "coin", "market")
        .agg(
            close_in("th").alias("avg_price_thb"),
            close_in("global").alias("avg_price_usd"),
            decimal_sum(c("volume")).alias("total_volume"),
            decimal_sum(c("quote_volume")).alias("total_quote_volume"),
            F.sum(c("num_trades").cast("bigint")).alias("total_trades"),
        )
    )


def cap_outliers(
    df: DataFrame, cols: Sequence[str] = ("total_volume", "total_trades"), k: float = 3.0
) -> DataFrame:
    """Cap each column at mean + k sample deviations over all rows; NULL stays NULL.

    The thresholds are one scalar subquery: nothing is collected, and a table too small to
    have a deviation is left as it is.
    """
    bounds = [(F.avg(x) + F.lit(float(k)) * F.stddev(x)).alias(x) for x in cols]
    limits = df.agg(*bounds).select(F.struct(*cols)).scalar()
    capped = df.withColumn("__limits", limits)
    return capped.withColumns(
        {
            x: F.when(c(x).isNotNull(), F.least(c(x).cast("double"), c(f"__limits.{x}")))
            for x in cols
        }
    ).drop("__limits")


def clean_market(daily: DataFrame, as_of: Column) -> DataFrame:
    filled = fill_zero(daily, ["total_volume", "total_quote_volume", "total_trades"])
    return cap_outliers(valid_dates(filled, as_of))


def coin_pivot(daily: DataFrame, coins: Sequence[str] = fixed.PIVOT_COINS) -> DataFrame:
    """One row per day with five metrics per coin; there is one input row per day, coin, market."""

    def on(market: str, name: str) -> Column:
        return F.max(F.when(c("market") == market, c(name)))

    return (
        daily.groupBy("date")
        .pivot("coin", list(coins))
        .agg(
            on("global", "total_volume").alias("volume_global"),
            on("global", "total_quote_volume").alias("quote_volume_global"),
            on("global", "avg_price_usd").alias("price_usd"),
            on("th", "avg_price_thb").alias("price_thb"),
            on("global", "total_trades").alias("trades_global"),
        )
    )


def dominance(
    pivot: DataFrame, coins: Sequence[str] = fixed.PIVOT_COINS, zero_prices: bool = False
) -> DataFrame:
    """Totals over the coins and the share of the leading two; missing metrics count as 0.

    Missing prices stay NULL, or become 0 with `zero_prices`. Trade counts are whole numbers.
    """
    zero = [f"{x}_{m}" for x in coins for m in ("volume_global", "quote_volume_global")]
    if zero_prices:
        zero += [f"{x}_{m}" for x in coins for m in ("price_usd", "price_thb")]
    trades = {f"{x}_trades_global": F.coalesce(c(f"{x}_trades_global"), F.lit(0)) for x in coins}
    filled = fill_zero(pivot, zero).withColumns(trades)

    def total(metric: str) -> Column:
        return reduce(lambda a, b: a + b, (c(f"{x}_{metric}") for x in coins))

    usd = c("total_trading_volume_usd")

    def share(coin: str) -> Column:
        base = F.when(usd > 0, usd).otherwise(F.lit(1.0))
        return F.round(c(f"{coin}_quote_volume_global") / base * 100, 2)

    whole = {n: F.floor(n).cast("bigint") for n in (*trades, "total_trades")}
    return (
        filled.withColumns(
            {
                "total_trading_volume_usd": total("quote_volume_global"),
                "total_trades": total("trades_global"),
            }
        )
        .withColumns({f"{x.lower()}_dominance": share(x) for x in coins[:2]})
        .withColumns(whole)
    )


def daily_dominance(pivot: DataFrame, coins: Sequence[str] = fixed.PIVOT_COINS) -> DataFrame:
    """The daily job's variant: only quote volumes are filled, a day without volume has no share."""
    quote = [f"{x}_quote_volume_global" for x in coins]
    usd = c("total_trading_volume_usd")
    total = reduce(lambda a, b: a + b, (c(x) for x in quote))
    return (
        fill_zero(pivot, quote)
        .withColumn("total_trading_volume_usd", total)
        .withColumns(
            {
                f"{x.lower()}_dominance": F.round(
                    F.try_divide(c(f"{x}_quote_volume_global"), usd) * 100, 2
                )
                for x in coins[:2]
            }
        )
    )


def market_gold(
    candles: DataFrame, as_of: Column, coins: Sequence[str] = fixed.PIVOT_COINS
) -> DataFrame:
    """Candles to the daily summary, one lazy chain."""
    return dominance(coin_pivot(clean_market(market_daily(candles), as_of), coins), coins)
