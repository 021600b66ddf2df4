"""Market inputs: candles, price snapshots, volume comparisons, tickers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import fixed

c = F.col

# Positions in a 12-element candle and their types.
_CANDLE = (
    ("open_time", "ms"),
    ("open", "double"),
    ("high", "double"),
    ("low", "double"),
    ("close", "double"),
    ("volume", "double"),
    ("close_time", "ms"),
    ("quote_volume", "double"),
    ("num_trades", "int"),
    ("taker_buy_base", "double"),
    ("taker_buy_quote", "double"),
    ("ignore", "double"),
)


def parse_klines(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON arrays of 12-element arrays -> (typed candles, rejects with their text).

    Every answer leaves a trace: one that is no such array, or an empty one, is a reject as a whole.
    """

    def field(i: int, kind: str) -> Column:
        cell = F.try_element_at(c("cells"), F.lit(i + 1))
        if kind == "ms":
            return F.timestamp_millis(cell.try_cast("bigint"))
        return cell.try_cast(kind)

    keep = [x for x in df.columns if x != value]
    rows = df.select(
        *keep, c(value).alias("__text"), F.explode_outer(F.from_json(c(value), "array<array<string>>")).alias("cells")
    ).select(
        *keep, "__text", "cells", *[field(i, kind).alias(name) for i, (name, kind) in enumerate(_CANDLE)]
    )
    whole = F.lit(True)
    for name, _ in _CANDLE:
        whole = whole & c(name).isNotNull()
    bad = rows.where(~whole).select(*keep, F.coalesce(F.to_json("cells"), "__text").alias("raw"))
    return rows.where(whole).drop("cells", "__text"), bad


def parse_array_candles(df: DataFrame, last_only: bool = True) -> DataFrame:
    """Parallel arrays t,o,h,l,c,v of successful answers -> one row per candle, or the last one."""
    names = {"t": "t", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
    zipped = F.arrays_zip(*[c(x) for x in names])
    keep = [x for x in df.columns if x not in (*names, "s")]
    ok = df.where((c("s") == "ok") & (F.size("t") > 0))
    row = F.element_at(zipped, -1) if last_only else F.explode(zipped)
    return ok.select(*keep, row.alias("k")).select(
        *keep,
        (c("k.t").cast("bigint") * 1000).alias("timestamp"),
        *[c(f"k.{k}").cast("double").alias(n) for k, n in names.items() if k != "t"],
    )


def explode_prices(snapshots: DataFrame, as_of: Column) -> DataFrame:
    """Snapshot maps `prices` and `thb_pairs` -> one price row per symbol and source."""

    def rows(col: str, source: str) -> DataFrame:
        return snapshots.select(F.explode(col).alias("symbol", "price")).select(
            "symbol",
            c("price").cast("double").alias("price"),
            as_of.alias("timestamp"),
            F.lit(source).alias("source"),
            *[F.lit(0.0).alias(x) for x in ("volume_24h", "price_change_24h", "market_cap")],
        )

    world = rows("prices", fixed.GLOBAL_SOURCE)
    return world.unionByName(rows("thb_pairs", fixed.TH_SOURCE))


def compare_volumes(tickers: DataFrame, share: float = 0.1) -> DataFrame:
    """Ticker rows -> rows of the volume comparison; the local side is a share of the global."""
    return tickers.select(
        "symbol",
        F.struct(
            c("count").cast("bigint").alias("global_daily_trades"),
            c("volume").alias("global_daily_volume"),
            F.floor(c("count") * share).cast("bigint").alias("th_daily_trades"),
            (c("volume") * share).alias("th_daily_volume"),
            c("price_change").alias("price_change_24h"),
        ).alias("stats"),
    )


def unpivot_volumes(comparison: DataFrame, as_of: Column, column: str = "volume_comparison") -> DataFrame:
    """Map symbol -> statistics into two rows per symbol, one per exchange."""
    rows = comparison.select(F.explode(column).alias("symbol", "s"))

    def side(exchange: str, prefix: str) -> Column:
        return F.struct(
            F.lit(exchange).alias("exchange"),
            F.coalesce(c(f"s.{prefix}_daily_volume"), F.lit(0.0)).alias("daily_volume"),
            F.coalesce(c(f"s.{prefix}_daily_trades").cast("bigint"), F.lit(0)).alias("daily_trades"),
        )

    both = F.array(side(fixed.GLOBAL_EXCHANGE, "global"), side(fixed.TH_EXCHANGE, "th"))
    change = F.coalesce(c("s.price_change_24h"), F.lit(0.0))
    return rows.select("symbol", change.alias("price_change_pct"), F.inline(both)).select(
        "exchange",
        "symbol",
        "daily_volume",
        "daily_trades",
        as_of.cast("date").alias("timestamp"),
        "price_change_pct",
    )


_TICKER = (
    "array<struct<symbol: string, volume: string, quoteVolume: string, count: string, "
    "priceChangePercent: string>>"
)


def parse_ticker(df: DataFrame, n: int = 50, value: str = "value") -> DataFrame:
    """The first `n` entries of a day-statistics answer, typed."""
    return (
        df.select(F.posexplode(F.from_json(c(value), _TICKER)).alias("pos", "t"))
        .where(c("pos") < n)
        .select(
            c("t.symbol").alias("symbol"),
            c("t.volume").try_cast("double").alias("volume"),
            c("t.quoteVolume").try_cast("double").alias("quote_volume"),
            c("t.count").try_cast("bigint").alias("count"),
            c("t.priceChangePercent").try_cast("double").alias("price_change"),
        )
    )


def ticker_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """Answers without a single entry, with their text."""
    return df.where(F.coalesce(F.size(F.from_json(c(value), _TICKER)), F.lit(-1)) <= 0)


def listed_pairs(prices: DataFrame, pairs: Sequence[str] = fixed.THB_PAIRS) -> DataFrame:
    return prices.where(c("symbol").isin(*pairs))
