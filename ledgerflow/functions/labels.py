"""Display labels and small lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow import fixed
from ledgerflow.functions.cleaning import lookup


def corridor(src: Column, dst: Column) -> Column:
    return F.concat(src, F.lit(" → "), dst)


def flow_direction(src: Column, dst: Column) -> Column:
    return F.concat(src, F.lit("_to_"), dst)


def account_category(account_type: Column) -> Column:
    return (
        F.when(account_type == "whale", "Whale")
        .when(account_type == "suspicious", "Suspicious")
        .otherwise("Regular")
    )


def status_label(is_suspicious: Column) -> Column:
    return F.when(is_suspicious == 1, "🚨 Suspicious").otherwise("✅ Normal")


def hour_class(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 23), "evening")
        .otherwise("night")
    )


def map_coin(symbol: Column, coins: Mapping[str, str] = fixed.SYMBOL_COINS) -> Column:
    """Coin of a traded pair; pairs outside the table are UNKNOWN."""
    return F.coalesce(lookup(symbol, coins), F.lit(fixed.UNKNOWN))


def coin_of_pair(symbol: Column, market: Column) -> Column:
    """Daily-job spelling: drop USDT from a global pair, take the part after THB_ otherwise."""
    return F.when(market == "global", F.replace(symbol, F.lit("USDT"), F.lit(""))).otherwise(
        F.try_element_at(F.split(symbol, "_"), F.lit(2))
    )


def market_of_symbol(symbol: Column) -> Column:
    return F.when(symbol.endswith("THB"), "th").otherwise("global")


def network_type(symbol: Column, networks: Mapping[str, str] = fixed.COIN_NETWORKS) -> Column:
    return F.coalesce(lookup(symbol, networks), F.lit(fixed.DEFAULT_NETWORK))
