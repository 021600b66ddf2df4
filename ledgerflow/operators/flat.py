"""Flat rows: from nested events, from drifting layouts, with defaults, FX and routing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import fixed
from ledgerflow.functions.labels import network_type
from ledgerflow.functions.numbers import round_units

c = F.col


# --- names -------------------------------------------------------------------
# Other names under which a canonical column arrives, best first.
ALIASES = {
    "event_ts": ("event_ts", "transaction_timestamp", "timestamp"),
    "sender_user_id": ("sender_user_id", "sender_id", "user_id"),
    "receiver_user_id": ("receiver_user_id", "recipient_id", "receiver_id"),
    "sender_country": ("sender_country", "from_country", "country"),
    "receiver_country": ("receiver_country", "recipient_country", "to_country"),
    "usd_amount": ("usd_amount", "fiat_amount", "amount"),
    "crypto_currency": ("crypto_currency", "currency"),
    "aml_score": ("aml_score", "fraud_score"),
}
PRICE_ALIASES = {
    "price_usd": ("price_usd", "price"),
    "change_24h": ("change_24h", "price_change_24h", "percent_change_24h"),
    "last_updated": ("last_updated", "timestamp"),
}
VOLUME_ALIASES = {
    "trade_date": ("trade_date", "timestamp"),
    "volume_usd": ("volume_usd", "daily_volume"),
}


def rename_drift(df: DataFrame, aliases: Mapping[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """Give drifting layouts the canonical names; the first alias present wins, others stay."""
    found = {}
    for name, options in aliases.items():
        hit = next((o for o in options if o in df.columns), None)
        if hit and hit != name:
            found[name] = c(hit)
    out = df.withColumns(found) if found else df
    if "event_ts" in out.columns and "event_date" not in out.columns:
        out = out.withColumn("event_date", F.to_date("event_ts"))
    return out


# --- nested event to flat row --------------------------------------------------
def _text(path: str, default: str) -> Column:
    return F.coalesce(c(path), F.lit(default))


# The names and stand-in values of the columns below are fixed values: other jobs read these rows.
def to_flat_transaction(events: DataFrame, topic: Column, arrived: Column) -> DataFrame:
    """13-column row of an event; an unreadable time falls back to the arrival time."""
    risk = _text("compliance.risk_level", "low")
    when = c("timestamp")
    if dict(events.dtypes)["timestamp"] == "string":
        when = F.try_to_timestamp(when)
    return events.select(
        _text("transaction_id", "").alias("transaction_id"),
        _text("sender.user_id", "").alias("user_id"),
        F.coalesce(c("transfer.usd_equivalent"), F.lit(0.0)).alias("amount"),
        _text("transfer.crypto_symbol", "USD").alias("currency"),
        F.lit("crypto_transfer").alias("transaction_type"),
        _text("status", "unknown").alias("status"),
        F.coalesce(when, arrived).alias("timestamp"),
        _text("sender.country", "").alias("from_country"),
        _text("receiver.country", "").alias("to_country"),
        F.coalesce(c("compliance.aml_score"), F.lit(0.0)).alias("fraud_score"),
        risk.isin("medium", "high").alias("is_suspicious"),
        topic.alias("topic_source"),
        arrived.alias("created_at"),
    )


def to_alert_record(events: DataFrame, topic: Column, arrived: Column) -> DataFrame:
    """Alert row of every event on the alert topic or with an AML score over 0.7."""
    aml = F.coalesce(c("compliance.aml_score"), F.lit(0.0))
    tx = _text("transaction_id", "")
    details = F.to_json(F.struct(*[c(f"`{x}`") for x in events.columns]))
    return events.where((topic == fixed.TOPIC_ALERTS) | (aml > 0.7)).select(
        F.concat(F.lit("alert_"), tx).alias("alert_id"),
        tx.alias("transaction_id"),
        _text("sender.user_id", "").alias("user_id"),
        aml.cast("float").alias("fraud_score"),
        F.lit("fraud_detection").alias("alert_type"),
        F.when(aml > 0.8, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.coalesce(c("timestamp"), arrived).alias("timestamp"),
        details.alias("details"),
        arrived.alias("created_at"),
    )


# --- defaults ---------------------------------------------------------------------
# Column, type, then the places to look before the final default.
_DEFAULTS = (
    ("transaction_id", "string", (), ""),
    ("from_exchange", "string", (), fixed.GLOBAL_EXCHANGE),
    ("to_exchange", "string", (), fixed.TH_EXCHANGE),
    ("amount", "double", (), 0.0),
    ("currency", "string", (), "USDT"),
    ("is_suspicious", "short", (), 0),
    ("risk_score", "bigint", (), 0),
    ("country", "string", (), "US"),
    ("account_type", "string", (), "regular"),
    ("sender_user_id", "string", (), ""),
    ("receiver_user_id", "string", (), ""),
    ("crypto_currency", "string", ("currency",), "USDT"),
    ("fiat_amount", "double", (), 0.0),
    ("exchange_rate", "double", (), 1.0),
    ("transaction_type", "string", (), "cross_border_transfer"),
    ("processing_time_ms", "bigint", (), 1000),
    ("sender_country", "string", ("country",), "US"),
    ("receiver_country", "string", (), "TH"),
    ("sender_kyc_level", "short", (), 2),
    ("receiver_kyc_level", "short", (), 2),
    ("network_confirmations", "short", (), 6),
)


def apply_defaults(df: DataFrame, arrived: Column) -> DataFrame:
    """The 24 columns of a flat row, each from the input, a stand-in column or its default."""
    have = set(df.columns)

    def first(name: str, others: tuple[str, ...], to: str, last: Column) -> Column:
        options = [c(x).cast(to) for x in (name, *others) if x in have]
        return F.coalesce(*options, last.cast(to)).alias(name)

    cols = {n: first(n, others, to, F.lit(d)) for n, to, others, d in _DEFAULTS}
    fiat = F.coalesce(c("fiat_amount"), F.lit(0.0)) if "fiat_amount" in have else F.lit(0.0)
    cols["timestamp"] = first("timestamp", (), "timestamp", arrived)
    cols["thb_equivalent"] = first("thb_equivalent", (), "double", fiat * fixed.USD_THB_FLAT)
    cols["fee_usd"] = first("fee_usd", (), "double", fiat * fixed.MAKER_FEE)
    return df.select(*cols.values())


# --- amounts ------------------------------------------------------------------------
def rates_frame(
    spark: SparkSession, rates: Mapping[str, float] = fixed.COIN_USD_RATES
) -> DataFrame:
    """The price list as a frame, one row per coin, of a size the optimiser can see."""
    rows = [
        F.struct(F.lit(coin).alias("crypto_currency"), F.lit(rate).alias("coin_rate"))
        for coin, rate in rates.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def fx_enrich(
    df: DataFrame,
    rates: DataFrame,
    usd: str = "usd_amount",
    maker: Column | None = None,
    usd_thb: float = fixed.USD_THB,
) -> DataFrame:
    """Coin amount, baht amount and fees of a dollar amount; unknown coins give NULL amounts.

    The price list is an ordinary join: it is broadcast when its measured size allows.
    """
    coin, amount = c("crypto_currency"), c(usd)
    raw = amount / c("coin_rate")
    digits = F.when(coin.isin("BTC", "ETH"), F.round(raw, 8)).when(
        coin.isin(*fixed.STABLECOINS), F.round(raw, 2)
    )
    rate = F.lit(fixed.MAKER_FEE)
    kind = F.lit("maker")
    if maker is not None:
        rate = F.when(maker, rate).otherwise(fixed.TAKER_FEE)
        kind = F.when(maker, "maker").otherwise("taker")
    return (
        df.join(rates, "crypto_currency", "left")
        .withColumns(
            {
                "crypto_amount": digits.otherwise(F.round(raw, 6)),
                "thb_amount": F.round(amount * usd_thb, 2),
                "fee_rate": rate,
                "fee_type": kind,
                "fee_usd": F.round(amount * rate, 4),
                "fee_thb": F.round(amount * rate * usd_thb, 4),
            }
        )
        .drop("coin_rate")
    )


def flat_amounts(df: DataFrame, usd: str = "usd_amount") -> DataFrame:
    """Baht and fee of the flat model (35.1 baht, 0.1 % fee)."""
    return df.withColumns(
        {
            "thb_equivalent": round_units(c(usd) * fixed.USD_THB_FLAT),
            "fee_usd": round_units(c(usd) * fixed.MAKER_FEE, 4),
        }
    )


def with_network(df: DataFrame, networks: Mapping[str, str] = fixed.COIN_NETWORKS) -> DataFrame:
    return df.withColumn("network_type", network_type(c("crypto_currency"), networks))


# --- routing --------------------------------------------------------------------------
def route(
    df: DataFrame,
    risk_level: Column,
    country: Column,
    alert: Column | None = None,
) -> DataFrame:
    """Target topic and key of each event: alerts first, then by risk level."""
    topic = F.when(risk_level.isin("medium", "high"), fixed.TOPIC_SUSPICIOUS).otherwise(
        fixed.TOPIC_NORMAL
    )
    if alert is not None:
        topic = F.when(alert, fixed.TOPIC_ALERTS).otherwise(topic)
    return df.withColumns({"topic": topic, "key": country})
