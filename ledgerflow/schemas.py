"""Declared schemas: the event, the flat tables, the market inputs, and table layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ledgerflow import fixed

TEXT, INT, LONG, SHORT = T.StringType(), T.IntegerType(), T.LongType(), T.ShortType()
REAL, FLOAT, TIME, DATE = T.DoubleType(), T.FloatType(), T.TimestampType(), T.DateType()
BYTES, TEXTS = T.BinaryType(), T.ArrayType(T.StringType())


def row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One superset of all event variants; every field is nullable.
EVENT = row(
    transaction_id=TEXT,
    timestamp=TIME,
    status=TEXT,
    sender=row(
        user_id=TEXT,
        account_type=TEXT,
        email=TEXT,
        country=TEXT,
        kyc_level=INT,
        preferred_crypto=TEXT,
        exchange=TEXT,
    ),
    receiver=row(
        user_id=TEXT,
        email=TEXT,
        country=TEXT,
        exchange=TEXT,
        kyc_level=INT,
        registration_date=DATE,
    ),
    transfer=row(
        crypto_symbol=TEXT,
        crypto_amount=REAL,
        usd_equivalent=REAL,
        thb_equivalent=REAL,
        exchange_rate_usd_thb=REAL,
        crypto_rate_usd=REAL,
    ),
    fees=row(fee_usd=REAL, fee_rate=REAL, fee_type=TEXT, fee_thb=REAL),
    network=row(network_type=TEXT, confirmation_blocks=INT, network_fee_usd=REAL),
    processing_time_minutes=INT,
    compliance=row(aml_score=REAL, risk_level=TEXT, flags=TEXTS, sanctions_check=TEXT),
    stream_metadata=row(producer_id=TEXT, generated_at=TIME, sequence_id=LONG, fraud_type=TEXT),
    fraud_pattern=row(
        pattern_type=TEXT,
        total_recipients_in_window=INT,
        time_window_minutes=INT,
        pattern_total_usd=REAL,
    ),
)

TOPIC = row(key=BYTES, value=BYTES, topic=TEXT, partition=INT, offset=LONG, timestamp=TIME)

ENVELOPE = row(
    _corrupt=TEXT,
    partition_key=TEXT,
    kafka_topic=TEXT,
    kafka_partition=INT,
    kafka_offset=LONG,
    kafka_timestamp=TIME,
    ingestion_timestamp=TIME,
    date_partition=TEXT,
    hour_partition=INT,
)
RAW_LAYER = T.StructType(EVENT.fields + ENVELOPE.fields)

# --- cleaned layer: what the cleaned rows look like when streamed again ---------
SILVER_LAYER = row(
    transaction_id=TEXT,
    transaction_timestamp=TIME,
    status=TEXT,
    sender_user_id=TEXT,
    sender_account_type=TEXT,
    sender_email=TEXT,
    sender_country=TEXT,
    sender_kyc_level=INT,
    sender_preferred_crypto=TEXT,
    receiver_user_id=TEXT,
    receiver_email=TEXT,
    receiver_country=TEXT,
    receiver_exchange=TEXT,
    receiver_kyc_level=INT,
    crypto_currency=TEXT,
    crypto_amount=REAL,
    usd_amount=REAL,
    thb_amount=REAL,
    exchange_rate_usd_thb=REAL,
    fee_usd=REAL,
    fee_rate=REAL,
    fee_type=TEXT,
    original_aml_score=REAL,
    original_risk_level=TEXT,
    kafka_topic=TEXT,
    kafka_partition=INT,
    kafka_offset=LONG,
    kafka_timestamp=TIME,
    ingestion_timestamp=TIME,
    date_partition=TEXT,
    hour_partition=INT,
    dq_transaction_id_valid=T.BooleanType(),
    dq_amount_valid=T.BooleanType(),
    dq_country_valid=T.BooleanType(),
    dq_currency_valid=T.BooleanType(),
    dq_status_valid=T.BooleanType(),
    dq_risk_level_valid=T.BooleanType(),
    data_quality_score=REAL,
    is_high_quality=T.BooleanType(),
    enhanced_fraud_score=REAL,
    is_cross_border=T.BooleanType(),
    transaction_category=TEXT,
    risk_category=TEXT,
    kyc_compliance_level=TEXT,
    silver_processing_timestamp=TIME,
    processing_date=DATE,
    event_date=DATE,
)

# --- flat tables ---------------------------------------------------------------
TRANSACTIONS = row(
    transaction_id=TEXT,
    timestamp=TIME,
    from_exchange=TEXT,
    to_exchange=TEXT,
    amount=REAL,
    currency=TEXT,
    is_suspicious=SHORT,
    risk_score=LONG,
    country=TEXT,
    account_type=TEXT,
    sender_user_id=TEXT,
    receiver_user_id=TEXT,
    crypto_currency=TEXT,
    fiat_amount=REAL,
    exchange_rate=REAL,
    transaction_type=TEXT,
    processing_time_ms=LONG,
    sender_country=TEXT,
    receiver_country=TEXT,
    sender_kyc_level=SHORT,
    receiver_kyc_level=SHORT,
    thb_equivalent=REAL,
    fee_usd=REAL,
    network_confirmations=SHORT,
    created_at=TIME,
)
PRICES = row(
    symbol=TEXT,
    price=REAL,
    timestamp=TIME,
    source=TEXT,
    volume_24h=REAL,
    price_change_24h=REAL,
    market_cap=REAL,
    created_at=TIME,
)
VOLUMES = row(
    exchange=TEXT,
    symbol=TEXT,
    daily_volume=REAL,
    daily_trades=LONG,
    timestamp=DATE,
    price_change_pct=REAL,
    created_at=TIME,
)
USERS = row(
    user_id=TEXT,
    account_type=TEXT,
    email=TEXT,
    country=TEXT,
    exchange=TEXT,
    kyc_level=SHORT,
    registration_date=DATE,
    risk_profile=TEXT,
    monthly_volume_usd=REAL,
    preferred_cryptos=TEXTS,
    created_at=TIME,
)
ALERTS = row(
    alert_id=TEXT,
    transaction_id=TEXT,
    user_id=TEXT,
    fraud_score=FLOAT,
    alert_type=TEXT,
    severity=TEXT,
    timestamp=TIME,
    details=TEXT,
    created_at=TIME,
)
MARKET_DAILY = row(
    date=DATE,
    coin=TEXT,
    market=TEXT,
    avg_price_thb=REAL,
    avg_price_usd=REAL,
    total_volume=REAL,
    total_quote_volume=REAL,
    total_trades=LONG,
)
MARKET_SUMMARY = T.StructType(
    row(date=DATE).fields
    + [
        T.StructField(f"{coin}_{metric}", LONG if metric == "trades_global" else REAL)
        for coin in fixed.PIVOT_COINS
        for metric in (
            "volume_global",
            "quote_volume_global",
            "price_usd",
            "price_thb",
            "trades_global",
        )
    ]
    + row(
        total_trading_volume_usd=REAL, total_trades=LONG, btc_dominance=REAL, eth_dominance=REAL
    ).fields
)
OFFSETS = row(topic=TEXT, partition=INT, end_offset=LONG, committed_offset=LONG)


@dataclass(frozen=True)
class TableSpec:
    """How a table is laid out: month folders of `month_of` and a sort inside each file."""

    schema: T.StructType
    sort_by: tuple[str, ...]
    month_of: str | None = None


TABLES = {
    "transactions": TableSpec(
        TRANSACTIONS, ("timestamp", "transaction_id", "sender_user_id"), "timestamp"
    ),
    "crypto_prices": TableSpec(PRICES, ("symbol", "timestamp")),
    "trading_volumes": TableSpec(VOLUMES, ("exchange", "symbol", "timestamp")),
    "user_accounts": TableSpec(USERS, ("user_id", "exchange")),
    "fraud_alerts": TableSpec(ALERTS, ("timestamp", "alert_id"), "timestamp"),
    "crypto_aggregates": TableSpec(MARKET_DAILY, ("date", "coin", "market"), "date"),
    "crypto_daily_summary": TableSpec(MARKET_SUMMARY, ("date",), "date"),
}
