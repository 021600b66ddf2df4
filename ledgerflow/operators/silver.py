"""Cleaned layer: flatten the event, standardise, score and tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import scoring
from ledgerflow.functions.cleaning import known_country, known_currency, strip
from ledgerflow.operators.quality import DQ_FLAGS, QualityRules, quality_flags

# Column of the cleaned row and the place it comes from.
FLAT_COLUMNS = {
    "transaction_id": "transaction_id",
    "transaction_timestamp": "timestamp",
    "status": "status",
    "sender_user_id": "sender.user_id",
    "sender_account_type": "sender.account_type",
    "sender_email": "sender.email",
    "sender_country": "sender.country",
    "sender_kyc_level": "sender.kyc_level",
    "sender_preferred_crypto": "sender.preferred_crypto",
    "receiver_user_id": "receiver.user_id",
    "receiver_email": "receiver.email",
    "receiver_country": "receiver.country",
    "receiver_exchange": "receiver.exchange",
    "receiver_kyc_level": "receiver.kyc_level",
    "crypto_currency": "transfer.crypto_symbol",
    "crypto_amount": "transfer.crypto_amount",
    "usd_amount": "transfer.usd_equivalent",
    "thb_amount": "transfer.thb_equivalent",
    "exchange_rate_usd_thb": "transfer.exchange_rate_usd_thb",
    "fee_usd": "fees.fee_usd",
    "fee_rate": "fees.fee_rate",
    "fee_type": "fees.fee_type",
    "original_aml_score": "compliance.aml_score",
    "original_risk_level": "compliance.risk_level",
    "kafka_topic": "kafka_topic",
    "kafka_partition": "kafka_partition",
    "kafka_offset": "kafka_offset",
    "kafka_timestamp": "kafka_timestamp",
    "ingestion_timestamp": "ingestion_timestamp",
    "date_partition": "date_partition",
    "hour_partition": "hour_partition",
}
QUALITY_COLUMNS = (*DQ_FLAGS, "data_quality_score", "is_high_quality")
_STANDARD = {
    "sender_country": known_country,
    "receiver_country": known_country,
    "crypto_currency": known_currency,
}


def flatten_event(df: DataFrame) -> DataFrame:
    """31 flat columns, plus the quality columns when the input has them."""
    keep = [c for c in QUALITY_COLUMNS if c in df.columns]
    flat = [
        (F.upper(path) if name in _STANDARD else F.col(path)).alias(name)
        for name, path in FLAT_COLUMNS.items()
    ]
    # Upper case, then bare, then its code: a step of its own is computed once a row and not at each place
    # that uses it, and the method that a row runs through stays short enough for the JIT (8,000 bytes).
    bare = df.select(*flat, *keep).withColumns({name: strip(F.col(name)) for name in _STANDARD})
    return bare.withColumns({name: known(F.col(name)) for name, known in _STANDARD.items()})


def tag_rows(flat: DataFrame, tiered: bool = False) -> DataFrame:
    """Enhanced fraud score and the four tags derived from the row."""
    c = F.col
    score = scoring.enhanced_fraud_score(
        c("original_aml_score"),
        c("usd_amount"),
        c("sender_country"),
        c("receiver_country"),
        c("sender_kyc_level"),
        c("receiver_kyc_level"),
        tiered,
    )
    kyc = scoring.kyc_compliance_level(c("sender_kyc_level"), c("receiver_kyc_level"))
    return flat.withColumn("enhanced_fraud_score", score).withColumns(
        {
            "is_cross_border": c("sender_country") != c("receiver_country"),
            "transaction_category": scoring.transaction_category(c("usd_amount")),
            "risk_category": scoring.risk_category(c("enhanced_fraud_score")),
            "kyc_compliance_level": kyc,
        }
    )


def stamp(df: DataFrame, as_of: Column) -> DataFrame:
    """Processing time and day, given by the caller so that reruns agree."""
    return df.withColumns(
        {"silver_processing_timestamp": as_of, "processing_date": F.to_date(as_of)}
    )


def to_silver(raw: DataFrame, as_of: Column, rules: QualityRules = QualityRules()) -> DataFrame:
    """Raw layer to cleaned layer. Checks look at the values as they came in."""
    silver = tag_rows(flatten_event(quality_flags(raw, rules)))
    return stamp(silver, as_of).withColumn("event_date", F.to_date("transaction_timestamp"))
