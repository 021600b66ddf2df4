"""Alerts, velocity windows, round amounts, duplicates and consumer lag."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import fixed
from ledgerflow.functions import scoring
from ledgerflow.functions.numbers import units

c = F.col


def score_alerts(events: DataFrame, keep_all: bool = False) -> DataFrame:
    """Score nested events and keep the alerts; `keep_all` keeps every scored event."""
    aml, usd = c("compliance.aml_score"), c("transfer.usd_equivalent")
    scored = events.withColumn("fraud_score", scoring.alert_score(aml, usd)).withColumns(
        {
            "is_fraud_alert": scoring.is_alert(c("compliance.flags"), c("fraud_score")),
            "alert_type": scoring.alert_type(aml, usd, c("sender.kyc_level")),
        }
    )
    return scored if keep_all else scored.where(c("is_fraud_alert"))


def event_rule_inputs() -> scoring.RuleInputs:
    return scoring.RuleInputs(
        usd=c("transfer.usd_equivalent"),
        aml=c("compliance.aml_score"),
        country=c("sender.country"),
        kyc=c("sender.kyc_level"),
        symbol=c("transfer.crypto_symbol"),
    )


def rule_hit_counts(events: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Hits and dollars per rule; one pass, one row per rule."""
    usd = units(c("transfer.usd_equivalent"))
    aggs = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(rule).alias("hits"),
            (F.coalesce(F.sum(F.when(rule, usd)), F.lit(0)) / F.lit(100.0)).alias("usd_volume"),
        )
        for name, rule in rules.items()
    ]
    return events.agg(F.array(*aggs).alias("rows")).select(F.inline("rows"))


# --- windows ----------------------------------------------------------------------
@dataclass(frozen=True)
class VelocityRules:
    """High class: largest > `max_single`, total > `min_total`, receivers > `receivers`."""

    max_single: float = 30000
    min_total: float = 10000
    receivers: int = 5
    medium_risk: float = 70


@dataclass(frozen=True)
class RapidRules:
    """Many middling transfers: each >= `each`, total >= `total`, receivers >= `receivers`."""

    each: float = 9000
    total: float = 50000
    receivers: int = 8


def window_totals(
    tx: DataFrame,
    width: str = "1 minute",
    slide: str | None = None,
    watermark: str | None = None,
    ts: str = "event_ts",
) -> DataFrame:
    """Per sender and window: count, total, distinct receivers, mean risk, largest amount.

    Two steps, for batch and stream alike: first per (window, sender, receiver), then per
    (window, sender) counting the receivers. The distinct count is exact without a growing set
    in the state, and a hot sender is spread over its receivers before it is gathered.
    """
    if watermark is not None:
        tx = tx.withWatermark(ts, watermark)
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    pairs = tx.groupBy(span.alias("window"), "sender_user_id", "receiver_user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(units(c("usd_amount"))).alias("usd"),
        F.sum(c("risk_score").cast("bigint")).alias("risk"),
        F.count("risk_score").alias("risk_n"),
        F.max("usd_amount").alias("top"),
    )
    return (
        pairs.groupBy("window", "sender_user_id")
        .agg(
            F.sum("n").alias("transactions"),
            (F.sum("usd") / F.lit(100.0)).alias("total_amount"),
            F.count("receiver_user_id").alias("unique_receivers"),
            F.try_divide(F.sum("risk").cast("double"), F.sum("risk_n")).alias("avg_risk_score"),
            F.max("top").alias("max_single_transaction"),
        )
        .select(
            c("window.start").alias("window_start"),
            c("window.end").alias("window_end"),
            *["sender_user_id", "transactions", "total_amount", "unique_receivers"],
            *["avg_risk_score", "max_single_transaction"],
        )
    )


def classify_windows(totals: DataFrame, rules: VelocityRules = VelocityRules()) -> DataFrame:
    """Fraud class of each window whose total exceeds the threshold."""
    big = c("total_amount") > rules.min_total
    high = (c("max_single_transaction") > rules.max_single) & big
    high = high & (c("unique_receivers") > rules.receivers)
    label = (
        F.when(high, "HIGH_FRAUD_RISK")
        .when(c("avg_risk_score") > rules.medium_risk, "MEDIUM_FRAUD_RISK")
        .otherwise("LOW_RISK")
    )
    return totals.where(big).withColumn("fraud_classification", label)


def velocity_fraud(
    tx: DataFrame,
    width: str = "1 minute",
    slide: str | None = None,
    rules: VelocityRules = VelocityRules(),
    watermark: str | None = None,
) -> DataFrame:
    """Windows of the high class only."""
    classes = classify_windows(window_totals(tx, width, slide, watermark), rules)
    return classes.where(c("fraud_classification") == "HIGH_FRAUD_RISK")


def rapid_fire(
    tx: DataFrame,
    width: str = "5 minutes",
    slide: str | None = "1 minute",
    rules: RapidRules = RapidRules(),
    watermark: str | None = None,
) -> DataFrame:
    """Sliding windows in which one sender splits a large total over many receivers.

    In a stream only transfers of at least `rules.each` enter the state and move the watermark.
    """
    part = tx.where(c("usd_amount") >= rules.each)
    totals = window_totals(part, width, slide, watermark)
    return totals.where(
        (c("total_amount") >= rules.total) & (c("unique_receivers") >= rules.receivers)
    )


def round_amounts(
    tx: DataFrame,
    amounts: Sequence[float] | None = fixed.ROUND_AMOUNTS,
    multiple_of: float | None = None,
) -> DataFrame:
    """Transfers of exactly one of the listed amounts, or of a whole multiple of one."""
    usd = c("usd_amount")
    if multiple_of is not None:
        return tx.where((usd > 0) & (usd % F.lit(float(multiple_of)) == 0))
    return tx.where(usd.isin(*[float(a) for a in amounts]))


# --- duplicates ---------------------------------------------------------------------
def dedup(df: DataFrame, key: str = "transaction_id", watermark: str | None = None,
          ts: str = "event_ts", order: Sequence[str] | None = None) -> DataFrame:
    """One row per key.

    Stream: the first to arrive inside the watermark. Batch: the first in `order`, picked by a
    map-side aggregate, so a key with very many copies never meets in one task.
    """
    if df.isStreaming:
        if watermark is None:
            raise ValueError("a stream needs a watermark")
        return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
    rest = [x for x in df.columns if x != key]
    lead = list(order or [ts])
    fields = [*lead, *[x for x in rest if x not in lead]]
    best = F.min(F.struct(*fields)).alias("__row")
    return df.groupBy(key).agg(best).select(key, "__row.*").select(df.columns)


# --- consumer lag ---------------------------------------------------------------------
def lag_health(offsets: DataFrame) -> DataFrame:
    """Lag and colour per topic, with the overall lag and status on every row."""
    lag = F.greatest(F.lit(0), c("end_offset") - F.coalesce(c("committed_offset"), F.lit(0)))
    topics = offsets.groupBy("topic").agg(F.sum(lag).cast("bigint").alias("lag"))
    whole = F.sum("lag").over(Window.partitionBy())  # one row per topic
    color = F.when(c("lag") < 100, "green").when(c("lag") < 1000, "yellow").otherwise("red")
    status = (
        F.when(c("total_lag") < 500, "HEALTHY")
        .when(c("total_lag") < 2000, "WARNING")
        .otherwise("CRITICAL")
    )
    return topics.withColumns({"color": color, "total_lag": whole}).withColumn("status", status)
