"""The aggregate tables from partial states that can be added up.

A state is what a set of cleaned rows adds to a day: sums, counts, smallest and largest values at the
finest grain that the tables need, the distinct users at that grain as rows, and the ids of the
fraud groups. States of disjoint sets of rows are added up in any order and grouping, and the tables
follow from them exactly as from the rows (`operators.gold` computes the same from the rows). So a
new batch costs the batch and the states of its days, never the days' rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.labels import flow_direction, hour_class
from ledgerflow.functions.numbers import FEE, MONEY, SCORE, merged_state, percent, state_avg, state_sum, sum_state, units
from ledgerflow.functions.scoring import flow_risk_level
from ledgerflow.operators import gold

c = F.col

DAY = "event_date"
CORRIDOR = ["sender_country", "receiver_country"]
GRAIN = [DAY, *CORRIDOR, "crypto_currency", "risk_category", "transaction_hour"]
#: Measures with exact sums: column and decimals.
AMOUNTS = {"usd": ("usd_amount", MONEY), "fee": ("fee_usd", FEE), "score": ("enhanced_fraud_score", SCORE), "aml": ("original_aml_score", SCORE)}
#: Plain counts and unit sums, which are added up, and extremes.
ADDED = ("n", "usd_units", "fee_units", "rate_units", "rate_n", "score_units", "high", "ok", "not_ok", "border", "large")
LEAST, MOST = ("usd_min",), ("usd_max", "score_max")


def measures(silver: DataFrame, ts_col: str = "transaction_timestamp") -> DataFrame:
    """Partial sums per day, corridor, currency, risk class and hour."""
    rows = silver.withColumn("transaction_hour", F.hour(ts_col))
    states: dict[str, Column] = {}
    for name, (col, scale) in AMOUNTS.items():
        states |= sum_state(name, c(col), scale)
    states |= {
        "n": F.count("transaction_id"),
        "usd_units": F.sum(units(c("usd_amount"))),
        "fee_units": F.sum(units(c("fee_usd"), FEE)),
        "rate_units": F.sum(units(c("fee_rate"), SCORE)),
        "rate_n": F.count("fee_rate"),
        "score_units": F.sum(units(c("enhanced_fraud_score"), SCORE)),
        "high": F.count_if(c("risk_category") == "high_risk"),
        "ok": F.count_if(c("kyc_compliance_level") == "compliant"),
        "not_ok": F.count_if(c("kyc_compliance_level") == "non_compliant"),
        "border": F.count_if(c("is_cross_border")),
        "large": F.count_if(c("transaction_category") == "large"),
        "usd_min": F.min("usd_amount"),
        "usd_max": F.max("usd_amount"),
        "score_max": F.max("enhanced_fraud_score"),
    }
    return rows.groupBy(*GRAIN).agg(*[x.alias(name) for name, x in states.items()])


def people(silver: DataFrame) -> DataFrame:
    """The distinct users of each day, corridor, currency and risk class, by role."""
    both = F.array(
        F.struct(F.lit("sender").alias("role"), c("sender_user_id").alias("user_id")),
        F.struct(F.lit("receiver").alias("role"), c("receiver_user_id").alias("user_id")),
    )
    return silver.select(*GRAIN[:-1], F.inline(both)).where(c("user_id").isNotNull()).distinct()


def members(silver: DataFrame) -> DataFrame:
    return gold.fraud_members(silver, DAY)


STATES = {"measures": measures, "people": people, "members": members}


def added_up(name: str, state: DataFrame) -> DataFrame:
    """One state from several of the same kind."""
    if name == "measures":
        return _merged(state, GRAIN)
    return state.distinct() if name == "people" else state


def _merged(state: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    out: dict[str, Column] = {}
    for name in AMOUNTS:
        out |= merged_state(name)
    out |= {x: F.sum(x) for x in ADDED} | {x: F.min(x) for x in LEAST} | {x: F.max(x) for x in MOST}
    return state.groupBy(*keys).agg(*[x.alias(name) for name, x in out.items()], *more)


def _with_people(table: DataFrame, users: DataFrame, keys: Sequence[str], senders: str, receivers: str) -> DataFrame:
    """Add the numbers of distinct senders and receivers per key."""
    found = (
        users.select(*keys, "role", "user_id").distinct().groupBy(*[c(k).alias(f"__{k}") for k in keys])
        .agg(F.count_if(c("role") == "sender").alias(senders), F.count_if(c("role") == "receiver").alias(receivers))
    )
    same = [c(k).eqNullSafe(c(f"__{k}")) for k in keys]
    return table.join(found, same, "left").drop(*[f"__{k}" for k in keys]).na.fill(0, [senders, receivers])


def daily_summary(state: DataFrame, users: DataFrame) -> DataFrame:
    keys = [DAY, *CORRIDOR, "crypto_currency"]
    g = _with_people(_merged(state, keys), users, keys, "unique_senders", "unique_receivers")
    return g.select(
        *keys,
        c("n").alias("transaction_count"),
        state_sum("usd").alias("total_usd_volume"),
        state_avg("usd").alias("avg_transaction_amount"),
        c("usd_min").alias("min_transaction_amount"),
        c("usd_max").alias("max_transaction_amount"),
        state_sum("fee", FEE).alias("total_fees_collected"),
        F.round(state_avg("score", SCORE), 4).alias("avg_fraud_score"),
        c("high").alias("high_risk_count"),
        c("border").alias("cross_border_count"),
        c("ok").alias("compliant_count"),
        "unique_senders",
        "unique_receivers",
        percent(c("border"), c("n")).alias("cross_border_percentage"),
        percent(c("high"), c("n")).alias("high_risk_percentage"),
        percent(c("ok"), c("n")).alias("compliance_percentage"),
        F.lit("daily").alias("aggregation_level"),
    )


def country_flows(state: DataFrame, users: DataFrame) -> DataFrame:
    g = _merged(state, [DAY, *CORRIDOR], F.countDistinct("crypto_currency").alias("currencies_used"))
    mean = state_avg("score", SCORE)
    return g.select(
        DAY,
        *CORRIDOR,
        c("n").alias("flow_transaction_count"),
        state_sum("usd").alias("flow_total_volume"),
        state_avg("usd").alias("flow_avg_amount"),
        state_sum("fee", FEE).alias("flow_total_fees"),
        mean.alias("flow_avg_fraud_score"),
        "currencies_used",
        c("large").alias("large_transactions"),
        c("usd_max").alias("largest_transaction"),
        flow_direction(c("sender_country"), c("receiver_country")).alias("flow_direction"),
        (c("sender_country") == c("receiver_country")).alias("is_domestic"),
        flow_risk_level(mean).alias("flow_risk_level"),
    )


def fraud_analytics(state: DataFrame, users: DataFrame) -> DataFrame:
    keys = [DAY, "risk_category", *CORRIDOR]
    g = _with_people(_merged(state, keys), users, keys, "unique_risk_senders", "unique_risk_receivers")
    day = F.sum("n").over(Window.partitionBy(DAY))  # one row per group
    own, given = state_avg("score", SCORE), state_avg("aml", SCORE)
    return g.select(
        *keys,
        c("n").alias("risk_transaction_count"),
        state_sum("usd").alias("risk_total_volume"),
        own.alias("avg_enhanced_fraud_score"),
        given.alias("avg_original_aml_score"),
        c("not_ok").alias("non_compliant_count"),
        c("large").alias("large_amount_count"),
        "unique_risk_senders",
        "unique_risk_receivers",
        c("score_max").alias("max_fraud_score"),
        (own - given).alias("fraud_improvement"),
        F.try_divide(c("n"), day).alias("risk_concentration"),
    )


def daily_kpis(state: DataFrame, users: DataFrame) -> DataFrame:
    """Without the day-over-day trends."""
    distinct = [
        F.countDistinct(x).alias(name)
        for x, name in (("crypto_currency", "currencies_traded"), ("sender_country", "countries_sending"), ("receiver_country", "countries_receiving"))
    ]
    g = _with_people(_merged(state, [DAY], *distinct), users, [DAY], "daily_active_senders", "daily_active_receivers")

    def total(name: str, scale: int) -> Column:
        return c(name).cast("decimal(38,0)").cast("double") / F.lit(float(10**scale))

    n, revenue = c("n"), total("fee_units", FEE)
    return g.select(
        DAY,
        n.alias("daily_transaction_volume"),
        total("usd_units", MONEY).alias("daily_usd_volume"),
        F.try_divide(total("usd_units", MONEY), c("usd_n")).alias("daily_avg_transaction_size"),
        revenue.alias("daily_revenue"),
        F.try_divide(total("rate_units", SCORE), c("rate_n")).alias("avg_fee_rate"),
        F.try_divide(total("score_units", SCORE), c("score_n")).alias("daily_avg_fraud_score"),
        c("high").alias("daily_high_risk_transactions"),
        c("ok").alias("daily_compliant_transactions"),
        c("border").alias("daily_cross_border_transactions"),
        "currencies_traded",
        "countries_sending",
        "countries_receiving",
        "daily_active_senders",
        "daily_active_receivers",
        percent(c("border"), n).alias("cross_border_rate"),
        percent(c("ok"), n).alias("compliance_rate"),
        percent(c("high"), n).alias("high_risk_rate"),
        F.round(F.try_divide(revenue, n), 4).alias("revenue_per_transaction"),
    )


def hourly_trends(state: DataFrame, users: DataFrame) -> DataFrame:
    g = _merged(state, [DAY, "transaction_hour"], F.countDistinct("sender_country").alias("hourly_countries"))
    return g.select(
        DAY,
        "transaction_hour",
        c("n").alias("hourly_count"),
        state_sum("usd").alias("hourly_volume"),
        state_avg("score", SCORE).alias("hourly_avg_fraud_score"),
        "hourly_countries",
        state_sum("fee", FEE).alias("hourly_revenue"),
        hour_class(c("transaction_hour")).alias("hour_classification"),
    )


#: The tables that follow from measures and people; the ids behind the fraud groups are their own state.
TABLES = {
    "transaction_summary": daily_summary,
    "country_flows": country_flows,
    "fraud_analytics": fraud_analytics,
    "business_kpis": daily_kpis,
    "hourly_trends": hourly_trends,
}
