"""The five aggregate tables over the cleaned layer.

All are plain batch functions. They group by `date_col`, the event date by default; pass
`processing_date` to group by the day the cleaning job ran. Sums are exact (see
`functions.numbers`), so a recomputed day equals the first computation bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.labels import flow_direction, hour_class
from ledgerflow.functions.numbers import FEE, SCORE, exact_avg, exact_sum, merged_state, percent, state_avg, state_sum, sum_state, units
from ledgerflow.functions.scoring import flow_risk_level

c = F.col


def _high_risk() -> Column:
    return F.count_if(c("risk_category") == "high_risk")


def _kyc(level: str) -> Column:
    return F.count_if(c("kyc_compliance_level") == level)


def _cross_border() -> Column:
    return F.count_if(c("is_cross_border"))


def _large() -> Column:
    return F.count_if(c("transaction_category") == "large")


def daily_summary(silver: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Per day, corridor and currency.

    Two distinct counts in one aggregation would send every row three times, with the state of all
    sums in each, and the states once more. Here a row is sent once, with its values, to its group;
    there it counts as its sender's (with the values) and as its receiver's, and each user of a group is
    one row of a hash aggregate, which may spill: no group is held as a list.
    """
    keys = [date_col, "sender_country", "receiver_country", "crypto_currency"]
    values = {
        "usd": c("usd_amount"),
        "fee": c("fee_usd"),
        "score": c("enhanced_fraud_score"),
        "counted": c("transaction_id").isNotNull(),
        "high": c("risk_category") == "high_risk",
        "border": c("is_cross_border"),
        "ok": c("kyc_compliance_level") == "compliant",
    }
    whole = silver.select(*keys, "sender_user_id", "receiver_user_id", *[x.alias(f"__{n}") for n, x in values.items()]).repartition(*keys)
    sends = c("__sends")
    rows = whole.withColumn("__sends", F.explode(F.array(F.lit(True), F.lit(False)))).select(
        *keys,
        sends,
        F.when(sends, c("sender_user_id")).otherwise(c("receiver_user_id")).alias("__user"),
        *[F.when(sends, c(f"__{n}")).alias(f"__{n}") for n in values],
    )
    states = {
        **sum_state("__usd", c("__usd")),
        **sum_state("__fee", c("__fee"), FEE),
        **sum_state("__score", c("__score"), SCORE),
        **{f"__{n}": F.count_if(c(f"__{n}")) for n in ("counted", "high", "border", "ok")},
        "__least": F.min("__usd"),
        "__most": F.max("__usd"),
    }
    users = rows.groupBy(*keys, "__sends", "__user").agg(*[x.alias(n) for n, x in states.items()])
    total = {n: x for name in ("__usd", "__fee", "__score") for n, x in merged_state(name).items()}
    known = c("__user").isNotNull()
    groups = users.groupBy(*keys).agg(
        *[x.alias(n) for n, x in total.items()],
        *[F.sum(f"__{n}").alias(f"__{n}") for n in ("counted", "high", "border", "ok")],
        F.min("__least").alias("__least"),
        F.max("__most").alias("__most"),
        F.count_if(sends & known).alias("__senders"),
        F.count_if(~sends & known).alias("__receivers"),
    )
    grouped = groups.select(
        *keys,
        c("__counted").alias("transaction_count"),
        state_sum("__usd").alias("total_usd_volume"),
        state_avg("__usd").alias("avg_transaction_amount"),
        c("__least").alias("min_transaction_amount"),
        c("__most").alias("max_transaction_amount"),
        state_sum("__fee", FEE).alias("total_fees_collected"),
        F.round(state_avg("__score", SCORE), 4).alias("avg_fraud_score"),
        c("__high").alias("high_risk_count"),
        c("__border").alias("cross_border_count"),
        c("__ok").alias("compliant_count"),
        c("__senders").alias("unique_senders"),
        c("__receivers").alias("unique_receivers"),
    )
    n = c("transaction_count")
    return grouped.withColumns(
        {
            "cross_border_percentage": percent(c("cross_border_count"), n),
            "high_risk_percentage": percent(c("high_risk_count"), n),
            "compliance_percentage": percent(c("compliant_count"), n),
            "aggregation_level": F.lit("daily"),
        }
    )


def country_flows(silver: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Per day and corridor."""
    src, dst = c("sender_country"), c("receiver_country")
    return (
        silver.groupBy(date_col, "sender_country", "receiver_country")
        .agg(
            F.count("transaction_id").alias("flow_transaction_count"),
            exact_sum(c("usd_amount")).alias("flow_total_volume"),
            exact_avg(c("usd_amount")).alias("flow_avg_amount"),
            exact_sum(c("fee_usd"), FEE).alias("flow_total_fees"),
            exact_avg(c("enhanced_fraud_score"), SCORE).alias("flow_avg_fraud_score"),
            F.countDistinct("crypto_currency").alias("currencies_used"),
            _large().alias("large_transactions"),
            F.max("usd_amount").alias("largest_transaction"),
        )
        .withColumns(
            {
                "flow_direction": flow_direction(src, dst),
                "is_domestic": src == dst,
                "flow_risk_level": flow_risk_level(c("flow_avg_fraud_score")),
            }
        )
    )


def _fraud_keys(date_col: str) -> list[str]:
    return [date_col, "risk_category", "sender_country", "receiver_country"]


def fraud_members(silver: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Every transaction id with the fraud group it belongs to, one row per id.

    This is the whole list behind `fraud_analytics`, kept as rows: a hot group stays spread
    over many tasks instead of becoming one array.
    """
    return silver.where(c("transaction_id").isNotNull()).select(
        *_fraud_keys(date_col), "transaction_id"
    )


def fraud_analytics(
    silver: DataFrame, date_col: str = "event_date", max_ids: int | None = None
) -> DataFrame:
    """Per day, risk class and corridor, with the group's share of its day.

    With `max_ids` (up to 1000), adds that many example ids, the smallest ones. The rank filter is
    pushed below the shuffle, so a task never receives more than `max_ids` ids per group and input
    partition. The whole list of ids is `fraud_members`.
    """
    if max_ids is not None and max_ids > 1000:
        raise ValueError("example ids are limited to 1000; fraud_members has all of them")
    keys = _fraud_keys(date_col)
    groups = silver.groupBy(*keys).agg(
        F.count("transaction_id").alias("risk_transaction_count"),
        exact_sum(c("usd_amount")).alias("risk_total_volume"),
        exact_avg(c("enhanced_fraud_score"), SCORE).alias("avg_enhanced_fraud_score"),
        exact_avg(c("original_aml_score"), SCORE).alias("avg_original_aml_score"),
        _kyc("non_compliant").alias("non_compliant_count"),
        _large().alias("large_amount_count"),
        F.countDistinct("sender_user_id").alias("unique_risk_senders"),
        F.countDistinct("receiver_user_id").alias("unique_risk_receivers"),
        F.max("enhanced_fraud_score").alias("max_fraud_score"),
    )
    day = F.sum("risk_transaction_count").over(Window.partitionBy(date_col))
    out = groups.withColumns(
        {
            "fraud_improvement": c("avg_enhanced_fraud_score") - c("avg_original_aml_score"),
            "risk_concentration": F.try_divide(c("risk_transaction_count"), day),
        }
    )
    if max_ids is None:
        return out
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("transaction_id"))
    examples = (
        fraud_members(silver, date_col)
        .withColumn("__rank", rank)
        .where(c("__rank") <= max_ids)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("transaction_id")).alias("sample_transaction_ids"))
    )
    match = [c(f"g.{k}").eqNullSafe(c(f"e.{k}")) for k in keys]
    return (
        out.alias("g")
        .join(examples.alias("e"), match, "left")
        .select("g.*", "e.sample_transaction_ids")
    )


def daily_kpis(silver: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Per day, without the day-over-day trends.

    Five exact distinct counts in one aggregation would copy every row six times. Here the
    three narrow ones (currencies, countries) are counted on the small day x corridor x
    currency table that also carries the partial sums; only the two user counts go over the
    rows, reading three columns.
    """
    grain = silver.groupBy(date_col, "sender_country", "receiver_country", "crypto_currency").agg(
        F.count("transaction_id").alias("n"),
        F.sum(units(c("usd_amount"))).alias("usd"),
        F.count("usd_amount").alias("usd_n"),
        F.sum(units(c("fee_usd"), FEE)).alias("fee"),
        F.sum(units(c("fee_rate"), SCORE)).alias("rate"),
        F.count("fee_rate").alias("rate_n"),
        F.sum(units(c("enhanced_fraud_score"), SCORE)).alias("score"),
        F.count("enhanced_fraud_score").alias("score_n"),
        _high_risk().alias("high"),
        _kyc("compliant").alias("ok"),
        _cross_border().alias("border"),
    )

    def total(name: str, scale: int) -> Column:
        return F.sum(c(name).cast("decimal(38,0)")).cast("double") / F.lit(float(10**scale))

    days = grain.groupBy(date_col).agg(
        F.sum("n").alias("daily_transaction_volume"),
        total("usd", 2).alias("daily_usd_volume"),
        F.try_divide(total("usd", 2), F.sum("usd_n")).alias("daily_avg_transaction_size"),
        total("fee", FEE).alias("daily_revenue"),
        F.try_divide(total("rate", SCORE), F.sum("rate_n")).alias("avg_fee_rate"),
        F.try_divide(total("score", SCORE), F.sum("score_n")).alias("daily_avg_fraud_score"),
        F.sum("high").alias("daily_high_risk_transactions"),
        F.sum("ok").alias("daily_compliant_transactions"),
        F.sum("border").alias("daily_cross_border_transactions"),
        F.countDistinct("crypto_currency").alias("currencies_traded"),
        F.countDistinct("sender_country").alias("countries_sending"),
        F.countDistinct("receiver_country").alias("countries_receiving"),
    )
    people = silver.groupBy(c(date_col).alias("__day")).agg(
        F.countDistinct("sender_user_id").alias("daily_active_senders"),
        F.countDistinct("receiver_user_id").alias("daily_active_receivers"),
    )
    n = c("daily_transaction_volume")
    return (
        days.join(people, c(date_col).eqNullSafe(c("__day")))
        .drop("__day")
        .withColumns(
            {
                "cross_border_rate": percent(c("daily_cross_border_transactions"), n),
                "compliance_rate": percent(c("daily_compliant_transactions"), n),
                "high_risk_rate": percent(c("daily_high_risk_transactions"), n),
                "revenue_per_transaction": F.round(F.try_divide(c("daily_revenue"), n), 4),
            }
        )
    )


def with_trends(days: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Day-over-day change of the mean size and growth of the count.

    The window has no partition key on purpose: its input is one row per day.
    """
    series = Window.orderBy(date_col)
    size, n = c("daily_avg_transaction_size"), c("daily_transaction_volume")
    before = F.lag(n, 1).over(series)
    return days.withColumns(
        {
            "avg_transaction_size_trend": size - F.lag(size, 1).over(series),
            "volume_growth_rate": percent(n - before, before, digits=None),
        }
    )


def business_kpis(silver: DataFrame, date_col: str = "event_date") -> DataFrame:
    return with_trends(daily_kpis(silver, date_col), date_col)


def hourly_trends(
    silver: DataFrame, ts_col: str = "transaction_timestamp", date_col: str = "event_date"
) -> DataFrame:
    """Per day and hour of day."""
    return (
        silver.groupBy(date_col, F.hour(ts_col).alias("transaction_hour"))
        .agg(
            F.count("transaction_id").alias("hourly_count"),
            exact_sum(c("usd_amount")).alias("hourly_volume"),
            exact_avg(c("enhanced_fraud_score"), SCORE).alias("hourly_avg_fraud_score"),
            F.countDistinct("sender_country").alias("hourly_countries"),
            exact_sum(c("fee_usd"), FEE).alias("hourly_revenue"),
        )
        .withColumn("hour_classification", hour_class(c("transaction_hour")))
    )


# Tables of the aggregated layer; the KPI table is stored without trends, because a changed
# day also changes the next day's trend. Apply `with_trends` when reading it.
GOLD_TABLES = {
    "transaction_summary": daily_summary,
    "country_flows": country_flows,
    "fraud_analytics": fraud_analytics,
    "fraud_members": fraud_members,
    "business_kpis": daily_kpis,
    "hourly_trends": lambda silver, date_col="event_date": hourly_trends(
        silver, date_col=date_col
    ),
}
