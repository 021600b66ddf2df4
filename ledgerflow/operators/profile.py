"""Summaries of a transfer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import exact_sum, percent

c = F.col


def transfer_summary(tx: DataFrame) -> DataFrame:
    """One row: totals, mean, suspicious share and time range."""
    sums = tx.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        exact_sum(c("usd_amount")).alias("total_volume_usd"),
        exact_sum(c("thb_amount")).alias("total_volume_thb"),
        F.count_if(c("risk_level").isin("medium", "high")).alias("suspicious_transactions"),
        F.min("event_ts").alias("earliest"),
        F.max("event_ts").alias("latest"),
    )
    n = c("total_transactions")
    return sums.withColumns(
        {
            "average_transaction_usd": F.round(F.try_divide(c("total_volume_usd"), n), 2),
            "fraud_rate": percent(c("suspicious_transactions"), n),
        }
    )


def counts_by(tx: DataFrame, col: str) -> DataFrame:
    return tx.groupBy(col).agg(F.count(F.lit(1)).alias("transaction_count"))


def summary_document(tx: DataFrame) -> DataFrame:
    """The summary with both breakdowns as one JSON text; coins and countries are short lists."""

    def breakdown(col: str) -> Column:
        pairs = F.map_from_entries(
            F.sort_array(F.collect_list(F.struct(F.coalesce(c(col), F.lit("")), "transaction_count")))
        )
        return counts_by(tx, col).agg(pairs.alias("m")).scalar()

    row = transfer_summary(tx)
    return row.select(
        F.to_json(
            F.struct(
                *[c(x) for x in row.columns],
                breakdown("crypto_currency").alias("crypto_distribution"),
                breakdown("sender_country").alias("country_distribution"),
            )
        ).alias("summary")
    )


def biz_totals(tx: DataFrame) -> DataFrame:
    out = tx.agg(
        exact_sum(c("usd_amount")).alias("total_usd"),
        exact_sum(c("thb_equivalent")).alias("total_thb"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.count("usd_amount").alias("__n"),
    )
    mean = F.try_divide(c("total_usd"), c("__n"))
    return out.withColumn("average_amount_usd", mean).drop("__n")


def top_currencies(tx: DataFrame, k: int = 5) -> DataFrame:
    counts = counts_by(tx, "crypto_currency")
    return counts.orderBy(F.desc("transaction_count"), "crypto_currency").limit(k)


def daily_volumes(tx: DataFrame) -> DataFrame:
    return tx.groupBy("event_date").agg(exact_sum(c("usd_amount")).alias("total_usd"))


def top_accounts(tx: DataFrame, role: str, k: int = 10) -> DataFrame:
    """The `k` ids of a role (sender_user_id, receiver_user_id) with the largest dollar sum."""
    sums = tx.groupBy(role).agg(
        exact_sum(c("usd_amount")).alias("total_usd"),
        F.count("transaction_id").alias("transaction_count"),
    )
    return sums.orderBy(F.desc("total_usd"), role).limit(k)


def fraud_overview(tx: DataFrame) -> DataFrame:
    flagged = c("is_suspicious") == 1
    out = tx.agg(
        F.count_if(flagged).alias("total_suspicious"),
        exact_sum(c("usd_amount"), where=flagged).alias("suspicious_volume_usd"),
        F.count_if(c("risk_score") > 70).alias("high_risk_transactions"),
        F.count(F.lit(1)).alias("__n"),
    )
    share = percent(c("total_suspicious"), c("__n"), digits=None)
    return out.withColumn("fraud_percentage", share).drop("__n")


def dataset_profile(
    df: DataFrame,
    usd: str = "usd_amount",
    country: str = "sender_country",
    ts: str = "event_ts",
    risk: str = "risk_level",
) -> DataFrame:
    """One row describing a dataset, all measures from a single pass.

    `column_types` and `null_counts` are maps keyed by column; write the row as JSON next to
    the dataset.
    """
    nulls = [F.count_if(c(f"`{x}`").isNull()).alias(f"__null_{i}") for i, x in enumerate(df.columns)]
    one = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(country).alias("unique_countries"),
        F.min(ts).alias("range_start"),
        F.max(ts).alias("range_end"),
        exact_sum(c(usd)).alias("total_volume_usd"),
        F.count_if(c(risk).isin("medium", "high")).alias("fraud_transactions"),
        *nulls,
    )
    types = [F.lit(x) for pair in df.dtypes for x in pair]
    by_column = [x for i, n in enumerate(df.columns) for x in (F.lit(n), c(f"__null_{i}"))]
    return one.select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.create_map(*types).alias("column_types"),
        F.create_map(*by_column).alias("null_counts"),
        *["unique_countries", "range_start", "range_end", "total_volume_usd"],
        "fraud_transactions",
    )
