"""User accounts taken from transactions, and account distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import units

c = F.col


def _mailbox(user: Column) -> Column:
    """First 8 characters of the second `_` part, or of the id when it has no `_`."""
    return F.substring(
        F.when(user.contains("_"), F.split(user, "_")[1]).otherwise(user), 1, 8
    )


def extract_users(
    tx: DataFrame,
    registration_date: Column,
    email_domain: str = "example.com",
    top: int = 3,
) -> DataFrame:
    """One account per id seen as sender or receiver.

    The attributes come from the first appearance in (time, transaction id, sender before
    receiver); a country missing on its side is taken from `country`, if there is such a column.
    Volume is all sent plus half of all received dollars; the coins are the ones of most volume,
    then by name. The earliest time and the sums are hash aggregates, so an account with very many
    transfers stays cheap; only the rows of the earliest time are compared in full.
    """
    cents = F.coalesce(units(c("usd_amount")), F.lit(0))
    risk = (
        F.when(c("is_suspicious") == 1, "high").when(c("risk_score") > 50, "medium").otherwise("low")
    )

    def role(n: int, side: str, exchange: str, home: str, weight: int) -> Column:
        return F.struct(
            c(f"{side}_user_id").alias("user_id"),
            F.lit(n).alias("role"),
            F.coalesce(c(f"{side}_country"), *([c("country")] if "country" in tx.columns else []), F.lit(home)).alias("country"),
            F.coalesce(c(f"{side}_kyc_level"), F.lit(2)).cast("bigint").alias("kyc_level"),
            F.coalesce(c(exchange), F.lit("Unknown")).alias("exchange"),
            (cents * F.lit(weight)).alias("half_cents"),
        )

    sides = F.array(
        role(0, "sender", "from_exchange", "US", 2), role(1, "receiver", "to_exchange", "TH", 1)
    )
    seen = (
        tx.select(
            "event_ts",
            "transaction_id",
            F.coalesce("account_type", F.lit("regular")).alias("account_type"),
            risk.alias("risk_profile"),
            F.coalesce("crypto_currency", F.lit("BTC")).alias("coin"),
            F.inline(sides),
        )
        .where(F.length("user_id") > 0)
    )
    per_coin = seen.groupBy("user_id", "coin").agg(
        F.sum("half_cents").alias("half_cents"), F.min("event_ts").alias("first_ts")
    )
    users = per_coin.groupBy("user_id").agg(
        F.min("first_ts").alias("first_ts"),
        F.sum("half_cents").alias("half_cents"),
        # One entry per coin of the user.
        F.sort_array(F.collect_list(F.struct((-c("half_cents")).alias("n"), "coin"))).alias("coins"),
    )
    own = ["account_type", "country", "kyc_level", "exchange", "risk_profile"]
    same = (c("s.user_id") == c("u.user_id")) & c("s.event_ts").eqNullSafe(c("u.first_ts"))
    at_first = seen.alias("s").join(users.alias("u"), same).select("u.*", "s.transaction_id", "s.role", *[f"s.{x}" for x in own])
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("transaction_id", "role", *own))
    return at_first.withColumn("__rank", rank).where("__rank = 1").select(
        "user_id",
        *own[:4],
        F.concat(_mailbox(c("user_id")), F.lit("@" + email_domain)).alias("email"),
        registration_date.alias("registration_date"),
        "risk_profile",
        F.round(c("half_cents") / F.lit(200.0), 2).alias("monthly_volume_usd"),
        F.slice("coins.coin", 1, top).alias("preferred_cryptos"),
    )


def account_distribution(users: DataFrame, k: int = 10) -> DataFrame:
    """The `k` largest groups of account type and country."""
    groups = users.groupBy("account_type", "country").agg(F.count(F.lit(1)).alias("user_count"))
    return groups.orderBy(F.desc("user_count"), "account_type", "country").limit(k)
