"""Joins, each written so that no key is multiplied out or gathered.

Where the report aggregates after the join, the large side is aggregated to one row per key
first. The join then moves keys instead of transactions, and a hot key costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.numbers import SCORE, exact_sum, sum_units, units

c = F.col


def participants(tx: DataFrame, ids: Sequence[str] = ("sender_user_id", "receiver_user_id")) -> DataFrame:
    """One row per transaction and distinct participant; a self-transfer appears once."""
    others = [x for x in tx.columns if x not in ids]
    both = F.array_distinct(F.array(*[c(i) for i in ids]))
    return tx.select(*others, F.explode(both).alias("user_id")).where(c("user_id").isNotNull())


def users_tx_join(
    users: DataFrame,
    tx: DataFrame,
    ids: Sequence[str] = ("sender_user_id", "receiver_user_id"),
) -> DataFrame:
    """Accounts with the totals of all transactions they send or receive.

    Same rows as a left join on `id = sender OR id = receiver` followed by a grouping on the
    account: idle accounts stay, with count 0 and NULL sums. `user_id` is the account key.
    """
    mine = participants(
        tx.select(*ids, "transaction_id", "usd_amount", "risk_score", "is_suspicious"), ids
    )
    totals = mine.groupBy("user_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        exact_sum(c("usd_amount")).alias("total_volume"),
        F.try_divide(F.sum("risk_score").cast("double"), F.count("risk_score")).alias("avg_risk_score"),
        F.count_if(c("is_suspicious") == 1).alias("suspicious_count"),
    )
    return users.join(totals, "user_id", "left").na.fill(
        0, subset=["transaction_count", "suspicious_count"]
    )


def price_tx_join(prices: DataFrame, tx: DataFrame) -> DataFrame:
    """Price rows with the platform totals of their symbol; symbols without trades stay.

    Equals the row-level left join grouped by the price columns: equal price rows multiply
    the count and the sum, so the number of equal rows is applied as a factor.
    """
    quotes = prices.groupBy("symbol", "price_usd", "change_24h", "volume_24h").agg(
        F.count(F.lit(1)).alias("__rows")
    )
    traded = tx.groupBy(c("crypto_currency").alias("symbol")).agg(
        F.count("transaction_id").alias("__n"),
        sum_units(c("usd_amount")).alias("__usd"),
        F.count("usd_amount").alias("__usd_n"),
    )
    return (
        quotes.join(traded, "symbol", "left")
        .withColumns(
            {
                "platform_transactions": F.coalesce(c("__n") * c("__rows"), F.lit(0)),
                "platform_volume": (c("__usd") * c("__rows").cast("decimal(19,0)")).cast("double") / F.lit(100.0),
                "avg_amount": F.try_divide(c("__usd").cast("double") / F.lit(100.0), c("__usd_n")),
            }
        )
        .drop("__rows", "__n", "__usd", "__usd_n")
    )


def latest_by(df: DataFrame, keys: Sequence[str], ts: str, null_safe: bool = False) -> DataFrame:
    """All rows that carry their key's largest timestamp; ties are all kept. Rows with a NULL key or
    timestamp match nothing, as in SQL; with `null_safe` NULL is a key like others, and rows of a key
    that has no timestamp at all come out.

    The newest timestamp per key is found by a map-side aggregate; the semi join's right side
    has one row per key, and the optimiser broadcasts it only when its measured size allows.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    if not null_safe:
        return df.join(newest, [*keys, ts], "left_semi")
    names = {x: f"__newest_{x}" for x in (*keys, ts)}
    same = [c(x).eqNullSafe(c(y)) for x, y in names.items()]
    return df.join(newest.withColumnsRenamed(names), same, "left_semi")


def one_latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in `order`: `row_number() = 1` without sorting whole keys.

    The greatest first value of a key is found by a hash aggregate; only rows that carry it go on to
    the comparison of whole rows. A NULL key is a key like others.
    """
    df = latest_by(df, keys, order[0], null_safe=True)
    others = [x for x in df.columns if x not in keys and x not in order]
    last = Window.partitionBy(*keys).orderBy(*[F.desc(x) for x in (*order, *others)])
    return df.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank")


def with_share(df: DataFrame, part: str, total: DataFrame, name: str) -> DataFrame:
    """`part` as percent of the single value in `total` (a one-row, one-column frame)."""
    share = F.try_divide(c(part) * F.lit(100.0), total.scalar())
    return df.withColumn(name, F.round(share, 2))


def user_activity(
    tx: DataFrame, sender: str = "sender_user_id", receiver: str = "receiver_user_id"
) -> DataFrame:
    """Total and number of sent transactions for every id seen on either side.

    One pass: a receiving row contributes the id with nothing sent.
    """
    usd = units(c("usd_amount"))
    roles = F.array(
        F.struct(c(sender).alias("user_id"), usd.alias("usd"), F.lit(1).alias("sent")),
        F.struct(c(receiver).alias("user_id"), F.lit(0).cast("bigint").alias("usd"), F.lit(0).alias("sent")),
    )
    return (
        tx.select(F.inline(roles))
        .where(c("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            (F.sum("usd") / F.lit(100.0)).alias("total_transaction_volume"),
            F.sum("sent").alias("transaction_count"),
        )
    )


def sender_features(
    tx: DataFrame, night: Column | None = None, user: str = "sender_user_id"
) -> DataFrame:
    """One row per sender: counts, sums, distinct partners and the share of night transfers."""
    is_night = F.hour("event_ts") < 6 if night is None else night
    grouped = tx.groupBy(user).agg(
        F.count("transaction_id").alias("transaction_count"),
        exact_sum(c("usd_amount")).alias("total_sent"),
        F.max("usd_amount").alias("max_sent"),
        F.try_divide(
            F.sum(units(c("aml_score"), SCORE)) / F.lit(1e6), F.count("aml_score")
        ).alias("avg_aml_score"),
        F.count_if(c("is_suspicious") == 1).alias("suspicious_count"),
        F.count_if(is_night).alias("night_count"),
        F.countDistinct("receiver_user_id").alias("unique_receivers"),
        F.countDistinct("receiver_country").alias("receiver_countries"),
        F.countDistinct("crypto_currency").alias("currencies"),
    )
    n = c("transaction_count")
    return grouped.withColumns(
        {
            "avg_sent": F.try_divide(c("total_sent"), n),
            "night_share": F.try_divide(c("night_count"), n),
        }
    )
