"""The BI questions as DataFrame functions.

Inputs: `tx` (canonical flat transfers), `users`, `prices`, `volumes`, and a fixed `as_of`
moment instead of the clock. Every top list ends its sort key with the group key, so ties
always fall the same way. All text-and-number reports come from one pass over the transfers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import fixed
from ledgerflow.functions import labels, scoring
from ledgerflow.functions.numbers import (
    dollars,
    exact_avg,
    exact_sum,
    merged_state,
    percent,
    readable_quantity,
    state_avg,
    state_sum,
    sum_state,
    units,
    whole_units,
)
from ledgerflow.operators import joins
from ledgerflow.operators.fraud import VelocityRules, classify_windows, window_totals
from ledgerflow.operators.ordered import price_changes

c = F.col


def usd() -> Column:
    return c("usd_amount")


def risk() -> Column:
    return c("risk_score")


def flagged() -> Column:
    return c("is_suspicious") == 1


def n_rows() -> Column:
    return F.count(F.lit(1))


def avg_risk(digits: int | None = None) -> Column:
    mean = F.try_divide(F.sum(risk()).cast("double"), F.count(risk()))
    return mean if digits is None else F.round(mean, digits)


def suspicious() -> Column:
    return F.count_if(flagged())


def cross_border(tx: DataFrame) -> DataFrame:
    """Transfers whose two countries are known and differ."""
    return tx.where(c("sender_country") != c("receiver_country"))


def recent(ts: str, as_of: Column, interval: str) -> Column:
    """The last `interval` up to `as_of`, both ends included."""
    return c(ts).between(as_of - F.expr(f"INTERVAL {interval}"), as_of)


def recent_days(day: str, as_of: Column, days: int) -> Column:
    today = F.to_date(as_of)
    return c(day).between(F.date_sub(today, days), today)


def top(df: DataFrame, k: int, first: Sequence[str], then: Sequence[str]) -> DataFrame:
    """The first `k` rows by the `first` columns descending, ties by the `then` columns."""
    return df.orderBy(*[F.desc(x) for x in first], *then).limit(k)


# --- transfer questions -----------------------------------------------------------
def corridors(tx: DataFrame, k: int = 20) -> DataFrame:
    groups = cross_border(tx).groupBy("sender_country", "receiver_country")
    out = groups.agg(
        n_rows().alias("transaction_count"),
        exact_sum(usd()).alias("total_volume_usd"),
        exact_avg(usd()).alias("avg_transaction_size"),
        suspicious().alias("suspicious_count"),
        avg_risk(1).alias("avg_risk_score"),
    )
    return top(out, k, ["total_volume_usd"], ["sender_country", "receiver_country"])


def top_users(users: DataFrame, tx: DataFrame, k: int = 50) -> DataFrame:
    both = joins.users_tx_join(users, tx).select(
        "user_id", "account_type", "country", "exchange", "kyc_level", "monthly_volume_usd",
        "transaction_count", "total_volume", "avg_risk_score",
        F.array_join("preferred_cryptos", ",").alias("preferred_cryptos"),
    )
    return top(both, k, ["total_volume"], ["user_id"])


def latest_prices(prices: DataFrame, k: int = 20) -> DataFrame:
    rows = prices.select("symbol", "timestamp", "price", "volume_24h", "change_24h")
    last = joins.one_latest_by(rows, ["symbol"], ["timestamp"]).select(
        "symbol",
        F.round("price", 4).alias("current_price_usd"),
        F.round("volume_24h", 0).alias("volume_24h_usd"),
        F.round("change_24h", 2).alias("change_24h_percent"),
        c("timestamp").alias("last_updated"),
    )
    return top(last, k, ["volume_24h_usd"], ["symbol"])


def exchange_volumes(volumes: DataFrame) -> DataFrame:
    return volumes.groupBy(c("trade_date").alias("trading_date"), "exchange", "symbol").agg(
        exact_sum(c("volume_usd")).alias("daily_volume"),
        exact_avg(c("volume_usd")).alias("avg_volume"),
        n_rows().alias("trading_sessions"),
    ).orderBy(F.desc("trading_date"), F.desc("daily_volume"), "exchange", "symbol")


def fraud_patterns(tx: DataFrame, min_rows: int = 5, k: int = 100) -> DataFrame:
    keys = ["event_date", "sender_country", "receiver_country", "account_type"]
    out = (
        tx.groupBy(*keys)
        .agg(
            n_rows().alias("total_transactions"),
            suspicious().alias("suspicious_transactions"),
            exact_sum(usd()).alias("total_volume"),
            exact_sum(usd(), where=flagged()).alias("suspicious_volume"),
            avg_risk().alias("avg_risk_score"),
            F.max(risk()).alias("max_risk_score"),
        )
        .where(c("total_transactions") >= min_rows)
        .withColumn(
            "fraud_rate_percent", percent(c("suspicious_transactions"), c("total_transactions"))
        )
        .withColumnRenamed("event_date", "transaction_date")
    )
    return top(
        out, k, ["fraud_rate_percent", "total_volume"], ["transaction_date", *keys[1:]]
    )


def risky_senders(
    tx: DataFrame,
    as_of: Column,
    interval: str = "24 HOURS",
    min_rows: int = 3,
    min_risk: float = 50,
    k: int = 50,
) -> DataFrame:
    out = (
        tx.where(recent("event_ts", as_of, interval))
        .groupBy("sender_user_id", "sender_country")
        .agg(
            n_rows().alias("transactions_24h"),
            exact_sum(usd()).alias("volume_24h"),
            avg_risk().alias("avg_risk_score"),
            suspicious().alias("suspicious_count"),
            F.max("event_ts").alias("last_transaction"),
            F.countDistinct("crypto_currency").alias("currencies_used"),
        )
        .where((c("transactions_24h") >= min_rows) & (c("avg_risk_score") >= min_risk))
    )
    return top(out, k, ["avg_risk_score", "volume_24h"], ["sender_user_id", "sender_country"])


def _rows(one: DataFrame, rows: Sequence[tuple[str, dict[str, Column]]]) -> DataFrame:
    """A one-row frame turned into labelled rows."""
    cells = [
        F.struct(F.lit(label).alias("metric"), *[v.alias(n) for n, v in values.items()])
        for label, values in rows
    ]
    return one.select(F.inline(F.array(*cells)))


def _border() -> Column:
    return c("sender_country") != c("receiver_country")


def kpis(tx: DataFrame, users: DataFrame) -> DataFrame:
    """Five labelled counts with their volume; one pass per table."""
    money = lambda x: dollars(F.round(x, 0))
    t = tx.agg(
        n_rows().alias("n"),
        exact_sum(usd()).alias("usd"),
        F.count_if(_border()).alias("border_n"),
        exact_sum(usd(), where=_border()).alias("border_usd"),
        suspicious().alias("bad_n"),
        exact_sum(usd(), where=flagged()).alias("bad_usd"),
    )
    u = users.agg(n_rows().alias("n"), F.countDistinct("country").alias("countries"))
    named = lambda n, v: {"value": c(n), "volume": v}
    none = F.lit("N/A")
    return _rows(
        t,
        [
            ("Total Transactions", named("n", money(c("usd")))),
            ("Cross-Border Transfers", named("border_n", money(c("border_usd")))),
            ("Suspicious Transactions", named("bad_n", money(c("bad_usd")))),
        ],
    ).unionByName(
        _rows(
            u,
            [("Active Users", named("n", none)), ("Countries Served", named("countries", none))],
        )
    )


def flow_network(tx: DataFrame, min_rows: int = 10, k: int = 100) -> DataFrame:
    out = (
        cross_border(tx)
        .groupBy(c("sender_country").alias("source"), c("receiver_country").alias("target"))
        .agg(
            n_rows().alias("transaction_count"),
            exact_sum(usd()).alias("flow_volume"),
            exact_avg(usd()).alias("avg_amount"),
            avg_risk(1).alias("avg_risk"),
        )
        .where(c("transaction_count") >= min_rows)
    )
    return top(out, k, ["flow_volume"], ["source", "target"])


def price_vs_volume(
    prices: DataFrame, tx: DataFrame, as_of: Column, interval: str = "1 DAY"
) -> DataFrame:
    day = prices.where(recent("timestamp", as_of, interval))
    quotes = day.select(
        c("coin").alias("symbol"), c("price").alias("price_usd"), "change_24h", "volume_24h"
    )
    return (
        joins.price_tx_join(quotes, tx)
        .select(
            "symbol",
            F.round("price_usd", 4).alias("price"),
            F.round("change_24h", 2).alias("change_24h_percent"),
            c("volume_24h").alias("market_volume_24h"),
            "platform_transactions",
            "platform_volume",
            F.round("avg_amount", 2).alias("avg_transaction_size"),
        )
        .orderBy(F.desc("platform_volume"), "symbol", "price")
    )


# --- charts -----------------------------------------------------------------------
def corridor_bar(tx: DataFrame, k: int = 15) -> DataFrame:
    out = (
        cross_border(tx)
        .groupBy("sender_country", "receiver_country")
        .agg(
            n_rows().alias("transactions"),
            whole_units(exact_sum(usd())).alias("volume_usd"),
            F.round(exact_avg(usd()), 0).alias("avg_transaction"),
        )
        .select(
            labels.corridor(c("sender_country"), c("receiver_country")).alias("corridor"),
            *["transactions", "volume_usd", "avg_transaction"],
        )
    )
    return top(out, k, ["volume_usd"], ["corridor"])


def account_risk(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("account_type")
        .agg(
            n_rows().alias("total_transactions"),
            suspicious().alias("suspicious_transactions"),
            avg_risk(1).alias("avg_risk_score"),
            whole_units(exact_sum(usd())).alias("total_volume_usd"),
        )
        .withColumn(
            "fraud_rate_percent",
            percent(c("suspicious_transactions"), c("total_transactions"), 1),
        )
        .orderBy(F.desc("fraud_rate_percent"), "account_type")
    )


def top_assets(tx: DataFrame, k: int = 10) -> DataFrame:
    out = tx.groupBy(c("crypto_currency").alias("cryptocurrency")).agg(
        n_rows().alias("transaction_count"),
        whole_units(exact_sum(usd())).alias("volume_usd"),
        F.round(exact_avg(usd()), 0).alias("avg_amount"),
    )
    return top(out, k, ["volume_usd"], ["cryptocurrency"])


def country_totals(tx: DataFrame) -> DataFrame:
    """Sent and received per country; a `direction` column tells the two apart."""

    def side(col: str, name: str) -> Column:
        return F.struct(F.lit(name).alias("direction"), c(col).alias("country"))

    both = F.array(side("sender_country", "outgoing"), side("receiver_country", "incoming"))
    return (
        tx.select(usd(), F.inline(both))
        .groupBy("direction", "country")
        .agg(n_rows().alias("transactions"), whole_units(exact_sum(usd())).alias("volume"))
        .orderBy(F.desc("volume"), "direction", "country")
    )


def daily_trend(tx: DataFrame, k: int = 30) -> DataFrame:
    out = tx.groupBy(c("event_date").alias("transaction_date")).agg(
        n_rows().alias("daily_transactions"),
        whole_units(exact_sum(usd())).alias("daily_volume"),
        suspicious().alias("daily_suspicious"),
        avg_risk(1).alias("avg_daily_risk"),
    )
    return top(out, k, ["transaction_date"], [])


def user_table(users: DataFrame, tx: DataFrame, k: int = 20) -> DataFrame:
    out = joins.users_tx_join(users, tx).select(
        "user_id", "account_type", "country", "kyc_level", "transaction_count",
        whole_units(c("total_volume")).alias("total_volume_usd"),
        F.round("avg_risk_score", 1).alias("avg_risk_score"),
        "suspicious_count",
        F.array_join("preferred_cryptos", ", ").alias("preferred_cryptos"),
    )
    return top(out, k, ["total_volume_usd"], ["user_id"])


def price_tracker(
    prices: DataFrame, symbols: Sequence[str] = fixed.PRICE_TRACKER_SYMBOLS
) -> DataFrame:
    listed = prices.where(c("symbol").isin(*symbols))
    return (
        joins.latest_by(listed, ["symbol"], "timestamp")
        .select(
            "symbol",
            F.round("price", 6).alias("current_price"),
            F.round("change_24h", 2).alias("change_24h_percent"),
            c("source").alias("exchange"),
            c("timestamp").alias("last_updated"),
        )
        .orderBy(F.desc("current_price"), "symbol")
    )


def risk_alerts(
    tx: DataFrame,
    as_of: Column,
    interval: str = "7 DAYS",
    min_risk: float = 70,
    min_rows: int = 2,
    k: int = 25,
) -> DataFrame:
    out = (
        tx.where(recent("event_ts", as_of, interval) & (risk() >= min_risk))
        .groupBy("sender_user_id", "sender_country")
        .agg(
            n_rows().alias("recent_transactions"),
            whole_units(exact_sum(usd())).alias("total_volume"),
            avg_risk(1).alias("avg_risk_score"),
            suspicious().alias("suspicious_count"),
            F.max("event_ts").alias("last_transaction"),
            # At most one entry per listed coin.
            F.array_join(F.sort_array(F.collect_set("crypto_currency")), ", ").alias(
                "currencies_used"
            ),
        )
        .where(c("recent_transactions") >= min_rows)
        .withColumnsRenamed({"sender_user_id": "user_id", "sender_country": "country"})
    )
    return top(out, k, ["avg_risk_score", "total_volume"], ["user_id", "country"])


def cards(tx: DataFrame, users: DataFrame) -> DataFrame:
    """Eight labelled values as text."""
    money = lambda x: dollars(whole_units(x))
    text = lambda x: {"value": x.cast("string")}
    t = tx.agg(
        n_rows().alias("n"),
        exact_sum(usd()).alias("usd"),
        exact_sum(usd(), where=_border()).alias("border"),
        suspicious().alias("bad"),
        F.countDistinct("crypto_currency").alias("coins"),
        avg_risk(1).alias("risk"),
    )
    u = users.agg(n_rows().alias("n"), F.countDistinct("country").alias("countries"))
    return _rows(
        t,
        [
            ("Total Transactions", text(c("n"))),
            ("Total Volume (USD)", text(money(c("usd")))),
            ("Cross-Border Volume", text(money(c("border")))),
            ("Suspicious Transactions", text(c("bad"))),
            ("Crypto Assets", text(c("coins"))),
            ("Average Risk Score", text(c("risk"))),
        ],
    ).unionByName(
        _rows(u, [("Active Users", text(c("n"))), ("Countries Served", text(c("countries")))])
    )


def scatter_sample(
    tx: DataFrame, min_usd: float = 1000, k: int = 1000, seed: int | None = None
) -> DataFrame:
    """`k` rows over `min_usd`: in hash order, which repeats, or shuffled by `seed`."""
    order = F.md5("transaction_id") if seed is None else F.rand(seed)
    return (
        tx.where(min_usd < usd())
        .select(
            "transaction_id",
            usd().alias("volume_usd"),
            "risk_score",
            labels.account_category(c("account_type")).alias("account_category"),
            "sender_country",
            "crypto_currency",
        )
        .orderBy(order, "transaction_id")
        .limit(k)
    )


# --- dashboard --------------------------------------------------------------------
def overview(tx: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    active = recent_days("event_date", as_of, days)
    text = lambda x: {"value": x}
    t = tx.agg(
        exact_sum(usd()).alias("usd"),
        n_rows().alias("n"),
        F.countDistinct(F.when(active, c("sender_user_id"))).alias("users"),
        percent(suspicious(), F.count("is_suspicious")).alias("fraud"),
    )
    return _rows(
        t,
        [
            ("Total Transaction Volume", text(F.concat(F.lit("$"), readable_quantity(c("usd"))))),
            ("Total Transactions", text(c("n").cast("string"))),
            ("Active Users (30d)", text(c("users").cast("string"))),
            ("Fraud Rate", text(F.concat(F.format_string("%.2f", "fraud"), F.lit("%")))),
        ],
    )


def corridor_share(tx: DataFrame, k: int = 10) -> DataFrame:
    """Top corridors with their share of all cross-border volume.

    The denominator adds up the corridor rows, one per pair of countries, so the transfers are
    read once and the window without partition key sees only those few rows.
    """
    out = (
        cross_border(tx)
        .groupBy("sender_country", "receiver_country")
        .agg(
            n_rows().alias("transaction_count"),
            F.sum(units(usd())).alias("cents"),
            F.round(exact_avg(usd()), 2).alias("avg_amount"),
        )
        .withColumn("whole", F.sum("cents").over(Window.partitionBy()) / F.lit(100.0))
        .withColumn("usd", c("cents") / F.lit(100.0))
        .withColumn("share", F.round(F.try_divide(c("usd") * 100.0, c("whole")), 2))
    )
    return top(out, k, ["usd"], ["sender_country", "receiver_country"]).select(
        labels.corridor(c("sender_country"), c("receiver_country")).alias("corridor"),
        "transaction_count",
        F.concat(F.lit("$"), readable_quantity(c("usd"))).alias("total_volume"),
        "avg_amount",
        F.concat(F.format_string("%.2f", "share"), F.lit("%")).alias("volume_share"),
    )


def price_board(
    prices: DataFrame, symbols: Sequence[str] = fixed.PRICE_BOARD_SYMBOLS
) -> DataFrame:
    return (
        prices.where(c("coin").isin(*symbols))
        .select(
            c("coin").alias("symbol"),
            c("price").alias("current_price"),
            "volume_24h",
            c("change_24h").alias("percent_change_24h"),
            "market_cap",
            c("timestamp").alias("last_updated"),
        )
        .orderBy(F.desc("market_cap"), "symbol", "last_updated")
    )


def daily_volume(tx: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        tx.where(recent_days("event_date", as_of, days))
        .groupBy(c("event_date").alias("date"))
        .agg(n_rows().alias("transaction_count"), exact_sum(usd()).alias("total_volume"))
        .orderBy("date")
    )


def fraud_by_account(tx: DataFrame) -> DataFrame:
    fraud_usd = F.when(flagged(), usd()).otherwise(F.lit(0.0))
    return (
        tx.groupBy("account_type")
        .agg(
            n_rows().alias("total_transactions"),
            suspicious().alias("suspicious_transactions"),
            percent(suspicious(), F.count("is_suspicious")).alias("fraud_rate_percent"),
            F.round(exact_avg(fraud_usd), 2).alias("avg_fraud_amount"),
        )
        .orderBy(F.desc("fraud_rate_percent"), "account_type")
    )


def geography(tx: DataFrame, k: int = 15) -> DataFrame:
    out = tx.groupBy(c("sender_country").alias("country")).agg(
        n_rows().alias("transaction_count"),
        exact_sum(usd()).alias("total_volume"),
        F.countDistinct("sender_user_id").alias("unique_users"),
    )
    return top(out, k, ["total_volume"], ["country"])


def currency_volume(tx: DataFrame, k: int = 10) -> DataFrame:
    out = tx.groupBy(c("crypto_currency").alias("currency")).agg(
        n_rows().alias("transaction_count"),
        exact_sum(usd()).alias("total_volume"),
        F.round(exact_avg(usd()), 2).alias("avg_transaction_size"),
    )
    return top(out, k, ["total_volume"], ["currency"])


def hourly_fraud(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy(F.hour("event_ts").alias("hour_of_day"))
        .agg(
            n_rows().alias("total_transactions"),
            suspicious().alias("suspicious_count"),
            percent(suspicious(), F.count("is_suspicious"), 1).alias("fraud_rate_percent"),
        )
        .orderBy("hour_of_day")
    )


def high_value(tx: DataFrame, min_usd: float = 50000, k: int = 20) -> DataFrame:
    big = tx.where(min_usd <= usd())
    return top(big, k, ["usd_amount", "event_date"], ["transaction_id"]).select(
        "transaction_id",
        c("sender_user_id").alias("sender_id"),
        c("receiver_user_id").alias("recipient_id"),
        labels.corridor(c("sender_country"), c("receiver_country")).alias("corridor"),
        c("crypto_currency").alias("currency"),
        usd().alias("amount"),
        c("event_date").alias("transaction_date"),
        labels.status_label(c("is_suspicious")).alias("status"),
    )


def segments(users: DataFrame) -> DataFrame:
    return (
        users.groupBy("account_type")
        .agg(
            F.countDistinct("user_id").alias("user_count"),
            F.round(exact_avg(c("total_transaction_volume")), 2).alias("avg_user_volume"),
            F.round(
                F.try_divide(F.sum("transaction_count").cast("double"), F.count("transaction_count")), 2
            ).alias("avg_transactions_per_user"),
            F.max("total_transaction_volume").alias("max_user_volume"),
        )
        .orderBy(F.desc("avg_user_volume"), "account_type")
    )


def exchange_comparison(volumes: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        volumes.where(recent_days("trade_date", as_of, days))
        .groupBy("exchange")
        .agg(
            exact_sum(c("volume_usd")).alias("total_volume_usd"),
            F.sum("daily_trades").alias("total_trades"),
            F.round(exact_avg(c("avg_trade_size"), 6), 2).alias("avg_trade_size"),
            F.countDistinct("symbol").alias("symbols_traded"),
        )
        .orderBy(F.desc("total_volume_usd"), "exchange")
    )


def risk_buckets(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy(scoring.risk_bucket(risk()).alias("risk_category"))
        .agg(
            n_rows().alias("transaction_count"),
            F.round(exact_avg(usd()), 2).alias("avg_amount"),
            exact_sum(usd()).alias("total_volume"),
        )
        .orderBy(F.desc("avg_amount"), "risk_category")
    )


# --- exchange-pair questions ---------------------------------------------------------
def between(
    tx: DataFrame, src: str = fixed.GLOBAL_EXCHANGE, dst: str = fixed.TH_EXCHANGE
) -> DataFrame:
    return tx.where((c("from_exchange") == src) & (c("to_exchange") == dst))


def monthly_volume(tx: DataFrame, as_of: Column, months: int = 6) -> DataFrame:
    return (
        between(tx)
        .where(recent("event_ts", as_of, f"{months} MONTHS"))
        .groupBy(
            F.date_format("event_ts", "yyyyMM").cast("int").alias("month"),
            c("crypto_currency").alias("currency"),
        )
        .agg(
            n_rows().alias("transaction_count"),
            exact_sum(usd()).alias("total_usd_volume"),
            exact_sum(c("thb_equivalent")).alias("total_thb_volume"),
            exact_avg(usd()).alias("avg_transaction_usd"),
        )
        .orderBy(F.desc("month"), F.desc("total_usd_volume"), "currency")
    )


def pair_accounts(tx: DataFrame, k: int = 10) -> DataFrame:
    keys = ["sender_user_id", "account_type", "sender_country"]
    out = between(tx).groupBy(*keys).agg(
        n_rows().alias("transaction_count"),
        exact_sum(usd()).alias("total_volume_usd"),
        exact_avg(usd()).alias("avg_transaction_usd"),
        F.max(usd()).alias("max_transaction_usd"),
        avg_risk().alias("avg_risk_score"),
    )
    return top(out, k, ["total_volume_usd"], keys)


def price_series(
    prices: DataFrame,
    suffix: str = "THB",
    sources: Sequence[str] = (fixed.GLOBAL_SOURCE, fixed.TH_SOURCE),
    order: Sequence[str] = ("timestamp", "source", "price"),
) -> DataFrame:
    """Every quote of the listed pairs with its predecessor and the change in percent."""
    rows = prices.where(c("source").isin(*sources) & c("symbol").endswith(suffix))
    rows = rows.select("symbol", "source", "price", "timestamp")
    return price_changes(rows, "symbol", order).orderBy("symbol", F.desc("timestamp"), "source")


def trade_counts(volumes: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return (
        volumes.where(recent_days("trade_date", as_of, days))
        .select(
            "exchange",
            "symbol",
            c("trade_date").alias("date"),
            c("daily_trades").alias("transaction_count"),
            "daily_volume",
            "price_change_pct",
        )
        .orderBy("exchange", "symbol", F.desc("date"))
    )


def pair_senders(tx: DataFrame, k: int = 5) -> DataFrame:
    out = (
        between(tx)
        .groupBy("sender_user_id", "sender_country", "account_type", "sender_kyc_level")
        .agg(
            n_rows().alias("send_count"),
            exact_sum(usd()).alias("total_sent_usd"),
            F.countDistinct("receiver_user_id").alias("unique_receivers"),
            avg_risk().alias("avg_risk_score"),
        )
        .withColumnsRenamed(
            {"sender_user_id": "user_id", "sender_country": "country", "sender_kyc_level": "kyc_level"}
        )
    )
    return top(out, k, ["total_sent_usd"], ["user_id", "country", "account_type", "kyc_level"])


def pair_receivers(tx: DataFrame, k: int = 5) -> DataFrame:
    out = (
        between(tx)
        .groupBy("receiver_user_id", "receiver_country", "receiver_kyc_level")
        .agg(
            n_rows().alias("receive_count"),
            exact_sum(usd()).alias("total_received_usd"),
            F.countDistinct("sender_user_id").alias("unique_senders"),
            avg_risk().alias("avg_risk_score"),
        )
        .withColumnsRenamed(
            {"receiver_user_id": "user_id", "receiver_country": "country", "receiver_kyc_level": "kyc_level"}
        )
    )
    return top(out, k, ["total_received_usd"], ["user_id", "country", "kyc_level"])


def window_fraud(
    tx: DataFrame,
    as_of: Column | None = None,
    interval: str = "1 DAY",
    width: str = "1 minute",
    rules: VelocityRules = VelocityRules(),
) -> DataFrame:
    """Fraud class per sender and window, of the last `interval` or of everything."""
    rows = tx if as_of is None else tx.where(recent("event_ts", as_of, interval))
    return classify_windows(window_totals(rows, width), rules).orderBy(
        F.desc("fraud_classification"), F.desc("total_amount"), "sender_user_id", "window_start"
    )


def high_value_alert(
    tx: DataFrame, as_of: Column, interval: str = "1 HOUR", min_usd: float = 50000
) -> DataFrame:
    return tx.where(recent("event_ts", as_of, interval) & (min_usd < usd())).agg(
        n_rows().alias("high_value_transactions"), exact_sum(usd()).alias("total_value_usd")
    )


# --- daily report and checks -----------------------------------------------------------
def _countries(col: str) -> Column:
    """How many countries occur. The set is bounded by the countries there are, so it is kept in the
    aggregate; several distinct counts would copy every row."""
    return F.size(F.collect_set(col)).cast("bigint")


def stats(tx: DataFrame) -> DataFrame:
    return tx.agg(
        n_rows().alias("total_transactions"),
        exact_sum(usd()).alias("total_volume"),
        exact_avg(usd()).alias("avg_amount"),
        _countries("sender_country").alias("sender_countries"),
        _countries("receiver_country").alias("receiver_countries"),
    )


def fraud_split(tx: DataFrame) -> DataFrame:
    return tx.groupBy("is_suspicious").agg(
        n_rows().alias("count"), avg_risk().alias("avg_risk_score"), exact_sum(usd()).alias("total_volume")
    )


def daily_report(tx: DataFrame, date: str, generated_at: str) -> DataFrame:
    """Statistics and fraud split as one JSON document, from one pass: the few rows of the split carry
    what the statistics need."""
    seen = ("sender_country", "receiver_country")
    split = tx.groupBy("is_suspicious").agg(
        n_rows().alias("n"),
        *[x.alias(name) for name, x in sum_state("usd", usd()).items()],
        avg_risk().alias("avg_risk_score"),
        *[F.collect_set(x).alias(x) for x in seen],
    )
    row = F.struct("is_suspicious", c("n").alias("count"), "avg_risk_score", state_sum("usd").alias("total_volume"))
    whole = split.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *[x.alias(name) for name, x in merged_state("usd").items()],
        *[F.size(F.array_distinct(F.flatten(F.collect_list(x)))).cast("bigint").alias(x) for x in seen],
        F.sort_array(F.collect_list(row)).alias("split"),
    )
    summary = F.struct(
        c("n").alias("total_transactions"),
        state_sum("usd").alias("total_volume"),
        state_avg("usd").alias("avg_amount"),
        c("sender_country").alias("sender_countries"),
        c("receiver_country").alias("receiver_countries"),
    )
    document = F.struct(F.lit(date).alias("date"), summary.alias("transaction_summary"), c("split").alias("fraud_analysis"), F.lit(generated_at).alias("generated_at"))
    return whole.select(F.to_json(document).alias("report"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table."""
    counts = [
        df.agg(n_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out


def totals(tx: DataFrame) -> DataFrame:
    return tx.agg(
        n_rows().alias("total_transactions"),
        exact_sum(usd()).alias("total_usd_volume"),
        exact_sum(c("thb_equivalent")).alias("total_thb_volume"),
        exact_avg(usd()).alias("avg_transaction_usd"),
    )


def suspicious_totals(tx: DataFrame) -> DataFrame:
    return tx.where(flagged()).agg(
        n_rows().alias("suspicious_count"),
        exact_sum(usd()).alias("suspicious_volume_usd"),
        avg_risk().alias("avg_risk_score"),
    )


def latest(tx: DataFrame, k: int = 5) -> DataFrame:
    return top(tx, k, ["event_ts"], ["transaction_id"])


def big_risky_senders(tx: DataFrame, min_usd: float = 30000) -> DataFrame:
    return (
        tx.where(c("risk_level").isin("medium", "high"))
        .groupBy("sender_user_id")
        .agg(n_rows().alias("tx_count"), exact_sum(usd()).alias("total_volume"))
        .where(c("total_volume") > min_usd)
    )
