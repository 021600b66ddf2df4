"""Canonical views over the driver's sample tables.

Each view asks only for the joins its columns need; the join keys are complete in the tables,
so leaving a join out changes no row. Nothing here is hinted: a dimension is broadcast when
its measured size allows, and hot keys in the others are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import fixed
from ledgerflow.functions.numbers import round_units, units
from ledgerflow.operators.quality import add_partitions

c = F.col

# Country per nation key, clean and as it might be typed.
CLEAN_COUNTRIES = (
    "TH PH SG MY VN ID US GB JP UK CN RU KR DE CA AU FR IN AE VE IR KP HK TW BR".split()
)
TYPED_COUNTRIES = [
    "TH", " th ", "\tThailand\n", "PH", "Philippines", "SG", "Singapore ", "MY", "Malaysia",
    "VN", "ID", "indonesia", "US", "United States", "GB", "UK", "Great Britain", "JP", " japan",
    "CN", "RU", "KR", None, "", "VE",
]
TYPE_COINS = {
    "STANDARD": "BTC",
    "MEDIUM": "ETH",
    "SMALL": "USDC",
    "LARGE": "XRP",
    "ECONOMY": "USDT",
    "PROMO": "BNB",
}
EVENT_COINS = {
    "click": "BTC",
    "view": "ETH",
    "purchase": "USDT",
    "signup": "USDC",
    "error": "XRP",
}
SEGMENT_ACCOUNTS = {"MACHINERY": "whale", "BUILDING": "suspicious"}
USER_COINS = ("BTC", "ETH", "USDT", "USDC", "XRP", "BNB")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: Iterable[str | None], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _choose(key: Column, table: dict[str, str], last: str | None = None) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out if last is None else out.otherwise(last)


def _risk_level(aml: Column) -> Column:
    return F.when(aml <= 0.3, "low").when(aml <= 0.6, "medium").otherwise("high")


def _user(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


# --- transfers ------------------------------------------------------------------
def tx(spark: SparkSession, sf: str, columns: Iterable[str]) -> DataFrame:
    """Transfers from line items, with the columns asked for."""
    usd, aml = c("l_extendedprice"), c("l_discount") * F.lit(10.0)
    exprs: dict[str, tuple[Column, tuple[str, ...]]] = {
        "transaction_id": (
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ()
        ),
        "order_line": (F.concat_ws("-", "l_orderkey", "l_linenumber"), ()),
        "event_ts": (c("l_shipdate"), ()),
        "event_date": (F.to_date("l_shipdate"), ()),
        "usd_amount": (usd, ()),
        "thb_amount": (round_units(usd * fixed.USD_THB), ()),
        "thb_equivalent": (round_units(usd * fixed.USD_THB_FLAT), ()),
        "fee_rate": (c("l_tax"), ()),
        "fee_usd": (round_units(usd * c("l_tax"), 4), ()),
        "aml_score": (aml, ()),
        "risk_score": (units(c("l_discount"), 3), ()),
        "risk_level": (_risk_level(aml), ()),
        "is_suspicious": (F.when(c("l_returnflag") == "R", 1).otherwise(0), ()),
        "from_exchange": (_choose(c("l_linestatus"), {"O": fixed.GLOBAL_EXCHANGE}, fixed.TH_EXCHANGE), ()),
        "to_exchange": (_choose(c("l_returnflag"), {"N": fixed.GLOBAL_EXCHANGE}, fixed.TH_EXCHANGE), ()),
        "receiver_user_id": (_user("U_", c("l_suppkey")), ()),
        "receiver_kyc_level": ((c("l_suppkey") % 3 + 1).cast("int"), ()),
        "status": (_choose(c("o_orderstatus"), {"O": "pending", "F": "completed"}, "settled"), ("orders",)),
        "sender_user_id": (_user("U_", c("o_custkey")), ("orders",)),
        "sender_kyc_level": ((c("o_custkey") % 3 + 1).cast("int"), ("orders",)),
        "account_type": (_choose(c("c_mktsegment"), SEGMENT_ACCOUNTS, "regular"), ("orders", "customer")),
        "sender_country": (_pick(CLEAN_COUNTRIES, c("c_nationkey")), ("orders", "customer")),
        "sender_typed": (_pick(TYPED_COUNTRIES, c("c_nationkey")), ("orders", "customer")),
        "receiver_country": (_pick(CLEAN_COUNTRIES, c("s_nationkey")), ("supplier",)),
        "receiver_typed": (_pick(TYPED_COUNTRIES, c("s_nationkey")), ("supplier",)),
        "crypto_currency": (_choose(c("p_type"), TYPE_COINS), ("part",)),
    }
    columns = list(columns)

    # Made once for each row of a dimension: the rows that come out of the joins are many more, and
    # the code that each runs through is shorter.
    below = {x for x in columns if x in ("account_type", "sender_typed", "receiver_typed", "crypto_currency")}

    def dimension(name: str) -> DataFrame:
        own = {x: exprs[x][0] for x in columns if x in below and exprs[x][1][-1] == name}
        return table(spark, sf, name).withColumns(own) if own else table(spark, sf, name)

    needs = {n for name in columns for n in exprs[name][1]}
    rows, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    if "customer" in needs:  # joined to the smaller table, so that line items move once for both
        orders = orders.join(dimension("customer"), c("o_custkey") == c("c_custkey"))
    # Line items are moved with as few columns as there are: the part's one comes first.
    for name, left, right in (("supplier", "l_suppkey", "s_suppkey"), ("part", "l_partkey", "p_partkey")):
        if name in needs:
            rows = rows.join(dimension(name), c(left) == c(right))
    if "orders" in needs:
        rows = rows.join(orders, c("l_orderkey") == c("o_orderkey"))
    return rows.select(*[c(x) if x in below else exprs[x][0].alias(x) for x in columns])


def ev_tx(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers with a time of day, from events; one scan, no join."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    user = c("user_id")
    rows = table(spark, sf, "events").withColumn("k", k)
    k, aml = c("k"), c("k") / F.lit(100.0)
    coin = _choose(c("event_type"), EVENT_COINS)
    return rows.select(
        _user("E_", c("event_id")).alias("transaction_id"),
        c("event_id"),
        c("ts").alias("event_ts"),
        F.to_date("ts").alias("event_date"),
        _user("U_", user).alias("sender_user_id"),
        _user("U_", k).alias("receiver_user_id"),
        _pick(CLEAN_COUNTRIES, user % 25).alias("sender_country"),
        _pick(CLEAN_COUNTRIES, k % 25).alias("receiver_country"),
        (user % 3 + 1).cast("int").alias("sender_kyc_level"),
        (k % 3 + 1).cast("int").alias("receiver_kyc_level"),
        F.when(user % 3 == 0, "whale").when(user % 3 == 1, "regular").otherwise("suspicious").alias("account_type"),
        coin.alias("crypto_currency"),
        c("value").alias("usd_amount"),
        round_units(c("value") * fixed.USD_THB).alias("thb_amount"),
        F.lit(0.001).alias("fee_rate"),
        round_units(c("value") * 0.001, 4).alias("fee_usd"),
        aml.alias("aml_score"),
        k.alias("risk_score"),
        _risk_level(aml).alias("risk_level"),
        F.when(k >= 90, 1).otherwise(0).alias("is_suspicious"),
        F.lit("completed").alias("status"),
    )


def nested(flat: DataFrame, sender_country: str, receiver_country: str) -> DataFrame:
    """Flat transfers as nested events with the topic columns of a raw layer."""
    usd = c("usd_amount")
    flags = F.when(usd > 50000, F.array(F.lit("high_amount")))
    suspicious = c("risk_level").isin("medium", "high")
    topic = F.when(suspicious, fixed.TOPIC_SUSPICIOUS).otherwise(fixed.TOPIC_NORMAL)
    ts = c("event_ts")
    none = F.lit(None).cast("string")
    events = flat.select(
        "transaction_id",
        ts.alias("timestamp"),
        "status",
        F.struct(
            c("sender_user_id").alias("user_id"), c("account_type"), none.alias("email"),
            c(sender_country).alias("country"), c("sender_kyc_level").alias("kyc_level"),
            none.alias("preferred_crypto"),
        ).alias("sender"),
        F.struct(
            c("receiver_user_id").alias("user_id"), none.alias("email"),
            c(receiver_country).alias("country"), F.lit(fixed.TH_EXCHANGE).alias("exchange"),
            c("receiver_kyc_level").alias("kyc_level"),
        ).alias("receiver"),
        F.struct(
            c("crypto_currency").alias("crypto_symbol"), usd.alias("crypto_amount"),
            usd.alias("usd_equivalent"), c("thb_amount").alias("thb_equivalent"),
            F.lit(fixed.USD_THB).alias("exchange_rate_usd_thb"),
        ).alias("transfer"),
        F.struct("fee_usd", "fee_rate", F.lit("maker").alias("fee_type")).alias("fees"),
        F.struct("aml_score", "risk_level", flags.alias("flags")).alias("compliance"),
        topic.alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.lit(0).cast("bigint").alias("kafka_offset"),
        ts.alias("kafka_timestamp"),
        ts.alias("ingestion_timestamp"),
    )
    return add_partitions(events).drop("year", "month", "day", "hour", "date")


_EVENT_COLUMNS = (
    "transaction_id event_ts status sender_user_id account_type sender_typed sender_country "
    "sender_kyc_level receiver_user_id receiver_typed receiver_country receiver_kyc_level "
    "crypto_currency usd_amount thb_amount fee_usd fee_rate aml_score risk_level"
).split()


def tx_nested(spark: SparkSession, sf: str) -> DataFrame:
    return nested(tx(spark, sf, _EVENT_COLUMNS), "sender_typed", "receiver_typed")


def ev_nested(spark: SparkSession, sf: str) -> DataFrame:
    return nested(ev_tx(spark, sf), "sender_country", "receiver_country")


# --- market -----------------------------------------------------------------------
def candles(spark: SparkSession, sf: str) -> DataFrame:
    """One candle per line item, at 8 decimals: global pairs end in USDT, local ones in THB."""
    world = c("l_linestatus") == "O"
    coin = _choose(c("p_type"), TYPE_COINS)
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
        .select(
            c("l_shipdate").alias("open_time"),
            F.concat(coin, F.when(world, "USDT").otherwise("THB")).alias("symbol"),
            F.when(world, "global").otherwise("th").alias("market"),
            F.round(c("l_extendedprice") / 98765, 8).alias("close"),
            F.round(c("l_quantity") / 98765, 8).alias("volume"),
            F.round(c("l_extendedprice") / 7, 8).alias("quote_volume"),
            c("l_linenumber").alias("num_trades"),
        )
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Price quotes from events: three dollar pairs and two baht pairs."""
    rows = ev_tx(spark, sf)
    coin = c("crypto_currency")
    baht = coin.isin("USDT", "USDC")
    return rows.select(
        F.concat(coin, F.when(baht, "THB").otherwise("USDT")).alias("symbol"),
        coin.alias("coin"),
        c("usd_amount").alias("price"),
        c("event_ts").alias("timestamp"),
        F.when(baht, fixed.TH_SOURCE).otherwise(fixed.GLOBAL_SOURCE).alias("source"),
        (c("risk_score") * 1000).cast("double").alias("volume_24h"),
        (c("risk_score") - 50).cast("double").alias("change_24h"),
        (c("usd_amount") * 1000000).alias("market_cap"),
    )


def volumes(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly traded volume per exchange and brand."""
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
        .groupBy(
            _choose(c("l_linestatus"), {"O": fixed.GLOBAL_EXCHANGE}, fixed.TH_EXCHANGE).alias("exchange"),
            c("p_brand").alias("symbol"),
            F.to_date(F.date_trunc("month", "l_shipdate")).alias("trade_date"),
        )
        .agg(
            (F.sum(units(c("l_extendedprice"))) / F.lit(100.0)).alias("volume_usd"),
            (F.sum(units(c("l_quantity"))) / F.lit(100.0)).alias("daily_volume"),
            F.count(F.lit(1)).alias("daily_trades"),
            (F.sum(units(c("l_discount"))) / F.count(F.lit(1))).alias("price_change_pct"),
        )
        .withColumn("avg_trade_size", c("volume_usd") / c("daily_trades"))
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts from customers."""
    key = c("c_custkey")
    country = _pick(CLEAN_COUNTRIES, c("c_nationkey"))
    coins = F.array(_pick(USER_COINS, key % 6), _pick(USER_COINS, (key + 1) % 6))
    return table(spark, sf, "customer").select(
        _user("U_", key).alias("user_id"),
        _choose(c("c_mktsegment"), SEGMENT_ACCOUNTS, "regular").alias("account_type"),
        country.alias("country"),
        F.when(country == "TH", fixed.TH_EXCHANGE).otherwise(fixed.GLOBAL_EXCHANGE).alias("exchange"),
        (key % 3 + 1).alias("kyc_level"),
        c("c_acctbal").alias("monthly_volume_usd"),
        coins.alias("preferred_cryptos"),
    )


def offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Topic offsets: one topic per event type, one partition per user."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return (
        table(spark, sf, "events")
        .groupBy(c("event_type").alias("topic"), c("user_id").cast("int").alias("partition"))
        .agg(F.max("event_id").alias("end_offset"), F.max(F.when(k < 50, c("event_id"))).alias("committed_offset"))
    )
