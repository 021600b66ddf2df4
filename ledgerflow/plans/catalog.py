"""Every registered query: a DataFrame over the sample tables and, where SQL can say it, the
oracle SQL. All queries read whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from ledgerflow import fixed, schemas
from ledgerflow.functions import cleaning, labels, scoring
from ledgerflow.operators import flat, fraud, gold, joins, market, ordered, profile, quality
from ledgerflow.operators import silver as cleaned
from ledgerflow.operators import users as accounts
from ledgerflow.plans import bi
from ledgerflow.plans import oracle as o
from ledgerflow.sources import events as topics
from ledgerflow.sources import files, sample
from ledgerflow.sources import market as quotes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

c = F.col
TX_AS_OF = "2001-11-04 00:00:00"
EV_AS_OF = "2024-01-30 23:59:59"
MID_DAY = "1999-06-01"


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def portable(df: DataFrame) -> DataFrame:
    """Plain types only: text for dates, times and lists, BIGINT and DOUBLE for numbers."""
    cols = []
    for f in df.schema.fields:
        x, t = c(f"`{f.name}`"), f.dataType
        if isinstance(t, DateType):
            x = F.date_format(x, "yyyy-MM-dd")
        elif isinstance(t, TimestampType | TimestampNTZType):
            x = F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, ByteType | ShortType | IntegerType):
            x = x.cast("bigint")
        elif isinstance(t, FloatType | DecimalType):
            x = x.cast("double")
        elif isinstance(t, ArrayType):
            x = F.array_join(x, ",")
        cols.append(x.alias(f.name))
    return df.select(*cols)


def add(key: str, fn: Query, sql: str | None = None) -> None:
    QUERIES[key] = lambda spark, sf: portable(fn(spark, sf))
    if sql:
        ORACLE[key] = sql


# --- inputs -----------------------------------------------------------------------
def tx(*columns: str) -> Query:
    return lambda spark, sf: sample.tx(spark, sf, columns)


PAIR = ("sender_country", "receiver_country")
IDS = ("sender_user_id", "receiver_user_id")
CORE = ("usd_amount", "is_suspicious", "risk_score")


def silver_tx(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned.to_silver(sample.tx_nested(spark, sf), moment(TX_AS_OF))


def silver_ev(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned.to_silver(sample.ev_nested(spark, sf), moment(EV_AS_OF))


# --- sources and sinks ------------------------------------------------------------
def _json_parse(spark, sf):
    events = sample.table(spark, sf, "events")
    raw = events.select(
        c("user_id").cast("string").alias("key"),
        c("props").alias("value"),
        c("event_type").alias("topic"),
        F.lit(0).alias("partition"),
        c("event_id").alias("offset"),
        c("ts").alias("timestamp"),
    )
    parsed = topics.parse_events(raw, c("timestamp"), schemas.row(k=schemas.LONG), ts=None)
    return parsed.select("kafka_offset", "partition_key", "kafka_topic", "kafka_timestamp", "k")


add(
    "json_parse",
    _json_parse,
    f"""SELECT event_id AS kafka_offset, CAST(user_id AS VARCHAR) AS partition_key,
event_type AS kafka_topic, {o.ts("ts")} AS kafka_timestamp,
CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events""",
)


def _candles_scan(spark, sf):
    paths = [f"{sf}/lineitem.parquet", f"{sf}/no-such-symbol.parquet"]
    rows = files.read_existing(spark, paths)
    return rows.groupBy(c("l_linestatus").alias("market"), F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("candles"), F.max("l_extendedprice").alias("high")
    )


add(
    "candles_scan",
    _candles_scan,
    f"""SELECT l_linestatus AS market, {o.day("l_shipdate")} AS date, count(*) AS candles,
max(l_extendedprice) AS high FROM lineitem GROUP BY 1,2""",
)


def _map_explode(spark, sf):
    rows = sample.ev_tx(spark, sf)
    snapshots = rows.select(
        F.create_map(
            F.concat("crypto_currency", F.lit("USDT")), "usd_amount",
            F.lit("BNBUSDT"), c("risk_score").cast("double"),
        ).alias("prices"),
        F.create_map(F.concat("crypto_currency", F.lit("THB")), "thb_amount").alias("thb_pairs"),
    )
    return quotes.explode_prices(snapshots, moment(EV_AS_OF))


add(
    "map_explode",
    _map_explode,
    o.q(
        o.EV,
        f"""SELECT symbol, price, {o.ts(f"TIMESTAMP '{EV_AS_OF}'")} AS timestamp, source,
0e0 AS volume_24h, 0e0 AS price_change_24h, 0e0 AS market_cap FROM (
SELECT crypto_currency||'USDT' AS symbol, usd_amount AS price, 'binance_global' AS source FROM ev
UNION ALL SELECT 'BNBUSDT', CAST(risk_score AS DOUBLE), 'binance_global' FROM ev
UNION ALL SELECT crypto_currency||'THB', thb_amount, 'binance_th' FROM ev)""",
    ),
)


def _volume_unpivot(spark, sf):
    line, part = sample.table(spark, sf, "lineitem"), sample.table(spark, sf, "part")
    tickers = (
        line.join(part, c("l_partkey") == c("p_partkey"))
        .groupBy(c("p_brand").alias("symbol"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            (F.sum(F.floor(c("l_quantity") * 100 + 0.5)) / 100.0).alias("volume"),
            F.max("l_discount").alias("price_change"),
        )
    )
    stats = quotes.compare_volumes(tickers)
    return quotes.unpivot_volumes(
        stats.select(F.create_map("symbol", "stats").alias("volume_comparison")), moment(TX_AS_OF)
    )


add(
    "volume_unpivot",
    _volume_unpivot,
    f"""WITH t AS (SELECT p_brand AS symbol, count(*) AS n, {o.s("l_quantity")} AS v, max(l_discount) AS ch
FROM lineitem JOIN part ON l_partkey=p_partkey GROUP BY 1)
SELECT 'Binance_Global' AS exchange, symbol, v AS daily_volume, n AS daily_trades,
'2001-11-04' AS timestamp, ch AS price_change_pct FROM t
UNION ALL SELECT 'Binance_TH', symbol, v*0.1e0, CAST(floor(n*0.1e0) AS BIGINT), '2001-11-04', ch FROM t""",
)

add(
    "market_day_scan",
    lambda spark, sf: files.read_table(
        spark, f"{sf}/lineitem.parquet", MID_DAY, "l_shipdate"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"),
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_extendedprice,
{o.ts("l_shipdate")} AS l_shipdate FROM lineitem WHERE l_shipdate=TIMESTAMP '{MID_DAY} 00:00:00'""",
)


def _topic_route(spark, sf):
    scored = fraud.score_alerts(sample.tx_nested(spark, sf), keep_all=True)
    alert = F.coalesce(c("is_fraud_alert"), F.lit(False)) & c("compliance.risk_level").isin("medium", "high")
    routed = flat.route(scored, c("compliance.risk_level"), c("sender.country"), alert)
    return routed.select("transaction_id", "topic", "key")


_ALERT_SCORE = """CASE WHEN aml_score>0.9e0 THEN 1e0 WHEN usd_amount>100000 THEN 0.9e0
WHEN usd_amount>50000 THEN 0.7e0 WHEN aml_score>0.7e0 THEN 0.6e0 ELSE 0.1e0 END"""
_IS_ALERT = f"(CASE WHEN usd_amount>50000 THEN true END OR {_ALERT_SCORE}>0.8e0)"
_ALERT_TYPE = """CASE WHEN usd_amount>100000 THEN 'high_amount' WHEN aml_score>0.9e0 THEN 'high_aml_score'
WHEN sender_kyc_level=1 THEN 'low_kyc' ELSE 'general_suspicious' END"""
add(
    "topic_route",
    _topic_route,
    o.q(
        o.TX,
        f"""SELECT transaction_id, CASE WHEN {_IS_ALERT} AND risk_level IN ('medium','high') THEN
'transactions-fraud-alerts' WHEN risk_level IN ('medium','high') THEN 'transactions-suspicious'
ELSE 'transactions-normal' END AS topic, sender_typed AS key FROM tx""",
    ),
)


def _dataset_profile(spark, sf):
    rows = sample.tx(
        spark, sf, ["transaction_id", "event_ts", "sender_typed", "usd_amount", "risk_level"]
    )
    one = profile.dataset_profile(rows, country="sender_typed")
    return one.select(
        "row_count", "column_count", F.explode("null_counts").alias("column_name", "null_count"),
        "unique_countries", "range_start", "range_end", "total_volume_usd", "fraud_transactions",
    )


add(
    "dataset_profile",
    _dataset_profile,
    o.q(
        o.TX,
        f"""SELECT count(*) AS row_count, 5 AS column_count, n AS column_name,
sum(CASE WHEN n='sender_typed' AND sender_typed IS NULL THEN 1 ELSE 0 END)::BIGINT AS null_count,
count(DISTINCT sender_typed) AS unique_countries, {o.ts("min(event_ts)")} AS range_start,
{o.ts("max(event_ts)")} AS range_end, {o.s("usd_amount")} AS total_volume_usd,
{o.cnt("risk_level IN ('medium','high')")} AS fraud_transactions
FROM tx, (VALUES ('transaction_id'),('event_ts'),('sender_typed'),('usd_amount'),('risk_level')) v(n)
GROUP BY n""",
    ),
)

# --- row rules ----------------------------------------------------------------------
_SILVER_OUT = (
    "transaction_id transaction_timestamp event_date status sender_user_id sender_account_type "
    "sender_country sender_kyc_level receiver_user_id receiver_country receiver_kyc_level "
    "crypto_currency usd_amount thb_amount fee_usd fee_rate original_aml_score "
    "original_risk_level data_quality_score is_high_quality enhanced_fraud_score is_cross_border "
    "transaction_category risk_category kyc_compliance_level"
).split()


def _silver_sql(cols: list[str], src: str = o.SILVER_TX) -> str:
    text = {
        "transaction_timestamp": o.ts("transaction_timestamp"),
        "event_date": o.day("event_date"),
    }
    return o.q(src, "SELECT " + ", ".join(f"{text.get(x, x)} AS {x}" for x in cols) + " FROM silver")


add(
    "silver_flat",
    lambda spark, sf: silver_tx(spark, sf).select(*_SILVER_OUT),
    _silver_sql(_SILVER_OUT),
)
#: Every column of the cleaned row; what the view holds only one value of is that value here.
_SILVER_ROW = [*cleaned.FLAT_COLUMNS, *cleaned.QUALITY_COLUMNS, "enhanced_fraud_score", "is_cross_border", "transaction_category", "risk_category",
               "kyc_compliance_level", "silver_processing_timestamp", "processing_date", "event_date"]
_TIMES = ("transaction_timestamp", "kafka_timestamp", "ingestion_timestamp", "silver_processing_timestamp")


def _silver_row_sql() -> str:
    at, none = "transaction_timestamp", "NULL::VARCHAR"
    same = {
        "sender_email": none, "sender_preferred_crypto": none, "receiver_email": none, "receiver_exchange": f"'{fixed.TH_EXCHANGE}'",
        "crypto_amount": "usd_amount", "exchange_rate_usd_thb": f"{fixed.USD_THB}::DOUBLE", "fee_type": "'maker'",
        "kafka_topic": f"CASE WHEN original_risk_level IN ('medium','high') THEN '{fixed.TOPIC_SUSPICIOUS}' ELSE '{fixed.TOPIC_NORMAL}' END",
        "kafka_partition": "0", "kafka_offset": "0", "date_partition": o.day(at), "hour_partition": f"hour({at})",
        "silver_processing_timestamp": f"'{TX_AS_OF}'", "processing_date": f"'{TX_AS_OF[:10]}'", "event_date": o.day("event_date"),
    } | {x: f"strftime({at},'%Y-%m-%d %H:%M:%S')" for x in _TIMES[:3]}
    return o.q(o.SILVER_TX, "SELECT " + ", ".join(f"{same.get(x, x)} AS {x}" for x in _SILVER_ROW) + " FROM silver")


add(
    "silver_rows",
    lambda spark, sf: silver_tx(spark, sf).select(
        *[F.date_format(x, "yyyy-MM-dd HH:mm:ss").alias(x) if x in _TIMES else F.col(x).cast("string").alias(x) if x in ("processing_date", "event_date") else x for x in _SILVER_ROW]
    ),
    _silver_row_sql(),
)
add(
    "date_parts",
    lambda spark, sf: quality.add_partitions(sample.table(spark, sf, "events"), "ts").select(
        "event_id", "date_partition", "hour_partition", "year", "month", "day", "hour", "date"
    ),
    f"""SELECT event_id, {o.day("ts")} AS date_partition, hour(ts) AS hour_partition, year(ts) AS year,
month(ts) AS month, day(ts) AS day, hour(ts) AS hour, {o.day("ts")} AS date FROM events""",
)
_DQ = ["transaction_id", *quality.DQ_FLAGS, "data_quality_score", "is_high_quality"]
add(
    "dq_flags",
    lambda spark, sf: quality.quality_flags(sample.tx_nested(spark, sf)).select(*_DQ),
    _silver_sql(_DQ),
)
add(
    "dq_summary",
    lambda spark, sf: quality.quality_summary(quality.quality_flags(sample.tx_nested(spark, sf))),
    o.q(
        o.SILVER_TX,
        "SELECT data_quality_score, is_high_quality, count(*) AS row_count, "
        + ", ".join(f"{o.cnt(x)} AS {x.replace('_valid', '_passed')}" for x in quality.DQ_FLAGS)
        + " FROM silver GROUP BY 1,2",
    ),
)


def _dq_quarantine(spark, sf):
    fields = ("transaction_id", "timestamp", "sender.country", "receiver.country", "status")
    ok, rejects = quality.split_required(sample.tx_nested(spark, sf), fields)
    return (
        ok.select("transaction_id", F.lit("ok").alias("outcome"), F.lit("").alias("missing_fields"))
        .unionByName(
            rejects.select(
                "transaction_id",
                F.lit("rejected").alias("outcome"),
                F.array_join("missing_fields", ",").alias("missing_fields"),
            )
        )
    )


add(
    "dq_quarantine",
    _dq_quarantine,
    o.q(
        o.TX,
        """SELECT transaction_id, CASE WHEN sender_typed IS NULL OR receiver_typed IS NULL THEN 'rejected'
ELSE 'ok' END AS outcome, concat_ws(',', CASE WHEN sender_typed IS NULL THEN 'sender.country' END,
CASE WHEN receiver_typed IS NULL THEN 'receiver.country' END) AS missing_fields FROM tx""",
    ),
)


def _dq_required(spark, sf):
    """Split by the declared list of required fields; a third of the rows lack their sender."""
    rows = sample.tx_nested(spark, sf).withColumn("sender", F.when(c("receiver.kyc_level") != 1, c("sender")))
    ok, rejects = quality.split_required(rows)
    return (
        ok.select("transaction_id", F.lit("").alias("missing_fields"))
        .unionByName(rejects.select("transaction_id", F.array_join("missing_fields", ",").alias("missing_fields")))
        .groupBy("missing_fields").agg(F.count(F.lit(1)).alias("row_count"), F.min("transaction_id").alias("first_id"))
    )


add(
    "dq_required",
    _dq_required,
    o.q(
        o.TX,
        """SELECT CASE WHEN receiver_kyc_level=1 THEN 'sender' ELSE '' END AS missing_fields, count(*) AS row_count,
min(transaction_id) AS first_id FROM tx GROUP BY 1""",
    ),
)
add(
    "std_country",
    lambda spark, sf: sample.tx(spark, sf, ["sender_typed"])
    .groupBy(
        c("sender_typed").alias("typed"), cleaning.std_country(c("sender_typed")).alias("country")
    )
    .agg(F.count(F.lit(1)).alias("transaction_count")),
    o.q(
        o.TX,
        f"""SELECT sender_typed AS typed, {o._std("sender_typed")} AS country,
count(*) AS transaction_count FROM tx GROUP BY 1,2""",
    ),
)
add(
    "std_currency",
    lambda spark, sf: sample.table(spark, sf, "events").select(
        "event_id",
        cleaning.std_currency(
            F.when(c("event_type") != "error", F.concat(F.lit("\t "), "event_type", F.lit(" \n")))
        ).alias("currency"),
    ),
    """SELECT event_id, CASE WHEN event_type='error' THEN 'UNKNOWN' ELSE upper(event_type) END AS currency
FROM events""",
)
add(
    "fraud_score",
    lambda spark, sf: sample.tx(
        spark,
        sf,
        ["transaction_id", "aml_score", "usd_amount", *PAIR, "sender_kyc_level", "receiver_kyc_level"],
    ).select(
        "transaction_id",
        *[
            scoring.enhanced_fraud_score(
                F.when(c("usd_amount") > 1000, c("aml_score")), c("usd_amount"), c(PAIR[0]), c(PAIR[1]),
                c("sender_kyc_level"), c("receiver_kyc_level"), tiered,
            ).alias(name)
            for tiered, name in ((False, "fraud_score"), (True, "tiered_fraud_score"))
        ],
    ),
    o.q(
        o.TX,
        "SELECT transaction_id, "
        + ", ".join(
            f"""least(((((coalesce(CASE WHEN usd_amount>1000 THEN aml_score END,0e0) + {amount})
+ CASE WHEN sender_country<>receiver_country THEN 0.05e0 ELSE 0e0 END)
+ CASE WHEN sender_kyc_level=1 THEN 0.1e0 ELSE 0e0 END)
+ CASE WHEN receiver_kyc_level=1 THEN 0.1e0 ELSE 0e0 END), 1e0) AS {name}"""
            for amount, name in (
                ("CASE WHEN usd_amount>50000 THEN 0.1e0 ELSE 0e0 END", "fraud_score"),
                (
                    "CASE WHEN usd_amount>100000 THEN 0.2e0 WHEN usd_amount>50000 THEN 0.1e0 ELSE 0e0 END",
                    "tiered_fraud_score",
                ),
            )
        )
        + " FROM tx",
    ),
)
add(
    "row_tags",
    lambda spark, sf: silver_tx(spark, sf)
    .groupBy("is_cross_border", "transaction_category", "risk_category", "kyc_compliance_level")
    .agg(F.count(F.lit(1)).alias("transaction_count")),
    o.q(
        o.SILVER_TX,
        """SELECT is_cross_border, transaction_category, risk_category, kyc_compliance_level,
count(*) AS transaction_count FROM silver GROUP BY 1,2,3,4""",
    ),
)
_ALERT_COLS = ("transaction_id", "fraud_score", "is_fraud_alert", "alert_type")
add(
    "alert_score",
    lambda spark, sf: fraud.score_alerts(sample.tx_nested(spark, sf), keep_all=True).select(*_ALERT_COLS),
    o.q(
        o.TX,
        f"""SELECT transaction_id, {_ALERT_SCORE} AS fraud_score, {_IS_ALERT} AS is_fraud_alert,
{_ALERT_TYPE} AS alert_type FROM tx""",
    ),
)
add(
    "alerts",
    lambda spark, sf: fraud.score_alerts(
        sample.tx_nested(spark, sf).where(c("kafka_topic") == fixed.TOPIC_SUSPICIOUS)
    ).select("transaction_id", "timestamp", c("sender.country").alias("sender_country"),
             "transfer.usd_equivalent", "fraud_score", "alert_type"),
    o.q(
        o.TX,
        f"""SELECT transaction_id, {o.ts("event_ts")} AS timestamp, sender_typed AS sender_country,
usd_amount AS usd_equivalent, {_ALERT_SCORE} AS fraud_score, {_ALERT_TYPE} AS alert_type FROM tx
WHERE risk_level IN ('medium','high') AND {_IS_ALERT}""",
    ),
)

_RULE_SQL = {
    "high_amount": "usd_amount>30000",
    "high_aml": "aml_score>0.7e0",
    "risky_country": "sender_typed IN ('RU','CN') AND usd_amount>10000",
    "low_kyc_amount": "sender_kyc_level=1 AND usd_amount>5000",
    "stablecoin_large": "crypto_currency IN ('USDT','USDC') AND usd_amount>50000",
}


def _rule_hits(spark, sf):
    hits = scoring.rule_hits(scoring.named_rules(fraud.event_rule_inputs()))
    rows = sample.tx_nested(spark, sf).select("transaction_id", hits.alias("rules"))
    return rows.withColumn("rule_count", F.size("rules"))


add(
    "rule_hits",
    _rule_hits,
    o.q(
        o.TX,
        "SELECT transaction_id, concat_ws(',', "
        + ", ".join(f"CASE WHEN {e} THEN '{n}' END" for n, e in _RULE_SQL.items())
        + ") AS rules, CAST("
        + "+".join(f"CASE WHEN {e} THEN 1 ELSE 0 END" for e in _RULE_SQL.values())
        + " AS BIGINT) AS rule_count FROM tx",
    ),
)
add(
    "rule_hit_counts",
    lambda spark, sf: fraud.rule_hit_counts(
        sample.tx_nested(spark, sf), scoring.named_rules(fraud.event_rule_inputs())
    ),
    o.q(
        o.TX,
        " UNION ALL ".join(
            f"SELECT '{n}' AS rule, count(*) AS hits, coalesce({o.s('usd_amount')},0e0) AS usd_volume FROM tx WHERE {e}"
            for n, e in _RULE_SQL.items()
        ),
    ),
)
add(
    "flat_tx",
    lambda spark, sf: flat.to_flat_transaction(
        sample.tx_nested(spark, sf), c("kafka_topic"), moment(TX_AS_OF)
    ),
    o.q(
        o.TX,
        f"""SELECT transaction_id, sender_user_id AS user_id, usd_amount AS amount, crypto_currency AS currency,
'crypto_transfer' AS transaction_type, status, {o.ts("event_ts")} AS timestamp,
coalesce(sender_typed,'') AS from_country, coalesce(receiver_typed,'') AS to_country,
aml_score AS fraud_score, risk_level IN ('medium','high') AS is_suspicious,
CASE WHEN risk_level IN ('medium','high') THEN 'transactions-suspicious' ELSE 'transactions-normal' END AS topic_source,
'2001-11-04 00:00:00.000000' AS created_at FROM tx""",
    ),
)
add(
    "alert_records",
    lambda spark, sf: flat.to_alert_record(
        sample.tx_nested(spark, sf), c("kafka_topic"), moment(TX_AS_OF)
    )
    .withColumn("details_id", F.get_json_object("details", "$.transaction_id"))
    .withColumn("details_country", F.get_json_object("details", "$.sender.country"))
    .drop("details"),
    o.q(
        o.TX,
        f"""SELECT 'alert_'||transaction_id AS alert_id, transaction_id, sender_user_id AS user_id,
CAST(CAST(aml_score AS FLOAT) AS DOUBLE) AS fraud_score, 'fraud_detection' AS alert_type,
CASE WHEN aml_score>0.8e0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, {o.ts("event_ts")} AS timestamp,
'2001-11-04 00:00:00.000000' AS created_at, transaction_id AS details_id, sender_typed AS details_country
FROM tx WHERE aml_score>0.7e0""",
    ),
)


def _defaults(spark, sf):
    rows = sample.tx(
        spark, sf,
        ["transaction_id", "event_ts", "usd_amount", "crypto_currency", "sender_typed",
         "receiver_user_id", "risk_score"],
    )
    coin = c("crypto_currency")
    partial = rows.select(
        "transaction_id",
        F.when(c("risk_score") != 0, c("event_ts")).alias("timestamp"),
        F.when(coin != "BNB", coin).alias("currency"),
        F.when(coin.isin("BTC", "ETH"), coin).alias("crypto_currency"),
        F.when(coin != "XRP", c("usd_amount")).alias("fiat_amount"),
        c("sender_typed").alias("country"),
        F.when(coin == "ETH", F.lit("SG")).alias("sender_country"),
        "receiver_user_id",
        "risk_score",
        F.when(coin == "BTC", F.lit(1.5)).alias("fee_usd"),
    )
    return flat.apply_defaults(partial, moment(TX_AS_OF))


add(
    "defaults",
    _defaults,
    o.q(
        o.TX,
        f"""SELECT transaction_id, 'Binance_Global' AS from_exchange, 'Binance_TH' AS to_exchange, 0e0 AS amount,
coalesce(CASE WHEN crypto_currency<>'BNB' THEN crypto_currency END,'USDT') AS currency,
0 AS is_suspicious, risk_score, coalesce(sender_typed,'US') AS country, 'regular' AS account_type,
'' AS sender_user_id, receiver_user_id,
CASE WHEN crypto_currency='BNB' THEN 'USDT' ELSE crypto_currency END AS crypto_currency,
CASE WHEN crypto_currency<>'XRP' THEN usd_amount ELSE 0e0 END AS fiat_amount, 1e0 AS exchange_rate,
'cross_border_transfer' AS transaction_type, 1000 AS processing_time_ms,
CASE WHEN crypto_currency='ETH' THEN 'SG' ELSE coalesce(sender_typed,'US') END AS sender_country,
'TH' AS receiver_country, 2 AS sender_kyc_level, 2 AS receiver_kyc_level, 6 AS network_confirmations,
CASE WHEN risk_score<>0 THEN {o.ts("event_ts")} ELSE '2001-11-04 00:00:00.000000' END AS timestamp,
CASE WHEN crypto_currency<>'XRP' THEN usd_amount ELSE 0e0 END*35.1e0 AS thb_equivalent,
CASE WHEN crypto_currency='BTC' THEN 1.5e0 ELSE CASE WHEN crypto_currency<>'XRP' THEN usd_amount ELSE 0e0 END*0.001e0 END AS fee_usd
FROM tx""",
    ),
)


def _fx(spark, sf):
    rows = sample.tx(spark, sf, ["transaction_id", "usd_amount", "crypto_currency", "risk_score"])
    return flat.fx_enrich(rows, flat.rates_frame(spark), maker=c("risk_score") < 50).drop("risk_score")


_FEE = "CASE WHEN risk_score<50 THEN 0.001e0 ELSE 0.0015e0 END"
_RATE = "CASE crypto_currency WHEN 'BTC' THEN 45000e0 WHEN 'ETH' THEN 2800e0 WHEN 'XRP' THEN 0.62e0 WHEN 'BNB' THEN 320e0 ELSE 1e0 END"
add(
    "fx_enrich",
    _fx,
    o.q(
        o.TX,
        f"""SELECT transaction_id, usd_amount, crypto_currency,
CASE WHEN crypto_currency IN ('BTC','ETH') THEN {o.r(f"(usd_amount/({_RATE}))", 8)}
 WHEN crypto_currency IN ('USDT','USDC') THEN {o.r(f"(usd_amount/({_RATE}))", 2)}
 ELSE {o.r(f"(usd_amount/({_RATE}))", 6)} END AS crypto_amount,
{o.r("(usd_amount*35.5e0)", 2)} AS thb_amount, {_FEE} AS fee_rate,
CASE WHEN risk_score<50 THEN 'maker' ELSE 'taker' END AS fee_type,
{o.r(f"(usd_amount*({_FEE}))", 4)} AS fee_usd, {o.r(f"((usd_amount*({_FEE}))*35.5e0)", 4)} AS fee_thb FROM tx""",
    ),
)
add(
    "network_lookup",
    lambda spark, sf: flat.with_network(sample.tx(spark, sf, ["crypto_currency"]))
    .groupBy("crypto_currency", "network_type")
    .agg(F.count(F.lit(1)).alias("transaction_count")),
    o.q(
        o.TX,
        """SELECT crypto_currency, CASE crypto_currency WHEN 'BTC' THEN 'Bitcoin' WHEN 'BNB' THEN 'BSC'
WHEN 'XRP' THEN 'Ripple' ELSE 'Ethereum' END AS network_type, count(*) AS transaction_count FROM tx GROUP BY 1,2""",
    ),
)


def _points(spark, sf):
    rows = sample.tx(
        spark, sf,
        ["transaction_id", "account_type", "usd_amount", "sender_kyc_level", "sender_country", "is_suspicious"],
    )
    flagged = c("is_suspicious") == 1
    score = scoring.points_risk_score(
        c("account_type"), c("usd_amount"), c("sender_kyc_level"), c("sender_country"), flagged
    )
    out = rows.withColumn("points", score)
    return out.select(
        "transaction_id", "points", scoring.points_suspicious(flagged, c("points")).alias("suspicious")
    )


add(
    "points_risk",
    _points,
    o.q(
        o.TX,
        """SELECT transaction_id, CAST(p AS BIGINT) AS points, (is_suspicious=1 OR p>70) AS suspicious FROM (
SELECT *, greatest(0,least(100,
 CASE account_type WHEN 'suspicious' THEN 40 WHEN 'whale' THEN 10 ELSE 0 END
 + CASE WHEN usd_amount>100000 THEN 30 WHEN usd_amount>50000 THEN 20 WHEN usd_amount>30000 THEN 15 ELSE 0 END
 + CASE sender_kyc_level WHEN 1 THEN 20 WHEN 2 THEN 10 ELSE 0 END
 + CASE WHEN sender_country IN ('RU','CN','VE','IR','KP') THEN 25 ELSE 0 END
 + CASE WHEN is_suspicious=1 THEN 30 ELSE 0 END)) AS p FROM tx)""",
    ),
)
_COIN = """CASE WHEN symbol IN ('BTCUSDT','BTCTHB') THEN 'BTC' WHEN symbol IN ('ETHUSDT','ETHTHB') THEN 'ETH'
WHEN symbol IN ('USDCUSDT','USDTTHB') THEN 'USDC' ELSE 'UNKNOWN' END"""
add(
    "coin_map",
    lambda spark, sf: sample.candles(spark, sf)
    .groupBy("symbol", labels.map_coin(c("symbol")).alias("coin"),
             labels.market_of_symbol(c("symbol")).alias("market"))
    .agg(F.count(F.lit(1)).alias("candles")),
    o.q(o.CANDLES, f"SELECT symbol, {_COIN} AS coin, market, count(*) AS candles FROM candles GROUP BY 1,2,3"),
)
add(
    "cast_coerce",
    lambda spark, sf: quality.narrow(
        sample.table(spark, sf, "events")
        .withColumn("k", F.get_json_object("props", "$.k"))
        .withColumn("row_id", c("event_id"))
        .select("row_id", "event_id", "user_id", "value", "event_type", "k"),
        {"event_id": "smallint", "user_id": "tinyint", "value": "float", "event_type": "int", "k": "double"},
    ),
    """SELECT event_id AS row_id, CAST(TRY_CAST(event_id AS SMALLINT) AS BIGINT) AS event_id,
CAST(TRY_CAST(user_id AS TINYINT) AS BIGINT) AS user_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value,
CAST(TRY_CAST(event_type AS INT) AS BIGINT) AS event_type,
TRY_CAST(json_extract_string(props,'$.k') AS DOUBLE) AS k FROM events""",
)
add(
    "narrow_rejects",
    lambda spark, sf: quality.narrow_rejects(
        sample.table(spark, sf, "events").withColumn("row_id", c("event_id")),
        {"event_id": "smallint", "user_id": "tinyint", "event_type": "int"},
        ["row_id"],
    ),
    """SELECT event_id AS row_id, 'event_id' AS "column", CAST(event_id AS VARCHAR) AS value FROM events WHERE event_id>32767
UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events WHERE user_id>127
UNION ALL SELECT event_id, 'event_type', event_type FROM events""",
)
add(
    "valid_dates",
    lambda spark, sf: quality.valid_dates(
        sample.tx(spark, sf, ["transaction_id", "event_date"]), F.lit(MID_DAY).cast("date"), "event_date"
    ),
    f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
{o.day("l_shipdate")} AS event_date FROM lineitem WHERE CAST(l_shipdate AS DATE)<=DATE '{MID_DAY}'""",
)

# --- market --------------------------------------------------------------------------
_DAILY = f"""{o.CANDLES}, daily AS (SELECT date, {_COIN} AS coin, market,
CASE WHEN market='th' THEN {o.s8("close")}/count(close) END AS avg_price_thb,
CASE WHEN market='global' THEN {o.s8("close")}/count(close) END AS avg_price_usd,
{o.s8("volume")} AS total_volume, {o.s8("quote_volume")} AS total_quote_volume,
CAST(sum(num_trades) AS BIGINT) AS total_trades FROM candles GROUP BY 1,2,3)"""
_CAPPED = f"""{_DAILY}, stats AS (SELECT avg(total_volume)+3e0*stddev_samp(total_volume) AS v,
avg(total_trades)+3e0*stddev_samp(total_trades) AS t FROM daily),
capped AS (SELECT date, coin, market, avg_price_thb, avg_price_usd, least(total_volume, v) AS total_volume,
total_quote_volume, least(CAST(total_trades AS DOUBLE), t) AS total_trades FROM daily, stats)"""
_METRICS = {
    "volume_global": ("global", "total_volume"),
    "quote_volume_global": ("global", "total_quote_volume"),
    "price_usd": ("global", "avg_price_usd"),
    "price_thb": ("th", "avg_price_thb"),
    "trades_global": ("global", "total_trades"),
}


def _pivot_sql(src: str) -> str:
    cols = ", ".join(
        f"max(CASE WHEN coin='{k}' AND market='{m}' THEN {x} END) AS {k}_{n}"
        for k in fixed.PIVOT_COINS
        for n, (m, x) in _METRICS.items()
    )
    return f"SELECT date, {cols} FROM {src} GROUP BY date"


def _daily(spark, sf):
    return market.market_daily(sample.candles(spark, sf))


def _klines(spark, sf):
    """Answers of a market: mostly candles, some empty and some errors."""
    cells = [F.unix_millis(c("l_shipdate").cast("timestamp")).cast("string"), *[F.lit("1.5")] * 3, c("l_extendedprice").cast("string"),
             c("l_quantity").cast("string"), F.lit("1000"), F.lit("2.5"), c("l_linenumber").cast("string"), *[F.lit("0.5")] * 3]
    text = (
        F.when(c("l_linenumber") == 7, '{"code": -1}')
        .when(c("l_linenumber") == 6, "[]")
        .when(c("l_linenumber") == 5, "[[1, 2")
        .otherwise(F.to_json(F.array(F.array(*cells))))
    )
    answers = sample.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("value"))
    ok, bad = quotes.parse_klines(answers)
    return ok.select("l_orderkey", "l_linenumber", "close", "num_trades", F.lit(None).cast("string").alias("raw")).unionByName(
        bad.select("l_orderkey", "l_linenumber", "raw"), allowMissingColumns=True
    )


add(
    "klines_parse",
    _klines,
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber<5 THEN l_extendedprice END AS close,
CASE WHEN l_linenumber<5 THEN l_linenumber END AS num_trades,
CASE l_linenumber WHEN 7 THEN '{"code": -1}' WHEN 6 THEN '[]' WHEN 5 THEN '[[1, 2' END AS raw FROM lineitem""",
)
add(
    "combine_markets",
    lambda spark, sf: market.combine_markets(
        [sample.candles(spark, sf).where(c("market") == m).drop("open_time") for m in ("global", "th")],
        "2001-11-04",
        moment(TX_AS_OF),
    ),
    o.q(
        o.CANDLES,
        """SELECT symbol, market, close, volume, quote_volume, CAST(num_trades AS BIGINT) AS num_trades,
'2001-11-04' AS date, '2001-11-04 00:00:00.000000' AS processed_at FROM candles""",
    ),
)
add("market_daily", _daily, o.q(_DAILY, f"SELECT * REPLACE ({o.day('date')} AS date) FROM daily"))
add(
    "outlier_cap",
    lambda spark, sf: market.cap_outliers(_daily(spark, sf)).select(
        "date", "coin", "market",
        *[F.round(x, 4).alias(x) for x in ("total_volume", "total_trades")],
    ),
    o.q(
        _CAPPED,
        f"""SELECT {o.day("date")} AS date, coin, market, {o.r("total_volume", 4)} AS total_volume,
{o.r("total_trades", 4)} AS total_trades FROM capped""",
    ),
)
add(
    "market_pivot",
    lambda spark, sf: market.coin_pivot(_daily(spark, sf)),
    o.q(_DAILY, f"SELECT * REPLACE ({o.day('date')} AS date) FROM ({_pivot_sql('daily')})"),
)


def _market_gold(spark, sf):
    out = market.market_gold(sample.candles(spark, sf), F.lit("2001-11-04").cast("date"))
    return out.withColumns({f"{k}_volume_global": F.round(f"{k}_volume_global", 4) for k in fixed.PIVOT_COINS})


def _market_gold_sql() -> str:
    cols, q = [], "+".join(f"coalesce({k}_quote_volume_global,0e0)" for k in fixed.PIVOT_COINS)
    t = "+".join(f"coalesce({k}_trades_global,0e0)" for k in fixed.PIVOT_COINS)
    for k in fixed.PIVOT_COINS:
        v = f"coalesce({k}_volume_global,0e0)"
        cols += [
            f"{o.r(v, 4)} AS {k}_volume_global",
            f"coalesce({k}_quote_volume_global,0e0) AS {k}_quote_volume_global",
            f"{k}_price_usd, {k}_price_thb",
            f"CAST(floor(coalesce({k}_trades_global,0e0)) AS BIGINT) AS {k}_trades_global",
        ]
    for k in fixed.PIVOT_COINS[:2]:
        x = f"(coalesce({k}_quote_volume_global,0e0)/CASE WHEN ({q})>0 THEN ({q}) ELSE 1e0 END*1e2)"
        cols.append(f"{o.r(x, 2)} AS {k.lower()}_dominance")
    return (
        f"SELECT {o.day('date')} AS date, {', '.join(cols)}, ({q}) AS total_trading_volume_usd, "
        f"CAST(floor({t}) AS BIGINT) AS total_trades FROM ({_pivot_sql('capped')})"
    )


add("market_gold", _market_gold, o.q(_CAPPED, _market_gold_sql()))

# --- joins ----------------------------------------------------------------------------
_JOIN_TX = tx("transaction_id", *IDS, *CORE)
_OR = "users ua LEFT JOIN tx t ON (ua.user_id=t.sender_user_id OR ua.user_id=t.receiver_user_id)"
_TX_USERS = o.TX + ", " + o.USERS
add(
    "or_join_users",
    lambda spark, sf: joins.users_tx_join(sample.users(spark, sf), _JOIN_TX(spark, sf)).select(
        "user_id", "account_type", "transaction_count", "total_volume", "avg_risk_score", "suspicious_count"
    ),
    o.q(
        _TX_USERS,
        f"""SELECT ua.user_id, ua.account_type, count(t.transaction_id) AS transaction_count,
{o.s("t.usd_amount")} AS total_volume, CAST(sum(t.risk_score) AS DOUBLE)/nullif(count(t.risk_score),0) AS avg_risk_score,
count(*) FILTER (WHERE t.is_suspicious=1) AS suspicious_count FROM {_OR} GROUP BY 1,2""",
    ),
)


def _price_tx(spark, sf):
    day = sample.prices(spark, sf).select(
        c("coin").alias("symbol"), F.floor("price").alias("price_usd"), "change_24h", "volume_24h"
    )
    return joins.price_tx_join(day, tx("transaction_id", "crypto_currency", "usd_amount")(spark, sf))


_TX_PRICES = o.TX + ", " + o.PRICES
add(
    "price_tx_join",
    _price_tx,
    o.q(
        _TX_PRICES,
        f"""SELECT coin AS symbol, CAST(floor(price) AS BIGINT) AS price_usd, change_24h, volume_24h,
count(t.transaction_id) AS platform_transactions, {o.s("t.usd_amount")} AS platform_volume,
{o.a("t.usd_amount")} AS avg_amount
FROM prices p LEFT JOIN tx t ON p.coin=t.crypto_currency GROUP BY 1,2,3,4""",
    ),
)


def _latest_semi(spark, sf):
    rows = sample.tx(spark, sf, ["transaction_id", "receiver_user_id", "event_date", "usd_amount"])
    return joins.latest_by(rows, ["receiver_user_id"], "event_date").select(
        "receiver_user_id", "event_date", "transaction_id", "usd_amount"
    )


add(
    "latest_semi",
    _latest_semi,
    o.q(
        o.TX,
        f"""SELECT receiver_user_id, {o.day("event_date")} AS event_date, transaction_id, usd_amount FROM tx
WHERE (receiver_user_id, event_date) IN (SELECT receiver_user_id, max(event_date) FROM tx GROUP BY 1)""",
    ),
)
add(
    "user_activity",
    lambda spark, sf: joins.user_activity(tx("usd_amount", *IDS)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT u.user_id, coalesce({o.s("t.usd_amount")},0e0) AS total_transaction_volume,
count(t.sender_user_id) AS transaction_count FROM (SELECT sender_user_id AS user_id FROM tx
UNION SELECT receiver_user_id FROM tx) u LEFT JOIN tx t ON t.sender_user_id=u.user_id GROUP BY 1""",
    ),
)

# --- aggregated layer -------------------------------------------------------------------
_DAY = f"{o.day('event_date')} AS event_date"


def _share(name: str, n: str) -> str:
    return o.pct(name, n)


add(
    "gold_daily_summary",
    lambda spark, sf: gold.daily_summary(silver_tx(spark, sf)),
    o.q(
        o.SILVER_TX,
        f"""SELECT *, {o.pct("cross_border_count", "transaction_count")} AS cross_border_percentage,
{o.pct("high_risk_count", "transaction_count")} AS high_risk_percentage,
{o.pct("compliant_count", "transaction_count")} AS compliance_percentage, 'daily' AS aggregation_level FROM (
SELECT {_DAY}, sender_country, receiver_country, crypto_currency, count(transaction_id) AS transaction_count,
{o.s("usd_amount")} AS total_usd_volume, {o.a("usd_amount")} AS avg_transaction_amount,
min(usd_amount) AS min_transaction_amount, max(usd_amount) AS max_transaction_amount,
{o.s("fee_usd", 4)} AS total_fees_collected, {o.r(o.a("enhanced_fraud_score", 6), 4)} AS avg_fraud_score,
{o.cnt("risk_category='high_risk'")} AS high_risk_count, {o.cnt("is_cross_border")} AS cross_border_count,
{o.cnt("kyc_compliance_level='compliant'")} AS compliant_count,
count(DISTINCT sender_user_id) AS unique_senders, count(DISTINCT receiver_user_id) AS unique_receivers
FROM silver GROUP BY event_date, 2,3,4)""",
    ),
)
add(
    "gold_country_flows",
    lambda spark, sf: gold.country_flows(silver_tx(spark, sf)),
    o.q(
        o.SILVER_TX,
        f"""SELECT *, sender_country||'_to_'||receiver_country AS flow_direction,
sender_country=receiver_country AS is_domestic, CASE WHEN flow_avg_fraud_score<=0.3e0 THEN 'low'
WHEN flow_avg_fraud_score<=0.6e0 THEN 'medium' ELSE 'high' END AS flow_risk_level FROM (
SELECT {_DAY}, sender_country, receiver_country, count(transaction_id) AS flow_transaction_count,
{o.s("usd_amount")} AS flow_total_volume, {o.a("usd_amount")} AS flow_avg_amount,
{o.s("fee_usd", 4)} AS flow_total_fees, {o.a("enhanced_fraud_score", 6)} AS flow_avg_fraud_score,
count(DISTINCT crypto_currency) AS currencies_used, {o.cnt("transaction_category='large'")} AS large_transactions,
max(usd_amount) AS largest_transaction FROM silver GROUP BY event_date, 2,3)""",
    ),
)
add(
    "gold_fraud_analytics",
    lambda spark, sf: gold.fraud_analytics(silver_tx(spark, sf), max_ids=3),
    o.q(
        o.SILVER_TX,
        f"""SELECT *, avg_enhanced_fraud_score-avg_original_aml_score AS fraud_improvement,
CAST(risk_transaction_count AS DOUBLE)/CAST(sum(risk_transaction_count) OVER (PARTITION BY event_date) AS DOUBLE) AS risk_concentration
FROM (SELECT {_DAY}, risk_category, sender_country, receiver_country, count(transaction_id) AS risk_transaction_count,
{o.s("usd_amount")} AS risk_total_volume, {o.a("enhanced_fraud_score", 6)} AS avg_enhanced_fraud_score,
{o.a("original_aml_score", 6)} AS avg_original_aml_score,
{o.cnt("kyc_compliance_level='non_compliant'")} AS non_compliant_count,
{o.cnt("transaction_category='large'")} AS large_amount_count,
count(DISTINCT sender_user_id) AS unique_risk_senders, count(DISTINCT receiver_user_id) AS unique_risk_receivers,
max(enhanced_fraud_score) AS max_fraud_score,
array_to_string(list_sort(list(transaction_id))[1:3], ',') AS sample_transaction_ids
FROM silver GROUP BY event_date, 2,3,4)""",
    ),
)
add(
    "gold_fraud_members",
    lambda spark, sf: gold.fraud_members(silver_tx(spark, sf)),
    o.q(
        o.SILVER_TX,
        f"SELECT {_DAY}, risk_category, sender_country, receiver_country, transaction_id FROM silver",
    ),
)
add(
    "gold_business_kpis",
    lambda spark, sf: gold.business_kpis(silver_tx(spark, sf)),
    o.q(
        o.SILVER_TX,
        f"""SELECT *, {o.pct("daily_cross_border_transactions", "daily_transaction_volume")} AS cross_border_rate,
{o.pct("daily_compliant_transactions", "daily_transaction_volume")} AS compliance_rate,
{o.pct("daily_high_risk_transactions", "daily_transaction_volume")} AS high_risk_rate,
{o.r("(daily_revenue/daily_transaction_volume)", 4)} AS revenue_per_transaction,
daily_avg_transaction_size-lag(daily_avg_transaction_size) OVER (ORDER BY event_date) AS avg_transaction_size_trend,
CAST(daily_transaction_volume-lag(daily_transaction_volume) OVER (ORDER BY event_date) AS DOUBLE)/
CAST(lag(daily_transaction_volume) OVER (ORDER BY event_date) AS DOUBLE)*1e2 AS volume_growth_rate FROM (
SELECT {_DAY}, count(transaction_id) AS daily_transaction_volume, {o.s("usd_amount")} AS daily_usd_volume,
{o.a("usd_amount")} AS daily_avg_transaction_size, {o.s("fee_usd", 4)} AS daily_revenue,
{o.a("fee_rate", 6)} AS avg_fee_rate, count(DISTINCT sender_user_id) AS daily_active_senders,
count(DISTINCT receiver_user_id) AS daily_active_receivers,
{o.a("enhanced_fraud_score", 6)} AS daily_avg_fraud_score,
{o.cnt("risk_category='high_risk'")} AS daily_high_risk_transactions,
{o.cnt("kyc_compliance_level='compliant'")} AS daily_compliant_transactions,
{o.cnt("is_cross_border")} AS daily_cross_border_transactions,
count(DISTINCT crypto_currency) AS currencies_traded, count(DISTINCT sender_country) AS countries_sending,
count(DISTINCT receiver_country) AS countries_receiving FROM silver GROUP BY event_date)""",
    ),
)
add(
    "gold_hourly_trends",
    lambda spark, sf: gold.hourly_trends(silver_ev(spark, sf)),
    o.q(
        o.SILVER_EV,
        f"""SELECT *, CASE WHEN transaction_hour BETWEEN 6 AND 11 THEN 'morning'
WHEN transaction_hour BETWEEN 12 AND 17 THEN 'afternoon' WHEN transaction_hour BETWEEN 18 AND 23 THEN 'evening'
ELSE 'night' END AS hour_classification FROM (SELECT {_DAY}, hour(transaction_timestamp) AS transaction_hour,
count(transaction_id) AS hourly_count, {o.s("usd_amount")} AS hourly_volume,
{o.a("enhanced_fraud_score", 6)} AS hourly_avg_fraud_score, count(DISTINCT sender_country) AS hourly_countries,
{o.s("fee_usd", 4)} AS hourly_revenue FROM silver GROUP BY event_date, 2)""",
    ),
)

# --- profiles and users -------------------------------------------------------------------
_PROFILE = ["transaction_id", "usd_amount", "sender_typed", "receiver_typed", "risk_level"]
add(
    "null_profile",
    lambda spark, sf: quality.null_profile(sample.tx(spark, sf, _PROFILE)),
    o.q(
        o.TX,
        " UNION ALL ".join(
            f"SELECT '{x}' AS column_name, count(*)-count({x}) AS null_count, "
            f"{o.pct(f'(count(*)-count({x}))', 'count(*)')} AS null_percent FROM tx"
            for x in _PROFILE
        ),
    ),
)
_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_STAT_SQL = {
    "count": "CAST(count({x}) AS DOUBLE)",
    "mean": o.r("avg({x})", 4),
    "stddev": o.r("stddev_samp({x})", 4),
    "min": "min({x})",
    "25%": "quantile_disc({x}, 0.25)",
    "50%": "quantile_disc({x}, 0.5)",
    "75%": "quantile_disc({x}, 0.75)",
    "max": "max({x})",
}


def _numeric_summary(spark, sf):
    out = quality.numeric_summary(sample.table(spark, sf, "lineitem"), _NUMERIC, exact=True)
    return out.select("summary", *[F.round(x, 4).alias(x) for x in _NUMERIC])


add(
    "numeric_summary",
    _numeric_summary,
    " UNION ALL ".join(
        f"SELECT '{n}' AS summary, "
        + ", ".join(f"{e.replace('{x}', x)} AS {x}" for x in _NUMERIC)
        + " FROM lineitem"
        for n, e in _STAT_SQL.items()
    ),
)
add(
    "transfer_summary",
    lambda spark, sf: profile.transfer_summary(
        tx("usd_amount", "thb_amount", "risk_level", "event_ts")(spark, sf)
    ),
    o.q(
        o.TX,
        f"""SELECT count(*) AS total_transactions, {o.s("usd_amount")} AS total_volume_usd,
{o.s("thb_amount")} AS total_volume_thb, {o.cnt("risk_level IN ('medium','high')")} AS suspicious_transactions,
{o.ts("min(event_ts)")} AS earliest, {o.ts("max(event_ts)")} AS latest,
{o.r(f"({o.s('usd_amount')}/count(*))", 2)} AS average_transaction_usd,
{o.pct("count(*) FILTER (WHERE risk_level IN ('medium','high'))", "count(*)")} AS fraud_rate FROM tx""",
    ),
)
for _key, _col in (("crypto_counts", "crypto_currency"), ("country_counts", "sender_country")):
    add(
        _key,
        lambda spark, sf, col=_col: profile.counts_by(tx(col)(spark, sf), col),
        o.q(o.TX, f"SELECT {_col}, count(*) AS transaction_count FROM tx GROUP BY 1"),
    )
add(
    "biz_totals",
    lambda spark, sf: profile.biz_totals(tx("usd_amount", "thb_equivalent")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT {o.s("usd_amount")} AS total_usd, {o.s("thb_equivalent")} AS total_thb,
count(*) AS transaction_count, {o.a("usd_amount")} AS average_amount_usd FROM tx""",
    ),
)
add(
    "top_currencies",
    lambda spark, sf: profile.top_currencies(tx("crypto_currency")(spark, sf)),
    o.q(o.TX, "SELECT crypto_currency, count(*) AS transaction_count FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"),
)
add(
    "daily_volumes",
    lambda spark, sf: profile.daily_volumes(tx("event_date", "usd_amount")(spark, sf)),
    o.q(o.TX, f"SELECT {_DAY}, {o.s('usd_amount')} AS total_usd FROM tx GROUP BY 1"),
)
for _key, _col in (("top_senders", IDS[0]), ("top_receivers", IDS[1])):
    add(
        _key,
        lambda spark, sf, col=_col: profile.top_accounts(
            tx(col, "usd_amount", "transaction_id")(spark, sf), col
        ),
        o.q(
            o.TX,
            f"""SELECT {_col}, {o.s("usd_amount")} AS total_usd, count(transaction_id) AS transaction_count
FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        ),
    )
add(
    "fraud_overview",
    lambda spark, sf: profile.fraud_overview(tx(*CORE)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT {o.cnt("is_suspicious=1")} AS total_suspicious,
{o.s("usd_amount", where="is_suspicious=1")} AS suspicious_volume_usd,
{o.cnt("risk_score>70")} AS high_risk_transactions,
{o.pct("count(*) FILTER (WHERE is_suspicious=1)", "count(*)", None)} AS fraud_percentage FROM tx""",
    ),
)
_USER_TX = (
    "event_ts transaction_id account_type is_suspicious risk_score crypto_currency usd_amount "
    "sender_user_id receiver_user_id sender_country receiver_country sender_kyc_level "
    "receiver_kyc_level from_exchange to_exchange"
).split()
add(
    "user_accounts",
    lambda spark, sf: accounts.extract_users(
        sample.tx(spark, sf, _USER_TX), F.lit("2001-11-04").cast("date")
    ),
    o.q(
        o.TX
        + """, sides AS (
SELECT sender_user_id AS user_id, 0 AS role, sender_country AS country, sender_kyc_level AS kyc, from_exchange AS exchange, * FROM tx
UNION ALL SELECT receiver_user_id, 1, receiver_country, receiver_kyc_level, to_exchange, * FROM tx),
coins AS (SELECT user_id, array_to_string(list(crypto_currency ORDER BY v DESC, crypto_currency)[1:3], ',') AS preferred_cryptos
FROM (SELECT user_id, crypto_currency, sum(CAST(floor(usd_amount*1e2+0.5) AS BIGINT)*(2-role)) AS v FROM sides GROUP BY 1,2) GROUP BY 1)""",
        f"""SELECT user_id, first(account_type ORDER BY event_ts, transaction_id, role) AS account_type,
first(country ORDER BY event_ts, transaction_id, role) AS country,
first(kyc ORDER BY event_ts, transaction_id, role) AS kyc_level,
first(exchange ORDER BY event_ts, transaction_id, role) AS exchange,
substr(split_part(user_id,'_',2),1,8)||'@example.com' AS email, '2001-11-04' AS registration_date,
first(CASE WHEN is_suspicious=1 THEN 'high' WHEN risk_score>50 THEN 'medium' ELSE 'low' END
 ORDER BY event_ts, transaction_id, role) AS risk_profile,
{o.r("(CAST(sum(CAST(floor(usd_amount*1e2+0.5) AS BIGINT)*(2-role)) AS DOUBLE)/2e2)", 2)} AS monthly_volume_usd,
first(preferred_cryptos) AS preferred_cryptos FROM sides JOIN coins USING (user_id) GROUP BY user_id""",
    ),
)
add(
    "account_distribution",
    lambda spark, sf: accounts.account_distribution(sample.users(spark, sf)),
    o.q(
        o.USERS,
        "SELECT account_type, country, count(*) AS user_count FROM users GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 10",
    ),
)

# --- BI questions -------------------------------------------------------------------------
S, A = o.s("usd_amount"), o.a("usd_amount")
TR = f"CAST(floor({S}) AS BIGINT)"
SUSP = f"CAST({o.SUSP} AS BIGINT)"
XB = "sender_country<>receiver_country"
E_DAY = f"TIMESTAMP '{EV_AS_OF}'"
T_DAY = f"TIMESTAMP '{TX_AS_OF}'"
ev_tx = sample.ev_tx

add(
    "m1_corridors",
    lambda spark, sf: bi.corridors(tx(*PAIR, *CORE)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT sender_country, receiver_country, count(*) AS transaction_count, {S} AS total_volume_usd,
{A} AS avg_transaction_size, {SUSP} AS suspicious_count, {o.r(o.ARISK, 1)} AS avg_risk_score
FROM tx WHERE {XB} GROUP BY 1,2 ORDER BY total_volume_usd DESC, 1, 2 LIMIT 20""",
    ),
)
_OR_AGG = f"""count(t.transaction_id) AS transaction_count, {o.s("t.usd_amount")} AS total_volume,
CAST(sum(t.risk_score) AS DOUBLE)/nullif(count(t.risk_score),0) AS avg_risk_score"""
add(
    "m2_top_users",
    lambda spark, sf: bi.top_users(sample.users(spark, sf), _JOIN_TX(spark, sf)),
    o.q(
        _TX_USERS,
        f"""SELECT ua.user_id, ua.account_type, ua.country, ua.exchange, ua.kyc_level, ua.monthly_volume_usd,
{_OR_AGG}, array_to_string(ua.preferred_cryptos, ',') AS preferred_cryptos FROM {_OR}
GROUP BY 1,2,3,4,5,6,ua.preferred_cryptos ORDER BY total_volume DESC NULLS LAST, 1 LIMIT 50""",
    ),
)
add(
    "m3_latest_prices",
    lambda spark, sf: bi.latest_prices(sample.prices(spark, sf)),
    o.q(
        o.PRICES,
        f"""SELECT symbol, {o.r("price", 4)} AS current_price_usd, {o.r("volume_24h", 0)} AS volume_24h_usd,
{o.r("change_24h", 2)} AS change_24h_percent, {o.ts("timestamp")} AS last_updated FROM (
SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS rn FROM prices) WHERE rn=1
ORDER BY volume_24h DESC, symbol LIMIT 20""",
    ),
)
add(
    "m4_volumes",
    lambda spark, sf: bi.exchange_volumes(sample.volumes(spark, sf)),
    o.q(
        o.VOLUMES,
        f"""SELECT {o.day("trade_date")} AS trading_date, exchange, symbol, {o.s("volume_usd")} AS daily_volume,
{o.a("volume_usd")} AS avg_volume, count(*) AS trading_sessions FROM volumes GROUP BY 1,2,3""",
    ),
)
add(
    "m5_fraud_patterns",
    lambda spark, sf: bi.fraud_patterns(
        tx("event_date", *PAIR, "account_type", *CORE)(spark, sf), min_rows=2
    ),
    o.q(
        o.TX,
        f"""SELECT {o.day("event_date")} AS transaction_date, sender_country, receiver_country, account_type,
count(*) AS total_transactions, {SUSP} AS suspicious_transactions, {S} AS total_volume,
{o.s("usd_amount", where="is_suspicious=1")} AS suspicious_volume, {o.ARISK} AS avg_risk_score,
max(risk_score) AS max_risk_score, {o.pct(o.SUSP, "count(*)")} AS fraud_rate_percent
FROM tx GROUP BY 1,2,3,4 HAVING count(*)>=2 ORDER BY fraud_rate_percent DESC, total_volume DESC,1,2,3,4 LIMIT 100""",
    ),
)
add(
    "m6_risky_24h",
    lambda spark, sf: bi.risky_senders(ev_tx(spark, sf), moment(EV_AS_OF), min_rows=3, min_risk=50),
    o.q(
        o.EV,
        f"""SELECT sender_user_id, sender_country, count(*) AS transactions_24h, {S} AS volume_24h,
{o.ARISK} AS avg_risk_score, {SUSP} AS suspicious_count, {o.ts("max(event_ts)")} AS last_transaction,
count(DISTINCT crypto_currency) AS currencies_used FROM ev
WHERE event_ts>={E_DAY}-INTERVAL 24 HOUR AND event_ts<={E_DAY} GROUP BY 1,2
HAVING count(*)>=3 AND {o.ARISK}>=50 ORDER BY avg_risk_score DESC, volume_24h DESC,1,2 LIMIT 50""",
    ),
)


def _money(x: str) -> str:
    return f"'$'||CAST(CAST({o.r(x, 0)} AS BIGINT) AS VARCHAR)"


add(
    "m7_kpis",
    lambda spark, sf: bi.kpis(tx(*PAIR, *CORE)(spark, sf), sample.users(spark, sf)),
    o.q(
        _TX_USERS,
        f"""SELECT 'Total Transactions' AS metric, count(*) AS value, {_money(S)} AS volume FROM tx
UNION ALL SELECT 'Cross-Border Transfers', count(*), {_money(S)} FROM tx WHERE {XB}
UNION ALL SELECT 'Suspicious Transactions', {SUSP}, {_money(o.s("usd_amount", where="is_suspicious=1"))} FROM tx
UNION ALL SELECT 'Active Users', count(*), 'N/A' FROM users
UNION ALL SELECT 'Countries Served', count(DISTINCT country), 'N/A' FROM users""",
    ),
)
add(
    "m8_flow_network",
    lambda spark, sf: bi.flow_network(tx(*PAIR, *CORE)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT sender_country AS source, receiver_country AS target, count(*) AS transaction_count,
{S} AS flow_volume, {A} AS avg_amount, {o.r(o.ARISK, 1)} AS avg_risk FROM tx WHERE {XB} GROUP BY 1,2
HAVING count(*)>=10 ORDER BY flow_volume DESC,1,2 LIMIT 100""",
    ),
)
add(
    "m9_price_vs_volume",
    lambda spark, sf: bi.price_vs_volume(
        sample.prices(spark, sf), tx("transaction_id", "crypto_currency", "usd_amount")(spark, sf), moment(EV_AS_OF)
    ),
    o.q(
        _TX_PRICES,
        f"""SELECT coin AS symbol, {o.r("price", 4)} AS price, {o.r("change_24h", 2)} AS change_24h_percent,
volume_24h AS market_volume_24h, count(t.transaction_id) AS platform_transactions,
{o.s("t.usd_amount")} AS platform_volume, {o.r(o.a("t.usd_amount"), 2)} AS avg_transaction_size
FROM prices p LEFT JOIN tx t ON p.coin=t.crypto_currency
WHERE p.timestamp>={E_DAY}-INTERVAL 1 DAY AND p.timestamp<={E_DAY} GROUP BY coin, price, change_24h, volume_24h""",
    ),
)
add(
    "v1_corridor_bar",
    lambda spark, sf: bi.corridor_bar(tx(*PAIR, "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT sender_country||' → '||receiver_country AS corridor, count(*) AS transactions,
{TR} AS volume_usd, {o.r(A, 0)} AS avg_transaction FROM tx WHERE {XB} GROUP BY 1 ORDER BY volume_usd DESC,1 LIMIT 15""",
    ),
)
add(
    "v2_account_risk",
    lambda spark, sf: bi.account_risk(tx("account_type", *CORE)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT account_type, count(*) AS total_transactions, {SUSP} AS suspicious_transactions,
{o.r(o.ARISK, 1)} AS avg_risk_score, {TR} AS total_volume_usd,
{o.pct(o.SUSP, "count(*)", 1)} AS fraud_rate_percent FROM tx GROUP BY 1""",
    ),
)
add(
    "v3_assets",
    lambda spark, sf: bi.top_assets(tx("crypto_currency", "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT crypto_currency AS cryptocurrency, count(*) AS transaction_count, {TR} AS volume_usd,
{o.r(A, 0)} AS avg_amount FROM tx GROUP BY 1 ORDER BY volume_usd DESC,1 LIMIT 10""",
    ),
)
add(
    "v4_country_flows",
    lambda spark, sf: bi.country_totals(tx(*PAIR, "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT 'outgoing' AS direction, sender_country AS country, count(*) AS transactions, {TR} AS volume
FROM tx GROUP BY 2 UNION ALL SELECT 'incoming', receiver_country, count(*), {TR} FROM tx GROUP BY 2""",
    ),
)
add(
    "v5_daily_trend",
    lambda spark, sf: bi.daily_trend(tx("event_date", *CORE)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT {o.day("event_date")} AS transaction_date, count(*) AS daily_transactions, {TR} AS daily_volume,
{SUSP} AS daily_suspicious, {o.r(o.ARISK, 1)} AS avg_daily_risk FROM tx GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    ),
)
add(
    "v6_users",
    lambda spark, sf: bi.user_table(sample.users(spark, sf), _JOIN_TX(spark, sf)),
    o.q(
        _TX_USERS,
        f"""SELECT ua.user_id, ua.account_type, ua.country, ua.kyc_level, count(t.transaction_id) AS transaction_count,
CAST(floor({o.s("t.usd_amount")}) AS BIGINT) AS total_volume_usd,
{o.r("(CAST(sum(t.risk_score) AS DOUBLE)/nullif(count(t.risk_score),0))", 1)} AS avg_risk_score,
CAST(sum(CASE WHEN t.is_suspicious=1 THEN 1 ELSE 0 END) AS BIGINT) AS suspicious_count,
array_to_string(ua.preferred_cryptos, ', ') AS preferred_cryptos FROM {_OR}
GROUP BY 1,2,3,4,ua.preferred_cryptos ORDER BY total_volume_usd DESC NULLS LAST, 1 LIMIT 20""",
    ),
)
_LISTED = ",".join(f"'{x}'" for x in fixed.PRICE_TRACKER_SYMBOLS)
add(
    "v7_price_tracker",
    lambda spark, sf: bi.price_tracker(sample.prices(spark, sf)),
    o.q(
        o.PRICES,
        f"""SELECT symbol, {o.r("price", 6)} AS current_price, {o.r("change_24h", 2)} AS change_24h_percent,
source AS exchange, {o.ts("timestamp")} AS last_updated FROM prices
WHERE (symbol, timestamp) IN (SELECT symbol, max(timestamp) FROM prices GROUP BY 1) AND symbol IN ({_LISTED})""",
    ),
)
add(
    "v8_alerts",
    lambda spark, sf: bi.risk_alerts(ev_tx(spark, sf), moment(EV_AS_OF)),
    o.q(
        o.EV,
        f"""SELECT sender_user_id AS user_id, sender_country AS country, count(*) AS recent_transactions,
{TR} AS total_volume, {o.r(o.ARISK, 1)} AS avg_risk_score, {SUSP} AS suspicious_count,
{o.ts("max(event_ts)")} AS last_transaction,
array_to_string(list_sort(list(DISTINCT crypto_currency)), ', ') AS currencies_used FROM ev
WHERE event_ts>={E_DAY}-INTERVAL 7 DAY AND event_ts<={E_DAY} AND risk_score>=70 GROUP BY 1,2 HAVING count(*)>=2
ORDER BY avg_risk_score DESC, total_volume DESC,1,2 LIMIT 25""",
    ),
)
_MONEY = f"'$'||CAST({TR} AS VARCHAR)"
add(
    "v9_cards",
    lambda spark, sf: bi.cards(tx(*PAIR, *CORE, "crypto_currency")(spark, sf), sample.users(spark, sf)),
    o.q(
        _TX_USERS,
        f"""SELECT 'Total Transactions' AS metric, CAST(count(*) AS VARCHAR) AS value FROM tx
UNION ALL SELECT 'Total Volume (USD)', {_MONEY} FROM tx
UNION ALL SELECT 'Cross-Border Volume', {_MONEY} FROM tx WHERE {XB}
UNION ALL SELECT 'Suspicious Transactions', CAST({SUSP} AS VARCHAR) FROM tx
UNION ALL SELECT 'Active Users', CAST(count(*) AS VARCHAR) FROM users
UNION ALL SELECT 'Countries Served', CAST(count(DISTINCT country) AS VARCHAR) FROM users
UNION ALL SELECT 'Crypto Assets', CAST(count(DISTINCT crypto_currency) AS VARCHAR) FROM tx
UNION ALL SELECT 'Average Risk Score', CAST({o.r(o.ARISK, 1)} AS VARCHAR) FROM tx""",
    ),
)
add(
    "v10_sample",
    lambda spark, sf: bi.scatter_sample(
        tx("transaction_id", "usd_amount", "risk_score", "account_type", "sender_country", "crypto_currency")(spark, sf)
    ),
    o.q(
        o.TX,
        """SELECT transaction_id, usd_amount AS volume_usd, risk_score, CASE account_type WHEN 'whale' THEN 'Whale'
WHEN 'suspicious' THEN 'Suspicious' ELSE 'Regular' END AS account_category, sender_country, crypto_currency
FROM tx WHERE usd_amount>1000 ORDER BY md5(transaction_id), transaction_id LIMIT 1000""",
    ),
)
add(
    "a1_overview",
    lambda spark, sf: bi.overview(
        tx("usd_amount", "event_date", "sender_user_id", "is_suspicious")(spark, sf), moment(TX_AS_OF)
    ),
    o.q(
        o.TX,
        f"""SELECT 'Total Transaction Volume' AS metric, '$'||{o.readable(S)} AS value FROM tx
UNION ALL SELECT 'Total Transactions', CAST(count(*) AS VARCHAR) FROM tx
UNION ALL SELECT 'Active Users (30d)', CAST(count(DISTINCT sender_user_id) AS VARCHAR) FROM tx
 WHERE event_date>=CAST({T_DAY} AS DATE)-30 AND event_date<=CAST({T_DAY} AS DATE)
UNION ALL SELECT 'Fraud Rate', printf('%.2f', {o.pct(o.SUSP, "count(is_suspicious)")})||'%' FROM tx""",
    ),
)
add(
    "corridor_share",
    lambda spark, sf: bi.corridor_share(tx(*PAIR, "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT corridor, transaction_count, '$'||{o.readable("usd")} AS total_volume, avg_amount,
printf('%.2f', {o.r("(usd*1e2/total)", 2)})||'%' AS volume_share FROM (
SELECT sender_country||' → '||receiver_country AS corridor, count(*) AS transaction_count, {S} AS usd,
{o.r(A, 2)} AS avg_amount, (SELECT {S} FROM tx WHERE {XB}) AS total FROM tx WHERE {XB}
GROUP BY 1 ORDER BY usd DESC, 1 LIMIT 10)""",
    ),
)
_BOARD = ",".join(f"'{x}'" for x in fixed.PRICE_BOARD_SYMBOLS)
add(
    "a3_price_board",
    lambda spark, sf: bi.price_board(sample.prices(spark, sf)),
    o.q(
        o.PRICES,
        f"""SELECT coin AS symbol, price AS current_price, volume_24h, change_24h AS percent_change_24h, market_cap,
{o.ts("timestamp")} AS last_updated FROM prices WHERE coin IN ({_BOARD})""",
    ),
)
add(
    "a4_daily_30d",
    lambda spark, sf: bi.daily_volume(tx("event_date", "usd_amount")(spark, sf), moment(TX_AS_OF)),
    o.q(
        o.TX,
        f"""SELECT {o.day("event_date")} AS date, count(*) AS transaction_count, {S} AS total_volume FROM tx
WHERE event_date>=CAST({T_DAY} AS DATE)-30 AND event_date<=CAST({T_DAY} AS DATE) GROUP BY 1""",
    ),
)
_FRAUD_USD = "CASE WHEN is_suspicious=1 THEN usd_amount ELSE 0 END"
add(
    "a5_fraud_type",
    lambda spark, sf: bi.fraud_by_account(tx("account_type", "is_suspicious", "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT account_type, count(*) AS total_transactions, {SUSP} AS suspicious_transactions,
{o.pct(o.SUSP, "count(is_suspicious)")} AS fraud_rate_percent,
{o.r(o.a(_FRAUD_USD), 2)} AS avg_fraud_amount FROM tx GROUP BY 1""",
    ),
)
add(
    "a6_geo",
    lambda spark, sf: bi.geography(tx("sender_country", "usd_amount", "sender_user_id")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT sender_country AS country, count(*) AS transaction_count, {S} AS total_volume,
count(DISTINCT sender_user_id) AS unique_users FROM tx GROUP BY 1 ORDER BY total_volume DESC,1 LIMIT 15""",
    ),
)
add(
    "a7_currency",
    lambda spark, sf: bi.currency_volume(tx("crypto_currency", "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT crypto_currency AS currency, count(*) AS transaction_count, {S} AS total_volume,
{o.r(A, 2)} AS avg_transaction_size FROM tx GROUP BY 1 ORDER BY total_volume DESC,1 LIMIT 10""",
    ),
)
add(
    "a8_hourly_fraud",
    lambda spark, sf: bi.hourly_fraud(ev_tx(spark, sf)),
    o.q(
        o.EV,
        f"""SELECT hour(event_ts) AS hour_of_day, count(*) AS total_transactions, {SUSP} AS suspicious_count,
{o.pct(o.SUSP, "count(is_suspicious)", 1)} AS fraud_rate_percent FROM ev GROUP BY 1""",
    ),
)
add(
    "a9_high_value",
    lambda spark, sf: bi.high_value(
        tx("transaction_id", *IDS, *PAIR, "crypto_currency", "usd_amount", "event_date", "is_suspicious")(spark, sf)
    ),
    o.q(
        o.TX,
        f"""SELECT transaction_id, sender_user_id AS sender_id, receiver_user_id AS recipient_id,
sender_country||' → '||receiver_country AS corridor, crypto_currency AS currency, usd_amount AS amount,
{o.day("event_date")} AS transaction_date,
CASE WHEN is_suspicious=1 THEN '🚨 Suspicious' ELSE '✅ Normal' END AS status FROM tx WHERE usd_amount>=50000
ORDER BY usd_amount DESC, event_date DESC, transaction_id LIMIT 20""",
    ),
)


def _segments(spark, sf):
    activity = joins.user_activity(tx("usd_amount", *IDS)(spark, sf))
    people = sample.users(spark, sf).join(activity, "user_id", "left")
    return bi.segments(people.na.fill(0, subset=["total_transaction_volume", "transaction_count"]))


add(
    "a10_segments",
    _segments,
    o.q(
        _TX_USERS,
        f"""SELECT account_type, count(DISTINCT user_id) AS user_count, {o.r(o.a("vol"), 2)} AS avg_user_volume,
{o.r("(CAST(sum(n) AS DOUBLE)/count(n))", 2)} AS avg_transactions_per_user, max(vol) AS max_user_volume FROM (
SELECT u.user_id, u.account_type, coalesce({o.s("t.usd_amount")},0e0) AS vol, count(t.sender_user_id) AS n
FROM users u LEFT JOIN tx t ON t.sender_user_id=u.user_id GROUP BY 1,2) GROUP BY 1""",
    ),
)
add(
    "a11_exchanges",
    lambda spark, sf: bi.exchange_comparison(sample.volumes(spark, sf), moment(TX_AS_OF), 30),
    o.q(
        o.VOLUMES,
        f"""SELECT exchange, {o.s("volume_usd")} AS total_volume_usd, CAST(sum(daily_trades) AS BIGINT) AS total_trades,
{o.r(o.a("avg_trade_size", 6), 2)} AS avg_trade_size, count(DISTINCT symbol) AS symbols_traded FROM volumes
WHERE trade_date>=CAST({T_DAY} AS DATE)-30 AND trade_date<=CAST({T_DAY} AS DATE) GROUP BY 1""",
    ),
)
add(
    "a12_risk_buckets",
    lambda spark, sf: bi.risk_buckets(tx("risk_score", "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT CASE WHEN risk_score<20 THEN 'Low Risk (0-19)' WHEN risk_score<50 THEN 'Medium Risk (20-49)'
WHEN risk_score<70 THEN 'High Risk (50-69)' ELSE 'Critical Risk (70+)' END AS risk_category,
count(*) AS transaction_count, {o.r(A, 2)} AS avg_amount, {S} AS total_volume FROM tx GROUP BY 1""",
    ),
)
_BETWEEN = "from_exchange='Binance_Global' AND to_exchange='Binance_TH'"
_ENDS = ("from_exchange", "to_exchange")
add(
    "s1_monthly",
    lambda spark, sf: bi.monthly_volume(
        tx(*_ENDS, "event_ts", "crypto_currency", "usd_amount", "thb_equivalent")(spark, sf), moment(TX_AS_OF)
    ),
    o.q(
        o.TX,
        f"""SELECT CAST(strftime(event_ts,'%Y%m') AS BIGINT) AS month, crypto_currency AS currency,
count(*) AS transaction_count, {S} AS total_usd_volume, {o.s("thb_equivalent")} AS total_thb_volume,
{A} AS avg_transaction_usd FROM tx WHERE {_BETWEEN} AND event_ts>={T_DAY}-INTERVAL 6 MONTH AND event_ts<={T_DAY}
GROUP BY 1,2""",
    ),
)
add(
    "s2_accounts",
    lambda spark, sf: bi.pair_accounts(
        tx(*_ENDS, "sender_user_id", "account_type", "sender_country", *CORE)(spark, sf)
    ),
    o.q(
        o.TX,
        f"""SELECT sender_user_id, account_type, sender_country, count(*) AS transaction_count, {S} AS total_volume_usd,
{A} AS avg_transaction_usd, max(usd_amount) AS max_transaction_usd, {o.ARISK} AS avg_risk_score FROM tx
WHERE {_BETWEEN} GROUP BY 1,2,3 ORDER BY total_volume_usd DESC,1,2,3 LIMIT 10""",
    ),
)
_OVER = "OVER (PARTITION BY symbol ORDER BY timestamp, source, price)"
add(
    "s3_price_change",
    lambda spark, sf: bi.price_series(sample.prices(spark, sf)),
    o.q(
        o.PRICES,
        f"""SELECT symbol, source, price, {o.ts("timestamp")} AS timestamp, lag(price) {_OVER} AS prev_price,
(price-lag(price) {_OVER})/nullif(lag(price) {_OVER},0)*1e2 AS price_change_pct FROM prices
WHERE source IN ('binance_global','binance_th') AND symbol LIKE '%THB'""",
    ),
)
add(
    "s4_trades",
    lambda spark, sf: bi.trade_counts(sample.volumes(spark, sf), moment(TX_AS_OF), 30),
    o.q(
        o.VOLUMES,
        f"""SELECT exchange, symbol, {o.day("trade_date")} AS date, daily_trades AS transaction_count, daily_volume,
price_change_pct FROM volumes WHERE trade_date>=CAST({T_DAY} AS DATE)-30 AND trade_date<=CAST({T_DAY} AS DATE)""",
    ),
)
add(
    "s5_senders",
    lambda spark, sf: bi.pair_senders(
        tx(*_ENDS, *IDS, "sender_country", "account_type", "sender_kyc_level", *CORE)(spark, sf)
    ),
    o.q(
        o.TX,
        f"""SELECT sender_user_id AS user_id, sender_country AS country, account_type, sender_kyc_level AS kyc_level,
count(*) AS send_count, {S} AS total_sent_usd, count(DISTINCT receiver_user_id) AS unique_receivers,
{o.ARISK} AS avg_risk_score FROM tx WHERE {_BETWEEN} GROUP BY 1,2,3,4 ORDER BY total_sent_usd DESC,1,2,3,4 LIMIT 5""",
    ),
)
add(
    "s6_receivers",
    lambda spark, sf: bi.pair_receivers(
        tx(*_ENDS, *IDS, "receiver_country", "receiver_kyc_level", *CORE)(spark, sf)
    ),
    o.q(
        o.TX,
        f"""SELECT receiver_user_id AS user_id, receiver_country AS country, receiver_kyc_level AS kyc_level,
count(*) AS receive_count, {S} AS total_received_usd, count(DISTINCT sender_user_id) AS unique_senders,
{o.ARISK} AS avg_risk_score FROM tx WHERE {_BETWEEN} GROUP BY 1,2,3 ORDER BY total_received_usd DESC,1,2,3 LIMIT 5""",
    ),
)
# The sample's events are small and sparse, so width and thresholds are given.
_RULES = fraud.VelocityRules(max_single=100, min_total=100, receivers=5, medium_risk=55)


def _window_sql(src: str, width: str, slide: str, steps: int, where: str = "true") -> str:
    return f"""win AS (SELECT sender_user_id, w AS window_start, w+INTERVAL {width} AS window_end,
count(*) AS transactions, {S} AS total_amount, count(DISTINCT receiver_user_id) AS unique_receivers,
{o.ARISK} AS avg_risk_score, max(usd_amount) AS max_single_transaction FROM (
SELECT *, time_bucket(INTERVAL {slide}, event_ts)-i*INTERVAL {slide} AS w FROM {src}, range({steps}) g(i) WHERE {where})
GROUP BY 1,2)"""


_WIN_COLS = f"""sender_user_id, {o.ts("window_start")} AS window_start, {o.ts("window_end")} AS window_end,
transactions, total_amount, unique_receivers, avg_risk_score, max_single_transaction"""
_CLASS = """CASE WHEN max_single_transaction>100 AND total_amount>100 AND unique_receivers>5 THEN 'HIGH_FRAUD_RISK'
WHEN avg_risk_score>55 THEN 'MEDIUM_FRAUD_RISK' ELSE 'LOW_RISK' END AS fraud_classification"""
add(
    "s7_window_fraud",
    lambda spark, sf: bi.window_fraud(ev_tx(spark, sf), width="1 day", rules=_RULES),
    o.q(
        o.EV + ", " + _window_sql("ev", "1 DAY", "1 DAY", 1),
        f"SELECT {_WIN_COLS}, {_CLASS} FROM win WHERE total_amount>100",
    ),
)
add(
    "velocity_fraud",
    lambda spark, sf: fraud.velocity_fraud(ev_tx(spark, sf), "1 day", "6 hours", _RULES),
    o.q(
        o.EV + ", " + _window_sql("ev", "1 DAY", "6 HOURS", 4),
        f"""SELECT * FROM (SELECT {_WIN_COLS}, {_CLASS} FROM win WHERE total_amount>100)
WHERE fraud_classification='HIGH_FRAUD_RISK'""",
    ),
)
add(
    "rapid_fire",
    lambda spark, sf: fraud.rapid_fire(
        ev_tx(spark, sf), "1 day", "6 hours", fraud.RapidRules(each=5, total=100, receivers=5)
    ),
    o.q(
        o.EV + ", " + _window_sql("ev", "1 DAY", "6 HOURS", 4, "usd_amount>=5"),
        f"SELECT {_WIN_COLS} FROM win WHERE total_amount>=100 AND unique_receivers>=5",
    ),
)
add(
    "round_amounts",
    lambda spark, sf: fraud.round_amounts(tx("transaction_id", "usd_amount")(spark, sf), multiple_of=10),
    o.q(o.TX, "SELECT transaction_id, usd_amount FROM tx WHERE usd_amount>0 AND usd_amount%10e0=0"),
)
add(
    "s8_high_value_alert",
    lambda spark, sf: bi.high_value_alert(ev_tx(spark, sf), moment(EV_AS_OF), "1 HOUR", 20),
    o.q(
        o.EV,
        f"""SELECT count(*) AS high_value_transactions, {S} AS total_value_usd FROM ev
WHERE usd_amount>20 AND event_ts>={E_DAY}-INTERVAL 1 HOUR AND event_ts<={E_DAY}""",
    ),
)
add(
    "s8_high_value_default",
    lambda spark, sf: bi.high_value_alert(tx(*CORE, "event_ts")(spark, sf), moment(TX_AS_OF)),
    o.q(
        o.TX,
        f"""SELECT count(*) AS high_value_transactions, {S} AS total_value_usd FROM tx
WHERE usd_amount>50000 AND event_ts>=TIMESTAMP '{TX_AS_OF}'-INTERVAL 1 HOUR AND event_ts<=TIMESTAMP '{TX_AS_OF}'""",
    ),
)
_STATS = f"""count(*) AS total_transactions, {S} AS total_volume, {A} AS avg_amount,
count(DISTINCT sender_country) AS sender_countries, count(DISTINCT receiver_country) AS receiver_countries"""
_SPLIT = f"is_suspicious, count(*) AS count, {o.ARISK} AS avg_risk_score, {S} AS total_volume"
add(
    "d1_stats",
    lambda spark, sf: bi.stats(tx(*PAIR, "usd_amount")(spark, sf)),
    o.q(o.TX, f"SELECT {_STATS} FROM tx"),
)
add(
    "d2_fraud_split",
    lambda spark, sf: bi.fraud_split(tx(*CORE)(spark, sf)),
    o.q(o.TX, f"SELECT {_SPLIT} FROM tx GROUP BY 1"),
)


def _daily_report(spark, sf):
    """The document, read back and laid out as rows."""
    report = bi.daily_report(tx(*PAIR, *CORE)(spark, sf), "2001-11-04", "2001-11-05T01:00:00")
    schema = """date string, transaction_summary struct<total_transactions: bigint, total_volume: double,
        avg_amount: double, sender_countries: bigint, receiver_countries: bigint>,
        fraud_analysis array<struct<is_suspicious: int, count: bigint, avg_risk_score: double,
        total_volume: double>>, generated_at string"""
    doc = report.select(F.from_json("report", schema).alias("r"))
    return doc.select(
        "r.date", "r.generated_at", "r.transaction_summary.*", F.explode("r.fraud_analysis").alias("f")
    ).select(
        "date", "generated_at", "total_transactions", "total_volume", "avg_amount", "sender_countries",
        "receiver_countries", "f.is_suspicious", "f.count", "f.avg_risk_score",
        c("f.total_volume").alias("split_volume"),
    )


add(
    "d3_daily_report",
    _daily_report,
    o.q(
        o.TX,
        f"""SELECT '2001-11-04' AS date, '2001-11-05T01:00:00' AS generated_at, a.*, b.is_suspicious, b.count,
b.avg_risk_score, b.total_volume AS split_volume FROM (SELECT {_STATS} FROM tx) a,
(SELECT {_SPLIT} FROM tx GROUP BY 1) b""",
    ),
)
_TABLES = ("lineitem", "orders", "customer", "events")
add(
    "d4_row_counts",
    lambda spark, sf: bi.row_counts({t: sample.table(spark, sf, t) for t in _TABLES}),
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES),
)
add(
    "d5_totals",
    lambda spark, sf: bi.totals(tx("usd_amount", "thb_equivalent")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT count(*) AS total_transactions, {S} AS total_usd_volume,
{o.s("thb_equivalent")} AS total_thb_volume, {A} AS avg_transaction_usd FROM tx""",
    ),
)
add(
    "d6_suspicious",
    lambda spark, sf: bi.suspicious_totals(tx(*CORE)(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT count(*) AS suspicious_count, {S} AS suspicious_volume_usd, {o.ARISK} AS avg_risk_score
FROM tx WHERE is_suspicious=1""",
    ),
)
add(
    "d7_latest",
    lambda spark, sf: bi.latest(tx("transaction_id", "event_ts", *PAIR, "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT transaction_id, {o.ts("event_ts")} AS event_ts, sender_country, receiver_country, usd_amount FROM tx
ORDER BY tx.event_ts DESC, transaction_id LIMIT 5""",
    ),
)
add(
    "d8_big_risky",
    lambda spark, sf: bi.big_risky_senders(tx("risk_level", "sender_user_id", "usd_amount")(spark, sf)),
    o.q(
        o.TX,
        f"""SELECT sender_user_id, count(*) AS tx_count, {S} AS total_volume FROM tx
WHERE risk_level IN ('medium','high') GROUP BY 1 HAVING {S}>30000""",
    ),
)

# --- streaming rules in batch, documented extras ----------------------------------------
add(
    "dedup_tx",
    lambda spark, sf: fraud.dedup(
        tx("order_line", "event_ts", "transaction_id", "usd_amount")(spark, sf),
        "order_line",
        order=["event_ts", "transaction_id"],
    ),
    o.q(
        o.TX,
        f"""SELECT order_line, {o.ts("event_ts")} AS event_ts, transaction_id, usd_amount FROM tx
QUALIFY row_number() OVER (PARTITION BY order_line ORDER BY tx.event_ts, transaction_id)=1""",
    ),
)
add(
    "lag_health",
    lambda spark, sf: fraud.lag_health(sample.offsets(spark, sf)),
    """WITH p AS (SELECT event_type AS topic, max(event_id) AS e,
max(CASE WHEN CAST(json_extract_string(props,'$.k') AS BIGINT)<50 THEN event_id END) AS m FROM events GROUP BY event_type, user_id),
t AS (SELECT topic, CAST(sum(greatest(0, e-coalesce(m,0))) AS BIGINT) AS lag FROM p GROUP BY 1),
w AS (SELECT CAST(sum(lag) AS BIGINT) AS total_lag FROM t)
SELECT topic, lag, CASE WHEN lag<100 THEN 'green' WHEN lag<1000 THEN 'yellow' ELSE 'red' END AS color, total_lag,
CASE WHEN total_lag<500 THEN 'HEALTHY' WHEN total_lag<2000 THEN 'WARNING' ELSE 'CRITICAL' END AS status FROM t, w""",
)


def _zscore(spark, sf):
    rows = ev_tx(spark, sf).select("transaction_id", "event_ts", "sender_user_id", "usd_amount")
    out = ordered.behavior_zscore(rows, n=20)
    return out.select(
        "transaction_id", "history_count",
        *[F.round(x, 6).alias(x) for x in ("history_mean", "history_stddev", "amount_zscore")],
    )


_HIST = "OVER (PARTITION BY sender_user_id ORDER BY event_ts, transaction_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
add(
    "behavior_zscore",
    _zscore,
    o.q(
        o.EV,
        f"""SELECT transaction_id, n AS history_count, {o.r("m", 6)} AS history_mean, {o.r("d", 6)} AS history_stddev,
CASE WHEN d>0 THEN {o.r("((usd_amount-m)/d)", 6)} END AS amount_zscore FROM (
SELECT *, count(usd_amount) {_HIST} AS n, avg(usd_amount) {_HIST} AS m, stddev_samp(usd_amount) {_HIST} AS d FROM ev)""",
    ),
)
add(
    "sender_features",
    lambda spark, sf: joins.sender_features(ev_tx(spark, sf)),
    o.q(
        o.EV,
        f"""SELECT *, total_sent/transaction_count AS avg_sent, night_count/CAST(transaction_count AS DOUBLE) AS night_share
FROM (SELECT sender_user_id, count(transaction_id) AS transaction_count, {S} AS total_sent, max(usd_amount) AS max_sent,
{o.a("aml_score", 6)} AS avg_aml_score, {o.cnt("is_suspicious=1")} AS suspicious_count,
{o.cnt("hour(event_ts)<6")} AS night_count, count(DISTINCT receiver_user_id) AS unique_receivers,
count(DISTINCT receiver_country) AS receiver_countries, count(DISTINCT crypto_currency) AS currencies
FROM ev GROUP BY 1)""",
    ),
)
