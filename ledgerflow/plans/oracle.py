"""Reference SQL for the registered queries, written for DuckDB over the raw sample tables.

Independent of the DataFrame code: plain SQL as the report states it (OR-joins, row-level
joins, UNION ALL), so that it checks the rewrites.
"""

from __future__ import annotations

from ledgerflow.sources import sample


# --- expressions ---------------------------------------------------------------
def s(x: str, scale: int = 2, where: str | None = None) -> str:
    u = f"CAST(floor(({x})*1e{scale}+0.5) AS BIGINT)"
    if where:
        u = f"CASE WHEN {where} THEN {u} ELSE 0 END"
    return f"(CAST(sum({u}) AS DOUBLE)/1e{scale})"


def a(x: str, scale: int = 2) -> str:
    return f"({s(x, scale)}/nullif(count({x}),0))"


def s8(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,8))) AS DOUBLE)"


def r(x: str, n: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16)),{n}) AS DOUBLE)"


def pct(x: str, y: str, n: int | None = 2) -> str:
    e = f"(CAST({x} AS DOUBLE)/nullif(CAST({y} AS DOUBLE),0)*1e2)"
    return e if n is None else r(e, n)


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def day(x: str) -> str:
    return f"strftime({x},'%Y-%m-%d')"


def ts(x: str) -> str:
    return f"strftime({x},'%Y-%m-%d %H:%M:%S.%f')"


def readable(x: str) -> str:
    steps = ((1e12, "trillion"), (1e9, "billion"), (1e6, "million"), (1e3, "thousand"))
    cases = " ".join(
        f"WHEN abs({x})>={size:.0f}e0 THEN printf('%.2f', {r(f'({x})/{size:.0f}e0', 2)})||' {word}'"
        for size, word in steps
    )
    return f"(CASE {cases} ELSE printf('%.2f', {r(x, 2)}) END)"


ARISK = "(CAST(sum(risk_score) AS DOUBLE)/count(risk_score))"
SUSP = "sum(CASE WHEN is_suspicious=1 THEN 1 ELSE 0 END)"


# --- views -----------------------------------------------------------------------
def _list(values) -> str:
    def one(v):
        if v is None:
            return "NULL"
        return "E'" + v.replace("\t", "\\t").replace("\n", "\\n") + "'"

    return "[" + ",".join(one(v) for v in values) + "]"


def _pick(values, index: str) -> str:
    return f"({_list(values)})[CAST({index} AS INT)+1]"


def _choose(key: str, table: dict[str, str], last: str | None = None) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    tail = f" ELSE '{last}'" if last else ""
    return f"CASE {key} {cases}{tail} END"


def _risk(aml: str) -> str:
    return f"CASE WHEN {aml}<=0.3e0 THEN 'low' WHEN {aml}<=0.6e0 THEN 'medium' ELSE 'high' END"


def _round(x: str, scale: int = 2) -> str:
    return f"floor(({x})*1e{scale}+0.5)/1e{scale}"


_CLEAN, _TYPED = sample.CLEAN_COUNTRIES, sample.TYPED_COUNTRIES

TX = f"""tx AS (
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
 concat_ws('-', l_orderkey, l_linenumber) AS order_line,
 l_shipdate AS event_ts, CAST(l_shipdate AS DATE) AS event_date,
 l_extendedprice AS usd_amount, {_round("l_extendedprice*35.5e0")} AS thb_amount,
 {_round("l_extendedprice*35.1e0")} AS thb_equivalent, l_tax AS fee_rate,
 {_round("l_extendedprice*l_tax", 4)} AS fee_usd, l_discount*1e1 AS aml_score,
 CAST(floor(l_discount*1e3+0.5) AS BIGINT) AS risk_score, {_risk("(l_discount*1e1)")} AS risk_level,
 CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END AS is_suspicious,
 {_choose("l_linestatus", {"O": "Binance_Global"}, "Binance_TH")} AS from_exchange,
 {_choose("l_returnflag", {"N": "Binance_Global"}, "Binance_TH")} AS to_exchange,
 'U_'||l_suppkey AS receiver_user_id, l_suppkey%3+1 AS receiver_kyc_level,
 {_choose("o_orderstatus", {"O": "pending", "F": "completed"}, "settled")} AS status,
 'U_'||o_custkey AS sender_user_id, o_custkey%3+1 AS sender_kyc_level,
 {_choose("c_mktsegment", sample.SEGMENT_ACCOUNTS, "regular")} AS account_type,
 {_pick(_CLEAN, "c_nationkey")} AS sender_country, {_pick(_TYPED, "c_nationkey")} AS sender_typed,
 {_pick(_CLEAN, "s_nationkey")} AS receiver_country, {_pick(_TYPED, "s_nationkey")} AS receiver_typed,
 {_choose("p_type", sample.TYPE_COINS)} AS crypto_currency
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
 JOIN supplier ON l_suppkey=s_suppkey JOIN part ON l_partkey=p_partkey)"""

EV = f"""ev AS (
SELECT 'E_'||event_id AS transaction_id, event_id, ts AS event_ts, CAST(ts AS DATE) AS event_date,
 'U_'||user_id AS sender_user_id, 'U_'||k AS receiver_user_id,
 {_pick(_CLEAN, "user_id%25")} AS sender_country, {_pick(_CLEAN, "k%25")} AS receiver_country,
 user_id%3+1 AS sender_kyc_level, k%3+1 AS receiver_kyc_level,
 CASE user_id%3 WHEN 0 THEN 'whale' WHEN 1 THEN 'regular' ELSE 'suspicious' END AS account_type,
 {_choose("event_type", sample.EVENT_COINS)} AS crypto_currency, value AS usd_amount,
 {_round("value*35.5e0")} AS thb_amount, 0.001e0 AS fee_rate, {_round("value*0.001e0", 4)} AS fee_usd,
 k/1e2 AS aml_score, k AS risk_score, {_risk("(k/1e2)")} AS risk_level,
 CASE WHEN k>=90 THEN 1 ELSE 0 END AS is_suspicious, 'completed' AS status, event_type
FROM (SELECT *, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events))"""

PRICES = EV + """, prices AS (
SELECT crypto_currency || CASE WHEN crypto_currency IN ('USDT','USDC') THEN 'THB' ELSE 'USDT' END AS symbol,
 crypto_currency AS coin, usd_amount AS price, event_ts AS timestamp,
 CASE WHEN crypto_currency IN ('USDT','USDC') THEN 'binance_th' ELSE 'binance_global' END AS source,
 CAST(risk_score*1000 AS DOUBLE) AS volume_24h, CAST(risk_score-50 AS DOUBLE) AS change_24h,
 usd_amount*1000000 AS market_cap FROM ev)"""

USERS = f"""users AS (
SELECT 'U_'||c_custkey AS user_id, {_choose("c_mktsegment", sample.SEGMENT_ACCOUNTS, "regular")} AS account_type,
 {_pick(_CLEAN, "c_nationkey")} AS country,
 CASE WHEN {_pick(_CLEAN, "c_nationkey")}='TH' THEN 'Binance_TH' ELSE 'Binance_Global' END AS exchange,
 c_custkey%3+1 AS kyc_level, c_acctbal AS monthly_volume_usd,
 [{_pick(sample.USER_COINS, "c_custkey%6")}, {_pick(sample.USER_COINS, "(c_custkey+1)%6")}] AS preferred_cryptos
FROM customer)"""

VOLUMES = f"""volumes AS (
SELECT *, volume_usd/daily_trades AS avg_trade_size FROM (
SELECT {_choose("l_linestatus", {"O": "Binance_Global"}, "Binance_TH")} AS exchange, p_brand AS symbol,
 CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
 {s("l_extendedprice")} AS volume_usd, {s("l_quantity")} AS daily_volume, count(*) AS daily_trades,
 CAST(sum(CAST(floor(l_discount*1e2+0.5) AS BIGINT)) AS DOUBLE)/count(*) AS price_change_pct
FROM lineitem JOIN part ON l_partkey=p_partkey GROUP BY 1,2,3))"""

CANDLES = f"""candles AS (
SELECT l_shipdate AS open_time, CAST(l_shipdate AS DATE) AS date,
 {_choose("p_type", sample.TYPE_COINS)} || CASE WHEN l_linestatus='O' THEN 'USDT' ELSE 'THB' END AS symbol,
 CASE WHEN l_linestatus='O' THEN 'global' ELSE 'th' END AS market,
 round(l_extendedprice/98765,8) AS close, round(l_quantity/98765,8) AS volume,
 round(l_extendedprice/7,8) AS quote_volume, l_linenumber AS num_trades
FROM lineitem JOIN part ON l_partkey=p_partkey)"""


def _std(x: str) -> str:
    t = f"trim(upper({x}), E' \\t\\n\\r')"
    names = (
        "WHEN 'THAILAND' THEN 'TH' WHEN 'PHILIPPINES' THEN 'PH' WHEN 'SINGAPORE' THEN 'SG' "
        "WHEN 'MALAYSIA' THEN 'MY' WHEN 'VIETNAM' THEN 'VN' WHEN 'INDONESIA' THEN 'ID' "
        "WHEN 'UNITED STATES' THEN 'US' WHEN 'GREAT BRITAIN' THEN 'GB' WHEN 'JAPAN' THEN 'JP'"
    )
    return f"coalesce(CASE {t} {names} ELSE {t} END, 'UNKNOWN')"


def silver(src: str, sender: str, receiver: str) -> str:
    lst = lambda *v: "(" + ",".join(f"'{x}'" for x in v) + ")"
    countries = lst("TH", "PH", "SG", "MY", "VN", "ID", "US", "GB", "JP")
    checks = {
        "dq_transaction_id_valid": "transaction_id IS NOT NULL AND length(transaction_id)>0",
        "dq_amount_valid": "usd_amount>=0.01 AND usd_amount<=1000000",
        "dq_country_valid": f"{sender} IN {countries} AND {receiver} IN {countries}",
        "dq_currency_valid": "crypto_currency IN "
        + lst("BTC", "ETH", "XRP", "ADA", "DOT", "AVAX", "MATIC"),
        "dq_status_valid": "status IN " + lst("pending", "completed", "failed", "cancelled"),
        "dq_risk_level_valid": "risk_level IN " + lst("low", "medium", "high"),
    }
    flags = ", ".join(f"CASE WHEN {e} THEN true ELSE false END AS {n}" for n, e in checks.items())
    total = "+".join(f"CAST({n} AS INT)" for n in checks)
    return f"""flat AS (
SELECT transaction_id, event_ts AS transaction_timestamp, event_date, status, sender_user_id,
 account_type AS sender_account_type, {_std(sender)} AS sender_country, sender_kyc_level,
 receiver_user_id, {_std(receiver)} AS receiver_country, receiver_kyc_level, crypto_currency,
 usd_amount, thb_amount, fee_usd, fee_rate, aml_score AS original_aml_score,
 risk_level AS original_risk_level, {flags} FROM {src}),
scored AS (
SELECT *, CAST({total} AS DOUBLE)/6e0 AS data_quality_score,
 least(((((coalesce(original_aml_score,0e0) + CASE WHEN usd_amount>50000 THEN 0.1e0 ELSE 0e0 END)
  + CASE WHEN sender_country<>receiver_country THEN 0.05e0 ELSE 0e0 END)
  + CASE WHEN sender_kyc_level=1 THEN 0.1e0 ELSE 0e0 END)
  + CASE WHEN receiver_kyc_level=1 THEN 0.1e0 ELSE 0e0 END), 1e0) AS enhanced_fraud_score FROM flat),
silver AS (
SELECT *, data_quality_score>=0.8e0 AS is_high_quality, sender_country<>receiver_country AS is_cross_border,
 CASE WHEN usd_amount<=1000 THEN 'micro' WHEN usd_amount<=10000 THEN 'small'
  WHEN usd_amount<=50000 THEN 'medium' ELSE 'large' END AS transaction_category,
 CASE WHEN enhanced_fraud_score<=0.3e0 THEN 'low_risk' WHEN enhanced_fraud_score<=0.6e0 THEN 'medium_risk'
  ELSE 'high_risk' END AS risk_category,
 CASE WHEN sender_kyc_level>=2 AND receiver_kyc_level>=2 THEN 'compliant'
  WHEN sender_kyc_level>=1 AND receiver_kyc_level>=1 THEN 'partial' ELSE 'non_compliant' END AS kyc_compliance_level
FROM scored)"""


SILVER_TX = TX + ", " + silver("tx", "sender_typed", "receiver_typed")
SILVER_EV = EV + ", " + silver("ev", "sender_country", "receiver_country")


def q(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
