"""Lists, thresholds and rates the results depend on.

Everything here is a default; the operators take these as parameters.
"""

# --- fixed values: data quality -------------------------------------------
REQUIRED_FIELDS = (
    "transaction_id",
    "timestamp",
    "sender",
    "receiver",
    "transfer",
    "status",
    "compliance",
)
MIN_AMOUNT = 0.01
MAX_AMOUNT = 1000000.0
QUALITY_COUNTRIES = ("TH", "PH", "SG", "MY", "VN", "ID", "US", "GB", "JP")
QUALITY_SYMBOLS = ("BTC", "ETH", "XRP", "ADA", "DOT", "AVAX", "MATIC")
STATUS_VALUES = ("pending", "completed", "failed", "cancelled")
RISK_LEVELS = ("low", "medium", "high")
HIGH_QUALITY_SCORE = 0.8

# --- fixed values: country names to codes ---------------------------------
COUNTRY_NAMES = {
    "THAILAND": "TH",
    "PHILIPPINES": "PH",
    "SINGAPORE": "SG",
    "MALAYSIA": "MY",
    "VIETNAM": "VN",
    "INDONESIA": "ID",
    "UNITED STATES": "US",
    "GREAT BRITAIN": "GB",
    "JAPAN": "JP",
}
UNKNOWN = "UNKNOWN"

# --- fixed values: rates, fees, networks ----------------------------------
COIN_USD_RATES = {
    "BTC": 45000.0,
    "ETH": 2800.0,
    "USDT": 1.0,
    "USDC": 1.0,
    "BNB": 320.0,
    "ADA": 0.45,
    "DOT": 6.5,
    "XRP": 0.62,
    "SOL": 98.5,
    "MATIC": 0.85,
    "AVAX": 28.5,
    "LINK": 14.2,
    "UNI": 6.8,
    "LTC": 95.0,
    "BCH": 240.0,
}
USD_THB = 35.5
USD_THB_FLAT = 35.1  # used when only the fiat amount of a flat row is known
MAKER_FEE = 0.001
TAKER_FEE = 0.0015
COIN_NETWORKS = {
    "BTC": "Bitcoin",
    "ETH": "Ethereum",
    "BNB": "BSC",
    "ADA": "Cardano",
    "DOT": "Polkadot",
    "XRP": "Ripple",
    "SOL": "Solana",
    "MATIC": "Polygon",
    "AVAX": "Avalanche",
    "LINK": "Ethereum",
    "UNI": "Ethereum",
    "LTC": "Litecoin",
    "BCH": "Bitcoin Cash",
}
DEFAULT_NETWORK = "Ethereum"

# --- fixed values: points risk score --------------------------------------
HIGH_RISK_COUNTRIES = ("RU", "CN", "VE", "IR", "KP")
STABLECOINS = ("USDT", "USDC")

# --- fixed values: exchanges, price sources, topics -----------------------
GLOBAL_EXCHANGE = "Binance_Global"
TH_EXCHANGE = "Binance_TH"
GLOBAL_SOURCE = "binance_global"
TH_SOURCE = "binance_th"
TOPIC_NORMAL = "transactions-normal"
TOPIC_SUSPICIOUS = "transactions-suspicious"
TOPIC_ALERTS = "transactions-fraud-alerts"
THB_PAIRS = ("BTCTHB", "ETHTHB", "USDTTHB", "BNBTHB", "ADATHB", "DOTTHB")

# --- fixed values: market symbols and coins -------------------------------
SYMBOL_COINS = {
    "BTCUSDT": "BTC",
    "BTCTHB": "BTC",
    "ETHUSDT": "ETH",
    "ETHTHB": "ETH",
    "USDCUSDT": "USDC",
    "USDTTHB": "USDC",
}
PIVOT_COINS = ("BTC", "ETH", "USDC")
PRICE_TRACKER_SYMBOLS = (
    "BTCUSDT",
    "ETHUSDT",
    "BNBUSDT",
    "ADAUSDT",
    "XRPUSDT",
    "SOLUSDT",
    "DOGEUSDT",
    "TRXUSDT",
    "MATICUSDT",
    "AVAXUSDT",
)
PRICE_BOARD_SYMBOLS = ("BTC", "ETH", "BNB", "ADA", "DOT", "MATIC", "LINK", "UNI", "AAVE", "SUSHI")

# --- fixed values: velocity scenarios -------------------------------------
ROUND_AMOUNTS = (10000, 25000, 50000, 100000)

# Scores and labels of alerts, by the first bound that is exceeded.
ALERT_SCORES = (("aml", 0.9, 1.0), ("usd", 100000, 0.9), ("usd", 50000, 0.7), ("aml", 0.7, 0.6))
ALERT_SCORE_ELSE = 0.1
ALERT_FROM = 0.8
ALERT_TYPES = (("usd", 100000, "high_amount"), ("aml", 0.9, "high_aml_score"))
LOW_KYC_TYPE, OTHER_TYPE = "low_kyc", "general_suspicious"

# Points of the 0 to 100 score.
ACCOUNT_POINTS = {"suspicious": 40, "whale": 10}
AMOUNT_POINTS = (("usd", 100000, 30), ("usd", 50000, 20), ("usd", 30000, 15))
KYC_POINTS = {1: 20, 2: 10}
COUNTRY_POINTS, FLAG_POINTS, SUSPICIOUS_POINTS = 25, 30, 70

# Bounds of the named rules.
RULE_HIGH_AMOUNT, RULE_HIGH_AML = 30000, 0.7
RULE_COUNTRIES, RULE_COUNTRY_AMOUNT = ("RU", "CN"), 10000
RULE_KYC_AMOUNT, RULE_STABLECOIN_AMOUNT = 5000, 50000
