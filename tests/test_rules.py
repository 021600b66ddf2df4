"""Row rules at their boundaries, with NULLs."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerflow.functions import cleaning, labels, numbers, scoring

c = F.col


def values(spark, schema, rows, column):
    df = spark.createDataFrame(rows, schema).withColumn("__n", F.monotonically_increasing_id())
    return [r[0] for r in df.orderBy("__n").select(column).collect()]


def test_country(spark):
    given = [None, " th ", "\tThailand\n", "Great Britain", "narnia", "", "　japan\x1c"]
    got = values(spark, "x string", [(g,) for g in given], cleaning.std_country(c("x")))
    assert got == ["UNKNOWN", "TH", "TH", "GB", "NARNIA", "", "JP"]


def test_strip_equals_text_strip(spark):
    given = ["a", " a", "a ", "\ta b\n", "\xa0é\u2009", "é", "", " ", "\x1fx", "x\x85", "ü y"]
    got = values(spark, "x string", [(g,) for g in given], cleaning.strip(c("x")))
    assert got == [g.strip() for g in given]


def test_currency(spark):
    got = values(spark, "x string", [(None,), (" btc\t",)], cleaning.std_currency(c("x")))
    assert got == ["UNKNOWN", "BTC"]


SCORE = "aml double, usd double, a string, b string, ks int, kr int"


def score(spark, rows, tiered=False):
    col = scoring.enhanced_fraud_score(
        c("aml"), c("usd"), c("a"), c("b"), c("ks"), c("kr"), tiered
    )
    return values(spark, SCORE, rows, col)


def test_enhanced_score(spark):
    rows = [
        (None, 50000.0, "TH", "TH", None, 0),
        (0.2, 50001.0, "TH", "TH", 2, 3),
        (0.2, 100001.0, "TH", "TH", 2, 2),
        (0.2, None, "TH", "US", 1, 2),
        (0.2, 1.0, None, "US", 1, 1),
        (0.2, 1.0, None, None, 0, None),
        (0.95, 60000.0, "TH", "US", 1, 1),
    ]
    want = [0.0, 0.2 + 0.1, 0.2 + 0.1, 0.2 + 0.05 + 0.1, 0.2 + 0.05 + 0.1 + 0.1, 0.2, 1.0]
    assert score(spark, rows) == want
    assert score(spark, [(0.2, 100001.0, "TH", "TH", 2, 2)], tiered=True) == [0.4]


def test_ladders(spark):
    usd = [(0.0,), (1000.0,), (10000.0,), (50000.0,), (50000.01,), (None,)]
    assert values(spark, "x double", usd, scoring.transaction_category(c("x"))) == [
        "micro", "micro", "small", "medium", "large", "large",
    ]
    risk = [(0.3,), (0.31,), (0.6,), (0.61,), (None,)]
    assert values(spark, "x double", risk, scoring.risk_category(c("x"))) == [
        "low_risk", "medium_risk", "medium_risk", "high_risk", "high_risk",
    ]
    kyc = [(2, 3), (1, 2), (1, 0), (None, 3)]
    got = values(spark, "a int, b int", kyc, scoring.kyc_compliance_level(c("a"), c("b")))
    assert got == ["compliant", "partial", "non_compliant", "non_compliant"]
    bucket = values(spark, "x int", [(19,), (20,), (49,), (69,), (70,)], scoring.risk_bucket(c("x")))
    assert [b.split(" ")[0] for b in bucket] == ["Low", "Medium", "Medium", "High", "Critical"]
    hours = values(spark, "x int", [(5,), (6,), (12,), (18,), (23,)], labels.hour_class(c("x")))
    assert hours == ["night", "morning", "afternoon", "evening", "evening"]


def test_alert_score(spark):
    rows = [
        (0.7, 50000.0), (0.71, 50000.0), (0.7, 50001.0), (0.7, 100000.0), (0.7, 100001.0),
        (0.9, 1.0), (0.91, 1.0), (None, None),
    ]
    got = values(spark, "aml double, usd double", rows, scoring.alert_score(c("aml"), c("usd")))
    assert got == [0.1, 0.6, 0.7, 0.7, 0.9, 0.6, 1.0, 0.1]


def test_alert_flag(spark):
    rows = [(None, 0.1), (None, 0.9), ([], 0.1), (["high_amount"], 0.1), (["x"], 0.81)]
    got = values(spark, "f array<string>, s double", rows, scoring.is_alert(c("f"), c("s")))
    assert got == [None, True, False, True, True]


def test_alert_type(spark):
    rows = [(0.95, 100001.0, 1), (0.95, 1.0, 1), (0.9, 1.0, 1), (None, 1.0, 2)]
    got = values(
        spark, "a double, u double, k int", rows, scoring.alert_type(c("a"), c("u"), c("k"))
    )
    assert got == ["high_amount", "high_aml_score", "low_kyc", "general_suspicious"]


def test_points(spark):
    rows = [
        ("regular", 30000.0, 3, "US", False),
        ("regular", 30001.0, 3, "US", False),
        ("whale", 50001.0, 2, "US", False),
        ("regular", 100001.0, 1, "RU", False),
        ("suspicious", 100001.0, 1, "KP", True),
        (None, None, None, None, None),
    ]
    schema = "t string, u double, k int, n string, f boolean"
    col = scoring.points_risk_score(c("t"), c("u"), c("k"), c("n"), c("f"))
    assert values(spark, schema, rows, col) == [0, 15, 40, 75, 100, 0]
    flag = scoring.points_suspicious(c("f"), c("p"))
    got = values(spark, "f boolean, p int", [(False, 70), (False, 71), (True, 0), (None, 0)], flag)
    assert got == [False, True, True, False]


def test_rule_hits(spark):
    x = scoring.RuleInputs(c("u"), c("a"), c("n"), c("k"), c("s"))
    rows = [
        (60000.0, 0.8, "RU", 1, "USDT"),
        (30000.0, 0.7, "RU", 2, "BTC"),
        (None, None, None, None, None),
    ]
    schema = "u double, a double, n string, k int, s string"
    got = values(spark, schema, rows, scoring.rule_hits(scoring.named_rules(x)))
    names = list(scoring.named_rules(x))
    assert got == [names, ["risky_country"], []]


def test_coin_and_network(spark):
    pairs = [("BTCUSDT",), ("BTCTHB",), ("USDTTHB",), ("BNBUSDT",), (None,)]
    got = values(spark, "x string", pairs, labels.map_coin(c("x")))
    assert got == ["BTC", "BTC", "USDC", "UNKNOWN", "UNKNOWN"]
    daily = [("BTCUSDT", "global"), ("USDCUSDT", "global"), ("THB_USDT", "th")]
    got = values(spark, "s string, m string", daily, labels.coin_of_pair(c("s"), c("m")))
    assert got == ["BTC", "USDC", "USDT"]
    got = values(spark, "x string", [("BCH",), ("USDT",), (None,)], labels.network_type(c("x")))
    assert got == ["Bitcoin Cash", "Ethereum", "Ethereum"]


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (0.0, "0.00"),
        (999.0, "999.00"),
        (1024.0, "1.02 thousand"),
        (3915600029.22, "3.92 billion"),
        (2.5e12, "2.50 trillion"),
    ],
)
def test_readable(spark, value, text):
    assert values(spark, "x double", [(value,)], numbers.readable_quantity(c("x"))) == [text]


def test_exact_sum_does_not_depend_on_order(spark):
    rows = [(i * 0.1 + 0.01,) for i in range(10000)]
    df = spark.createDataFrame(rows, "x double")
    agg = [numbers.exact_sum(c("x")).alias("s"), numbers.exact_avg(c("x")).alias("a")]
    one = df.repartition(1).agg(*agg).first()
    many = df.repartition(16).agg(*agg).first()
    assert one == many == Row(s=4999600.0, a=499.96)
    empty = df.where("x < 0").agg(*agg).first()
    assert empty == Row(s=None, a=None)


def test_sums_neither_overflow_nor_hide(spark):
    def total(values, where=None):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(numbers.exact_sum(c("x"), where=where).alias("s")).first().s

    assert total([5e16] * 4) == 2e17 and total([-5e16] * 4) == -2e17
    assert total([9.2e18, 9.2e18, 1.0]) == 1.84e19
    assert total([0.01, 5e16]) == 5e16 + 0.01 and total([0.1] * 10) == 1.0 and total([-0.25, 0.1]) == -0.15
    assert total([1.0, float("nan")]) != total([1.0, float("nan")])
    assert total([1.0, float("nan")], c("x") < 5) == 1.0
    assert total([None]) is None and total([]) is None
