import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import quality, silver
from ledgerflow.schemas import RAW_LAYER, SILVER_LAYER

c = F.col
FLAT = "transaction_id string, usd_amount double, sender_country string, receiver_country string, crypto_currency string, status string, risk_level string"
GOOD = ("t", 1.0, "TH", "GB", "BTC", "completed", "low")


def flags(spark, *rows):
    df = spark.createDataFrame(list(rows), FLAT)
    return quality.quality_flags(df, paths=quality.FLAT_PATHS).collect()


def changed(**kw):
    names = [x.split()[0] for x in FLAT.split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, GOOD, strict=True))


@pytest.mark.parametrize(
    ("row", "passed"),
    [
        (GOOD, 6),
        (changed(transaction_id=None), 5),
        (changed(transaction_id=""), 5),
        (changed(usd_amount=0.009), 5),
        (changed(usd_amount=0.01), 6),
        (changed(usd_amount=1000000.0), 6),
        (changed(usd_amount=1000000.01), 5),
        (changed(usd_amount=None), 5),
        (changed(sender_country="UK"), 5),
        (changed(sender_country="th"), 5),
        (changed(receiver_country=None, status="settled"), 4),
        ((None,) * 7, 0),
    ],
)
def test_flags(spark, row, passed):
    (r,) = flags(spark, row)
    assert r.data_quality_score == passed / 6.0
    assert sum(r[n] for n in quality.DQ_FLAGS) == passed
    assert r.is_high_quality == (passed >= 5)


def test_split_required(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), (None, None)], "p string, q string")
    ok, bad = quality.split_required(df, ["p", "q"])
    assert [r.p for r in ok.collect()] == ["a"]
    assert sorted(map(tuple, (r.missing_fields for r in bad.collect()))) == [("p",), ("p", "q")]


def test_flatten_all(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', 2, 'c', named_struct('d', 3)) AS a")
    out = quality.flatten_all(df)
    assert out.columns == ["id", "a_b", "a_c_d"]
    assert out.first() == (1, 2, 3)
    assert quality.flatten_all(df, ".").columns == ["id", "a.b", "a.c.d"]


def test_narrow_and_fill(spark):
    df = spark.sql("SELECT '300' AS k, 1e300D AS f, CAST(NULL AS DOUBLE) AS v")
    out = quality.narrow(df, {"k": "tinyint", "absent": "int"})
    assert out.first().k is None and dict(out.dtypes)["k"] == "tinyint"
    assert quality.fill_zero(df, ["v"]).first().v == 0.0
    edges = spark.createDataFrame([(127,), (128,), (-128,), (-129,), (None,)], "x bigint")
    got = [r.x for r in quality.narrow(edges, {"x": "tinyint"}).collect()]
    assert got == [127, None, -128, None, None]


def test_valid_dates(spark):
    df = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-01-02', NULL)) AS date")
    assert quality.valid_dates(df, F.lit("2024-01-01").cast("date")).count() == 1


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None), (4, "x")], "a int, `b.c` string")
    got = {r.column_name: (r.null_count, r.null_percent) for r in quality.null_profile(df).collect()}
    assert got == {"a": (1, 25.0), "b.c": (3, 75.0)}
    empty = quality.null_profile(df.where("a > 9")).collect()
    assert {r.null_percent for r in empty} == {0.0}


def test_numeric_summary(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    cols = ["l_extendedprice", "l_quantity"]
    got = {r.summary: r for r in quality.numeric_summary(df, cols).collect()}
    want = {r.summary: r for r in df.select(*cols).summary().collect()}
    assert set(got) == set(want)
    for name, row in want.items():
        for x in cols:
            assert got[name][x] == pytest.approx(float(row[x]), rel=1e-9), (name, x)
    data = sorted(r[0] for r in df.select("l_extendedprice").collect())
    for name, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        rank = data.index(got[name].l_extendedprice)
        assert abs(rank / len(data) - p) < 0.002


def nested(spark, **over):
    cols = {
        "timestamp": "TIMESTAMP'2024-01-01 05:00:00'",
        "sender": "named_struct('user_id','a','account_type','x','email','e','country',' thailand ',"
        "'kyc_level',1,'preferred_crypto','BTC','exchange','z')",
    }
    exprs = []
    for f in RAW_LAYER.fields:
        sql = over.get(f.name, cols.get(f.name, f"CAST(NULL AS {f.dataType.simpleString()})"))
        exprs.append(f"{sql} AS `{f.name}`")
    return spark.sql("SELECT " + ", ".join(exprs))


def test_silver_schema_and_nulls(spark):
    out = silver.to_silver(nested(spark), F.lit("2024-01-02 03:04:05").cast("timestamp"))
    assert {(f.name, f.dataType) for f in out.schema.fields} == {
        (f.name, f.dataType) for f in SILVER_LAYER.fields
    }
    r = out.first()
    assert (r.sender_country, r.receiver_country, r.crypto_currency) == ("TH", "UNKNOWN", "UNKNOWN")
    assert r.is_cross_border is True and r.transaction_category == "large"
    assert r.enhanced_fraud_score == 0.05 + 0.1 and r.kyc_compliance_level == "non_compliant"
    assert r.data_quality_score == 0.0
    assert str(r.processing_date) == "2024-01-02" and str(r.event_date) == "2024-01-01"
    assert len(silver.FLAT_COLUMNS) == 31
