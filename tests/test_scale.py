"""What lets the cleaned and aggregated layers grow: short generated methods, rows sent once."""

import re
from collections import defaultdict

import pytest

from ledgerflow.operators import gold
from ledgerflow.plans import catalog
from ledgerflow.sources import sample

SILVER = (
    "event_date string, sender_country string, receiver_country string, crypto_currency string, transaction_id string, usd_amount double, "
    "fee_usd double, enhanced_fraud_score double, risk_category string, is_cross_border boolean, kyc_compliance_level string, "
    "sender_user_id string, receiver_user_id string"
)


@pytest.fixture
def tables(spark, tmp_path):
    for name, schema, row in (
        ("customer", "c_custkey long, c_nationkey int, c_mktsegment string", (1, 1, "BUILDING")),
        ("supplier", "s_suppkey long, s_nationkey int", (1, 2)),
        ("part", "p_partkey long, p_type string", (1, "STANDARD")),
        ("orders", "o_orderkey long, o_custkey long, o_orderstatus string", (1, 1, "O")),
        (
            "lineitem",
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            None,
        ),
    ):
        if row is None:
            rows = spark.sql("SELECT 1L, 1L, 1L, 1, 10.0D, 0.05D, 0.01D, 'R', 'O', timestamp_ntz'2024-01-05 10:00:00'")
            rows.toDF(*(x.split()[0] for x in schema.split(", "))).write.parquet(f"{tmp_path}/{name}.parquet")
        else:
            spark.createDataFrame([row], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["silver_rows", "silver_flat"])
def test_cleaning_is_compiled(spark, tables, name):
    """The JIT leaves methods of more than 8,000 bytes interpreted."""
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the whole plan is known before it runs
    try:
        frame = catalog.QUERIES[name](spark, tables)
        text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    (row,) = frame.collect()
    assert (row.sender_country, row.receiver_country, row.crypto_currency, row.usd_amount) == ("TH", "TH", "BTC", 10.0)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_no_nation_is_no_country(spark, tables, tmp_path):
    """Of several customers, in one file, one has no nation."""
    rows = [(k, None if k == 2 else 24, "BUILDING") for k in (1, 2, 3)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_mktsegment string").coalesce(1).write.mode("overwrite").parquet(f"{tables}/customer.parquet")
    spark.createDataFrame([(k, k, "O") for k in (1, 2, 3)], "o_orderkey long, o_custkey long, o_orderstatus string").write.mode("overwrite").parquet(f"{tables}/orders.parquet")
    one = spark.read.parquet(f"{tables}/lineitem.parquet").drop("l_orderkey")
    line = spark.range(1, 4, 1, 1).withColumnRenamed("id", "l_orderkey").crossJoin(one)
    line.write.parquet(f"{tmp_path}/more")
    spark.read.parquet(f"{tmp_path}/more").write.mode("overwrite").parquet(f"{tables}/lineitem.parquet")
    found = sample.tx(spark, tables, ["sender_user_id", "sender_typed", "account_type"]).collect()
    assert sorted(found) == [("U_1", "VE", "suspicious"), ("U_2", None, "suspicious"), ("U_3", "VE", "suspicious")]


def test_daily_summary_sends_a_row_once(spark):
    day = ("2024-01-01", "TH", None, "BTC")
    rows = [
        (*day, "a", 1.25, 0.5, 0.2, "high_risk", True, "compliant", "u", "v"),
        (*day, None, None, None, None, None, None, None, "u", None),
        (*day, "c", 2.0, 0.25, 0.4, "low_risk", False, "partial", None, "v"),
        (*day, "c", 2.0, 0.25, 0.4, "low_risk", False, "partial", "w", "u"),
        ("2024-01-02", "TH", "TH", "BTC", None, None, None, None, None, None, None, None, None),
    ]
    found = gold.daily_summary(spark.createDataFrame(rows, SILVER))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1
    groups = defaultdict(list)
    for r in rows:
        groups[r[:4]].append(r)
    got = {tuple(r[:4]): r for r in found.collect()}
    assert got.keys() == groups.keys()
    for key, part in groups.items():
        r, usd = got[key], [x[5] for x in part if x[5] is not None]
        assert r.transaction_count == sum(x[4] is not None for x in part)
        assert (r.total_usd_volume, r.min_transaction_amount, r.max_transaction_amount) == ((sum(usd), min(usd), max(usd)) if usd else (None,) * 3)
        assert (r.unique_senders, r.unique_receivers) == tuple(len({x[k] for x in part} - {None}) for k in (11, 12))
        assert (r.high_risk_count, r.cross_border_count, r.compliant_count) == tuple(sum(x[k] == v for x in part) for k, v in ((8, "high_risk"), (9, True), (10, "compliant")))
