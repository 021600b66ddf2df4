"""Order-dependent operators against plain Python, with one key holding most rows."""

import math
import random
import statistics

from pyspark.sql import functions as F

from ledgerflow.operators import ordered


def series(n=400, seed=1):
    rnd = random.Random(seed)
    keys = ["hot"] * (n // 2) + [rnd.choice("abcdefgh") for _ in range(n // 2)] + [None] * 5
    rnd.shuffle(keys)
    rows = [(k, i, rnd.choice([None, 0.0, 1.0, 2.5, 7.0])) for i, k in enumerate(keys)]
    rnd.shuffle(rows)
    return rows


def brute(rows, n):
    out, seen = {}, {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        out[i] = seen.setdefault(k, [])[-n:]
        seen[k].append(v)
    return out


def test_with_previous_matches_brute_force(spark):
    rows = series()
    df = spark.createDataFrame(rows, "k string, i int, v double")
    for n in (1, 3, 50):
        for slices in (1, 7, 60):
            out = ordered.with_previous(df, ["k"], ["i"], "v", n, "p", slices).collect()
            assert len(out) == len(rows)
            want = brute(rows, n)
            assert {r.i: r.p for r in out} == want, (n, slices)


def test_hot_key_is_split(spark):
    df = spark.createDataFrame(series(4000), "k string, i int, v double")
    cut = df.repartitionByRange(16, "k", "i").withColumn("s", F.spark_partition_id())
    per_slice = [r["count"] for r in cut.groupBy("s").count().collect()]
    assert max(per_slice) < 4000 / 4


def test_price_changes(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 2, 15.0), ("a", 3, 0.0), ("a", 4, 3.0), ("b", 1, 1.0)],
        "symbol string, timestamp int, price double",
    )
    out = {
        (r.symbol, r.timestamp): (r.prev_price, r.price_change_pct)
        for r in ordered.price_changes(df, slices=3).collect()
    }
    assert out == {
        ("a", 1): (None, None),
        ("a", 2): (10.0, 50.0),
        ("a", 3): (15.0, -100.0),
        ("a", 4): (0.0, None),
        ("b", 1): (None, None),
    }


def test_zscore(spark):
    rows = [("u", i, str(i), float(x)) for i, x in enumerate([1, 1, 2, 9, None or 4, 4, 4])]
    df = spark.createDataFrame(
        rows, "sender_user_id string, event_ts int, transaction_id string, usd_amount double"
    )
    out = sorted(
        ordered.behavior_zscore(df, n=3, slices=4).collect(), key=lambda r: r.event_ts
    )
    xs = [r[3] for r in rows]
    for i, r in enumerate(out):
        past = xs[max(0, i - 3) : i]
        assert r.history_count == len(past)
        if len(past) < 2 or statistics.stdev(past) == 0:
            assert r.amount_zscore is None
        else:
            want = (xs[i] - statistics.mean(past)) / statistics.stdev(past)
            assert abs(r.amount_zscore - want) < 1e-9


def test_checkpoint_folder_comes_from_the_session(spark):
    from ledgerflow import session

    sc = spark.sparkContext
    before = session.checkpoint_dir(spark)
    assert sc.getCheckpointDir() == before == session.checkpoint_dir(spark)
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5 and "Scan ExistingRDD" in df._jdf.queryExecution().toString()


def test_exact_quantiles(spark):
    rnd = random.Random(5)
    rows = [(1.0 if i % 3 == 0 else rnd.random() * 9, None if i % 5 == 0 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double")
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.column: r for r in ordered.exact_quantiles(df, ["a", "b"], shares, 13).collect()}
    for i, name in enumerate("ab"):
        xs = sorted(r[i] for r in rows if r[i] is not None)
        want = [xs[max(math.ceil(p * len(xs)), 1) - 1] for p in shares]
        assert [got[name][f"q{j}"] for j in range(5)] == want


def jobs_of(spark, build):
    """The frame that `build` gives, and how many jobs building it ran."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    frame = build()
    n = len(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("other", "other")
    return frame, n


def test_building_runs_no_job(spark):
    df = spark.createDataFrame(series(), "k string, i int, v double")
    out, n = jobs_of(spark, lambda: ordered.with_previous(df, ["k"], ["i"], "v", 3, "p", rows_per_slice=20))
    assert n == 0 and {r.i: r.p for r in out.collect()} == brute(series(), 3)
    out, n = jobs_of(spark, lambda: ordered.exact_quantiles(df, ["v"], [0.5], values_per_slice=1))
    assert n == 0 and len(out.collect()) == 1
    for frame in (out, ordered.with_previous(df, ["k"], ["i"], "v", 3, "p")):
        assert "ExistingRDD[" in (plan := frame._jdf.queryExecution().toString()) and "heckpoint" not in plan


def test_only_hot_keys_are_sliced_and_evenly(spark):
    rows = [("hot", i % 997, i) for i in range(6000)] + [(f"k{i % 50}", i, i) for i in range(2000)] + [(None, 1, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, at int, i int")
    cuts = ordered.cuts_of(df, ["k"], "at", 500)
    (hot,) = cuts.collect()
    assert hot.k == "hot" and len(hot["__cuts"]) == 12 and hot["__cuts"] == sorted(hot["__cuts"])
    out = ordered.with_slices(df, ["k"], "at", cuts)
    sizes = {r["__slice"]: r["count"] for r in out.where("k = 'hot'").groupBy("__slice").count().collect()}
    assert len(sizes) == 13 and max(sizes.values()) < 3 * 6000 / 13
    assert out.where("__slice is null").count() == 2030
    # The cuts do not depend on how the rows are dealt out.
    assert ordered.cuts_of(df.repartition(7, "i"), ["k"], "at", 500).collect() == [hot]


def test_rows_with_no_order_value_and_one_moment_for_many_rows(spark):
    rows = [("a", None if i < 40 else 7, i) for i in range(200)] + [("b", i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, at int, i int")
    want = {}
    for key in "ab":
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want |= {(key, r[2]): [x[2] for x in own[max(0, j - 2) : j]] for j, r in enumerate(own)}
    for slices in (None, 5):
        out = ordered.with_previous(df, ["k"], ["at", "i"], "i", 2, "p", slices, rows_per_slice=30)
        assert {(r.k, r.i): r.p for r in out.collect()} == want


def test_exact_quantiles_of_skewed_values_and_no_rows(spark):
    rows = [(float(i % 3), float("inf") if i == 0 else 10.0 ** (i % 300), None) for i in range(900)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r.column: r for r in ordered.exact_quantiles(df, ["a", "b", "c"], [0.1, 0.5, 1.0], values_per_slice=7).collect()}
    assert set(got) == {"a", "b"}
    for i, name in enumerate("ab"):
        xs = sorted(r[i] for r in rows)
        assert [got[name][f"q{j}"] for j in range(3)] == [xs[math.ceil(p * 900) - 1] for p in (0.1, 0.5, 1.0)]
    assert ordered.exact_quantiles(df.where("a > 5"), ["a"], [0.5]).collect() == []
