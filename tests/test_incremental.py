"""Aggregate tables from states: equal to the batch, cheap, and safe to run again."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import gold, gold_state
from ledgerflow.operators.silver import to_silver
from ledgerflow.sinks import stream as sink
from ledgerflow.sources import events
from ledgerflow.streaming import incremental, layers
from test_streaming import event, finish, moment, rows_of, write_topic_file


def cleaned(spark, topic):
    return to_silver(events.valid_events(events.parse_events(spark.read.parquet(topic), moment())), moment())


def days_of_events(n, first=0):
    countries = ["TH", "RU", "US", None]
    out = [event(i, 1 + i % 4, usd=37.13 * (i + 1) ** 2, aml=(i % 10) / 10, country=countries[i % 4]) for i in range(first, first + n)]
    if first == 0 and n > 7:
        out[3]["transaction_id"] = None
        out[5]["timestamp"] = "no time"
        out[7]["transfer"]["usd_equivalent"] = 5e15
    return [json.dumps(e) for e in out]


def test_states_of_parts_give_the_tables(spark, tmp_path):
    topic = str(tmp_path / "topic")
    write_topic_file(spark, topic, days_of_events(60))
    silver = cleaned(spark, topic).withColumn("usd_amount", F.when(F.col("transaction_id") == "t9", F.lit(float("nan"))).otherwise(F.col("usd_amount"))).persist()
    parts = [silver.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == k) for k in range(3)]

    def whole(of):
        out = of(parts[0])
        for part in parts[1:]:
            out = out.unionByName(of(part))
        return out

    measures, users = (gold_state.added_up(x, whole(gold_state.STATES[x])) for x in ("measures", "people"))
    for name, build in gold_state.TABLES.items():
        got, want = build(measures, users), gold.GOLD_TABLES[name](silver)
        assert sorted(got.dtypes) == sorted(want.dtypes), name
        assert rows_of(got) == rows_of(want), name


@pytest.fixture
def lake(spark, tmp_path):
    topic, paths = str(tmp_path / "topic"), layers.Paths(str(tmp_path / "lake"))
    write_topic_file(spark, topic, days_of_events(40))
    raw = events.read_topic_files(spark, topic)
    finish(layers.start_bronze(raw, paths, sink.ONCE, moment()))
    finish(layers.start_silver(spark, paths, sink.ONCE, moment()))
    finish(layers.start_gold(spark, paths, sink.ONCE))
    return topic, paths


def assert_gold(spark, paths, topic):
    expected = cleaned(spark, topic).persist()
    for name, build in gold.GOLD_TABLES.items():
        assert rows_of(spark.read.parquet(paths.layer(f"gold/{name}"))) == rows_of(build(expected)), name


def test_a_trigger_opens_no_old_cleaned_file(spark, lake):
    topic, paths = lake
    for path in Path(paths.layer("silver")).rglob("*.parquet"):  # whoever reads an old file fails
        path.write_bytes(b"not parquet")
    write_topic_file(spark, topic, days_of_events(12, first=100), "transactions-suspicious", 500)
    raw = events.read_topic_files(spark, topic)
    finish(layers.start_bronze(raw, paths, sink.ONCE, moment()))
    finish(layers.start_silver(spark, paths, sink.ONCE, moment()))
    finish(layers.start_gold(spark, paths, sink.ONCE))
    assert_gold(spark, paths, topic)


def test_a_batch_that_runs_again_changes_nothing(spark, lake, tmp_path):
    topic, paths = lake
    state, tables = paths.layer("gold_state"), paths.layer("gold")
    last = max(incremental._batches(spark, state))
    path = str(tmp_path / "late")
    write_topic_file(spark, path, days_of_events(9, first=300), "transactions-normal", 900)
    batch = cleaned(spark, path)
    incremental.add_batch(batch, last + 1, state, tables)
    incremental.add_batch(batch, last + 1, state, tables)
    write_topic_file(spark, topic, days_of_events(9, first=300), "transactions-normal", 900)
    assert_gold(spark, paths, topic)


def test_bases_hide_their_parts_and_old_parts_go(spark, tmp_path):
    topic, state, tables = str(tmp_path / "topic"), str(tmp_path / "state"), str(tmp_path / "gold")
    for n in range(4):
        path = str(tmp_path / f"in{n}")
        texts = days_of_events(8, first=10 * n)
        write_topic_file(spark, path, texts, offset=100 * n)
        write_topic_file(spark, topic, texts, offset=100 * n)
        incremental.add_batch(cleaned(spark, path), n, state, tables, every=1)
        if n == 2:  # the batch that made a base runs again
            incremental.add_batch(cleaned(spark, path), n, state, tables, every=1)
    expected = cleaned(spark, topic)
    for name, build in gold.GOLD_TABLES.items():
        assert rows_of(spark.read.parquet(f"{tables}/{name}")) == rows_of(build(expected)), name
    assert incremental._batches(spark, state) == [2, 3]


def test_states_are_asked_for(spark, tmp_path):
    silver = cleaned(spark, _topic(spark, tmp_path))
    with pytest.raises(RuntimeError, match="new checkpoint"):
        incremental.add_batch(silver, 7, str(tmp_path / "state"), str(tmp_path / "gold"))


def _topic(spark, tmp_path):
    write_topic_file(spark, str(tmp_path / "topic"), days_of_events(2))
    return str(tmp_path / "topic")
