"""A JSON array that many tasks read gives the records of the plain reader."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.sources import files, json_array

SCHEMA = "id long, name string, tags array<string>, inner struct<a: long, b: struct<c: string>>, list array<struct<x: double>>"


def records(n, seed=1):
    rnd = random.Random(seed)
    words = ["plain", 'quo"te', "back\\slash", "bra{ce}s", "[list]", "}{", '\\"', "é漢", "line\nbreak", "tab\t", "", "\\\\", "},{", "x" * 90]
    return [
        {
            "id": k, "name": rnd.choice(words), "tags": [rnd.choice(words) for _ in range(rnd.randrange(4))],
            "inner": rnd.choice([None, {"a": k, "b": {"c": rnd.choice(words)}}, {"a": None, "b": None}]), "list": [{"x": 0.5}] * rnd.randrange(3),
        }
        for k in range(n)
    ]


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_same_records_as_the_plain_reader(spark, tmp_path, small_blocks, indent, ascii_only):
    rows = records(60)
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_only))
    (tmp_path / "b.json").write_text(" " + json.dumps(records(7, 2), indent=indent, separators=(" ,", " : ")) + "\n\n")
    path, schema = str(tmp_path), StructType.fromDDL(SCHEMA)
    got = files.read_json_array(spark, path, schema)
    want = spark.read.schema(schema).option("multiLine", True).json(path)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and want.count() == 67
    blocks = json_array._pieces(spark, path).select("path", "block").distinct().count()
    tasks = json_array._pieces(spark, path).select(F.spark_partition_id()).distinct().count()
    assert blocks > 10 and tasks > 10


def test_small_and_broken_files(spark, tmp_path, small_blocks):
    schema = StructType.fromDDL("id long, _corrupt_record string")
    texts = {"none": "[]", "empty": "", "one": '[{"id": 1}]', "plain": '[\n{"id": 2} ,\n {"id": 3}\n]\n', "cut": '[{"id": 4}, {"id": 5, "t": "' + "y}" * 400, "bad": '[{"id": 6}, {id? 7}, {"id": 8}]'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = {name: files.read_json_array(spark, str(tmp_path / f"{name}.json"), schema).collect() for name in texts}
    assert rows["none"] == rows["empty"] == [] and [r.id for r in rows["one"]] == [1]
    assert sorted(r.id for r in rows["plain"]) == [2, 3]
    assert sorted((r.id or 0, bool(r["_corrupt_record"])) for r in rows["cut"])[-1] == (4, False) and len(rows["cut"]) == 2
    assert sorted((r.id or 0, r["_corrupt_record"]) for r in rows["bad"] if r["_corrupt_record"]) == [(0, "{id? 7}")] and len(rows["bad"]) == 3


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [{"id": 1, "name": "a}{" * 2000}, {"id": 2, "name": "z"}]
    (tmp_path / "big.json").write_text(json.dumps(rows))
    got = files.read_json_array(spark, str(tmp_path), StructType.fromDDL("id long, name string")).collect()
    assert sorted((r.id, r.name) for r in got) == [(1, "a}{" * 2000), (2, "z")]
