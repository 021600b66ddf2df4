"""Aggregate tables kept up to date at the cost of a micro-batch, not of its days.

Each batch writes what its rows add (`operators.gold_state`) to a folder of its own number, so a batch
that runs again replaces its own part and nothing else. The tables of the touched days are then made
from the parts of those days; cleaned files of earlier batches are not opened. Every `COMPACT` batches
the parts of the days touched since are added up to one base per day; a base counts only once its
line in the list of bases is written, and hides the parts up to its batch. Parts that two later bases
hide are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import schemas
from ledgerflow.operators import gold_state
from ledgerflow.operators.gold_state import DAY
from ledgerflow.sinks.batch import replace_date
from ledgerflow.sources.files import delete, exists, folders

#: Batches after which the parts of their days are added up.
COMPACT = 50

BASES = f"{DAY} date, upto long"


def _state_schema(spark: SparkSession, name: str, number: str) -> T.StructType:
    fields = gold_state.STATES[name](spark.createDataFrame([], schemas.SILVER_LAYER)).schema.fields
    return T.StructType([*fields, T.StructField(number, T.LongType())])


def _is_day(day: object) -> Column:
    return F.col(DAY).isNull() if day is None else F.col(DAY) == F.lit(day)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for x in conditions:
        out = out | x
    return out


def _bases(spark: SparkSession, root: str, days: list, upto: int) -> dict:
    """The newest base of each day that has one."""
    if not exists(spark, f"{root}/bases/list"):
        return {}
    known = spark.read.schema(BASES).parquet(f"{root}/bases/list").where((F.col("upto") <= upto) & _any([_is_day(d) for d in days]))
    return {r[DAY]: r["upto"] for r in known.groupBy(DAY).agg(F.max("upto").alias("upto")).collect()}  # one row a day


def read_state(spark: SparkSession, root: str, name: str, days: list, upto: int) -> DataFrame:
    """Everything that batches up to `upto` have added to some days, not yet added up."""
    bases = _bases(spark, root, days, upto)
    parts = spark.read.schema(_state_schema(spark, name, "batch")).parquet(f"{root}/{name}")
    fresh = _any([_is_day(d) & (F.col("batch") > F.lit(bases.get(d, -1))) for d in days])
    out = parts.where(fresh & (F.col("batch") <= upto)).drop("batch")
    if bases:
        old = spark.read.schema(_state_schema(spark, name, "upto")).parquet(f"{root}/bases/{name}")
        out = out.unionByName(old.where(_any([_is_day(d) & (F.col("upto") == u) for d, u in bases.items()])).drop("upto"))
    return out


def compact(spark: SparkSession, root: str, days: list, upto: int) -> None:
    """Add up the parts of some days into a base; running it again replaces the base by the same one."""
    for name in gold_state.STATES:
        whole = gold_state.added_up(name, read_state(spark, root, name, days, upto))
        whole.hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY).parquet(f"{root}/bases/{name}/upto={upto}")
    schema = T.StructType([T.StructField(DAY, T.DateType()), T.StructField("upto", T.LongType())])
    spark.createDataFrame([(d, upto) for d in days], schema).coalesce(1).write.mode("append").parquet(f"{root}/bases/list")


def _batches(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(x.split("=")[1]) for x in folders(spark, f"{root}/measures") if x.startswith("batch="))


def _tidy(spark: SparkSession, root: str, batch_id: int, every: int) -> None:
    """Remove parts that the base before the last hides already."""
    for number in _batches(spark, root):
        if number <= batch_id - 2 * every:
            for name in gold_state.STATES:
                delete(spark, f"{root}/{name}/batch={number}")


def add_batch(batch: DataFrame, batch_id: int, root: str, tables: str, every: int = COMPACT) -> None:
    """Take in a batch of cleaned rows: its states to `root`, the tables of its days below `tables`."""
    spark = batch.sparkSession
    if batch_id > 0 and not exists(spark, f"{root}/measures"):
        raise RuntimeError(f"no states in {root}: a query of whole days went before; begin with a new checkpoint")
    batch = batch.persist()
    try:
        days = [r[0] for r in batch.select(DAY).distinct().collect()]  # at most one value per calendar day
        for name, of in gold_state.STATES.items():
            of(batch).write.mode("overwrite").partitionBy(DAY).parquet(f"{root}/{name}/batch={batch_id}")
    finally:
        batch.unpersist()
    if days:
        measures, users = (gold_state.added_up(x, read_state(spark, root, x, days, batch_id)).persist() for x in ("measures", "people"))
        for name, build in gold_state.TABLES.items():
            replace_date(build(measures, users), f"{tables}/{name}", DAY)
        measures.unpersist()
        users.unpersist()
        replace_date(read_state(spark, root, "members", days, batch_id), f"{tables}/fraud_members", DAY)
    if batch_id % every == every - 1:
        first = batch_id - every + 1
        recent = spark.read.schema(_state_schema(spark, "measures", "batch")).parquet(f"{root}/measures").where(F.col("batch").between(first, batch_id))
        if touched := [r[0] for r in recent.select(DAY).distinct().collect()]:
            compact(spark, root, touched, batch_id)
        _tidy(spark, root, batch_id, every)
