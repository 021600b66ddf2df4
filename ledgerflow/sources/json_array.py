"""One large JSON array, read by many tasks.

A file is taken apart at every `}`, which the text source can do in parallel, wherever a block begins.
Whether a `}` closes a record depends on all that stands before it: on how many quotes (is it inside a
string?) and on how many brackets are open. Both are sums, so each block adds up its own, a step over
the blocks (one row each) tells every block what lies before it, and each piece then knows its depth.
Pieces up to a closing at depth 1 are one record, also where it spans blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

c = F.col

_BLOCK = ["path", "block"]


def _count(text: Column, sign: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(sign), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between closing braces: path, block, place in the block, text, number of quotes."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        c("_metadata.file_path").alias("path"),
        c("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # in order within a block, whatever the task
        "value",
        # An escaped sign is no quote; the escape itself ends within its piece.
        F.regexp_replace("value", r"\\.", "").alias("bare"),
    ).withColumn("quotes", _count(c("bare"), '"'))


def _before(rows: DataFrame, amount: str, name: str) -> DataFrame:
    """Add `name`: the sum of `amount` over all pieces of the file before a piece. Blocks are added up
    first, so no task sees more than one block."""
    blocks = rows.groupBy(*_BLOCK).agg(F.sum(amount).alias("__whole"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    blocks = blocks.select(*_BLOCK, F.coalesce(F.sum("__whole").over(earlier), F.lit(0)).alias("__earlier"))
    inside = Window.partitionBy(*_BLOCK).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return rows.join(blocks, _BLOCK).withColumn(name, own + c("__earlier")).drop("__earlier")


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, number, record: the text of every object of the arrays in the files, numbered per file. An
    object that is never closed comes out as it is."""
    rows = _before(_pieces(spark, path), "quotes", "__quotes")
    in_string = F.pmod(c("__quotes"), F.lit(2)) == 1
    # What stands outside strings: a string that is open goes up to its quote, whole ones, an unclosed one.
    opened = F.when(in_string, F.regexp_replace("bare", '^[^"]*("|$)', "")).otherwise(c("bare"))
    outside = F.regexp_replace(F.regexp_replace(opened, '"[^"]*"', ""), '"[^"]*$', "")
    ends_outside = F.pmod(c("__quotes") + c("quotes"), F.lit(2)) == 0
    rows = rows.withColumns({"outside": outside, "closes": ends_outside.cast("int")}).drop("bare", "quotes", "__quotes")
    up = _count(c("outside"), "{") + _count(c("outside"), "[") - _count(c("outside"), "]")
    rows = _before(rows.withColumn("change", up - c("closes")), "change", "__depth")
    done = (c("closes") == 1) & (c("__depth") + c("change") == 1)
    rows = _before(rows.withColumn("done", done.cast("int")).drop("outside", "change", "__depth"), "done", "number")
    whole = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    texts = rows.groupBy("path", "number").agg(whole.alias("__all"), F.max("done").alias("__done"))
    text = F.regexp_replace(F.array_join(F.transform("__all", lambda x: x["value"]), "}"), r"^[^{]*", "")
    texts = texts.select("path", "number", F.concat(text, F.when(c("__done") == 1, "}").otherwise("")).alias("record"))
    return texts.where(F.startswith("record", F.lit("{")))


def read_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records of JSON array files. The array's elements are objects. Unreadable ones give NULLs, and
    their text where the schema has the column `_corrupt_record`."""
    return record_texts(spark, path).select(F.from_json("record", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
