"""Shards that all hold the mixture of the sources, by proportional stratified interleaving.

Rows of each source are shuffled by a seeded key and ranked; a row's fractional rank is its place
in its source as a share, (rank + 1/2) / rows of the source. Sorted by fractional rank, every
stretch of the table holds the sources in their proportions, so the table is cut into equal counts
of rows.

No source is ranked in one task: the key space of each source and the space of fractional ranks
are both cut into equal cells (keys are uniform, fractional ranks are so by construction), cells
are counted, and a row's rank is the count of earlier cells plus its place in its cell. Rows equal
in all that is used are counted first and dealt out at the end, so a row repeated millions of
times is one row until then.

Rows: a NULL source is a source of its own, apart from the empty one; a NULL text has no bytes and
a NULL checksum; a NULL id is an id; repeated rows get one place each; only the three columns named
are read; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.shared import stored

#: Rows of a cell, about.
CELL = 1 << 16
#: Digits of the key that are used: 60 bits.
_KEY_BITS = 60


def _before(cells: DataFrame, *within: str) -> DataFrame:
    """Adds `before`: the rows of earlier cells."""
    earlier = Window.partitionBy(*within).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def interleave(
    docs: DataFrame, shards: int, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot and fraction (the fractional rank) of each row.
    Shards hold counts of rows at most one apart; slots are gapless from 0 in each shard, in order of
    the fractional rank."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        size.alias("size"),
        F.crc32(F.col(text_col)).alias("text_crc32"),
    )
    same = ["doc_id", "no_source", "source", "size", "text_crc32"]
    label = F.concat_ws(":", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "size", "text_crc32")))
    key = F.conv(F.substring(F.md5(label), 1, _KEY_BITS // 4), 16, 10).cast("long")
    kinds = stored(rows.groupBy(*same).agg(F.count("*").alias("copies")).withColumn("key", key), "shard-rows")
    total = kinds.agg(F.sum("copies").alias("n")).first()["n"] or 0
    bits = max(6, (total // CELL).bit_length())

    # Ranks within the sources.
    kinds = kinds.withColumn("cell", F.shiftright("key", _KEY_BITS - bits))
    source = ["no_source", "source"]
    counted = stored(kinds.groupBy(*source, "cell").agg(F.sum("copies").alias("n")), "shard-cells")
    of_source = counted.groupBy(*source).agg(F.sum("n").alias("of_source"))
    cells = _before(counted, *source).join(of_source, source).drop("n")
    earlier = Window.partitionBy(*source, "cell").orderBy("key", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = kinds.join(cells, [*source, "cell"]).withColumn("rank", F.col("before") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)))

    # Places in the order of fractional ranks.
    one_each = ranked.withColumn("rank", F.explode(F.sequence("rank", F.expr("rank + copies - 1"))))
    fraction = (F.col("rank") + 0.5) / F.col("of_source")
    spread = stored(
        one_each.withColumn("fraction", fraction)
        .withColumn("cell", F.floor(F.col("fraction") * (1 << bits)))
        .select(*same, "fraction", "cell"),
        "shard-fractions",
    )
    order = Window.partitionBy("cell").orderBy("fraction", *source)
    # One row per cell: some thousands for billions of rows.
    bases = _before(spread.groupBy("cell").agg(F.count("*").alias("n")))
    place = spread.join(bases.drop("n"), "cell").withColumn("place", F.col("before") + F.row_number().over(order) - 1)
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return place.withColumn("shard", shard.cast("int")).select(
        "doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "text_crc32",
        "shard", (F.col("place") - first).alias("slot"), "fraction",
    )


def write_shards(
    docs: DataFrame, places: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> None:
    """Write every row of `docs`, with all its columns, to one folder per shard, in slot order. Rows that
    are equal in id, source and text are dealt to their places in any order. Columns of the documents
    that are named `shard` or `slot` are written as `shard_` and `slot_`."""
    used = ["doc_id", "source", "size", "text_crc32"]
    text = F.col(f"`{text_col}`")
    values = [F.col(f"`{id_col}`").cast("long"), F.col(f"`{source_col}`"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16, F.crc32(text)]
    own = docs.columns
    row = F.struct(*[F.col(f"`{x}`") for x in own]).alias("row")
    number = Window.partitionBy(*[f"k_{x}" for x in used])
    rows = docs.select(row, *[v.alias(f"k_{x}") for x, v in zip(used, values, strict=True)])
    rows = rows.withColumn("k_number", F.row_number().over(number.orderBy(F.xxhash64("row"))))
    where = places.select(*[F.col(x).alias(f"k_{x}") for x in used], "shard", "slot").withColumn("k_number", F.row_number().over(number.orderBy("shard", "slot")))
    same = [F.col(f"r.k_{x}").eqNullSafe(F.col(f"w.k_{x}")) for x in (*used, "number")]
    shards = where.select("shard").distinct().count()
    renamed = [F.col(f"row.`{x}`").alias(f"{x}_" if x in ("shard", "slot") else x) for x in own]
    dealt = rows.alias("r").join(where.alias("w"), same).select(*renamed, "shard", "slot")
    dealt.repartitionByRange(max(1, shards), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
