"""A corpus pipeline: five stages over the documents, each by one operator of ledgerflow.llm.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is stored as Parquet and read
again as the next one's docs. All but the last return the columns of docs, whatever they are; only
doc_id, text and source are looked at. A NULL or empty text fails the quality rules, so later
stages see texts with words; they take NULLs all the same. Rows without an id are documents like
others. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import jaccard_join, latent_decontam, line_rules, packing, secrets
from ledgerflow.llm.queries import SEQUENCE, TOKENIZER
from ledgerflow.llm.shared import stored

#: Hundredths of Jaccard similarity from which documents are near-duplicates, by 5-word shingles.
SIMILAR, SHINGLE = 80, 5


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; lines that too many documents of a source share go too."""
    return _counted(line_rules.keep_good(docs, line_rules.frequent_lines(docs)))


#: Up to so many removed rows are sent to all tasks as 64-bit keys (16 MB); more are joined by a shuffle.
SENT_KEYS = 1_000_000


def _row_key() -> Column:
    """Names a row by its id and text; a NULL id counts as a value of its own."""
    doc_id = F.col("doc_id").cast("long")
    return F.xxhash64(doc_id.isNull(), doc_id, F.xxhash64("text"))


def _checked(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.limit(SENT_KEYS + 1).count() <= SENT_KEYS else keys


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id (no id comes last), then the least
    hash of the text; of repeated rows one. Texts without words are in no group, and stay."""
    found = jaccard_join.join_similar(docs, SIMILAR, SHINGLE).where("label is not null")
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text_key").alias("__key")
    rows = stored(found.groupBy("label", "doc_id", "text_key").agg(F.count("*").alias("copies")).withColumn("__key", key), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = rows.groupBy("label").agg(F.min_by("__key", order).alias("first"))
    rows = stored(rows.join(first, "label").select("__key", "copies", (F.col("__key") == F.col("first")).alias("stays")), "groups")
    gone, repeated = rows.where("not stays").select("__key"), rows.where("stays and copies > 1").select("__key")
    name = _free(docs, "__key")
    gone, repeated = (_checked(keys.withColumnRenamed("__key", name)) for keys in (gone, repeated))
    left = docs.withColumn(name, _row_key()).join(gone, name, "left_anti")
    single = left.join(repeated, name, "left_anti")
    one_each = left.join(repeated, name, "left_semi").dropDuplicates([name])
    return single.unionByName(one_each).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    space = latent_decontam.fit(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return latent_decontam.remove_leaks(docs, space)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    spans = _free(docs, "__spans")
    found = secrets.with_spans(docs, "text", spans)
    return _counted(found.withColumn("text", secrets.masked(F.col("text"), F.col(spans))).select(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document in training sequences: the token ids of each piece with their place."""
    return packing.pack(docs, TOKENIZER, SEQUENCE, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("pack_sequences", pack_sequences),
]

#: Near-duplicate groups, latent retrieval and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
