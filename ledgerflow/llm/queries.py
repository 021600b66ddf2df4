"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    chunk_dedup,
    divergence,
    jaccard_join,
    latent_decontam,
    licenses,
    line_rules,
    ngram_lm,
    oracle,
    packing,
    phrases,
    prefix_tokens,
    secrets,
    sharding,
    training_order,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Tokens of one training sequence.
SEQUENCE = 2048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Tokens up to which a text may be asked to be cut.
BUDGETS = (512, 1024, 2048)

#: Words of an n-gram.
ORDER = 3

#: Shards of the table.
SHARDS = 40


def op1_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "source", "fraction",
    )


def op2_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_tokens.count_prefixes(documents(spark, sf_dir), TOKENIZER, budgets=BUDGETS, keep_steps=False)
    return counts.withColumn("over_limit", F.col("n_tokens") > SEQUENCE)


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    model = ngram_lm.train(docs.where(~held_out), ORDER)
    scores = ngram_lm.score(docs, model)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.totals[0][1]).cast("long").alias("train_tokens"),
        "base_score", "score", ngram_lm.perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    spans = F.col("spans")
    base = F.filter(spans, lambda x: x["kind"] < 3)
    return found.select(
        "doc_id",
        *(secrets.count_kind(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(documents(spark, sf_dir), TOKENIZER, SEQUENCE)[1]


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_rules.assess(docs, line_rules.frequent_lines(docs))


def op7_repeated_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return chunk_dedup.repeated_spans(docs, chunk_dedup.find_repeats(docs))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), TOKENIZER, SEQUENCE)


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    space = latent_decontam.fit(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return latent_decontam.find_leaks(docs, space)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    joined = {c: F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")}
    return found.select(*(joined.get(c, c) for c in found.columns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_stratified_shards": op1_stratified_shards,
    "op2_prefix_tokens": op2_prefix_tokens,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_secret_scan": op4_secret_scan,
    "op5_training_order": op5_training_order,
    "op6_line_rules": op6_line_rules,
    "op7_repeated_chunks": op7_repeated_chunks,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_latent_decontamination": op10_latent_decontamination,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_source_divergence": op12_source_divergence,
    "op13_license_scan": op13_license_scan,
}
ORACLE: dict[str, str] = {
    "op1_stratified_shards": oracle.SHARDS,
    "op4_secret_scan": oracle.SECRETS,
    "op8_jaccard_join": oracle.JACCARD,
    "op11_phrase_mining": oracle.PHRASES,
    "op12_source_divergence": oracle.DIVERGENCE,
    "op13_license_scan": oracle.LICENSES,
}
