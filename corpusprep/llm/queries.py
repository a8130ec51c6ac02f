"""The registered query of each operator: the operator over its whole table, and the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import (
    bpe_transducer,
    embed_dedup,
    exact_index,
    fim,
    hash_tree,
    html_main,
    langid,
    minhash_forest,
    packing,
    suffix_dedup,
    token_count,
    turn_repair,
    url_filter,
)
from corpusprep.llm.common import table


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.clean(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return cleaned.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = hash_tree.balanced(8)
    placed = hash_tree.shard(table(spark, sf_dir, "documents"), shards, hash_tree.joined(shards, 8))
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link(table(spark, sf_dir, "embeddings"), 0.95).withColumnRenamed("id", "vec_id")


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pieces.withColumnRenamed("id", "doc_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op7_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near(table(spark, sf_dir, "documents"), width=2, percent=80).withColumnRenamed("id", "doc_id")


def op8_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    coded = bpe_transducer.round_trip(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.withColumnRenamed("id", "doc_id")


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that the language classifier never learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.fit(documents, ~held_out())
    found = langid.predict(documents, model)
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "rejected")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_index.dedup(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_repair.damaged(table(spark, sf_dir, "conversations"))
    return turn_repair.audit(turns).withColumnRenamed("conv", "conv_id")


def op12_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumnRenamed("id", "doc_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"))
    output, form = F.col("fim")["output"], F.col("fim")["form"]
    return made.select(
        "doc_id",
        F.col("fim")["n"].alias("n"),
        form.alias("form"),
        F.col("fim")["prefix_chars"].alias("prefix_chars"),
        F.col("fim")["middle_chars"].alias("middle_chars"),
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fim.restored(output, form), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_suffix_array": op1_suffix_array,
    "op2_hash_tree": op2_hash_tree,
    "op3_embeddings": op3_embeddings,
    "op4_best_fit": op4_best_fit,
    "op5_url_filter": op5_url_filter,
    "op6_main_text": op6_main_text,
    "op7_minhash_forest": op7_minhash_forest,
    "op8_transducer": op8_transducer,
    "op9_language": op9_language,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_turn_repair": op11_turn_repair,
    "op12_token_count": op12_token_count,
    "op13_fill_in_middle": op13_fill_in_middle,
}
